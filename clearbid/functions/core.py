"""Time, interval and string helpers shared by every operator.

All event times are ``timestamp_ntz`` holding UTC wall-clock values.  Literals
are built from strings so that the session time zone never shifts them and
Catalyst folds them into constants that reach the Parquet scan as pushed
filters.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TS_FMT = "%Y-%m-%d %H:%M:%S"


def ts_lit(value: datetime | str) -> Column:
    """A ``timestamp_ntz`` literal (UTC wall clock)."""
    text = value.isoformat(" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast(T.TimestampNTZType())


def hour_floor(col: Column | str) -> Column:
    """Start of the UTC hour holding ``col``, as ``timestamp_ntz``.

    Built from the day and the hour field, which Spark takes from the wall
    clock: ``date_trunc`` would go through the session time zone.
    """
    c = F.col(col) if isinstance(col, str) else col
    return day_floor(c) + F.make_dt_interval(F.lit(0), F.hour(c))


def day_floor(col: Column | str) -> Column:
    """Start of the UTC day holding ``col``, as ``timestamp_ntz``."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("date").cast(T.TimestampNTZType())


def utc_clock(instant: Column) -> Column:
    """An instant (``timestamp``) as its UTC wall clock, whatever the session time zone."""
    micros = F.unix_micros(instant)
    day = F.lit(86_400_000_000)
    whole = F.floor(micros / day).cast("int")
    rest = micros - whole.cast("bigint") * day
    seconds = (rest.cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return ts_lit("1970-01-01 00:00:00") + F.make_dt_interval(whole, F.lit(0), F.lit(0), seconds)


def in_range(col: Column | str, start: datetime | str, end: datetime | str) -> Column:
    """Half-open ``start <= col < end``."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= ts_lit(start)) & (c < ts_lit(end))


def _as_dt(value: datetime | str) -> datetime:
    return value if isinstance(value, datetime) else datetime.strptime(str(value), _TS_FMT)


def last_full_hour(now: datetime | None = None) -> tuple[datetime, datetime]:
    """Default job interval: the last complete UTC hour."""
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    end = now.replace(minute=0, second=0, microsecond=0)
    return end - timedelta(hours=1), end


@dataclass(frozen=True)
class Interval:
    """A half-open job interval ``[start, end)`` in UTC.

    ``start > end`` is an error; ``start == end`` is allowed and selects no
    rows.  ``widen`` and ``lookback`` give the derived bounds the operators
    use for bids/impressions and for attribution touches.
    """

    start: datetime
    end: datetime

    def __post_init__(self):
        object.__setattr__(self, "start", _as_dt(self.start))
        object.__setattr__(self, "end", _as_dt(self.end))
        if self.start > self.end:
            raise ValueError(f"an interval from {self.start} to {self.end} runs backwards")

    @classmethod
    def default(cls, now: datetime | None = None) -> "Interval":
        return cls(*last_full_hour(now))

    def contains(self, col: Column | str) -> Column:
        return in_range(col, self.start, self.end)

    def widened(self, hours: int = 1) -> "Interval":
        return Interval(self.start - timedelta(hours=hours), self.end + timedelta(hours=hours))

    def lookback_from_end(self, days: int) -> datetime:
        return self.end - timedelta(days=days)

    def lookback_from_start(self, days: int) -> datetime:
        return self.start - timedelta(days=days)

    def days(self) -> list[datetime]:
        """Every UTC day the interval touches (the daily rollup refreshes all)."""
        day = self.start.replace(hour=0, minute=0, second=0, microsecond=0)
        out = []
        while day < self.end:
            out.append(day)
            day += timedelta(days=1)
        return out


def split_keywords(col: Column | str) -> Column:
    """Comma list -> array<string>.

    Empty and trailing parts are kept ('a,,b,' -> [a, '', b, '']); NULL stays
    NULL and the empty string becomes the empty array.
    """
    c = F.col(col) if isinstance(col, str) else col
    return (F.when(c.isNull(), F.lit(None).cast("array<string>"))
            .when(c == "", F.array().cast("array<string>"))
            .otherwise(F.split(c, ",", -1)))


def geo_region(country: Column | str, region: Column | str) -> Column:
    """'country-region', NULL when either part is NULL."""
    c = F.col(country) if isinstance(country, str) else country
    r = F.col(region) if isinstance(region, str) else region
    return F.concat(c, F.lit("-"), r)


def parse_rfc3339(col: Column | str) -> Column:
    """RFC 3339 text (with any offset) -> UTC wall clock ``timestamp_ntz``."""
    c = F.col(col) if isinstance(col, str) else col
    return utc_clock(F.to_timestamp(c))


# The five cell types the warehouse result decoder knows, and the
# Spark type each becomes.
CELL_TYPES = {
    "STRING": T.StringType(),
    "INTEGER": T.LongType(),
    "FLOAT": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampNTZType(),
}


def decode_cells(df: DataFrame, field_types: dict[str, str], strict: bool = True) -> DataFrame:
    """Cast string cells to typed columns by warehouse type name.

    Unknown type names raise ``KeyError``.  TIMESTAMP cells hold float epoch
    seconds and are truncated to whole seconds.  ``strict=False`` uses
    ``try_cast`` so dirty cells become NULL instead of failing the job.
    """
    cols = []
    for name in df.columns:
        if name not in field_types:
            cols.append(F.col(name))
            continue
        target = CELL_TYPES[field_types[name]]
        src = F.col(name)
        if isinstance(target, T.TimestampNTZType):
            secs = src.try_cast("double") if not strict else src.cast("double")
            val = utc_clock(F.timestamp_seconds(F.floor(secs)))
        elif isinstance(target, T.BooleanType):
            low = F.lower(src)
            val = F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))
            if strict:
                val = val.otherwise(F.when(src.isNotNull(), src.cast("boolean")))
        else:
            val = src.cast(target) if strict else src.try_cast(target)
        cols.append(val.alias(name))
    return df.select(*cols)
