"""Resolution of not-modified revisit records of web archives.

A record is (record_id, url, ts, kind, headers, payload): ``response`` holds a
full payload, ``revisit`` only the headers of a 304.  Each revisit is joined
as-of to the latest earlier response of its canonical URL.  Its validators are
checked (entity tags first, compared weakly, else last-modified dates), and the
headers a 304 may update are merged over the stored ones.

The as-of join orders records of a URL by time in cells: a range partitioning by
time deals all records over ranges of equally many, a window finds the latest response inside a
(URL, range), and a window over the ranges of a URL carries it forward.  A URL
with a third of all records is thus spread over the ranges.

Header names are compared and returned in lower case; of several spellings of one
name in a record the last counts.

Defined results: records of a null URL are never resolved, and take no part in the join; a null time sorts
before all others; earlier means a smaller time, so a response of the same time
does not serve; of responses at one time the largest record_id does; repeated
rows are resolved each; without validators on both sides a revisit is
``unverified``; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearbid.llm.common import materialize

CELL_ROWS, MAX_CELLS = 5000, 4096   # records of one time range, and how many ranges there are at most
# headers that a 304 response may bring up to date
UPDATABLE = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Scheme, user, default port, ``www.``, fragment, tracking parameters and a closing slash or index page go."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    u = F.regexp_replace(u, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(u, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":(80|443)$", "")
    host = F.regexp_replace(host, r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[^/?]*([^?]*)", 1), r"/(index\.html?)?$", "")
    query = F.regexp_replace(F.regexp_extract(u, r"\?(.*)$", 1), "(^|&)(utm_[a-z]*|ref)=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    return F.concat(host, path, F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))


def lower_names(headers: Column) -> Column:
    """Header map with lower-case names; the last of several spellings stays."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    named = F.transform(entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    last = F.filter(named, lambda e, i: ~F.exists(F.slice(named, i + 2, F.size(named)), lambda x: x["key"] == e["key"]))
    return F.map_from_entries(last)


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit: its reference, the outcome and the merged headers.

    (record_id, url, canonical_url, ts, ref_record_id, outcome, headers); the
    reference and headers are null unless the outcome is ``resolved`` or
    ``unverified``.  The payload stays with the response it refers to.
    """
    bare = lambda h: F.regexp_replace(h["etag"], "^W/", "")
    rows = records.select(
        "record_id", "url", canonical_url(F.col("url")).alias("canonical_url"), "ts", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.coalesce(F.col("kind") == "response", F.lit(False)).alias("full"), lower_names(F.col("headers")).alias("headers"))
    cells = min(MAX_CELLS, max(1, records.count() // CELL_ROWS))
    # the ranges ascend, nulls first; the written number of a row's range does not change when a task runs again
    dealt = materialize(rows.filter(F.col("canonical_url").isNotNull()).repartitionByRange(cells, F.col("at").asc_nulls_first())
                        .withColumn("cell", F.spark_partition_id()), "records")
    lost = rows.filter(F.col("canonical_url").isNull() & ~F.col("full"))
    stored = F.struct("at", "record_id", "headers")
    # revisits come first at equal times: only earlier responses are seen
    inside = Window.partitionBy("canonical_url", "cell").orderBy(F.col("at").asc_nulls_first(), "full", "record_id")
    latest = F.last(F.when(F.col("full"), stored), ignorenulls=True)
    near = dealt.withColumn("near", latest.over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    ends = (dealt.filter("full").groupBy("canonical_url", "cell")
            .agg(F.max_by(stored, F.struct("at", "record_id")).alias("end")))
    starts = dealt.select("canonical_url", "cell").distinct().join(ends, ["canonical_url", "cell"], "left")
    earlier = Window.partitionBy("canonical_url").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = starts.select("canonical_url", "cell", F.last("end", ignorenulls=True).over(earlier).alias("carry"))
    found = (near.filter(~F.col("full")).join(carried, ["canonical_url", "cell"], "left").withColumn("ref", F.coalesce("near", "carry"))
             .unionByName(lost, allowMissingColumns=True))
    mine, theirs = F.col("headers"), F.col("ref.headers")
    tags = F.when(bare(mine).isNotNull() & bare(theirs).isNotNull(), bare(mine) == bare(theirs))
    dates = F.when(mine["last-modified"].isNotNull() & theirs["last-modified"].isNotNull(), mine["last-modified"] == theirs["last-modified"])
    same = F.coalesce(tags, dates)
    outcome = (F.when(F.col("ref").isNull(), "no earlier response").when(same.isNull(), "unverified")
               .when(same, "resolved").otherwise("validators differ"))
    names = F.array(*[F.lit(h) for h in UPDATABLE])
    update = F.map_filter(mine, lambda k, v: F.array_contains(names, k))
    merged = F.map_concat(F.map_filter(theirs, lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)
    told = found.withColumn("outcome", outcome)
    good = F.col("outcome").isin("resolved", "unverified")
    return told.select("record_id", "url", "canonical_url", "ts", F.when(good, F.col("ref.record_id")).alias("ref_record_id"),
                       "outcome", F.when(good, merged).alias("headers"))
