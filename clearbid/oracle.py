"""DuckDB oracle SQL for every registered query.

Each oracle rebuilds the ad tables from ``events``/``nation``/``region`` with
the same rules as ``clearbid.sources.fixtures`` and then states the query in a
*different* formulation from the Spark plan (self-join to the group maximum,
rank over the full touch join, literal per-interval templates), so a shared
mistake shows up as a mismatch.  Doubles are rounded to 6 places on both
sides (see ``R``); counts are cast to BIGINT (DuckDB sums integers to HUGEINT).
"""

from __future__ import annotations

from datetime import datetime, timedelta

FMT = "%Y-%m-%d %H:%M:%S"


def T(dt: datetime) -> str:
    return f"TIMESTAMP '{dt.strftime(FMT)}'"


def R(expr: str) -> str:
    """Round a double to 6 places for comparison, nudged 1e-12 away from zero.

    Averages whose exact value sits on a half-way point (e.g. 2.8728125) come
    out a few ulps either side of it depending on summation order, which
    differs between engines and even between Spark runs; the nudge makes both
    round such values the same way.  Spark applies the same rule.
    """
    return f"round(({expr}) + sign({expr}) * 1e-12, 6)"


FIXTURES = """
ev_auc AS (
  SELECT e.event_id AS eid, e.ts, e.user_id AS uid, e.event_type,
         unnest(CASE WHEN e.event_id % 3 = 0 THEN [0, 1] ELSE [0] END) AS slot
  FROM events e WHERE e.event_type IN ('view', 'error')
),
auctions AS (
  SELECT x.ts AS tstamp,
         'a' || CAST(x.eid AS VARCHAR) AS "auctionId",
         'i' || CAST(x.eid * 10 + x.slot AS VARCHAR) AS impid,
         'u' || CAST(x.uid AS VARCHAR) AS uuid,
         CASE WHEN x.event_type = 'view' THEN 'info' ELSE 'error' END AS level,
         'pub' || CAST(x.uid % 3 AS VARCHAR) AS publisher,
         'site' || CAST(x.uid % 6 AS VARCHAR) AS site,
         'page' || CAST(x.eid % 4 AS VARCHAR) AS page,
         'pl' || CAST(x.slot AS VARCHAR) AS placement,
         'pc' || CAST(x.uid % 3 AS VARCHAR) AS pub_clique,
         CASE WHEN x.uid % 13 = 0 THEN NULL ELSE n.n_name END AS country,
         r.r_name AS region,
         'city' || CAST(x.uid % 7 AS VARCHAR) AS city,
         CAST(500 + x.uid % 50 AS BIGINT) AS metro,
         'z' || CAST(x.uid % 40 AS VARCHAR) AS zip,
         CASE WHEN x.eid % 9 = 0 THEN NULL
              WHEN x.eid % 9 = 1 THEN ''
              ELSE 'k' || CAST(x.eid % 3 AS VARCHAR) || ',k' || CAST(3 + x.eid % 5 AS VARCHAR) END AS keywords,
         x.eid, x.slot
  FROM ev_auc x
  JOIN nation n ON n.n_nationkey = x.uid % 25
  JOIN region r ON r.r_regionkey = n.n_regionkey
),
impressions AS (
  SELECT tstamp + INTERVAL 2 SECOND AS tstamp, "auctionId", impid, uuid,
         'adv' || CAST(eid % 4 AS VARCHAR) AS advertiser,
         'cmp' || CAST(eid % 8 AS VARCHAR) AS campaign,
         'cg' || CAST(eid % 3 AS VARCHAR) AS creativegroup,
         'cr' || CAST(slot AS VARCHAR) AS creative,
         'ac' || CAST(eid % 2 AS VARCHAR) AS adv_clique,
         eid, slot
  FROM auctions WHERE level = 'info'
),
bids_k AS (
  SELECT a.*, unnest(generate_series(1, 1 + a.eid % 5)) AS k FROM auctions a WHERE a.level = 'info'
),
bids AS (
  SELECT tstamp + INTERVAL 1 SECOND AS tstamp,
         impid || 'b' || CAST(k AS VARCHAR) AS bidid, "auctionId", impid,
         'ac' || CAST((eid + CASE WHEN k = 5 THEN 1 ELSE 0 END) % 2 AS VARCHAR) AS adv_clique,
         CAST(1 + (eid * 7 + (k % 3) * 3) % 20 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS bid,
         eid, slot
  FROM bids_k
),
clicks_c AS (
  SELECT i.*, unnest([5, 25]) AS c FROM impressions i WHERE i.slot = 0
),
clicks AS (
  SELECT tstamp + INTERVAL 60 SECOND AS tstamp,
         impid || 'c' || CAST(c AS VARCHAR) AS clickid,
         impid, uuid, advertiser, campaign, creativegroup, creative, eid, slot
  FROM clicks_c WHERE eid % c = 0
),
actions AS (
  SELECT ts AS tstamp, 'x' || CAST(event_id AS VARCHAR) AS actionid,
         'u' || CAST(user_id AS VARCHAR) AS uuid,
         'adv' || CAST(event_id % 4 AS VARCHAR) AS advertiser,
         event_type AS actionbeacon, value, event_id AS eid
  FROM events WHERE event_type IN ('purchase', 'signup')
),
auction_defaults AS (
  SELECT DISTINCT tstamp, "auctionId" FROM auctions WHERE level = 'error'
)"""


def with_fixtures(*ctes: str) -> str:
    parts = [FIXTURES.strip()] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts)


# --------------------------------------------------------------------------- auctions

def auction_stats_cte(name: str, start: datetime, end: datetime, widen_h: int = 1) -> str:
    """Self-join form: bids joined to their group max; non-winners price second."""
    ws, we = T(start - timedelta(hours=widen_h)), T(end + timedelta(hours=widen_h))
    return f"""
{name}_b AS (SELECT * FROM bids WHERE tstamp >= {ws} AND tstamp < {we}),
{name}_m AS (SELECT "auctionId", impid, adv_clique, MAX(bid) AS max_bid FROM {name}_b GROUP BY 1, 2, 3),
{name}_w AS (
  SELECT b.bidid FROM {name}_b b JOIN {name}_m m
    ON b."auctionId" = m."auctionId" AND b.impid = m.impid AND b.adv_clique = m.adv_clique AND b.bid = m.max_bid
),
{name}_g AS (
  SELECT a.tstamp, a."auctionId", a.uuid, a.impid,
         COUNT(bb.bidid) AS num_bids, MAX(bb.bid) AS max_bid,
         MAX(CASE WHEN w.bidid IS NULL THEN bb.bid END + 0.01) AS cp
  FROM auctions a
  JOIN impressions i ON a.impid = i.impid
  JOIN {name}_b bb ON a."auctionId" = bb."auctionId" AND a.impid = bb.impid AND i.adv_clique = bb.adv_clique
  LEFT JOIN {name}_w w ON bb.bidid = w.bidid
  WHERE a.tstamp >= {T(start)} AND a.tstamp < {T(end)}
    AND i.tstamp >= {ws} AND i.tstamp < {we}
    AND a.level = 'info'
  GROUP BY 1, 2, 3, 4
),
{name}_info AS (
  SELECT tstamp, "auctionId", uuid, impid, CAST(num_bids AS BIGINT) AS num_bids, max_bid,
         COALESCE(cp, max_bid) AS clearprice FROM {name}_g
),
{name}_err AS (
  SELECT tstamp, "auctionId", uuid, impid, CAST(0 AS BIGINT) AS num_bids,
         CAST(0.0 AS DOUBLE) AS max_bid, CAST(0.0 AS DOUBLE) AS clearprice
  FROM auctions WHERE tstamp >= {T(start)} AND tstamp < {T(end)} AND level = 'error'
  GROUP BY 1, 2, 3, 4
),
{name} AS (SELECT * FROM {name}_info UNION ALL SELECT * FROM {name}_err)"""


def auction_stats_hourly_cte(name: str, widen_h: int = 1) -> str:
    """Per-hour form: bounds relative to each auction's own hour, window max per slot."""
    lo = f"date_trunc('hour', a.tstamp) - INTERVAL {widen_h} HOUR"
    hi = f"date_trunc('hour', a.tstamp) + INTERVAL {1 + widen_h} HOUR"
    return f"""
{name}_j AS (
  SELECT a.tstamp, a."auctionId", a.uuid, a.impid, i.adv_clique, bb.bidid, bb.bid,
         MAX(bb.bid) OVER (PARTITION BY a.tstamp, a."auctionId", a.uuid, a.impid, i.adv_clique) AS mx
  FROM auctions a
  JOIN impressions i ON a.impid = i.impid
  JOIN bids bb ON a."auctionId" = bb."auctionId" AND a.impid = bb.impid AND i.adv_clique = bb.adv_clique
  WHERE a.level = 'info' AND i.tstamp >= {lo} AND i.tstamp < {hi}
    AND bb.tstamp >= {lo} AND bb.tstamp < {hi}
),
{name}_info AS (
  SELECT tstamp, "auctionId", uuid, impid, CAST(COUNT(bidid) AS BIGINT) AS num_bids, MAX(bid) AS max_bid,
         COALESCE(MAX(CASE WHEN bid < mx THEN bid END) + 0.01, MAX(bid)) AS clearprice
  FROM {name}_j GROUP BY 1, 2, 3, 4
),
{name}_err AS (
  SELECT tstamp, "auctionId", uuid, impid, CAST(0 AS BIGINT) AS num_bids,
         CAST(0.0 AS DOUBLE) AS max_bid, CAST(0.0 AS DOUBLE) AS clearprice
  FROM auctions WHERE level = 'error' GROUP BY 1, 2, 3, 4
),
{name} AS (SELECT * FROM {name}_info UNION ALL SELECT * FROM {name}_err)"""


# ------------------------------------------------------------------------ attribution

IMP_COLS = ["imp_tstamp", "action_tstamp", "uuid", "actionid", "impid", "advertiser", "campaign",
            "creativegroup", "creative", "adv_clique", "actionbeacon", "value", "publisher", "site",
            "page", "placement", "pub_clique"]
CLICK_COLS = ["click_tstamp", "action_tstamp", "uuid", "actionid", "impid", "clickid", "advertiser",
              "campaign", "creativegroup", "creative", "actionbeacon", "value", "publisher", "site",
              "page", "placement", "pub_clique"]
IMP_ORDER = ["action_tstamp", "uuid", "advertiser", "actionbeacon", "value", "impid", "imp_tstamp",
             "campaign", "creativegroup", "creative", "adv_clique", "publisher", "site", "page",
             "placement", "pub_clique"]
CLICK_ORDER = ["action_tstamp", "uuid", "advertiser", "actionbeacon", "value", "impid", "clickid",
               "click_tstamp", "campaign", "creativegroup", "creative", "publisher", "site", "page",
               "placement", "pub_clique"]


def _matched_cte(name: str, touch: str, ttime: str, tcols: list[str], out: list[str], order: list[str],
                 action_where: str, touch_lo: str, auction_lo: str) -> str:
    """Reference form: max touch time per action, re-join tied touches, join auctions, rank."""
    tsel = ", ".join(f"t.{c}" for c in tcols)
    order_sql = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return f"""
{name}_a AS (SELECT * FROM actions WHERE {action_where}),
{name}_m AS (
  SELECT ia.actionid, ia.tstamp, ia.uuid, ia.advertiser, ia.actionbeacon, ia.value,
         MAX(t.tstamp) AS {ttime}
  FROM {touch} t JOIN {name}_a ia ON ia.uuid = t.uuid AND ia.advertiser = t.advertiser
  WHERE t.tstamp <= ia.tstamp AND t.tstamp >= {touch_lo.format(ts='ia.tstamp')}
  GROUP BY 1, 2, 3, 4, 5, 6
),
{name}_c AS (
  SELECT m.{ttime}, m.tstamp AS action_tstamp, m.uuid, m.actionid, m.advertiser, m.actionbeacon, m.value,
         {tsel}, au.publisher, au.site, au.page, au.placement, au.pub_clique
  FROM {name}_m m
  JOIN {touch} t ON m.{ttime} = t.tstamp AND m.uuid = t.uuid AND m.advertiser = t.advertiser
  JOIN auctions au ON t.impid = au.impid AND au.tstamp >= {auction_lo.format(ts='m.tstamp')}
),
{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY actionid ORDER BY {order_sql}) AS rn FROM {name}_c
),
{name} AS (SELECT {", ".join(out)} FROM {name}_r WHERE rn = 1)"""


def imp_matched_cte(name: str, start: datetime, end: datetime, lookback: int) -> str:
    lo = T(end - timedelta(days=lookback))
    return _matched_cte(name, "impressions", "imp_tstamp",
                        ["impid", "campaign", "creativegroup", "creative", "adv_clique"], IMP_COLS, IMP_ORDER,
                        f"tstamp >= {T(start)} AND tstamp < {T(end)}", lo, lo)


def click_matched_cte(name: str, start: datetime, end: datetime, lookback: int) -> str:
    return _matched_cte(name, "clicks", "click_tstamp",
                        ["impid", "clickid", "campaign", "creativegroup", "creative"], CLICK_COLS, CLICK_ORDER,
                        f"tstamp >= {T(start)} AND tstamp < {T(end)}",
                        T(end - timedelta(days=lookback)), T(start - timedelta(days=lookback)))


def imp_matched_hourly_cte(name: str, lookback: int) -> str:
    lo = "date_trunc('hour', {ts}) + INTERVAL 1 HOUR - INTERVAL %d DAY" % lookback
    return _matched_cte(name, "impressions", "imp_tstamp",
                        ["impid", "campaign", "creativegroup", "creative", "adv_clique"], IMP_COLS, IMP_ORDER,
                        "TRUE", lo, lo)


def click_matched_hourly_cte(name: str, lookback: int) -> str:
    lo_t = "date_trunc('hour', {ts}) + INTERVAL 1 HOUR - INTERVAL %d DAY" % lookback
    lo_a = "date_trunc('hour', {ts}) - INTERVAL %d DAY" % lookback
    return _matched_cte(name, "clicks", "click_tstamp",
                        ["impid", "clickid", "campaign", "creativegroup", "creative"], CLICK_COLS, CLICK_ORDER,
                        "TRUE", lo_t, lo_a)


def rounded_select(cols: list[str], doubles: set[str], src: str) -> str:
    sel = [f"{R(c)} AS {c}" if c in doubles else c for c in cols]
    return f"SELECT {', '.join(sel)} FROM {src}"


# --------------------------------------------------------------------------- rollups

GEO = ["country", "region", "city", "DMA", "zip"]
DIMS = {
    "hourly": {
        "imps": ["publisher", "site", "page", "placement", "advertiser", "campaign", "creativegroup",
                 "creative", "pub_clique", "adv_clique"],
        "actions": ["publisher", "site", "page", "placement", "advertiser", "campaign", "creativegroup",
                    "creative", "actionbeacon", "pub_clique", "adv_clique"],
        "defaults": ["publisher", "site", "page", "placement", "pub_clique"],
    },
    "geo": {
        "imps": ["publisher", "site", "page", "advertiser", "campaign", "pub_clique", "adv_clique"] + GEO,
        "actions": ["publisher", "site", "page", "advertiser", "campaign", "actionbeacon", "pub_clique",
                    "adv_clique"] + GEO,
        "defaults": ["publisher", "site", "page", "pub_clique"] + GEO,
    },
    "keyword": {
        "imps": ["publisher", "site", "page", "placement", "keywords", "advertiser", "campaign",
                 "creativegroup", "creative", "pub_clique", "adv_clique"],
        "actions": ["publisher", "site", "page", "placement", "advertiser", "campaign", "creativegroup",
                    "creative", "actionbeacon", "pub_clique", "adv_clique", "keywords"],
        "defaults": ["publisher", "site", "page", "placement", "pub_clique", "keywords"],
    },
}
IMP_SIDE = {"advertiser", "campaign", "creativegroup", "creative", "adv_clique"}


def _auction_expr(col: str, alias: str = "a") -> str:
    if col == "region":
        return f"{alias}.country || '-' || {alias}.region"
    if col == "DMA":
        return f"{alias}.metro"
    return f"{alias}.{col}"


def _kw_out(col: str) -> str:
    if col != "keywords":
        return col
    return ("CASE WHEN keywords IS NULL THEN NULL WHEN keywords = '' THEN CAST([] AS VARCHAR[]) "
            "ELSE string_split(keywords, ',') END AS keywords")


def imps_rollup_sql(grain: str, pricing: str, label: str, where: str, stats: str) -> tuple[list[str], str]:
    """stats: name of an auction_stats CTE; label: SQL for the hour column."""
    dims = DIMS[grain]["imps"]
    sel = [f"{('i.' + d) if d in IMP_SIDE else _auction_expr(d)} AS {d}" for d in dims]
    spend = ("SUM(s.clearprice * CASE WHEN c.clickid IS NULL THEN 0 ELSE 1 END)" if pricing == "CPC"
             else "SUM(s.clearprice) / 1000")
    inner = f"""
SELECT {label} AS hour, {", ".join(sel)},
       AVG(s.clearprice) AS clearprice, CAST(SUM(s.num_bids) AS BIGINT) AS bids,
       CAST({spend} AS DOUBLE) AS spend, CAST(COUNT(a.impid) AS BIGINT) AS imps,
       CAST(COUNT(DISTINCT a.uuid) AS BIGINT) AS uniques, CAST(COUNT(c.clickid) AS BIGINT) AS clicks,
       CAST(0 AS BIGINT) AS view_convs, CAST(0 AS BIGINT) AS click_convs
FROM auctions a
JOIN impressions i ON a.impid = i.impid
JOIN {stats} s ON a.impid = s.impid AND a."auctionId" = s."auctionId"
LEFT JOIN clicks c ON a.impid = c.impid
WHERE {where}
GROUP BY ALL"""
    cols = ["hour"] + dims + ["clearprice", "bids", "spend", "imps", "uniques", "clicks", "view_convs",
                              "click_convs"]
    return cols, inner


def actions_rollup_sql(grain: str, label: str, where: str, imp: str, click: str) -> tuple[list[str], str]:
    dims = DIMS[grain]["actions"]
    need_auction = grain != "hourly"
    sel = []
    for d in dims:
        if need_auction and d in GEO + ["keywords"]:
            sel.append(f"{_auction_expr(d, 'au')} AS {d}")
        else:
            sel.append(f"i.{d} AS {d}")
    join = "JOIN auctions au ON au.impid = i.impid" if need_auction else ""
    inner = f"""
SELECT {label} AS hour, {", ".join(sel)},
       CAST(0 AS BIGINT) AS bids, CAST(0 AS DOUBLE) AS spend, CAST(0 AS BIGINT) AS imps,
       CAST(0 AS BIGINT) AS uniques, CAST(0 AS BIGINT) AS clicks,
       CAST(SUM(CASE WHEN c.click_tstamp IS NULL OR c.click_tstamp <= i.imp_tstamp THEN 1 ELSE 0 END) AS BIGINT) AS view_convs,
       CAST(SUM(CASE WHEN c.click_tstamp IS NOT NULL AND c.click_tstamp > i.imp_tstamp THEN 1 ELSE 0 END) AS BIGINT) AS click_convs
FROM {imp} i
{join}
LEFT JOIN {click} c ON c.actionid = i.actionid
WHERE {where}
GROUP BY ALL"""
    cols = ["hour"] + dims + ["bids", "spend", "imps", "uniques", "clicks", "view_convs", "click_convs"]
    return cols, inner


def defaults_rollup_sql(grain: str, label: str, where: str) -> tuple[list[str], str]:
    dims = DIMS[grain]["defaults"]
    sel = [f"{_auction_expr(d)} AS {d}" for d in dims]
    inner = f"""
SELECT {label} AS hour, {", ".join(sel)},
       CAST(COUNT(d."auctionId") AS BIGINT) AS defaults, CAST(COUNT(DISTINCT a.uuid) AS BIGINT) AS uniques
FROM auctions a JOIN auction_defaults d ON a."auctionId" = d."auctionId"
WHERE {where}
GROUP BY ALL"""
    return ["hour"] + dims + ["defaults", "uniques"], inner


def finalize(cols: list[str], inner: str, doubles: set[str] = frozenset({"clearprice", "spend"})) -> str:
    out = []
    for c in cols:
        if c in doubles:
            out.append(f"{R(c)} AS {c}")
        else:
            out.append(_kw_out(c))
    return f"SELECT {', '.join(out)} FROM ({inner}) q"
