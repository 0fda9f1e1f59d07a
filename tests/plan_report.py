"""Print the physical-plan shape of the headline operators.

Usage: python tests/plan_report.py [ad_tables_root]

The ad tables are derived from /root/testdata/sf0.01 and written as
date-partitioned Parquet into a fresh scratch folder unless a root holding
them is given.  Broadcast joins are disabled so the plans show the shuffle
structure a large input would get.  For each operator the report counts
exchanges and scans and lists the pushed and partition filters of each scan.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile
from datetime import datetime

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clearbid.functions import Interval  # noqa: E402
from clearbid.operators import attribution as attr  # noqa: E402
from clearbid.operators import auctions as auc  # noqa: E402
from clearbid.operators import rollups as ru  # noqa: E402
from clearbid.plans import jobs  # noqa: E402
from clearbid.session import build_session  # noqa: E402
from clearbid.sources.fixtures import write_ad_tables  # noqa: E402


def shape(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" not in line:
            continue
        cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
        part = re.search(r"PartitionFilters: \[([^\]]*)\]", line)
        scans.append((cols.group(1) if cols else "", part.group(1) if part else ""))
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)),
        "scans": scans,
    }


def main(argv):
    spark = build_session("local[4]", extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                             "spark.sql.adaptive.enabled": "false"})
    if len(argv) > 1:
        root = argv[1]
        names = ["auctions", "impressions", "bids", "clicks", "actions", "auction_defaults"]
        paths = {n: f"{root}/{n}" for n in names}
    else:
        paths = write_ad_tables(spark, "/root/testdata/sf0.01", tempfile.mkdtemp(prefix="plan-report-"))
    t = jobs.AdTables.of({k: spark.read.parquet(v) for k, v in paths.items()})
    hour = Interval(datetime(2024, 1, 15, 5), datetime(2024, 1, 15, 6))
    mid = jobs.intermediates(t, hour, False)
    cases = {
        "auction_stats (1h)": auc.auction_stats(t.auctions, t.impressions, t.bids, hour),
        "auction_stats_hourly (whole)": auc.auction_stats_hourly(t.auctions, t.impressions, t.bids),
        "imp_matched_actions (1h, 30d)": attr.imp_matched_actions(t.impressions, t.actions, t.auctions, hour, 30),
        "hourly_cpm (1h)": ru.imps_clicks(ru.joined_impressions(t.auctions, t.impressions, mid.auction_stats,
                                                                t.clicks, hour), ru.HOURLY),
        "hourly_actions (1h)": jobs.grain_frames(t, mid, ru.HOURLY, hour, False)["convs"],
        "geo_defaults (1h)": ru.defaults(t.auctions, t.auction_defaults, ru.GEO, hour),
    }
    for name, df in cases.items():
        s = shape(df)
        print(f"{name}: {s['exchanges']} exchanges, {len(s['scans'])} scans")
        for cols, part in s["scans"]:
            cols = re.sub(r"#\d+", "", cols)
            part = re.sub(r"#\d+", "", part)
            print(f"    read [{cols}]  partition filter [{part or '-'}]")


if __name__ == "__main__":
    main(sys.argv)
