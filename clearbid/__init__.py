"""clearbid: ad-exchange analytics as plain Spark DataFrame operators.

Every public operator is a function ``DataFrame(s) -> DataFrame`` built from
built-in Spark SQL expressions, joins, aggregations and windows, so Catalyst
plans it and whole-stage codegen runs it.  Layout:

* ``sources``    table readers (time-range, widened, lookback scans), sinks
                 (partition overwrite, keyed upsert, copy-once) and the test
                 fixture derivation of ad tables from the driver data.
* ``functions``  scalar column helpers (timestamp literals, hour/day floors,
                 keyword split, geo region label, typed decode).
* ``operators``  auction clearing, last-touch attribution, rollups by grain,
                 daily rollup/upsert, newest-N and keep-N-per-key.
* ``plans``      multi-operator jobs: the hourly run, hourly/daily backfill,
                 table migration and environment sync.
"""

from clearbid.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
