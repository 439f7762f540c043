"""Time the stages of one full preparation run and single operators; prints one JSON line.

Stages are stored tables, each timed alone. Operators that start from a stage find it stored, so
their time is their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelcast.plans import model_queries as m  # noqa: E402
from panelcast.plans import queries as q  # noqa: E402
from panelcast.runtime import local_session  # noqa: E402

STAGES = ("occasions", "plays", "play_stats", "jam_stats", "frame", "recent", "dated", "features")
OPERATORS = (
    "lag_gap", "global_lag", "scope_history", "runs_global", "unified_period", "keep_first", "asof_release",
    "panel_theta", "last_before", "expanding_stats", "expanding_median", "prev_period_counts",
    "prev_period_rates", "trailing_year", "topk_flag", "lookup_chain", "oversample",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.range(1).count()
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.time()
        run()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)

    build = q.build(spark, sf_dir)
    for stage in STAGES:
        timed(f"stage_{stage}", lambda: getattr(build, stage))
    timed("stage_analytical", lambda: m.stored_sets(spark, sf_dir))
    for name in OPERATORS:
        timed(name, lambda: q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "total seconds of all stages and operators",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
