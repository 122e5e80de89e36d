"""Print the physical plans of the pipeline's main steps over a written warehouse.

Usage: python scripts/explain_plans.py <warehouse dir> [bronze dir]
Shows what to look for at scale: ReadSchema (column pruning), PushedFilters,
Exchange count, partial aggregates before exchanges, broadcast sides.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from ridestar.plans import checks as C
    from ridestar.plans import core, marts, quality, staging
    from ridestar.session import local_session

    wh = sys.argv[1].rstrip("/")
    spark = local_session()
    t = {n: spark.read.parquet(f"{wh}/{n}") for n in
         ("stg_rideshare_events", "dim_cabs", "dim_datetime", "dim_locations", "dim_weather", "fact_trips")}
    stg, fact = t["stg_rideshare_events"], t["fact_trips"]
    plans = {
        "dim_cabs": core.dim_cabs(stg),
        "dim_locations": core.dim_locations(stg),
        "dim_weather": core.dim_weather(stg),
        "mart_surge_analysis": marts.mart_surge_analysis(fact, t["dim_locations"], t["dim_cabs"]),
        "mart_trip_trends": marts.mart_trip_trends(fact, t["dim_datetime"], t["dim_cabs"]),
        "dq_metrics": quality.dq_metrics(stg, fact),
        "relationships": C.check_counts(t | {C.STG: stg}, [c for c in C.DECLARED_CHECKS if c.kind == "relationships"][:1]),
    }
    if len(sys.argv) > 2:
        plans = {"staging": staging.stg_events(spark.read.parquet(sys.argv[2]))} | plans
    for name, df in plans.items():
        print(f"\n==================== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
