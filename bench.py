"""Times the headline queries; prints one JSON line.

Layouts and dimensions are written before the clock starts, as they are tables in a warehouse. The
clock covers a query from the Python calls that put it together, with any job they start, to its last row.
Every query runs once to warm up and then five times; the median counts. Files, partitions and rows read by the mart queries are reported beside the
times, because work read is what carries over to large data.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from slicemill.operators.history import join_valid_at, overlapping_versions  # noqa: E402
from slicemill.operators.marts import team_day  # noqa: E402
from slicemill.plans import all_queries  # noqa: E402
from slicemill.plans.history_queries import dimension  # noqa: E402
from slicemill.plans.standins import FIRST_YEAR, LAST_YEAR, LOWEST, NARROW, WIDE, fact, orders  # noqa: E402
from slicemill.session import build_session, work_path  # noqa: E402
from slicemill.sinks import datasets  # noqa: E402

REPEATS = int(os.environ.get("BENCH_REPEATS", "5"))
OPERATORS = ["team_day_narrow", "team_day_wide", "type_slice_average", "hour_profile", "hour_profile_by_group",
             "join_conservation", "top_price", "latest_version", "scd1_names", "scd2_versions", "split_rejected_by_reason", "unique_violations", "contract_metrics", "rules_report",
             "content_checksum", "except_all_counts", "sym_diff", "compare_by_key", "goals_not_exceed", "day_totals",
             "raw_batches_applied", "elt_mart_team_day", "publish_slice_result"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median(make) -> float:
    run(make())
    times = []
    for _ in range(REPEATS):
        started = time.perf_counter()
        run(make())
        times.append(time.perf_counter() - started)
    return round(statistics.median(times), 4)


def layouts(spark, sf_dir):
    """The fact as plain, yearly partitioned and clustered Parquet, with the slice predicate of each."""
    f = fact(spark, sf_dir)
    paths = {n: work_path(spark, f"bench-{n}") for n in ("plain", "by_year", "clustered")}
    f.write.parquet(paths["plain"])
    datasets.write_by_year(f, paths["by_year"], "match_date", LOWEST, FIRST_YEAR, LAST_YEAR)
    datasets.write_clustered(f, paths["clustered"], ["source_system", "match_date", "team_id"])

    def mart(name, slice_):
        rows = spark.read.parquet(paths[name])
        if name == "by_year":
            rows = rows.where(datasets.slice_partitions(*slice_, FIRST_YEAR))
        return team_day(rows, "main", *slice_)

    return {f"mart_{size}_{name}": (lambda n=name, s=slice_: mart(n, s))
            for size, slice_ in (("narrow", NARROW), ("wide", WIDE)) for name in paths}


def validity(spark, sf_dir):
    """The validity join and the overlap search against a stored dimension."""
    dim = dimension(spark, sf_dir, F.col("o_orderpriority"))
    o = orders(spark, sf_dir)
    return {"asof_join": lambda: join_valid_at(o, dim, ["o_custkey"], "day", ["attr"]),
            "overlapping_versions": lambda: overlapping_versions(dim, ["o_custkey"], "attr")}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g")})
    spark.sparkContext.setLogLevel("ERROR")
    todo = layouts(spark, sf_dir)
    work = {name: datasets.scan_work(make()) for name, make in todo.items()}
    todo |= validity(spark, sf_dir)
    todo |= {name: (lambda q=all_queries.QUERIES[name]: q(spark, sf_dir)) for name in OPERATORS}
    times = {name: median(make) for name, make in todo.items()}
    print(json.dumps({"metric": "sum of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "work": work, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "cpus": cpus, "repeats": REPEATS}))
    spark.stop()


if __name__ == "__main__":
    main()
