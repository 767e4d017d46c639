"""Times the headline queries; prints one JSON line.

The raw tables are first derived from the generated ones and written as partitioned Parquet, untimed, so
that a report's time is that of the report on stored tables. Every query runs to completion without
collecting; its time is the best of the repeats (whole runs go once, last). ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_REPEATS``
set the input, the cores and the number of repeats.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from catalogue import fixture
from catalogue.queries import QUERIES
from tallyframe.plans.reports import REPORTS, build_report
from tallyframe.plans.run import staged_families
from tallyframe.session import builder
from tallyframe.sources.bronze import bronze_from_parquet, write_bronze_parquet
from tallyframe.sources.schemas import PARTITIONED
from tallyframe.sources.staging import Stage

TABLE_QUERIES = (
    "status_counts_by_segment",
    "distinct_and_guarded_average",
    "wide_quantity_distribution",
    "cumulative_quantity",
    "spec_report",
    "decode_every_code",
    "decode_join_lookup",
    "insert_if_absent",
    "last_n_periods",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = builder("bench", f"local[{cpus}]").config("spark.driver.memory", "8g").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="bench-")

    derived = fixture.bronze(spark, sf_dir)
    # several files per year, as tables of some size have
    spread = derived.map(lambda name, df: df.repartition(int(cpus)) if name in PARTITIONED else df)
    write_bronze_parquet(spread, f"{work}/bronze")
    bronze = bronze_from_parquet(spark, f"{work}/bronze")

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def shared() -> None:
        wide = staged_families(spark, bronze, stage=Stage(spark, work))
        for report in REPORTS.values():
            run(report.project(wide[report.family]))

    def separate() -> None:
        for name in REPORTS:
            run(build_report(name, bronze))

    jobs = {f"report_{name}": lambda n=name: run(build_report(n, bronze)) for name in REPORTS}
    jobs["report_national_pupil_year"] = lambda: run(build_report("national_pupil", bronze, periods="202324"))
    jobs |= {name: lambda q=QUERIES[name]: run(q(spark, sf_dir)) for name in TABLE_QUERIES}
    jobs["all_reports_shared"] = shared
    jobs["all_reports_separate"] = separate

    seconds = {}
    for name, job in jobs.items():
        times = []
        for _ in range(1 if name.startswith("all_reports") else repeats):
            start = time.perf_counter()
            job()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
