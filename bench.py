"""Times the headline queries, at two scales and plan building apart, and prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from verification.runs import QUERIES
from wardline.session import configure

HEADLINE = [
    "denied_selects", "statement_verdicts", "decisions", "bulk_decisions", "bulk_decisions_shuffled", "audit_rows",
    "visible_tables", "show_tables_listings", "uri_access", "settings_guard", "object_order",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    builder = configure(builder).config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str = sf_dir) -> tuple[float, float]:
        """Seconds to build the plan, with the measuring jobs of that, and to run it."""
        start = time.perf_counter()
        df = QUERIES[name](spark, folder)
        built = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return built - start, time.perf_counter() - built

    # One run to warm the JVM, so that the first query does not pay for its start.
    run("statement_verdicts")
    best = {name: min((run(name) for _ in range(2)), key=sum) for name in HEADLINE}
    seconds = {name: round(sum(parts), 3) for name, parts in best.items()}
    # How times grow with the data can be read off the next smaller scale, where there is one.
    smaller = f"{sf_dir.removesuffix('0.1')}0.01"
    at_smaller = {n: round(sum(run(n, smaller)), 3) for n in HEADLINE} if sf_dir.endswith("sf0.1") and os.path.isdir(smaller) else {}
    statements = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    requests = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "build": {name: round(parts[0], 3) for name, parts in best.items()},
                "run": {name: round(parts[1], 3) for name, parts in best.items()},
                "queries_sf0.01": at_smaller,
                "statements_per_sec": round(statements / seconds["statement_verdicts"]),
                "requests_per_sec": round(requests / seconds["bulk_decisions"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
