"""Wall time of the headline queries; prints one JSON line.

Each query is built and run in full (its rows are counted out by a no-op sink)
once to warm up and then BENCH_RUNS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from waymark.functions.geometry import envelope, overlaps  # noqa: E402
from waymark.plans.catalog import QUERIES  # noqa: E402
from waymark.plans.filters import BOX  # noqa: E402
from waymark.sources.derived import derived_tables  # noqa: E402
from waymark.sources.store import read_features, stored_tag, write_features  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
HEADLINE = ["q_count", "q_scan_features", "q_tag_eq", "q_bbox", "q_combined_filter", "q_members",
            "q_unnest_members", "q_parents", "q_area", "q_top_parks", "q_multipolygon"]


def session() -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-checkpoint-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(build) -> float:
    def once() -> float:
        start = time.perf_counter()
        result: DataFrame = build()
        result.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return round(statistics.median(once() for _ in range(RUNS)), 3)


def stored_queries(spark: SparkSession) -> dict:
    """The same filters over features written once in the store layout (writing not timed)."""
    path = tempfile.mkdtemp(prefix="bench-store-") + "/features"
    write_features(derived_tables(spark, SF_DIR), path)
    box = envelope(*BOX)

    def where(predicate):
        def run():
            stored = read_features(spark, path)
            return stored.where(predicate(stored)).select("fid", "type")
        return run

    return {
        "stored_scan": lambda: read_features(spark, path),
        "stored_count": lambda: read_features(spark, path).agg(F.count("*")),
        "stored_tag_eq": where(lambda s: stored_tag(s, "highway") == "primary"),
        "stored_bbox": where(lambda s: overlaps(box)),
        "stored_combined_filter": where(lambda s: (s.type == 1) & overlaps(box)
                                        & (stored_tag(s, "building") == "yes")),
    }


def main() -> None:
    spark = session()
    timed = {name: seconds(lambda q=QUERIES[name]: q(spark, SF_DIR)) for name in HEADLINE}
    stored = {name: seconds(build) for name, build in stored_queries(spark).items()}
    features = QUERIES["q_count"](spark, SF_DIR).first()[0]
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": {**timed, **stored}, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "features": features,
        "scan_features_per_sec": round(features / timed["q_scan_features"]),
        "stored_scan_features_per_sec": round(features / stored["stored_scan"]),
        "cpus": int(CPUS), "spark": pyspark.__version__,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
