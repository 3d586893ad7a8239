"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

QUERIES = ["page_profile", "attribute_lists", "scalar_text", "page_split", "greedy_batches", "first_and_last_wins", "dangling_refs", "positional_alignment", "violations", "top_lines", "cache_probe", "vocabulary_semi_join", "html_blocks", "already_english_all_words", "fragments_put_back", "compared_chapters"]


def main() -> None:
    from pyspark.sql import SparkSession

    from folia.plans import registry

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known, took = registry.queries(), {}
    for name in QUERIES:
        began = time.time()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()
