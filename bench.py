"""Headline timings: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from pairmill import catalog  # noqa: E402

HEADLINE = ["split_token_counts", "preparation_stats", "first_copies", "capped_replies",
            "clean_documents", "vocabulary", "encoded_pairs", "scope_gate", "corpus_bleu",
            "rouge_n", "distinct_ngrams", "genericity", "perplexity", "render_documents"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("pairmill-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "20g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    entries = catalog.load()
    # One untimed run compiles the regex and code generation paths of the JVM.
    entries["clean_documents"].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        entries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
