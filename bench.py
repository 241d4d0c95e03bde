"""Times the headline queries and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (names separated by commas, default all headline ones).
"""

from __future__ import annotations

import json
import os
import sys
import time

from sluice.plans.queries import QUERIES
from sluice.session import build_session

HEADLINE = (
    "source_top_words",
    "corpus_words",
    "stem_representative",
    "stem_retranslate",
    "tfidf_weights",
    "topic_weights",
    "doc_cosine_pairs",
    "lang_top_terms",
    "topic_assign",
    "csv_folder_concat",
    "typed_workbook",
    "dead_letter_rows",
    "enrich_from_responses",
    "page_elements",
    "load_upsert",
    "load_upsert_dup_keys",
    "knn_predict",
    "knn_search_scores",
    "eval_class_report",
    "rf_predict",
    "ada_predict",
    "svc_predict",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "sluice-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
