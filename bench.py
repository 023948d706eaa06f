"""Time the headline jobs and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. Each job is run
once to warm up on the smallest tables, then timed from building the query to the
last row written to a sink that discards it.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

JOBS = (
    "clean_pages",
    "clean_funnel",
    "prepare_dataset",
    "clean_strict",
    "dataset_profile",
    "stratified_split",
    "label_conflict_stress",
    "vocabulary",
    "tfidf",
    "linear_score",
    "classification_report",
    "lr_fit_score",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from broadsheet import build_session

    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    from pyspark.sql import functions as F

    from broadsheet.operators.model import fit_model
    from broadsheet.registry import QUERIES
    from broadsheet.registry.base import resolved_pages, table
    from broadsheet.session import materialise

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    seconds, rows = {}, {}
    for name in JOBS:
        if os.path.isdir(small) and name != "lr_fit_score":
            drain(QUERIES[name].build(spark, small))
        begin = time.perf_counter()
        drain(QUERIES[name].build(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - begin, 3)

    # inference over headline-sized texts: every line of every document
    pages = resolved_pages(spark, sf_dir).filter(F.col("label").isNotNull())
    model = fit_model(pages.select("ord", F.col("headline").alias("text"), "label"), "ord", "text")
    lines = materialise(
        table(spark, sf_dir, "documents")
        .select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
        .select(F.concat_ws("-", "doc_id", "line").alias("id"), "text"),
        "lines",
    )
    n = lines.count()
    drain(model.score(lines, "id", "text"))
    begin = time.perf_counter()
    drain(model.score(lines, "id", "text"))
    seconds["predict_lines"] = round(time.perf_counter() - begin, 3)

    counts = {t: table(spark, sf_dir, t).count() for t in ("pages", "documents")}
    for name, source in (("clean_pages", "pages"), ("tfidf", "documents"), ("linear_score", "documents")):
        rows[name] = round(counts[source] / seconds[name])
    rows["predict_lines"] = round(n / seconds["predict_lines"])
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows_per_second": rows,
                "predict_lines_rows": n,
                "predict_ms_per_row": round(seconds["predict_lines"] / n * 1000, 5),
            }
        )
    )


if __name__ == "__main__":
    main()
