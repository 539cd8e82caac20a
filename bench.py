"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from chronomark.registry import QUERIES

HEADLINE = ["agg_density_core", "agg_cooccurrence", "win_local_max", "win_level_shift", "win_islands_dead", "win_gaps_islands_shot", "bkt_5s_engagement", "join_band_le1", "join_band_lt1_first", "join_interval_overlap", "agg_speech_core", "agg_ngram_repeat", "txt_cta_keywords", "topk_cosine", "rpt_density", "rpt_pacing", "rpt_speech", "rpt_emotion", "rpt_overlay", "rpt_framing", "rpt_metadata", "rpt_markers"]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in HEADLINE if n in QUERIES]
    run = lambda n: QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run(names[0])  # the JVM's start and first compilation count for no query
    took = {}
    for n in names:
        t = time.perf_counter()
        run(n)
        took[n] = round(time.perf_counter() - t, 3)
    reports = [n for n in names if n.startswith("rpt_")]
    documents = sum(QUERIES[n](spark, sf_dir).count() for n in reports)  # an item of events, speech, boxes or captions each
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "reports": documents, "reports_per_sec": round(documents / sum(took[n] for n in reports), 1)}), flush=True)


if __name__ == "__main__":
    main()
