"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
#: The shuffle- and compute-bound queries, and one of each family.
NAMES = ["q06_score_candidates", "q08_rank_topn", "q09_dedup_provenance", "q12_change_points", "q14_signal_smooth", "q16_bridged_blobs", "q20_spike_detect", "q24_framing_knn", "q26_neardup_pairs", "q28_gate_funnel", "q31_tiers", "q34_iou_match", "q38_ratios_taxonomy", "q43_order_stats", "q44_delivery_manifest", "q47_asof", "q48_windows", "q58_run_summary", "q62_veto_volume", "q67_five_samples", "q69_delivery_items"]


def main() -> None:
    from pyspark.sql import SparkSession

    from tamarack.catalog import QUERIES

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["q22_accept_shot"](spark, SF).collect()  # starts the JVM's own work
    times = {}
    for name in NAMES:
        began = time.perf_counter()
        QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": SF.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
