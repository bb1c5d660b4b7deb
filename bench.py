"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from pyspark.sql import SparkSession  # noqa: E402

from readloom.plans import QUERIES  # noqa: E402

HEADLINE = ["evt_derived_columns", "pa_best_interval", "pa_dwell_spikes", "chi_subread_counts", "agg_final_report", "agg_group_stats", "trn_score_matrix", "trn_select_reads", "cal_multiscale", "aln_seed_assign", "seg_viterbi", "dmx_decide", "sig_mad_normalize", "st_live_counts", "snk_sam"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{folder}/shared")
        .config("spark.local.dir", f"{folder}/local")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):  # the first run warms up
            began = time.time()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - began)
        took[name] = round(runs[-1], 3)
    spark.stop()
    print(json.dumps({"metric": "seconds of the headline queries", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
