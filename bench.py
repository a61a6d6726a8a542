"""Benchmark of the headline queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line. Each query runs to completion through the no-op
sink (the whole plan executes, nothing is collected); each is run three times and
the faster run is reported, to damp scheduling noise on a shared host. Resampling runs at the
reference's sizes: 2,000 replicates and 10,000 A/A iterations, with the A/A
sample scaled from 500 of about 4,300 users to the fixture's group size.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pulsekit import params as P  # noqa: E402
from pulsekit.operators import audience, etl, experiment as X, resampling as RS  # noqa: E402
from pulsekit.operators.hypothesis import mann_whitney_u, welch_ttest  # noqa: E402
from pulsekit.plans import reports  # noqa: E402
from pulsekit.session import build_session  # noqa: E402
from pulsekit.sources import load_fixture_logs  # noqa: E402
from pulsekit.streaming.live import run_live_feed_metrics  # noqa: E402

REFERENCE_REPLICATES = 2000
REFERENCE_AA_ITERATIONS = 10000
REFERENCE_AA_SHARE = 500 / 4300


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus), app_name="pulsekit-bench",
                          extra={"spark.driver.memory": "16g"})
    lg = load_fixture_logs(spark, sf_dir)
    feed, msgs = lg.feed, lg.messages
    # Warm-up of one-time session costs (JVM code paths, the Parquet reader, the
    # Python worker pool used by the p-value UDFs); every benchmarked query below
    # still runs in full.
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()
    from pulsekit.functions.pvalues import student_t_pvalue
    spark.range(8).select(student_t_pvalue(F.lit(1.0), F.lit(10.0), F.lit("less"))).write.format("noop") \
        .mode("overwrite").save()

    def ab_users():
        return X.user_ctr(feed, P.EXPERIMENT_START, P.EXPERIMENT_END, (P.AB_CONTROL, P.AB_TEST))

    def all_users():
        return X.user_ctr(feed, P.EXPERIMENT_START, P.EXPERIMENT_END, P.ALL_GROUPS)

    def aa():
        um = X.user_ctr(feed, P.EXPERIMENT_START, P.EXPERIMENT_END, P.AA_GROUPS)
        sizes = um.where(F.col("ctr").isNotNull()).groupBy("exp_group").count().collect()
        n = max(2, round(min(r["count"] for r in sizes) * REFERENCE_AA_SHARE))
        return RS.aa_simulation(um, *P.AA_GROUPS, REFERENCE_AA_ITERATIONS, n, P.SEED)

    plans = {
        "etl_metrics_mart": lambda: etl.metrics_mart(feed, msgs, P.AS_OF),
        "dau_segments": lambda: audience.dau_segments(feed, msgs, P.AS_OF),
        "retention_cohorts": lambda: audience.retention_cohorts(feed, msgs, P.AS_OF),
        "app_report_latest": lambda: reports.app_report_latest(feed, msgs, P.AS_OF),
        "welch_ctr": lambda: welch_ttest(all_users(), "exp_group", "ctr", [(1, 2), (2, 3), (0, 3)]),
        "mwu_ctr": lambda: mann_whitney_u(all_users(), "exp_group", "ctr", [(2, 1), (2, 3)]),
        "bootstrap_means": lambda: RS.bootstrap_means(ab_users(), "exp_group", "ctr", REFERENCE_REPLICATES, P.SEED),
        "poisson_bootstrap_ctr": lambda: RS.poisson_bootstrap_ctr(ab_users(), REFERENCE_REPLICATES, P.SEED),
        "aa_simulation": aa,
    }
    def live():
        return run_live_feed_metrics(spark, sf_dir, glob="events.parquet")  # runs the stream, then reads its sink

    plans["live_feed_metrics"] = live
    times: dict[str, float] = {}
    for name, build in plans.items():
        runs = []
        for _ in range(3):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(min(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
