"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_ROUNDS   boosting rounds of the timed fit (default 100, the full preset)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farekit import build_session  # noqa: E402
from farekit.catalog import QUERIES, inputs  # noqa: E402
from farekit.operators import encode  # noqa: E402
from farekit.plans import multiplier, training  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "100"))

HEADLINE = (
    "s01_typed_scan",
    "p02_derive",
    "p08_subset",
    "j01_baseline_join",
    "j04_distance_lookup",
    "j06_calendar_lookup",
    "a02_stats_by_lead_time",
    "a03_stats_by_two_keys",
    "a04_ratio_stats",
    "a09_count_distinct",
    "a11_exact_median",
    "a12_airline_shares",
    "a17_summary",
    "o04_top_routes",
    "o05_top_days",
    "f16_price_composition",
    "f20_route_popularity",
    "m01_index_table",
    "m02_one_hot",
    "m04_scale",
    "m11_regression_metrics",
    "v08_rejected",
    "v10_request_features",
    "st2_stream_rejects",
)


def run(df) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "farekit-bench",
        f"local[{CPUS}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        result = action()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    QUERIES["a01_global_count"](spark, SF_DIR).collect()  # starts the session's workers
    for name in HEADLINE:
        timed(name, lambda name=name: run(QUERIES[name](spark, SF_DIR)))

    features = inputs.training_features(spark, SF_DIR)
    tables = timed("training_tables", lambda: training.training_tables(features, "fare_key"))
    model = timed(f"fit_gbt_{ROUNDS}_rounds", lambda: training.fit_fare_model(tables.train, "gbt", maxIter=ROUNDS))
    scored = model.transform(tables.held_out)
    quality = timed(
        "evaluate_gbt", lambda: encode.regression_metrics(scored, training.LABEL, training.PREDICTION).first()
    )
    ratios = inputs.ratios(spark, SF_DIR)
    part, _, _ = timed("training_ratios", lambda: multiplier.training_ratios(ratios, "fare_key"))
    timed("fit_fm_50_steps", lambda: multiplier.notebook_pipeline().fit(part))

    print(
        json.dumps(
            {
                "metric": "headline queries and fits, total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": CPUS,
                "training_rows": tables.train.count(),
                "held_out_r2": round(quality["r2"], 6),
                "held_out_rmse": round(quality["rmse"], 3),
                "held_out_mae": round(quality["mae"], 3),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
