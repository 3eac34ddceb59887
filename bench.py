"""Times headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores. Each query is
run whole into the `noop` sink; the best of two runs counts, after one warm-up query for the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.registry import REGISTRY  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = (
    "stg_orders",
    "stg_customers",
    "order_lines",
    "int_orders_enriched",
    "dim_customer",
    "dim_product",
    "dim_seller",
    "fct_orders",
    "fct_payments",
    "customer_features",
    "fct_orders_customer_sk",
    "dedup_latest",
    "merge_delete_insert",
    "left_any_join",
    "kpi_daily",
    "kpi_month_category",
    "kpi_seller",
    "avg_ticket_channel",
    "unique_combination",
    "unique_violations",
    "schema_match",
    "features_point_in_time",
    "fct_orders_incremental",
    "null_profile",
    "quality_gate",
    "anomaly_volume",
    "reconcile_revenue",
    "psi_features",
    "model_metrics",
    "bias_metrics",
    "scoring_summary",
    "stratified_split",
    "content_checksum",
    "bronze_roundtrip",
    "bronze_stream_upsert",
    "seed_orders",
    "validate_handoffs",
    "chunk_documents",
    "chunk_upsert",
    "vector_topk",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(key: str) -> float:
        start = time.perf_counter()
        REGISTRY[key].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("gold_totals")
    scale = Path(sf_dir).name.removeprefix("sf")
    seconds = {key: round(min(run(key) for _ in range(2)), 3) for key in keys}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
