"""Batch checks over JSON log columns: handoff messages, test-run results, routing logs."""

from __future__ import annotations

import json
from importlib.resources import files
from typing import Any

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.json_schema import validate
from tidemark.operators.ranking import exact_quantiles

HANDOFF: dict[str, Any] = json.loads((files("tidemark") / "data" / "handoff.schema.json").read_text())
REQUIRED = tuple(HANDOFF["required"])
AGENTS, INTENTS, STATUSES, NEXT_AGENTS = (tuple(HANDOFF["properties"][k]["enum"]) for k in ("from", "intent", "status", "next_agent"))


def validate_handoffs(messages: DataFrame, column: str = "message", schema: dict[str, Any] | None = None) -> DataFrame:
    """Adds `errors` and `valid` by a schema, that of the handoff contract if none is given."""
    return validate(messages, schema or HANDOFF, column)


def run_results_summary(results: DataFrame) -> DataFrame:
    """Tests run and failed over JSON result documents with a `results` array."""
    status = F.lower(F.col("r.status"))
    return results.select(F.explode("results").alias("r")).agg(
        F.count(F.lit(1)).alias("tests_total"), F.count_if(status.isin("fail", "error")).alias("tests_failed")
    )


def routing_metrics(log: DataFrame) -> DataFrame:
    """Per intent: decisions, success rate, mean retries, exact p95 duration, agents it was sent to."""
    base = log.groupBy("intent").agg(
        F.count(F.lit(1)).alias("decisions"),
        (F.count_if(F.col("status") == "ok") / F.count(F.lit(1))).alias("success_rate"),
        (F.sum("retries") / F.count(F.lit(1))).alias("mean_retries"),
    )
    # Agents come from a catalogue, so the distinct pairs are few.
    agents = log.groupBy("intent", "agent").agg(F.count(F.lit(1)).alias("n")).groupBy("intent")
    spread = agents.agg(F.count(F.lit(1)).alias("agents"))
    p95 = exact_quantiles(log, "intent", "duration_s", [0.95]).select(
        "intent", F.col("quantile").alias("p95_duration_s")
    )
    return base.join(spread, "intent").join(p95, "intent", "left").withColumn("drifting", F.col("agents") > 1)
