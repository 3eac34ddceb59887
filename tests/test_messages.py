import json

import pytest

from tidemark.operators import messages

GOOD = {
    "run_id": "nightly-00417",
    "from": "platform",
    "to": "bi_viz",
    "intent": "science",
    "status": "ok",
    "artifacts": ["s3://lake/x"],
    "contracts": {"rows_in": 1},
    "preconditions_met": [],
    "metrics": {"nested": {"a": [1]}},
    "next_agent": "ninguno",
    "ts": "2031-11-05T23:59:01Z",
}


def errors(spark, message):
    text = message if isinstance(message, str) or message is None else json.dumps(message)
    df = spark.createDataFrame([(text,)], "message string")
    r = messages.validate_handoffs(df).first()
    assert r.valid == (r.errors == [])
    return r.errors


def test_valid(spark):
    assert errors(spark, GOOD) == []
    assert errors(spark, GOOD | {"ts": "2031-11-05T23:59:01.25+01:00"}) == []


@pytest.mark.parametrize("key", messages.REQUIRED)
def test_missing_keys(spark, key):
    assert errors(spark, {k: v for k, v in GOOD.items() if k != key}) == [f"missing:{key}"]


@pytest.mark.parametrize(
    "change, want",
    [
        ({"run_id": "short"}, ["short:run_id"]),
        ({"run_id": 123456789}, ["short:run_id"]),
        ({"from": "stranger"}, ["enum:from"]),
        ({"to": "ninguno"}, ["enum:to"]),
        ({"status": None}, ["enum:status"]),
        ({"artifacts": "s3://lake"}, ["type:artifacts"]),
        ({"artifacts": '["s3://lake"]'}, ["type:artifacts"]),
        ({"artifacts": ["a", ""]}, ["empty:artifacts"]),
        ({"artifacts": [1]}, ["type:artifacts"]),
        ({"contracts": []}, ["type:contracts"]),
        ({"metrics": "{}"}, ["type:metrics"]),
        ({"ts": "2026-02-14"}, ["format:ts"]),
        ({"ts": "2026-02-30T00:00:00Z"}, ["format:ts"]),
        ({"note": 1}, ["extra"]),
    ],
)
def test_broken_rules(spark, change, want):
    assert errors(spark, GOOD | change) == want


@pytest.mark.parametrize("text", ["not json", "[1]", '"x"', None, ""])
def test_not_an_object(spark, text):
    assert errors(spark, text) == ["not_an_object"]


def test_run_results(spark, tmp_path):
    path = tmp_path / "run_results.json"
    path.write_text(json.dumps({"results": [{"status": s} for s in ("pass", "fail", "Error", "success", None)]}, indent=1))
    r = messages.run_results_summary(spark.read.option("multiLine", True).json(str(path))).first()
    assert (r.tests_total, r.tests_failed) == (5, 2)


def test_routing_metrics(spark):
    log = [("science", "ds_mlops", "ok", 0, float(i)) for i in range(19)] + [("science", "platform", "fallido", 4, 100.0), ("else", "x", "ok", 1, 2.0)]
    df = spark.createDataFrame(log, "intent string, agent string, status string, retries int, duration_s double")
    got = {r.intent: r for r in messages.routing_metrics(df).collect()}
    assert (got["science"].decisions, got["science"].success_rate, got["science"].mean_retries) == (20, 0.95, 0.2)
    assert got["science"].drifting and not got["else"].drifting
    assert got["science"].p95_duration_s == pytest.approx(18 + 0.05 * 82)
    assert got["else"].p95_duration_s == 2.0
