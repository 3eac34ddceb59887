import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.operators import drift, evaluation, fairness

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def psi_by_hand(ref, cur, bins=10):
    """The index straight from its definition."""
    ref, cur = (np.array([x for x in a if x is not None], dtype=float) for a in (ref, cur))
    if not len(ref) or not len(cur):
        return math.nan
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)))
    if len(edges) < 2:
        return 0.0
    inner = edges[1:-1]
    total = 0.0
    for b in range(len(inner) + 1):
        r = max(float(np.mean(np.searchsorted(inner, ref, side="right") == b)), 1e-6)
        a = max(float(np.mean(np.searchsorted(inner, cur, side="right") == b)), 1e-6)
        total += (a - r) * math.log(a / r)
    return total


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


RNG = np.random.default_rng(3)


@pytest.mark.parametrize(
    "ref, cur",
    [
        (list(range(100)), list(range(100))),
        ([5] * 20, [1, 2, 3]),
        ([1, 2, 3], []),
        ([], [1.0]),
        ([1, None, 2, 3], [None, 3, 3]),
        (list(RNG.normal(size=400)), list(RNG.normal(0.5, 1.2, size=300))),
        (list(RNG.integers(0, 4, 200)), list(RNG.integers(1, 6, 90))),
        ([0] * 90 + [1] * 10, [0] * 10 + [1] * 90),
    ],
)
def test_psi(spark, ref, cur):
    r = drift.psi_report(frame(spark, ref), frame(spark, cur), ["x"]).first()
    want = psi_by_hand(ref, cur)
    assert (math.isnan(r.psi) and math.isnan(want)) or r.psi == pytest.approx(want, abs=1e-9)
    state = "sin_datos" if math.isnan(want) else "estable" if want < 0.1 else "vigilar" if want <= 0.2 else "congelar"
    assert r.state == state
    assert (r.n_reference, r.n_current) == (sum(v is not None for v in ref), sum(v is not None for v in cur))


def groups(spark, table):
    pairs = [(g, p) for g, (n, pos) in table.items() for p in [1] * pos + [0] * (n - pos)]
    scoring = spark.createDataFrame(pairs, "gender string, churn_pred int")
    return fairness.bias_groups(scoring, ["gender"])


def test_null_group_and_rates(spark, rows):
    assert rows(groups(spark, {"f": (4, 1), None: (2, 2)})) == [
        ("gender", "(sin dato)", 2, 2, 1.0),
        ("gender", "f", 4, 1, 0.25),
    ]


@pytest.mark.parametrize(
    "table, gap, ratio, severities",
    [
        ({"f": (4, 0), "m": (4, 0)}, 0.0, 1.0, ("baja", "baja")),
        ({"f": (4, 0), "m": (4, 2)}, 0.5, 0.0, ("alta", "alta")),
        ({"f": (100, 50), "m": (100, 43)}, 0.07, 0.86, ("media", "baja")),
        ({"f": (100, 40), "m": (100, 31)}, 0.09, 0.775, ("media", "media")),
    ],
)
def test_bias_metrics(spark, table, gap, ratio, severities):
    found = {r.metric: r for r in fairness.bias_metrics(groups(spark, table)).collect()}
    assert found["demographic_parity"].value == pytest.approx(gap, abs=1e-9)
    assert found["disparate_impact"].value == pytest.approx(ratio, abs=1e-9)
    assert (found["demographic_parity"].severity, found["disparate_impact"].severity) == severities


def test_ties_go_to_the_first_name(spark):
    r = fairness.bias_metrics(groups(spark, {"m": (2, 1), "f": (2, 1), "x": (2, 1)})).first()
    assert (r.lowest_group, r.highest_group) == ("f", "f")


def test_prediction_falls_back_to_the_score(spark, rows):
    scoring = spark.createDataFrame([("f", 0.5), ("f", 0.49), ("m", None)], "gender string, churn_score double")
    assert rows(fairness.bias_groups(scoring, ["gender"]), "group", "n", "positives") == [("f", 2, 1), ("m", 1, 0)]
    with pytest.raises(ValueError):
        fairness.bias_groups(scoring.drop("churn_score"), ["gender"])


def metrics_by_hand(pairs):
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for cut in sorted({s for _, s in pairs}, reverse=True):
        seen = [y for y, s in pairs if s >= cut]
        ap += sum(y for y, s in pairs if s == cut) / len(pos) * (sum(seen) / len(seen))
    return auc, ap, sum((s - y) ** 2 for y, s in pairs) / len(pairs)


SCORES = st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0])), min_size=2, max_size=25)


@FEW
@given(pairs=SCORES.filter(lambda p: len({y for y, _ in p}) == 2))
def test_model_metrics_with_ties(spark, pairs):
    df = spark.createDataFrame([("v", y, s) for y, s in pairs], "g string, churn_label int, churn_score double")
    r = evaluation.model_metrics(df, "g").first()
    assert (r.roc_auc, r.pr_auc, r.brier) == pytest.approx(metrics_by_hand(pairs), abs=1e-9)


def test_metrics_of_one_class_are_null(spark):
    df = spark.createDataFrame([("v", 0, 0.3)], "g string, churn_label int, churn_score double")
    r = evaluation.model_metrics(df, "g").first()
    assert (r.roc_auc, r.pr_auc) == (None, None)


def versions(spark, table):
    return spark.createDataFrame(table, "version int, run_id string, roc_auc double, stage string")


def test_promotion_gate(spark):
    old = (1, "r1", 0.8, "Production")
    r = evaluation.promotion_gate(versions(spark, [old, (2, "r2", 0.72, "Staging")])).first()
    assert (r.candidate_version, r.promoted, r.production_version) == (2, 1, 2)
    r = evaluation.promotion_gate(versions(spark, [old, (2, "r2", 0.71, "Staging")])).first()
    assert (r.promoted, r.production_version) == (0, 1)
    r = evaluation.promotion_gate(versions(spark, [old, (2, "r2", 0.9, "Staging")]), run_id="r1").first()
    assert (r.promoted, r.production_version) == (0, 1)
    r = evaluation.promotion_gate(versions(spark, [(1, "r1", None, "Staging")])).first()
    assert (r.promoted, r.production_version) == (0, None)


@pytest.mark.parametrize("failed, psi, status", [(0, 0.2, "aprobado"), (0, 0.21, "rechazado"), (1, 0.0, "rechazado"), (0, None, "aprobado")])
def test_model_gate(spark, failed, psi, status):
    tests = spark.createDataFrame([(5, failed)], "tests_total bigint, tests_failed bigint")
    report = spark.createDataFrame([(psi,), (float("nan"),)], "psi double")
    assert evaluation.model_gate(tests, report).first().status == status


def test_scoring_summary(spark):
    values = [i / 20 for i in range(20)]
    df = spark.createDataFrame([(v, int(v >= 0.5)) for v in values], "churn_score double, churn_pred int")
    r = evaluation.scoring_summary(df).first()
    assert (r["rows"], r.positives) == (20, 10)
    assert r.mean_score == pytest.approx(np.mean(values))
    assert r.p95_score == pytest.approx(np.quantile(values, 0.95))


def test_class_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,), (None,)], "churn_label int")
    assert tuple(evaluation.class_weight(df).first()) == (2, 0, 2.0)
