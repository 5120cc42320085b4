from __future__ import annotations

from pitchflow import spec
from pitchflow.operators import quality


def test_load_rules_accepts_both_forms():
    as_dicts = [{"name": n, "constraint": c} for n, c in spec.SILVER_RULES]
    assert quality.load_rules(as_dicts) == dict(spec.SILVER_RULES)
    assert quality.load_rules(spec.STANDINGS_RULES) == dict(spec.STANDINGS_RULES)


def test_rule_report_counts_true_false_null(spark, ansi):
    df = spark.createDataFrame(
        [("2 - 1", 2, 1, 45), ("Sin jugar", None, None, None), ("2 - 1 (4-3)", 2, None, 120), (None, -1, 0, 50)],
        "marcador string, goles_local int, goles_visitante int, posesion_local int",
    )
    rules = [r for r in spec.SILVER_RULES if r[0] in ("marcador valido", "goles no negativos", "posesion valida")]
    got = {r.rule: (r.passed, r.failed, r.unknown) for r in quality.rule_report(df, rules).collect()}
    assert got == {
        "marcador valido": (1, 3, 0),  # NULL score: "IS NOT NULL AND ..." is FALSE, not unknown
        "goles no negativos": (1, 1, 2),
        "posesion valida": (3, 1, 0),
    }
    assert df.count() == 4  # reporting never drops rows


def test_observed_counts_equal_report(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "puntos int")
    rules = [("puntos no negativos", "puntos >= 0")]
    observed, obs = quality.observe_rules(df, rules, "dq_test")
    observed.write.format("noop").mode("overwrite").save()
    assert quality.observation_report(obs, rules) == [
        {"rule": "puntos no negativos", "passed": 2, "failed": 0, "unknown": 1}
    ]
