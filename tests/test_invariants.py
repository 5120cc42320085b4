"""Invariants over the synthetic matches derived from ``orders``."""

from __future__ import annotations

from samples import SMALL_SF
from pyspark.sql import functions as F

from pitchflow import spec
from pitchflow.operators import gold, quality
from pitchflow.plans import catalog


def test_team_rows_are_twice_played(spark):
    silver = catalog._silver(spark, SMALL_SF)
    played = gold.played(silver).count()
    assert gold.team_view(gold.played(silver)).count() == 2 * played


def test_goals_for_equal_goals_against_per_season(spark):
    st = catalog._standings(spark, SMALL_SF)
    rows = st.groupBy("temporada").agg(F.sum("goles_favor").alias("f"), F.sum("goles_contra").alias("c")).collect()
    assert rows and all(r.f == r.c for r in rows)


def test_standings_record_adds_up_and_rules_hold(spark):
    st = catalog._standings(spark, SMALL_SF)
    report = quality.rule_report(st, spec.STANDINGS_RULES).collect()
    assert all(r.failed == 0 and r.unknown == 0 for r in report)
    perf = catalog._performance(spark, SMALL_SF)
    report = quality.rule_report(perf, spec.PERFORMANCE_RULES).collect()
    assert all(r.failed == 0 and r.unknown == 0 for r in report)


def test_score_rule_failures_are_unplayed_matches(spark):
    orders = spark.read.parquet(f"{SMALL_SF}/orders.parquet")
    k = F.col("o_orderkey")
    unplayed = orders.filter((k % 23 == 0) | (k % 29 == 0) | (k % 31 == 0)).count()
    report = {r.rule: r for r in quality.rule_report(catalog._silver(spark, SMALL_SF), spec.SILVER_RULES).collect()}
    assert report["marcador valido"].failed == unplayed
    assert report["goles no negativos"].unknown >= unplayed - report["goles no negativos"].failed
    assert report["equipo_local no nulo"].passed == orders.count()


def test_possession_range(spark):
    silver = catalog._silver(spark, SMALL_SF)
    row = silver.agg(F.min("posesion_local").alias("lo"), F.max("posesion_local").alias("hi")).first()
    assert 35 <= row.lo <= row.hi <= 64
