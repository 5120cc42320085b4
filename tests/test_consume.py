"""Consumption queries on the hand-written fixture, literal expectations."""

from __future__ import annotations

import os
import tempfile
from bisect import bisect_left

import pytest
from samples import SEASON_2020, SEASON_2021, SEASON_2026, SEASON_2026_LATE, write_doc

from pitchflow.operators import consume
from pitchflow.plans import layers


@pytest.fixture(scope="module")
def gold(spark):
    work = tempfile.mkdtemp(prefix="pitchflow-consume-")
    land = os.path.join(work, "landing")
    for name, doc in (("2020.json", SEASON_2020), ("2021.json", SEASON_2021),
                      ("2026.json", SEASON_2026), ("2026-late.json", SEASON_2026_LATE)):
        write_doc(land, name, doc)
    root = os.path.join(work, "tables")
    layers.refresh_layers(spark, f"{land}/*.json", root, multi_line=True)
    return (
        layers.read_layer(spark, root, layers.SILVER),
        layers.read_layer(spark, root, layers.STANDINGS),
        layers.read_layer(spark, root, layers.PERFORMANCE),
    )


def test_season_table_orders_ties_by_name(gold):
    _, st, _ = gold
    rows = [(r.posicion, r.equipo) for r in consume.season_table(st, 2021).collect()]
    assert rows == [(1, "Alpha"), (1, "Gamma"), (3, "Beta"), (3, "Delta")]
    every = consume.season_table(st).collect()
    assert [r.temporada for r in every] == sorted(r.temporada for r in every)
    assert len(every) == st.count()


def test_all_time_points(gold):
    _, st, _ = gold
    rows = [(r.equipo, r.puntos_totales, r.diferencia_goles_total, r.temporadas)
            for r in consume.all_time_points(st, k=2).orderBy("puesto").collect()]
    assert rows == [("Alpha", 11, 4, 3), ("Gamma", 5, -1, 3)]


def test_team_evolution(gold):
    _, st, _ = gold
    alpha = {r.temporada: r for r in consume.team_evolution(st).filter("equipo = 'Alpha'").collect()}
    assert alpha[2020].puntos_anterior is None
    assert (alpha[2021].puntos_anterior, alpha[2021].variacion_puntos, alpha[2021].mejora_posicion) == (4, -1, 0)
    assert (alpha[2026].puntos, alpha[2026].variacion_puntos) == (4, 1)


def test_home_vs_away_pivot(gold):
    _, _, perf = gold
    rows = {(r.temporada, r.equipo): r for r in consume.home_vs_away(perf).collect()}
    alpha = rows[(2026, "Alpha")]
    assert (alpha.local_puntos, alpha.visitante_puntos, alpha.visitante_partidos_jugados) == (None, 4, 2)
    delta = rows[(2026, "Delta")]
    assert (delta.local_puntos, delta.local_posesion_promedio, delta.visitante_puntos) == (0, 61.0, None)


def test_possession_and_accuracy(gold):
    silver, _, perf = gold
    every = consume.possession_and_accuracy(silver)
    assert every.count() == perf.count()
    top = consume.possession_and_accuracy(silver, k=1).first()
    assert (top.puesto, top.equipo, top.rol, top.posesion_promedio) == (1, "Delta", "local", 61.0)
    assert top.precision_tiro == pytest.approx(4.0 / 15.0)


def test_away_fouls_and_fouls_and_cards(gold):
    silver, st, perf = gold
    away = consume.away_fouls(perf).orderBy("puesto").collect()
    assert [(r.puesto, r.equipo, r.faltas_promedio) for r in away][0] == (1, "Alpha", 9.0)
    cards = {(r.temporada, r.equipo): r for r in consume.fouls_and_cards(silver).collect()}
    beta = cards[(2021, "Beta")]
    assert (beta.partidos_con_estadisticas, beta.faltas_por_partido, beta.tarjetas_por_partido) == (1, 14.0, 4.0)
    # teams and seasons without any statistic are listed last, with NULL averages
    assert len(cards) == st.count()
    alpha = cards[(2020, "Alpha")]
    assert (alpha.partidos_con_estadisticas, alpha.faltas_por_partido) == (0, None)
    assert alpha.puesto == max(r.puesto for r in cards.values())


def test_shots_on_target_evolution(gold):
    _, _, perf = gold
    rows = consume.shots_on_target_evolution(perf).collect()
    assert {(r.equipo, r.rol, r.disparos_puerta_promedio) for r in rows} >= {("Delta", "local", 4.0)}
    assert all(r.disparos_puerta_anterior is None for r in rows)  # one season with statistics


def test_ranks_in_blocks_equal_one_window(spark):
    """Ties over block borders, one value in a third of the rows, NULLs last, no rows."""
    rows = [(i, None if i % 7 == 0 else 5.0 if i % 3 == 0 else float(i % 41), i % 4) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, x double, y int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = consume._ranked(df, ["x", "y"], None)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "CartesianProduct" not in plan
        got = {r.id: r.puesto for r in found.collect()}
        top = {r.id for r in consume._ranked(df, ["x", "y"], 50).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def place(row):
        return (row[1] is None, -(row[1] or 0.0), -row[2])

    keys = sorted(place(r) for r in rows)
    want = {r[0]: bisect_left(keys, place(r)) + 1 for r in rows}
    assert got == want
    assert top == {i for i, n in want.items() if n <= 50}
    assert consume._ranked(df.limit(0), ["x"], None).count() == 0
