"""Physical-plan shape: one scan in the team view, no shuffle in Silver, pruning in Gold."""

from __future__ import annotations

import contextlib
import io
import os
import re

from samples import SEASON_2020, SEASON_2021, SEASON_2026, SMALL_SF, write_doc

from pitchflow.operators import gold
from pitchflow.plans import catalog, layers


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def test_team_view_scans_once(spark):
    plan = _plan(catalog.q_team_view(spark, SMALL_SF))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
    assert "Union" not in plan
    assert "Generate" in plan
    assert "Exchange" not in plan  # nothing is shuffled between the scan and the rows


def _tables(spark, workdir):
    land = os.path.join(workdir, "landing")
    for name, doc in (("2020.json", SEASON_2020), ("2021.json", SEASON_2021), ("2026.json", SEASON_2026)):
        write_doc(land, name, doc)
    root = os.path.join(workdir, "tables")
    layers.refresh_layers(spark, f"{land}/*.json", root, multi_line=True)
    return root


def test_silver_has_no_exchange(spark, workdir):
    from pitchflow.operators.silver import silver_matches
    from pitchflow.streaming.bronze import read_bronze

    root = _tables(spark, workdir)
    plan = _plan(silver_matches(read_bronze(spark, f"{root}/bronze/bronze_partidos")))
    assert "Exchange" not in plan


def test_gold_prunes_and_pushes_down(spark, workdir):
    root = _tables(spark, workdir)
    silver = layers.read_layer(spark, root, layers.SILVER)
    perf_plan = _plan(gold.team_performance(silver))
    # the season filter prunes Silver's partition folders; the played filter reaches the scan
    assert "PartitionFilters: [isnotnull(temporada" in perf_plan and ">= 2022" in perf_plan
    assert "PushedFilters: [IsNotNull(goles_local), IsNotNull(goles_visitante)]" in perf_plan
    # only the columns the aggregate needs are read
    read_schema = [line for line in perf_plan.splitlines() if line.startswith("ReadSchema")][0]
    assert "pases_precisos_local" not in read_schema and "posesion_local" in read_schema
    st_plan = _plan(gold.standings(silver))
    exchanges = re.findall(r"^\(\d+\) Exchange", st_plan, re.M)
    assert len(exchanges) == 2  # group keys, then season for the rank
    assert "partial_sum" in st_plan  # map-side partial aggregate before the shuffle
