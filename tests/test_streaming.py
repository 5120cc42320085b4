"""Incremental ingest: exactly the new files, schema memory, batch == stream."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F
from samples import SEASON_2020, SEASON_2021, SEASON_2026, SEASON_2026_LATE, write_doc

from pitchflow import spec
from pitchflow.sources import landing as L
from pitchflow.streaming.bronze import ingest_landing, read_bronze, read_quarantine, replay_quarantine


def _rows(df):
    cols = sorted(c for c in df.columns if c != spec.LOAD_TIME_COL)
    return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect())


def test_incremental_runs(spark, workdir):
    land = os.path.join(workdir, "landing")
    files = f"{land}/*.json"
    bronze, state = os.path.join(workdir, "bronze"), os.path.join(workdir, "state")
    write_doc(land, "2020.json", SEASON_2020)
    write_doc(land, "2021.json", SEASON_2021)

    first = ingest_landing(spark, files, bronze, state, multi_line=True)
    assert first.documents == 2
    assert read_bronze(spark, bronze).count() == 6

    again = ingest_landing(spark, files, bronze, state, multi_line=True)
    assert again.documents == 0  # nothing new, nothing added
    assert read_bronze(spark, bronze).count() == 6

    write_doc(land, "2026.json", SEASON_2026)
    third = ingest_landing(spark, files, bronze, state, multi_line=True)
    assert third.documents == 1
    df = read_bronze(spark, bronze)
    assert df.count() == 8
    # English names are new columns; the rows ingested before read them as NULL
    assert "Total shots_local" in df.columns
    assert df.filter(df["`Total shots_local`"].isNotNull()).count() == 1
    assert df.filter("temporada = '2021'").filter(df["`Total shots_local`"].isNull()).count() == 2

    write_doc(land, "2026-late.json", SEASON_2026_LATE)
    ingest_landing(spark, files, bronze, state, multi_line=True)
    df = read_bronze(spark, bronze)
    assert df.count() == 9
    assert "Expected goals_local" in df.columns
    # the same stat as a number in one file and as text in another: both kept
    values = {r[0] for r in df.select("`Accurate passes_visitante`").collect()} - {None}
    assert values == {"12", "77 (58%)"}

    # batch read of all files == what the stream ingested
    batch = L.to_bronze(L.read_documents(spark, files, multi_line=True))
    assert _rows(batch.select(*[f"`{c}`" for c in df.columns if c != spec.LOAD_TIME_COL])) == _rows(df)


def test_schema_memory_merges_and_versions(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_doc(land, "2021.json", SEASON_2021)
    bronze, state = os.path.join(workdir, "bronze"), os.path.join(workdir, "state")
    s1 = ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True).schema
    data1 = [f.name for f in s1["data"].dataType.elementType.fields]
    assert "Tiros totales_local" in data1
    write_doc(land, "2026.json", SEASON_2026)
    s2 = ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True).schema
    data2 = [f.name for f in s2["data"].dataType.elementType.fields]
    assert set(data1) <= set(data2) and "Total shots_local" in data2
    # known fields keep their place; new ones are appended
    assert data2[: len(data1)] == data1
    assert L.SchemaStore(spark, f"{state}/schema").load() == (s2, 2)
    # a run without new files parses nothing and leaves the memory as it is
    again = ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True)
    assert (again.batches, again.documents, again.schema) == (0, 0, s2)
    assert L.SchemaStore(spark, f"{state}/schema").load()[1] == 2


def test_merge_schemas_widens_conflicts():
    from pyspark.sql import types as T

    a = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.LongType())])
    b = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.StringType()),
                      T.StructField("z", T.LongType())])
    m = L.merge_schemas(a, b)
    assert [(f.name, f.dataType) for f in m.fields] == [
        ("x", T.DoubleType()), ("y", T.StringType()), ("z", T.LongType())
    ]


def test_typed_inference_keeps_numbers(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_doc(land, "2021.json", SEASON_2021)
    docs = L.read_documents(spark, f"{land}/*.json", multi_line=True, infer_types=True)
    rows = L.explode_matches(docs)
    types = dict(rows.dtypes)
    assert types["temporada"] == "bigint"
    assert types["Tiros totales_local"] == "bigint"
    assert types["Pases precisos_local"] == "string"
    assert rows.filter("`_source_file` like '%2021.json'").count() == 2


def test_bronze_schema_matches_written_bronze(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_doc(land, "2021.json", SEASON_2021)
    write_doc(land, "2026.json", SEASON_2026)
    bronze, state = os.path.join(workdir, "bronze"), os.path.join(workdir, "state")
    res = ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True)
    stated = L.bronze_schema(L.as_stored(res.schema))
    written = read_bronze(spark, bronze).schema
    assert sorted((f.name, f.dataType.simpleString()) for f in stated.fields) == sorted(
        (f.name, f.dataType.simpleString()) for f in written.fields
    )


def test_silver_same_from_typed_and_string_bronze(spark, workdir):
    from pitchflow.operators.silver import silver_matches

    land = os.path.join(workdir, "landing")
    for name, doc in (("2020.json", SEASON_2020), ("2021.json", SEASON_2021),
                      ("2026.json", SEASON_2026), ("2026-late.json", SEASON_2026_LATE)):
        write_doc(land, name, doc)
    files = f"{land}/*.json"
    typed = L.to_bronze(L.read_documents(spark, files, multi_line=True, infer_types=True))
    strings = L.to_bronze(L.read_documents(spark, files, multi_line=True))
    assert dict(typed.dtypes)["Tiros totales_local"] == "bigint"
    # a field that is a number in one file and text in another is inferred as text
    assert dict(typed.dtypes)["Accurate passes_visitante"] == "string"
    drop = ["fecha_carga"]
    a = silver_matches(typed).drop(*drop)
    b = silver_matches(strings).drop(*drop)
    assert a.dtypes == b.dtypes
    assert _rows(a) == _rows(b)


def test_lost_checkpoint(spark, workdir):
    """A new state takes no file again that Bronze or the quarantine has, and replaces no batch."""
    land = os.path.join(workdir, "landing")
    write_doc(land, "2021.json", SEASON_2021)
    with open(os.path.join(land, "broken.json"), "w") as f:
        f.write('{"temporada": ')
    bronze = os.path.join(workdir, "bronze")

    def run(state):
        return ingest_landing(spark, f"{land}/*.json", bronze, os.path.join(workdir, state), multi_line=True)

    run("state")
    write_doc(land, "2026.json", SEASON_2026)
    for _ in range(2):
        run("other")
    write_doc(land, "2020.json", SEASON_2020)
    run("other")
    assert sorted(r.url for r in read_bronze(spark, bronze).collect()) == sorted(m["url"] for s in (SEASON_2020, SEASON_2021, SEASON_2026) for m in s["data"])
    assert read_quarantine(spark, bronze).count() == 1


def test_replay_once(spark, workdir):
    land, bronze, state = (os.path.join(workdir, d) for d in ("landing", "bronze", "state"))
    write_doc(land, "2021.json", SEASON_2021)
    for name, text in (("a.json", json.dumps(SEASON_2026)[:-1]), ("b.json", "nothing")):
        with open(os.path.join(land, name), "w") as f:
            f.write(text)
    assert ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True).malformed == 2
    got = [replay_quarantine(spark, bronze, state, lambda c: F.concat(c, F.lit(end))).documents for end in ("", "}", "}")]
    assert got == [0, 1, 0]
    write_doc(land, "2020.json", SEASON_2020)
    ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True)
    assert sorted(r.url for r in read_bronze(spark, bronze).collect()) == sorted(m["url"] for s in (SEASON_2020, SEASON_2021, SEASON_2026) for m in s["data"])


def test_archive_processed_landing_files(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_doc(land, "2021.json", SEASON_2021)
    bronze, state = os.path.join(workdir, "bronze"), os.path.join(workdir, "state")
    archive = os.path.join(workdir, "archive")
    ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True, archive_dir=archive)
    write_doc(land, "2026.json", SEASON_2026)
    ingest_landing(spark, f"{land}/*.json", bronze, state, multi_line=True, archive_dir=archive)
    assert read_bronze(spark, bronze).count() == 4
    archived = [f for _, _, files in os.walk(archive) for f in files if f.endswith(".json")]
    assert "2021.json" in archived  # the first run's file, once its batch committed


ODD = {"temporada": 2027, "data": [{"url": "m/odd/1", "Remates": 4, "remates": 5, "temporada": "x"}, "suelto", None, [1], {"url": "m/odd/2"}]}


def test_odd_documents_lose_no_match(spark, workdir):
    """What stands in a match list's place, or in it, takes no other match with it, nor the memory."""
    landing, bronze, state = (os.path.join(workdir, d) for d in ("landing", "bronze", "state"))
    files = f"{landing}/*.json"

    def run():
        return ingest_landing(spark, files, bronze, state, multi_line=True)

    write_doc(landing, "a.json", SEASON_2020)
    assert run().stray == 0
    write_doc(landing, "b.json", SEASON_2021)
    write_doc(landing, "c.json", {"temporada": 2021, "data": "sin datos"})
    write_doc(landing, "d.json", {"temporada": 2021, "data": {"url": "m/one"}})
    write_doc(landing, "e.json", ODD)
    write_doc(landing, "f.json", {"temporada": 2021, "data": None})
    second = run()
    assert (second.documents, second.malformed, second.stray) == (5, 0, 4)
    write_doc(landing, "g.json", SEASON_2026)
    known = run().schema
    rows = {r.url: r for r in read_bronze(spark, bronze, known, rescued=True).collect()}
    want = [m["url"] for s in (SEASON_2020, SEASON_2021, SEASON_2026) for m in s["data"]] + ["m/one", "m/odd/1", "m/odd/2"]
    assert sorted(rows) == sorted(want)
    odd = rows["m/odd/1"]
    assert (odd.temporada, odd.Remates, odd._rescatado) == ("2027", "4", '{"remates":"5","temporada":"x"}')
    assert all(r._rescatado is None for u, r in rows.items() if u != "m/odd/1")
    assert sorted(r.value for r in read_quarantine(spark, bronze).collect()) == ['"sin datos"', '"suelto"', "[1]", "null"]
