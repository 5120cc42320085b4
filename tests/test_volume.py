"""What keeps the ingest small: bounded row groups, nothing parsed in memory, narrow shuffles, compressed landing files."""

from __future__ import annotations

import glob
import json
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from samples import SEASON_2021, SMALL_SF, write_doc

from pitchflow import spec
from pitchflow.operators import silver
from pitchflow.plans import catalog
from pitchflow.sources import landing as L
from pitchflow.sources.fixture import raw_matches, read_orders, season_documents, write_documents
from pitchflow.sources.tables import drop_batches
from pitchflow.streaming import bronze as B
from pitchflow.streaming.bronze import ingest_landing, quarantine_path, read_bronze, read_quarantine, replay_quarantine


def test_texts_set_aside_are_read_few_at_a_time(spark, workdir):
    """Readers decode a row group at once, so a few whole documents must be one, not a hundred and more."""
    land, bronze, state = (os.path.join(workdir, n) for n in ("landing", "bronze", "state"))
    os.makedirs(land)
    rng = random.Random(3)
    texts = ['{"temporada": 2021, "data": [{"local": "' + rng.randbytes(300_000).hex() + '"}' for _ in range(30)]
    with open(f"{land}/broken.json", "w") as f:
        f.write("\n".join(texts))
    assert ingest_landing(spark, f"{land}/*.json", bronze, state).malformed == 30
    meta = [pq.ParquetFile(f).metadata for f in glob.glob(f"{quarantine_path(bronze)}/*/*.parquet")]
    assert max(m.row_group(i).num_rows for m in meta for i in range(m.num_row_groups)) <= 15
    assert sorted(r.value for r in read_quarantine(spark, bronze).collect()) == sorted(texts)
    assert replay_quarantine(spark, bronze, state, lambda t: F.concat(t, F.lit("]}"))).documents == 30
    assert read_bronze(spark, bronze).count() == 30


def test_parsed_documents_are_kept_on_disk(spark, workdir):
    write_doc(workdir, "2021.json", SEASON_2021)
    write_doc(workdir, "broken.json", SEASON_2021)
    with open(f"{workdir}/broken.json", "w") as f:
        f.write('{"temporada": 2')
    kept = L.persist_parsed(L.raw_documents(spark.read.text(f"{workdir}/*.json", wholetext=True)))
    assert kept.storageLevel.useDisk and not kept.storageLevel.useMemory
    got = {os.path.basename(r[spec.SOURCE_FILE_COL]): (r.value, r.good) for r in kept.withColumn("good", F.expr("v is not null")).collect()}
    kept.unpersist()
    assert got == {"2021.json": (None, True), "broken.json": ('{"temporada": 2', False)}


def test_matches_are_made_to_text_once(spark, workdir):
    """A filter on the texts made them a second time for every match."""
    write_doc(workdir, "2021.json", SEASON_2021)
    raw = L.raw_documents(spark.read.text(f"{workdir}/*.json", wholetext=True))
    plan = L.bronze_rows(raw, L.document_schema(raw)[0])._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(try_variant_get" not in plan


def test_schema_of_lists_and_of_odd_documents(spark, workdir):
    docs = [
        {"temporada": 2021, "data": [{"a": 1, "b": "x"}, {"a": 2.5}]},
        {"temporada": 2021, "data": []},
        {"temporada": 2021, "data": None},
        {"temporada": 2021},
    ]

    def found(all_docs):
        path = os.path.join(workdir, f"{len(all_docs)}.json")
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(d) for d in all_docs))
        raw = L.raw_documents(spark.read.text(path))
        schema, *counts = L.document_schema(raw)
        rows = L.bronze_rows(raw, schema).collect()
        return schema.simpleString(), counts, sorted((r.a, r.b) for r in rows if r.b), len(rows), L.stray_elements(raw).count()

    listed = found(docs)
    assert listed == ("struct<temporada:bigint,data:array<struct<a:double,b:string>>>", [4, 0, 0], [("1", "x")], 2, 0)
    for odd, more in (([None], 0), (["suelto", {"a": 3}], 1), ({"a": 4}, 1), ("sin datos", 0)):
        schema, counts, _, rows, aside = found([*docs, {"temporada": 2021, "data": odd}])
        assert (schema, rows) == (listed[0], 2 + more)
        assert counts == [5, 0, aside] and aside == (0 if isinstance(odd, dict) else 1)


def test_documents_shuffle_terms_and_not_fields(spark):
    orders = read_orders(spark, SMALL_SF)
    docs = season_documents(orders, 5000)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert spec.STATS[0][0] not in plan.split("Exchange", 1)[1]
    rows = docs.select(F.inline(spec.DATA_FIELD), "temporada")
    want = raw_matches(orders)
    assert rows.select(*[f"`{c}`" for c in want.columns]).exceptAll(want).isEmpty() and rows.count() == want.count()


def test_rescue_drops_shuffle_terms_and_not_texts(spark, workdir, monkeypatch):
    """The JSON of every match was shuffled to its document."""
    plans, write = [], DataFrameWriter.text

    def text(writer, path, *args, **options):
        plans.append((path, writer._df._jdf.queryExecution().executedPlan().toString()))
        return write(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "text", text)
    got = {r.temporada: (r.partidos, r.rescatados, r.apartados) for r in catalog.q_bronze_rescue(spark, SMALL_SF).collect()}
    lists = [plan for path, plan in plans if path.endswith(("/drop1_0", "/drop2_0"))]
    assert len(lists) == 2 and all("to_json" not in plan.split("Exchange", 1)[1] for plan in lists)
    k, season = F.col("o_orderkey"), (F.year("o_orderdate") + 25).cast("string")
    want = read_orders(spark, SMALL_SF).groupBy(season.alias("s")).agg(
        F.count(k), F.count_if(k % 7 == 0), F.count_if((k % 10 == 1) & (k % 100 != 0)) + 1
    )
    assert got == {r[0]: tuple(r[1:]) for r in want.collect()}


def test_compressed_landing_files(spark, workdir):
    docs = season_documents(read_orders(spark, SMALL_SF), 50)
    plain, small = write_documents(docs, f"{workdir}/plain"), write_documents(docs, f"{workdir}/small", compression="lz4")
    size = {p: sum(map(os.path.getsize, glob.glob(f"{p}/*.json*"))) for p in (plain, small)}
    assert 0 < size[small] * 3 < size[plain]
    assert spark.read.text(small).exceptAll(spark.read.text(plain)).isEmpty()
    assert spark.read.text(small).count() == docs.count()


ODD_TEXTS = [
    '{"temporada":2021,"x":1e999,"data":[{"a":1,"b":"x","m":1,"f":1.50,"n":{"q":[1, 2.0]},"t":true,"v":null,"Temporada":5,"A":"c",'
    + r'"é `k":"\u0001\"\\/\u2028 \ud83d\ude00 \ud800"},{"a":-0,"w":-0,"m":"x","f":1e-7,"n":3,"b":""}]}',
    '{"temporada":"2022","data":[]}',
    '{"temporada":null,"data":null}',
    '{"t":1}',
    '{"data":[{"a":3}],"data2":{"data":[1]}}',
    '{"data":[{"w":9007199254740993,"b":"  -0"},{}]}',
    '{"temporada":2020,"data":[{"w":1}]} {"x":2',
]


def test_fields_read_of_the_text_are_those_of_the_variant(spark, workdir):
    """Every value was cast to text out of its variant, one by one. Plain fields are read of the text, odd ones as before."""

    def found(texts):
        path = os.path.join(workdir, f"{len(texts)}.json")
        with open(path, "w") as f:
            f.write("\n".join(texts))
        raw = L.raw_documents(spark.read.text(path))
        schema, *counts, types = L.document_types(raw)
        return raw, schema, counts, types

    raw, schema, counts, types = found(ODD_TEXTS)
    assert counts == [7, 0, 0]
    assert {n for n, t in types.items() if not isinstance(t, L._AS_WRITTEN)} == {"f", "m", "n", "temporada"}
    want, got = (L.bronze_rows(raw, schema, types=t).drop(spec.LOAD_TIME_COL) for t in (None, types))
    assert got.schema == want.schema and got.count() == 6
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert "0" in [r.w for r in got.collect()] and "  -0" in [r.b for r in got.collect()]

    raw, schema, _, types = found(['{"temporada": 2022, "data": [{"a": 1, "b": "x"}]}'])
    plan = L.bronze_rows(raw, schema, types=types)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan and "parseJson" not in plan and "try_variant_get" not in plan

    for odd, bad, stray in (('{"dat', 1, 0), ('{"data": [null]}', 0, 1), ('{"data": "x"}', 0, 1), ('{"data": {"a": 1}}', 0, 0)):
        _, _, counts, types = found([*ODD_TEXTS, odd])
        assert counts[1:] == [bad, stray] and types is None


def test_types_are_read_of_the_documents_in_place(spark, workdir):
    """The match list was got of every document as a variant, which builds it anew, twice."""
    write_doc(workdir, "2021.json", SEASON_2021)
    seen, frame = [], type(spark.range(1))
    agg = frame.agg

    def kept(df, *columns):
        seen.append(agg(df, *columns))
        return seen[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(frame, "agg", kept)
        L.document_types(L.raw_documents(spark.read.text(f"{workdir}/*.json", wholetext=True)))
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(seen) == 1 and "VariantType" not in plan


def test_wide_projections_are_not_fused(spark, workdir):
    """Fused with the sort of the write, the Silver projection was one method that the JVM didn't compile."""
    rows = silver.silver_matches(raw_matches(read_orders(spark, SMALL_SF))).sortWithinPartitions("temporada")
    plan = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    projects = [line for line in plan if "Project [" in line]
    assert "equipo_local" in projects[1] and not any("*(" in line for line in projects[:2])


def _land_broken(workdir, texts):
    land, bronze, state = (os.path.join(workdir, n) for n in ("landing", "bronze", "state"))
    os.makedirs(land)
    with open(f"{land}/broken.json", "w") as f:
        f.write("\n".join(texts))
    return f"{land}/*.json", bronze, state


def test_texts_are_neither_kept_nor_shuffled(spark, workdir, monkeypatch):
    """A task that persisted or read whole documents held a hundred pieces of 4 MB; a replay dealt the texts out by their keys."""
    files, bronze, state = _land_broken(workdir, [json.dumps({"temporada": 2021, "data": [{"url": str(i)}]})[: None if i < 5 else -1] for i in range(20)])
    plans, persisted, frame, found = [], [], type(spark.range(1)), B.document_types
    persist = frame.persist
    monkeypatch.setattr(B, "document_types", lambda raw: plans.append(raw._jdf.queryExecution().executedPlan().toString()) or found(raw))
    monkeypatch.setattr(frame, "persist", lambda df, *level: persisted.append(df) or persist(df, *level))
    assert ingest_landing(spark, files, bronze, state).malformed == 15
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [replay_quarantine(spark, bronze, state, lambda t: F.concat(t, F.lit("}"))).documents for _ in range(2)] == [15, 0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not persisted
    assert len(plans) == 3 and not any("Exchange hashpartitioning" in p or "SortMergeJoin" in p for p in plans)
    assert sorted(int(r.url) for r in read_bronze(spark, bronze).collect()) == list(range(20))


@pytest.mark.parametrize("most", [0, 3, 100_000])
def test_replays_of_some_texts(spark, workdir, monkeypatch, most):
    """Every replay takes what is new to it, whichever keys are few enough to be sent to the texts."""
    texts = [json.dumps({"temporada": 2021, "data": [{"url": str(i)}]})[:-1] for i in range(8)]
    files, bronze, state = _land_broken(workdir, [*texts, texts[0], "nothing"])
    monkeypatch.setattr(B, "BROADCAST_KEYS", most)
    ingest_landing(spark, files, bronze, state)

    def mend(numbers):
        some = F.regexp_extract("value", r'"url": "(\d+)"', 1).isin([str(i) for i in numbers])
        return replay_quarantine(spark, bronze, state, lambda t: F.when(some, F.concat(t, F.lit("}"))).otherwise(t)).documents

    assert [mend(n) for n in ([5, 6], [], [0, 1, 2, 3, 5], [0, 5], range(8), range(8))] == [2, 0, 5, 0, 2, 0]
    assert sorted(r.url for r in read_bronze(spark, bronze).collect()) == sorted("001234567")
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_replay_that_ended_before_its_keys(spark, workdir):
    """Its batch, strays included, is written again and not beside itself."""
    files, bronze, state = _land_broken(workdir, ['{"temporada": 2021, "data": [{"url": "1"}, "suelto"]', "nothing"])
    ingest_landing(spark, files, bronze, state)
    for _ in range(2):
        drop_batches(spark, B.replayed_path(bronze), [B.REPLAYED])
        assert replay_quarantine(spark, bronze, state, lambda t: F.concat(t, F.lit("}"))).documents == 1
    assert replay_quarantine(spark, bronze, state, lambda t: F.concat(t, F.lit("}"))).documents == 0
    assert [r.url for r in read_bronze(spark, bronze).collect()] == ["1"]
    assert sorted(r.value for r in read_quarantine(spark, bronze).collect()) == sorted(['"suelto"', '{"temporada": 2021, "data": [{"url": "1"}, "suelto"]', "nothing"])


def test_broken_drop_has_few_documents_a_file(spark, workdir, monkeypatch):
    """A compressed file is one task, and the broken documents of a task were one file."""
    monkeypatch.setattr(catalog, "new_run_dir", lambda spark, name: f"{workdir}/{name}")
    monkeypatch.setattr(catalog, "MATCHES_PER_DOCUMENT", 20)
    monkeypatch.setattr(catalog, "DOCUMENTS_PER_FILE", 10)
    want = read_orders(spark, SMALL_SF).count()
    assert catalog.q_bronze_replay(spark, SMALL_SF).count() == want
    sizes = spark.read.text(f"{workdir}/bronze_replay/landing/broken").groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) <= 10
