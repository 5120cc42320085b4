"""The pipeline, stage by stage, and the registered queries of the subpackage."""

from __future__ import annotations

import os

import pytest
from compare import compare, duckdb_with_views

import corpus_pipeline
from pitchflow.llm import queries
from pitchflow.llm.common import connected_components, stored

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_filter_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.dtypes == docs.dtypes
        docs = stored(out, "test-stage")
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.count() == counts[-1]
    assert corpus_pipeline.run(spark, SMALL).count() == counts[-1]


def test_stages_take_an_empty_table_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (3, None, "en", "s", None), (3, "x", "en", "s", 1)], docs.schema)
    for rows in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SMALL).count() <= rows.count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    res = compare(queries.queries()[name](spark, SMALL), duckdb_with_views(SMALL), queries.oracle_sql()[name])
    assert res["ok"], res


def test_thirteen_operators_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.queries()) == list(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(ROOT):
        if any(x in folder for x in ("/llm", "/.git", "/tests")):
            continue
        for f in files:
            if f.endswith(".py") and f not in ("corpus_pipeline.py", "__spark_entry__.py"):
                with open(os.path.join(folder, f), encoding="utf-8") as g:
                    assert "llm" not in g.read(), f


def test_connected_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (10, 9), (9, 8), (8, 7), (7, 6), (6, 5), (20, 21), (21, 20), *[(100, 100 + i) for i in range(1, 50)], (149, 400), (-5, 400)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**dict.fromkeys((1, 2, 3), 1), **dict.fromkeys(range(5, 11), 5), 20: 20, 21: 20, **dict.fromkeys([*range(100, 150), 400, -5], -5)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def tasks_and_jobs(spark, run):
    """(tasks, jobs) that ``run`` takes with 64 shuffle partitions which Spark doesn't merge."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    group = f"counted-{run.__name__}"
    for k, v in held.items():
        spark.conf.set(k, v)
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
    finally:
        spark.sparkContext._jsc.clearJobGroup()
        for k, v in before.items():
            spark.conf.set(k, v)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    stages = map(tracker.getStageInfo, {s for j in jobs for s in j.stageIds})
    return sum(s.numCompletedTasks for s in stages if s), len(jobs)  # Spark forgets skipped stages in a long session


def test_few_edges_take_few_tasks_for_components(spark):
    def chain():
        got = connected_components(spark.createDataFrame([(i, i + 1) for i in range(0, 60)], "a long, b long").coalesce(1)).collect()
        assert sorted(map(tuple, got)) == [(i, 0) for i in range(61)]

    assert 100 < tasks_and_jobs(spark, chain)[0] < 600


def test_stars_are_components_without_a_round(spark):
    def stars():
        got = connected_components(spark.createDataFrame([(9, 1), (1, 8), (1, 8), (7, 2)], "a long, b long").coalesce(1)).collect()
        assert sorted(map(tuple, got)) == [(1, 1), (2, 2), (7, 2), (8, 1), (9, 1)]

    assert 0 < tasks_and_jobs(spark, stars)[1] < 10
