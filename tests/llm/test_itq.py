from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from pitchflow.llm import common, itq

VECTORS = "vec_id long, embedding array<float>, label int"


def clusters(n, dims, seed):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((n // 8, dims))
    return (centres[r.integers(0, len(centres), n)] + 0.16 * r.standard_normal((n, dims))).astype(np.float32)


def brute(rows, least=0.95):
    ok = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if o else None for (_, v), o in zip(rows, ok)]
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in range(n)]
    group = list(range(n))
    for _ in range(n):
        new = [min([group[i], *[group[j] for j in near[i]]]) for i in range(n)]
        if new == group:
            break
        group = new
    least_id = {}
    for i in range(n):
        ids = [x for x in (least_id.get(group[i]), rows[i][0]) if x is not None]
        least_id[group[i]] = min(ids, default=None)
    return near, [least_id[g] for g in group]


def check(spark, rows, recall):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], VECTORS)
    out = itq.near_duplicates(df.selectExpr("*", "1 as id", "2 as v", "3 as dims", "4 as code").repartition(3)).collect()
    near, component = brute(rows)
    want = sorted((repr(i), len(x), repr(c), i == c) for (i, _), x, c in zip(rows, near, component))
    got = sorted((repr(r.vec_id), r.n_links, repr(r.component_id), r.kept) for r in out)
    assert len(got) == len(want)
    if recall == 1:
        assert got == want
    assert sum(g[1] for g in got) <= sum(w[1] for w in want)
    assert sum(g[1] for g in got) >= recall * sum(w[1] for w in want)


def test_recall_against_brute_force(spark, docs):
    x = clusters(1500, 64, 3)
    check(spark, [(int(i), v) for i, v in zip(np.random.default_rng(1).permutation(5000), x)], 0.9)


def test_edge_cases(spark, docs):
    x = clusters(60, 16, 5)
    rows = [(100 + i, v) for i, v in enumerate(x)]
    rows += [(1, x[0]), (2, x[0]), (2, x[0]), (3, 2 * x[0]), (4, -x[0]), (5, None), (6, []), (7, [0.0] * 16), (8, [None, *x[0][1:]]),
             (9, [float("nan"), *x[0][1:]]), (10, [float("inf"), *x[0][1:]]), (None, x[0]), (None, x[1] * 50 + 3), (11, [1.0, 2.0]), (12, [1.0, 2.1]), (13, [0.0, -0.0, 1.0]), (14, [-0.0, 0.0, 1.0])]
    check(spark, rows, 1)


def test_empty_table(spark, docs):
    assert itq.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0


def test_candidates_are_all_codes_within_the_radius_once(spark):
    r = np.random.default_rng(0)
    base = r.integers(0, 2**63, 12).astype(np.uint64)
    flips = [sum(1 << int(b) for b in r.choice(64, k, replace=False)) for k in list(range(14)) * 6]
    codes = np.unique([b ^ np.uint64(f) for b in base for f in flips])
    df = spark.createDataFrame([(i, 64, int(np.int64(c.view(np.int64)))) for i, c in enumerate(codes)], "id long, dims int, code long")
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 11}
    for n in (1_000, 60_000, 2_000_000):  # five, four and three tables
        got = [(x.a, x.b) for x in itq.candidates(df, n, 11).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_sample_is_compared_below_a_bound(spark, docs, monkeypatch):
    """Every task sent as many vectors as the sample has to the driver, which compared them."""
    x = clusters(4000, 8, 4)
    rows = [(i * 7 + (i % 16 << 33), 8 if i % 3 else 7, x[i, : 8 if i % 3 else 7].astype(float).tolist()) for i in range(len(x))]
    classes = spark.createDataFrame(rows, "id long, dims int, v array<double>").repartition(16)
    seen, frame, limit, learn = [], type(classes), type(classes).limit, itq.learn
    monkeypatch.setattr(frame, "limit", lambda df, n: seen.append(df.count()) or limit(df, n))
    monkeypatch.setattr(itq, "learn", lambda v: seen.append(v) or learn(v))
    itq.links(classes, sample=200).collect()
    monkeypatch.undo()
    assert 200 <= seen[0] < 400
    want = classes.orderBy(F.xxhash64("id"), "id").limit(200).collect()
    for got, dims in zip(seen[1:], (7, 8), strict=True):
        assert got.tolist() == [r.v for r in want if r.dims == dims]
    # A bound that too few ids meet is raised until enough do.
    monkeypatch.setattr(itq, "_hash_bound", lambda n, most: -(2**63) + 2**50)
    low = itq.sampled(classes, len(rows), 200)
    assert low.column("v").to_pylist() == [r.v for r in want]


def test_entries_are_not_sent_to_every_executor(spark, workdir):
    """The file of the codes is small, so Spark broadcast the many entries made of each, which took the driver's memory."""
    codes = np.random.default_rng(2).integers(0, 2**63, 500)
    spark.createDataFrame([(i, 64, int(c)) for i, c in enumerate(codes)], "id long, dims int, code long").write.parquet(f"{workdir}/codes")
    for n in (1_000, 60_000, 2_000_000):
        pairs = itq.candidates(spark.read.parquet(f"{workdir}/codes"), n)
        assert pairs.count() >= 0
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_no_table_of_many_rows_is_broadcast(spark, docs, monkeypatch):
    """The same results with no broadcast at all in a join of two tables; by the bytes of its files, a table of millions of ids was one."""
    x = clusters(160, 16, 6)
    rows = spark.createDataFrame([(i, v.astype(float).tolist(), 0) for i, v in enumerate(x)], VECTORS)

    def run():
        out = itq.near_duplicates(rows)
        return sorted(out.collect()), out._jdf.queryExecution().executedPlan().toString()

    written, save = [], itq.stored
    monkeypatch.setattr(itq, "stored", lambda df, label: written.append(df._jdf.queryExecution().executedPlan().toString()) or save(df, label))
    want, _ = run()
    assert any("BroadcastHashJoin" in p for p in written)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    written.clear()
    got, plan = run()
    assert got == want
    named = [p for p in written if "component" in p and "Join" in p]
    assert named and not any("BroadcastHashJoin" in p for p in [*named, plan])


def test_rotation_balances_the_bits():
    x = clusters(2000, 64, 9)
    codes = itq.learn(x.astype(float)).codes(x.astype(float))
    share = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1).mean(axis=0)
    assert share.min() > 0.25 and share.max() < 0.75
