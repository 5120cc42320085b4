from __future__ import annotations

import random
from collections import Counter

import regex

from pitchflow.llm import decontaminate


def words(t):
    return [x for x in regex.split(r"[^\p{L}\p{M}\p{N}]+", (t or "").lower()) if x]


def shingles(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(rows, bench, least=0.8):
    """Every window of every document against every item."""
    out = {}
    for d, t in rows:
        w = words(t)
        for i, q in bench:
            iw = words(q)
            if not iw:
                continue
            k, n = min(5, len(iw)), len(iw)
            own = shingles(iw, k)
            for s in range(max(1, len(w) - n + 1)):
                there = shingles(w[s : s + n], k)
                common = sum((own & there).values())
                total = sum(own.values()) + sum(there.values()) - common
                if total and common / total >= least - 1e-12:
                    out[d, i] = max(out.get((d, i), 0), common / total)
    return out


def got(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def bench_table(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_against_brute_force(spark, docs):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]

    def some(n):
        return [r.choice(vocabulary) for _ in range(n)]

    bench = [(i, some(r.randint(6, 60))) for i in range(12)]
    rows = []
    for d in range(150):
        text = some(r.randint(0, 120))
        for _ in range(r.randint(0, 2)):
            item = list(r.choice(bench)[1])
            for _ in range(r.randint(0, 2)):  # edits near the ends, and in the middle of long items
                item[r.choice([0, 1, -1, -2, len(item) // 2])] = r.choice(vocabulary)
            if r.random() < 0.3:
                item = item[r.randint(0, 3) :]
            text[r.randint(0, len(text)) :] = [*item, *some(r.randint(0, 30))]
        rows.append((d, " ".join(text)))
    bench = [(i, " ".join(w)) for i, w in bench]
    found, want = got(decontaminate.hits(docs(rows), bench_table(spark, bench))), brute(rows, bench)
    assert set(found) == set(want) and len(want) > 40
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)


def test_edge_cases(spark, docs):
    item = "The quick brown fox, jumps over the lazy dog again."
    bench = [(1, item), (2, "Two words"), (3, None), (4, ""), (5, "?!"), (None, "no id has this item of many words"), (1, item), (6, item.upper())]
    rows = [(1, f"intro {item} outro"), (2, item.replace(" ", "\n** ")), (3, None), (4, ""), (5, "two, WORDS"), (None, "no id has this item of many words"),
            (7, "fox " * 50_000 + item), (8, f"x {item}"), (8, f"x {item}"), (9, "the quick brown fox stops")]
    df = docs(rows).selectExpr("doc_id", "text", "1 as item_id", "2 as w", "3 as text_hash", "4 as start", "5 as n")
    out = decontaminate.hits(df, bench_table(spark, bench).selectExpr("*", "1 as doc_id", "2 as hashes"))
    assert got(out) == {(1, 1): 1.0, (1, 6): 1.0, (2, 1): 1.0, (2, 6): 1.0, (5, 2): 1.0, (None, None): 1.0, (7, 1): 1.0, (7, 6): 1.0, (8, 1): 1.0, (8, 6): 1.0}
    assert out.count() == 10  # equal rows give one hit
    kept = decontaminate.drop_contaminated(df, bench_table(spark, bench))
    assert kept.columns == df.columns and sorted(x.doc_id for x in kept.collect()) == [3, 4, 9]


def test_empty_tables(spark, docs):
    assert decontaminate.hits(docs([]), bench_table(spark, [(1, "a b c d e f")])).count() == 0
    assert decontaminate.hits(docs([(1, "a b c d e f")]), bench_table(spark, [])).count() == 0
    assert decontaminate.drop_contaminated(docs([(1, "a b c d e f")]), bench_table(spark, [])).count() == 1


def test_the_same_without_broadcasts(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", -1)
    item = "one two three four five six seven eight"
    assert got(decontaminate.hits(docs([(1, f"a {item} b"), (2, "c d e f g h")]), bench_table(spark, [(1, item)]))) == {(1, 1): 1.0}


def test_no_python_in_the_plan(spark, docs):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        decontaminate.hits(docs([(1, "a b c d e f")]), bench_table(spark, [(1, "a b c d e f")])).explain()
    assert "Python" not in buf.getvalue() and "Arrow" not in buf.getvalue() and "Cartesian" not in buf.getvalue()


def test_near_blocks_reach_every_code_within_the_radius(spark):
    r = random.Random(9)
    pairs = []
    for _ in range(300):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        pairs.append([x - (1 << 64) if x >> 63 else x for x in (a, b)])
    df = spark.createDataFrame(pairs, "x long, y long").select(decontaminate._near_blocks("x").alias("near"), decontaminate._blocks("y").alias("own"))
    assert df.selectExpr("arrays_overlap(near, own) AS met").where("not met").count() == 0


def test_windows_between_the_aligned_ones(spark, docs):
    """Inserted words together with edits at both ends: the best window is aligned with no shared shingle."""
    item = [f"w{i}" for i in range(58)]
    text = ["x", "y", "z", "first", *item[1:29], "new", "words", *item[29:57], "last", "p", "q", "r"]
    rows, bench = [(1, " ".join(text))], [(1, " ".join(item))]
    want = brute(rows, bench)
    assert want == {(1, 1): 0.8}
    assert got(decontaminate.hits(docs(rows), bench_table(spark, bench))) == want


def test_inserted_and_deleted_words_against_brute_force(spark, docs):
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(80)]
    bench = [(i, [r.choice(vocabulary) for _ in range(n)]) for i, n in enumerate((8, 20, 45, 60, 90, 120))]
    bench.append((9, ["a", "a", "b"] * 20))  # repeated shingles
    rows = []
    for d in range(200):
        item = list(r.choice(bench)[1])
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(item) // 2) + len(item) // 4
            item[at:at] = [r.choice(vocabulary) for _ in range(r.randint(1, 5))]
        if r.random() < 0.5:
            del item[len(item) // 3 : len(item) // 3 + r.randint(1, 2)]
        for at in (0, -1):
            if r.random() < 0.5:
                item[at] = r.choice(vocabulary)
        rows.append((d, " ".join([*r.choices(vocabulary, k=r.randint(0, 9)), *item, *r.choices(vocabulary, k=r.randint(0, 9))])))
    bench = [(i, " ".join(w)) for i, w in bench]
    found, want = got(decontaminate.hits(docs(rows), bench_table(spark, bench))), brute(rows, bench)
    assert set(found) == set(want) and len(want) > 40
    assert all(abs(found[k] - want[k]) < 1e-9 for k in want)
