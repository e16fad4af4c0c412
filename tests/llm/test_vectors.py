"""Near-duplicate embeddings and nearest neighbours against brute force."""

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import ann, forest
from ledgerflow.llm.registry import QUERIES

BAD = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, None] + [1.0] * 14]


def cloud(n=900, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    if n < 520:
        return x.astype(np.float32)
    x[200:260] = x[200] + rng.standard_normal((60, d)) * 0.1 * np.linalg.norm(x[200]) / 4  # a dense group
    x[300:340] = x[300]  # copies
    x[400:410] = x[410:420] * 3  # parallel
    for i in range(500, 520):  # a chain
        x[i] = x[i - 1] + rng.standard_normal(d) * 0.15 * np.linalg.norm(x[i - 1]) / 4
    return x.astype(np.float32)


def frame(spark, x, clashing, bad=BAD):
    rows = [(int(i), [float(v) for v in r], 1) for i, r in enumerate(x)] + [(10_000 + 20 * i, b, None) for i, b in enumerate(bad)]
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5))


def test_near_duplicates(spark, clashing):
    x = cloud()
    got = {r["vec_id"]: r for r in forest.near_duplicates(frame(spark, x, clashing), trees=10, leaf=60, block=40).collect()}
    u = forest.unit(x.astype(np.float64))
    links = (u @ u.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(links, label, len(x)).min(axis=1))
        if (new == label).all():
            break
        label = new
    n = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (n <= links.sum(axis=1)).all() and n.sum() >= 0.999 * links.sum()
    assert np.mean([got[i]["component_id"] == label[i] for i in range(len(x))]) > 0.999
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    assert [tuple(got[10_000 + 20 * i])[1:] for i in range(len(BAD))] == [(0, 10_000 + 20 * i, True) for i in range(len(BAD))]
    assert got[339]["n_links"] >= 39 and got[339]["component_id"] == 300


def test_empty_vectors(spark, clashing):
    df = frame(spark, cloud()[:5], clashing, [])
    assert forest.near_duplicates(df.limit(0)).count() == 0 and ann.search(df.limit(0), df).count() == 0 and ann.search(df, df.limit(0)).count() == 0
    only_bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, forest.near_duplicates(only_bad).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert ann.search(only_bad, only_bad).count() == 0


@pytest.mark.parametrize("copies", [0, 60])
def test_search(spark, clashing, copies):
    x = cloud(1500, seed=2)
    x[700 : 700 + copies] = x[700] * 2
    df = frame(spark, x, clashing)
    rows = ann.search(df, df.filter("vec_id % 20 = 0"), k=10).collect()
    exact, hit = x.astype(np.float64) @ x.astype(np.float64).T, 0
    for q in range(0, len(x), 20):
        own = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        score = exact[q].copy()
        score[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -np.round(score, 9)))[:10]
        assert [r["rank"] for r in own] == list(range(1, 11)) and q not in [r["vec_id"] for r in own]
        assert np.allclose([r["score"] for r in own], [score[r["vec_id"]] for r in own], rtol=0, atol=1e-9)
        hit += len({r["vec_id"] for r in own} & set(best.tolist()))
    assert hit >= 0.9 * 10 * len(range(0, len(x), 20))
    assert {r["query_id"] for r in rows} == set(range(0, len(x), 20))  # broken vectors take no part


def test_search_fewer_than_k(spark, clashing):
    df = frame(spark, cloud()[:6], clashing, [])
    rows = ann.search(df, df.filter("vec_id = 0")).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]


def test_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op10_nearest_neighbours"](spark, sf).collect()
    table = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids = np.array(sorted(table))
    m = np.stack([table[i] for i in ids])
    hit = 0
    for q in ids[ids % 20 == 0]:
        s = m @ table[q]
        s[ids == q] = -np.inf
        hit += len({r["vec_id"] for r in rows if r["query_id"] == q} & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
    assert hit / (20 * (ids % 20 == 0).sum()) >= 0.9


def brute(x, ids, k=20):
    exact = x.astype(np.float64) @ x.astype(np.float64).T
    for i in np.flatnonzero(ids % 20 == 0):
        score = np.where(ids == ids[i], -np.inf, exact[i])
        yield ids[i], score, np.lexsort((ids, -np.round(score, 9)))[:k]


def test_search_among_copies(spark):
    """6000 copies of one vector and 50 others: every query gets its 20 nearest."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((6050, 16)).astype(np.float32)
    x[50:] = x[50]
    ids = np.concatenate([np.arange(50) * 20, 10_000 + np.arange(6000) * 20])
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<float>").repartition(6)
    rows, asked = ann.search(df, df.filter("vec_id < 11000")).collect(), 100
    by = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append(r)
    assert len(by) == asked and all(len(own) == 20 for own in by.values())
    hit = 0
    for q, score, best in brute(x, ids):
        if q < 11000:
            assert q not in [r["vec_id"] for r in by[q]]
            hit += np.sum(np.array([r["score"] for r in by[q]]) >= score[best[-1]] - 1e-9)
    assert hit >= 0.95 * 20 * asked


def test_search_in_skewed_groups(spark):
    """A third of all vectors lie in one tight group, and long lists are split."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((6000, 32)).astype(np.float32)
    x[:2000] = x[0] + 0.02 * rng.standard_normal((2000, 32))
    ids = np.arange(6000)
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<float>").repartition(6)
    by = {}
    for r in ann.search(df, df.filter("vec_id % 20 = 0")).collect():
        by.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert len(by) == 300 and all(len(v) == 20 for v in by.values())
    assert np.mean([len(by[q] & set(ids[best].tolist())) / 20 for q, _, best in brute(x, ids)]) >= 0.9


def test_repeated_keys_and_lengths(spark):
    """Rows that agree in key and vector are one; vectors of other lengths take no part, or link among themselves."""
    x = cloud(60, 8)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame([*rows, *rows[:10], *[(0, rows[0][1])] * 30, (900, [1.0, 2.0]), (920, [1.0, 2.0]), (940, [2.0, 4.0])], "vec_id long, embedding array<float>")
    out = ann.search(df, df.filter("vec_id % 20 = 0")).collect()
    assert {r["query_id"]: sum(o["query_id"] == r["query_id"] for o in out) for r in out} == {0: 20, 20: 20, 40: 20}
    assert len({(r["query_id"], r["vec_id"]) for r in out}) == 60
    got = {r["vec_id"]: r for r in forest.near_duplicates(df).collect()}
    assert {got[i]["component_id"] for i in (900, 920, 940)} == {900} and got[940]["n_links"] == 2
    text = df.select(df.vec_id.cast("string"), "embedding")
    for call in (lambda: ann.search(text, text), lambda: forest.near_duplicates(text)):
        with pytest.raises(TypeError):
            call()


@pytest.mark.parametrize("kind", ["odd", "groups", "ties", "huge"])
def test_search_equals_brute_force(spark, monkeypatch, kind):
    """Vectors that codes tell apart badly (an odd number of components, tight groups), that tie, or whose products single
    precision doesn't hold: exactly the nearest, in shares of 150 vectors, over which the largest lists are split."""
    rng = np.random.default_rng(8)
    if kind == "odd":
        x = rng.standard_normal((2000, 37))
    elif kind == "groups":
        x = np.repeat(rng.standard_normal((4, 16)), [1200, 400, 300, 100], axis=0) + 0.02 * rng.standard_normal((2000, 16))
    elif kind == "ties":
        x = (rng.random((2000, 40)) < 0.06).astype(float)
        x[~x.any(axis=1), 0] = 1
    else:
        x = rng.standard_normal((2000, 8)) * 1e25
    x, ids = x.astype(np.float32), rng.permutation(2000) * 3
    monkeypatch.setattr(ann, "HELD", 150 * x.shape[1], raising=False)
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x, strict=True)], "vec_id long, embedding array<float>").repartition(5)
    by = {}
    for r in sorted(ann.search(df, df.filter("vec_id % 20 = 0")).collect(), key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y = x.astype(np.float64)
    assert len(by) == 100
    for at in np.flatnonzero(ids % 20 == 0):
        score = np.where(ids == ids[at], -np.inf, (y * y[at]).sum(axis=1))
        assert by[ids[at]] == [(n, ids[b], score[b]) for n, b in enumerate(np.lexsort((ids, -score))[:20], 1)]


def test_exact_check_of_a_share(monkeypatch):
    """Of the rows that reach a query's bound the k + 1 best that it doesn't know, ties to the smaller rep, block by block."""
    monkeypatch.setattr(ann, "PRODUCTS", 256)
    rng = np.random.default_rng(9)
    x, q, reps, k = rng.integers(-2, 3, (90, 5)).astype(float), rng.integers(-2, 3, (33, 5)).astype(float), np.arange(90) * 7, 4
    least = rng.choice([-np.inf, 0.0, 3.0, 1e9], len(q))
    known = [sorted(rng.choice(reps, rng.integers(0, 9), replace=False).tolist()) + [3] * (i % 2) for i in range(len(q))]
    i, j, score = ann.unfound(q, least, x, reps, pa.array(known, pa.list_(pa.int64())), k)
    for n in range(len(q)):
        exact = x @ q[n]
        want = [int(r) for r in np.lexsort((reps, -exact)) if exact[r] >= least[n] and reps[r] not in known[n]][: k + 1]
        assert j[i == n].tolist() == want and score[i == n].tolist() == exact[want].tolist()
