import random
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from ledgerflow.llm import mixing, toxicity
from ledgerflow.llm.registry import QUERIES
from tests.llm.words import prose


def corpus(n=900):
    rnd = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        bad = i % 7 == 0
        w = prose(i, rnd.randint(30, 120), 800).translate(str.maketrans("0123456789", "abcdefghij")).split()  # terms are letters
        for _ in range(len(w) // 12 if bad else 0):
            w.insert(rnd.randrange(len(w)), rnd.choice(["idiot", "Idiot!", "scumbag", "losers", "loser"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_scores(spark, documents, clashing):
    rows, labels = corpus()
    odd = [(5000, None), (5001, ""), (5002, "idiot " * 50_000), (5003, "!!"), (None, "idiot loser"), (7, rows[7][1])]
    docs = clashing(documents(*rows, *odd)).drop("tox_score", "tox_predicted")
    table = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None), (8, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, table)
    out = toxicity.scored(docs, model).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r["doc_id"]: r for r in out}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert [r["doc_id"] for r in docs.filter(toxicity.held_out(F.col("doc_id"))).collect() if r["doc_id"] < 5000 and r["doc_id"] != 7] == [i for i in held if i != 7]
    assert not set(model.ids.tolist()) & set(held)
    right = np.mean([got[i]["tox_predicted"] == (i % 7 == 0) for i in held])
    assert right > 0.98
    assert all(0 <= r["tox_score"] <= 1 and r["tox_predicted"] == (r["tox_score"] >= 0.3) for r in out)
    assert got[5000]["tox_score"] == got[5001]["tox_score"] == got[None]["tox_score"] or got[None]["tox_score"] > 0.3
    assert got[5000]["tox_predicted"] == got[5001]["tox_predicted"] == 0 and got[5002]["tox_predicted"] == 1
    assert got[0]["tox_evidence"] and got[5000]["tox_evidence"] == []
    assert toxicity.scored(docs.limit(0), model).count() == 0
    assert {r["tox_score"] for r in toxicity.scored(docs, toxicity.fit(docs, table.limit(0))).collect()} == {0.0}
    again = toxicity.fit(docs, table.filter("toxic = 0"))
    assert {r["tox_predicted"] for r in toxicity.scored(docs, again).collect()} == {0}


def dense_of(model):
    """The examples' vectors, slots by terms."""
    out = np.zeros((model.often.shape[1], len(model.names)))
    for t in range(len(model.names)):
        a, z = model.at[t], model.at[t + 1]
        out[model.slots[a:z], t] = model.weights[a:z]
        if model.place[t] >= 0:
            assert a == z
            out[:, t] = model.often[model.place[t]]
    return out


def test_block_max_search_is_exact(spark, documents):
    rows, labels = corpus(600)
    model = toxicity.fit(documents(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    dense = dense_of(model)
    assert np.allclose(np.sqrt((dense**2).sum(axis=1))[: len(model.ids)], 1) and 0 < len(model.often) < len(model.names)
    rng = np.random.default_rng(0)
    picks = [np.sort(rng.choice(len(model.names), rng.integers(1, 40), replace=False)) for _ in range(300)]
    row, term = np.repeat(np.arange(300), [len(p) for p in picks]), np.concatenate(picks)
    count = rng.integers(1, 9, len(term))
    query = np.zeros((300, len(model.names)))
    query[row, term] = (1 + np.log(count)) * model.idf[term]
    query /= np.sqrt((query**2).sum(axis=1, keepdims=True))
    exact = query @ dense.T
    slots, near = model.searched(row, term, count, 300)
    assert np.allclose(near, -np.sort(-exact, axis=1)[:, : toxicity.NEIGHBOURS], atol=1e-9)
    assert np.allclose(near, np.take_along_axis(exact, slots, 1), atol=1e-9)


def test_query_by_brute_force(spark):
    """op7 over its whole table: idf from class counts, cosines, votes and the calibrated line by plain sums."""
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    label = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs}
    learn = [i for i in docs if label.get(i) is not None and not held[i]]
    words = {i: Counter(w for t in docs[i].replace("\x0b", " ").split() for w in regex.findall(r"\p{L}+", t.lower())) for i in docs}
    toxic = sum(label[i] for i in learn)
    share, idf = toxic / len(learn), {}
    df = [Counter(w for i in learn if label[i] == y for w in words[i]) for y in (0, 1)]
    for w in {w for i in learn for w in words[i]}:
        idf[w] = abs(np.log((df[1][w] + toxicity.SMOOTH * share) / (toxicity.SMOOTH * share)) - np.log((df[0][w] + toxicity.SMOOTH * (1 - share)) / (toxicity.SMOOTH * (1 - share))))

    def vector(i):
        v = {w: (1 + np.log(c)) * idf[w] for w, c in words[i].items() if w in idf}
        norm = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()} if norm else {}

    examples = {i: vector(i) for i in learn}
    model = toxicity.fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, sf).collect()}
    assert got.keys() == docs.keys()
    for i, r in got.items():
        own = vector(i)
        near = sorted(((sum(x * e.get(w, 0) for w, x in own.items()), label[j]) for j, e in examples.items()), reverse=True)[: toxicity.NEIGHBOURS]
        vote = (sum(c * c * y for c, y in near) + 0.5 * share) / (sum(c * c for c, _ in near) + 0.5)
        assert r["score"] == pytest.approx(float(model.score(np.array(vote))), abs=1e-6)
        assert r["held_out"] == held[i] and r["predicted"] == (r["score"] >= 0.3)


def test_held_out_accuracy_on_the_table(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES["op7_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    hit = out[out.predicted == 1]
    assert hit.toxic.mean() > 0.95 and (out[out.toxic == 1].predicted == 1).mean() > 0.85


SOURCES = ["b", "a", None, "B", "é", "hot"]


def mixture(n=400, seed=0):
    rnd = random.Random(seed)
    return [(i, prose(i, rnd.randint(0, 60)), "hot" if i % 3 == 0 else rnd.choice(SOURCES)) for i in range(n)] + [(900, None, "b"), (901, "", "b"), (902, " \x0b ", "a"), (None, "x y", "a"), (903, "\x1c\xa0x", "a"), (5, "repeated row", "a"), (5, "repeated row", "a"), (904, prose(1, 20_000), "é")]


def filled(sizes, weights, epochs=3):
    """Targets by resharing the excess until none is above."""
    total, open_, target = sum(sizes.values()), dict(sizes), {}
    while True:
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > epochs * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(epochs * sizes[s])
            del open_[s]


def test_targets_and_words(spark, documents, clashing):
    rows = mixture()
    docs = clashing(documents(*rows)).repartition(5)
    parts = mixing.mix(docs)
    out = mixing.taken(*parts).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in out:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    named = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(named)}
    want = filled(sizes, weights)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
    for s in sizes:
        assert abs(sum(r["taken"] for r in out if r["source"] == s) - want[s]) <= mixing.PACKET
    assert sum(r["taken"] for r in out) == sum(sizes.values())
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert {r["key"]: r["size"] for r in out}[903] == 1 and {r["key"]: r["size"] for r in out}[902] == 0
    again = mixing.taken(*mixing.mix(docs.repartition(3))).collect()
    key = lambda rs: sorted((str(r["key"]), str(r["source"]), r["size"], r["taken"]) for r in rs)
    assert key(again) == key(out)


def test_order_of_the_mix(spark, documents):
    rows, packets = mixing.mix(documents(*mixture(200, 1)[:-1]))
    got = mixing.ordered(packets).join(rows.select("row_id", "source"), "row_id").orderBy("place").collect()
    place = 0
    for r in got:  # the places are prefix sums of the words, in the order of virtual finish times
        assert r["place"] == place and 0 < r["words"] <= mixing.PACKET
        place += r["words"]
    assert place == sum(r["size"] for r in rows.collect())
    assert [r["virtual_finish"] for r in got] == sorted(r["virtual_finish"] for r in got)
    half = [r for r in got if r["place"] < place / 2]
    for s in {r["source"] for r in got}:  # every stretch of the mix has every source in proportion
        whole, first = (sum(r["words"] for r in x if r["source"] == s) for x in (got, half))
        assert abs(first - whole / 2) <= 2 * mixing.PACKET


def test_served_by_brute_force(spark, documents):
    """The budget's cut of all sources' packets in the order of virtual finish times, over plain lists."""
    docs = documents(*mixture(150, 3))
    rows, packets = mixing.mix(docs, share=0.4)
    rows = rows.collect()
    budget, want = int(sum(r["size"] for r in rows) * 0.4), {}
    queue = []
    for s in {r["source"] for r in rows}:
        at = 0
        for copy in range(3):
            for r in sorted((r for r in rows if r["source"] == s), key=lambda r: (r["row_id"]["range"], r["row_id"]["nth"], r["row_id"]["again"])):
                for k in range(0, r["size"], mixing.PACKET):
                    n = min(mixing.PACKET, r["size"] - k)
                    if at < r["target"]:
                        queue.append(((at + n) / r["target"], s is None, s or "", copy, r["row_id"]["range"], r["row_id"]["nth"], r["row_id"]["again"], k, n, r["row_id"]))
                    at += n
    for *_, n, row in sorted(queue, key=lambda q: q[:3]):
        n = min(n, budget)
        want[row], budget = want.get(row, 0) + n, budget - n
    assert {r["row_id"]: r["taken"] for r in mixing.taken(mixing.mix(docs, share=0.4)[0], packets).collect() if r["taken"]} == {r: n for r, n in want.items() if n}


def test_equal_rows_and_null_keys(spark, documents):
    """A third of all rows are one row, another third have no key."""
    rows = [(None, prose(i, 30), "s") for i in range(60)] + [(7, "one row of five words", "t")] * 60 + [(i, prose(i, 40), "u") for i in range(100, 160)]
    docs = documents(*rows)
    out = mixing.taken(*mixing.mix(docs)).collect()
    assert len(out) == 180 and sum(r["taken"] for r in out) == sum(r["size"] for r in out)
    got = mixing.mixed(docs)
    words = lambda df: df.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0]
    assert words(got) == words(docs)
    assert got.filter("source = 't'").count() >= 60


def test_mixed_rows(spark, documents, clashing):
    docs = clashing(documents(*mixture()))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    served = {}
    for r in mixing.taken(*mixing.mix(docs)).collect():
        served[r["key"], r["source"]] = served.get((r["key"], r["source"]), 0) + r["taken"]
    got, rows = {}, out.collect()
    for r in rows:  # the words returned are those served
        n = len([w for w in (r["text"] or "").translate(dict.fromkeys((9, 10, 11, 12, 13), " ")).split(" ") if w])
        got[r["doc_id"], r["source"]] = got.get((r["doc_id"], r["source"]), 0) + n
        assert r["n_chars"] == (len(r["text"]) if r["text"] is not None else None)
    assert got == {k: n for k, n in served.items() if n or k[0] in (900, 901, 902) or k in got}
    assert sum(r["doc_id"] in (900, 901, 902) for r in rows) == 3
    small = mixing.mixed(docs, share=0.3)
    words = F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)))
    assert small.agg(words).first()[0] == int(docs.agg(words).first()[0] * 0.3)
    assert mixing.mixed(docs.limit(0)).count() == 0
    r, c = mixing.mix(docs.limit(0))
    assert r.count() == c.count() == 0
    empty = mixing.taken(*mixing.mix(documents((1, "", "a"), (2, None, None)))).collect()
    assert sorted((r["key"], r["target"], r["taken"]) for r in empty) == [(1, 0.0, 0), (2, 0.0, 0)]
