"""Substring and near-duplicate removal against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerflow.llm import near_text, substrings
from ledgerflow.llm.common import utf8_bytes, words
from tests.llm.words import prose


def test_chunks_cover_texts_and_find_step_again():
    texts = ["", "a", prose(1, 500), "x" * 10_000, "".join(map(chr, random.Random(1).choices(range(0x4E00, 0x5000), k=2000))), " ".join(["é"] * 300), "  \n " * 50, prose(2, 3)]
    off, data = utf8_bytes(pa.array(texts))
    start, end, row, digest = substrings.chunks(off, data)
    for i, t in enumerate(texts):
        own = row == i
        pieces = [data[a:b].tobytes().decode() for a, b in zip(start[own], end[own], strict=True)]  # no character is cut
        assert "".join(pieces) == t
    # a text's chunks don't depend on its neighbours, and equal stretches have equal chunks whatever stands before
    alone = substrings.chunks(*utf8_bytes(pa.array([texts[2]])))
    assert digest[row == 2].tolist() == alone[3].tolist()
    shifted = substrings.chunks(*utf8_bytes(pa.array(["inserted words " + texts[2]])))
    assert len(set(alone[3].tolist()) - set(shifted[3].tolist())) <= 3
    assert len(row[row == 4]) > 5  # no white space: still cut


def test_passages_go_from_all_but_one(spark, documents, clashing):
    rnd = random.Random(5)
    passage, other = prose(100, 60, 10**6), prose(101, 300, 10**6)
    rows, clean = [], set()
    for i in range(300):
        parts = [prose(1000 + i, rnd.randint(5, 200), 10**6)]
        if i % 10 == 3:
            parts.insert(rnd.randint(0, 1), passage)
        if i % 50 == 7:
            parts.insert(1, other)
        if i % 10 != 3 and i % 50 != 7:
            clean.add(i)
        rows.append((i, " ".join(parts)))
    rows += [(1000, None), (1001, ""), (None, prose(77, 50)), (1002, "copy " + prose(5, 90, 10**6)), (1003, "copy " + prose(5, 90, 10**6)), (1004, "word " * 100_000)]
    out = substrings.deduplicated(clashing(documents(*rows)).drop("n_removed").repartition(7)).collect()
    got = {r["doc_id"]: r for r in out}
    assert len(out) == len(rows)
    assert all(got[i]["text"] == dict(rows)[i] and got[i]["n_removed"] == 0 for i in clean)
    left = lambda p, n=20: [i for i in got if got[i]["text"] and any(" ".join(p.split()[k : k + n]) in got[i]["text"] for k in range(len(p.split()) - n + 1))]
    assert left(passage) == [3] and left(other) == [7]
    for i in range(13, 300, 10):  # what stands around a passage stays
        kept, own = got[i]["text"], prose(1000 + i, len(dict(rows)[i].split()) - 60, 10**6)
        assert len(kept.split()) >= len(own.split()) and len(kept.split()) <= len(own.split()) + 40
    assert got[1000]["text"] is None and got[1001]["text"] == "" and got[1000]["n_removed"] == 0
    assert got[None]["text"] == prose(77, 50)
    assert got[1002]["n_removed"] == 0 and len(got[1003]["text"].split()) < 20
    assert all(r["n_removed"] == len(dict(rows)[r["doc_id"]] or "") - len(r["text"] or "") for r in out)
    empty = substrings.deduplicated(documents(*rows).limit(0))
    assert empty.count() == 0 and empty.columns[-1] == "n_removed"


def test_passages_without_white_space_go(spark, documents):
    rnd = random.Random(8)
    script = lambda n: "".join(map(chr, rnd.choices(range(0x4E00, 0x5E00), k=n)))
    rows, lengths = [], {}
    for i in range(160):
        passage, n = script(size := (60, 80, 100, 150)[i % 4]), rnd.randint(40, 400)
        rows += [(2 * i, script(n) + passage + script(100)), (2 * i + 1, script(rnd.randint(40, 400)) + passage + script(80))]
        lengths[2 * i + 1] = size
    rows.append((1000, script(300)))
    got = {r["doc_id"]: r["n_removed"] for r in substrings.deduplicated(documents(*rows).repartition(3)).collect()}
    assert all(n == 0 for i, n in got.items() if i not in lengths)
    found = {size: [got[i] for i in lengths if lengths[i] == size] for size in (60, 80, 100, 150)}
    caught = {size: sum(n > 0 for n in found[size]) / len(found[size]) for size in found}
    assert caught[100] >= 0.95 and caught[150] == 1 and caught[80] >= 0.8 and caught[60] >= 0.4, caught
    assert all(n <= size for size in found for n in found[size]) and sum(found[150]) / 40 > 120


def test_unspaced_chunks_have_a_longest():
    for text in ("x" * 10_000, "字" * 5000, "word " * 50 + "字" * 5000):
        start, end, _, _ = substrings.chunks(*utf8_bytes(pa.array([text])))
        assert (end - start).max() <= substrings.MOST + 66


def test_chunks_of_different_documents_are_no_passage(spark, documents):
    """A text of pieces that each stand in another document holds no repeated passage; rows without a key are documents."""
    rnd, rows = random.Random(9), []
    pieces = [prose(300 + i, 6, 10**6) for i in range(60)]  # two in a row are no passage
    for i, p in enumerate(pieces):
        rows.append((i, f"{prose(500 + i, 60, 10**6)} {p} {prose(700 + i, 60, 10**6)}"))
    rows += [(100 + k, " ".join(rnd.sample(pieces, 30))) for k in range(20)]
    passage = prose(1, 100, 10**6)
    rows += [(None, f"{prose(2, 50, 10**6)} {passage}"), (None, f"{prose(3, 50, 10**6)} {passage}"), (None, f"{prose(4, 50, 10**6)} {passage}"), (200, "again " * 3000), (201, "again " * 5000)]
    got = substrings.deduplicated(documents(*rows).repartition(4)).collect()
    cut = {r["doc_id"]: r["n_removed"] for r in got if r["n_removed"]}
    assert not [i for i in cut if i is not None and i < 120], cut
    assert sorted(r["n_removed"] > 500 for r in got if r["doc_id"] is None) == [False, True, True]
    assert cut[200] > 16_800 and cut[201] > 29_000
    with pytest.raises(TypeError):
        substrings.deduplicated(documents(*rows).selectExpr("string(doc_id) AS doc_id", "text"))


def test_repeated_rows_are_one_document(spark, documents):
    d = documents((1, prose(1, 100)), (1, prose(1, 100)), (1, prose(2, 100)), (2, prose(2, 100)))
    got = sorted((r["doc_id"], r["n_removed"] > 0) for r in substrings.deduplicated(d).collect())
    assert got == [(1, False)] * 3 + [(2, True)]


def near(text, share, seed):
    rnd = random.Random(seed)
    w = text.split()
    for i in rnd.sample(range(len(w)), max(1, int(len(w) * share))):
        w[i] = f"n{rnd.randrange(10**6)}"
    return " ".join(w)


def weighted(spark, rows):
    """All links by brute force."""
    texts = [t or "" for _, t in rows]
    idf = near_text.idf_of(near_text.word_frequencies(spark.createDataFrame([(t,) for t in texts], "text string")), len([i for i, _ in rows if i is not None]))
    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i)]
    out = []
    for at in range(0, len(pairs), 20_000):
        part = pairs[at : at + 20_000]
        s = near_text.similarities(pa.array([texts[i] for i, _ in part]), pa.array([texts[j] for _, j in part]), idf)
        out += [p for p, x in zip(part, s, strict=True) if x >= 0.8 or texts[p[0]] == texts[p[1]]]
    return out


def test_near_copies_share_a_class(spark, documents, clashing):
    rnd = random.Random(6)
    rows = [(i, prose(i, rnd.randint(1, 150))) for i in range(60)]
    base = prose(500, 300)
    rows += [(100 + i, near(base, rnd.uniform(0.002, 0.06), i)) for i in range(60)] + [(99, base)]  # many copies of one original, of each other less alike
    chain = prose(600, 200)
    for i in range(12):
        rows.append((200 + i, chain))
        chain = near(chain, 0.01, 900 + i)
    rows += [(300 + i, rows[5][1]) for i in range(5)] + [(400, ""), (401, None), (402, " \n"), (403, "one"), (404, "one"), (405, "long " * 100_000), (300, rows[5][1])]
    got = {r["id"]: r["class_id"] for r in near_text.classes(clashing(documents(*rows)).repartition(5)).collect()}
    by = {}
    for i, t in rows:
        by.setdefault(i, t)
    ids = list(by)
    label = {i: i for i in ids}
    links = [(ids[a], ids[b]) for a, b in weighted(spark, list(by.items()))]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    wrong = [i for i in ids if got[i] != label[i]]
    assert not wrong
    assert got[304] == 5 and got[400] == got[401] == 400 and got[402] == 402 and got[404] == 403
    assert near_text.classes(documents(*rows).limit(0)).count() == 0
    assert [tuple(r) for r in near_text.classes(documents((None, "a"), (None, None))).collect()] == [(None, None)] * 2


def test_keys_with_several_texts(spark, documents):
    """Rows with one key are one document with one class, which its texts share; keys of another type are an error."""
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    docs = documents((1, a), (1, b), (2, b), (3, c), (0, near(a, 0.005, 1)), (5, c), (5, near(c, 0.005, 2)), (6, near(c, 0.005, 2)), (7, prose(9, 80)))
    got = [tuple(r) for r in near_text.classes(docs).collect()]
    assert sorted(got) == [(0, 0), (1, 0), (2, 0), (3, 3), (5, 3), (6, 3), (7, 7)]
    with pytest.raises(TypeError):
        near_text.classes(docs.withColumn("doc_id", docs.doc_id.cast("string")))


def test_matrix_of_similarities():
    idf = np.linspace(1, 2, 2 * near_text.BUCKETS).astype(np.float32).reshape(2, -1)
    base = prose(1, 120, 60)
    a = pa.array([near(base, 0.02 * i, i) for i in range(12)] + ["", None, "one two", "a b c d e " * 40])
    b = pa.array([near(base, 0.03 * i, 50 + i) for i in range(9)] + ["a b c d e " * 30, "one two", "", "x"])
    got = near_text.similar(a, b, idf)
    i, j = np.divmod(np.arange(len(a) * len(b)), len(b))
    assert np.allclose(got.ravel(), near_text.similarities(a.take(pa.array(i)), b.take(pa.array(j)), idf), atol=1e-12)


def test_the_sketch_counts_words(spark):
    texts = [prose(i, 100, 5000) + " everywhere" for i in range(400)]
    sketch = near_text.word_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    df = Counter(w for t in texts for w in set(t.split()))
    names = sorted(df)
    h, _ = near_text._word_table(pa.array(names))
    got = np.minimum(*(sketch[i][at] for i, at in enumerate(near_text._counters(h))))
    want = np.array([df[w] for w in names])
    assert (got >= want).all() and (got == want).mean() > 0.99


def template_family(pairs, seed=70):
    """Texts over one template, below 0.8 with it and with each other, but for the pairs of two copies."""
    template, rows = prose(seed, 300), []
    for i in range(pairs):
        x = near(template, 0.033, seed * 1000 + i)
        rows += [(2 * i + 1, x), (2 * i + 2, near(x, 0.017, seed * 2000 + i))]
    return [(0, template), *rows]


def test_pairs_over_a_template_are_found(spark, documents, monkeypatch):
    rows = template_family(150)
    label = {i: i for i, _ in rows}
    links = sorted((rows[b][0], rows[a][0]) for a, b in weighted(spark, rows))
    assert len(links) > 100
    for _ in rows:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    monkeypatch.setattr(near_text, "BLOCK", 32)  # many blocks to a bucket
    got = {r["id"]: r["class_id"] for r in near_text.classes(documents(*rows)).collect()}
    assert len(set(label.values())) > 50 and got == label


def test_similarity_is_weighted_jaccard():
    idf = np.linspace(1, 2, 2 * near_text.BUCKETS).astype(np.float32).reshape(2, -1)
    a, b = "a b c d e f g a b c d e", "a b c d e f x"

    def weights(t):
        w = t.split()
        out = defaultdict(float)
        h, _ = near_text._word_table(pa.array([t]))
        for i in range(len(w) - 4):
            out[tuple(w[i : i + 5])] += float(np.mean([max(idf[0][at[0]], idf[1][at[1]]) for x in h[i : i + 5] for at in [near_text._counters(x)]]))
        return out

    x, y = weights(a), weights(b)
    want = sum(min(x[k], y[k]) for k in x.keys() | y.keys()) / sum(max(x[k], y[k]) for k in x.keys() | y.keys())
    assert abs(near_text.similarities(pa.array([a]), pa.array([b]), idf)[0] - want) < 1e-6


def test_samples_agree_as_often_as_weights_do():
    idf = np.full((2, near_text.BUCKETS), 1.5, np.float32)
    base = [prose(i, 200) for i in range(300)]
    other = [near(t, 0.03, i) for i, t in enumerate(base)]
    s = near_text.similarities(pa.array(base), pa.array(other), idf)
    sign = [near_text.signatures(300, *near_text.shingles(pa.array(x), idf)) for x in (base, other)]
    assert abs((sign[0] == sign[1]).mean() - s.mean()) < 0.02


def test_words():
    off, data = utf8_bytes(pa.array(["a bc", "", None, "\tdé\x0b "]))
    start, end, row = words(off, data)
    assert [data[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)] == ["a", "bc", "dé"] and row.tolist() == [0, 0, 3]
