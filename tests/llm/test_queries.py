"""The registered queries on a whole table against brute force."""

import hashlib
import html
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerflow.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)] and set(ORACLE_SQL) == {"op4_url_filter", "op8_mixing"} and all(isinstance(s, str) for s in ORACLE_SQL.values())


def test_bpe(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in QUERIES["op9_bpe"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids
        own = got[r["doc_id"]]
        assert own["n_tokens"] == len(ids) and own["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_html(spark):
    got = {r["page_id"]: r["text"] for r in QUERIES["op3_html_text"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", article)]
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)


def windows(text, n):
    w = text.split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def test_substrings(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_substring_dedup"](spark, SF).collect()
    before, after = (Counter(w for t in x for w in windows(t, 50)) for x in (texts.values(), [r["text"] for r in rows]))
    twice = lambda c: sum(v > 1 for w, v in c.items() if len(set(w)) > 10)
    assert twice(before) > 100 and twice(after) == 0
    shared = Counter(w for t in texts.values() for w in windows(t, 10))
    for r in rows:
        own = texts[r["doc_id"]]
        assert len(own) - len(r["text"]) == r["n_removed"]
        if len(own.split()) >= 10 and all(shared[w] == 1 for w in windows(own, 10)):
            assert r["n_removed"] == 0 or len(set(own.split())) < len(own.split()) / 2


def test_near_duplicates(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: r["class_id"] for r in QUERIES["op5_near_duplicates"](spark, SF).collect()}
    s = {i: windows(t, 5) or {tuple(t.split())} for i, t in texts.items()}
    holders, both = defaultdict(list), Counter()
    for i, x in s.items():
        for w in x:
            for j in holders[w]:
                both[i, j] += 1
            holders[w].append(i)
    alike = {p: n / (len(s[p[0]]) + len(s[p[1]]) - n) for p, n in both.items()}
    for (i, j), x in alike.items():
        if x >= 0.84:
            assert got[i] == got[j], (i, j, x)
    linked = defaultdict(set)
    for (i, j), x in alike.items():
        if x >= 0.76:
            linked[i].add(j)
            linked[j].add(i)
    for i, c in got.items():
        assert i == c or linked[i] or sum(t == texts[i] for t in texts.values()) > 1


def test_vectors(spark):
    table = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = np.array(sorted(table))
    u = np.stack([table[i] for i in ids])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    n = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in QUERIES["op6_embedding_dedup"](spark, SF).collect()}
    assert [got[i] for i in ids] == n.tolist()
