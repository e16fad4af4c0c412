"""Each stage of the pipeline on what the stage before it kept."""

from collections import Counter

import corpus_pipeline as pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerflow.llm import mixing
from ledgerflow.llm.common import stored
from ledgerflow.llm.registry import QUERIES
from tests.llm.test_text_dedup import weighted
from tests.llm.words import prose

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        if name != "bpe":
            assert out.columns == columns
        seen[name], docs = (docs, out), out
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    before, after = seen["toxicity"]
    predicted = {r["doc_id"] for r in QUERIES["op7_toxicity"](spark, SF).filter("predicted = 1").collect()}
    assert ids(after) == ids(before) - predicted and predicted
    before, after = seen["near_dedup"]
    assert after.count() == len(ids(after)) <= before.count()
    texts = Counter(r[0] for r in after.select("text").collect())
    assert max(texts.values()) == 1 and set(texts) == {r[0] for r in before.select("text").collect()} & set(texts)
    # one document of each group that brute force finds
    rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
    label = {i: i for i, _ in rows}
    links, changed = [(rows[a][0], rows[b][0]) for a, b in weighted(spark, rows)], True
    while changed:
        changed = False
        for a, b in links:
            m = min(label[a], label[b])
            changed |= label[a] != m or label[b] != m
            label[a] = label[b] = m
    assert ids(after) == {i for i, m in label.items() if i == m}
    before, after = seen["substring_dedup"]
    assert ids(after) == ids(before)
    # what is left shares no long passage, what went did
    text = lambda df: {r["doc_id"]: (r["text"] or "").split() for r in df.select("doc_id", "text").collect()}
    old, new = text(before), text(after)
    holders = lambda texts, n: Counter(w for t in texts.values() for w in {tuple(t[k : k + n]) for k in range(len(t) - n + 1)})
    assert max(holders(new, 80).values(), default=1) == 1
    inner = Counter(tuple(t[k : k + 8]) for t in old.values() for k in range(len(t) - 7))
    for i, t in old.items():
        if new[i] != t:
            assert any(inner[tuple(t[k : k + 8])] > 1 for k in range(len(t) - 7)), i
    assert after.filter(F.length("text") != F.col("n_chars")).count() == before.filter(F.length("text") != F.col("n_chars")).count()
    before, after = seen["mixing"]
    assert ids(after) <= ids(before) and after.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    words = F.sum(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)))
    assert after.agg(words).first()[0] == before.agg(words).first()[0]
    before, after = seen["bpe"]
    texts = {}
    for r in before.select("doc_id", "text").collect():
        texts.setdefault(r["doc_id"], []).append(r["text"] or "")
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    got = {}
    for r in after.collect():
        got.setdefault(r["doc_id"], []).append(list(r["ids"]))
    for i, own in texts.items():
        assert sorted(got[i]) == sorted(e.ids for e in library.encode_batch(own, add_special_tokens=False))
    assert after.count() == before.count() and after.filter("size(ids) <> n_tokens").count() == 0


def test_stages_take_odd_tables(spark, documents):
    odd = documents((1, None), (2, ""), (None, prose(1, 30)), (3, prose(2, 40), None), (3, prose(2, 40), None), (4, "word " * 50_000, "a"))
    for docs in (odd, odd.limit(0)):
        for name, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), name)
    assert pipeline.ORACLE_SQL is None


def test_texts_that_share_an_id_stay(spark, documents):
    rows = [(1, prose(1, 80)), (1, prose(2, 80)), (1, prose(1, 80)), (2, prose(2, 80)), (3, prose(3, 80)), (4, prose(1, 80)), (5, None), (None, prose(3, 80))]
    out = pipeline.drop_near_duplicates(spark, documents(*rows), SF)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted([(1, prose(1, 80)), (1, prose(2, 80)), (3, prose(3, 80)), (5, None), (None, prose(3, 80))], key=str)
