"""Token files and BPE against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerflow.llm import bpe, token_files
from ledgerflow.llm.common import fresh_path
from ledgerflow.llm.registry import QUERIES
from tests.llm.words import prose

POOL = ["<|endoftext|>", " ", "\n", "\t", "  ", "'s", "don't", "İ", "ǅ", "é", "e\u0301", "你好", "😀", "\xa0", "\x1c", "\0", "0", "123", "!!!", "a", "The", " the", "zzzqqq", "\u200b", "ß", "A.", "b,", "Ω", "<|startoftext|>"]


def hard(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(POOL) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


TEXTS = [*hard(1, 400), "", None, "x" * 5000, "ab" * 3000, " " * 300, prose(1, 40_000), "same text", "same text"]


def library(name, texts):
    return [e.ids for e in Tokenizer.from_file(public_tokenizers.path(name)).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_token_files(spark, documents, clashing):
    docs = documents(*((1000 - i, t) for i, t in enumerate(TEXTS)), (None, "no id"), (500, "second of one id"))
    where = fresh_path(spark, "tokens")
    manifest = token_files.write(clashing(docs).repartition(5), public_tokenizers.path("word_bpe_49k.json"), where, vocabulary=49_408)
    rows = token_files.read(spark, where, manifest).collect()
    rows = sorted(rows, key=lambda r: r["start"])
    order = [r["key"] for r in rows]
    assert order[0] is None and order[1:] == sorted(order[1:]) and len(rows) == len(TEXTS) + 2
    ids = dict(zip((1000 - i for i in range(len(TEXTS))), library("word_bpe_49k.json", TEXTS), strict=True))
    start = 0
    for r in rows:
        assert r["start"] == start
        start += r["n_tokens"]
        if r["key"] is not None and r["key"] != 500:
            assert r["n_tokens"] == len(ids[r["key"]]) + 1 and r["ids_crc32"] == zlib.crc32(raw([*ids[r["key"]], 2]))
    assert sum(s["n_tokens"] for s in manifest) == start and all(s["width"] == 2 for s in manifest)
    assert np.array_equal(np.cumsum([0] + [s["n_tokens"] for s in manifest])[:-1], [s["base"] for s in manifest])


def test_token_files_of_any_tokenizer(spark, documents):
    """A tokenizer that looks across white space gets whole texts."""
    where, path = fresh_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json")
    assert token_files.by_words(public_tokenizers.path("word_bpe_49k.json")) and not token_files.by_words(path)
    manifest = token_files.write(documents(*enumerate(TEXTS)).repartition(3), path, where, end_id=50_256)
    got = {r["key"]: (r["n_tokens"], r["ids_crc32"]) for r in token_files.read(spark, where, manifest).collect()}
    assert got == {i: (len(x) + 1, zlib.crc32(raw([*x, 50_256]))) for i, x in enumerate(library("byte_bpe_50k.json", TEXTS))}
    with pytest.raises(TypeError):
        token_files.write(documents((1, "a")).selectExpr("string(doc_id) AS doc_id", "text"), path, where)


def test_token_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got, start = {r["doc_id"]: r for r in QUERIES["op1_token_files"](spark, sf).collect()}, 0
    assert len(got) == len(docs)
    for (i, _), ids in zip(docs, library("word_bpe_49k.json", [t for _, t in docs]), strict=True):
        ids = [*ids, 2]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(raw(ids)))
        start += len(ids)


def test_token_files_wide_and_empty(spark, documents):
    where = fresh_path(spark, "tokens")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = token_files.write(documents((1, "a b c")), path, where, vocabulary=1 << 17)
    assert manifest[0]["width"] == 4 and token_files.read(spark, where, manifest).first()["n_tokens"] == 4
    assert token_files.write(documents((1, "a")).limit(0), path, where, vocabulary=10) == []
    assert token_files.read(spark, where, []).count() == 0


def test_bpe_is_the_librarys(spark, documents, clashing):
    docs = clashing(documents(*enumerate(TEXTS)))
    path = public_tokenizers.path("byte_bpe_50k.json")
    lexicon = bpe.fit_lexicon(docs, path, fresh_path(spark, "lexicon"))
    rows = {r["doc_id"]: r for r in bpe.encode_column(docs, path, lexicon).collect()}
    t = Tokenizer.from_file(path)
    for i, ids in enumerate(library("byte_bpe_50k.json", TEXTS)):
        text = t.decode(ids, skip_special_tokens=False)
        assert rows[i]["ids"] == ids and rows[i]["n_tokens"] == len(ids) and rows[i]["decoded"] == text, TEXTS[i]
        assert rows[i]["ids_sha256"] == hashlib.sha256(raw(ids)).hexdigest() and rows[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_column(docs.limit(0), path, lexicon).count() == 0


def test_transducer_is_minimal_and_exact():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["walking", "talking", "walks", "talks", "walk", "talk", "", "é"])}
    t = bpe.Transducer.compile(words)
    every = [*words, b"wal", b"walkin", b"walkings", b"x"]
    off = np.concatenate([[0], np.cumsum([len(w) for w in every])])
    found = t.find(off, np.frombuffer(b"".join(every), np.uint8))
    assert [t.ids[t.offset[f] : t.offset[f + 1]].tolist() if f >= 0 else None for f in found] == [*words.values(), None, None, None, None]
    assert len(t.final) < sum(map(len, words)) // 2  # suffixes are shared
    assert bpe.Transducer.compile({}).find(np.array([0, 1]), np.frombuffer(b"a", np.uint8)).tolist() == [-1]


def test_decoding_of_broken_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    codec, t = bpe.Codec(path, bpe.Transducer.compile({})), Tokenizer.from_file(path)
    off, ids = codec.encode(["é😀"])
    cut = ids[: len(ids) - 1]
    assert codec.decode(np.array([0, len(cut)]), cut)[0].decode() == t.decode(cut.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("name", ["op1_token_files", "op9_bpe"])
def test_queries_run(spark, name):
    from ledgerflow.llm.registry import QUERIES

    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() == 200
