"""Properties over arbitrary texts."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from ledgerflow.llm import bpe, html_text, near_text, substrings, token_files
from ledgerflow.llm.common import laid, sliced, utf8_bytes, words

TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("ab \n<|endoftext|>é.,'s1\0", max_size=80)
TEXTS = st.lists(TEXT, min_size=1, max_size=6)
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
codec, encoder = bpe.Codec(BYTE, bpe.Transducer.compile({b" the": [262], b"ab": [397]})), token_files.WordEncoder(WORD)
IDF = np.linspace(1, 2, 2 * near_text.BUCKETS).astype(np.float32).reshape(2, -1)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encoders_equal_the_library(texts):
    off, ids = codec.encode(texts)
    decoded = codec.decode(off, ids)
    for i, e in enumerate(byte.encode_batch(texts, add_special_tokens=False)):
        assert ids[off[i] : off[i + 1]].tolist() == e.ids and decoded[i].decode() == byte.decode(e.ids, skip_special_tokens=False)
    off, ids = encoder(pa.array(texts), 2)
    for i, e in enumerate(word.encode_batch(texts, add_special_tokens=False)):
        assert ids[off[i] : off[i + 1]].tolist() == [*e.ids, 2]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_chunks_and_words_cover_their_texts(texts):
    off, data = utf8_bytes(pa.array(texts))
    start, end, row, _ = substrings.chunks(off, data)
    for i, t in enumerate(texts):
        assert "".join(data[a:b].tobytes().decode() for a, b in zip(start[row == i], end[row == i], strict=True)) == t
    start, end, row = words(off, data)
    for i, t in enumerate(texts):
        got = [data[a:b].tobytes().decode() for a, b in zip(start[row == i], end[row == i], strict=True)]
        assert got == [w for w in __import__("re").split("[ \t-\r]+", t) if w]


@settings(max_examples=200, deadline=None)
@given(TEXTS, TEXTS)
def test_similarity_bounds(a, b):
    n = min(len(a), len(b))
    x, y = pa.array(a[:n]), pa.array(b[:n])
    s = near_text.similarities(x, y, IDF)
    assert ((s >= 0) & (s <= 1 + 1e-9)).all() and np.allclose(s, near_text.similarities(y, x, IDF))
    own = near_text.similarities(x, x, IDF)
    assert all(v == 0 if not t.strip(" \t\n\x0b\x0c\r") else abs(v - 1) < 1e-6 for v, t in zip(own, a[:n], strict=True))


@settings(max_examples=200, deadline=None)
@given(st.text("<>/abpdivhlinka='\" \n&;!-", max_size=200) | TEXT)
def test_any_markup_can_be_scanned(text):
    page = html_text.parsed(text)
    assert len(page.texts) == len(page.inside) == len(page.dropped) == len(page.linked) and all(t == t.strip() and t for t in page.texts)


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 50))
def test_slices_cover_a_batch(texts, limit):
    batch = pa.RecordBatch.from_arrays([pa.array([*texts, None])], ["text"])
    assert [t for part in sliced(batch, "text", limit) for t in part.column("text").to_pylist()] == [*texts, None]


def test_laid():
    flat = np.arange(10)
    assert laid(flat, np.array([3, 0, 9]), np.array([2, 0, 1])).tolist() == [3, 4, 9] and len(laid(flat, np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
