"""BPE encoding and decoding with a minimal acyclic transducer as lexicon of the frequent words.

Frequent words with their ids are compiled into a minimal automaton that shares prefixes and suffixes; its arcs carry
numbers whose sum along a word is the word's place in a table of id lists. The automaton is one memory-mapped file.
Words that it hasn't are merged exactly, pair by pair."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyarrow import compute as pc, fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fresh_path, laid, sliced, spread, stored, table, tidy

#: Words of the lexicon, and different words that a task counts at a time.
LEXICON_WORDS, COUNTED_WORDS = 1 << 15, 1 << 17
#: How texts are cut to words (the published pattern of byte-level BPE).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Words of more bytes are merged one by one.
WIDE = 48
BIG = np.int32(2**31 - 1)


class Merges:
    """Vocabulary, merge ranks and exact merging."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model, vocab = spec["model"], spec["model"]["vocab"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        symbol, extra = {b: chr(b) for b in printable}, 0
        for b in range(256):
            if b not in symbol:
                symbol[b], extra = chr(256 + extra), extra + 1
        back = {c: b for b, c in symbol.items()}
        self.byte_id = np.array([vocab[symbol[b]] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.n = max(max(vocab.values()), *(t["id"] for t in spec["added_tokens"]), 0) + 1
        rank = {}
        for i, (a, b) in enumerate(pairs):
            rank[vocab[a] * self.n + vocab[b]] = (i, vocab[a + b])
        self.pair = np.array(sorted(rank), np.int64)
        self.rank = np.array([rank[k][0] for k in self.pair.tolist()], np.int32)
        self.made = np.empty(len(pairs), np.int32)
        for i, m in rank.values():
            self.made[i] = m
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.piece = [b""] * self.n
        for t, i in vocab.items():
            self.piece[i] = bytes(back[c] for c in t)
        for t, i in self.special.items():
            self.piece[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.n + b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where((self.pair[at] == key) & (a >= 0) & (b >= 0), self.rank[at], BIG)

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: in every step the leftmost pair of the lowest rank of each word becomes one."""
        out: list = [None] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        for lo, hi in ((0, 4), (4, 8), (8, 12), (12, 18), (18, 28), (28, WIDE)):
            own = np.flatnonzero((size > lo) & (size <= hi))
            for at in range(0, len(own), 20_000):
                part = own[at : at + 20_000]
                for i, ids in zip(part.tolist(), self._matrix([words[i] for i in part], hi), strict=True):
                    out[i] = ids
        for i in np.flatnonzero(size > WIDE):
            out[i] = self._long(words[i])
        return [x if x is not None else [] for x in out]

    def _matrix(self, words: list[bytes], width: int) -> list[list[int]]:
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        n = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.where(np.arange(width) < n[:, None], self.byte_id[raw], np.int32(-1))
        ranks = np.full((len(words), width), BIG, np.int32)
        if width > 1:
            ranks[:, :-1] = self.ranks(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(words))
        columns = np.arange(width)
        while len(row):
            j = ranks[row].argmin(axis=1)
            best = ranks[row, j]
            row, j, best = row[best < BIG], j[best < BIG], best[best < BIG]
            if not len(row):
                break
            source = np.minimum(columns + (columns > j[:, None]), width - 1)
            x = np.take_along_axis(ids[row], source, 1)
            x[:, -1] = -1
            x[np.arange(len(row)), j] = self.made[best]
            y = np.take_along_axis(ranks[row], source, 1)
            y[:, -1] = BIG
            k, left, right = np.arange(len(row)), np.maximum(j - 1, 0), np.minimum(j + 1, width - 1)
            y[k, j] = np.where(j < width - 1, self.ranks(x[k, j], x[k, right]), BIG)
            y[k, left] = np.where(j > 0, self.ranks(x[k, left], x[k, j]), y[k, left])
            ids[row], ranks[row] = x, y
            n[row] -= 1
        return [r[:m].tolist() for r, m in zip(ids, n.tolist(), strict=True)]

    def _long(self, word: bytes) -> list[int]:
        """The same by a heap over a linked list, for words of any length."""
        import heapq

        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        first = self.ranks(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r < BIG]
        heapq.heapify(heap)
        lookup = self.__dict__.setdefault("_dict", dict(zip(self.pair.tolist(), self.rank.tolist(), strict=True)))
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.made[r]), -2
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r2 := lookup.get(ids[x] * self.n + ids[y])) is not None:
                    heapq.heappush(heap, (r2, x, ids[x], ids[y]))
        return [x for x in ids if x != -2]


class Transducer:
    """A minimal acyclic transducer from words (bytes) to id lists, laid out in flat arrays."""

    NAMES = ("key", "target", "number", "final", "offset", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.__dict__.update(arrays)

    @classmethod
    def compile(cls, lexicon: dict[bytes, list[int]]) -> Transducer:
        """Words go in sorted order; a state that can't change any more is replaced by an equal one if there is any."""
        nodes, register = [{}], {}  # a node: arcs byte -> node
        finals = [False]
        path: list[tuple[int, int, int]] = []  # parent, byte, child

        def close(depth: int) -> None:
            while len(path) > depth:
                parent, byte, child = path.pop()
                sign = (finals[child], *nodes[child].items())
                nodes[parent][byte] = register.setdefault(sign, child)

        words, last = sorted(lexicon), b""
        for w in words:
            same = next((i for i, (a, b) in enumerate(zip(w, last, strict=False)) if a != b), min(len(w), len(last)))
            close(same)
            at = path[-1][2] if path else 0
            for byte in w[same:]:
                nodes.append({})
                finals.append(False)
                nodes[at][byte] = len(nodes) - 1
                path.append((at, byte, len(nodes) - 1))
                at = len(nodes) - 1
            finals[at], last = True, w
        close(0)
        order, new = [], {0: 0}
        stack = [0]
        while stack:  # states that are in use, numbered anew
            s = stack.pop()
            order.append(s)
            for t in nodes[s].values():
                if t not in new:
                    new[t] = len(new)
                    stack.append(t)
        below: dict[int, int] = {}

        def words_from(s: int) -> int:
            todo = [s]
            while todo:
                x = todo[-1]
                missing = [t for t in nodes[x].values() if t not in below]
                if missing:
                    todo.extend(missing)
                else:
                    below[x] = finals[x] + sum(below[t] for t in nodes[x].values())
                    todo.pop()
            return below[s]

        words_from(0)
        key, target, number, final = [], [], [], np.zeros(len(new), bool)
        for s in order:
            final[new[s]] = finals[s]
            skipped = int(finals[s])
            for byte, t in sorted(nodes[s].items()):
                key.append(new[s] * 256 + byte)
                target.append(new[t])
                number.append(skipped)
                skipped += below[t]
        by = np.argsort(np.array(key, np.int64))
        size = np.array([len(lexicon[w]) for w in words], np.int64)
        return cls({"key": np.array(key, np.int64)[by], "target": np.array(target, np.int64)[by], "number": np.array(number, np.int64)[by], "final": final.astype(np.int64), "offset": np.concatenate([[0], np.cumsum(size)]).astype(np.int64), "ids": np.array([i for w in words for i in lexicon[w]], np.int64)})

    def save(self, where: str) -> None:
        """One file: six lengths, then the arrays, all little-endian int64."""
        there, path = fs.FileSystem.from_uri(where)
        there.create_dir(path.rpartition("/")[0], recursive=True)
        with there.open_output_stream(path) as f:
            f.write(np.array([len(getattr(self, n)) for n in self.NAMES], "<i8").tobytes())
            for n in self.NAMES:
                f.write(getattr(self, n).astype("<i8").tobytes())

    @classmethod
    def load(cls, where: str) -> Transducer:
        there, path = fs.FileSystem.from_uri(where)
        if isinstance(there, fs.LocalFileSystem):
            data = np.memmap(path, "<i8", "r")
        else:
            with there.open_input_file(path) as f:
                data = np.frombuffer(f.read(), "<i8")
        ends = 6 + np.cumsum(data[:6])
        return cls({n: data[e - s : e] for n, s, e in zip(cls.NAMES, data[:6], ends, strict=True)})

    def find(self, off: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The place of each word (laid end to end) in the table of id lists, or -1; all words step together."""
        n = np.diff(off)
        place, state = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
        alive = np.arange(len(n)) if len(self.key) else np.zeros(0, np.int64)
        out, at = np.full(len(n), -1, np.int64), 0
        while len(alive):
            done = n[alive] == at
            ended = alive[done]
            ended = ended[self.final[state[ended]] == 1]
            out[ended] = place[ended]
            alive = alive[~done]
            key = state[alive] * 256 + data[off[alive] + at]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            ok = self.key[arc] == key
            alive, arc = alive[ok], arc[ok]
            state[alive] = self.target[arc]
            place[alive] += self.number[arc]
            at += 1
        return out


def frequent_words(docs: DataFrame, text: str = "text", most: int = LEXICON_WORDS) -> list[str]:
    """About the `most` words (as the pattern cuts them) that are most frequent over all texts. Counting is lossy (a task that has
    COUNTED_WORDS different ones forgets the rarest half), which no result depends on: the lexicon only saves merging."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = pa.array([], pa.string()), np.zeros(0, np.int64)
        for batch in batches:
            for part in sliced(batch, text, 16 << 20):
                seen = pc.value_counts(pc.ascii_split_whitespace(pc.fill_null(part.column(text), "")).flatten())
                both = pa.chunked_array([held, seen.field("values")]).combine_chunks().dictionary_encode()
                n = np.bincount(both.indices.to_numpy(zero_copy_only=False), np.concatenate([count, seen.field("counts").to_numpy(zero_copy_only=False)]), len(both.dictionary)).astype(np.int64)
                best = np.sort(np.argpartition(-n, COUNTED_WORDS // 2)[: COUNTED_WORDS // 2]) if len(n) > COUNTED_WORDS else np.arange(len(n))
                held, count = both.dictionary.take(pa.array(best)), n[best]
        if len(held):
            yield pa.RecordBatch.from_arrays([held, pa.array(count)], ["word", "n"])

    counted = docs.select(text).mapInArrow(tidy(task), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counted = stored(counted, "word-counts")
    # as many classes of counts, the largest first, as hold `most` words at most: no task sorts them all
    rank, held, least = F.floor(F.log2("n") * 32).cast("int"), 0, None
    for r in counted.groupBy(rank.alias("rank")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("rank").desc()).collect():  # 2048 rows at most
        held += r["n"]
        if held > most:
            break
        least = r["rank"]
    total: dict[str, int] = {}
    for r in counted.filter(rank >= least).collect() if least is not None else []:
        for w in PATTERN.findall(" " + r["word"]):
            total[w] = total.get(w, 0) + r["n"]
    return sorted(total, key=lambda w: (-total[w], w))[:most]


class _Codes(dict):
    """Numbers the words of a slice as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Codec:
    """Encodes and decodes in a worker: Merges and a memory-mapped Transducer."""

    def __init__(self, path: str, lexicon: str | Transducer):
        self.merges = Merges(path)
        self.transducer = Transducer.load(lexicon) if isinstance(lexicon, str) else lexicon
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.merges.special, key=len, reverse=True)))) if self.merges.special else None
        self.piece_size = np.fromiter(map(len, self.merges.piece), np.int64, self.merges.n)
        self.piece_at = np.concatenate([[0], np.cumsum(self.piece_size)])
        self.pieces = np.frombuffer(b"".join(self.merges.piece), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (n + 1) and ids. Special tokens' strings in a text become their ids, as the library does."""
        codes, found, count = _Codes(), [], []
        special = {-1 - i: t for i, t in enumerate(self.merges.special.values())}
        names = {t: -1 - i for i, t in enumerate(self.merges.special)}
        for text in texts:
            if self.special and self.special.search(text):
                own, at = [], 0
                for m in self.special.finditer(text):
                    own += map(codes.__getitem__, PATTERN.findall(text[at : m.start()]))
                    own.append(names[m[0]])
                    at = m.end()
                own += map(codes.__getitem__, PATTERN.findall(text[at:]))
            else:
                own = list(map(codes.__getitem__, PATTERN.findall(text)))
            found.append(np.array(own, np.int64))
            count.append(len(own))
        words = [w.encode() for w in codes]
        off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]).astype(np.int64)
        place = self.transducer.find(off, np.frombuffer(b"".join(words), np.uint8)) if words else np.zeros(0, np.int64)
        rest = np.flatnonzero(place < 0)
        merged = self.merges.merge([words[i] for i in rest])
        # one table: the lexicon's lists, the merged ones, the special tokens
        extra = [*merged, *([t] for t in reversed(special.values()))]
        size = np.concatenate([np.diff(self.transducer.offset), np.fromiter(map(len, extra), np.int64, len(extra))])
        flat = np.concatenate([self.transducer.ids, np.fromiter((i for x in extra for i in x), np.int64, int(size[len(self.transducer.offset) - 1 :].sum()))]).astype(np.uint32)
        begin, known = np.cumsum(size) - size, len(self.transducer.offset) - 1
        place[rest] = known + np.arange(len(rest))
        code = np.concatenate(found) if found else np.zeros(0, np.int64)
        slot = np.where(code < 0, len(size) + code, place[np.maximum(code, 0)] if len(place) else 0)
        n = size[slot]
        ids = laid(flat, begin[slot], n)
        return np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(np.array(count, np.int64))])], ids

    def decode(self, off: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """Texts in UTF-8; bytes that aren't valid become U+FFFD."""
        n = self.piece_size[ids]
        data = laid(self.pieces, self.piece_at[ids], n).tobytes()
        at = np.concatenate([[0], np.cumsum(n)])[off].tolist()
        out = (data[a:b] for a, b in zip(at[:-1], at[1:], strict=True))
        try:
            data.decode()
            return list(out)
        except UnicodeDecodeError:
            return [x.decode(errors="replace").encode() for x in out]


_codecs: dict[tuple, Codec] = {}


def codec_of(path: str, lexicon: str) -> Codec:
    """This worker's codec, kept from task to task; the last one only."""
    if (path, lexicon) not in _codecs:
        _codecs.clear()
        _codecs[path, lexicon] = Codec(path, lexicon)
    return _codecs[path, lexicon]


def fit_lexicon(docs: DataFrame, path: str, where: str, most: int = LEXICON_WORDS) -> str:
    words = [w.encode() for w in frequent_words(docs, most=most)]
    Transducer.compile(dict(zip(words, Merges(path).merge(words), strict=True))).save(where)
    return where


def encode_column(docs: DataFrame, path: str, lexicon: str, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """One row per document: key and, as `keep` asks, ids (array<int>), decoded (string), and of all n_tokens, ids_sha256
    (of the ids as little-endian 32-bit integers) and decoded_sha256.

    A null or empty text has no ids and decodes to ''. Repeated rows stay; an empty table gives none; other columns are
    ignored. Texts are handled whole, in slices of some MB, a longer text alone."""
    out = f"key {docs.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ("ids" in keep) + ", decoded string" * ("decoded" in keep)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, lexicon)
        for batch in batches:
            for part in sliced(batch, "text", 4 << 20):
                off, ids = codec.encode(pc.fill_null(part.column("text"), "").to_pylist())
                decoded = codec.decode(off, ids)
                raw, at = memoryview(ids.astype("<u4")).cast("B"), off.tolist()
                sha = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
                found = [part.column("key"), pa.array(np.diff(off), pa.int64()), pa.array(sha), pa.array([hashlib.sha256(x).hexdigest() for x in decoded])]
                names = ["key", "n_tokens", "ids_sha256", "decoded_sha256"]
                if "ids" in keep:
                    found.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                if "decoded" in keep:
                    found.append(pa.array(decoded, pa.binary()).cast(pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(found, names)

    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(tidy(task), out).withColumnRenamed("key", key)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, docs = public_tokenizers.path("byte_bpe_50k.json"), table(spark, sf_dir, "documents")
    return encode_column(spread(docs), path, fit_lexicon(docs, path, fresh_path(spark, "lexicon")), keep=())
