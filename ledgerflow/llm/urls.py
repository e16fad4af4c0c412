"""URL filters by Bloom filter cascades: exact membership in rule lists over the corpus's key universe, without joins."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table, tidy

#: The rules of op4: (host, path) and what becomes of a url that the rule fits.
RULES = {("net", "/"): "block", ("example.net", "/en/"): "allow", ("example.com", "/de/"): "block", ("org", "/fr/"): "allow"}


def hashes(keys: Iterable[str], level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each key; every level has its own."""
    both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(k.encode("utf-8", "surrogatepass"), seed=level) for k in keys), np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1] | np.uint64(1)


class Bloom:
    """A Bloom filter of a level over n keys with false-positive rate p."""

    def __init__(self, keys: list[str], p: float, level: int):
        self.level, self.k = level, max(1, math.ceil(-math.log2(p)))
        self.m = max(64, math.ceil(len(keys) * self.k / math.log(2)))
        bits = np.zeros(self.m, bool)
        for at in self._places(keys):
            bits[at] = True
        self.bits = np.packbits(bits, bitorder="little")

    def _places(self, keys: list[str]) -> Iterator[np.ndarray]:
        a, b = hashes(keys, self.level)
        with np.errstate(over="ignore"):
            for i in range(self.k):
                yield ((a + np.uint64(i) * b) % np.uint64(self.m)).astype(np.int64)

    def has(self, keys: list[str]) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self._places(keys):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return out


class Cascade:
    """Odd levels encode listed keys, even levels the universe's keys that the levels before let through though they
    aren't listed. A key's answer is the parity of the first level that hasn't it. Exact for listed keys and for every
    key of the universe it was fitted on."""

    def __init__(self, levels: list[Bloom]):
        self.levels = levels

    def has(self, keys: list[str]) -> np.ndarray:
        out, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
        for i, level in enumerate(self.levels):
            passed = level.has([keys[j] for j in open_])
            out[open_[~passed]] = i % 2 == 1  # not in level 1, 3, ...: not listed; not in 2, 4, ...: listed
            open_ = open_[passed]
        out[open_] = len(self.levels) % 2 == 1
        return out


def fit_cascades(universe: DataFrame, lists: dict[str, set[str]], most_levels: int = 64) -> dict[str, Cascade]:
    """A cascade for each list over `universe` (one string column of keys, repeats allowed).

    The first level's false-positive rate is (listed keys) / (keys of the universe, estimated), so its false positives
    are about as many as the listed keys however large the corpus is: what reaches the driver grows with the lists, not
    with the corpus. One pass over the universe finds what passes it, listed keys and others; tasks get the Bloom filters,
    not the lists. The later levels come from these two sets alone."""
    key = universe.columns[0]
    universe = universe.filter(F.col(key).isNotNull())
    n = universe.agg(F.approx_count_distinct(key)).first()[0]
    first = {name: Bloom(sorted(listed), min(0.5, max(1, len(listed)) / (n + 2)), 1) for name, listed in lists.items()}

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.compute.unique(batch.column(0)).to_pylist()
            for name, bloom in first.items():
                passed = [k for k, ok in zip(keys, bloom.has(keys), strict=True) if ok]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(passed), pa.string()), pa.array(passed, pa.string())], ["list", "key"])

    wrong = {name: [] for name in lists}
    for name, k in universe.mapInArrow(tidy(passing), "list string, key string").distinct().collect():
        if k not in lists[name]:
            wrong[name].append(k)
    out = {}
    for name, listed in lists.items():
        levels, inside, outside = [first[name]], sorted(listed), sorted(wrong[name])
        while outside:
            if len(levels) >= most_levels:
                raise ValueError("two keys have the same hashes at every level")
            levels.append(level := Bloom(outside, 0.5, len(levels) + 1))
            inside, outside = outside, [k for k, ok in zip(inside, level.has(inside), strict=True) if ok]
        out[name] = Cascade(levels)
    return out


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; null or no :// gives ''."""
    rest = F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(F.when(F.locate("://", url) > 0, host), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or # or the end; null or no :// gives ''."""
    rest = F.substring(url, F.locate("://", url) + F.lit(3), F.length(url))
    return F.coalesce(F.when(F.locate("://", url) > 0, F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)), F.lit(""))


def keys_of(host: Column, path: Column, rules: dict[tuple[str, str], str]) -> Column:
    """Every host suffix joined to every path prefix that could be a rule: as many host labels and such path lengths as
    the rules have."""
    labels = F.split(host, r"\.")
    depth = max((h.count(".") + 1 for h, _ in rules), default=0)
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(1, depth)))), lambda i: F.array_join(F.slice(labels, -i, i), "."))
    lengths = F.array(*map(F.lit, sorted({len(p) for _, p in rules}) or [0]))
    heads = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(tails, lambda t: F.transform(heads, lambda p: F.concat(t, p))))


def judge(pages: DataFrame, rules: dict[tuple[str, str], str] = RULES, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per page: key, host, path, rule, verdict.

    A rule (host, path) fits its host and all subdomains where the url's path starts with the rule's; the longest that
    fits decides (equally long ones: the one with the longer host). No rule fits: rule null, verdict `default`.
    Null urls and urls without :// have empty host and path, which no rule with a host fits. Repeated rows stay, an empty
    table gives none, other columns are ignored. Paths compare byte by byte, case and all."""
    base = pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    base = base.withColumn("keys", keys_of(F.col("host"), F.col("path"), rules))
    lists = {verdict: {h + p for (h, p), v in rules.items() if v == verdict} for verdict in dict.fromkeys(rules.values())}
    cascades = fit_cascades(base.select(F.explode("keys").alias("key")), lists)
    out = base.schema["key"].dataType

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            per_row = batch.column("keys")
            flat = per_row.flatten().dictionary_encode()
            distinct = flat.dictionary.to_pylist()
            found = {}
            for verdict, cascade in cascades.items():
                found |= {k: verdict for k, ok in zip(distinct, cascade.has(distinct), strict=True) if ok}
            size = np.array([(len(k) * 65536 + k.find("/") % 65536 + 1) if k in found else 0 for k in distinct], np.int64)
            rule, at = [], 0
            codes = flat.indices.to_numpy(zero_copy_only=False)
            for n in pa.compute.list_value_length(per_row).to_numpy(zero_copy_only=False):
                own = codes[at : at + n]
                best = own[np.argmax(size[own])] if n and size[own].max() else -1
                rule.append(distinct[best] if best >= 0 else None)
                at += n
            said = [found[r] if r is not None else default for r in rule]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "host", "path")), pa.array(rule, pa.string()), pa.array(said, pa.string())], ["key", "host", "path", "rule", "verdict"])

    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("key", out), *(StructField(c, StringType()) for c in ("host", "path", "rule", "verdict"))])
    return base.mapInArrow(tidy(verdicts), schema).withColumnRenamed("key", key)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


OP4_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u
), r(rule_host, rule_path, said) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), best AS (
  SELECT *, (SELECT max_by({'rule': rule_host || rule_path, 'said': said}, length(rule_host || rule_path)) FROM r
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS b FROM p
)
SELECT page_id, host, path, b.rule AS rule, coalesce(b.said, 'allow') AS verdict FROM best
"""
