"""Mixing sources to target weights by weighted fair queueing (DataFrame operations only)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import quoted, stored, table

#: A word: what lies between ASCII white space. Words of a packet, at most.
WORD, PACKET = r"[^\x20\x09-\x0D]+", 64


def targets(per_source: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, share: float = 1.0) -> DataFrame:
    """per_source (source, source_size) with weight and target.

    Sources in code-point order, null last, get the weights in turn. share of all words is dealt by weight; a target
    stops at epochs times its source's size, and what it can't use goes to the others by weight. With the sources
    ordered by cap / weight, the capped ones come first: lambda is the best level over all places in that order.
    One row per source goes to one task here, no documents."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    at = (F.row_number().over(by_name) - 1) % len(weights) + 1
    x = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at.cast("int")).cast("long"))
    x = x.withColumn("cap", F.col("source_size") * epochs)
    everything = W.partitionBy()
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    x = x.withColumn("level", (budget - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    x = x.withColumn("level", F.max("level").over(everything))
    return x.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level"))).select("source", "source_size", "weight", "target")


def sized(docs: DataFrame, key: Column, identity: Column) -> DataFrame:
    """docs without their texts: key, source, size, a digest of the text and what else tells a row from others."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(key.alias("key"), F.col("source").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(text.cast("binary")).alias("digest"), identity.alias("identity"))


def mix(docs: DataFrame, key: Column | str = "doc_id", weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, share: float = 1.0, seed: str = "mix", packet: int = PACKET, identity: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Weighted fair queueing of documents (key, text, source).

    Every source's documents are shuffled by md5(seed, key, digest of the text) and served up to `epochs` times, in packets
    of at most `packet` words, so that a long document holds up no other source. A packet's virtual finish time is its
    source's cumulative words, itself included, over the source's target; packets that begin before their source's target
    are sorted by it over all sources, and the order is cut at the total budget (the packet across the cut is taken in
    part). So each source gets its target to within a packet.

    Returns (rows, packets). rows: one per input row, row_id, key, source, size, digest, identity, source_size, target.
    packets: the mix, row_id, copy, packet, words (taken), virtual_finish and place (words of the mix before it). identity: what tells rows with equal keys, sources and
    texts apart; rows that agree in all are served one after the other.

    Nulls: a null text has size 0 and is taken with 0 words; a null source is a source, the last one; a null key shuffles
    as 'null'. Repeated rows are rows of their own. An empty table gives empty results. Other columns are ignored.

    Cumulative sums are prefix sums in two levels: a source's documents fall by md5 into about sqrt(n) ranges, whose
    totals are summed first, so a source with most of the rows is no task of its own; equal rows are counted before.
    The global order is cut to ranges of virtual time, which hold the same number of words each, and works alike."""
    key = F.col(key) if isinstance(key, str) else key
    plain = stored(sized(docs, key, F.lit(0).cast("long") if identity is None else identity), "mix-sizes")
    n, total = plain.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget, ranges = min(math.floor(total * share), total * epochs), max(1, math.isqrt(n))
    share_of = targets(plain.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs, share)
    alike = plain.groupBy("key", "source", "size", "digest", "identity").agg(F.count(F.lit(1)).alias("n"))
    shuffled = alike.withColumn("deal", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("null")), F.lit(":"), F.col("digest")).cast("binary")))
    shuffled = shuffled.withColumn("range", F.floor(F.conv(F.substring("deal", 1, 8), 16, 10).cast("double") / float(1 << 32) * ranges).cast("int"))
    own = F.col("size") * F.col("n")
    totals = shuffled.groupBy("source", "range").agg(F.sum(own).alias("range_size"))
    upto = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select("source", "range", F.coalesce(F.sum("range_size").over(upto), F.lit(0)).alias("base"))
    bases = bases.join(share_of, bases.source.eqNullSafe(share_of.source)).select(bases.source.alias("b_source"), F.col("range").alias("b_range"), "base", "source_size", "target")
    inside = W.partitionBy("source", "range").orderBy("deal", F.col("key").asc_nulls_last(), "identity")
    placed = shuffled.withColumn("nth", F.row_number().over(inside)).withColumn("upto", F.sum(own).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    placed = placed.join(bases, placed.source.eqNullSafe(F.col("b_source")) & (F.col("range") == F.col("b_range")))
    placed = placed.withColumn("again", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    begin = F.col("base") + F.col("upto") - own + F.col("again") * F.col("size")
    rows = placed.select(F.struct("source", "range", "nth", "again").alias("row_id"), "key", "source", "size", "digest", "identity", "source_size", "target", begin.alias("begin"))
    rows = stored(rows, "mix-rows")

    copies = rows.select("row_id", "size", "target", "begin", "source_size", F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("copy"))
    copies = copies.withColumn("start", F.col("begin") + (F.col("copy") - 1) * F.col("source_size")).filter((F.col("size") > 0) & (F.col("start") < F.col("target")))
    last = F.least(F.floor((F.col("size") - 1) / packet), F.floor((F.col("target") - F.col("start")) / packet)).cast("long")
    packets = copies.select("row_id", "copy", "size", "target", "start", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("packet"))
    at = F.col("packet") * packet
    packets = packets.filter(F.col("start") + at < F.col("target")).withColumn("words", F.least(F.lit(packet), F.col("size") - at).cast("long"))
    packets = packets.select("row_id", "copy", "packet", "words", ((F.col("start") + at + F.col("words")) / F.col("target")).alias("virtual_finish"))
    packets = packets.withColumn("span", F.least(F.floor(F.col("virtual_finish") * ranges), F.lit(ranges)).cast("int"))
    spans = packets.groupBy("span").agg(F.sum("words").alias("span_words"))
    spans = spans.select(F.col("span").alias("s_span"), F.coalesce(F.sum("span_words").over(W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("s_base"))
    along = W.partitionBy("span").orderBy("virtual_finish", F.col("row_id.source").asc_nulls_last(), "row_id", "copy", "packet").rowsBetween(W.unboundedPreceding, -1)
    packets = packets.withColumn("s_words", F.coalesce(F.sum("words").over(along), F.lit(0))).join(spans, F.col("span") == F.col("s_span"))
    packets = packets.withColumn("place", F.col("s_base") + F.col("s_words")).filter(F.col("place") < budget)
    served = F.least(F.col("words"), F.lit(budget) - F.col("place"))
    return rows.drop("begin"), packets.select("row_id", "copy", "packet", served.alias("words"), "virtual_finish", "place")


def ordered(packets: DataFrame) -> DataFrame:
    """The mix in the order in which it is served: a range sort over all partitions."""
    return packets.orderBy("place")


def taken(rows: DataFrame, packets: DataFrame) -> DataFrame:
    """rows with taken, the words that the mix takes of each, repeats counted."""
    sums = packets.groupBy("row_id").agg(F.sum("words").alias("taken"))
    return rows.join(sums, "row_id", "left").withColumn("taken", F.coalesce("taken", F.lit(0)))


def first_words(text: Column, n: Column) -> Column:
    """The first n words of a text with the white space before and between them."""
    return F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), F.lit(1), n.cast("int")), "")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """docs as the mix has them, range-sorted by their place in it: each row as many times as copies of it are served. Of
    a copy that the budget's end finds in service (one a source at most) the text is the words served. Columns are those
    of docs; n_chars, if there is one, follows a cut text.

    Rows without words (null and empty texts, or white space only) take no words and have no place: they stay once, at
    the end. Rows that agree in all columns are one, served as often as all of them are."""
    whole = F.xxhash64(*map(quoted, docs.columns))
    rows, packets = mix(docs, identity=whole, **options)
    copies = packets.groupBy("row_id", "copy").agg(F.sum("words").alias("words"), F.max("place").alias("place"))  # in the order in which they end
    key = ["key", "source", "size", "digest", "identity"]
    again = rows.agg(F.max("row_id.again")).first()[0]
    places = copies.join(rows, "row_id").select(*(F.col(c).alias(f"m_{c}") for c in key), "words", "place")
    empty = rows.filter("size = 0").select(*(F.col(c).alias(f"m_{c}") for c in key), F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("place"))
    places = places.unionByName(empty)
    # a row's columns travel in one, so that their names can't clash
    d = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    d = d.withColumns({"key": F.col("row.doc_id"), "source": F.col("row.source"), "size": F.regexp_count(text, F.lit(WORD)).cast("long"), "digest": F.md5(text.cast("binary")), "identity": F.xxhash64(*(F.col("row")[c] for c in docs.columns))})
    d = d.dropDuplicates(["identity", "digest"]) if again else d
    d = d.join(places, (d.identity == F.col("m_identity")) & (d.digest == F.col("m_digest")) & (d.size == F.col("m_size")) & d.key.eqNullSafe(F.col("m_key")) & d.source.eqNullSafe(F.col("m_source")))
    cut = F.col("words") < F.col("size")
    d = d.select("row", "place", cut.alias("cut"), F.when(cut, first_words(F.col("row.text"), F.col("words"))).otherwise(F.col("row.text")).alias("now"))
    d = d.repartitionByRange(F.col("place").asc_nulls_last()).sortWithinPartitions(F.col("place").asc_nulls_last())
    own = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("now")}
    if "n_chars" in own:
        own["n_chars"] = F.when(F.col("cut"), F.length("now").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return d.select(*(own[c].alias(c) for c in docs.columns))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(*mix(table(spark, sf_dir, "documents"))).select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS digest FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), named AS (
  SELECT *, source_size * 3 AS cap, [5, 2, 1][((row_number() OVER (ORDER BY source COLLATE "BINARY" NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per
), levels AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source COLLATE "BINARY" NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
      / (sum(weight) OVER (ORDER BY cap / weight, source COLLATE "BINARY" NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM named
), aimed AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT max(level) FROM levels)) AS target FROM levels
), dealt AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY deal, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING) - size AS start
  FROM (SELECT sized.*, md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || digest) AS deal FROM sized)
), copies AS (
  SELECT d.doc_id, d.source, d.size, d.deal, a.target, copy, d.start + (copy - 1) * a.source_size AS start
  FROM dealt d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source, (VALUES (1), (2), (3)) c(copy) WHERE d.size > 0
), packets AS (
  SELECT *, start + 64 * packet AS since, least(64, size - 64 * packet) AS words FROM (SELECT *, unnest(range((size + 63) // 64)) AS packet FROM copies) WHERE start + 64 * packet < target
), sorted AS (
  SELECT doc_id, words, sum(words) OVER (ORDER BY (since + words)::DOUBLE / target, source COLLATE "BINARY" NULLS LAST, deal, doc_id NULLS LAST, copy, packet ROWS UNBOUNDED PRECEDING) - words AS place FROM packets
), served AS (
  SELECT doc_id, sum(least(words, budget - place))::BIGINT AS taken FROM sorted, (SELECT sum(size) AS budget FROM sized) WHERE place < budget GROUP BY doc_id
)
SELECT d.doc_id, d.size, a.source_size, a.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM dealt d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source LEFT JOIN served t ON t.doc_id IS NOT DISTINCT FROM d.doc_id
"""
