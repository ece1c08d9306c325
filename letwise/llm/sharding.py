"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number for a key from a hash of both; the key goes to the shard whose draw, divided by the
shard's weight, is smallest. A shard's draws never depend on the other shards, so one more shard only takes the keys
for which it draws the smallest number, about its share of the weight, and no key moves between the old ones.

``place`` is a narrow step of built-in functions. ``number`` gives the rows of each shard gapless places with one
range shuffle, which no hot key or shard can unbalance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from letwise.session import scratch_path

SHARDS = 8
LAW = "key"
RANGE_ROWS = 1 << 18
_STEPS = float(1 << 52)


def stable_key(key: Column) -> Column:
    """The text that is hashed for a key; a null key counts as the empty text."""
    return F.coalesce(key.cast("string"), F.lit(""))


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """The number that a shard draws for a key: ``-ln(u) / weight`` with u in (0, 1) from 52 bits of an MD5 digest."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", key, shard.cast("string"))), 1, 13), 16, 10).cast("long")
    return -F.log((bits + F.lit(0.5)) / F.lit(_STEPS)) / weight


def _without(frame: DataFrame, names: Sequence[str]) -> list[Column]:
    """The caller's columns but for those that the result replaces."""
    return [F.col(f"`{c}`") for c in frame.columns if c.lower() not in names]


def place(frame: DataFrame, key: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS,
          grown_weight: float | None = 1.0) -> DataFrame:
    """``frame`` with ``shard`` (from 0) and ``grown_shard``, the shard if one more of weight ``grown_weight`` were
    added (null without one). Only the key, the shard's number and the weights decide; rows that repeat a key go
    together. Ties go to the smaller shard. Columns of these names are replaced. An empty frame stays empty."""
    if not weights or min(weights) <= 0 or (grown_weight is not None and grown_weight <= 0):
        raise ValueError("weights must be positive")
    if len(set(weights)) == 1:
        shards = F.transform(F.sequence(F.lit(0), F.lit(len(weights) - 1)),
                             lambda s: F.struct(s.alias("shard"), F.lit(float(weights[0])).alias("weight")))
    else:
        shards = F.array(*[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)])
    name = stable_key(F.col(f"`{key}`"))
    best = F.array_min(F.transform(shards, lambda s: F.struct(draw(name, s["shard"], s["weight"]).alias("draw"),
                                                              s["shard"].alias("shard"))))
    packed = frame.select(F.struct(*_without(frame, ("shard", "grown_shard"))).alias("row"), best.alias("best"), name.alias("key"))
    shard = F.col("best.shard")
    if grown_weight is None:
        grown = F.lit(None).cast("int")
    else:
        new = draw(F.col("key"), F.lit(len(weights)), F.lit(float(grown_weight)))
        grown = F.when(new < F.col("best.draw"), F.lit(len(weights))).otherwise(shard)
    return packed.select("row.*", shard.cast("int").alias("shard"), grown.cast("int").alias("grown_shard"))


def number(frame: DataFrame, key: str = "doc_id", ties: Sequence[str] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """``frame`` (with ``shard``) and ``slot``: the place of each row in its shard, gapless from 0, in the order of the
    key's MD5 digest, which mixes the records well; then the key, then the columns ``ties``.

    Rows equal in all of these get places in no set order. The rows are written once with a running number, which
    lets the range shuffle cut between equal keys, and once as ranged; counts per range and shard (a row each) then
    give every range its first place. A column named slot is replaced."""
    spark = frame.sparkSession
    order = ["shard", "digest", "key", *[f"tie{i}" for i in range(len(ties))], "n"]
    rows = scratch_path(spark, "shard-rows")
    (frame.select(F.struct(*_without(frame, ("slot",))).alias("row"), F.col("shard"),
                  F.md5(stable_key(F.col(f"`{key}`"))).alias("digest"), F.col(f"`{key}`").alias("key"),
                  *[F.col(f"`{c}`").alias(f"tie{i}") for i, c in enumerate(ties)], F.monotonically_increasing_id().alias("n"))
     .write.parquet(rows))
    written = spark.read.parquet(rows)
    parts = max(1, -(-written.count() // range_rows))
    ranged = scratch_path(spark, "shard-ranges")
    at = F.monotonically_increasing_id()
    (written.repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .select("row", "shard", F.shiftright(at, 33).cast("int").alias("part"), at.bitwiseAND((1 << 33) - 1).alias("at"))
     .write.parquet(ranged))
    ranges = spark.read.parquet(ranged)
    counts = ranges.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("shard", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return ranges.join(starts, ["shard", "part"]).select("row.*", (F.col("at") + F.col("shift")).alias("slot"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes plus 1; a null text has none) and ``text_crc32`` (unsigned, of the bytes)."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    return docs.select(*_without(docs, ("size", "text_crc32")), (F.octet_length(whole) + 1).cast("long").alias("size"),
                       F.crc32(whole).alias("text_crc32"))


def write_shards(placed: DataFrame, path: str, rows_per_file: int = 1 << 20) -> None:
    """The numbered rows as Parquet, a folder a shard and files of ``rows_per_file`` places each, in order."""
    file = F.floor(F.col("slot") / rows_per_file)
    (placed.withColumn("file", file).repartition("shard", "file").sortWithinPartitions("shard", "slot")
     .drop("file").write.option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path))


def shards_sql() -> str:
    """DuckDB SQL of ``op11_sharding``. The CRC is taken over hexadecimal digits, low digit of a byte first; its four
    constants are the CRC-32 remainders of the single bits of a digit."""
    def drawn(shard: str) -> str:
        return f"-ln((('0x' || substr(md5(doc_id::VARCHAR || '/' || ({shard})::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / {1 << 52}::DOUBLE)"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_min(list_transform(range(8), lambda s: {{'draw': {drawn('s')}, 'shard': s}})) AS best, {drawn('8')} AS new
  FROM documents),
c AS (
  SELECT doc_id, best, new, octet_length(encode(text)) + 1 AS size,
    list_transform(string_split(regexp_replace(hex(encode(text)), '(.)(.)', '\\2\\1', 'g'), ''),
                   lambda h: CASE WHEN h = '' THEN NULL ELSE instr('0123456789ABCDEF', h) - 1 END) AS digits
  FROM d),
r AS (
  SELECT doc_id, best, new, size, CASE WHEN size = 1 THEN 0 ELSE xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, digits::BIGINT[]),
    lambda c, h: xor(c >> 4, xor(xor((xor(c, h) & 1) * 498536548, ((xor(c, h) >> 1) & 1) * 997073096),
                                 xor(((xor(c, h) >> 2) & 1) * 1994146192, ((xor(c, h) >> 3) & 1) * 3988292384))))) END AS crc
  FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'key' AS law, CAST(best.shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY best.shard ORDER BY md5(doc_id::VARCHAR), doc_id, size, crc) - 1 AS slot,
  CAST(CASE WHEN new < best.draw THEN 8 ELSE best.shard END AS INTEGER) AS grown_shard
FROM r"""
