"""Shards of near equal bytes by sampled splitters.

1. Key: a hash of the text, as a number from 0 to 1, so that equal texts have
   equal keys.  Rows are drawn with a chance in proportion to their size, from
   a hash of their id; draws are counted by key.
2. Quantiles of the draws are the splitters of ``shards * per`` ranges, of
   about the same bytes each; a key drawn often enough to fill a range is a
   range of its own.
3. The ranges' bytes are counted over all rows.  Overfull ranges are subdivided
   by a hash of the id, so that a text with very many copies is spread, and
   only then.
4. Ranges are dealt to shards in key order by cumulative bytes; ranges move
   from the fullest to the emptiest shard while that evens them out.
5. A row's slot is its rank in its range, after the rows of the shard's ranges
   before it.

Only draws, splitters and the ranges' totals (a few thousand numbers, set by
``shards`` and ``per``, not by the data) are seen by the driver.

Defined results: a null text has no bytes, so size 8, and the key and CRC-32 of
the empty text; an empty table gives an empty result; ties are ordered by id;
repeated rows get a slot each; a null id is hashed like any other; other
columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut

SHARDS = 24
PER = 64  # ranges per shard
DRAWS = 8  # draws per range
CELLS = 4096


def _share(hash_column):
    """A hash as a number from 0 up to 1."""
    return F.shiftrightunsigned(hash_column, 11) / F.lit(float(1 << 53))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``, the key and a second key for each row."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    own = docs[id_col].cast("long")
    return docs.select(
        own.alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        _share(F.xxhash64(text)).alias("key"),
        _share(F.xxhash64(F.lit("second"), own)).alias("second"),
    )


def splitters(rows: DataFrame, total: int, ranges: int) -> list[float]:
    """Ascending boundaries; a range starts at its boundary."""
    chance = F.col("size") * F.lit(ranges * DRAWS / total)
    draws = F.floor(chance + _share(F.xxhash64(F.lit("draw"), "doc_id", "text_crc32"))).cast("long")
    drawn = rows.select("key", draws.alias("draws")).where("draws > 0").groupBy("key").agg(F.sum("draws").alias("draws"))
    found: set[float] = set()
    seen = 0
    for key, n in sorted((r["key"], r["draws"]) for r in drawn.collect()):
        if n >= DRAWS:
            found |= {key, math.nextafter(key, 2.0)}
        elif (seen + n) // DRAWS > seen // DRAWS:
            found.add(key)
        seen += n
    return sorted(found)


def ranged(rows: DataFrame, bounds: list[float]) -> DataFrame:
    """Adds ``range``: how many boundaries are at or below the key.  Looked up
    by cell of the key space, a table of ``CELLS`` rows."""
    cells: list[list[float]] = [[] for _ in range(CELLS)]
    for b in bounds:
        if b < 1:
            cells[int(b * CELLS)].append(b)
    before, table = 0, []
    for cell, own in enumerate(cells):
        table.append((cell, before, own))
        before += len(own)
    lookup = rows.sparkSession.createDataFrame(table, "cell int, before int, bounds array<double>")
    found = rows.withColumn("cell", F.floor(F.col("key") * CELLS).cast("int")).join(F.broadcast(lookup), "cell")
    at = F.col("before") + F.size(F.filter("bounds", lambda b: b <= F.col("key")))
    return found.select(*rows.columns, at.alias("range"))


def subdivided(rows: DataFrame, target: float) -> DataFrame:
    """Adds ``part``: overfull ranges are cut into parts of about ``target`` bytes."""
    sizes = rows.groupBy("range").agg(F.sum("size").alias("bytes"), F.max("size").alias("most")).collect()
    parts = [(r["range"], math.ceil(r["bytes"] / target)) for r in sizes if r["bytes"] > 2 * max(target, r["most"])]
    lookup = rows.sparkSession.createDataFrame(parts, "range int, parts int")
    found = rows.join(F.broadcast(lookup), "range", "left")
    return found.withColumn("part", F.floor(F.col("second") * F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")


def dealt(sizes: list[tuple[int, int, int]], shards: int) -> dict[tuple[int, int], int]:
    """Shard of each (range, part), from ``(range, part, bytes)``."""
    sizes = sorted(sizes)
    total = sum(n for _, _, n in sizes)
    load = [0] * shards
    own: list[list[tuple[int, int, int]]] = [[] for _ in range(shards)]
    seen = 0
    for r, p, n in sizes:
        shard = min(shards - 1, int((seen + n / 2) * shards / total))
        own[shard].append((n, r, p))
        load[shard] += n
        seen += n
    for _ in range(4 * len(sizes)):
        full, free = max(range(shards), key=lambda s: (load[s], s)), min(range(shards), key=lambda s: (load[s], s))
        gap = load[full] - load[free]
        fitting = [x for x in own[full] if 0 < x[0] < gap]
        if not fitting:
            break
        best = min(fitting, key=lambda x: (abs(gap - 2 * x[0]), x))
        own[full].remove(best)
        own[free].append(best)
        load[full] -= best[0]
        load[free] += best[0]
    return {(r, p): s for s, parts in enumerate(own) for _, r, p in parts}


def shard(docs: DataFrame, shards: int = SHARDS, per: int = PER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row ``doc_id, size, text_crc32, shard, slot`` (0 up in a shard)."""
    spark = docs.sparkSession
    rows = cut(keyed(docs, id_col, text_col))
    total = rows.agg(F.sum("size").alias("b")).first()["b"] or 1
    target = total / (shards * per)
    rows = subdivided(ranged(rows, splitters(rows, total, shards * per)), target)
    rows = cut(rows)
    sizes = [
        (r["range"], r["part"], r["bytes"], r["n"])
        for r in rows.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("size").alias("n")).collect()
    ]
    of = dealt([x[:3] for x in sizes], shards)
    before = [0] * shards
    table = []
    for r, p, _, n in sorted(sizes):
        s = of[r, p]
        table.append((r, p, s, before[s]))
        before[s] += n
    lookup = spark.createDataFrame(table, "range int, part int, shard int, before long")
    rank = F.row_number().over(Window.partitionBy("range", "part").orderBy("key", "doc_id", "size"))
    found = rows.withColumn("rank", rank - 1).join(F.broadcast(lookup), ["range", "part"])
    return found.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank")).alias("slot"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the ``op2`` query."""
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents with all their columns, in one folder per shard and in
    slot order within the files."""
    found = shard(docs, shards).select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), "shard", "slot")
    crc = F.crc32(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    n = F.row_number().over(Window.partitionBy("_id", "_crc").orderBy("shard", "slot"))
    m = F.row_number().over(Window.partitionBy("doc_id", "_own_crc").orderBy(F.lit(0)))
    left = docs.withColumn("_own_crc", crc).withColumn("_m", m)
    right = found.withColumn("_n", n)
    at = left["doc_id"].eqNullSafe(right["_id"]) & (left["_own_crc"] == right["_crc"]) & (left["_m"] == right["_n"])
    joined = left.join(right, at).drop("_id", "_crc", "_n", "_m", "_own_crc")
    joined.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
