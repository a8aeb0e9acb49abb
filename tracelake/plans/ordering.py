"""Running totals and positions, global or per group, without a single-task
window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task, and
with one it moves every group into one task.  The pattern below keeps the work
spread out:

1. equal rows become one row with their number as a weight (a map-side combined
   aggregate): a row that a third of the table repeats leaves each task once;
2. ``repartitionByRange`` on (group, order keys, a hash of the row): rows that tie
   on the order keys but differ elsewhere spread over many buckets, so a key, or
   a group, that holds a third of all rows is split.  The hash depends on the
   row's content only, never on its position, so a task retried after a lost
   executor sends every row to the same bucket again;
3. materialise the bucketed rows once with ``checkpoint()`` in the shared
   checkpoint folder.  All consumers below must see the *same* buckets: two
   independently planned range exchanges sample separately and may cut at
   different bounds.  The checkpoint also cuts the lineage, so a lost
   executor does not re-run the sampling and the range shuffle;
4. a running sum of the weighted values *inside* each bucket (and group);
5. totals per bucket -> running offset.  Without groups there is one total per
   bucket; with groups only the first and the last group of a bucket can reach
   over its edge, so there are at most two.  Broadcasting them is safe;
6. add the offset, and expand the weights with ``sequence``; rows that more than
   a fraction of a bucket repeats are first cut into parts that are dealt out.

Narrow rows are shuffled twice (equal rows, ranges) and written once; no task ever
holds more than one bucket.  The checkpoint makes the functions run one job eagerly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.session import shared_dir, shuffle_partitions

_UID, _BUCKET, _LOCAL, _TOTAL, _OFFSET = "_tl_uid", "_tl_bucket", "_tl_local", "_tl_total", "_tl_offset"
_VAL, _W, _SUM, _START, COPY = "_tl_val", "_tl_n", "_tl_sum", "_tl_start", "_tl_copy"


def _order_exprs(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def _hashable(c: Column, t: T.DataType) -> Column:
    """Map and variant values cannot be hashed: hash their JSON text."""
    if isinstance(t, (T.MapType, T.VariantType)):
        return F.to_json(c)
    if isinstance(t, T.StructType) and any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in t.fields):
        return F.to_json(c)
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.MapType, T.VariantType, T.StructType)):
        return F.to_json(c)
    return c


def row_hash(df: DataFrame) -> Column:
    """A deterministic 64-bit hash of a whole row (content only)."""
    return F.xxhash64(*[_hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])


def _groupable(t: T.DataType) -> bool:
    if isinstance(t, (T.MapType, T.VariantType)):
        return False
    if isinstance(t, T.ArrayType):
        return _groupable(t.elementType)
    if isinstance(t, T.StructType):
        return all(_groupable(f.dataType) for f in t.fields)
    return True


def _times(value: Column, t: T.DataType, n: Column) -> Column:
    """``value * n`` in the type that a sum of values has."""
    if isinstance(t, T.DecimalType):
        # room for 12 digits of n: Spark rounds decimal products that may exceed 38 digits
        wide = T.DecimalType(min(t.precision, 25), t.scale)
        return (value.cast(wide) * n.cast("decimal(12,0)")).cast(T.DecimalType(37, t.scale))
    return value * n


def _collapsed(df: DataFrame, val: Column, tiebreak: Column | None) -> DataFrame:
    """Equal rows as one row: ``_W`` of them, whose values sum up to ``_SUM``."""
    tagged = df.withColumn(_UID, tiebreak if tiebreak is not None else row_hash(df)).withColumn(_VAL, val)
    total = F.sum(_VAL)
    if all(_groupable(f.dataType) for f in df.schema.fields):
        cols = [F.col(f"`{c}`") for c in [*df.columns, _UID, _VAL]]
        return tagged.groupBy(*cols).agg(F.count(F.lit(1)).alias(_W), total.alias(_SUM))
    # maps and variants cannot be compared: such rows stay single
    kind = tagged.limit(0).agg(total.alias("s")).schema["s"].dataType
    return tagged.withColumn(_W, F.lit(1).cast("bigint")).withColumn(_SUM, F.col(_VAL).cast(kind))


def _offsets(ranged: DataFrame, group: list[str]) -> DataFrame:
    """What lies before each bucket: at most one row per bucket, or with groups
    two, of the groups that a bucket shares with the one before."""
    before = Window.orderBy(_BUCKET)
    if group:
        key = F.struct(*[F.col(f"`{g}`") for g in group])
        edges = ranged.groupBy(_BUCKET).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        edges = edges.select(F.explode(F.array("lo", "hi")).alias("_tl_edge")).distinct()
        ranged = ranged.join(F.broadcast(edges), key.eqNullSafe(F.col("_tl_edge")), "left_semi")
        before = Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy(_BUCKET)
    totals = ranged.groupBy(_BUCKET, *[F.col(f"`{g}`") for g in group]).agg(F.sum(_SUM).alias(_TOTAL))
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    names = [F.col(f"`{g}`").alias(f"_tl_group{i}") for i, g in enumerate(group)]
    return totals.select(F.col(_BUCKET).alias("_tl_at"), *names, F.sum(_TOTAL).over(before).alias(_OFFSET))


def running_total(
    df: DataFrame,
    order: Sequence[Column | str],
    value: Column | str,
    out: str,
    buckets: int | None = None,
    tiebreak: Column | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over all rows up to and including the
    current one, in ``order`` (ascending sort expressions allowed), with
    ``group`` within the rows equal in these columns (NULLs are one group).

    ``tiebreak`` orders rows equal in ``order``; by default a hash of the
    whole row.  NULL values count as 0.  Decimal values keep 25 digits."""
    spark = df.sparkSession
    n = buckets or shuffle_partitions(spark)
    group = list(group)
    val = F.col(value) if isinstance(value, str) else value
    by = [F.col(f"`{g}`") for g in group]
    keys = [*by, *_order_exprs(order), F.col(_UID)]
    shared_dir(spark)  # make sure a checkpoint folder is set (tests, local runs)
    ranged = (
        _collapsed(df, val, tiebreak)
        .repartitionByRange(n, *keys)
        .withColumn(_BUCKET, F.spark_partition_id())
        .checkpoint(eager=True)
    )
    rows, most = ranged.agg(F.sum(_W), F.max(_W)).first()
    kind = ranged.schema[_SUM].dataType
    if isinstance(kind, T.DecimalType):
        kind = T.DecimalType(37, kind.scale)  # the sum of two such is not rounded
    inside = Window.partitionBy(_BUCKET, *by).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn(_LOCAL, F.sum(_SUM).over(inside))
    offsets = _offsets(ranged, group)
    at = F.col(_BUCKET) == F.col("_tl_at")
    for i, c in enumerate(by):
        at = at & c.eqNullSafe(F.col(f"_tl_group{i}"))
    joined = local.join(F.broadcast(offsets), at, "left")
    zero = F.lit(0).cast(kind)
    here, before = (F.coalesce(F.col(c).cast(kind), zero) for c in (_LOCAL, _OFFSET))
    joined = joined.withColumn(_START, (here + before).cast(kind))
    cols = [F.col(f"`{c}`") for c in df.columns]

    if (most or 0) <= 1:
        return joined.select(*cols, (F.col(_START) + F.coalesce(F.col(_VAL).cast(kind), zero)).alias(out))
    each = each_copy(joined, rows, most, n)
    own = _times(F.col(_VAL), each.schema[_VAL].dataType, F.col(COPY)).cast(kind)
    return each.select(*cols, (F.col(_START) + F.coalesce(own, zero)).alias(out))


def each_copy(weighted: DataFrame, rows: int, most: int, n: int) -> DataFrame:
    """Rows of weight ``_W`` as so many rows, numbered from 1 in ``COPY``.
    ``rows`` is the sum and ``most`` the largest of the weights; rows of more than
    an eighth of a partition's copies (at most 8 n of them) are expanded part by
    part, the parts dealt out over the tasks."""
    one = F.lit(1).cast("bigint")
    part = max(1, rows // (8 * n))
    if most <= part:
        return weighted.withColumn(COPY, F.explode(F.sequence(one, F.col(_W))))
    few = weighted.where(F.col(_W) <= part).withColumn(COPY, F.explode(F.sequence(one, F.col(_W))))
    parts = weighted.where(F.col(_W) > part).withColumn("_tl_part", F.explode(F.sequence(F.lit(0), F.floor((F.col(_W) - 1) / part))))
    parts = parts.repartition(n, F.col(_UID), F.col("_tl_part"))
    first = F.col("_tl_part") * part + 1
    last = F.least(first + (part - 1), F.col(_W))
    return few.unionByName(parts.withColumn(COPY, F.explode(F.sequence(first, last))).drop("_tl_part"))


def with_position(
    df: DataFrame,
    order: Sequence[Column | str],
    out: str = "pos",
    buckets: int | None = None,
    tiebreak: Column | None = None,
    group: Sequence[str] = (),
) -> DataFrame:
    """Add a 1-based position in ``order``, global or within ``group`` (a
    distributed row_number)."""
    return running_total(df, order, F.lit(1).cast("bigint"), out, buckets, tiebreak, group)


def values_at_positions(
    df: DataFrame,
    value: Column | str,
    positions: Sequence[int] | Callable[[int], Sequence[int]],
    buckets: int | None = None,
    tiebreak: Column | None = None,
) -> tuple[DataFrame, int]:
    """The values at given 1-based positions of ``value`` in ascending order
    (NULLs left out), as rows ``(pos, v)``, and the number of values.
    ``positions`` may be a function of that number (e.g. quartiles).

    Order statistics need only a few positions, so only a few buckets need a
    local ranking: the rows are range-bucketed once on (value, tiebreaker —
    by default a hash of the whole row) and checkpointed; the per-bucket
    count, min and max — one row per bucket, bounded by the bucket count —
    are read on the driver to find the bucket and local rank of each wanted
    position.  A bucket whose min equals its max answers directly (a value
    holding a third of the rows needs no ranking at all); only the other
    wanted buckets are ranked.  One full shuffle; the second touches a few
    buckets.
    """
    spark = df.sparkSession
    n = buckets or shuffle_partitions(spark)
    shared_dir(spark)
    v = F.col(value) if isinstance(value, str) else value
    ranged = (
        df.select(v.alias("v"), (tiebreak if tiebreak is not None else row_hash(df)).alias(_UID))
        .where(F.col("v").isNotNull())
        .repartitionByRange(n, "v", _UID)
        .withColumn(_BUCKET, F.spark_partition_id())
        .checkpoint(eager=True)
    )
    vtype = ranged.schema["v"].dataType
    stats = ranged.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    counts = sorted((r[_BUCKET], r["n"], r["lo"], r["hi"]) for r in stats.collect())
    total = sum(c for _, c, _, _ in counts)
    if callable(positions):
        positions = positions(total)
    positions = sorted(set(positions))
    known: dict[int, object] = {}
    wanted: dict[tuple[int, int], int] = {}
    start = 0
    for bucket, c, lo, hi in counts:
        for p in positions:
            if start < p <= start + c:
                if lo == hi:
                    known[p] = lo
                else:
                    wanted[(bucket, p - start)] = p
        start += c
    schema = f"pos bigint, v {vtype.simpleString()}"
    out = spark.createDataFrame(sorted(known.items()), schema)
    if wanted:
        local = Window.partitionBy(_BUCKET).orderBy("v", _UID)
        ranked = (
            ranged.where(F.col(_BUCKET).isin(sorted({b for b, _ in wanted})))
            .withColumn("_tl_rank", F.row_number().over(local))
        )
        cond, pos = None, None
        for (bucket, rank), p in sorted(wanted.items()):
            hit = (F.col(_BUCKET) == bucket) & (F.col("_tl_rank") == rank)
            cond = hit if cond is None else cond | hit
            pos = F.when(hit, F.lit(p)) if pos is None else pos.when(hit, F.lit(p))
        out = out.unionByName(ranked.where(cond).select(pos.cast("bigint").alias("pos"), "v"))
    return out, total
