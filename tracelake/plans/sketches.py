"""Distinct counts and quartiles of any range of loads, from stored sketches.

Every load of a versioned table gets one small row: HyperLogLog sketches of the
columns to be counted and KLL sketches of the numbers, as the sketch aggregates of
Spark make them.  Sketches merge, so a question about loads ``a`` to ``b`` reads these
rows alone, however many rows the loads hold.  A load that is written again replaces
its sketches.  Estimates come with the error that they keep.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.plans.tables import LOAD, read_loads

LG_K = 14  # 2^14 registers: 16 KB a sketch at most
KLL_K = 2000  # about 40 KB a sketch
DEVIATIONS = 4  # standard errors that the stated bounds are wide


def distinct_bound(lg_k: int = LG_K) -> float:
    """The relative error that a distinct count stays within."""
    return DEVIATIONS * 1.04 / 2 ** (lg_k / 2)


def rank_bound(k: int = KLL_K) -> float:
    """The error in rank, as a share of all rows, that a quartile stays within:
    the published fit of KLL's error, 2.296 / k^0.9021, at 99 % of cases; doubled."""
    return 2 * 2.296 / k**0.9021


def _name(kind: str, column: str) -> str:
    return f"{kind}_{column}"


def write_sketches(
    spark: SparkSession, table_dir: str, sketch_dir: str, load_id: int, distinct: Sequence[str] = (), numbers: Sequence[str] = (),
) -> str:
    """Sketch one load (its folder alone is read, and of it only these columns).
    NULLs are not counted, nor NaN.  One partial aggregation."""
    rows = read_loads(spark, table_dir).where(F.col(LOAD) == int(load_id))
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), LG_K).alias(_name("hll", c)) for c in distinct]
    for c in numbers:
        v = F.col(f"`{c}`").cast("double")
        aggs.append(F.kll_sketch_agg_double(F.when(~F.isnan(v), v), KLL_K).alias(_name("kll", c)))
    rows.agg(*aggs).write.mode("overwrite").parquet(f"{sketch_dir.rstrip('/')}/{LOAD}={int(load_id)}")
    return sketch_dir


def _loads(spark: SparkSession, sketch_dir: str, first: int | None, last: int | None) -> DataFrame:
    rows = spark.read.option("mergeSchema", "true").parquet(sketch_dir)
    tests: list[Column] = [F.lit(True)]
    tests += [F.col(LOAD) >= first] if first is not None else []
    tests += [F.col(LOAD) <= last] if last is not None else []
    return rows.where(reduce(lambda a, b: a & b, tests))


def distinct_in_loads(
    spark: SparkSession, sketch_dir: str, columns: Sequence[str], first: int | None = None, last: int | None = None
) -> DataFrame:
    """``column, estimate, bound``: distinct values over loads ``first`` to ``last``,
    and the relative error that the estimate stays within.  No load: 0."""
    rows = _loads(spark, sketch_dir, first, last)
    estimate = rows.agg(*[F.hll_sketch_estimate(F.hll_union_agg(_name("hll", c))).alias(c) for c in columns])
    long = estimate.unpivot([], [f"`{c}`" for c in columns], "column", "estimate")
    return long.select("column", F.coalesce("estimate", F.lit(0).cast("bigint")).alias("estimate"), F.lit(distinct_bound()).alias("bound"))


def quartiles_in_loads(
    spark: SparkSession, sketch_dir: str, columns: Sequence[str], first: int | None = None, last: int | None = None,
    fractions: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """``column, fraction, n, estimate, bound``: quantiles over loads ``first`` to
    ``last``, with the number of values and the error in rank, as a share of them,
    that the estimate stays within.  Nothing for a column without values."""
    rows = _loads(spark, sketch_dir, first, last)
    out = None
    for c in columns:
        merged = rows.agg(F.kll_merge_agg_double(_name("kll", c)).alias("s"))
        merged = merged.select("s", F.kll_sketch_get_n_double("s").alias("n")).where(F.col("n") > 0)
        points = [
            F.struct(F.lit(float(q)).alias("fraction"), F.kll_sketch_get_quantile_double("s", F.lit(float(q))).alias("estimate"))
            for q in fractions
        ]
        each = merged.select("n", F.explode(F.array(*points)).alias("p"))
        one = each.select(F.lit(c).alias("column"), "p.fraction", "n", "p.estimate", F.lit(rank_bound()).alias("bound"))
        out = one if out is None else out.unionByName(one)
    return out
