"""What the training-data operators share: reading, column picking, lineage cuts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.session import scratch_path, shared_dir

BROADCAST_IDS = 1_000_000  # 8 MB of ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` (long) and ``text`` (null read as empty): other columns,
    whatever their names, never meet the operators' own."""
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage in the shared folder of
    ``spark.checkpoint.dir``.  Reliable files that survive lost executors; the
    context cleaner removes them once the frame is no longer referenced."""
    shared_dir(df.sparkSession)  # registers a folder where the session has none (tests)
    return df.checkpoint(eager=True)


class Tables:
    """The tables of one run: Parquet in the shared folder, which survives lost
    executors.  ``drop`` removes those whose consumers are all written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "table")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(frame))[1])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def last(self, df: DataFrame) -> DataFrame:
        """Write the result and drop all other tables."""
        others = [frame for frame, _ in self.paths.values()]
        out = self.write(df)
        self.drop(*others)
        return out


def only(docs: DataFrame, ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """``docs`` on their way to a join with ``ids`` (one column): if the ids
    are at most ``limit``, other documents are left out before the shuffle."""
    if ids.count() > limit:
        return docs
    ids = ids.toDF("_id")
    return docs.join(F.broadcast(ids), docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")


def among(df: DataFrame, cols: list, keys: DataFrame, how: str = "left_semi", words: int = BROADCAST_IDS) -> DataFrame:
    """The rows of ``df`` whose ``cols`` may be among the rows of ``keys`` (like
    types), all that are and few others; with ``left_anti``, the rest.  For what
    goes to a join: ``keys``, a table of any length, are broadcast as one bit
    each, 16 places a key up to ``words`` numbers of 64 bits."""
    words = max(1, min(words, keys.count() // 4))

    def place(cols: list):
        h = F.xxhash64(F.lit("bits"), *cols)
        return F.pmod(h, F.lit(words)).alias("_word"), F.shiftrightunsigned(h, 58).cast("int").alias("_place")

    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_place"))
    bits = keys.select(*place(keys.columns)).groupBy("_word").agg(F.bit_or(one).alias("_bits"))
    word, at = place(cols)
    return df.join(F.broadcast(bits), (word == bits["_word"]) & (F.getbit(bits["_bits"], at) == 1), how)


_KEPT: dict[tuple, object] = {}  # what this worker process keeps from task to task


def kept(key: tuple, make: Callable[[], object]):
    """What ``make`` returns, kept by the worker process until another key is
    asked for or ``forget`` is called: one object at a time."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def forget() -> None:
    """For tasks that need nothing of what an operator before them left."""
    _KEPT.clear()


def rows_of(columns: list[list], names: list[str], types: list) -> "object":
    """An Arrow record batch from Python lists."""
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
