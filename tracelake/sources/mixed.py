"""Parquet files of one table whose column types differ."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES_A_TASK = 200
ReadError = (PySparkException, Py4JJavaError)  # the merge of many footers fails in a job of the JVM


def cannot_merge(e: Exception) -> bool:
    """Whether a read failed because the files' types differ (and not for a
    missing path or a lost permission)."""
    text = str(e)
    return "CANNOT_MERGE" in text or "Failed to merge" in text


def open_input(uri: str):
    """A seekable file of a ``file:``, ``hdfs:``, ``s3:`` / ``s3a:`` or ``gs:`` address."""
    from urllib.parse import unquote

    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + unquote(uri[len("file:"):]).lstrip("/"))
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return system.open_input_file(path)


def file_types(spark: SparkSession, paths: list[str], opener: Callable = open_input) -> DataFrame:
    """``path, types`` of every Parquet file below ``paths``: a map from column
    to type name, from the footer.  The footers are read by tasks, the listing
    is Spark's; no column is read."""

    def footers(batches: Iterator) -> Iterator:
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path in batch["path"]:
                with opener(path) as f:
                    found.append({c.name: str(c.type) for c in pq.read_schema(f)})
            yield batch[["path"]].assign(types=found)

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path")
    tasks = max(1, -(-len(listed.inputFiles()) // FILES_A_TASK))
    return listed.repartition(tasks, "path").mapInPandas(footers, "path string, types map<string,string>")


def agreeing(kinds: list[dict[str, str]]) -> list[list[int]]:
    """Numbers of ``kinds`` (column types of files) in groups in which no column
    has two types; each goes to the first group that it agrees with."""
    groups: list[tuple[dict[str, str], list[int]]] = []
    for i, types in enumerate(kinds):
        for known, own in groups:
            if all(known.get(name, kind) == kind for name, kind in types.items()):
                known.update(types)
                own.append(i)
                break
        else:
            groups.append((dict(types), [i]))
    return [own for _, own in groups]


def read_mixed(
    spark: SparkSession, paths: list[str], align: Callable[[DataFrame], DataFrame], base: str | None = None,
    opener: Callable = open_input,
) -> DataFrame:
    """The files below ``paths`` as one table, whatever their column types.

    Files are grouped by the types in their footers, each group is one scan
    with merged columns, ``align`` gives it the common schema, and the groups
    are united: as many scans as there are groups of unlike types, not as
    there are files.  The driver holds the paths, as it does for any scan, and
    one row per distinct set of types.  ``base`` keeps partition folders as
    columns."""
    kinds = F.array_sort(F.map_entries("types"))
    own = file_types(spark, paths, opener).groupBy(kinds.alias("kinds")).agg(F.array_sort(F.collect_list("path")).alias("paths"))
    rows = sorted(own.collect(), key=lambda r: (-len(r["paths"]), str(r["kinds"])))
    out = None
    for group in agreeing([{e["key"]: e["value"] for e in r["kinds"]} for r in rows]):
        read = spark.read.option("mergeSchema", "true")
        if base is not None:
            read = read.option("basePath", base)
        one = align(read.parquet(*[p for i in group for p in rows[i]["paths"]]))
        out = one if out is None else out.unionByName(one)
    return out
