"""Benchmark decontamination: a broadcast hash set of the test items' word
n-grams, scanned over the words of every training document.

Words are the maximal runs of digits, letters a to z (A to Z lower-cased) and
characters beyond ASCII.  A window is ``n`` consecutive words of an item; an
item with fewer words (but not none) is one window.  Candidates are runs of
words that all occur in the items; each is verified against the exact windows.

The items are broadcast only up to ``block_bytes`` of text.  More items are
dealt into blocks near that size (a longer item is a block of its own size) and
every block scans all documents in turn, carrying the hits along with the row.
Between blocks the rows are written to the shared folder and the block's
broadcast is destroyed, so one block at a time is held by the driver and by a
worker; the documents are not joined or shuffled in either case.

Defined results: a null or empty text has no words and no hits; an empty item
(null text, no words) has no window; repeated rows are judged row by row; items
with a null id hit words but are no listed item; items that share an id count
once; an empty benchmark hits nothing; other columns are ignored by ``scan``
and kept by ``decontaminate``.
"""

from __future__ import annotations

import re
from itertools import repeat

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import Tables

NGRAM = 10
BLOCK_BYTES = 32 << 20

# Bytes that end a word become spaces, A-Z become a-z, all others stay.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Windows:
    """The hash set: word ids, and for each window length its windows."""

    def __init__(self, items: list[tuple], n: int):
        self.vocab: dict[bytes, int] = {}
        self.by_length: dict[int, dict[bytes, set]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words((text or "").encode())]
            if not ids:
                continue
            size = min(n, len(ids))
            found = self.by_length.setdefault(size, {})
            for i in range(len(ids) - size + 1):
                found.setdefault(_key(ids[i : i + size]), set()).add(item)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, merged word spans that are hit, items found."""
        import numpy as np

        own = words(text)
        total = len(own)
        ids = np.fromiter(map(self.vocab.get, own, repeat(0)), np.int32, total)
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        hits, items = [], set()
        for size, found in self.by_length.items():
            if size > total:
                continue
            for i in np.flatnonzero(known[size:] - known[:-size] == size).tolist():
                got = found.get(ids[i : i + size].tobytes())
                if got is not None:
                    hits.append((i, i + size))
                    items |= got
        return total, merged(hits), items


def _key(ids: list[int]) -> bytes:
    import numpy as np

    return np.array(ids, np.int32).tobytes()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> tuple[DataFrame, int]:
    """The items with a block number, and how many blocks keep each near
    ``block_bytes``; a block is read only when its turn comes."""
    items = benchmark.select(
        benchmark[id_col].cast("string").alias("item"), benchmark[text_col].cast("string").alias("text")
    ).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 8).alias("b")).first()["b"] or 0
    count = -(-size // block_bytes) if size else 0
    return items.withColumn("block", F.pmod(F.xxhash64("text", "item"), F.lit(max(1, count)))), count


def scan(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, block_bytes: int = BLOCK_BYTES,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """For every document: ``doc_id, n_words, spans`` (word spans that are hit,
    end exclusive) and ``items`` (ids as text, sorted)."""
    found = _scanned(docs, benchmark, F.struct(docs[id_col].cast("long").alias("doc_id")), n, block_bytes, text_col, item_col)
    return found.select("_row.doc_id", "n_words", "spans", "items")


def _scanned(docs: DataFrame, benchmark: DataFrame, row: Column, n: int, block_bytes: int, text_col: str, item_col: str) -> DataFrame:
    """``_text, n_words, spans, items`` and ``_row``, which is carried along."""
    spark = docs.sparkSession
    items, count = blocks_of(benchmark, item_col, "text", block_bytes)
    base = docs.select(
        F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<struct<a:long,b:long>>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
        row.alias("_row"),
    )
    schema = base.schema
    tables, written = Tables(spark), None
    for block in range(max(1, count)):
        rows = [] if not count else [tuple(r) for r in items.where(F.col("block") == block).select("item", "text").collect()]
        shared = spark.sparkContext.broadcast(rows)
        base = base.mapInArrow(_scanner(shared, n), schema)
        if block + 1 < count:
            before, written = written, tables.write(base)
            base = written
            shared.destroy()
            if before is not None:
                tables.drop(before)
    return base


def _scanner(shared, n: int):
    def run(batches):
        import pyarrow as pa

        windows = Windows(shared.value, n)
        for batch in batches:
            totals, spans, items = [], [], []
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            for text, (old_spans, old_items) in zip(batch.column("_text").to_pylist(), before, strict=True):
                total, hit, found = windows.scan(text)
                totals.append(total)
                spans.append([{"a": a, "b": b} for a, b in merged(hit + [(s["a"], s["b"]) for s in old_spans])])
                items.append(sorted({*old_items, *(x for x in found if x is not None)}))
            done = {"n_words": totals, "spans": spans, "items": items}
            yield pa.RecordBatch.from_arrays(
                [pa.array(done[f.name], f.type) if f.name in done else batch.column(f.name) for f in batch.schema],
                schema=batch.schema,
            )

    return run


def without_spans(text: bytes, spans: list) -> bytes:
    """The text without its words number a to b (and what stands between)."""
    ends = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for s in spans:
        out.append(text[at : ends[s["a"]][0]])
        at = ends[s["b"] - 1][1]
    return b"".join([*out, text[at:]])


def _cleaned(batches):
    import pyarrow as pa

    for batch in batches:
        rows = zip(batch.column("_text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
        texts = pa.array([without_spans(t, s) if s else t for t, s in rows], batch.schema.field("_text").type)
        yield batch.set_column(batch.schema.names.index("_text"), "_text", texts)


def decontaminate(docs: DataFrame, benchmark: DataFrame, drop: bool = True, n: int = NGRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with all their columns, without benchmark passages: whole
    documents go (``drop``), or only the spans that are hit."""
    row = F.struct(*[docs[c] for c in docs.columns])
    found = _scanned(docs, benchmark, row, n, block_bytes, "text", "item_id")
    if drop:
        return found.where(F.size("spans") == 0).select("_row.*")
    found = found.select("_text", "spans", "_row")
    found = found.mapInArrow(_cleaned, found.schema)
    text = F.when(F.size("spans") == 0, F.col("_row.text")).otherwise(F.col("_text").cast("string"))
    return found.select(*[text.alias("text") if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


def digest(found: DataFrame) -> DataFrame:
    """The columns of the ``op7`` query."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["b"] - s["a"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
