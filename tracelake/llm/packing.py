"""Packing of tokenised documents into sequences, shortest pack first over the
histogram of lengths.

1. Tokenise every whole text on the executors, add the end id, and cut the ids
   into pieces of at most ``size`` ids; the ids of a piece are kept as a CRC-32
   (or, with ``keep_ids``, as an array).
2. Count the pieces by length: at most ``size`` numbers, whatever the input.
3. Place lengths longest first, all pieces of one length at a time.  Open
   packs are kept as ranges of sequence numbers by the space they have left; a
   length goes to the packs with the most space (the shortest packs) that it
   fits, a range splits when it is used in part, and new packs open when none
   fits.  Each step is one row (length, ranks, first sequence, offset).
4. Rank the pieces within their length and look their step up.

The rank is counted in ``SALTS`` hash buckets per length, with the buckets'
counts summed up before, so that a length that a third of all pieces share is
still ranked by many tasks.

Defined results: a null or empty text is the end id alone; a text of any
length is tokenised whole; ties in length are ranked by hash, document and
start; repeated rows are documents of their own; an empty table has no pieces;
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import insort
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut, id_text, kept

SIZE = 4096
END_ID = 2
END = END_ID.to_bytes(4, "little")
SALTS = 64
CACHE_WORDS = 400_000  # in each half of a store of a worker process, about 60 MB
ROWS = 500  # documents whose pieces are held at a time
CALL_WORDS = 1000  # encoded in one call
WORD_END = "</w>"
SPECIAL = b"<|"  # special tokens start so
# Letters (and all of non-ASCII), then ASCII punctuation but the apostrophe, at
# which words like "it's" are split by other rules.
WORD = re.compile(rb"([a-z\x80-\xff]+)([!-&(-/:-@\[-`{-~]*)")
# A capital before a letter outside ASCII: a combining mark composes with some
# capitals and not with their small letters, or the other way round.
CAPITAL = re.compile(rb"[A-Z][\x80-\xff]")
BROADCAST_STEPS = 100_000
TOKENIZER = "word_bpe_49k.json"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Store:
    """Ids by word, in two halves: when ``now`` is full it becomes the old one,
    whose words come back as they are met again."""

    def __init__(self, limit: int):
        self.limit = limit
        self.now: dict = {}
        self.old: dict = {}

    def __len__(self) -> int:
        return len(self.now)

    def missing(self, words: list) -> list:
        """The words that are in neither half; afterwards all others are in ``now``."""
        new = set(words).difference(self.now)
        if len(self.now) + len(new) > self.limit:
            self.now, self.old = {}, self.now
            new = set(words)
        if new and self.old:
            found = {w: self.old[w] for w in new if w in self.old}
            self.now.update(found)
            new.difference_update(found)
        return list(new)


class Encoder:
    """Ids of whole texts.

    This vocabulary lower-cases, splits at white space and ends each word with
    an id whose token ends in ``WORD_END``.  So texts are cut at ASCII white
    space and lower-cased, except the stretches with a capital that normalising
    may compose with a mark first, and a stretch is encoded once, as long as the
    bounded stores hold it.  Most stretches are one word of plain letters and a tail
    of ASCII punctuation; such words are encoded many in one call, without the
    steps that change nothing in them, and told apart by their last ids.
    Other stretches are encoded one by one, and texts that may hold a special
    token, or those of a vocabulary without ``WORD_END``, whole."""

    def __init__(self, tokenizer: str, cache_words: int | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        from tokenizers import Tokenizer, pre_tokenizers

        if "/" not in tokenizer:
            import public_tokenizers

            tokenizer = public_tokenizers.path(tokenizer)
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.by_words = getattr(self.tokenizer.model, "end_of_word_suffix", None) == WORD_END
        self.bare = Tokenizer(self.tokenizer.model)  # the same tables, no second copy of them
        split = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(split)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # ids as bytes: joining them is cheap, and the collector skips them
        self.known = Store(cache_words or CACHE_WORDS)
        self.words = Store(cache_words or CACHE_WORDS)

    def encode(self, text: bytes):
        import numpy as np

        if not self.by_words or SPECIAL in text:
            ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
            return np.array([*ids, END_ID], np.uint32)
        if CAPITAL.search(text):
            own = [x if CAPITAL.search(x) else x.lower() for x in text.split()]
        else:
            own = text.lower().split()
        new = self.known.missing(own)
        if new:
            self.learn(new)
        return np.frombuffer(b"".join(map(self.known.now.__getitem__, own)) + END, "<u4")

    def learn(self, stretches: list[bytes]) -> None:
        """Puts the ids of stretches, lower-cased or as they stand, into the store."""
        words: dict[bytes, tuple[str, bytes]] = {}
        rest = set()
        for stretch in stretches:
            match = WORD.fullmatch(stretch)
            if match and plain(word := match[1].decode()):
                words[stretch] = word.lower(), match[2]
                rest.add(match[2])
            else:
                rest.add(stretch)
        rest.discard(b"")
        got = self.tokenizer.encode_batch_fast([x.decode() for x in rest], add_special_tokens=False)
        others = {x: as_bytes(g.ids) for x, g in zip(rest, got, strict=True)} | {b"": b""}
        new = self.words.missing([word for word, _ in words.values()])
        for i in range(0, len(new), CALL_WORDS):
            self.learn_words(new[i : i + CALL_WORDS])
        for stretch in stretches:
            if stretch in words:
                word, tail = words[stretch]
                self.known.now[stretch] = self.words.now[word] + others[tail]
            else:
                self.known.now[stretch] = others[stretch]

    def learn_words(self, new: list[str]) -> None:
        import numpy as np

        ids = self.bare.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids
        ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
        joined = as_bytes(ids)
        for word, start, end in zip(new, [0, *ends[:-1]], ends, strict=True):
            self.words.now[word] = joined[start:end]


def as_bytes(ids: list[int]) -> bytes:
    import numpy as np

    return np.array(ids, "<u4").tobytes()


def plain(word: str) -> bool:
    """Letters below U+0180 only, lower-cased to such letters: normalising
    changes nothing else in them, and they are never split."""
    return word.isalpha() and max(word) < "\u0180" and word.lower().isalpha()


def encoder_of(tokenizer: str, cache_words: int | None = None) -> Encoder:
    """A worker process keeps its encoder from task to task."""
    return kept(("packing", tokenizer, cache_words), lambda: Encoder(tokenizer, cache_words))


def pieces(docs: DataFrame, size: int = SIZE, tokenizer: str = TOKENIZER, keep_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text", cache_words: int | None = None) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``, and
    ``ids`` if asked for.  A worker process holds the ids of at most four times
    ``cache_words`` stretches: fewer take less memory and more time."""

    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        encoder = encoder_of(tokenizer, cache_words)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                rows: list[tuple] = []
                kept = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encoder.encode(text)
                    for start in range(0, len(ids), size):
                        piece = ids[start : start + size].astype("<u4", copy=False)
                        rows.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                        if keep_ids:
                            kept.append(piece.astype("int32"))
                columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)]
                if keep_ids:
                    columns.append(pa.array(kept, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * keep_ids)

    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return id_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """Steps ``(length, first rank, rank after the last, first sequence,
    offset)`` that place every piece of the histogram."""
    steps, sequences = [], 0
    spaces: list[int] = []  # spaces that open packs have left, ascending
    packs: dict[int, list[tuple[int, int]]] = {}  # space: ranges of sequences

    def put(space: int, first: int, end: int) -> None:
        if space:
            if space not in packs:
                packs[space] = []
                insort(spaces, space)
            packs[space].append((first, end))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        back = []
        while left:
            if spaces and spaces[-1] >= length:
                space = spaces[-1]
                first, end = packs[space].pop()
                if not packs[space]:
                    del packs[space], spaces[-1]
            else:
                space, first = size, sequences
                each = size // length  # a new pack takes the length as often as it fits
                end = sequences = first + -(-left // each)
            n = min(left, end - first)
            steps.append((length, rank, rank + n, first, size - space))
            if first + n < end:
                put(space, first + n, end)
            if space - length >= length:
                put(space - length, first, first + n)
            else:
                back.append((space - length, first, first + n))
            rank, left = rank + n, left - n
        for x in back:
            put(*x)
    return steps


def step_table(spark: SparkSession, steps: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """The steps as an Arrow table: a list would go through Python workers of its
    own on the executors, beside those of the operators."""
    import pyarrow as pa

    names = ["_length", "_from", "_to", "_first", "_at"]
    schema = "_length long, _from long, _to long, _first long, _at long"
    if not steps:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in zip(*steps, strict=True)], names), schema)


def pack(found: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (as ``pieces`` returns)."""
    spark = found.sparkSession
    found = cut(found)  # tokenised once, read for the histogram and for the ranks
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS)).cast("int"))
    counts = cut(salted.groupBy("length", "_salt").count())
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    steps = shortest_pack_first(histogram, size)
    before = counts.select(
        "length", "_salt",
        (F.sum("count").over(Window.partitionBy("length").orderBy("_salt")) - F.col("count")).alias("_before"),
    )
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "start", "ids_crc32"))
    ranked = (
        salted.withColumn("_own", own - 1)
        .join(before, ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_own"))
    )
    plan = step_table(spark, steps)
    if len(steps) <= BROADCAST_STEPS:
        plan = F.broadcast(plan)
    at = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    return ranked.join(plan, at).select(
        *found.columns,
        (F.col("_first") + F.col("_rank") - F.col("_from")).alias("sequence_id"),
        F.col("_at").alias("offset"),
    )
