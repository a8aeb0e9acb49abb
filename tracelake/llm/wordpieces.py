"""SentencePiece encoding and decoding by vectorised merge rounds.

The model file holds pieces with scores; encoding a text means joining, again
and again, the adjacent pair of symbols whose joined piece has the best score,
the leftmost of equals.  Here many words are joined at once:

1. Texts are normalised (dummy prefix, spaces as U+2581) and cut wherever two
   neighbouring characters stand next to each other in no piece at all: no pair
   can ever be joined over such a cut, so the stretches between are words that
   do not depend on each other.  Equal words of a chunk are encoded once.
2. All words lie end to end in one flat numpy array of symbols, next to the
   rank of each symbol's pair with its right neighbour.  A round takes the
   least rank of every word (a segmented minimum), joins all its pairs of that
   rank, the leftmost of overlapping ones, closes the gaps and looks up only
   the pairs beside a join.  Words without a pair leave the arrays.
3. Rounds join all equals of a word at once, which is the one-by-one order as
   long as the new piece makes no pair of an equal or better rank.  Words with
   several joins in a round of which one makes such a piece (``Model.eager``),
   and words longer than ``LONG`` symbols, are joined pair by pair from a heap:
   the same order, in n log n steps.
4. Characters without a piece become the ids of their UTF-8 bytes.

Decoding gathers the bytes of all ids of a chunk in one flat array, with the
library's rules: the dummy prefix goes, control ids are empty, each byte that
is no UTF-8 becomes U+FFFD.

Tables are built from the model file once per worker process; what a task
holds beside them is one chunk of about ``CHUNK`` characters, or of one word if
that is longer.  The model must be of the BPE type with an identity
normaliser, byte pieces and no user-defined or unused pieces; others raise.

Defined results: a null or empty text has no ids and decodes to the empty
text; texts of any length are encoded whole; repeated rows, equal or null ids
are encoded each by itself; an empty table gives an empty one; other columns
are ignored.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import id_text

MODEL = "piece_bpe_32k.model"
CHUNK = 1_000_000  # characters encoded together
LONG = 4096  # symbols of a word, beyond which it is joined from a heap
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # piece types of the model format
BPE = 2  # model type of the model format
ENCODED = "doc_id long, ids array<int>"


def model_path(name: str) -> str:
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Model:
    """The tables of a model file, as numpy arrays."""

    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        kinds = np.array([p.type for p in proto.pieces])
        if (
            proto.trainer_spec.model_type != BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces
            or not spec.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix
            or not np.isin(kinds, (NORMAL, UNKNOWN, CONTROL, BYTE)).all() or (kinds == BYTE).sum() != 256
        ):
            raise ValueError(f"{path}: not a BPE model with byte pieces and an identity normaliser")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.size = len(proto.pieces)
        self.control, self.byte = kinds == CONTROL, kinds == BYTE
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        self._chars(normal)
        self._pairs(normal, np.array([p.score for p in proto.pieces]))
        self._bytes(proto)

    def _chars(self, normal: dict[str, int]) -> None:
        """``dense``: code point to a number from 1 (0: in no piece);
        ``symbol``: that number to a symbol; ``beside``: bit map of the pairs of
        characters that stand next to each other in a piece."""
        import numpy as np

        chars = sorted({c for piece in normal for c in piece})
        self.dense = np.zeros(0x110000, np.int32)
        self.dense[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        # characters that are part of pieces but no pieces themselves come after the vocabulary
        others = [c for c in chars if c not in normal]
        self.symbols = {**normal, **{c: self.size + i for i, c in enumerate(others)}}
        self.n_symbols = self.size + len(others)
        self.symbol = np.array([-1] + [self.symbols[c] for c in chars], np.int64)
        self.symbol_text = {i: c for c, i in self.symbols.items() if i >= self.size}
        self.width = len(chars) + 1
        pairs = {(a, b) for piece in normal for a, b in zip(piece, piece[1:])}
        keys = np.array(
            [int(self.dense[ord(a)]) * self.width + int(self.dense[ord(b)]) for a, b in pairs], np.int64
        )
        bits = np.zeros(self.width * self.width, bool)
        bits[keys] = True
        self.beside = np.packbits(bits, bitorder="little")

    def _pairs(self, normal: dict[str, int], scores) -> None:
        """Sorted ``keys`` of the pairs of symbols that make a piece, with the
        piece's ``rank`` (0: best score; equal scores share one) and id."""
        import numpy as np

        ranks = np.unique(-scores, return_inverse=True)[1]
        found = {}
        for piece, i in normal.items():
            for at in range(1, len(piece)):
                a, b = self.symbols.get(piece[:at]), self.symbols.get(piece[at:])
                if a is not None and b is not None:
                    found[a * self.n_symbols + b] = i
        self.keys = np.array(sorted(found), np.int64)
        self.made = np.array([found[k] for k in self.keys.tolist()], np.int64)
        self.rank = ranks[self.made].astype(np.int64)
        self.none = int(ranks.max()) + 1  # the rank of no pair
        # pieces that may take part in a pair as good as the one that made them
        eager = np.zeros(self.n_symbols, bool)
        own = np.full(self.n_symbols, -1)
        own[: self.size] = ranks
        for side in (self.keys // self.n_symbols, self.keys % self.n_symbols):
            eager[side[self.rank <= own[side]]] = True
        self.eager = eager

    def _bytes(self, proto) -> None:
        """The bytes that each id decodes to, end to end."""
        import numpy as np

        texts = []
        for i, p in enumerate(proto.pieces):
            if self.control[i]:
                texts.append(b"")
            elif self.byte[i]:
                texts.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type == UNKNOWN:
                texts.append(proto.trainer_spec.unk_surface.encode())
            else:
                texts.append(p.piece.replace(SPACE, " ").encode())
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(texts), np.uint8)
        self.spaced = np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in proto.pieces])
        self.byte_id = np.zeros(256, np.int64)
        self.byte_id[[t[0] for t, own in zip(texts, self.byte, strict=True) if own]] = np.flatnonzero(self.byte)

    # ------------------------------------------------------------- encoding

    def cuts(self, points, starts=()):
        """Where words start in an array of code points, in which texts start
        at ``starts``."""
        import numpy as np

        dense = self.dense[points]
        keys = dense[:-1].astype(np.int64) * self.width + dense[1:]
        start = np.ones(len(points), bool)
        start[1:] = (self.beside[keys >> 3] >> (keys & 7).astype(np.uint8)) & 1 == 0
        start[list(starts)] = True
        return np.flatnonzero(start)

    def pair_ranks(self, left, right):
        """Rank and piece of each pair; ``none`` where it makes no piece."""
        import numpy as np

        keys = left * self.n_symbols + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.rank[at], self.none), self.made[at]

    def encode_words(self, words: list[str]):
        """Ids of all words end to end, and the number of each word's ids."""
        import numpy as np

        sizes = np.fromiter(map(len, words), np.int64, len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbols = self.symbol[self.dense[points]]
        # a character in no piece keeps its code point, as a negative number
        symbols = np.where(symbols < 0, -1 - points.astype(np.int64), symbols)
        out: list = [None] * len(words)
        long = sizes > LONG
        starts = np.cumsum(sizes) - sizes
        for w in np.flatnonzero(long).tolist():
            out[w] = self.join_by_heap(symbols[starts[w] : starts[w] + sizes[w]])
        word = np.repeat(np.arange(len(words)), sizes)
        live = ~long[word]
        self._rounds(symbols[live], word[live], out)
        flat = np.concatenate(out) if out else np.zeros(0, np.int64)
        return self._as_ids(flat, np.fromiter(map(len, out), np.int64, len(out)))

    def _rounds(self, symbols, word, out: list) -> None:
        """Joins until no pair remains; ``out`` gets each word's symbols."""
        import numpy as np

        ranks = np.full(len(symbols), self.none)
        made = np.zeros(len(symbols), np.int64)

        def look(at) -> None:
            """Looks up the pairs that start at these places."""
            inside = at[at + 1 < len(symbols)]
            inside = inside[word[inside] == word[inside + 1]]
            ranks[at] = self.none
            ranks[inside], made[inside] = self.pair_ranks(symbols[inside], symbols[inside + 1])

        look(np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            least = np.minimum.reduceat(ranks, first)
            sizes = np.diff(np.append(first, len(symbols)))
            done = least == self.none
            if done.any():
                for w, a, n in zip(word[first[done]].tolist(), first[done].tolist(), sizes[done].tolist(), strict=True):
                    out[w] = symbols[a : a + n]
                stay = np.repeat(~done, sizes)
                symbols, word, ranks, made = symbols[stay], word[stay], ranks[stay], made[stay]
                least, sizes = least[~done], sizes[~done]
                if not len(symbols):
                    return
            hit = ranks == np.repeat(least, sizes)
            # of overlapping places every second one from the left
            at = np.flatnonzero(hit)
            run = np.concatenate([[True], np.diff(at) != 1])
            begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            again = np.zeros(len(at), bool)  # joins of words with several of them in this round
            again[1:] = word[at[1:]] == word[at[:-1]]
            again &= self.eager[made[at]] | np.append(False, self.eager[made[at[:-1]]])
            if again.any():
                slow = np.unique(word[at[again]])
                for w in slow.tolist():
                    a, b = np.searchsorted(word, [w, w + 1])
                    out[w] = self.join_by_heap(symbols[a:b])
                stay = ~np.isin(word, slow)
                joined = np.zeros(len(symbols), bool)
                joined[at] = True
                symbols, word, ranks, made, joined = symbols[stay], word[stay], ranks[stay], made[stay], joined[stay]
                at = np.flatnonzero(joined)
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            symbols, word, ranks, made = symbols[keep], word[keep], ranks[keep], made[keep]
            beside = np.zeros(len(symbols), bool)
            beside[new[at]] = True
            beside[np.maximum(new[at] - 1, 0)] = True
            look(np.flatnonzero(beside))

    def join_by_heap(self, symbols):
        """The same joins one at a time, best rank first, leftmost of equals."""
        import numpy as np

        symbols = symbols.tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs = self._pair_table()
        heap = []

        def push(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and symbols[i] >= 0 and symbols[j] >= 0:
                got = pairs.get(symbols[i] * self.n_symbols + symbols[j])
                if got is not None:
                    heapq.heappush(heap, (got[0], i, symbols[i], symbols[j], got[1]))

        for i in range(n):
            push(i)
        while heap:
            _, i, a, b, piece = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j] = piece, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(before[i])
            push(i)
        return np.array([s for s in symbols if s is not None], np.int64)

    def _pair_table(self) -> dict:
        if not hasattr(self, "_table"):
            self._table = dict(
                zip(self.keys.tolist(), zip(self.rank.tolist(), self.made.tolist(), strict=True), strict=True)
            )
        return self._table

    def _as_ids(self, symbols, sizes):
        """Symbols outside the vocabulary replaced by the ids of their bytes."""
        import numpy as np

        rare = (symbols < 0) | (symbols >= self.size)
        if not rare.any():
            return symbols, sizes
        texts = [chr(-1 - s) if s < 0 else self.symbol_text[s] for s in symbols[rare].tolist()]
        parts = [t.encode() for t in texts]
        n = np.ones(len(symbols), np.int64)
        n[rare] = [len(p) for p in parts]
        ids = np.repeat(symbols, n)
        ids[np.repeat(rare, n)] = self.byte_id[np.frombuffer(b"".join(parts), np.uint8)]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return ids, np.bincount(owner, n, len(sizes)).astype(np.int64)

    def encode(self, texts: list[str]):
        """Ids of all texts end to end, and the number of each text's ids.

        Chunks of about ``CHUNK`` characters, cut between words."""
        import numpy as np
        import pandas as pd

        ids, counts = [], np.zeros(len(texts), np.int64)

        def chunk(parts: list[tuple[int, str]]) -> None:
            joined = "".join(p for _, p in parts)
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            lengths = np.array([len(p) for _, p in parts], np.int64)
            starts = np.cumsum(lengths) - lengths
            cuts = self.cuts(points, starts)
            ends = np.append(cuts[1:], len(joined))
            words = [joined[a:b] for a, b in zip(cuts.tolist(), ends.tolist(), strict=True)]
            code, known = pd.factorize(np.array(words, object))
            flat, sizes = self.encode_words(list(known))
            first = np.cumsum(sizes) - sizes
            n = sizes[code]
            offsets = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ids.append(flat[np.repeat(first[code], n) + offsets].astype(np.int32))
            part = np.searchsorted(starts, cuts, "right") - 1
            of = np.array([i for i, _ in parts], np.int64)[part]
            np.add.at(counts, of, n)

        waiting, size = [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            text = self.prefix + text.replace(" ", SPACE)
            for part in self._split(text):
                waiting.append((i, part))
                size += len(part)
                if size >= CHUNK:
                    chunk(waiting)
                    waiting, size = [], 0
        if waiting:
            chunk(waiting)
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), counts

    def _split(self, text: str) -> Iterator[str]:
        """A text of more than ``CHUNK`` characters in parts that end between
        words."""
        import numpy as np

        at, size = 0, CHUNK
        while len(text) - at > size:
            points = np.frombuffer(text[at : at + size].encode("utf-32-le"), np.uint32)
            last = int(self.cuts(points)[-1])
            if last:
                yield text[at : at + last]
                at, size = at + last, CHUNK
            else:
                size *= 2  # one word so far
        yield text[at:]

    # ------------------------------------------------------------- decoding

    def decode(self, ids, counts) -> list[str]:
        """The texts of id lists that lie end to end."""
        import numpy as np

        ids = np.asarray(ids, np.int64)
        ends = np.cumsum(counts)
        n = self.lengths[ids].copy()
        first = self.starts[ids].copy()
        if self.prefix:
            # the first id that is not control loses the space of the dummy prefix
            owner = np.repeat(np.arange(len(counts)), counts)
            shown = np.flatnonzero(~self.control[ids])
            head = shown[np.unique(owner[shown], return_index=True)[1]]
            head = head[self.spaced[ids[head]]]
            first[head] += 1
            n[head] -= 1
        last = np.cumsum(n)
        offsets = np.arange(last[-1] if len(last) else 0) - np.repeat(last - n, n)
        flat = self.flat[np.repeat(first, n) + offsets].tobytes()
        total = np.concatenate([[0], last])
        # bytes on the two sides of a control id make no character together
        inner = np.flatnonzero(self.control[ids])
        cuts = np.sort(np.concatenate([[0], ends, inner]))
        bounds = total[cuts].tolist()
        parts = [flat[a:b].decode("utf-8", BAD_BYTE) for a, b in zip(bounds, bounds[1:])]
        if not len(inner):
            return parts
        own = np.searchsorted(cuts[1:], ends, "right").tolist()  # parts up to each text's end
        return ["".join(parts[a:b]) for a, b in zip([0, *own], own)]


BAD_BYTE = "tracelake-byte-by-byte"


def _one_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error(BAD_BYTE, _one_byte)

_MODELS: dict[str, Model] = {}  # a worker process keeps its tables from task to task


def model_of(name: str) -> Model:
    codecs.register_error(BAD_BYTE, _one_byte)
    if name not in _MODELS:
        _MODELS.clear()
        _MODELS[name] = Model(model_path(name))
    return _MODELS[name]


def groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``limit`` together."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, model: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the whole text's ``ids``, one row per document."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = model_of(model)
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1)
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1])
            for a, b in groups(sizes.tolist(), CHUNK):
                ids, counts = own.encode(texts.slice(a, b - a).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([docs.slice(a, b - a), lists], names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` that the ids decode to (null ids:
    the empty text)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        own = model_of(model)
        for batch in batches:
            docs, lists = batch.column(0), batch.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in groups(sizes.tolist(), CHUNK):
                part = lists.slice(a, b - a)
                texts = own.decode(part.flatten().to_numpy(zero_copy_only=False), sizes[a:b])
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(a, b - a), part, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, ENCODED + ", text string")


def digest(decoded: DataFrame) -> DataFrame:
    """Per document the number of ids, and hashes of ids and decoded text."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
