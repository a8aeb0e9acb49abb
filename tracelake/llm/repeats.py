"""Exact removal of long repeated byte strings with a sparse suffix array
sorted deep-shallow.

A byte goes when a ``MATCH``-byte string that covers it also starts anywhere
else, in the same text or another.

1. Anchors.  In every window of ``MATCH`` bytes the ``GRAM``-byte gram with the
   smallest hash (leftmost among equals) is the window's anchor: equal windows
   have equal anchors at equal offsets.  A text has about one anchor in 85
   bytes.  Only anchors whose gram occurs twice or more can lie in a repeat.
2. Equal texts are one text with a count: a text with copies goes whole.
3. The context of an anchor (the bytes of all windows that have it) is dealt to
   a task by the gram's hash.  There the suffixes that start at anchors, and
   the reversed prefixes that end there, are sorted: multikey quicksort on
   8-byte characters to ``SHALLOW`` bytes, then a blind trie for each group
   that still agrees.  Neighbours' common prefixes give, for every offset, the
   classes of contexts that agree left and right of the anchor; two contexts
   in one class are a repeated window.  Equal contexts are combined before they
   are dealt, and sorted once.
4. A gram with more than ``HOT`` contexts (the edge of a passage that a third
   of all texts share) is not gathered in one task: its distinct contexts,
   combined map-side, are spread, each window is counted by a 128-bit hash,
   and windows counted twice or more come back to their contexts.
5. Covered runs are joined with the text by document and taken out.

Defined results: a null or empty text keeps its 0 bytes; texts under ``MATCH``
bytes lose nothing; texts of any length are judged whole; repeated rows are
copies of one another; rows with a null doc_id count like others; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import cut, id_text, only

MATCH = 200
GRAM = 32
WINDOW = MATCH - GRAM + 1
SHALLOW = 24  # bytes that multikey quicksort looks at
HOT = 1 << 16  # contexts of one gram that are sorted in one task: 24 MB at most
BLOCK_BYTES = 24 << 20  # contexts that a task sorts together
CHUNK = 1 << 22  # window starts looked at together


def _gram_hashes(b):
    """A 64-bit hash of every 32-byte gram of a uint8 array."""
    import numpy as np

    w = b.astype(np.uint64)
    for width in (1, 2, 4):
        w = w[:-width] | (w[width:] << np.uint64(8 * width))
    h = w[:-24] * np.uint64(0x9E3779B97F4A7C15)
    for at, times in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0xD6E8FEB86659FD93)):
        h ^= h >> np.uint64(29)
        h += w[at : len(w) - 24 + at]
        h *= np.uint64(times)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def anchors(text: bytes) -> tuple[list[int], list[int], list[int], list[int]]:
    """Positions of the anchors, first and last window start of each, and the
    hashes of their grams (signed)."""
    import numpy as np

    starts = len(text) - MATCH + 1
    pos, lo, hashes = [], [], []
    for c in range(0, max(0, starts), CHUNK):
        n = min(CHUNK, starts - c)
        h = _gram_hashes(np.frombuffer(text, np.uint8, n + MATCH - 1, c))
        order = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        least, width = order, 1
        while 2 * width <= WINDOW:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: n], least[WINDOW - width : WINDOW - width + n])
        at = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        new = at[first] + c
        keep = 1 if pos and pos[-1] == new[0] else 0  # goes on from the chunk before
        pos += new[keep:].tolist()
        lo += (first[keep:] + c).tolist()
        hashes += h[at[first[keep:]]].view(np.int64).tolist()
    hi = [x - 1 for x in lo[1:]] + ([starts - 1] if lo else [])
    return pos, lo, hi, hashes


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    n = min(len(a), len(b))
    x, y = a[start:n], b[start:n]
    if x == y:
        return n
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return start + (8 * len(x) - differ.bit_length()) // 8


def blind_trie(strings: list[bytes], members: list[int], depth: int) -> list[int]:
    """The members in order; all agree on their first ``depth`` bytes.

    A trie of branching depths and single bytes: a string goes down by those
    bytes alone, is compared once with the leaf it reaches, and is put in
    where the two part.  An inner node is (depth, {byte: node}).
    """

    def byte(i: int, d: int) -> int:
        s = strings[i]
        return s[d] if d < len(s) else -1

    root: dict = {0: Leaf([members[0]])}
    for i in members[1:]:
        node = root[0]
        while not isinstance(node, Leaf):
            d, kids = node
            node = kids.get(byte(i, d)) or next(iter(kids.values()))
        other = node[0]
        at = common_prefix(strings[i], strings[other], depth)
        if at == len(strings[i]) == len(strings[other]):
            node.append(i)
            continue
        kids, key, node = root, 0, root[0]
        while not isinstance(node, Leaf) and node[0] < at:
            kids, key = node[1], byte(i, node[0])
            node = kids[key]
        if not isinstance(node, Leaf) and node[0] == at:
            node[1][byte(i, at)] = Leaf([i])
        else:
            kids[key] = (at, {byte(i, at): Leaf([i]), byte(other, at): node})
    out: list[int] = []
    stack = [root[0]]
    while stack:
        node = stack.pop()
        if isinstance(node, Leaf):
            out += node
        else:
            stack += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


class Leaf(list):
    """Members of a blind trie that are equal strings."""


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Indices of the strings in lexicographic order."""
    out: list[int] = []
    stack: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while stack:
        members, depth = stack.pop()
        if len(members) == 1 or depth < 0:  # alone, or ended and equal
            out += members
        elif depth >= shallow:
            out += blind_trie(strings, members, depth)
        else:
            chars = [strings[i][depth : depth + 8] for i in members]
            pivot = sorted((chars[0], chars[len(chars) // 2], chars[-1]))[1]
            less = [i for i, c in zip(members, chars, strict=True) if c < pivot]
            same = [i for i, c in zip(members, chars, strict=True) if c == pivot]
            more = [i for i, c in zip(members, chars, strict=True) if c > pivot]
            if more:
                stack.append((more, depth))
            stack.append((same, depth + 8 if len(pivot) == 8 else -1))
            if less:
                stack.append((less, depth))
    return out


def repeated_starts(groups: list[list[tuple[int, bytes, int]]]):
    """For groups of contexts ``(offset of the anchor, bytes, copies)`` with
    one gram each: a matrix of rows (contexts, all groups in turn) by window
    starts in the context, true where the window occurs twice or more."""
    import numpy as np

    flat = [c for g in groups for c in g]
    n = len(flat)
    off = np.array([c[0] for c in flat])
    wins = np.array([len(c[1]) - MATCH + 1 for c in flat])
    copies = np.array([c[2] for c in flat])
    sides = []
    for strings in ([c[1][: c[0]][::-1] for c in flat], [c[1][c[0] :] for c in flat]):
        order, common, at = [], [], 0
        for g in groups:
            own = strings[at : at + len(g)]
            ranked = deep_shallow(own)
            common.append(-1)
            common += [common_prefix(own[a], own[b]) for a, b in zip(ranked, ranked[1:])]
            order += [at + i for i in ranked]
            at += len(g)
        sides.append((np.array(order), np.array(common)))
    (left_order, left), (right_order, right) = sides
    out = (np.arange(WINDOW)[None, :] < wins[:, None]) & (copies > 1)[:, None]
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(WINDOW):  # windows that start o bytes before their anchor
        own = np.flatnonzero((o <= off) & (off - o < wins))
        if len(own) < 2:
            continue
        left_class[left_order] = np.cumsum(left < o)
        right_class[right_order] = np.cumsum(right < MATCH - o)
        _, which, count = np.unique(left_class[own] * (n + 1) + right_class[own], return_inverse=True, return_counts=True)
        hit = own[count[which] > 1]
        out[hit, off[hit] - o] = True
    return out


def covered(starts) -> list[list[int]]:
    """Per row of a start matrix the covered bytes as a, b, a, b, ..."""
    import numpy as np

    edge = np.diff(np.pad(starts.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, first = np.nonzero(edge == 1)
    _, after = np.nonzero(edge == -1)
    out: list[list[int]] = [[] for _ in range(len(starts))]
    for r, a, b in zip(rows.tolist(), first.tolist(), after.tolist(), strict=True):
        out[r] += [a, b - 1 + MATCH]
    return out


FOUND = "doc_id long, md5 binary, n_bytes long, sha256 string, grams array<long>"


def looked_at(docs: DataFrame) -> DataFrame:
    def run(batches):
        from hashlib import md5, sha256

        import pyarrow as pa

        for batch in batches:
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([md5(t).digest() for t in texts], pa.binary()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.array([anchors(t)[3] for t in texts], pa.list_(pa.int64())),
                ],
                names=["doc_id", "md5", "n_bytes", "sha256", "grams"],
            )

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, FOUND)


CONTEXTS = "gram long, off int, context binary, keys array<binary>, los array<long>"


def contexts(texts: DataFrame) -> DataFrame:
    """Contexts of the anchors whose numbers ``own`` lists, from ``md5, text,
    own``; equal ones that a task meets are one row with their places."""

    def run(batches):
        import pyarrow as pa

        def batch_of(places: dict[tuple, tuple[list, list]]):
            types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
            columns = list(zip(*((*c, *at) for c, at in places.items()), strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["gram", "off", "context", "keys", "los"]
            )

        places: dict[tuple, tuple[list, list]] = {}
        n = 0
        for batch in batches:
            for key, text, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                pos, lo, hi, grams = anchors(text)
                for i in own:
                    if i < len(pos):
                        at = places.setdefault((grams[i], pos[i] - lo[i], text[lo[i] : hi[i] + MATCH]), ([], []))
                        at[0].append(key)
                        at[1].append(lo[i])
                        n += 1
                if len(places) >= 60_000 or n >= 400_000:
                    yield batch_of(places)
                    places, n = {}, 0
        yield batch_of(places)

    return texts.mapInArrow(run, CONTEXTS)


def sorted_spans(found: DataFrame) -> DataFrame:
    """``md5, spans`` (flat, in the text) of the contexts that are repeated at
    least in part, each gram's contexts sorted in one task."""

    def run(batches):
        import pyarrow as pa

        def done(rows: list[tuple]):
            members: dict[int, dict[tuple, list]] = {}
            for gram, off, context, places, los in rows:
                members.setdefault(gram, {}).setdefault((off, context), []).extend(zip(places, los, strict=True))
            groups = [[(off, c, len(m)) for (off, c), m in g.items()] for g in members.values()]
            keys, spans = [], []
            if groups:
                ranges = iter(covered(repeated_starts(groups)))
                for g in members.values():
                    for (_, own), rel in zip(g.items(), ranges):
                        for md5, lo in own if rel else ():
                            keys.append(md5)
                            spans.append([lo + x for x in rel])
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(spans, pa.list_(pa.int64()))], names=["md5", "spans"])

        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if size > BLOCK_BYTES and row[0] != rows[-1][0]:
                    yield done(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[2]) + 60 * len(row[3])
        yield done(rows)

    dealt = found.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, "md5 binary, spans array<long>")


def counted_spans(found: DataFrame) -> DataFrame:
    """The same for hot grams: windows are counted by hash, spread over tasks."""
    found = cut(found.withColumn("of", F.unhex(F.md5(F.concat(F.col("off").cast("string").cast("binary"), "context")))))
    distinct = cut(
        found.groupBy("gram", "of").agg(F.first("off").alias("off"), F.first("context").alias("context"), F.sum(F.size("keys")).alias("n"))
    )

    def run(batches):
        import pyarrow as pa
        from xxhash import xxh3_128_digest

        for batch in batches:
            for gram, of, context, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                starts = range(len(context) - MATCH + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([gram] * len(starts), pa.int64()),
                        pa.array([of] * len(starts), pa.binary()),
                        pa.array(starts, pa.int64()),
                        pa.array([n] * len(starts), pa.int64()),
                        pa.array([xxh3_128_digest(context[s : s + MATCH]) for s in starts], pa.binary()),
                    ],
                    names=["gram", "of", "start", "n", "window"],
                )

    windows = distinct.select("gram", "of", "context", "n").mapInArrow(
        run, "gram long, of binary, start long, n long, window binary"
    )
    windows = cut(windows)
    often = cut(windows.groupBy("window").agg(F.sum("n").alias("n")).where("n > 1").select("window"))
    hit = windows.join(often, "window").groupBy("gram", "of").agg(F.collect_list("start").alias("starts"))
    rel = F.flatten(F.transform("starts", lambda s: F.array(s, s + MATCH)))
    hit = cut(hit.select("gram", "of", rel.alias("rel")))
    places = found.join(hit, ["gram", "of"]).select("rel", F.explode(F.arrays_zip("keys", "los")).alias("at"))
    return places.select(F.col("at.keys").alias("md5"), F.transform("rel", lambda x: x + F.col("at.los")).alias("spans"))


def taken_out(texts: DataFrame) -> DataFrame:
    """``md5, n_removed, n_spans, kept`` from ``md5, text, spans``."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            removed, runs, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                out, at, n, gone = [], 0, 0, 0
                end = -1
                for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
                    if a > end:
                        n += 1
                        out.append(text[at:a])
                    gone += max(0, b - max(a, at if a <= end else a))
                    at = end = max(at, end, b)
                removed.append(gone)
                runs.append(n)
                kept.append(b"".join([*out, text[at:]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                names=["md5", "n_removed", "n_spans", "kept"],
            )

    return texts.mapInArrow(run, "md5 binary, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Two frames: for every row ``doc_id, md5, n_bytes, sha256, copies``, and
    for every text that lost bytes (and has no copy; texts with copies go
    whole) ``md5, n_removed, n_spans, kept``."""
    texts = id_text(docs, id_col, text_col)
    found = cut(looked_at(texts))
    same = cut(found.groupBy("md5").agg(F.min("doc_id").alias("rep"), F.count("md5").alias("copies")))
    whole = texts.select("doc_id", F.col("text").cast("binary").alias("text"), F.unhex(F.md5("text")).alias("md5"))

    first = found.where(F.size("grams") > 0).join(same, "md5").where(F.col("doc_id").eqNullSafe(F.col("rep")))
    first = cut(first.select(F.xxhash64("md5").alias("tid"), "md5", "rep", "copies", "grams"))
    grams = first.select("tid", F.posexplode("grams").alias("i", "gram"))
    often = cut(grams.groupBy("gram").agg(F.count("i").alias("n")).where("n > 1").select("gram", (F.col("n") > hot).alias("hot")))
    wanted = grams.join(often, "gram").groupBy("tid").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("i"))).alias("cold"), F.collect_set(F.when(F.col("hot"), F.col("i"))).alias("hot")
    )
    wanted = cut(wanted.join(first.select("tid", "md5", "rep"), "tid").withColumnRenamed("md5", "key"))

    at = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("md5") == F.col("key"))
    here = only(whole, wanted.select("rep")).join(wanted, at)
    spans = sorted_spans(contexts(here.where(F.size("cold") > 0).select("md5", "text", "cold")))
    if not often.where("hot").isEmpty():
        spans = spans.unionByName(counted_spans(contexts(here.where(F.size("hot") > 0).select("md5", "text", "hot"))))
    alone = same.where("copies = 1").select(F.col("md5").alias("key"), "rep")
    spans = spans.groupBy("md5").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = cut(spans.join(alone, spans["md5"] == alone["key"]).select("key", "rep", "spans"))
    changed = taken_out(only(whole, spans.select("rep")).join(spans, at).select("md5", "text", "spans"))
    rows = found.select("doc_id", "md5", "n_bytes", "sha256").join(same.select("md5", "copies"), "md5")
    return rows, changed


def digest(rows: DataFrame, changed: DataFrame) -> DataFrame:
    """The columns of the ``op6`` query."""
    changed = cut(changed.select("md5", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= MATCH)

    def value(whole, name, other):
        return F.when(gone, whole).otherwise(F.coalesce(F.col(name), other)).alias(name)

    return rows.join(changed, "md5", "left").select(
        "doc_id",
        "n_bytes",
        value(F.col("n_bytes"), "n_removed", F.lit(0).cast("long")),
        value(F.lit(1).cast("long"), "n_spans", F.lit(0).cast("long")),
        value(F.sha2(F.lit(b""), 256), "kept_sha256", F.col("sha256")),
    )
