"""MinHash near-duplicates with odd sketches for checking candidates.

A document's set holds the hashes of its distinct 5-word shingles.  Documents
are linked when 100 * |A and B| >= 75 * |A or B|; links are confirmed on the
full sets, and a class is a connected component.

1. Each whole text becomes a set, its ``BANDS * ROWS`` MinHash samples, the
   bands' keys, and an odd sketch: a bitmap in which every sample flips one
   bit.  The population count of two sketches' XOR estimates how many samples
   differ; the sketch folds in more samples than the bands use.  The chance
   that a link shares no band is below 1e-7 at the limit.  A second bitmap
   folds in the whole set: the XOR's population count is never above the
   number of shingles that differ, so a pair whose count is too high for its
   two set sizes is no link for certain.  Pairs must be near by both.
2. Equal sets are one candidate (their smallest id).
3. Star rounds: in every band bucket each member is a candidate with the
   bucket's smallest id; per member the partner it shares most buckets with is
   confirmed if their sketches are near.  That is one pair a document, whatever
   the bucket's size.
   As long as step 4 would look at more than ``CROSS`` pairs a member, up to
   ``ROUNDS`` more rounds do so with leaders drawn by a hash, for members of
   other components than the leader's.
4. The rest: in buckets whose members lie in several components, members
   outside the leader's component are candidates with all members of other
   components whose sketch is near enough, in the first bucket they share.
   Buckets that are still large there (texts that share a passage, say) are
   split by each second band, so that pairs meet only if they share two.
5. Components by large-star and small-star rounds over the confirmed links.

Sets travel only for documents in a candidate pair, to the pair's other member.
Hot ids (a leader of many members) meet in joins of two shuffles, which Spark
splits when skewed.  Tables between the steps are Parquet files in the shared
folder, removed once what follows from them is written.

Defined results: a null or empty text, or one without words, has no shingle,
is linked with nothing and kept; fewer than five words are one shingle; ties go
to the smaller id; rows that share a doc_id are one document as to links; rows
with a null doc_id are linked with nothing and kept, with a null component; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import BROADCAST_IDS, Tables, among, id_text

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 3
SAMPLES = 512  # of the odd sketch; the bands use the first ones
SKETCH_WORDS = 16  # 64 bits each
MAX_XOR = 290  # bits; at 75 % similarity the mean is 201 and the deviation 17
ROUNDS = 1  # star rounds with drawn leaders
CROSS = 100
LARGE = 20_000  # members from which a mixed bucket is split by a second band
CHUNK = 1024
EDGES_A_TASK = 8192  # the star rounds use no more tasks than their edges need


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: bytes):
    """Sorted distinct 64-bit hashes of the text's 5-word shingles."""
    import numpy as np
    from xxhash import xxh64_intdigest

    own = text.lower().split()  # A-Z and ASCII white space only, as bytes
    if not own:
        return np.empty(0, np.uint64)
    if len(own) < SHINGLE:
        return np.array([xxh64_intdigest(b" ".join(own), 1)], np.uint64)
    h = np.fromiter(map(xxh64_intdigest, own), np.uint64, len(own))
    n = len(own) - SHINGLE + 1
    s = h[:n].copy()
    for j in range(1, SHINGLE):
        s *= np.uint64(0x9E3779B97F4A7C15)
        s += h[j : n + j]
    return np.unique(_mix(s))


class Hasher:
    """MinHash samples, band keys and odd sketches; the same on every worker."""

    def __init__(self):
        import numpy as np

        k = SAMPLES
        seed = _mix(np.arange(1, 2 * k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.flip = (seed[:k] >> np.uint64(32)).astype(np.uint32)[:, None]
        self.times = ((seed[k:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
        self.number = np.arange(k, dtype=np.uint64) << np.uint64(32)
        self.band = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)

    def samples(self, hashes):
        import numpy as np

        low = (hashes >> np.uint64(32)).astype(np.uint32)
        best = None
        for i in range(0, len(low), CHUNK):
            got = ((low[None, i : i + CHUNK] ^ self.flip) * self.times).min(axis=1)
            best = got if best is None else np.minimum(best, got)
        return best

    def keys(self, samples):
        import numpy as np

        rows = samples[: BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
        key = self.band.copy()
        for r in range(ROWS):
            key = _mix(key + rows[:, r])
        return key.view(np.int64)

    def sketch(self, samples):
        import numpy as np

        return parities(_mix(samples.astype(np.uint64) | self.number))


def parities(hashes):
    """Odd sketch: every hash flips one bit."""
    import numpy as np

    bits = SKETCH_WORDS * 64
    at = (hashes % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(at, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


SKETCHED = "doc_id long, n_shingles long, set_key binary, bands array<long>, odd array<long>, whole array<long>"


def sketched(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        from hashlib import md5

        import numpy as np
        import pyarrow as pa

        hasher = Hasher()
        for batch in batches:
            sizes, keys, bands, odds, wholes = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                own = shingles(text)
                sizes.append(len(own))
                if len(own):
                    samples = hasher.samples(own)
                    keys.append(md5(own.tobytes()).digest())
                    bands.append(hasher.keys(samples))
                    odds.append(hasher.sketch(samples))
                    wholes.append(parities(own))
                else:
                    keys.append(None)
                    bands.append(np.empty(0, np.int64))
                    odds.append(np.empty(0, np.int64))
                    wholes.append(np.empty(0, np.int64))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (bands, odds, wholes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), *lists],
                names=["doc_id", "n_shingles", "set_key", "bands", "odd", "whole"],
            )

    return id_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary")).mapInArrow(run, SKETCHED)


def _xor(a: str, b: str):
    """Bits in which two odd sketches differ."""
    x, y = F.col(a), F.col(b)
    return reduce(add, [F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(SKETCH_WORDS)])


def _may_link(whole_a: str, whole_b: str, size_a: str, size_b: str):
    """False only for pairs that differ in too many shingles for a link."""
    return _xor(whole_a, whole_b) * (100 + PERCENT) <= (F.col(size_a) + F.col(size_b)) * (100 - PERCENT)


def confirmed(pairs: DataFrame, docs: DataFrame, tables: Tables) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    pairs = tables.write(pairs.select("a", "b"))
    near = _bounded(pairs)

    def sets(batches):
        import pyarrow as pa

        for batch in batches:
            found = [shingles(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "set"])

    def sets_of(ids: DataFrame, name: str) -> DataFrame:
        ids = ids.toDF("_id").distinct()
        own = docs.join(near(ids), docs["doc_id"] == ids["_id"], "left_semi")
        own = own.select("doc_id", F.col("text").cast("binary")).mapInArrow(sets, "id long, set binary")
        return own.select(F.col("id").alias(name), F.col("set").alias(f"set_{name}"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets_of(pairs.select("a"), "a").join(near(pairs), "a")
    joined = left.join(sets_of(pairs.select("b"), "b"), "b").select("a", "b", "set_a", "set_b")
    links = tables.write(joined.mapInArrow(run, "a long, b long"))
    tables.drop(pairs)
    return links


def _bounded(table: DataFrame):
    """What to do with frames of at most the rows of ``table`` (two numbers a
    row) before a join: broadcast them if they are few enough, else nothing."""
    return F.broadcast if table.count() <= BROADCAST_IDS else lambda frame: frame


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """``id, component`` (smallest id) of every id in the edges (a, b), by
    alternating large-star and small-star rounds until nothing changes."""
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    edges = tables.write(edges.distinct())
    state = None
    while True:
        now = edges.agg(F.count("u").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == state:
            break
        state, tasks = now, 1 + 2 * now["n"] // EDGES_A_TASK
        both = edges.union(edges.select("v", "u"))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = tables.write(large.where("u > v").coalesce(tasks).distinct().coalesce(tasks))
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        small = tables.write(small.where("u > v").coalesce(tasks).distinct().coalesce(tasks))
        tables.drop(edges, large)
        edges = small
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, cross: int = CROSS, large: int = LARGE
) -> DataFrame:
    """For every row: ``doc_id, n_shingles, component_id, kept``.  ``rounds``,
    ``cross`` and ``large`` (see above) change the way, not the links."""
    tables = Tables(docs.sparkSession)
    texts = id_text(docs, id_col, text_col)
    found = tables.write(sketched(texts))
    own = found.where("n_shingles > 0 and doc_id is not null")
    classes = tables.write(own.groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    named = found.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    named = tables.write(named.select("doc_id", "n_shingles", "rep"))
    first = classes.select("set_key", F.col("rep").alias("doc_id"))
    reps = own.dropDuplicates(["set_key", "doc_id"]).join(first, ["set_key", "doc_id"], "left_semi")
    reps = tables.write(reps.select(F.col("doc_id").alias("rep"), "n_shingles", "bands", "odd", "whole"))
    tables.drop(found, classes)
    odd = reps.select("rep", "n_shingles", "odd", "whole")
    buckets = reps.select("rep", F.explode("bands").alias("key"))
    leaders = buckets.groupBy("key").agg(F.min("rep").alias("leader"), F.max("rep").alias("last")).where("leader < last")
    leaders = tables.write(leaders.select("key", "leader"))
    # members of buckets with company, and the bucket's leader
    members = tables.write(buckets.join(leaders, "key"))
    tables.drop(leaders)

    links = None
    stars = members.where("rep > leader").groupBy("rep").agg(F.mode("leader", True).alias("leader"))
    for number in range(1, rounds + 2):
        stars = with_sketches(stars, odd, "rep", "leader")
        stars = stars.groupBy(F.col("rep").alias("a")).agg(F.min(F.struct("x", "leader"))["leader"].alias("b"))
        found_links = confirmed(stars, texts, tables)
        links = found_links if links is None else links.unionByName(found_links)
        label = components(links, tables)
        mixed = labelled(members, label, tables)
        outside = F.sum((F.col("mine") != F.col("theirs")).cast("long")).alias("s")
        sizes = mixed.groupBy("key").agg(F.count("rep").alias("n"), outside)
        size = sizes.agg(F.sum(F.col("n") * F.col("s")).alias("pairs"), F.sum("n").alias("n")).first()
        if number > rounds or (size["pairs"] or 0) <= cross * (size["n"] or 0):
            break
        stars = drawn_stars(mixed, number, tables)

    # all pairs across components that share a bucket
    pairs = with_sketches(cross_pairs(mixed, reps, large, tables), odd, "a", "b")
    more = confirmed(pairs, texts, tables)
    if not more.isEmpty():
        label = components(links.union(more), tables)

    named = named.join(label.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "rep"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return tables.last(named.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    ))


def keep_first(docs: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """One document of each class, with all its columns: the smallest id.  Rows
    that share that id all stay; rows with a null id all stay.  Up to ``limit``
    ids that go are broadcast; of more, only texts that may go are shuffled."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    gone = Tables(docs.sparkSession).write(gone)
    if gone.count() <= limit:
        return docs.join(F.broadcast(gone), docs["doc_id"] == gone["_gone"], "left_anti")
    id_ = F.col("doc_id").cast("long")
    here = among(docs, [id_], gone)
    return here.join(gone, id_ == gone["_gone"], "left_anti").unionByName(among(docs, [id_], gone, "left_anti"))


def with_sketches(pairs: DataFrame, odd: DataFrame, a: str, b: str) -> DataFrame:
    """The pairs whose sketches are near, with ``x``, the bits that differ."""
    pairs = pairs.join(odd.toDF(a, "_na", "_oa", "_wa"), a)
    pairs = pairs.join(odd.toDF(b, "_nb", "_ob", "_wb"), b)
    pairs = pairs.where(_may_link("_wa", "_wb", "_na", "_nb")).withColumn("x", _xor("_oa", "_ob"))
    return pairs.where(F.col("x") <= MAX_XOR).select(a, b, "x")


def drawn_stars(mixed: DataFrame, number: int, tables: Tables) -> DataFrame:
    """Pairs (rep, leader) of different components in buckets whose leader is
    drawn by a hash that differs by bucket and round."""
    drawn = F.struct(F.xxhash64(F.lit(number), "key", "rep").alias("h"), F.col("rep").alias("leader"), F.col("mine").alias("theirs"))
    leaders = tables.write(mixed.groupBy("key").agg(F.min(drawn).alias("drawn")).select("key", "drawn.leader", "drawn.theirs"))
    pairs = mixed.select("key", "rep", "mine").join(leaders, "key").where("mine <> theirs")
    return pairs.select("rep", "leader").distinct()


def labelled(members: DataFrame, label: DataFrame, tables: Tables) -> DataFrame:
    """Members (key, rep, leader) of buckets in several components, with the
    component of member (``mine``) and leader (``theirs``)."""
    near = _bounded(label)
    mine = label.select(F.col("id").alias("rep"), F.col("component").alias("mine"))
    theirs = label.select(F.col("id").alias("leader"), F.col("component").alias("theirs"))
    all_ = members.join(near(mine), "rep", "left").withColumn("mine", F.coalesce("mine", "rep"))
    all_ = all_.join(near(theirs), "leader", "left").withColumn("theirs", F.coalesce("theirs", "leader"))
    several = tables.write(all_.where("mine <> theirs").select("key").distinct())
    mixed = tables.write(all_.join(several, "key"))
    tables.drop(several)
    return mixed


def cross_pairs(mixed: DataFrame, reps: DataFrame, limit: int, tables: Tables) -> DataFrame:
    """Distinct pairs (a, b) of different components that share a bucket and
    whose sketches are near."""
    mixed = mixed.select("key", "rep", "mine", "theirs")
    large = tables.write(mixed.groupBy("key").agg(F.count("rep").alias("n")).where(F.col("n") > limit).select("key"))
    if large.isEmpty():
        return _pairs_in(mixed, reps).distinct()
    here = _pairs_in(mixed.join(large, "key", "left_anti"), reps)
    rest = mixed.join(large, "key").join(reps.select("rep", "bands"), "rep")
    again = rest.select("rep", "mine", "theirs", "key", F.explode("bands").alias("second")).where("key <> second")
    again = tables.write(again.withColumn("key", _both("key", "second")).drop("second"))
    sizes = again.groupBy("key").agg(F.min("mine").alias("lo"), F.max("mine").alias("hi")).where("lo <> hi")
    split = _pairs_in(again.join(sizes.select("key"), "key"), reps)
    return here.unionByName(split).distinct()


def _both(a, b):
    """One key for two bands, whichever comes first."""
    return F.xxhash64(F.least(a, b), F.greatest(a, b))


def _pairs_in(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Near pairs of different components in a bucket, once for every bucket
    that two members share."""
    known = members.join(reps.select("rep", "n_shingles", "odd", "whole"), "rep")
    outside = known.where("mine <> theirs")
    outside = outside.select(
        "key", F.col("rep").alias("a"), F.col("mine").alias("ca"), F.col("n_shingles").alias("na"),
        F.col("odd").alias("oa"), F.col("whole").alias("wa"),
    )
    also = (F.col("mine") != F.col("theirs")).alias("also")
    other = known.select(
        "key", F.col("rep").alias("b"), F.col("mine").alias("cb"), also, F.col("n_shingles").alias("nb"),
        F.col("odd").alias("ob"), F.col("whole").alias("wb"),
    )
    near = (F.col("ca") != F.col("cb")) & (~F.col("also") | (F.col("a") < F.col("b")))
    near = near & _may_link("wa", "wb", "na", "nb") & (_xor("oa", "ob") <= MAX_XOR)
    return outside.join(other, "key").where(near).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
