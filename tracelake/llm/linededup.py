"""Line deduplication by a deletion-neighbourhood join.

A line is its words: lower case, split at white space.  Two lines are alike if
they are equal, or if both have at least ``MIN_WORDS`` words and one word
inserted, deleted or replaced makes them equal (edit distance in words).  A
line is dropped if a line alike it comes earlier, by (doc_id, row, line number).

1. Equal lines are one by two 64-bit hashes, with their first position.
2. One edit leaves the first or the last half of the shorter line's words as
   they are.  Only lines that share such a half with another line of a fitting
   length can have a partner: counted on hashes, no text moves.
3. Of those lines, every deletion variant is emitted as a hashed key (words
   before, words after, position), and the line itself as the variant of each
   place where a word may be missing.  All lines with a key in common are
   alike, so the earliest of a key stands for all of them: no pairs within.
4. Each pair (line, earliest) is verified on the words.
5. Positions of dropped lines go back to their documents.

Everything is DataFrame expressions.  Hot lines are combined map-side; the last
join is between two written or scanned tables, which Spark splits when skewed.
Texts, lines and keys go to a join only if they may have a partner there, which
a broadcast bit a key tells (``common.among``); the join itself is exact.
Tables between the steps are Parquet files in the shared folder, removed once
what follows from them is written.

Defined results: blank lines are no lines (they stay); a null or empty text has
none; ties (equal lines) go to the smaller position; rows that share a doc_id
are documents of their own, in the order of their texts' hashes, and of rows
with the same text all but one lose their lines; a null doc_id comes before all
others; an empty table gives an empty result; other columns are ignored by
``dropped_lines`` and kept by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import BROADCAST_IDS, Tables, among, cut, id_text

MIN_WORDS = 8  # of both lines, for an edit to count
BLOCK = 256  # words whose running hashes are built together
_FIRST = -(1 << 63)
_ROW = 31  # bits of a line number, and of a row number


def row_numbers(texts: DataFrame, tables: Tables) -> DataFrame | None:
    """``_id, _h1, _h2, _n``: a number for each distinct text of the ids that
    several rows share; None if there is no such id."""
    shared = tables.write(texts.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    n = shared.count()
    if not n:
        tables.drop(shared)
        return None
    ids = F.broadcast(shared) if n <= BROADCAST_IDS else shared
    own = texts.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("_id"), *_text_hashes("text"))
    own = cut(own.distinct().orderBy("_id", "_h1", "_h2"))
    tables.drop(shared)
    # the checkpoint's partitions are fixed, and so are the numbers within them
    own = own.select("*", F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_n"))
    counts = sorted(own.groupBy("_p").count().collect())
    before, starts = 0, [0] * (counts[-1]["_p"] + 1)
    for r in counts:
        starts[r["_p"]] = before
        before += r["count"]
    return cut(own.withColumn("_n", F.col("_n") + F.element_at(F.lit(starts).cast("array<long>"), F.col("_p") + 1)).drop("_p"))


def _text_hashes(text: str | Column) -> list[Column]:
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def numbered(docs: DataFrame, numbers: DataFrame | None, id_col: Column, text: Column) -> DataFrame:
    """Adds ``_row``, the number of a row among those that share its id, or 0."""
    if numbers is None:
        return docs.withColumn("_row", F.lit(0).cast("long"))
    numbers = F.broadcast(numbers) if numbers.count() <= BROADCAST_IDS else numbers
    h1, h2 = _text_hashes(text)
    at = (F.coalesce(id_col.cast("long"), F.lit(_FIRST)) == numbers["_id"]) & (h1 == numbers["_h1"]) & (h2 == numbers["_h2"])
    return docs.join(numbers, at, "left").select(*[docs[c] for c in docs.columns], F.coalesce("_n", F.lit(0).cast("long")).alias("_row"))


def lines(docs: DataFrame, least: int) -> DataFrame:
    """``doc_id, _row, line`` (number), ``m`` (words), hashes and halves of
    every line with a word, from ``doc_id, _row, text``; no text."""
    own = docs.select("doc_id", "_row", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    own = own.where(F.col("t").rlike(r"[^ \t\x0b\f\r]")).select("doc_id", "_row", "line", _words("t").alias("words"))
    size = F.size("words")
    return own.select("doc_id", "_row", "line", size.alias("m"), *_hashes(), *halves(size, F.col("words"), least))


def _words(line: str) -> Column:
    return F.array_remove(F.split(F.lower(line), r"[ \t\x0b\f\r]+"), "")


def _pos() -> Column:
    """Position of a line as one ordered number."""
    rest = F.shiftleft("_row", _ROW) + F.col("line")
    return (F.col("doc_id").cast("decimal(19,0)") * F.lit(1 << 2 * _ROW).cast("decimal(19,0)") + rest.cast("decimal(19,0)")).alias("pos")


def _hashes() -> list[Column]:
    return [F.xxhash64("words").alias("k1"), F.xxhash64(F.lit(1), "words").alias("k2")]


def _half(short: Column) -> Column:
    """Words that count as the half of a line of ``short`` words: at most half
    of them, and the same for most neighbouring lengths."""
    return (F.floor(short / 4) * 2).cast("int")


def halves(size: Column, words: Column, least: int) -> list[Column]:
    """Hashes of the halves that an edit may leave: of the line as the shorter
    (or equal) one of a pair (``p``, ``s``), and as the longer one (``long_p``,
    ``long_s``, null where they are the same words)."""
    out = []
    for side in ("p", "s"):

        def part(h, side=side):
            return F.xxhash64(F.slice(words, 1, h) if side == "p" else F.slice(words, size - h + 1, h))

        out.append(F.when(size >= least, part(_half(size))).alias(side))
        out.append(F.when((size % 4 == 0) & (size - 1 >= least), part(_half(size - 1))).alias(f"long_{side}"))
    return out


def distinct_lines(own: DataFrame) -> DataFrame:
    """One row per distinct line: hashes, first position, count, words, halves."""
    parts = ["m", "p", "s", "long_p", "long_s"]
    own = own.select(_pos(), "k1", "k2", *parts)
    return own.groupBy("k1", "k2").agg(F.min("pos").alias("pos"), F.count("pos").alias("n"), *[F.min(c).alias(c) for c in parts])


def with_company(distinct: DataFrame, least: int, tables: Tables) -> DataFrame:
    """``pos`` of the lines that share a half with another, and whether it is a
    first (``p``) or a last one (``s``)."""
    size = F.col("m")
    parts = []
    for side in ("p", "s"):
        own = F.when(size >= least, F.xxhash64(F.lit(side), size, F.col(side)))
        long = F.when(size - 1 >= least, F.xxhash64(F.lit(side), size - 1, F.coalesce(f"long_{side}", side)))
        parts += [F.struct(half.alias("half"), F.lit(half is own).alias("own"), F.lit(side == "p").alias("p")) for half in (own, long)]
    each = distinct.where(size >= least).select("pos", F.explode(F.array(*parts)).alias("h")).select("pos", "h.*").where("half is not null")
    shared = each.groupBy("half").agg(F.count("pos").alias("n"), F.max("own").alias("any_own")).where("n > 1 and any_own")
    shared = tables.write(shared.select("half"))
    found = among(each, ["half"], shared).join(shared, "half")
    return found.groupBy("pos").agg(F.max("p").alias("p"), F.max(~F.col("p")).alias("s"))


def _scan(xs: str | Column) -> Column:
    """XORs of the elements before each place, and of all at the end."""
    zero = F.array(F.lit(0).cast("long"))
    return F.aggregate(xs, zero, lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1).bitwiseXOR(x))))


def _with_running(own: DataFrame, name: str) -> DataFrame:
    """Replaces an array of longs by its running XORs, in blocks so that the
    copying stays in proportion to the length."""
    count = F.floor((F.size(name) - 1) / BLOCK)
    blocks = F.transform(F.sequence(F.lit(0), count.cast("int")), lambda b: _scan(F.slice(name, b * BLOCK + 1, BLOCK)))
    own = own.withColumn(name, blocks)
    own = own.withColumn("_starts", _scan(F.transform(name, lambda b: F.element_at(b, -1))))
    whole = F.zip_with(
        name, F.slice("_starts", 1, F.size(name)), lambda b, at: F.transform(F.slice(b, 1, F.size(b) - 1), lambda x: x.bitwiseXOR(at))
    )
    return own.withColumn(name, F.concat(F.flatten(whole), F.array(F.element_at("_starts", -1)))).drop("_starts")


def variants(own: DataFrame) -> DataFrame:
    """``pos, key`` of the deletion variants in the half that may differ, from
    ``pos, p, s, words``."""
    m = F.size("words")
    own = own.select(
        "pos", "p", "s", m.alias("m"),
        F.transform("words", lambda w, i: F.xxhash64(w, i)).alias("head"),
        F.transform("words", lambda w, i: F.xxhash64(F.lit("e"), w, F.size("words") - i)).alias("tail"),
    )
    own = _with_running(_with_running(own, "head"), "tail")
    h = _half(F.col("m") - 1)
    places = F.sequence(F.when(F.col("s"), 0).otherwise(h), F.when(F.col("p"), F.col("m")).otherwise(F.col("m") - h))
    own = own.withColumn("places", places).withColumn("all", F.element_at("tail", -1))

    def after(i):  # hash of what stands from place i on
        return F.col("all").bitwiseXOR(F.element_at("tail", i + 1))

    missing = F.transform("places", lambda i: F.xxhash64(F.element_at("head", i + 1), after(i), i, "m"))
    words = F.filter("places", lambda i: i < F.col("m"))
    deleted = F.transform(words, lambda i: F.xxhash64(F.element_at("head", i + 1), after(i + 1), i, F.col("m") - 1))
    return own.select("pos", F.explode(F.concat(missing, deleted)).alias("key"))


def within_one_edit(a: str, b: str) -> Column:
    """Whether word lists differ by at most one insertion, deletion or replacement."""

    def agree(x: Column, y: Column) -> Column:
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        at = F.array_position(same, False)
        return F.when(at == 0, F.size(same)).otherwise(at - 1)

    x, y = F.col(a), F.col(b)
    longest = F.greatest(F.size(x), F.size(y))
    kept = agree(x, y) + agree(F.reverse(x), F.reverse(y))
    return (F.abs(F.size(x) - F.size(y)) <= 1) & (kept >= longest - 1)


def alike_lines(distinct: DataFrame, docs: DataFrame, copies: bool, least: int, tables: Tables) -> DataFrame:
    """``k1, k2, pos`` of the distinct lines that have an earlier one within one
    edit; ``copies``: whether rows may be equal."""
    ids = F.lit(1 << 2 * _ROW).cast("decimal(19,0)")
    company = with_company(distinct, least, tables).withColumn("doc_id", F.floor(F.col("pos") / ids).cast("long"))
    rest = (F.col("pos") - F.col("doc_id").cast("decimal(19,0)") * ids).cast("long")
    line = rest.bitwiseAND((1 << _ROW) - 1).cast("int")
    at = ["doc_id", "_row", "line"]
    company = tables.write(company.select("doc_id", F.shiftright(rest, _ROW).alias("_row"), line.alias("line"), "p", "s"))
    each = docs.select("doc_id", "_row", F.posexplode(F.split("text", "\n")).alias("line", "t"))
    own = among(each, at, company.select(*at)).join(company, at).select(_pos(), "p", "s", "t")
    own = tables.write(own.dropDuplicates(["pos"]) if copies else own)  # equal rows share positions
    tables.drop(company)
    keys = tables.write(variants(own.select("pos", "p", "s", _words("t").alias("words"))))
    first = keys.groupBy("key").agg(F.min("pos").alias("first"), F.max("pos").alias("last")).where("first < last")
    first = tables.write(first.select("key", "first"))
    pairs = among(keys, ["key"], first.select("key")).join(first, "key").where("pos > first")
    pairs = tables.write(pairs.select("pos", "first").distinct())
    tables.drop(keys, first)
    one = among(own, ["pos"], pairs.select("pos")).select("pos", _words("t").alias("words"))
    two = among(own, ["pos"], pairs.select("first")).select(F.col("pos").alias("first"), _words("t").alias("w2"))
    alike = pairs.join(one, "pos").join(two, "first").where(within_one_edit("words", "w2"))
    alike = tables.write(alike.select(*_hashes(), "pos").distinct())
    tables.drop(own, pairs)
    return alike


def _found(texts: DataFrame, numbers: DataFrame | None, least: int, tables: Tables) -> DataFrame:
    """``doc_id, _row, copies`` (equal rows), ``all`` lines with a word and
    ``dropped`` ones of the first copy (numbers from 0, ascending)."""
    texts = numbered(texts, numbers, texts["doc_id"], texts["text"])
    own = tables.write(lines(texts, least))
    distinct = tables.write(distinct_lines(own))
    alike = alike_lines(distinct, texts, numbers is not None, least, tables)
    known = distinct.where("n > 1").select("k1", "k2", "pos", F.lit(False).alias("alike"))
    known = known.unionByName(alike.withColumn("alike", F.lit(True)))
    known = tables.write(known.groupBy("k1", "k2").agg(F.min("pos").alias("first"), F.max("alike").alias("alike")))
    tables.drop(distinct, alike)
    each = own.select("doc_id", "_row", "line", "k1", "k2")
    here = among(each, ["k1", "k2"], known.select("k1", "k2")).join(known, ["k1", "k2"], "left")
    gone = F.col("first").isNotNull() & ((_pos() > F.col("first")) | F.col("alike"))
    here = here.select("doc_id", "_row", "line", F.when(gone, F.col("line")).alias("gone"))
    rest = among(each, ["k1", "k2"], known.select("k1", "k2"), "left_anti")
    each = here.unionByName(rest.select("doc_id", "_row", "line", F.lit(None).cast("int").alias("gone")))
    found = each.groupBy("doc_id", "_row").agg(
        F.count("line").alias("n"), F.array_sort(F.collect_set("line")).alias("all"), F.array_sort(F.collect_set("gone")).alias("dropped")
    )
    return found.withColumn("copies", F.expr("n div size(all)"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(_FIRST)).alias("doc_id"), "text")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """Per row with a line: ``doc_id, n_lines, n_dropped, dropped`` (line
    numbers from 0, ascending)."""
    tables = Tables(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    found = _found(texts, row_numbers(texts, tables), least, tables)
    found = found.select("doc_id", "all", "dropped", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    found = found.withColumn("dropped", F.when(F.col("copy") == 1, F.col("dropped")).otherwise(F.col("all")))
    return tables.last(found.select(
        F.nullif("doc_id", F.lit(_FIRST)).alias("doc_id"), F.size("all").cast("long").alias("n_lines"),
        F.size("dropped").cast("long").alias("n_dropped"), "dropped",
    ))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """The documents with all their columns, without the dropped lines;
    documents that had words and have none left go."""
    tables = Tables(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    numbers = row_numbers(texts, tables)
    found = _found(texts, numbers, least, tables).where(F.size("dropped") > 0)
    found = tables.last(found.select(
        F.col("doc_id").alias("_of"), F.col("_row").alias("_of_row"),
        (F.size("all") == F.size("dropped")).alias("_all"), F.col("dropped").alias("_dropped"),
    ))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    own = numbered(docs, numbers, docs[id_col], text)
    if numbers is not None:
        own = _one_of_copies(own, id_col, text_col)
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST))
    places = found.select("_of", "_of_row")
    here = among(own, [id_, "_row"], places)
    here = here.join(found, (id_ == found["_of"]) & (F.col("_row") == found["_of_row"]), "left").where("not coalesce(_all, false)")
    kept = F.filter(F.split(F.col(text_col), "\n"), lambda t, i: ~F.array_contains("_dropped", i))
    text = F.when(F.col("_dropped").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    here = here.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
    return here.unionByName(among(own, [id_, "_row"], places, "left_anti").select(*docs.columns))


def _one_of_copies(own: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``own`` with one of the rows that share an id and a text with a word: the
    others' lines all repeat its lines.  Combined before the shuffle."""
    key = [F.col(id_col).alias("_k"), F.col("_row").alias("_r"), *_text_hashes(text_col)]
    wordless = ~F.coalesce(F.col(text_col).cast("string"), F.lit("")).rlike(r"[^ \t\x0b\f\r\n]")
    copies = own.where(~wordless).groupBy(*key).count().where("count > 1")
    copies = cut(copies.drop("count"))
    if copies.isEmpty():
        return own
    same = F.col(id_col).eqNullSafe(F.col("_k")) & (F.col("_row") == F.col("_r"))
    same = same & (F.xxhash64(text_col) == F.col("_h1")) & (F.xxhash64(F.lit(1), text_col) == F.col("_h2"))
    row = F.struct(*own.columns)
    kept = own.join(copies, same, "left_semi").groupBy(*key).agg(F.min_by(row, F.to_json(row)).alias("x")).select("x.*")
    return own.join(copies, same, "left_anti").unionByName(kept)
