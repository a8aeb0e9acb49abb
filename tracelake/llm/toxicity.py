"""Toxicity: a sparse linear classifier with counterfactual regularisation.

Training: a bounded sample of labelled documents (``sample`` per class, by a
hash of the id).  Features are a document's distinct words and, for each, its
beginnings of 4, 5 and 6 letters, hashed.  For every identity term in a
labelled document, copies are made with the term swapped for each other term
of its group, and the loss adds ``swap_weight`` times the squared change of
the score, so that a neutral mention of one group weighs what a mention of
any other weighs.  An L1 term keeps the weights sparse, and no weight is below
zero: words are evidence of toxicity or none, so that a long text cannot talk
an insult down.

Both classes weigh the same in the loss, however many documents the sample has
of each: scores are probabilities at even odds.

Scoring: sum of the weights of the distinct words, on the executors; only the
non-zero weights (bounded by the sample) are shared.

Defined results: a null or empty text gets the score of the intercept; whole
texts are scored; labels other than 0 and 1 and null labels are ignored, as
are labels without a document; a document with several labels is toxic if any
says so; without labels of both classes every score is the share of toxic
labels; repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import forget, id_text, rows_of

SAMPLE = 2000  # documents per class that the classifier is fitted on
THRESHOLD = 0.7
SWAP_WEIGHT = 1.0
SPACE = 1 << 22
MIN_DOCUMENTS = 3  # documents of the sample that a feature must occur in
WORD = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 100_000  # of a task, about 30 MB
ROWS = 500  # documents whose texts are Python strings at a time

# Groups of identity terms that may stand for one another.
IDENTITY_GROUPS = (
    ("woman", "man", "girl", "boy", "female", "male", "transgender", "nonbinary"),
    ("women", "men", "girls", "boys", "females", "males"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "hispanic", "arab", "african", "european", "american"),
    ("immigrant", "refugee", "foreigner", "native", "citizen"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("young", "old", "elderly", "teenage"),
    ("disabled", "blind", "deaf", "autistic"),
    ("frau", "mann", "mädchen", "junge"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden", "hindus", "buddhisten"),
    ("schwul", "lesbisch", "hetero"),
    ("femme", "homme", "fille", "garçon"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes"),
    ("mujer", "hombre", "chica", "chico"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas"),
)


def features_of(word: str) -> list[int]:
    """Hashed features of one lower-case word."""
    parts = [f"{n}:{word[:n]}" for n in (4, 5, 6) if len(word) >= n]
    return [crc32(p.encode()) % SPACE for p in (f"w:{word}", *parts)]


def distinct_words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def document_features(own: set[str]) -> dict[int, int]:
    """Feature: in how many distinct words it occurs."""
    counts: dict[int, int] = {}
    for word in own:
        for f in features_of(word):
            counts[f] = counts.get(f, 0) + 1
    return counts


def swaps(own: set[str]) -> list[tuple[str, str]]:
    """Identity terms of the document with each term they may be swapped for."""
    return [(a, b) for group in IDENTITY_GROUPS for a in group if a in own for b in group if b != a]


class Model:
    """Non-zero weights by feature, and the intercept."""

    def __init__(self, weights: dict[int, float], intercept: float):
        self.weights, self.intercept = weights, intercept
        self._words: dict[str, float] = {}

    def word(self, word: str) -> float:
        got = self.weights.get
        return sum(got(f, 0.0) for f in features_of(word))

    def score(self, text: str) -> float:
        known = self._words
        if len(known) > CACHE_WORDS:
            known.clear()
        total = self.intercept
        for w in distinct_words(text):
            s = known.get(w)
            if s is None:
                s = known[w] = self.word(w)
            if s:
                total += s
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, total))))


def fit_rows(rows: list[tuple[list[int], list[int], int]], pairs: list[tuple[int, str, str]], toxic_share: float,
             swap_weight: float = SWAP_WEIGHT, l1: float = 5e-5, steps: int = 150, rate: float = 0.3) -> Model:
    """``rows``: (features, counts, label); ``pairs``: (row, term, other term).
    Proximal adaptive gradient steps over the whole sample."""
    import numpy as np

    labels = np.array([r[2] for r in rows], float)
    if len(set(labels.tolist())) < 2:
        share = min(1 - 1e-6, max(1e-6, toxic_share))
        return Model({}, math.log(share / (1 - share)))
    sizes = [len(r[0]) for r in rows]
    cols = np.concatenate([np.asarray(r[0], np.int64) for r in rows])
    vals = np.concatenate([np.asarray(r[1], float) for r in rows])
    at = np.repeat(np.arange(len(rows)), sizes)
    names, inverse, often = np.unique(cols, return_inverse=True, return_counts=True)
    term_features = {f for a, b in {(a, b) for _, a, b in pairs} for t in (a, b) for f in features_of(t)}
    keep = (often >= MIN_DOCUMENTS) | np.isin(names, np.fromiter(term_features, np.int64, len(term_features)))
    extra = np.setdiff1d(np.fromiter(term_features, np.int64, len(term_features)), names)
    number = np.cumsum(keep) - 1
    on = keep[inverse]
    cols, vals, at = number[inverse[on]], vals[on], at[on]
    names = np.concatenate([names[keep], extra])
    index = {int(f): i for i, f in enumerate(names)} if pairs else {}
    # each swap as (feature, change) of the score
    swap_at, swap_cols, swap_vals = [], [], []
    for i, (_, a, b) in enumerate(pairs):
        for term, sign in ((a, -1.0), (b, 1.0)):
            for f in features_of(term):
                swap_at.append(i)
                swap_cols.append(index[f])
                swap_vals.append(sign)
    swap_at, swap_cols, swap_vals = np.array(swap_at, int), np.array(swap_cols, int), np.array(swap_vals)
    n, d = len(rows), len(names)
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (n - labels.sum()))
    w, bias = np.zeros(d), 0.0
    power, bias_power = np.full(d, 1e-12), 1e-12
    for _ in range(steps):
        z = np.bincount(at, vals * w[cols], n) + bias
        miss = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * weight
        grad = np.bincount(cols, vals * miss[at], d)
        if len(pairs):
            change = np.bincount(swap_at, swap_vals * w[swap_cols], len(pairs))
            grad += 2 * swap_weight / len(pairs) * np.bincount(swap_cols, swap_vals * change[swap_at], d)
        power += grad**2
        step = rate / np.sqrt(power)
        w = w - step * grad
        w = np.maximum(0, w - step * l1)
        bias_power += miss.sum() ** 2
        bias -= rate * miss.sum() / math.sqrt(bias_power)
    used = np.flatnonzero(w)
    return Model(dict(zip(names[used].tolist(), w[used].tolist(), strict=True)), float(bias))


def fit(docs: DataFrame, labels: DataFrame, use: Callable[[Column], Column] | None = None, sample: int = SAMPLE,
        swap_weight: float = SWAP_WEIGHT) -> Model:
    """Fit on at most ``sample`` labelled documents of each class.  ``use``:
    which document ids labels may be learned from.  Hashed features reach the
    driver, as bytes; no texts do."""
    import numpy as np

    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id is not null and toxic in (0, 1)")
    if use is not None:
        known = known.where(use(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg("toxic").alias("s")).first()["s"]
    order = F.xxhash64("doc_id")
    picked = known.where("toxic = 1").orderBy(order, "doc_id").limit(sample)
    picked = picked.unionByName(known.where("toxic = 0").orderBy(order, "doc_id").limit(sample))

    def run(batches):
        from array import array

        import pyarrow as pa

        forget()
        ints = pa.binary()
        for batch in parts(batches):
            fs, ns, ps = [], [], []
            for text in batch.column(2).to_pylist():
                own = distinct_words(text)
                counts = document_features(own)
                fs.append(array("i", counts).tobytes())
                ns.append(array("i", counts.values()).tobytes())
                ps.append([f"{a} {b}" for a, b in swaps(own)])
            yield rows_of([batch.column(0), batch.column(1), fs, ns, ps], ["doc_id", "toxic", "f", "n", "p"],
                          [pa.int64(), pa.int32(), ints, ints, pa.list_(pa.string())])

    texts = id_text(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text")
    found = texts.mapInArrow(run, "doc_id long, toxic int, f binary, n binary, p array<string>").collect()
    found.sort(key=lambda r: (r["doc_id"], r["f"]))
    rows = [(np.frombuffer(r["f"], np.int32), np.frombuffer(r["n"], np.int32), r["toxic"]) for r in found]
    pairs = [(i, *p.split(" ")) for i, r in enumerate(found) for p in r["p"]]
    return fit_rows(rows, pairs, share if share is not None else 0.5, swap_weight)


def parts(batches: Iterator) -> Iterator:
    """Batches of at most ``ROWS`` rows."""
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            yield batch.slice(first, ROWS)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row, over whole texts."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    def run(batches):
        import pyarrow as pa

        forget()
        own = Model(*shared.value)
        for batch in parts(batches):
            scores = [own.score(t) for t in batch.column(1).to_pylist()]
            yield rows_of([batch.column(0), scores], ["doc_id", "score"], [pa.int64(), pa.float64()])

    found = id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with all their columns, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    number = docs.columns.index("text")

    def run(batches):
        forget()
        own = Model(*shared.value)
        for batch in parts(batches):
            yield batch.filter(_mask([own.score(t or "") < threshold for t in batch.column(number).to_pylist()]))

    return docs.mapInArrow(run, docs.schema)


def _mask(values: list[bool]):
    import pyarrow as pa

    return pa.array(values, pa.bool_())


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept for measuring only."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1
