"""Quality rules by line labelling: a linear-chain conditional random field
marks each line of a document as content or boilerplate; the share of words in
content lines decides whether the document stays.

Training: a bounded sample of labelled documents (``sample`` per class, by a
hash of the id).  A line's label is its document's quality label; repeating an
earlier line is one of its properties.  The field has one weight per
(binned line property, state), start and transition weights, fitted by
gradient ascent on the regularised log-likelihood (forward-backward).

Scoring: Viterbi decoding per document over all its lines, on the executors;
only the weights (a few hundred numbers) are shared.

Base rules come first: a document with fewer than 20 words, or with more than
30 % of its words in repeated windows of 8 words, fails whatever its lines say.

Defined results: a null or empty text has no words and fails the base rule;
blank lines carry no label; a table without labelled rows of both classes gives
a field with neutral weights, which keeps what the base rules keep; repeated
rows are judged alike, row by row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import id_text, rows_of

SAMPLE = 1500  # documents per class that the field is fitted on
MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30
CONTENT_SHARE = 0.5
TRAIN_LINES = 64  # a training sequence; longer documents become several
MAX_TRAIN_LINES = 1024  # per document, of the bounded sample only

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = "#*$%&|<>"
_SYMBOL = re.compile(r"[#*$%&|<>]")
_STOPS = ".!?…:;\"')»”"


def words(text: str) -> list[bytes]:
    return text.encode().split()


def repeated_words(own: list[bytes], size: int = WINDOW) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    import numpy as np

    if len(own) <= size:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in own], np.int64)
    if len(number) == len(own):
        return 0
    width = 1
    while width < size:  # ids of runs of 2, 4, 8 words: equal ids, equal runs
        pairs = ids[:-width] * len(own) + ids[width:]
        ids = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    hit = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(own) + 1, np.int64)
    np.add.at(edge, np.flatnonzero(hit), 1)
    np.add.at(edge, np.flatnonzero(hit) + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    own = words(text)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line.strip(_SPACE):
            dup += line in seen
            seen.add(line)
    return (
        len(own),
        len(text) - sum(text.count(c) for c in _SPACE),
        sum(text.count(c) for c in _SYMBOLS),
        dup,
        repeated_words(own),
    )


def bins(value: float, edges: tuple) -> int:
    return sum(value >= e for e in edges)


# Property: its bin edges.  A line gets one bin of each.
PROPERTIES = (
    ("words", (2, 4, 8, 16, 40)),
    ("symbols per word", (0.05, 0.15, 0.3, 0.6)),
    ("upper-case share", (0.02, 0.1, 0.3, 0.6)),
    ("different words", (0.3, 0.5, 0.7, 0.9)),
    ("equal neighbours", (0.05, 0.2, 0.5)),
    ("letters share", (0.5, 0.7, 0.8, 0.9)),
    ("letters per word", (2.0, 3.0, 5.0, 8.0, 12.0)),
    ("ends like a sentence", (1,)),
    ("repeats a line", (1,)),
    ("commonest mark per word", (0.1, 0.3, 0.6)),
    ("digits share", (0.02, 0.1, 0.3)),
)
OFFSETS = []
N_FEATURES = 0
for _, _edges in PROPERTIES:
    OFFSETS.append(N_FEATURES)
    N_FEATURES += len(_edges) + 1


def line_features(line: str, seen: set[str]) -> list[int]:
    own = line.split()
    n = len(own)
    chars = sum(map(len, own))
    letters = sum(map(str.isalpha, line))
    upper = sum(map(str.isupper, line))
    digits = sum(map(str.isdigit, line))
    marks = Counter(w[-1] for w in own if not w[-1].isalnum())
    for mark in ".,":
        marks.pop(mark, None)
    values = (
        n,
        len(_SYMBOL.findall(line)) / n,
        upper / max(1, letters),
        len(set(own)) / n,
        sum(a == b for a, b in zip(own, own[1:])) / n,
        letters / max(1, chars),
        chars / n,
        own[-1][-1] in _STOPS,
        line in seen,
        max(marks.values(), default=0) / n,
        digits / max(1, chars),
    )
    seen.add(line)
    return [at + bins(v, edges) for at, v, (_, edges) in zip(OFFSETS, values, PROPERTIES, strict=True)]


def lines_of(text: str) -> list[tuple[int, list[int]]]:
    """For each line with a word: the number of its words and its features."""
    seen: set[str] = set()
    return [(len(line.split()), line_features(line, seen)) for line in text.split("\n") if line.split()]


class Field:
    """A fitted field: ``emit[feature][state]``, ``start``, ``move``; state 1
    is content."""

    def __init__(self, emit, start, move):
        self.emit, self.start, self.move = emit, start, move

    def viterbi(self, features: list[list[int]]) -> list[int]:
        """The likeliest states; ties go to content."""
        emit, move = self.emit, self.move
        back = []
        best = None
        for line in features:
            s0 = s1 = 0.0
            for f in line:
                e = emit[f]
                s0 += e[0]
                s1 += e[1]
            if best is None:
                best = (self.start[0] + s0, self.start[1] + s1)
            else:
                a, b = best[0] + move[0][0], best[1] + move[1][0]
                c, d = best[0] + move[0][1], best[1] + move[1][1]
                back.append((b >= a, d >= c))
                best = (max(a, b) + s0, max(c, d) + s1)
        if best is None:
            return []
        state = int(best[1] >= best[0])
        states = [state]
        for step in reversed(back):
            state = int(step[state])
            states.append(state)
        return states[::-1]

    def content_share(self, text: str) -> float:
        """Share of the words that lie in content lines; 0 without words."""
        lines = lines_of(text)
        states = self.viterbi([f for _, f in lines])
        total = sum(n for n, _ in lines)
        return sum(n for (n, _), s in zip(lines, states, strict=True) if s) / total if total else 0.0


def fit_field(sequences: list[tuple[list[list[int]], list[int]]], steps: int = 120, rate: float = 0.2, l2: float = 1e-3) -> Field:
    """Maximum likelihood by forward-backward and Adam, all sequences at once."""
    import numpy as np

    k = len(PROPERTIES)
    if not sequences or len({y for _, ys in sequences for y in ys}) < 2:
        return Field([[0.0, 0.0]] * N_FEATURES, [0.0, 0.0], [[0.0, 0.0], [0.0, 0.0]])
    n, longest = len(sequences), max(len(ys) for _, ys in sequences)
    x = np.full((n, longest, k), N_FEATURES, np.int64)
    y = np.zeros((n, longest), np.int64)
    on = np.zeros((n, longest))
    for i, (fs, ys) in enumerate(sequences):
        x[i, : len(ys)], y[i, : len(ys)], on[i, : len(ys)] = fs, ys, 1
    hot = np.eye(2)[y] * on[:, :, None]
    pair = np.einsum("nta,ntb->ab", hot[:, :-1], hot[:, 1:])
    first = hot[:, 0].sum(0)

    def spread(p):  # expected or observed counts of (feature, state)
        return np.stack([np.bincount(x.ravel(), np.repeat(p[:, :, s].ravel(), k), N_FEATURES + 1) for s in (0, 1)], 1)[:-1]

    seen = spread(hot)
    w = np.zeros(2 * N_FEATURES + 6)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        emit = np.vstack([w[: 2 * N_FEATURES].reshape(-1, 2), np.zeros((1, 2))])
        start, move = w[-6:-4], w[-4:].reshape(2, 2)
        score = emit[x].sum(2) * on[:, :, None]
        up = np.exp(score - score.max(2, keepdims=True))
        trans = np.exp(move - move.max())
        fwd, bwd = np.empty_like(up), np.ones_like(up)
        a = np.exp(start - start.max()) * up[:, 0]
        fwd[:, 0] = a / a.sum(1, keepdims=True)
        for t in range(1, longest):
            a = (fwd[:, t - 1] @ trans) * up[:, t]
            fwd[:, t] = np.where(on[:, t, None] > 0, a / a.sum(1, keepdims=True), fwd[:, t - 1])
        both = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            live = on[:, t + 1, None]
            right = up[:, t + 1] * bwd[:, t + 1]
            b = right @ trans.T
            bwd[:, t] = np.where(live > 0, b / b.sum(1, keepdims=True), 1.0)
            joint = fwd[:, t, :, None] * trans[None] * right[:, None, :]
            both += (joint / joint.sum((1, 2), keepdims=True) * live[:, :, None]).sum(0)
        post = fwd * bwd
        post = post / post.sum(2, keepdims=True) * on[:, :, None]
        grad = np.concatenate([(seen - spread(post)).ravel(), first - post[:, 0].sum(0), (pair - both).ravel()]) / n - l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(w[: 2 * N_FEATURES].reshape(-1, 2).tolist(), w[-6:-4].tolist(), w[-4:].reshape(2, 2).tolist())


def training_lines(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list:
    """Features and labels of the sampled documents' lines (no texts), at most
    ``sample`` documents a class and ``MAX_TRAIN_LINES`` lines a document."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    picked = known.where("quality = 0").orderBy(order, "doc_id").limit(sample)
    picked = picked.unionByName(known.where("quality = 1").orderBy(order, "doc_id").limit(sample))
    texts = id_text(docs).join(F.broadcast(picked), "doc_id")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                flat = []
                for _, features in lines_of(text)[:MAX_TRAIN_LINES]:
                    flat += [*features, label]
                out.append(flat)
            yield rows_of([batch.column(2), out], ["doc_id", "flat"], [pa.int64(), pa.list_(pa.int32())])

    rows = texts.select("text", "quality", "doc_id").mapInArrow(run, "doc_id long, flat array<int>").collect()
    width = len(PROPERTIES) + 1
    out = []
    for row in sorted(rows, key=lambda r: (r["doc_id"], r["flat"])):
        lines = [row["flat"][i : i + width] for i in range(0, len(row["flat"]), width)]
        for i in range(0, len(lines), TRAIN_LINES):
            part = lines[i : i + TRAIN_LINES]
            out.append(([x[:-1] for x in part], [x[-1] for x in part]))
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    return fit_field(training_lines(docs, labels, sample))


def judge(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", share: float = CONTENT_SHARE) -> DataFrame:
    """For every document the base counts, ``content_share``, ``base_failed``
    and ``kept``."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    shared = docs.sparkSession.sparkContext.broadcast((field.emit, field.start, field.move))

    def run(batches):
        import pyarrow as pa

        own = Field(*shared.value)
        for batch in batches:
            rows = [(*base_counts(t), own.content_share(t)) for t in batch.column(1).to_pylist()]
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[]] * 6
            yield rows_of([batch.column(0), *columns], ["doc_id", *counts, "content_share"], [pa.int64()] * 6 + [pa.float64()])

    found = id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", content_share double"
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= share))
