"""Exact order statistics of many columns without a sort.

A quantile sketch of each column brackets the wanted positions from both sides; one
more pass counts what lies below and inside each bracket.  A bracket that still
holds more than ``LIMIT`` rows is sketched again, inside itself, and so shrinks by
three orders of magnitude; the rows of a small one are grouped by value and ranked.
All columns and quantiles share every pass.

Nothing but partial aggregates and the rows of the last brackets is ever shuffled,
whatever the number of columns; a value that a third of all rows share is one row of
its bracket.  Three scans up to some 10^8 rows, two more for every further factor
of a thousand.  The bracket bounds are counted, not trusted: where a sketch was
wrong, its bracket is widened and counted again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import inf, nextafter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT = 100_000  # rows of a bracket that are ranked
ACCURACY = 10_000  # of the sketches: rank error at most 1 / ACCURACY
EXACT_DOUBLE = 2**53  # whole numbers below this are doubles
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Bracket:
    """Where the value at one position lies: ``low <= value <= high``."""

    name: str
    position: int  # from 1
    low: float  # as doubles
    high: float
    wide: int = 2  # sketch errors of margin on either side
    below: int = -1  # rows under the bracket, once counted
    inside: int = -1

    @property
    def holds(self) -> bool:
        return self.below < self.position <= self.below + self.inside

    def counted(self, below: int, inside: int, at_low: int, at_high: int) -> None:
        """Takes the counts over; ends that are not the wanted value are left out,
        one that is becomes the whole bracket.  So values that many rows share never
        keep a bracket from shrinking."""
        self.below, self.inside = below, inside
        if not self.holds or self.low == self.high:
            return
        if self.position <= below + at_low:
            self.high, self.inside = self.low, at_low
        elif self.position > below + inside - at_high:
            self.low, self.below, self.inside = self.high, below + inside - at_high, at_high
        else:
            self.below, self.inside = below + at_low, inside - at_low - at_high
            self.low, self.high = nextafter(self.low, inf), nextafter(self.high, -inf)


def quartile_positions(n: int, q: float) -> tuple[int, int, float]:
    """The positions on both sides of quantile ``q`` of ``n`` values, from 1,
    and how far between them it lies (linear interpolation)."""
    at = (n - 1) * q
    first = int(at // 1)
    between = at - first
    return first + 1, first + 1 + (between > 0), between


def order_statistics(
    df: DataFrame,
    values: dict[str, Column],
    fractions: Sequence[float],
    limit: int = LIMIT,
    accuracy: int = ACCURACY,
    also: Sequence[Column] = (),
) -> tuple[dict[str, int], dict[tuple[str, float], tuple], tuple]:
    """``(counts, found, extra)``: the number of values of each column that are not
    NULL; for each column and fraction the two values that linear interpolation
    takes and the place between them (nothing for a column without values); and the
    values of the aggregates ``also``, computed in the first pass."""
    names = list(values)
    if not names:
        return {}, {}, tuple(df.agg(*also).first()) if also else ()
    kinds = {f.name: f.dataType for f in df.select(*[values[c].alias(f"v{i}") for i, c in enumerate(names)]).schema.fields}
    kind = {c: kinds[f"v{i}"] for i, c in enumerate(names)}
    v = {c: values[c].cast("double") for c in names}

    grid = sorted({p for q in fractions for p in (q - 2 / accuracy, q + 2 / accuracy) if 0 < p < 1})
    first = df.agg(
        *[F.count(v[c]).alias(f"n{i}") for i, c in enumerate(names)],
        *[F.percentile_approx(v[c], grid or [0.5], accuracy).alias(f"q{i}") for i, c in enumerate(names)],
        *also,
    ).first()
    counts = {c: first[i] for i, c in enumerate(names)}
    wanted = {(c, q): quartile_positions(counts[c], q) for c in names for q in fractions if counts[c]}
    brackets: dict[tuple[str, int], Bracket] = {}
    for (c, q), (a, b, _) in wanted.items():
        sketch = dict(zip(grid or [0.5], first[len(names) + names.index(c)], strict=True))
        low, high = q - 2 / accuracy, q + 2 / accuracy
        for p in {a, b}:
            brackets[c, p] = Bracket(c, p, sketch[low] if low > 0 else -inf, sketch[high] if high < 1 else inf)

    open_ = list(brackets.values())
    while open_:
        _count(df, v, open_)
        open_ = [b for b in open_ if not b.holds or b.inside > limit and b.low < b.high]
        if open_:
            _sketch_again(df, v, open_, counts, accuracy)

    found, several = {}, {}
    for key, b in brackets.items():
        whole = isinstance(kind[b.name], _INTEGRAL)
        if b.low == b.high and (isinstance(kind[b.name], (T.DoubleType, T.FloatType)) or whole and abs(b.low) < EXACT_DOUBLE):
            found[key] = int(b.low) if whole else b.low
        else:
            several[key] = b
    found |= _ranked(df, values, v, kind, several)
    out = {(c, q): (found[c, a], found[c, b], between) for (c, q), (a, b, between) in wanted.items()}
    return counts, out, tuple(first[2 * len(names) :])


def _within(d: Column, b: Bracket) -> Column:
    return (d >= F.lit(b.low)) & (d <= F.lit(b.high))


def _count(df: DataFrame, v: dict[str, Column], held: list[Bracket]) -> None:
    tests = [
        t for b in held for d in (v[b.name],)
        for t in (d < F.lit(b.low), _within(d, b), d == F.lit(b.low), d == F.lit(b.high))
    ]
    row = df.agg(*[F.count_if(t).alias(f"t{i}") for i, t in enumerate(tests)]).first()
    for i, b in enumerate(held):
        b.counted(*row[4 * i : 4 * i + 4])


def _sketch_again(df: DataFrame, v: dict[str, Column], held: list[Bracket], counts: dict[str, int], accuracy: int) -> None:
    """New bounds: for a bracket that missed its position, with a wider margin
    over all values; for a large one, inside itself."""
    aggs, ends = [], []
    for b in held:
        if b.holds:
            d, n, below, widest = F.when(_within(v[b.name], b), v[b.name]), b.inside, b.below, (b.low, b.high)
            b.wide = 2
        else:
            d, n, below, widest = v[b.name], counts[b.name], 0, (-inf, inf)
            b.wide *= 8
        low = (b.position - 1 - below) / n - b.wide / accuracy
        high = (b.position - below) / n + b.wide / accuracy
        ends.append((low > 0, high < 1, widest))
        aggs += [F.percentile_approx(d, min(1.0, max(0.0, p)), accuracy) for p in (low, high)]
    row = df.agg(*[a.alias(f"e{i}") for i, a in enumerate(aggs)]).first()
    for i, (b, (low, high, widest)) in enumerate(zip(held, ends, strict=True)):
        b.low = row[2 * i] if low else widest[0]
        b.high = row[2 * i + 1] if high else widest[1]


def _ranked(df: DataFrame, values: dict[str, Column], v: dict[str, Column], kind: dict[str, T.DataType], brackets: dict) -> dict:
    """The wanted values of brackets, from their rows grouped by value: one job
    for each type of column."""
    found = {}
    for t in {kind[b.name].simpleString() for b in brackets.values()}:
        held = [(key, b) for key, b in brackets.items() if kind[b.name].simpleString() == t]
        rows = [F.when(_within(v[b.name], b), F.struct(F.lit(i).alias("b"), values[b.name].alias("v"))) for i, (_, b) in enumerate(held)]
        each = df.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.b", "r.v")
        groups = each.groupBy("b", "v").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(Window.partitionBy("b").orderBy("v"))
        place = F.element_at(F.array(*[F.lit(b.position - b.below) for _, b in held]), F.col("b") + 1)
        hit = (F.col("upto") - F.col("n") < place) & (F.col("upto") >= place)
        for r in groups.withColumn("upto", upto).where(hit).collect():  # one per bracket
            found[held[r["b"]][0]] = r["v"]
    return found


def interpolated(first, last, between: float) -> float:
    """The value between two order statistics, as a double."""
    if first == last:
        return float(first)
    return float(first) + float(last - first) * between
