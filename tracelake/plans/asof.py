"""As-of join: each event with the state that holds at its time.

Both sides are put in one order, by key and time, states before events of the same
time, and range partitioned on it, so a key that holds a third of all events is
split.  Inside a bucket the state is the last one seen for the key; a key that
reaches over the edge of a bucket takes what the bucket before hands over: at most
two rows per bucket, which are broadcast.  Equal events are one weighted row on
the way.  One range shuffle and one checkpoint, no join of events with states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.plans.ordering import _BUCKET, _UID, _W, COPY, _groupable, each_copy, row_hash
from tracelake.session import shared_dir, shuffle_partitions

_BY, _AT, _KIND, _ROW, _STATE = "_tl_by", "_tl_at", "_tl_kind", "_tl_row", "_tl_state"


def as_of_join(
    events: DataFrame,
    states: DataFrame,
    event_key: str | Column,
    event_time: str | Column,
    state_key: str | Column,
    state_time: str | Column,
    columns: Sequence[str],
    buckets: int | None = None,
) -> DataFrame:
    """Every row of ``events``, with ``columns`` of the newest row of ``states``
    that has the same key and is not later; NULL where there is none, and for
    events without a key or time.  Of states equal in key and time the one with
    the greatest ``columns`` holds.  Names of ``columns`` that ``events`` has too are
    not allowed.  Runs one job eagerly."""
    both = [c for c in columns if c in events.columns]
    if both:
        raise ValueError(f"columns of both sides: {both}")
    n = buckets or shuffle_partitions(events.sparkSession)
    shared_dir(events.sparkSession)
    ekey, etime, skey, stime = (F.col(c) if isinstance(c, str) else c for c in (event_key, event_time, state_key, state_time))
    names = events.columns
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    state = F.struct(*[F.col(f"`{c}`").alias(f"s{i}") for i, c in enumerate(columns)])

    known = states.select(skey.alias(_BY), stime.alias(_AT), state.alias(_STATE))
    known = known.where(F.col(_BY).isNotNull() & F.col(_AT).isNotNull())
    known = known.groupBy(_BY, _AT).agg(F.max(_STATE).alias(_STATE))
    tagged = events.select(ekey.alias(_BY), etime.alias(_AT), row.alias(_ROW), row_hash(events).alias(_UID))
    placed = F.col(_BY).isNotNull() & F.col(_AT).isNotNull()
    keyed = tagged.where(placed)
    if _groupable(keyed.schema[_ROW].dataType):
        keyed = keyed.groupBy(_BY, _AT, _ROW, _UID).agg(F.count(F.lit(1)).alias(_W))
    else:  # maps and variants cannot be compared: such rows stay single
        keyed = keyed.withColumn(_W, F.lit(1).cast("bigint"))
    kind = known.schema[_STATE].dataType
    union = known.select(
        _BY, _AT, F.lit(0).alias(_KIND), F.lit(None).cast(keyed.schema[_ROW].dataType).alias(_ROW),
        F.lit(0).cast("bigint").alias(_UID), F.lit(0).cast("bigint").alias(_W), _STATE,
    ).unionByName(keyed.withColumn(_KIND, F.lit(1)).withColumn(_STATE, F.lit(None).cast(kind)))
    order = [_BY, _AT, _KIND, _UID]
    ranged = (
        union.repartitionByRange(n, *order).withColumn(_BUCKET, F.spark_partition_id()).checkpoint(eager=True)
    )
    rows, most = ranged.agg(F.sum(_W), F.max(_W)).first()

    inside = Window.partitionBy(_BUCKET, _BY).orderBy(_AT, _KIND, _UID).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn(_STATE, F.last(_STATE, ignorenulls=True).over(inside)).where(F.col(_KIND) == 1)
    found = local.join(F.broadcast(_handed_over(ranged)), [_BUCKET, _BY], "left")
    found = found.withColumn(_STATE, F.coalesce(_STATE, "_tl_before"))
    if (most or 0) > 1:
        found = each_copy(found, rows, most, n).drop(COPY)
    out = found.select(_ROW, _STATE).unionByName(tagged.where(~placed).select(_ROW, F.lit(None).cast(kind).alias(_STATE)))
    return out.select(
        *[F.col(f"{_ROW}.c{i}").alias(c) for i, c in enumerate(names)],
        *[F.col(f"{_STATE}.s{i}").alias(c) for i, c in enumerate(columns)],
    )


def _handed_over(ranged: DataFrame) -> DataFrame:
    """The state that each bucket takes over for its first key: the last one of
    that key in the buckets before.  At most two rows a bucket."""
    edges = ranged.groupBy(_BUCKET).agg(F.min(_BY).alias("lo"), F.max(_BY).alias("hi"))
    edges = edges.select(F.explode(F.array("lo", "hi")).alias(_BY)).distinct()
    edge_rows = ranged.join(F.broadcast(edges), _BY, "left_semi")
    newest = F.max_by(_STATE, F.when(F.col(_KIND) == 0, F.col(_AT)))
    last = edge_rows.groupBy(_BUCKET, _BY).agg(newest.alias(_STATE))
    earlier = Window.partitionBy(_BY).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return last.select(_BUCKET, _BY, F.last(_STATE, ignorenulls=True).over(earlier).alias("_tl_before"))
