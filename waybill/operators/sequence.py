"""Numbering each entity's events in time, by a scan over range partitions.

Events are sorted by (entity, time, event) into ranges, which is the only exchange. Each task numbers the
events of its range, and one short row per range says how the range begins and ends. From those rows
follow what each range has to add: how many events its first entity had before, that entity's first event
and its outcome, and the time of the event after the range's last one. So no task and no window ever
holds all events of an entity or of a day, and one entity with most of the events is spread like any rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.sources.storage import scratch_table

#: The time that came of an entity's first event, in sequences made with outcomes.
FIRST_OUTCOME = "first_outcome"
_FIRST_ROW, _LAST_ROW = 1, 2


@dataclass
class _Carry:
    """What a task knows of the entity it is in: its key, events so far, first event and its outcome."""

    known: pa.Scalar
    entity: pa.Scalar
    count: int
    first: pa.Scalar
    outcome: pa.Scalar


def _follows(column: pa.Array, other: pa.Array) -> np.ndarray:
    """Where two columns are equal, nulls included."""
    same = pc.fill_null(pc.equal(column, other), False)
    return pc.or_(same, pc.and_(pc.is_null(column), pc.is_null(other))).to_numpy(zero_copy_only=False)


def _numbered(rows: pa.RecordBatch, event: str, ts: str, carry: _Carry | None, range_no: int, final: bool):
    """(numbered events of a sorted piece, what is carried on, rows held back).

    Outcome rows stand after their event and become its column. The last event is held back unless the
    piece is the final one, as the next piece begins with its outcome or with the event after it.
    """
    is_event = pc.equal(rows.column("_kind"), 0).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(is_event)
    count = len(at) if final else len(at) - 1
    if count <= 0 and not final:
        return None, carry, rows
    events = rows.take(pa.array(at))
    if not len(at):
        return None, carry, rows.slice(0, 0)

    of_event = np.full(len(at), -1)
    other = np.flatnonzero(~is_event)
    owner = np.searchsorted(at, other) - 1
    other, owner = other[owner >= 0], owner[owner >= 0]
    if len(other):
        own = np.ones(len(other), dtype=bool)
        for name in ("_known", "_entity", ts, event):
            column = rows.column(name)
            own &= _follows(column.take(pa.array(other)), column.take(pa.array(at[owner])))
        of_event[owner[own][::-1]] = other[own][::-1]
    outcome = rows.column("_outcome").take(pa.array(of_event, mask=of_event < 0))

    new = np.ones(len(at), dtype=bool)
    for_next = np.zeros(len(at), dtype=bool)
    known, entity = events.column("_known"), events.column("_entity")
    for_next[:-1] = _follows(known[1:], known[:-1]) & _follows(entity[1:], entity[:-1])
    new[1:] = ~for_next[:-1]
    if carry is not None:
        new[0] = not (known[0] == carry.known and entity[0] == carry.entity)
    places = np.arange(len(at))
    start = np.maximum.accumulate(np.where(new, places, -1))
    going_on = start < 0
    position = np.where(going_on, (carry.count if carry else 0) + places + 1, places - start + 1)
    own_start = pa.array(start, mask=going_on)
    firsts = events.column(event).take(own_start)
    outcomes = outcome.take(own_start)
    if going_on.any():
        firsts = pc.if_else(pa.array(going_on), carry.first, firsts)
        outcomes = pc.if_else(pa.array(going_on), carry.outcome, outcomes)
    later = events.column(ts).take(pa.array(places + 1, mask=~for_next))

    edge = np.zeros(len(at), dtype=np.int32)
    edge[0] |= _FIRST_ROW * (carry is None)
    edge[-1] |= _LAST_ROW * final
    extra = {
        "_range": pa.array(np.full(len(at), range_no, dtype=np.int32)),
        "_edge": pa.array(edge),
        "_position": pa.array(position.astype(np.int64)),
        "_next": later,
        "_first": firsts,
        "_first_outcome": outcomes,
    }
    kept = [name for name in events.schema.names if name not in ("_kind", "_outcome")]
    columns = [events.column(name) for name in kept] + list(extra.values())
    out = pa.RecordBatch.from_arrays(columns, names=kept + list(extra)).slice(0, count)
    last = count - 1
    carry = _Carry(known[last], entity[last], int(position[last]), firsts[last], outcomes[last])
    return out, carry, rows.slice(0, 0) if final else rows.slice(int(at[-1]))


def _ranges(numbered: DataFrame, ts: str) -> DataFrame:
    """One row per range: what its first entity has from earlier ranges, and the time after its last event."""
    edges = numbered.filter("_edge > 0").select(
        "_range", "_edge", F.struct("_known", "_entity").alias("key"), F.col(ts).alias("ts"), "_position", "_first", "_first_outcome"
    )
    first, last = (F.col("_edge").bitwiseAND(bit) > 0 for bit in (_FIRST_ROW, _LAST_ROW))
    pick = lambda edge, value, name: F.max(F.when(edge, value)).alias(name)
    per_range = edges.groupBy("_range").agg(
        pick(first, F.struct("key", "ts"), "begin"),
        pick(last, F.struct("key", F.col("_position").alias("count"), F.col("_first").alias("first"), F.col("_first_outcome").alias("outcome")), "end"),
    )
    # The ranges in which an entity is the last one follow each other; the first of them knows its first event.
    line = W.partitionBy("end.key").orderBy("_range")
    so_far = per_range.select(
        "_range",
        "begin",
        F.struct(
            F.col("end.key").alias("key"),
            F.sum("end.count").over(line).alias("count"),
            F.first("end.first").over(line).alias("first"),
            F.first("end.outcome").over(line).alias("outcome"),
        ).alias("end"),
    )
    # One row per range, of which there are at most as many as shuffle partitions.
    order = W.orderBy("_range")
    before, after = F.lag("end").over(order), F.lead("begin").over(order)
    joined = so_far.select("_range", F.col("begin.key").alias("begin_key"), F.col("end.key").alias("end_key"), before.alias("before"), after.alias("after"))
    return joined.select(
        "_range",
        F.col("begin_key").alias("_begin_key"),
        F.when(F.col("before.key") == F.col("begin_key"), F.col("before")).alias("_before"),
        F.when(F.col("after.key") == F.col("end_key"), F.col("after.ts")).alias("_after"),
    )


def sequence_events(
    events: DataFrame, entity: str, event: str, ts: str, outcomes: DataFrame | None = None, outcome_ts: str = "outcome_ts"
) -> DataFrame:
    """Adds `event_seq`, `next_ts` and `first_event` per entity, ordered by (`ts`, `event`), nulls last.

    Entities that are NULL form one line. With `outcomes`, which has `entity`, `event` and `ts` of some
    events and `outcome_ts`, also adds `first_outcome`, the outcome time of the entity's first event; rows
    of it that match no event are left out. The sorted events are written once to scratch, which runs a job.
    """
    spark = events.sparkSession
    key = {"_known": F.col(entity).isNotNull(), "_entity": F.coalesce(F.col(entity).cast("string"), F.lit(""))}
    kind = outcomes.schema[outcome_ts].dataType if outcomes is not None else T.TimestampType()
    rows = events.withColumns({**key, "_kind": F.lit(0), "_outcome": F.lit(None).cast(kind)})
    if outcomes is not None:
        shared = {entity, event, ts}
        padded = [
            F.col(f.name) if f.name in shared else F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema
        ]
        marks = [value.alias(name) for name, value in key.items()]
        rows = rows.unionByName(outcomes.select(*padded, *marks, F.lit(1).alias("_kind"), F.col(outcome_ts).alias("_outcome")))
    order = ["_known", "_entity", F.col(ts).asc_nulls_last(), F.col(event).asc_nulls_last()]
    # An event and its outcome are equal in these, so they never part.
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, "_kind", "_outcome")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_no, carry, held = TaskContext.get().partitionId(), None, None
        for batch in batches:
            if held is not None and len(held):
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            out, carry, held = _numbered(batch, event, ts, carry, range_no, final=False)
            if out is not None:
                yield out
        if held is not None and len(held):
            out, _, _ = _numbered(held, event, ts, carry, range_no, final=True)
            if out is not None:
                yield out

    kept = [f for f in dealt.schema if f.name not in ("_kind", "_outcome")]
    nullable = lambda name, data_type: T.StructField(name, data_type, True)
    schema = T.StructType(
        [nullable(f.name, f.dataType) for f in kept]
        + [nullable("_range", T.IntegerType()), nullable("_edge", T.IntegerType()), nullable("_position", T.LongType())]
        + [nullable("_next", events.schema[ts].dataType), nullable("_first", events.schema[event].dataType)]
        + [nullable("_first_outcome", kind)]
    )
    numbered = scratch_table(dealt.mapInArrow(scan, schema), "sequence")
    ranges = _ranges(numbered, ts)
    goes_on = F.col("_before").isNotNull() & (F.struct("_known", "_entity") == F.col("_begin_key"))
    last = F.col("_edge").bitwiseAND(_LAST_ROW) > 0
    found = numbered.join(F.broadcast(ranges), "_range").select(
        *events.columns,
        (F.col("_position") + F.when(goes_on, F.col("_before.count")).otherwise(0)).alias("event_seq"),
        F.when(last, F.col("_after")).otherwise(F.col("_next")).alias("next_ts"),
        F.when(goes_on, F.col("_before.first")).otherwise(F.col("_first")).alias("first_event"),
        F.when(goes_on, F.col("_before.outcome")).otherwise(F.col("_first_outcome")).alias(FIRST_OUTCOME),
    )
    return found if outcomes is not None else found.drop(FIRST_OUTCOME)
