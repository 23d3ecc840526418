"""Did the outcome of an entity's first event change whether it came back?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.timing import days_before, days_between
from waybill.operators.sequence import FIRST_OUTCOME


def first_event_retention(
    sequence: DataFrame,
    outcomes: DataFrame,
    *,
    entity: str,
    ts: str,
    outcome_event: str,
    outcome_ts: str,
    data_end: Column,
    window_days: int,
) -> DataFrame:
    """Cohort of first events that have an outcome, with the next event after that outcome.

    `sequence` comes from `sequence_events`; `outcomes` holds one row per event with an outcome
    (`outcome_event`, `outcome_ts`, any further columns). Adds to `outcomes`: next_order_at,
    days_to_next_order, repeat_in_window, is_mature.

    The next event is the earliest later one with a time after the outcome. A sequence made with these
    outcomes carries that of each first event, so its events are not moved again: the next event is an
    aggregate that combines before its shuffle, and the wide outcomes are joined to one row per entity.
    To a sequence made without them, they are joined here. Events without an entity are different
    unknown entities, of which none is known to have come back.
    """
    # Own names on both sides, so outcome columns can be picked without clashes.
    carried = F.col(FIRST_OUTCOME) if FIRST_OUTCOME in sequence.columns else F.lit(None)
    steps = sequence.select(
        F.col("first_event").alias("_first_event"),
        F.when(F.col(entity).isNotNull() & (F.col("event_seq") > 1), F.col(ts)).alias("_later_ts"),
        carried.alias("_outcome_ts"),
    )
    if FIRST_OUTCOME not in sequence.columns:
        narrow = outcomes.select(
            F.col(outcome_event).alias("_first_event"), F.col(outcome_ts).alias("_outcome_ts")
        )
        steps = steps.drop("_outcome_ts").join(narrow, "_first_event")
    after = F.when(F.col("_later_ts") > F.col("_outcome_ts"), F.col("_later_ts"))
    following = steps.groupBy("_first_event").agg(F.min(after).alias("next_order_at"))
    outcome_at = F.col(outcome_ts)
    days = days_between(outcome_at, F.col("next_order_at"))
    return outcomes.join(following, F.col(outcome_event) == F.col("_first_event")).select(
        *outcomes.columns,
        "next_order_at",
        days.alias("days_to_next_order"),
        F.coalesce(days <= window_days, F.lit(False)).alias("repeat_in_window"),
        (outcome_at <= days_before(data_end, window_days)).alias("is_mature"),
    )
