"""Complete row history from the log, and reads of a history at a point in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronolake.functions.specs import AUDIT, CLOSE, KEY, ORDER, EntitySpec
from chronolake.operators.decode import with_row_hash
from chronolake.operators.skew import MAX_ROWS_PER_KEY, SEGMENT, balance, with_neighbours
from chronolake.session import stored


def build_history(rows: DataFrame, spec: EntitySpec, max_rows_per_key: int = MAX_ROWS_PER_KEY) -> DataFrame:
    """Every version of every key from decoded events (each event once).

    A version starts with an event that changes the row's content and lasts until the next change
    or delete, in source commit time. Events that repeat the content are folded into the version.
    """
    parts = balance(with_row_hash(rows, spec), KEY, ORDER, max_rows_per_key)
    history = _versions(parts.cold, spec)
    if parts.hot is not None:
        history = history.unionByName(_versions(parts.hot, spec))
    return history


def _versions(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    # '' stands for "no row": the content of a key before its first event and after a delete.
    rows = rows.withColumn("_state", F.when(F.col("operation") == "d", "").otherwise(F.col("_hash")))
    rows = with_neighbours(rows, KEY, ORDER, previous={"_before": "_state"})
    changes = rows.where(F.col("_state") != F.coalesce("_before", F.lit("")))
    changes = changes.withColumn("_event", F.struct("operation", *ORDER))
    changes = with_neighbours(changes, KEY, ORDER, following={"_next": "_event"})
    versions = changes.where(F.col("operation") != "d")
    stamped = versions.withColumns(
        {
            "is_active": F.coalesce(F.col("_next.operation") != "d", F.lit(True)),
            "_valid_from": F.timestamp_millis("source_ts_ms"),
            "_valid_to": F.timestamp_millis("_next.source_ts_ms"),
            "_is_current": F.col("_next").isNull(),
            "_cdc_order_lsn": F.col("pg_lsn"),
            **{close: F.col(f"_next.{column}") for close, column in zip(CLOSE, ORDER)},
        }
    )
    return stamped.select(*spec.silver_types())


def end_of_validity() -> Column:
    """``_valid_to``, or the end of time for an open row: sorts and compares without NULL cases."""
    return F.coalesce("_valid_to", F.lit("9999-12-31").cast("timestamp"))


def current_rows(history: DataFrame, active_only: bool = False) -> DataFrame:
    rows = history.where(F.col("_is_current"))
    return rows.where(F.col("is_active")) if active_only else rows


def as_of(history: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at ``moment`` (validity is half-open: [_valid_from, _valid_to))."""
    still_valid = F.col("_valid_to").isNull() | (F.col("_valid_to") > moment)
    return history.where((F.col("_valid_from") <= moment) & still_valid)


def last_closed(history: DataFrame) -> DataFrame:
    """Per key, the end of its latest closed version."""
    return history.where(~F.col("_is_current")).groupBy(KEY).agg(F.max("_valid_to").alias("last_valid_to"))


# Versions come before the facts of the same instant, empty versions before the one that lasts.
_STREAM_ORDER = ("_at", "_kind", "_end")


def fact_join(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    fact_time: str,
    version_columns: Sequence[str],
    how: str = "left",
    max_rows_per_key: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Each fact with the version of its key that was valid at the fact's time.

    Versions of a key do not overlap, so the one to take is the last that started at or before the
    fact, if it had not ended. Facts and versions are merged into one ordered stream per key and
    the version is carried forward: the cost is linear, no fact-version pairs are formed.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    version = F.struct("_valid_from", "_valid_to", *version_columns)
    fact_columns = facts.columns
    starts = history.where(F.col(KEY).isNotNull()).select(
        F.col(KEY).alias("_key"),
        F.col("_valid_from").alias("_at"),
        F.lit(0).alias("_kind"),
        end_of_validity().alias("_end"),
        version.alias("_version"),
    )
    arrivals = facts.select(
        F.col(fact_key).alias("_key"),
        F.col(fact_time).cast("timestamp").alias("_at"),
        F.lit(1).alias("_kind"),
        F.struct(*fact_columns).alias("_fact"),
    )
    stream = starts.unionByName(arrivals, allowMissingColumns=True)
    parts = balance(stream, "_key", _STREAM_ORDER, max_rows_per_key)
    matched = _carry_forward(parts.cold, "_key")
    if parts.hot is not None:
        matched = matched.unionByName(_carry_across_segments(parts.hot))
    ended = F.col("_version._valid_to") <= F.col("_at")
    arrived = matched.where(F.col("_kind") == 1)
    joined = arrived.withColumn("_version", F.when(~F.coalesce(ended, F.lit(False)), F.col("_version")))
    if how == "inner":
        joined = joined.where(F.col("_version").isNotNull())
    return joined.select(
        *[F.col(f"_fact.{c}").alias(c) for c in fact_columns],
        *[F.col(f"_version.{c}").alias(c) for c in ("_valid_from", "_valid_to", *version_columns)],
    )


def _carry_forward(stream: DataFrame, *group: str) -> DataFrame:
    """Fill ``_version`` with the latest one seen so far in the group."""
    so_far = Window.partitionBy(*group).orderBy(*_STREAM_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    return stream.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))


def _carry_across_segments(stream: DataFrame) -> DataFrame:
    # The segment numbers are read twice below; writing them down makes both reads see the same ones.
    stream = stored(stream, "segments")
    own = F.max_by("_version", F.when(F.col("_kind") == 0, F.struct("_at", "_end")))
    ends = stream.groupBy("_key", SEGMENT).agg(own.alias("_own"))
    earlier = Window.partitionBy("_key").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_key", SEGMENT, F.last("_own", ignorenulls=True).over(earlier).alias("_carried"))
    filled = _carry_forward(stream, "_key", SEGMENT).join(carried, ["_key", SEGMENT], "left")
    return filled.withColumn("_version", F.coalesce("_version", "_carried")).drop("_carried", SEGMENT)


def history_spine(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """What late events need of all earlier ones: key, audit columns and content hash, no content."""
    return with_row_hash(rows, spec).select(KEY, *AUDIT, "_hash")


def splice_late(
    history: DataFrame, spine: DataFrame, late: DataFrame, spec: EntitySpec, max_rows_per_key: int = MAX_ROWS_PER_KEY
) -> DataFrame:
    """The history with decoded events put in where they belong in event order, whatever order they came in.

    ``history`` holds all versions of the events whose ``history_spine`` is ``spine``; both are to be stored
    tables. The result equals ``build_history`` over those events and the late ones. Events that the spine
    has already, and repeated ones, change nothing. Add ``history_spine(late, spec)`` to the spine afterwards.

    Only a stretch of each key is built anew: from the change that covers the first late event to the second
    change after the last one. Inside, a late event can split a version, or make a repeated content a change;
    the first change behind it can turn into a repetition; the second can't, as the state before it is the
    same. Versions outside the stretch are passed on as they are.
    """
    order, closing = F.struct(*ORDER), F.struct(*[F.col(c).alias(o) for c, o in zip(CLOSE, ORDER)])
    same_event = [F.col(f"late.{c}").eqNullSafe(F.col(f"known.{c}")) for c in (KEY, *ORDER)]
    news = with_row_hash(late, spec).where(F.col(KEY).isNotNull()).dropDuplicates([KEY, *ORDER])
    news = stored(news.alias("late").join(spine.select(KEY, *ORDER).alias("known"), same_event, "left_anti"), "late-events")
    bounds = news.groupBy(KEY).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))

    touched = history.join(bounds, KEY)
    ends = F.when(F.col("_is_current"), F.array(order)).otherwise(F.array(order, closing))
    points = stored(touched.select(KEY, "_first", "_last", F.explode(ends).alias("_at")), "change-points")
    near = points.groupBy(KEY).agg(
        F.max(F.when(F.col("_at") <= F.col("_first"), F.col("_at"))).alias("_from"),
        F.min(F.when(F.col("_at") > F.col("_last"), F.col("_at"))).alias("_next"),
    )
    behind = points.join(near, KEY).groupBy(KEY).agg(F.min(F.when(F.col("_at") > F.col("_next"), F.col("_at"))).alias("_until"))
    cuts = bounds.select(KEY, F.lit(True).alias("_late")).join(near.join(behind, KEY), KEY, "left")
    cuts = stored(cuts.select(KEY, "_late", "_from", "_until"), "stretches")

    placed = history.join(cuts, KEY, "left")
    outside = F.col("_late").isNull() | (order < F.col("_from")) | (order >= F.col("_until"))
    kept = placed.where(F.coalesce(outside, F.lit(False))).select(*history.columns)

    # The change at the end of the stretch is read along, as the close of the last version inside.
    inside = (F.col("_from").isNull() | (order >= F.col("_from"))) & (F.col("_until").isNull() | (order <= F.col("_until")))
    columns = [KEY, *AUDIT, "_hash"]
    events = spine.join(cuts, KEY).where(inside).select(columns).unionByName(news.select(columns))
    # A repetition has the content of the version that it repeats.
    content = [c for c in spec.business() if c not in (KEY, "is_active")]
    known = touched.select(KEY, "_hash", *content).unionByName(news.select(KEY, "_hash", *content))
    known = known.dropDuplicates([KEY, "_hash"])
    whole = events.join(known, [KEY, "_hash"], "left").withColumn("is_active", F.col("operation") != "d")
    whole = stored(whole.select(*spec.business(), *AUDIT), "stretch-events")
    rebuilt = build_history(whole, spec, max_rows_per_key).join(cuts.select(KEY, "_until"), KEY)
    rebuilt = rebuilt.where(F.col("_until").isNull() | (order < F.col("_until")))
    return kept.unionByName(rebuilt.select(*history.columns))
