"""Load batch audit log.

Each start, end, failure or reset is one event row with an increasing ``event_seq``; the
state of a batch is its latest event (``max_by``), so a replay that ends a batch again
overwrites its outcome exactly as the host's UPDATE does. The start time is that of the
latest event that carries one. A commit folds its events into the state it found, so the
audit table holds one row per batch in one directory, however many events there were.
"""

from __future__ import annotations

import time
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.schemas import (ERROR_MESSAGE_LIMIT, LOAD_BATCH, SOURCE_SYSTEM, STATUS_FAILED, STATUS_STARTED,
                              STATUS_SUCCEEDED)

STATE_COLUMNS = ["load_batch_id", "source_system", "load_start_date", "load_end_date", "status", "rows_inserted",
                 "rows_updated", "error_message", "event_seq"]


def utc_now() -> datetime:
    """Load time as a driver-side literal (UTC wall time, no zone)."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_batch_id() -> str:
    """A new batch id (lower-case UUID text)."""
    return str(uuid.uuid4())


def _seq() -> int:
    return time.time_ns()


def start_event(batch_id: str, source_system: str = SOURCE_SYSTEM, at: datetime | None = None) -> tuple:
    """K8: status Started with a start time."""
    return (batch_id, source_system, at or utc_now(), None, STATUS_STARTED, None, None, None, _seq())


def end_event(batch_id: str, status: str, inserted: int | None, updated: int | None, error: str | None = None,
              source_system: str = SOURCE_SYSTEM, at: datetime | None = None) -> tuple:
    """K9: end time, status, counts and error of a batch."""
    if error is not None:
        error = error[:ERROR_MESSAGE_LIMIT]
    return (batch_id, source_system, None, at or utc_now(), status, inserted, updated, error, _seq())


def failed_event(batch_id: str, message: str, source_system: str = SOURCE_SYSTEM) -> tuple:
    """Status Failed from the loader, counts 0/0, message cut to 4000 characters."""
    return end_event(batch_id, STATUS_FAILED, 0, 0, message, source_system)


def succeeded_event(batch_id: str, inserted: int, updated: int, source_system: str = SOURCE_SYSTEM) -> tuple:
    return end_event(batch_id, STATUS_SUCCEEDED, inserted, updated, None, source_system)


def reset_event(batch_id: str, source_system: str = SOURCE_SYSTEM) -> tuple:
    """Back to Started with a NULL outcome (inserted if absent)."""
    return start_event(batch_id, source_system)


def events_frame(spark: SparkSession, events: list[tuple]) -> DataFrame:
    return spark.createDataFrame(events, LOAD_BATCH)


def record(tx, events: list[tuple]) -> None:
    """Commit ``events`` with ``tx``: the audit table becomes the state after them."""
    state = tx.read("load_batch").unionByName(events_frame(tx.store.spark, events))
    tx.replace("load_batch", current_state(state).coalesce(1))


def current_state(events: DataFrame) -> DataFrame:
    """Current audit row per batch: the latest event's outcome, the latest known start time."""
    latest = F.struct(*[F.col(c) for c in ("source_system", "load_end_date", "status", "rows_inserted",
                                             "rows_updated", "error_message", "event_seq")])
    start_seq = F.when(F.col("load_start_date").isNotNull(), F.col("event_seq"))
    agg = events.groupBy("load_batch_id").agg(
        F.max_by("load_start_date", start_seq).alias("load_start_date"),
        F.max_by(latest, F.col("event_seq")).alias("__s"))
    return agg.select("load_batch_id", "__s.source_system", "load_start_date", "__s.load_end_date", "__s.status",
                      "__s.rows_inserted", "__s.rows_updated", "__s.error_message", "__s.event_seq")


def readback(state: DataFrame) -> DataFrame:
    """Audit rows ordered by start time."""
    return state.orderBy(F.col("load_start_date").asc_nulls_last(), "load_batch_id")
