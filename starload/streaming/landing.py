"""Landed payload files as a stream: each micro-batch of new files becomes one load batch.

The reference fetches payloads and loads them batch by batch, and recovers from a
missed dimension row only by rerunning (late data is replayed, not merged). Here
the landing folder is a file stream (``wholetext``: one row per file); every
micro-batch runs the same staged, audited, atomic load as the batch jobs, through
``foreachBatch``. The stream's checkpoint (in the shared checkpoint folder) records
which files were processed; a micro-batch re-run after a failure inserts nothing
twice because every load anti-joins against its target.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starload.plans import jobs as J
from starload.plans.store import Warehouse

LOADERS = {
    "teams": lambda spark, wh, batch: J.load_teams(spark, wh, "", payloads=batch),
    "roster": lambda spark, wh, batch: J.load_rosters(spark, wh, batch),
    "schedule": lambda spark, wh, batch: J.load_schedules(spark, wh, batch),
    "boxscore": lambda spark, wh, batch: J.load_boxscores(spark, wh, batch),
}


def payload_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New payload files under ``folder`` as a stream of (path, raw)."""
    return (spark.readStream.format("text").option("wholetext", "true").option("recursiveFileLookup", "true")
            .load(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw")))


def start_landing_loads(spark: SparkSession, wh: Warehouse, landing: str, kind: str,
                        checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Load every new ``kind`` payload file (``teams``, ``roster``, ``schedule``, ``boxscore``) as it lands.

    ``checkpoint`` defaults to a fixed folder below the warehouse root, so that a restarted
    application goes on where the last one stopped. ``query.results`` holds the last 1,000 load results.
    With ``available_now`` the query processes what has landed and stops.
    """
    loader = LOADERS[kind]
    checkpoint = checkpoint or f"{wh.root}/_streams/landing-{kind}"
    results = deque(maxlen=1000)

    def run(batch: DataFrame, epoch: int) -> None:
        if batch.limit(1).count():
            results.append(loader(spark, wh, batch))

    writer = payload_stream(spark, f"{landing.rstrip('/')}/{kind}").writeStream.foreachBatch(run)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    query.results = results  # LoadResult per non-empty micro-batch (driver-side counts only)
    return query
