"""Status of feeds beyond their session: each start, batch and end is written down.

``FeedLog`` listens to the session's streams. An event becomes one small JSON file below
a shared folder, by day and kind, so that it is there as soon as it happened, whatever
becomes of the session. ``feed_events`` reads them as a table, and ``past_runs`` gives one
row a run: running, ended or failed, with its batches, rows and error. A run that is
still "running" long after its last event was lost with its session.

Defined cases: streams without a name are kept under an empty name; a folder without events
is an empty table; ``remove_events`` drops whole days.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from carebasin.sources.writers import matching_folders, remove_folder

EVENTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("batch", T.LongType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("event_day", T.DateType()),
        T.StructField("kind", T.StringType()),
    ]
)


class FeedLog(StreamingQueryListener):
    """Writes the events of all streams of a session to ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or ""
        self._write("started", event.runId, event.timestamp)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.names[str(progress.runId)] = progress.name or ""
        self._write(
            "progress", progress.runId, progress.timestamp, batch=progress.batchId,
            input_rows=progress.numInputRows, duration_ms=progress.batchDuration,
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._write("failed" if event.exception else "ended", event.runId, error=event.exception)

    def _write(self, kind: str, run_id, moment: str | None = None, **values) -> None:
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        moment = moment or now
        entry = {"run_id": str(run_id), "name": self.names.get(str(run_id), ""), "event_time": moment, **values}
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        place = hadoop.Path(f"{self.folder}/event_day={now[:10]}/kind={kind}/{uuid.uuid4().hex}.json")
        out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()


def watch_feeds(spark: SparkSession, folder: str) -> FeedLog:
    """Write down the streams of this session from now on;
    ``spark.streams.removeListener`` ends it."""
    log = FeedLog(spark, folder)
    spark.streams.addListener(log)
    return log


def feed_events(spark: SparkSession, folder: str, since: dt.date | None = None) -> DataFrame:
    """All events, or those of the days from ``since``; other days are not read."""
    if not matching_folders(spark, f"{folder}/event_day=*"):
        return spark.createDataFrame([], EVENTS)
    events = spark.read.schema(EVENTS).json(folder)
    return events if since is None else events.where(F.col("event_day") >= F.lit(since))


def past_runs(spark: SparkSession, folder: str, since: dt.date | None = None) -> DataFrame:
    """Per run: name, state, first and last event, batches and rows taken, and error."""
    one = F.when(F.col("kind") == "progress", 1)
    return (
        feed_events(spark, folder, since)
        .groupBy("run_id")
        .agg(
            F.max("name").alias("name"),
            F.coalesce(F.max(F.when(F.col("kind").isin("ended", "failed"), F.col("kind"))), F.lit("running")).alias("state"),
            F.min("event_time").alias("first_event"),
            F.max("event_time").alias("last_event"),
            F.count(one).alias("batches"),
            F.coalesce(F.sum("input_rows"), F.lit(0)).alias("input_rows"),
            F.max("batch").alias("last_batch"),
            F.max("error").alias("error"),
        )
    )


def remove_events(spark: SparkSession, folder: str, before: dt.date) -> None:
    """Remove the events of the days before a day."""
    for path in matching_folders(spark, f"{folder}/event_day=*"):
        if path.rsplit("=", 1)[1] < before.isoformat():
            remove_folder(spark, path)
