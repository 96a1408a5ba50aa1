"""Structured Streaming jobs: latest artefact per source, windowed counts
with a watermark, running arm statistics, and new-best alerts with per-key
state.

Results go to parquet tables in the cluster's shared checkpoint folder (the file
sink for append mode, a version per micro-batch for aggregates in update mode),
never to a driver-side memory sink. ``run_available`` and ``run_updates`` drive a
query with ``trigger(availableNow=True)`` so a batch of files is processed
to completion; the same query runs continuously with a processing-time
trigger in production.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from vialflow.operators.window import RANGE, running
from vialflow.session import scratch_path


def table_stream(spark: SparkSession, folder: str, name: str, max_files: int | None = None) -> DataFrame:
    """Stream the parquet files of one table, a single file or a folder of
    part files (schema taken from the files present now; new files are picked
    up as they land). ``max_files`` bounds a micro-batch where that is wanted."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    return stream.parquet(path + "*")


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Process everything available in append mode (rows that never change) and
    return the result table in the shared folder as a batch DataFrame."""
    spark = stream.sparkSession
    out = scratch_path(spark, f"stream-{name}")
    q = (stream.writeStream.outputMode("append").option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True)
         .format("parquet").option("path", out).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _versions(stream: DataFrame, schema: StructType, name: str, out: str | None, mode: str, rows) -> str:
    """Run a stream into a table of versions: a micro-batch writes what it changed
    below ``epoch=<its number>`` and touches nothing else. A batch that is run again
    after a failure replaces its own version, so a restart repeats nothing."""
    spark = stream.sparkSession
    out = out or scratch_path(spark, f"stream-{name}")
    # the table can be read before the first batch
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{out}/epoch=-1")

    def write(batch: DataFrame, epoch: int) -> None:
        rows(batch, epoch, out).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
    q = (stream.writeStream.outputMode(mode).option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True)
         .foreachBatch(write).start())
    q.awaitTermination()
    return out


def _read_versions(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField("epoch", LongType())])).parquet(out)


def run_updates(stream: DataFrame, keys: Sequence[str], name: str, out: str | None = None) -> DataFrame:
    """Process everything available in update mode and return the newest row per
    key. Only rows that a batch changed are written, whatever the table's size.
    ``out`` names a table to go on with: the query resumes from its checkpoint."""
    keys = list(keys)
    out = _versions(stream, stream.schema, name, out, "update", lambda batch, epoch, path: batch)
    rest = [c for c in stream.columns if c not in keys]
    newest = _read_versions(stream.sparkSession, out, stream.schema).groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("_r"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_r.{c}") for c in stream.columns])


def latest_per_source(events: DataFrame, source: str, ts: str, kind: str, id_col: str) -> DataFrame:
    """Streaming aggregate per source: last timestamp, kind of the latest
    event (id breaks ties) and event count."""
    return events.groupBy(source).agg(
        F.max(ts).alias("last_ts"),
        F.max_by(F.col(kind), F.struct(F.col(ts), F.col(id_col))).alias("last_kind"),
        F.count(F.lit(1)).alias("n_events"))


def silent_flag(latest: DataFrame, silence: str = "1 day") -> DataFrame:
    """Mark sources whose last event is older than the newest source's last
    event minus ``silence``."""
    newest = latest.agg(F.max("last_ts")).scalar()
    return latest.withColumn("silent", F.col("last_ts") < newest - F.expr(f"INTERVAL {silence}"))


def windowed_counts(events: DataFrame, ts: str, kind: str, window: str = "1 hour",
                    watermark: str = "10 minutes") -> DataFrame:
    """Tumbling-window counts per kind; the watermark lets append mode emit a
    window once no more late rows can reach it. Zone-less timestamps are
    read as session-time-zone timestamps."""
    return (events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
            .groupBy(F.window(ts, window).alias("w"), kind).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), kind, "n"))


def arm_state(events: DataFrame, entity: str, arm: str, reward: F.Column) -> DataFrame:
    """Running pulls / total / mean per (entity, arm), updated per batch."""
    return events.groupBy(entity, arm).agg(F.count(F.lit(1)).alias("pulls"), F.sum(reward).alias("total"),
                                           F.avg(reward).alias("mean"))


_BEST_OUT = StructType([StructField("user_id", LongType()), StructField("event_id", LongType()),
                        StructField("value", DoubleType()), StructField("previous_best", DoubleType())])


def _new_best(batch: DataFrame, epoch: int, out: str) -> DataFrame:
    """Alerts of one micro-batch, given those of earlier ones."""
    ev = batch.where(F.col("value").isNotNull() & ~F.isnan("value"))
    so_far = (_read_versions(batch.sparkSession, out, _BEST_OUT).where(F.col("epoch") < epoch)
              .groupBy("user_id").agg(F.max("value").alias("_best")))  # each best so far is an alert
    r = running(ev, ["ts", "event_id"], {"_before": ("max", "value")}, ["user_id"], block=RANGE, exclusive=True)
    r = r.join(so_far, "user_id", "left").withColumn("previous_best", F.greatest("_before", "_best"))
    return r.where(F.col("previous_best").isNull() | (F.col("value") > F.col("previous_best"))).select(*_BEST_OUT.names)


def best_alerts(events: DataFrame, out: str | None = None) -> DataFrame:
    """New-best alerts per user: an event whose value beats every earlier value of
    that user (the first event always does), in (ts, event_id) order within a
    micro-batch. The table of alerts is the state: a user's best is the largest
    alert of earlier versions. Within a batch the best before each event is a
    running maximum over ranges of (user, time), so a user with most of a batch's
    events is split by time and no Python frame holds them. NULL and NaN values
    raise no alert; ``out`` names a table to go on with."""
    ev = events.select("user_id", "event_id", "ts", F.col("value").cast("double").alias("value"))
    out = _versions(ev, _BEST_OUT, "best", out, "append", _new_best)
    return _read_versions(events.sparkSession, out, _BEST_OUT).select(*_BEST_OUT.names)
