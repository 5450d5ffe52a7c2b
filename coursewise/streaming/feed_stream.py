"""Incremental runs of the ingest jobs with Structured Streaming.

The reference re-reads a whole day's log file per batch job. The same jobs
can follow a landing folder instead: new raw files are picked up by the
file source, parsed by the very same column functions (the jobs are
stateless row maps, so no state store is involved), and committed exactly
once by the file sink, whose metadata log plus the checkpoint make a
restarted or retried query skip what is already written.

``trigger(availableNow=True)`` processes everything present and stops, so a
scheduler can run it like a batch job; drop it for a continuously running
query. Checkpoints live in the shared folder.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import cleaning
from ..plans import sinks
from ..sources import feeds as FD


def _text_stream(spark: SparkSession, landing: str, max_files: int | None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(landing)


def start_feed_ingest(spark: SparkSession, feed: str, landing: str, target: str, checkpoint: str,
                      available_now: bool = True, max_files: int | None = None,
                      run: str | None = None) -> StreamingQuery:
    """Follow ``landing`` (raw lines of one feed) into the partitioned table ``target``.

    Append-mode feeds go through the file sink (exactly-once appends).
    Overwrite-mode feeds (dimension snapshots) replace the partitions that a
    run touches, with all rows of the run, however many micro-batches it takes:
    every batch is staged beside the checkpoint, by partition, and the
    partitions it touches are replaced by what the run has staged for them so
    far. A run belongs to its checkpoint: it is closed when an
    ``available_now`` query ends without an error (or by ``close_run``), and
    only then the next one begins; a run that was cut off goes on where it
    stopped. ``run`` gives a run a name of its own instead.
    """
    spec = FD.FEEDS[feed]
    rows = FD.ingest(_text_stream(spark, landing, max_files), spec)
    w = rows.writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    if spec.mode == "append":
        return (w.format("parquet").partitionBy(*spec.partition).option("compression", "snappy")
                .outputMode("append").start(target))

    _closing(checkpoint)
    number = _closed_runs(spark, checkpoint)
    stage = f"{checkpoint.rstrip('/')}-staged/{run or f'run-{number}'}"
    layout = T.StructType([T.StructField("batch", T.LongType()), *rows.schema.fields])

    def replace(batch: DataFrame, epoch: int) -> None:
        # a repeated batch replaces itself
        batch.write.mode("overwrite").partitionBy(*spec.partition).parquet(f"{stage}/batch={epoch}")
        staged = batch.sparkSession.read.schema(layout).parquet(stage)
        touched = staged.where(f"batch = {epoch}").select(*spec.partition).distinct()
        same = [staged[c].eqNullSafe(touched[c]) for c in spec.partition]
        sinks.overwrite_partitions(staged.join(touched, same, "left_semi").select(*batch.columns), target, spec.partition)

    query = w.foreachBatch(replace).start()
    if available_now and run is None:
        def close() -> None:
            try:
                query.awaitTermination()
            except Exception:  # the caller sees it; the run stays open
                return
            close_run(spark, checkpoint, number)

        _CLOSERS[checkpoint] = threading.Thread(target=close)
        _CLOSERS[checkpoint].start()
    return query


#: Threads that wait for the end of this process's runs, by checkpoint.
_CLOSERS: dict[str, threading.Thread] = {}


def _closing(checkpoint: str) -> None:
    """Waits until a run of this process that has ended is closed."""
    thread = _CLOSERS.pop(checkpoint, None)
    if thread is not None:
        thread.join()


def _closed_runs(spark: SparkSession, checkpoint: str) -> int:
    try:
        done = spark.read.schema("run long").parquet(f"{checkpoint.rstrip('/')}-closed")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return done.distinct().count()


def close_run(spark: SparkSession, checkpoint: str, number: int | None = None) -> None:
    """Ends the snapshot that a checkpoint's runs collect: what comes next replaces it (for queries without ``available_now``)."""
    number = _closed_runs(spark, checkpoint) if number is None else number
    spark.createDataFrame([(number,)], "run long").coalesce(1).write.mode("append").parquet(f"{checkpoint.rstrip('/')}-closed")


def start_behavior_clean(spark: SparkSession, landing: str, target: str, checkpoint: str,
                         available_now: bool = True) -> StreamingQuery:
    """B0 incrementally: raw behaviour lines -> cleaned ORC files (see ``start_behavior_rejects`` for the rest)."""
    return _follow(cleaning.clean_behavior(_text_stream(spark, landing, None)), target, checkpoint, available_now)


def start_behavior_rejects(spark: SparkSession, landing: str, target: str, checkpoint: str,
                           available_now: bool = True) -> StreamingQuery:
    """The lines that the cleaner keeps out, with the reason, as ORC files."""
    return _follow(cleaning.behavior_rejects(_text_stream(spark, landing, None)), target, checkpoint, available_now)


def _follow(rows: DataFrame, target: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = rows.writeStream.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.format("orc").option("compression", "snappy").outputMode("append").start(target)
