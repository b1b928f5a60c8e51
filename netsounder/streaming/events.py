"""Streams: deduplicated readings, idempotent logs, edit sessions, windows and quality routing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from netsounder.operators.relational import first_by


def read_parquet_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def _timed(stream: DataFrame, time: str, late: str) -> DataFrame:
    """The stream with its watermark; times without a zone are read in the session's."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def first_readings(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """The first reading of each key; one that comes again within the watermark is dropped."""
    return _timed(stream, time, late).dropDuplicatesWithinWatermark([key])


def windowed(stream: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums of ``value`` in tumbling (or sliding) windows; later rows than the watermark are left out."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    out = _timed(stream, time, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(stream: DataFrame, time: str, key: str, gap: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    """Runs of edits of one author without a pause longer than ``gap``."""
    out = _timed(stream, time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def routed(readings: DataFrame, low: float, high: float) -> tuple[DataFrame, DataFrame]:
    """Usable readings, and refused ones with a reason."""
    why = F.when(F.col("value").isNull(), "no answer").when((F.col("value") < low) | (F.col("value") > high), "out of range")
    marked = readings.withColumn("refused", why)
    return marked.where("refused is null").drop("refused"), marked.where("refused is not null")


def merge_log(stream: DataFrame, path: str, checkpoint: str, key: str = "event_id") -> StreamingQuery:
    """Keep a log of distinct events under ``path``: each batch adds the keys that are new, so repeats change nothing."""

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = batch.dropDuplicates([key])
        fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        if fs_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(fs_path):
            old = spark.read.parquet(path).where(F.col("batch") < batch_id)
            new = new.join(old.select(key), key, "left_anti")
        new.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def folded(log: DataFrame, subject: str, order: list[str]) -> DataFrame:
    """The last event of each subject in the log's total order."""
    return first_by(log, [subject], [F.desc(c) for c in order])


def run_now(stream: DataFrame, name: str, mode: str = "append", then: Callable | None = None) -> DataFrame:
    """Drive a stream over all that is there into a table in memory; for tests and small results."""
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    out = stream.sparkSession.table(name)
    return then(out) if then else out


def freshness(spark: SparkSession, ledger: str, schema: str, stage: str = "stage", stamp: str = "fingerprint", time: str = "ran_at") -> DataFrame:
    """A stream of each stage's latest published stamp, from the ledger's files as they come; in ``complete`` mode."""
    seen = spark.readStream.schema(schema).json(ledger)
    last = seen.groupBy(stage).agg(F.max_by(F.col(stamp), F.col(time)).alias(stamp), F.max(time).alias(time))
    return last.select(stage, stamp, time)
