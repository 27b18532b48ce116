"""The stream of actions: reading, de-duplication and bounded runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.config import new_table_path, stage
from sessionloom.operators.skew import salted_join
from sessionloom.sources.rejects import LATE, REPEATED


def read_stream(spark: SparkSession, path: str, schema, time_col: str = "ts", **options) -> DataFrame:
    """A folder of parquet files as a stream; event time as TIMESTAMP.

    Options such as ``maxFilesPerTrigger`` bound what a micro-batch holds.
    """
    stream = spark.readStream.schema(schema).options(**options).parquet(path)
    return stream.withColumn(time_col, F.col(time_col).cast("timestamp"))


def dedup_signals(stream: DataFrame, id_col: str, time_col: str = "ts", lateness: str = "1 hour") -> DataFrame:
    """Drop repeats of an event that arrive within the allowed lateness."""
    return stream.withWatermark(time_col, lateness).dropDuplicatesWithinWatermark([id_col])


class Arrivals:
    """Handles one micro-batch: tells events that arrive in time from repeated and late ones.

    An event is late if it is older, by more than ``lateness``, than the newest event of earlier
    micro-batches, or has no time; it is repeated if one of its id is among the
    events accepted from that time on, or earlier in its own micro-batch. Rows without
    id are never repeated. Nothing is lost: under ``path``, ``accepted`` and ``rejects``
    (with a ``reason``) together are the input, one folder per micro-batch, which a
    repeated micro-batch replaces. ``then(accepted, batch_id)`` goes on with the rest.
    """

    def __init__(self, path: str, id_col: str, time_col: str = "ts", lateness: str = "1 HOUR", then: Callable[[DataFrame, int], None] | None = None):
        self.path, self.id_col, self.time_col, self.lateness, self.then = path, id_col, time_col, lateness, then

    def _read(self, spark: SparkSession, name: str, schema: str, before: int) -> DataFrame:
        rows = spark.read.schema(f"{schema}, batch_id int").option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")
        return rows.where(F.col("batch_id") < before)

    def _write(self, rows: DataFrame, name: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch_id={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = stage(batch.withColumn("_row", F.monotonically_increasing_id()))
        id_type = batch.schema[self.id_col].dataType.simpleString()
        span, known = "newest timestamp", f"_id {id_type}, _time timestamp"
        if batch_id == 0:
            self._write(spark.createDataFrame([], span), "spans", -1)
            self._write(spark.createDataFrame([], known), "seen", -1)
        own_id, time = F.col(self.id_col).alias("_id"), F.col(self.time_col).cast("timestamp")
        spans = self._read(spark, "spans", span, batch_id)
        newest = spans.agg(F.max("newest")).first()[0]
        late, seen = time.isNull(), self._read(spark, "seen", known, batch_id)
        if newest is not None:
            oldest = F.lit(newest) - F.expr(f"INTERVAL {self.lateness}")
            late = late | (time < oldest)
            # Micro-batches all of whose events are too old by now are not read.
            recent = [r.batch_id for r in spans.where(F.col("newest") >= oldest).select("batch_id").collect()]
            seen = seen.where(F.col("batch_id").isin(recent) & (F.col("_time") >= oldest))
        judged = arrived.withColumn("_late", late)
        firsts = judged.where(~F.col("_late")).groupBy(own_id).agg(F.min(F.struct(time.alias("_time"), "_row")).alias("_first"))
        before = seen.select("_id", F.lit(True).alias("_seen")).distinct()
        firsts = firsts.join(before, "_id", "left").withColumnRenamed("_id", self.id_col)
        # Copies of one event may be many: its rows are dealt to several tasks.
        judged = salted_join(judged, firsts, self.id_col, ["_row"], "left")
        again = F.col("_seen").isNotNull() | (F.col("_row") != F.col("_first._row"))
        reason = F.when(F.col("_late"), LATE).when(F.coalesce(again, F.lit(False)), REPEATED)
        judged = stage(judged.withColumn("reason", reason).select(*batch.columns, "reason"))
        accepted = judged.where("reason IS NULL").drop("reason")
        self._write(accepted, "accepted", batch_id)
        self._write(judged.where("reason IS NOT NULL"), "rejects", batch_id)
        self._write(accepted.select(own_id, time.alias("_time")), "seen", batch_id)
        self._write(arrived.agg(F.max(time).alias("newest")), "spans", batch_id)
        if self.then is not None:
            self.then(accepted, batch_id)


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], name: str, progress: str | None = None) -> None:
    """Process what is there in micro-batches, then stop.

    Progress is kept in shared storage, under ``progress`` where a stream is to be
    continued; ``handle`` has to give the same result when a micro-batch is repeated.
    """
    checkpoint = progress or new_table_path(stream.sparkSession, f"{name}-progress")
    running = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()


def table_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch to its own folder; a repeat replaces it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
