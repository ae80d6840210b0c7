"""Hourly flow by event time: windows that close at a watermark, and a second path that keeps what comes later (ST4).

The watermark before a batch is the latest event time of all earlier batches less ``delay``, as for Spark's own windowed aggregates. A window whose end is not
after it is closed: its total does not change any more. Spark drops later rows of a closed window; here they are reduced like the others and kept apart as
*late* rows, so that closed totals can be handed on once while nothing is lost: closed + open + late flow is the flow of all trips.

Every batch writes three small folders of its own number (its flow, its late flow, its latest event time) that a replay overwrites with the same rows: the
watermark depends on earlier batches only. The window state is the partial sums of the batches, not a state store; ``closed`` and ``open`` add them up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ebbflow.functions import hour_text
from ebbflow.operators.clean import clean_trips
from ebbflow.operators.legs import flow_legs
from ebbflow.sources.tables import hadoop_path

FLOW = "hour string, station_id string, delta_total long"
MARK = "latest timestamp"


class WindowSink:
    """Micro-batch sink of hourly windows by event time."""

    def __init__(self, spark: SparkSession, root: str, delay: str = "1 day"):
        self.spark, self.root, self.delay = spark, root.rstrip("/"), delay

    def _path(self, kind: str, batch: int) -> str:
        return f"{self.root}/{kind}/batch_id={batch}"

    def _batches(self, kind: str, before: int | None = None) -> list[str]:
        """Folders of a kind of the finished batches (whose mark is written, which is done last), those before a batch if one is given."""
        fs, p = hadoop_path(self.spark, f"{self.root}/marks")
        if not fs.exists(p):
            return []
        child = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        found = [int(s.getPath().getName().split("=", 1)[1]) for s in fs.listStatus(p) if fs.exists(child(s.getPath(), "_SUCCESS"))]
        return [self._path(kind, n) for n in sorted(found) if before is None or n < before]

    def _read(self, kind: str, schema: str, before: int | None = None) -> DataFrame:
        paths = self._batches(kind, before)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def watermark(self, before: int | None = None) -> str | None:
        """The hour text at or before which windows end that are closed, after all batches (or before one)."""
        mark = self._read("marks", MARK, before).agg((F.max("latest") - F.expr(f"INTERVAL {self.delay}")).alias("w"))
        return mark.select(F.date_format("w", "yyyy-MM-dd HH:mm:ss").alias("w")).first()["w"]  # one row, a few bytes a batch

    @staticmethod
    def _is_closed(mark: str | None):
        """Whether the window of ``hour`` ends at or before the watermark."""
        return F.lit(False) if mark is None else F.to_timestamp("hour") + F.expr("INTERVAL 1 HOUR") <= F.to_timestamp(F.lit(mark))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch body: reduce the batch once, then part it at the watermark of the batches before."""
        number = int(batch_id)
        legs = flow_legs(clean_trips(batch)).select("station_id", "ts", "delta")
        reduced = legs.groupBy(hour_text("ts").alias("hour"), "station_id").agg(F.sum("delta").cast("bigint").alias("delta_total"), F.max("ts").alias("latest"))
        staged = self._path("staged", number)
        reduced.write.mode("overwrite").parquet(staged)
        rows = self.spark.read.schema(f"{FLOW}, {MARK}").parquet(staged)
        late = self._is_closed(self.watermark(before=number))
        for kind, part in (("late", rows.where(late)), ("flow", rows.where(~late))):
            part.select("hour", "station_id", "delta_total").write.mode("overwrite").parquet(self._path(kind, number))
        rows.agg(F.max("latest").alias("latest")).write.mode("overwrite").parquet(self._path("marks", number))  # finishes the batch
        fs, p = hadoop_path(self.spark, staged)
        fs.delete(p, True)

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("hour", "station_id").agg(F.sum("delta_total").cast("bigint").alias("delta_total"))

    def closed(self) -> DataFrame:
        """hour, station_id, delta_total of the windows that do not change any more."""
        return self._summed(self._read("flow", FLOW).where(self._is_closed(self.watermark())))

    def open(self) -> DataFrame:
        """hour, station_id, delta_total so far of the other windows."""
        return self._summed(self._read("flow", FLOW).where(~self._is_closed(self.watermark())))

    def late(self) -> DataFrame:
        """hour, station_id, delta_total of rows that came after their window had closed."""
        return self._summed(self._read("late", FLOW))

    def deltas(self) -> DataFrame:
        """hour, station_id, delta_total of all rows: both paths added up."""
        return self._summed(self._read("flow", FLOW).unionByName(self._read("late", FLOW)))


def start_window_stream(trips: DataFrame, sink: WindowSink, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Run the window sink over a trip stream; progress is kept in ``checkpoint`` (a shared folder)."""
    writer = trips.writeStream.foreachBatch(sink.write_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
