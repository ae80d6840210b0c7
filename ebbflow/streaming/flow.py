"""Streaming flow (ST1-ST6, SRC2, SRC6, SNK3).

The recommended path is ``start_flow_stream`` + ``FlowStreamSink``: every micro-batch is cleaned and reduced to
partial hourly deltas, written under ``batch_id=N`` with dynamic partition overwrite. A replayed batch (same id
after a failure) replaces its own output, so the sink is idempotent. Totals and balances are sums over the
partials, which makes late trips simply count where they belong: no watermark drops them and no state store
grows with the key space.

``live_station_totals`` is a stateful Structured Streaming alternative for low-latency views; its state is one number per
station and drops nothing. Event-time windows that close, with a path for late rows, are in ``windows.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ebbflow.operators.balance import running_balance
from ebbflow.operators.clean import clean_trips, normalise_trips
from ebbflow.operators.deltas import class_flow_by_name
from ebbflow.operators.legs import flow_legs, station_name_pairs
from ebbflow.operators.snapshots import day_nets, day_totals, with_day
from ebbflow.schemas import TRIP_SCHEMA
from ebbflow.sources.tables import hadoop_path


def read_trips_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType = TRIP_SCHEMA,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Trip files arriving in a folder or glob (SRC2, ST1); a micro-batch takes all new files unless told otherwise."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def read_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of ``events`` files as a stream (input of adapter A, which is row-wise and stream-safe)."""
    schema = spark.read.parquet(path).schema
    return read_trips_stream(spark, path, "parquet", schema, max_files_per_trigger)


DELTAS = "hour string, station_id string, delta_total long, delta_ebike long, delta_other long"
PAIRS = "station_id string, station_name string"
BASE_DELTAS = f"{DELTAS}, date date"
TOTALS = "station_id string, total long, date date"


class FlowStreamSink:
    """Micro-batch sink keyed by batch id, plus readers of what it accumulated (ST2-ST6, SNK3).

    A batch writes partial deltas and station name pairs to folders of its own. ``compact`` folds finished batches into one
    base (``upto=N``: deltas by day, pairs, and every station's net flow up to the end of each day); readers take the newest finished base and
    the batches after it, so the cost of a read does not grow with the number of batches ever taken.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        for path in (self.deltas_path, self.pairs_path, self.base_path):  # readable before the first batch
            fs, p = hadoop_path(spark, path)
            fs.mkdirs(p)

    @property
    def deltas_path(self) -> str:
        return f"{self.root}/partial_deltas"

    @property
    def pairs_path(self) -> str:
        return f"{self.root}/station_pairs"

    @property
    def base_path(self) -> str:
        return f"{self.root}/base"

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch body: the micro-batch is reduced once, by (hour, station, name); a replay replaces its folder."""
        flow = f"{self.root}/batch_flow/batch_id={int(batch_id)}"
        class_flow_by_name(clean_trips(batch)).write.mode("overwrite").parquet(flow)
        reduced = self.spark.read.schema(f"{DELTAS}, station_name string").parquet(flow)
        sums = [F.sum(c).cast("bigint").alias(c) for c in ("delta_total", "delta_ebike", "delta_other")]
        part = reduced.groupBy("hour", "station_id").agg(*sums)
        part.write.mode("overwrite").parquet(f"{self.deltas_path}/batch_id={int(batch_id)}")
        # name pairs come from all trips, also those that cleaning rejects
        pairs = station_name_pairs(normalise_trips(batch))
        pairs.write.mode("overwrite").parquet(f"{self.pairs_path}/batch_id={int(batch_id)}")
        fs, p = hadoop_path(self.spark, flow)
        fs.delete(p, True)

    def _numbers(self, path: str) -> list[int]:
        """Numbers of the finished folders below a path."""
        fs, p = hadoop_path(self.spark, path)
        if not fs.exists(p):
            return []
        child = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        names = [s.getPath().getName() for s in fs.listStatus(p) if fs.exists(child(s.getPath(), "_SUCCESS"))]
        return sorted(int(n.split("=", 1)[1]) for n in names if "=" in n)

    def _base(self) -> int:
        """The last batch folded into the base; -1 without one."""
        finished = self._numbers(f"{self.base_path}/days")  # written last
        return finished[-1] if finished else -1

    def _open(self, path: str, schema: str) -> DataFrame:
        """Rows of the batches after the base."""
        base = self._base()
        paths = [f"{path}/batch_id={n}" for n in self._numbers(path) if n > base]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _folded(self, kind: str, schema: str) -> DataFrame:
        """Rows of the base."""
        base = self._base()
        return self.spark.read.schema(schema).parquet(f"{self.base_path}/{kind}/upto={base}") if base >= 0 else self.spark.createDataFrame([], schema)

    def deltas(self) -> DataFrame:
        """hour, station_id, delta_total, delta_ebike, delta_other summed over the base and the open batches."""
        parts = self._folded("deltas", BASE_DELTAS).drop("date").unionByName(self._open(self.deltas_path, DELTAS))
        return parts.groupBy("hour", "station_id").agg(
            *[F.sum(c).cast("bigint").alias(c) for c in ("delta_total", "delta_ebike", "delta_other")]
        )

    def pairs(self) -> DataFrame:
        """station_id, station_name pairs seen in any batch."""
        return self._folded("pairs", PAIRS).unionByName(self._open(self.pairs_path, PAIRS)).distinct()

    def open_deltas(self) -> DataFrame:
        """The same as ``deltas`` of the batches after the base only."""
        parts = self._open(self.deltas_path, DELTAS)
        return parts.groupBy("hour", "station_id").agg(F.sum("delta_total").cast("bigint").alias("delta_total"))

    def compact(self) -> int:
        """Fold all finished batches into a new base; returns the last batch folded. Not while a batch is being written."""
        done = self._numbers(self.deltas_path)
        last, base = max(done, default=-1), self._base()
        if last <= base:
            return base
        by_day = with_day(self.deltas()).hint("rebalance", "date")
        # each base has folders of its own; a session's dynamic overwrite would leave them without _SUCCESS, so unfinished
        by_day.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(f"{self.base_path}/deltas/upto={last}")
        self.pairs().write.mode("overwrite").parquet(f"{self.base_path}/pairs/upto={last}")
        folded = self.spark.read.schema(BASE_DELTAS).parquet(f"{self.base_path}/deltas/upto={last}")
        days = day_totals(day_nets(folded)).hint("rebalance", "date")
        days.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(f"{self.base_path}/days/upto={last}")  # makes the base current
        for kind in ("deltas", "pairs", "days"):
            for n in self._numbers(f"{self.base_path}/{kind}"):
                if n < last:
                    self._delete(f"{self.base_path}/{kind}/upto={n}")
        for path in (self.deltas_path, self.pairs_path):
            for n in self._numbers(path):
                if n <= last:
                    self._delete(f"{path}/batch_id={n}")
        return last

    def _delete(self, path: str) -> None:
        fs, p = hadoop_path(self.spark, path)
        fs.delete(p, True)

    def compact_into(self, tables) -> DataFrame:
        """Fold the accumulated totals into a ``FlowTables`` flow table (replace on key).

        The partials of all batches sum to complete totals per (hour, station), so replacing is exact and
        repeatable; only the days that occur in the partials are rewritten.
        """
        return tables.upsert_deltas(self.deltas(), mode="replace")

    def balances(self, initial: int = 0) -> DataFrame:
        """station_id, hour, balance: running balance over the accumulated deltas (starts at 0 by default,
        like the streaming job it models)."""
        return running_balance(self.deltas(), initial).select("station_id", "hour", "balance")

    def _base_dates(self) -> list[str]:
        """The days of the base, as dates in text."""
        fs, p = hadoop_path(self.spark, f"{self.base_path}/days/upto={self._base()}")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.split("=", 1)[1] for n in names if n.startswith("date="))

    def open_balances(self, initial: int = 0) -> DataFrame:
        """station_id, hour, balance of all hours that the open batches changed, on the days that they touch.

        An open batch may hold late hours, before or between those of the base. Of the base only the touched days are read, and the day totals before
        them. On later days the balance is that of the base plus the station's open flow; ``balances`` has all hours.
        """
        opened = with_day(self.open_deltas())
        touched = opened.select("date").distinct()
        folded = self._folded("deltas", BASE_DELTAS).join(touched, "date", "left_semi").select("date", "hour", "station_id", "delta_total")
        rows = folded.withColumn("open", F.lit(0)).unionByName(opened.select("date", "hour", "station_id", "delta_total", F.lit(1).alias("open")))
        rows = rows.groupBy("date", "station_id", "hour").agg(F.sum("delta_total").alias("delta_total"), F.sum("open").alias("open"), F.sum(F.col("delta_total") * F.col("open")).alias("own"))

        # per station and touched day: the base's total before it, and the open flow of earlier days
        earlier = Window.partitionBy("station_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
        days = rows.groupBy("station_id", "date").agg(F.sum("own").alias("own"), F.sum("open").alias("open"))
        days = days.select("station_id", "date", F.sum("own").over(earlier).alias("own"), F.sum("open").over(earlier).alias("open_before"))
        known = F.array(*[F.to_date(F.lit(d)) for d in self._base_dates()]).cast("array<date>")
        before = touched.withColumn("at", F.array_max(F.filter(known, lambda d: d < F.col("date"))))
        totals = self._folded("days", TOTALS).withColumnRenamed("date", "at").join(before, "at").select("station_id", "date", "total")
        days = days.join(totals, ["station_id", "date"], "left")
        start = F.coalesce("own", F.lit(0)) + F.coalesce("total", F.lit(0))
        days = days.select("station_id", "date", start.alias("before"), F.coalesce("open_before", F.lit(0)).alias("open_before"))

        inside = Window.partitionBy("station_id", "date").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
        found = rows.join(days, ["station_id", "date"]).select(
            "station_id",
            "hour",
            (F.lit(initial) + F.col("before") + F.sum("delta_total").over(inside)).cast("bigint").alias("balance"),
            (F.col("open_before") + F.sum("open").over(inside)).alias("changed"),
        )
        return found.where("changed > 0").select("station_id", "hour", "balance")


def start_flow_stream(
    trips: DataFrame,
    sink: FlowStreamSink,
    checkpoint: str,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Run the micro-batch sink over a trip stream; progress is kept in ``checkpoint`` (a shared folder)."""
    writer = trips.writeStream.foreachBatch(sink.write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(query: StreamingQuery) -> None:
    """Wait until an ``availableNow`` query has consumed everything; re-raise its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc


def live_station_totals(trips: DataFrame) -> DataFrame:
    """Running net flow per station (update mode); state holds one number per station."""
    return flow_legs(clean_trips(trips)).groupBy("station_id").agg(
        F.sum("delta").cast("bigint").alias("net_change")
    )


def distinct_pairs_stream(trips: DataFrame) -> DataFrame:
    """(station_id, station_name) pairs, each emitted once across all batches (ST3).

    Deduplication state holds one entry per distinct pair, a set bounded by the station catalogue.
    """
    legs = flow_legs(normalise_trips(trips), with_names=True)
    return (
        legs.where(F.col("station_name").isNotNull())
        .select("station_id", "station_name")
        .dropDuplicates(["station_id", "station_name"])
    )
