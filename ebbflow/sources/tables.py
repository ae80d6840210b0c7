"""Parquet table store for the station catalogue and the hourly flow (SNK1-SNK5, SRC3, SRC4).

* ``events_hourly`` holds data below ``date=D/load=N``: an upsert writes the merged rows of the days it touches, each once, as a
  new load, and then a manifest that names the current load of every day. Readers take the newest finished manifest, so
  a load that fails half-way leaves the old state readable, and a day is never a mix of two loads. Readers with an hour
  bound also get a date bound, so whole days are skipped at the scan.
* The files of a day are range-partitioned and sorted by station and carry a bloom filter on it, so a reader that asks for one station skips the
  row groups and pages of the others.
* ``events_hourly_changes`` has what a load changed per station and day. ``station_day_totals`` (see ``snapshot_totals``) has every station's net flow up to the end of each
  day, as of a load. A balance at an hour is one day of totals, the changes that later loads made to earlier days, and the hours of that day;
  a late hour is one row of changes, not a rewrite of all later days.
* ``loaded_files`` names the trip files that loads have taken (path, length, time), so that adding a file twice counts it once.
* ``station`` is small. Each upsert writes a complete new version folder; readers pick the newest finished one.

A load is current when its manifest is written; its days, changes, files and, for a delete, its station version count from then on.

Single writer per table, like the modelled application. ``vacuum`` removes what no manifest names any more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from ebbflow.config import INITIAL_BALANCE
from ebbflow.operators.balance import active_stations
from ebbflow.operators.clean import clean_trips
from ebbflow.operators.deltas import hourly_deltas
from ebbflow.operators.profile import row_counts
from ebbflow.operators.snapshots import day_nets, day_totals, totals_at
from ebbflow.operators.upsert import merge_deltas, merge_stations
from ebbflow.schemas import DELTA_SCHEMA, STATION_SCHEMA

DELTA_STORED = StructType(DELTA_SCHEMA.fields + [StructField("date", DateType()), StructField("load", IntegerType())])
MANIFEST = StructType([StructField("date", DateType()), StructField("load", IntegerType())])

STATION = "station"
EVENTS_HOURLY = "events_hourly"
MANIFESTS = "events_hourly_manifests"
CHANGES = "events_hourly_changes"
TOTALS = "station_day_totals"
FILES = "loaded_files"
NEEDS = "station_needs"
STAGED = "_staged"
CHANGE = "date date, station_id string, net bigint"
TOTAL = "station_id string, total bigint"
FILE = "path string, length bigint, modified bigint"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path on whatever store it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def hadoop_glob(spark: SparkSession, path: str) -> int:
    """How many files or folders a path or glob matches."""
    fs, p = hadoop_path(spark, path)
    return len(fs.globStatus(p) or [])


class FlowTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, *names: str) -> str:
        return "/".join((self.root, *names))

    def _exists(self, *names: str) -> bool:
        fs, p = hadoop_path(self.spark, self.path(*names))
        return fs.exists(p)

    def _delete(self, *names: str) -> None:
        fs, p = hadoop_path(self.spark, self.path(*names))
        fs.delete(p, True)

    def _numbers(self, *names: str, finished: bool = True) -> list[int]:
        """Numbers N of the ``...=N`` folders of a folder, ascending; only those whose write was committed."""
        fs, p = hadoop_path(self.spark, self.path(*names))
        if not fs.exists(p):
            return []
        found = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and "=" in s.getPath().getName()]
        child = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        done = [x for x in found if not finished or fs.exists(child(x, "_SUCCESS"))]
        return sorted(int(x.getName().split("=", 1)[1]) for x in done)

    # --- creation (SNK4) ---
    def create(self) -> "FlowTables":
        """Create both tables empty if absent; existing rows are kept."""
        for name in (STATION, EVENTS_HOURLY, MANIFESTS):
            fs, p = hadoop_path(self.spark, self.path(name))
            fs.mkdirs(p)
        return self

    def drop(self) -> None:
        """Remove both tables with all their rows."""
        for name in (STATION, EVENTS_HOURLY, MANIFESTS, CHANGES, TOTALS, FILES, NEEDS, STAGED):
            self._delete(name)

    # --- staged tables of a running load ---
    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` beside the tables and read it back: computed once, whatever derives from it."""
        path = self.path(STAGED, name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_staged(self) -> None:
        self._delete(STAGED)

    # --- reads (SRC3, SRC4) ---
    def stations(self, active_only: bool = False, ordered: bool = False) -> DataFrame:
        """id, name, capacity, is_active, created_at_utc of the current version, by name if asked for."""
        versions = [v for v in self._numbers(STATION) if self._is_current(v)]
        if not versions:
            return self.spark.createDataFrame([], STATION_SCHEMA)
        out = self.spark.read.schema(STATION_SCHEMA).parquet(self.path(STATION, f"version={versions[-1]}"))
        out = out.where(F.col("is_active") == 1) if active_only else out
        return out.orderBy("name", "id") if ordered else out

    def _is_current(self, version: int) -> bool:
        """Whether a station version stands by itself, or the load that it belongs to is finished."""
        needs = self._numbers(NEEDS, f"version={version}", finished=False)
        return not needs or self._is_finished(needs[-1])

    def _is_finished(self, load: int) -> bool:
        """Whether a load wrote its manifest. Older manifests that a vacuum removed were finished; numbers taken without one stay as empty folders."""
        return load <= max(self._numbers(MANIFESTS), default=-1) and (load in self._numbers(MANIFESTS) or load not in self._numbers(MANIFESTS, finished=False))

    def manifest(self) -> DataFrame:
        """date, load of every day of the flow table."""
        loads = self._numbers(MANIFESTS)
        if not loads:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self.path(MANIFESTS, f"load={loads[-1]}"))

    def deltas(self, until: str | None = None, since: str | None = None, station: str | None = None) -> DataFrame:
        """hour, station_id, delta_total, delta_ebike, delta_other, date; optional inclusive hour bounds, and one station."""
        df = self.spark.read.schema(DELTA_STORED).parquet(self.path(EVENTS_HOURLY))
        if station is not None:
            df = df.where(F.col("station_id") == F.lit(station))
        if until is not None:
            df = df.where((F.col("date") <= F.to_date(F.lit(until[:10]))) & (F.col("hour") <= F.lit(until)))
        if since is not None:
            df = df.where((F.col("date") >= F.to_date(F.lit(since[:10]))) & (F.col("hour") >= F.lit(since)))
        # the manifest has one row per day; both columns are partition columns of the data
        return df.join(self.manifest(), ["date", "load"], "left_semi").select(*DELTA_SCHEMA.fieldNames(), "date")

    def hourly_events(self, until: str | None = None, since: str | None = None) -> DataFrame:
        """hour (timestamp), station_id, delta: the flow as the monitoring view reads it (SRC4)."""
        return self.deltas(until, since).select(
            F.to_timestamp("hour").alias("hour"), "station_id", F.col("delta_total").alias("delta")
        )

    # --- balances from day totals (AG7, JN2) ---
    def snapshot_totals(self) -> int:
        """Write the totals of every station and day as of the current load; returns its number. Older totals and the changes they lacked go. Run it while
        no load is writing."""
        loads = self._numbers(MANIFESTS)
        if not loads:
            return -1
        rows = day_totals(day_nets(self.deltas())).hint("rebalance", "date").sortWithinPartitions("date", "station_id")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(self.path(TOTALS, f"load={loads[-1]}"))
        for name in (TOTALS, CHANGES):
            for n in self._numbers(name, finished=False):
                if n < loads[-1] or (name == CHANGES and n == loads[-1]):
                    self._delete(name, f"load={n}")
        return loads[-1]

    def _total_days(self, load: int) -> list[str]:
        fs, p = hadoop_path(self.spark, self.path(TOTALS, f"load={load}"))
        return sorted(s.getPath().getName().split("=", 1)[1] for s in fs.listStatus(p) if s.isDirectory() and "date=" in s.getPath().getName())

    def changes(self, after: int) -> DataFrame:
        """date, station_id, net: what the finished loads after load ``after`` changed."""
        paths = [self.path(CHANGES, f"load={n}") for n in self._numbers(CHANGES) if n > after and self._is_finished(n)]
        return self.spark.read.schema(CHANGE).parquet(*paths) if paths else self.spark.createDataFrame([], CHANGE)

    def net_changes(self, as_of: str) -> DataFrame:
        """station_id, net_change up to and including hour ``as_of``: one day of totals, later changes of earlier days, the hours of the last day."""
        day = as_of[:10]
        load = max(self._numbers(TOTALS), default=-1)
        earlier = [d for d in self._total_days(load) if d < day] if load >= 0 else []
        if load < 0:  # never summed up: all hours
            hours, later = self.deltas(until=as_of), self.spark.createDataFrame([], CHANGE)
        else:
            hours = self.deltas(until=as_of, since=f"{day} 00:00:00")
            later = self.changes(load).where(F.col("date") < F.to_date(F.lit(day)))
        path = self.path(TOTALS, f"load={load}", f"date={earlier[-1]}") if earlier else None
        start = self.spark.read.schema(TOTAL).parquet(path) if path else self.spark.createDataFrame([], TOTAL)
        return totals_at(start, later, hours)

    def balances_as_of(self, as_of: str, initial: int = INITIAL_BALANCE, active_only: bool = True) -> DataFrame:
        """station_id, station_name, balance of every catalogue station at the end of hour ``as_of``."""
        named = active_stations(self.stations(), active_only)
        balance = F.lit(initial).cast("bigint") + F.coalesce("net_change", F.lit(0))
        return named.join(self.net_changes(as_of), "station_id", "left").select("station_id", "station_name", balance.cast("bigint").alias("balance"))

    # --- upserts (SNK1, SNK2) ---
    def upsert_stations(self, new: DataFrame, now: Column | None = None) -> DataFrame:
        """Merge station rows (id, name[, capacity, is_active]) and write them as the next version."""
        version = max(self._numbers(STATION, finished=False), default=-1) + 1
        merge_stations(self.stations(), new, now).write.parquet(self.path(STATION, f"version={version}"))
        return self.stations()

    def upsert_deltas(self, new: DataFrame, mode: str = "replace", stored: bool = False, load: int | None = None) -> DataFrame:
        """Merge flow rows and write the days they touch as a new load (of a number already taken, if given); returns the table.

        ``new`` is read twice (its days, its rows) and staged first unless it is ``stored`` already. Old rows are read only of
        the touched days. Each merged row is written once.
        """
        new = new.select(*[c for c in DELTA_SCHEMA.fieldNames() if c in new.columns])
        for c in ("delta_ebike", "delta_other"):
            if c not in new.columns:
                new = new.withColumn(c, F.lit(0).cast("bigint"))
        new = new if stored else self.stage(new, "upsert")
        load = self._take_load() if load is None else load
        day = F.to_date(F.substring("hour", 1, 10))
        touched = new.select(day.alias("date")).distinct()
        old = self.deltas().join(touched, "date", "left_semi")
        merged = merge_deltas(old, new, mode).withColumns({"date": day, "load": F.lit(load)})
        self._write_load(merged, old, touched, load)
        if not stored:
            self._delete(STAGED, "upsert")
        return self.deltas()

    def _take_load(self) -> int:
        """The next load's number; a load that fails leaves it unfinished, and it is not used again."""
        load = max(self._numbers(MANIFESTS, finished=False), default=-1) + 1
        fs, p = hadoop_path(self.spark, self.path(MANIFESTS, f"load={load}"))
        fs.mkdirs(p)
        return load

    def _write_load(self, merged: DataFrame, old: DataFrame, touched: DataFrame, load: int) -> None:
        """The rows of the touched days, what they change, then the manifest that makes both current."""
        self._write_days(merged)
        written = self.spark.read.schema(DELTA_STORED).parquet(self.path(EVENTS_HOURLY)).where(F.col("load") == load)
        both = day_nets(written).unionByName(day_nets(old).withColumn("net", -F.col("net")))
        change = both.groupBy("date", "station_id").agg(F.sum("net").cast("bigint").alias("net")).where("net <> 0")
        change.write.mode("overwrite").parquet(self.path(CHANGES, f"load={load}"))
        self._write_manifest(touched.select("date", F.lit(load).alias("load")), load)

    def _write_days(self, merged: DataFrame) -> None:
        # ranges of (day, station): a hot day is several files of different stations, and small days share a task.
        # appended: another load of the same day is another folder; rows of a failed load are in no manifest
        rows = merged.repartitionByRange("date", "station_id").sortWithinPartitions("date", "station_id", "hour")
        writer = rows.write.mode("append").partitionBy("date", "load").option("parquet.bloom.filter.enabled#station_id", "true")
        writer.parquet(self.path(EVENTS_HOURLY))

    # --- cascade delete (JN8) ---
    def delete_stations(self, ids: DataFrame) -> DataFrame:
        """Delete the stations that ``ids`` (column id) names together with their flow; returns the remaining flow.

        Only days that hold their rows are rewritten. The new station version is marked as belonging to the load and written first; the load's
        manifest makes both current at once, so a delete that fails half-way changes nothing.
        """
        gone = self.stage(ids.select(F.col("id").alias("station_id")).distinct(), "delete")
        load = self._take_load()
        touched = self.deltas().join(gone, "station_id", "left_semi").select("date").distinct()
        old = self.deltas().join(touched, "date", "left_semi")
        kept = old.join(gone, "station_id", "left_anti").withColumn("load", F.lit(load)).select(*DELTA_STORED.fieldNames())
        version = max(self._numbers(STATION, finished=False), default=-1) + 1
        fs, p = hadoop_path(self.spark, self.path(NEEDS, f"version={version}", f"load={load}"))
        fs.mkdirs(p)
        remaining = self.stations().join(gone.select(F.col("station_id").alias("id")), "id", "left_anti")
        remaining.select(*STATION_SCHEMA.fieldNames()).write.parquet(self.path(STATION, f"version={version}"))
        self._write_load(kept, old, touched, load)
        self._delete(STAGED, "delete")
        return self.deltas()

    # --- files, each added once (SNK2) ---
    def add_trip_files(self, path: str, read) -> int:
        """Add the flow of the trip files that ``path`` (a folder or glob) holds and that no finished load has taken; returns how many were new.

        ``read`` makes trips of a list of paths. Files are known by path, length and time of their last change.
        """
        fs, p = hadoop_path(self.spark, path)
        found = [s for s in (fs.listStatus(p) if fs.exists(p) else fs.globStatus(p) or []) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]
        listed = [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in found]
        taken = [self.path(FILES, f"load={n}") for n in self._numbers(FILES) if self._is_finished(n)]
        known = self.spark.read.schema(FILE).parquet(*taken) if taken else self.spark.createDataFrame([], FILE)
        new = self.spark.createDataFrame(listed, FILE).join(known, ["path", "length", "modified"], "left_anti").collect()  # as long as the listing
        if not new:
            return 0
        flow = self.stage(hourly_deltas(clean_trips(read([r["path"] for r in new])), by_class=True), "files")
        load = self._take_load()
        self.spark.createDataFrame(new, FILE).coalesce(1).write.mode("overwrite").parquet(self.path(FILES, f"load={load}"))
        self.upsert_deltas(flow, mode="add", stored=True, load=load)
        self._delete(STAGED, "files")
        return len(new)

    def _write_manifest(self, days: DataFrame, load: int) -> None:
        kept = self.manifest().join(days.select("date"), "date", "left_anti")
        kept.unionByName(days).coalesce(1).write.mode("append").parquet(self.path(MANIFESTS, f"load={load}"))  # one row per day

    # --- maintenance ---
    def vacuum_stations(self, keep: int = 1) -> int:
        """Delete all but the newest ``keep`` current station versions; returns how many version folders were removed.

        Readers always select the highest current version, so older ones are only history. Run it while no upsert is
        writing (single writer, as for the upserts themselves).
        """
        kept = [v for v in self._numbers(STATION) if self._is_current(v)][-keep:]
        old = [v for v in self._numbers(STATION, finished=False) if v not in kept]
        for version in old:
            self._delete(STATION, f"version={version}")
        return len(old)

    def vacuum_deltas(self) -> int:
        """Delete the loads of days that the current manifest does not name, and older manifests."""
        current = {(str(r["date"]), r["load"]) for r in self.manifest().collect()}  # one row per day
        fs, p = hadoop_path(self.spark, self.path(EVENTS_HOURLY))
        removed = 0
        for day in [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]:
            for load in self._numbers(EVENTS_HOURLY, day, finished=False):
                if (day.split("=", 1)[1], load) not in current:
                    self._delete(EVENTS_HOURLY, day, f"load={load}")
                    removed += 1
        finished = self._numbers(MANIFESTS)
        for load in finished[:-1]:  # unfinished ones stay: they tell which changes and files do not count
            self._delete(MANIFESTS, f"load={load}")
        return removed

    # --- status (SNK5) ---
    def status(self) -> DataFrame:
        """name, rows per table; a missing table counts 0 rows."""
        frames = {}
        for name, reader in ((STATION, self.stations), (EVENTS_HOURLY, self.deltas)):
            frames[name] = reader() if self._exists(name) else self.spark.createDataFrame([], "x int")
        return row_counts(frames)
