"""Helpers shared by the training-data operators: table access, shared scratch folders, column names.

Scratch data always lives below the folder that ``spark.checkpoint.dir`` names, which driver and executors
share. Only a session without that setting (unit tests, one machine) gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared scratch folder of the session; one is made only where the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="ebbflow-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own for one intermediate table."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, buckets: int, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder in hash buckets of ``column`` and read it back: joins on that column leave it in place. The
    table's name leaves the catalog at once; its files stay with the other scratch data."""
    spark = df.sparkSession
    unique = f"{name}_{uuid.uuid4().hex[:12]}"
    df.write.option("path", scratch(spark, name)).option("compression", "zstd").bucketBy(buckets, column).saveAsTable(unique)
    table = spark.table(unique)
    table.schema  # resolved before the name goes  # noqa: B018
    spark.sql(f"DROP TABLE {unique}")
    return table


@contextmanager
def conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL settings (dots written as double underscores) and put the former values back."""
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: Rows of an Arrow batch where whole texts go to Python: Spark counts rows only, and 10,000 texts take tens of MB in the JVM and again in each worker.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession):
    """Within it, actions send at most ``BATCH_ROWS`` rows to Python at once (fewer if the session says so)."""
    now = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    return conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(min(now, BATCH_ROWS) if now > 0 else BATCH_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(column: str) -> F.Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def pieces(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the given text column of each part holds about ``size`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def cut_at(data: bytes | np.ndarray, starts: np.ndarray) -> pa.Array:
    """``data`` cut at ``starts`` (ascending, from 0 on), as a column over the same bytes."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def distinct_of(column: pa.Array) -> tuple[np.ndarray, list]:
    """Place of each value in the list of the distinct values, and that list, in order of first occurrence."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] numbers), starts[1], ..."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def extended(schema: T.StructType, *fields: tuple[str, str]) -> T.StructType:
    """``schema`` with more nullable columns, given as (name, DDL type)."""
    out = T.StructType(list(schema.fields))
    for name, ddl in fields:
        out = out.add(name, T._parse_datatype_string(ddl))
    return out


def file_system(uri: str):
    """(file system, path) of a folder URI, usable inside tasks; whatever store pyarrow knows (file, hdfs, s3, ...)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, name: str, data: bytes) -> None:
    """Write one file of a folder so that a repeated task attempt leaves exactly one whole copy."""
    system, folder = file_system(uri)
    system.create_dir(folder, recursive=True)
    unfinished = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(unfinished, compression=None) as out:
        out.write(data)
    system.move(unfinished, f"{folder}/{name}")


def read_files(spark: SparkSession, uri: str, suffix: str) -> DataFrame:
    """The finished files of a folder: path, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", f"[!_]*{suffix}").load(uri).select("path", "content")
