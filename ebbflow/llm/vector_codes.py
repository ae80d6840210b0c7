"""Vector codes: product quantisation on whole numbers with equal-average search.

**Codes.** A vector's components become ``floor(256 * x)`` and are cut into ``parts`` equal consecutive parts. Each part position has
a codebook of ``entries`` entries, at first that part of the rows with the smallest ids. A round assigns every part to its nearest entry
(squared Euclidean distance, ties to the lower index) and moves each entry to the componentwise ``floor(sum / count)`` of
its parts; an entry without parts stays. After the rounds all parts are assigned once more.

**Equal-average search.** The entries of a codebook are sorted by the sum of their components. A part's search begins at its own sum
and widens to both sides. By Cauchy-Schwarz (gap of sums)² / dimension never exceeds the squared distance, so a side is closed when that bound is
strictly above the best distance so far; an entry whose bound equals it may still tie with a lower index and is compared. The search
is exact. All parts of an Arrow batch widen together, and only those whose side is still open are compared.

Scale: a round is one pass over the vectors. Every task adds up its parts per codebook entry and emits at most ``parts * entries`` rows of
sums, which Spark adds up; so any vector may hold a third of all rows. The codebooks (``parts * entries`` rows, whatever the input) are all
that reaches the driver, and go to the tasks with the function. Vectors are read again in each round, never shuffled. Codes and
errors are written to the shared scratch folder once; the errors per label are a map-side combined sum and a join that
Spark plans from measured sizes. Sums are exact 64-bit integers, so a lost and repeated task gives the same codebooks.

Defined results: rows whose vector is null, empty or holds null or non-finite components are left out. The dimension is that of the kept row
with the smallest id (null ids come last, equal ids by vector) and must divide into the parts; rows of another dimension are left out too, as their vectors are of another
space. Rows given twice count twice, also among the first entries. Fewer rows than entries give fewer entries. Null ids and null
labels are kept (nulls are one label). Components of 2**22 or more in size after scaling raise ``ValueError``, since distances would not be exact. No rows
give no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 22


def scaled_vectors(rows: DataFrame, columns: dict[str, str], vector_col: str, scale: int = SCALE) -> DataFrame:
    """The columns named (new name to old) and ``vector`` (array of whole numbers) of the rows whose vector is whole: not null or empty, and
    without null or non-finite components."""
    raw = F.col(f"`{vector_col}`")
    whole = (F.size(raw) > 0) & F.forall(raw, lambda x: F.coalesce(x.cast("double").between(-1.7976931348623157e308, 1.7976931348623157e308), F.lit(False)))
    kept = rows.filter(F.coalesce(whole, F.lit(False)))
    vector = F.transform(raw, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return kept.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()], vector.alias("vector"))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors of an Arrow list column of one length as a matrix of 64-bit integers."""
    found = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dimension)
    if found.size and max(int(found.max()), -int(found.min())) >= LARGEST:
        raise ValueError(f"a component is {LARGEST} or more after scaling")
    return found


def nearest_entries(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance for every row of ``parts``, by equal-average search."""
    n, width = parts.shape
    sums = book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sorted_book, sorted_sums = book[order], sums[order]
    own = parts.sum(axis=1)
    middle = np.searchsorted(sorted_sums, own)
    best = np.full(n, np.iinfo(np.int64).max)
    index = np.full(n, len(book), np.int64)
    sides = [(np.arange(n), 0, 1), (np.arange(n), -1, -1)]  # open rows, first place from the middle, direction
    for step in range(len(book)):
        following = []
        for rows, start, way in sides:
            place = middle[rows] + (start + way * step)
            inside = (place >= 0) & (place < len(book))
            rows, place = rows[inside], place[inside]
            gap = sorted_sums[place] - own[rows]
            # gap² / width > best closes the side; in whole numbers gap² > best * width, kept from overflow by the division
            open_ = gap * gap <= np.minimum(best[rows], np.iinfo(np.int64).max // width) * width
            rows, place = rows[open_], place[open_]
            if len(rows):
                away = parts[rows] - sorted_book[place]
                distance, entry = np.einsum("ij,ij->i", away, away), order[place]
                better = (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
                best[rows[better]], index[rows[better]] = distance[better], entry[better]
            following.append((rows, start, way))
        sides = following
        if not any(len(rows) for rows, _, _ in sides):
            break
    return index, best


def assign(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers (row, part) and summed squared distances (row) of all parts. ``books`` is (part, entry, place)."""
    parts, _, width = books.shape
    codes, errors = np.empty((len(vectors), parts), np.int64), np.zeros(len(vectors), np.int64)
    for p in range(parts):
        codes[:, p], distance = nearest_entries(vectors[:, p * width : (p + 1) * width], books[p])
        errors += distance
    return codes, errors


def _moved(vectors: DataFrame, books: np.ndarray, dimension: int) -> np.ndarray:
    """The codebooks after one round over all vectors."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            values = matrix(batch.column("vector"), dimension)
            codes, _ = assign(values, books)
            for p in range(parts):
                at = p * entries + codes[:, p]
                counts += np.bincount(at, minlength=parts * entries)
                np.add.at(sums, at, values[:, p * width : (p + 1) * width])
        used = np.flatnonzero(counts)
        columns = [pa.array(used), pa.array(counts[used]), *(pa.array(sums[used, k]) for k in range(width))]
        yield pa.RecordBatch.from_arrays(columns, ["entry", "n", *(f"s{k}" for k in range(width))])

    schema = "entry bigint, n bigint, " + ", ".join(f"s{k} bigint" for k in range(width))
    totals = vectors.select("vector").mapInArrow(run, schema).groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("n", *(f"s{k}" for k in range(width)))])
    out = books.reshape(parts * entries, width).copy()
    for row in totals.collect():  # at most parts * entries rows
        out[row["entry"]] = [row[f"s{k}"] // row["n"] for k in range(width)]
    return out.reshape(books.shape)


def train_codebooks(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, place) of ``vectors`` (columns id, vector); None without rows."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).select("vector").collect()
    if not first:
        return None
    dimension = len(first[0]["vector"])
    if dimension % parts:
        raise ValueError(f"{dimension} components cannot be cut into {parts} equal parts")
    same = vectors.filter(F.size("vector") == dimension)
    start = [r["vector"] for r in same.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, dimension // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _moved(same, books, dimension)
    return books


def encode(vectors: DataFrame, books: np.ndarray, keep: dict[str, str]) -> DataFrame:
    """The columns ``keep`` (name to type), ``code`` (two hexadecimal digits a part) and ``error`` of every vector of the books' dimension."""
    dimension = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = assign(matrix(batch.column("vector"), dimension), books)
            text = [c.tobytes().hex() for c in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(text, pa.string()), pa.array(errors)], [*keep, "code", "error"])

    rows = vectors.filter(F.size("vector") == dimension).select(*keep, "vector")
    return rows.mapInArrow(run, ", ".join(f"`{c}` {kind}" for c, kind in keep.items()) + ", code string, error bigint")


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p, entry] for p, entry in enumerate(bytes.fromhex(code))])


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def code_report(
    rows: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The report of the contract: vec_id, code, error, label_error, codebooks_sha256 of every whole vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits a part: 1 to 256 entries")
    vectors = scaled_vectors(rows, {"id": id_col, "label": label_col}, vector_col)
    books = train_codebooks(vectors, parts, entries, rounds)
    kinds = dict(vectors.dtypes)
    if books is None:
        empty = f"vec_id {kinds['id']}, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return rows.sparkSession.createDataFrame([], empty)
    coded = materialize(encode(vectors, books, {c: kinds[c] for c in ("id", "label")}), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
