"""Hard negatives by a GNAT-style multiway hyperplane tree with exact leaves.

**Tree.** Each inner node has up to ``FANOUT`` split points; a vector goes to the child of its nearest split point. The split points are picked far
apart from a bounded sample of ``SAMPLE`` rows; every row is indexed. A node stores, for each split point i and each child j, the least and
the greatest distance from i to any row below j, taken over all rows. Leaves hold the rows themselves, as chunks of at most ``CHUNK``.

**Distances.** Scores are inner products of whole numbers. Each row gets one more component that lifts all rows to the same length R, a query
a zero there; then distance² = |query|² + R² - 2 * score, so a window of scores is exactly an annulus around the query.

**Search.** A child is eliminated for a window when, for some split point, the range stored for the child and the query's distance to that split point leave no
distance inside the window's annulus (triangle inequality, with a slack far above rounding). A search has two waves: first the anchor's own
leaf, which gives the k-th best score so far; then every other leaf that the annulus from there on still meets. Inside a leaf every row
is compared, so the results are exact whatever the tree looks like. First the best rows of the same label are found (positives), then, per
positive, the best rows of other labels inside the window of its score.

Scale: one pass gives sizes and lengths, one routes the rows and packs them into chunks without a shuffle; chunks of a leaf with very many rows (copies of
one vector) are separate rows, and Spark splits such a leaf in the join. Anchors travel in blocks of up to ``BLOCK``, one row for each leaf that
a block visits; the join by leaf meets chunks and blocks, and a matrix product compares them. Candidates leave a chunk as at most k rows per window, and
a window function keeps the first k with a limit inside each task. What reaches the driver is the sample (``SAMPLE`` rows) and the tree's ranges
(``MAX_LEAVES`` leaves); chunks, anchors and candidates are tables in the shared scratch folder, so a lost executor costs one step. Anchors are a fixed
share of the rows and each is held against every leaf that cannot be eliminated, which is the price of exact windows.

Defined results: rows with a null label, a null or empty vector, or null or non-finite components take no part, nor do rows whose dimension is
not that of the row with the smallest id. Equal scores are ordered by id, null ids last; a row with a null id is never an anchor. Rows given
twice are different rows: each is an anchor, and each may be the other's positive. An anchor without positives, or a positive without a row in its
window, gives no rows; so does an empty table. A positive with a negative score has an empty window. Components of 2**22 or more in size after scaling
raise ``ValueError``. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import conf, materialize
from ebbflow.llm.vector_codes import matrix, scaled_vectors

FANOUT, LEAF_ROWS, MAX_LEAVES, SAMPLE = 8, 1024, 1024, 16384
CHUNK, BLOCK, PAIRS_AT_ONCE = 1024, 256, 32
LEAST = -(1 << 60)


@dataclass
class Tree:
    """``splits[n]`` are the lifted split points of node n, ``children[n][j]`` is a node (0 or more) or leaf x as -1 - x."""

    radius2: int
    splits: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    paths: list[list[int]] = field(default_factory=list)  # of each leaf: the nodes above it, root first
    ranges: list[np.ndarray] = field(default_factory=list)  # of each node: [least, greatest][split point i, child j]

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.radius2 - np.einsum("ij,ij->i", vectors, vectors), 0)
        return np.hstack([vectors.astype(float), np.sqrt(rest.astype(float))[:, None]])

    def distances(self, lifted: np.ndarray, node: int) -> np.ndarray:
        """From lifted rows to the split points of a node."""
        return np.sqrt(np.maximum(2.0 * self.radius2 - 2.0 * (lifted @ self.splits[node].T), 0))

    def route(self, lifted: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        leaf = np.zeros(len(lifted), np.int64)
        open_ = [(0, np.arange(len(lifted)))] if self.splits else []
        while open_:
            node, rows = open_.pop()
            nearest = self.distances(lifted[rows], node).argmin(axis=1)
            for j, child in enumerate(self.children[node]):
                own = rows[nearest == j]
                if child < 0:
                    leaf[own] = -1 - child
                elif len(own):
                    open_.append((child, own))
        return leaf

    def chunk_ranges(self, lifted: np.ndarray, leaf: int) -> list[float]:
        """Least and greatest distances of the rows to the split points of the nodes above the leaf, root first."""
        out: list[float] = []
        for node in self.paths[leaf]:
            away = self.distances(lifted, node)
            out += [*away.min(axis=0).tolist(), *away.max(axis=0).tolist()]
        return out

    def take_ranges(self, by_leaf: dict[int, tuple[list[float], list[float]]]) -> None:
        """Fold the leaves' ranges (all least values, all greatest values, in the order of ``chunk_ranges``) into the nodes."""
        self.ranges = [np.stack([np.full((len(s), len(s)), math.inf), np.full((len(s), len(s)), -math.inf)]) for s in self.splits]
        for leaf, (low, high) in by_leaf.items():
            at, path = 0, self.paths[leaf]
            for node, below in zip(path, [*path[1:], -1 - leaf], strict=True):
                k, j = len(self.splits[node]), self.children[node].index(below)
                found = self.ranges[node]
                found[0, :, j] = np.minimum(found[0, :, j], low[at : at + k])
                found[1, :, j] = np.maximum(found[1, :, j], high[at + k : at + 2 * k])
                at += 2 * k

    def visits(self, queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(query, leaf): whether rows with a score in any of the query's windows (low[q, w] to high[q, w]) may be in the leaf."""
        length2 = np.einsum("ij,ij->i", queries, queries).astype(float)
        slack = 1e-5 * math.sqrt(self.radius2) + 1e-9
        inner = np.sqrt(np.maximum(length2[:, None] + self.radius2 - 2.0 * high, 0)) - slack
        far2 = length2[:, None] + self.radius2 - 2.0 * low
        outer = np.sqrt(np.maximum(far2, 0)) + slack
        alive = (low <= high) & (far2 >= 0)
        out = np.zeros((len(queries), len(self.paths)), bool)
        if not self.splits:
            out[:, 0] = alive.any(axis=1)
            return out
        open_ = [(0, alive)]
        while open_:
            node, alive = open_.pop()
            points = self.splits[node][:, :-1]
            away = np.sqrt(np.maximum(length2[:, None] + self.radius2 - 2.0 * (queries @ points.T), 0))[:, :, None]
            least, greatest = self.ranges[node]
            near = np.maximum(away - greatest, least - away).max(axis=1)  # of the rows below child j, by all split points
            far = (away + greatest).min(axis=1)
            met = alive[:, :, None] & (near[:, None, :] <= outer[:, :, None]) & (far[:, None, :] >= inner[:, :, None])
            for j, child in enumerate(self.children[node]):
                if met[:, :, j].any():
                    if child < 0:
                        out[:, -1 - child] = met[:, :, j].any(axis=1)
                    else:
                        open_.append((child, met[:, :, j]))
        return out


def grow(sample: np.ndarray, radius2: int, leaves: int, fanout: int = FANOUT) -> Tree:
    """A tree of about ``leaves`` leaves over a sample of vectors."""
    tree = Tree(radius2)

    def below(points: np.ndarray, want: int, path: list[int]) -> int:
        splits = _far_apart(points, min(fanout, want)) if want > 1 else points[:0]
        if len(splits) < 2:
            tree.paths.append(path)
            return -len(tree.paths)
        node = len(tree.splits)
        tree.splits.append(splits)
        tree.children.append([])
        nearest = tree.distances(points, node).argmin(axis=1)
        for j in range(len(splits)):
            own = points[nearest == j]
            tree.children[node].append(below(own, round(want * len(own) / len(points)), [*path, node]))
        return node

    below(tree.lift(sample), leaves, [])
    return tree


def _far_apart(points: np.ndarray, k: int) -> np.ndarray:
    """Up to k different points, each the farthest from those before among the first 3k candidates."""
    candidates = np.unique(points[: 64 * k], axis=0)
    candidates = candidates[np.linspace(0, len(candidates) - 1, min(len(candidates), 3 * k)).astype(int)] if len(candidates) else candidates
    if len(candidates) < 2:
        return candidates
    chosen, least = [0], ((candidates - candidates[0]) ** 2).sum(axis=1)
    while len(chosen) < k and least.max() > 0:
        chosen.append(int(least.argmax()))
        least = np.minimum(least, ((candidates - candidates[chosen[-1]]) ** 2).sum(axis=1))
    return candidates[chosen]


def _sampled(rows: DataFrame, n: int, sample: int) -> np.ndarray:
    """The vectors of the ``sample`` rows with the least random numbers, of at most n rows. An ordered limit alone sends up to ``sample`` rows of every task to the
    driver; so only numbers below a share that leaves a few more than ``sample`` rows are sent. If less than n rows are there (those of one dimension), the share grows."""
    most = sample + 8 * math.sqrt(sample) + 64  # eight standard deviations more
    share = most / n
    while True:
        drawn = rows.select("vector", F.rand(7).alias("k")).filter(F.col("k") < share)
        picked = drawn.orderBy("k").limit(sample).select("vector").collect()
        if len(picked) >= sample or share >= 1:
            return np.array([r["vector"] for r in picked], np.int64)
        share *= most / max(1, len(picked))


def _pack(vectors: np.ndarray) -> bytes:
    """Whole numbers of two bytes each where they fit, else four."""
    small = not vectors.size or max(int(vectors.max()), -int(vectors.min())) < 1 << 15
    return vectors.astype("<i2" if small else "<i4").tobytes()


def _open(data: bytes, rows: int, dimension: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{len(data) // (rows * dimension)}").reshape(rows, dimension).astype(float)


@dataclass
class Index:
    chunks: DataFrame  # leaf, chunk, ids, labels, anchors, vectors, ranges; rows of a chunk in order of id, null ids last
    tree: Tree
    dimension: int
    n_anchors: int


def build_index(rows: DataFrame, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT, sample: int = SAMPLE, chunk: int = CHUNK) -> Index | None:
    """The index of ``rows`` (id, label, anchor, vector); None without rows."""
    norm = F.aggregate("vector", F.lit(0).cast("double"), lambda s, x: s + x.cast("double") * x.cast("double"))
    least = F.min(F.struct(F.col("id").isNull(), "id", F.size("vector").alias("d")))["d"]
    found = rows.agg(F.max(norm).alias("norm"), least.alias("d"), F.count_if("anchor").alias("anchors"), F.count(F.lit(1)).alias("n")).first()
    if not found["n"]:
        return None
    if found["norm"] >= 2.0**52:
        raise ValueError("vectors are too long for exact scores")
    d, radius2 = found["d"], int(found["norm"])
    rows = rows.filter(F.size("vector") == d)
    leaves = max(1, min(MAX_LEAVES, round(found["n"] / leaf_rows)))
    tree = grow(_sampled(rows, found["n"], sample), radius2, leaves, fanout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 24

        def packed(leaf: int) -> pa.RecordBatch:
            nonlocal number
            part = held.pop(leaf)
            ids, labels, anchors = (np.concatenate([p[k] for p in part]) for k in (0, 2, 3))
            known, vectors = np.concatenate([p[1] for p in part]), np.concatenate([p[4] for p in part])
            order = np.lexsort((ids, ~known))
            number += 1
            made = {
                "leaf": [leaf],
                "chunk": [number],
                "ids": [[i if k else None for i, k in zip(ids[order].tolist(), known[order].tolist(), strict=True)]],
                "labels": [labels[order].tolist()],
                "anchors": [np.flatnonzero(anchors[order]).tolist()],
                "vectors": [_pack(vectors[order])],
                "ranges": [tree.chunk_ranges(tree.lift(vectors), leaf)],
            }
            return pa.RecordBatch.from_pydict(made, schema=kinds)

        for batch in batches:
            if not batch.num_rows:
                continue
            values = matrix(batch.column("vector"), d)
            leaf = tree.route(tree.lift(values))
            ids = batch.column("id")
            columns = (
                ids.fill_null(0).to_numpy(zero_copy_only=False),
                ids.is_valid().to_numpy(zero_copy_only=False),
                batch.column("label").to_numpy(zero_copy_only=False),
                batch.column("anchor").to_numpy(zero_copy_only=False),
                values,
            )
            order = np.argsort(leaf, kind="stable")
            ends = np.flatnonzero(np.diff(leaf[order], append=-1)) + 1
            for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                own, at = int(leaf[order[start]]), start
                while at < end:
                    part = held.setdefault(own, [])
                    room = chunk - sum(len(p[0]) for p in part)
                    part.append([c[order[at : min(end, at + room)]] for c in columns])
                    if end - at >= room:
                        yield packed(own)
                    at += room
        for own in sorted(held):
            yield packed(own)

    longs = pa.list_(pa.int64())
    kinds = pa.schema([("leaf", pa.int64()), ("chunk", pa.int64()), ("ids", longs), ("labels", longs), ("anchors", longs), ("vectors", pa.binary()), ("ranges", pa.list_(pa.float64()))])
    schema = "leaf bigint, chunk bigint, ids array<bigint>, labels array<bigint>, anchors array<bigint>, vectors binary, ranges array<double>"
    typed = rows.select(F.col("id").cast("bigint"), F.col("label").cast("bigint"), F.coalesce("anchor", F.lit(False)).alias("anchor"), "vector")
    chunks = materialize(typed.mapInArrow(run, schema), "tree-chunks")
    each = chunks.select("leaf", F.posexplode("ranges").alias("at", "value")).groupBy("leaf", "at").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    by_leaf: dict[int, tuple[dict, dict]] = {}
    for r in each.collect():  # at most MAX_LEAVES leaves, a few dozen numbers each
        low, high = by_leaf.setdefault(r["leaf"], ({}, {}))
        low[r["at"]], high[r["at"]] = r["low"], r["high"]
    tree.take_ranges({leaf: tuple([x[k] for k in range(len(x))] for x in both) for leaf, both in by_leaf.items()})
    return Index(chunks, tree, d, found["anchors"])


def anchor_table(index: Index) -> DataFrame:
    """anchor (unique number), anchor_id, label, leaf and vector of every anchor row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "anchor_id", "label", "leaf", "vector"]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for leaf, number, ids, labels, anchors, vectors in zip(*(batch.column(c).to_pylist() for c in ("leaf", "chunk", "ids", "labels", "anchors", "vectors")), strict=True):
                size = len(vectors) // len(ids)
                for at in anchors:
                    for column, value in zip(out, (_row_number(number, at), ids[at], labels[at], leaf, vectors[at * size : (at + 1) * size]), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.binary())], names)

    with_anchors = index.chunks.filter(F.size("anchors") > 0).select("leaf", "chunk", "ids", "labels", "anchors", "vectors")
    with conf(index.chunks.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(PAIRS_AT_ONCE)):
        return materialize(with_anchors.mapInArrow(run, "anchor bigint, anchor_id bigint, label bigint, leaf bigint, vector binary"), "anchors")


def _row_number(chunk: int, at: int) -> int:
    return chunk * 4096 + at


def _blocks(requests: DataFrame, index: Index, own_leaf: bool, block: int) -> DataFrame:
    """One row for each leaf that a block of anchors visits: its own leaf, or every other one that its windows may meet. ``requests``: anchor, label, leaf, vector, lows, highs."""
    tree, d = index.tree, index.dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def visits(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            width = max(len(r[4]) for r in rows)
            low, high = np.full((len(rows), width), np.inf), np.full((len(rows), width), -np.inf)
            for i, r in enumerate(rows):
                low[i, : len(r[4])], high[i, : len(r[4])] = r[4], r[5]
            vectors = np.concatenate([_open(r[3], 1, d) for r in rows])
            leaf = np.array([r[2] for r in rows])
            if own_leaf:
                met = np.zeros((len(rows), len(tree.paths)), bool)
                met[np.arange(len(rows)), leaf] = True
            else:
                met = tree.visits(vectors, low, high)
                met[np.arange(len(rows)), leaf] = False
            for visited in np.flatnonzero(met.any(axis=0)).tolist():
                own = [rows[i] for i in np.flatnonzero(met[:, visited])]
                packed = _pack(np.concatenate([_open(r[3], 1, d) for r in own]).astype(np.int64))
                yield pa.RecordBatch.from_pydict(
                    {"at_leaf": [visited], "anchor": [[r[0] for r in own]], "label": [[r[1] for r in own]], "vector": [packed], "lows": [[r[4] for r in own]], "highs": [[r[5] for r in own]]},
                    schema=kinds,
                )

        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("anchor", "label", "leaf", "vector", "lows", "highs")), strict=True)
            while len(held) >= block:
                yield from visits(held[:block])
                held = held[block:]
        if held:
            yield from visits(held)

    longs = pa.list_(pa.int64())
    kinds = pa.schema([("at_leaf", pa.int64()), ("anchor", longs), ("label", longs), ("vector", pa.binary()), ("lows", pa.list_(longs)), ("highs", pa.list_(longs))])
    schema = "at_leaf bigint, anchor array<bigint>, label array<bigint>, vector binary, lows array<array<bigint>>, highs array<array<bigint>>"
    rows = requests.select("anchor", "label", "leaf", "vector", "lows", "highs").repartition(max(1, math.ceil(index.n_anchors / block)))
    return rows.mapInArrow(run, schema)


def _candidates(requests: DataFrame, index: Index, same_label: bool, k: int, own_leaf: bool, block: int, name: str) -> DataFrame:
    """anchor, window, score, id: of every visited chunk the first k rows in each window, of the anchor's label (not the anchor itself) or of others."""
    d = index.dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, ids, labels, vectors, anchor, own, vector, lows, highs = (batch.column(c)[i].as_py() for c in range(batch.num_columns))
                scores = _open(vector, len(anchor), d) @ _open(vectors, len(ids), d).T
                same = np.array(own)[:, None] == np.array(labels)[None, :]
                scores[~same if same_label else same] = -np.inf
                at = np.array(anchor) - _row_number(number, 0)
                inside = np.flatnonzero((at >= 0) & (at < len(ids)))
                scores[inside, at[inside]] = -np.inf  # an anchor is not its own partner
                yield _best(scores, np.array(anchor), pa.array(ids, pa.int64()), lows, highs, k)

    visits = _blocks(requests, index, own_leaf, block)
    # Spark takes the visits for as small as the requests, a row for each leaf met, and would broadcast them through the driver
    joined = index.chunks.select("leaf", "chunk", "ids", "labels", "vectors").join(visits.hint("merge"), F.col("leaf") == F.col("at_leaf"))
    pairs = joined.select("chunk", "ids", F.col("labels"), "vectors", "anchor", "label", "vector", "lows", "highs")
    with conf(index.chunks.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=str(PAIRS_AT_ONCE)):
        return materialize(pairs.mapInArrow(run, "anchor bigint, window int, score bigint, id bigint"), name)


def _best(scores: np.ndarray, anchors: np.ndarray, ids: pa.Array, lows: list, highs: list, k: int) -> pa.RecordBatch:
    """The first k columns of each row in each of the row's windows, by score; equal scores in column order."""
    width = max(map(len, lows))
    low, high = np.full((len(anchors), width), np.inf), np.full((len(anchors), width), -np.inf)
    for i, (a, b) in enumerate(zip(lows, highs, strict=True)):
        low[i, : len(a)], high[i, : len(b)] = a, b
    some = np.flatnonzero(((scores >= low.min(axis=1)[:, None]) & (scores <= high.max(axis=1)[:, None])).any(axis=1))
    order = np.argsort(-scores[some], axis=1, kind="stable")
    ranked = np.take_along_axis(scores[some], order, axis=1)
    out: list[list[np.ndarray]] = [[], [], [], []]
    for w in range(width):
        first = (ranked > high[some, w, None]).sum(axis=1)
        place = first[:, None] + np.arange(k)
        column = np.minimum(place, scores.shape[1] - 1)
        found = np.take_along_axis(ranked, column, axis=1)
        row, col = np.nonzero((place < scores.shape[1]) & (found >= low[some, w, None]) & (found > -np.inf))
        for part, values in zip(out, (anchors[some][row], np.full(len(row), w), found[row, col].astype(np.int64), order[row, column[row, col]]), strict=True):
            part.append(values)
    anchor, window, score, at = (np.concatenate(x) for x in out)
    return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(window, pa.int32()), pa.array(score, pa.int64()), ids.take(pa.array(at, pa.int64()))], ["anchor", "window", "score", "id"])


def _first(candidates: DataFrame, k: int) -> DataFrame:
    """The first k candidates of every anchor and window, numbered from 1 as ``rank``."""
    order = Window.partitionBy("anchor", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _two_waves(requests: DataFrame, index: Index, same_label: bool, k: int, block: int, name: str) -> DataFrame:
    """The first k rows of every anchor and window over all leaves."""
    near = _candidates(requests, index, same_label, k, True, block, f"{name}-own-leaf")
    bound = _first(near, k).filter(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("bounds"))
    raised = F.when(F.col("bounds").isNull(), F.col("lows")).otherwise(F.transform("lows", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("bounds", w), x))))
    rest = requests.join(bound, "anchor", "left").withColumn("lows", raised)
    return _first(near.unionByName(_candidates(rest, index, same_label, k, False, block, f"{name}-other-leaves")), k)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low_percent: int = 30,
    high_percent: int = 90,
    block: int = BLOCK,
    **index_options,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for the rows that ``anchors`` marks (a condition on
    ``id`` and ``label``) and each of their first positives, the first rows of other labels whose score is low_percent to high_percent of the positive's."""
    kept = scaled_vectors(rows, {"id": id_col, "label": label_col}, vector_col).filter("label IS NOT NULL")
    kept = kept.withColumn("anchor", F.coalesce(anchors & F.col("id").isNotNull(), F.lit(False)))
    kind = dict(kept.dtypes)["id"]
    index = build_index(kept, **index_options)
    if index is None:
        names = f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint"
        return rows.sparkSession.createDataFrame([], names)
    table = anchor_table(index)
    whole = table.withColumns({"lows": F.array(F.lit(LEAST)), "highs": F.array(F.lit(-LEAST))})
    found = materialize(_two_waves(whole, index, True, positives, block, "positives"), "positives")

    usable = found.filter("score >= 0").select("anchor", F.col("rank").alias("of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = usable.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("of", "positive_score"))).alias("each"))
    least, greatest = F.expr(f"transform(each, x -> (x.positive_score * {low_percent} + 99) div 100)"), F.expr(f"transform(each, x -> (x.positive_score * {high_percent}) div 100)")
    requests = table.join(windows, "anchor").withColumns({"lows": least, "highs": greatest})
    chosen = _two_waves(requests, index, False, negatives, block, "negatives")
    named = chosen.select("anchor", (F.col("window") + 1).alias("of"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = named.join(usable, ["anchor", "of"]).join(table.select("anchor", "anchor_id"), "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def negatives_report(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", **options) -> DataFrame:
    """The report of the contract: the label of every seventh id moves on by one, and ids divisible by 100 are the anchors."""
    vec_id, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    source = rows.select(vec_id.alias("vec_id"), F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col(f"`{vector_col}`").alias("embedding"))
    return hard_negatives(source, F.col("id") % 100 == 0, **options)
