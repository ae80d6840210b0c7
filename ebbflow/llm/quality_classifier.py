"""Quality classifier: a linear support-vector model over n-gram indicators that naive Bayes has scaled.

**Indicators.** A text's words (white space separated) give two sequences: the lower-cased words, and their shapes, in which letters, digits and
runs of one character collapse, marked where a word repeats the one before. One- and two-word n-grams of the first and one- to
three-word n-grams of the second are hashed into ``2**BITS`` features; only their presence counts.

**Scaling.** Each feature has the log ratio of its smoothed document counts in the two classes, as shares of the class's total. A text is the vector of
the ratios of its features, at length one, and a constant.

**Model.** Hinge loss with a quadratic penalty, solved by dual coordinate descent: one dual variable per text, each set to its best value in turn within
its box while the weights follow, in a new seeded order each pass, until no variable moves more than ``TOLERANCE``. A logistic curve through the margins of a part
of the sample that a first fit did not see turns margins into scores; it is weighted to the class sizes among all training labels.

Scale: the model is fitted on a bounded sample of the labelled rows: per class the ``FIT_ROWS`` training ids with the least hashes, and of those, in that
order, as many as hold ``FIT_FEATURES`` features. The ids (at most 2 * ``FIT_ROWS`` numbers) are broadcast to the documents, so no text is shuffled;
the features of the sample meet in one task, bounded by these parameters whatever the input. Class sizes are counted over all labels. The weights (``2**BITS``
numbers) go to the tasks, and all documents are scored in one pass over whole texts. A lost task is repeated with the same result.

Defined results: labels are read from training rows only; of several labels of an id the lowest counts, labels other than 0 and 1 and null ids are ignored. Repeated ids among the documents are
one training row (the least by its features), and each row is scored. A null or empty text has no features; its score is that of the constant. Without training
rows of both classes every score is the smoothed share of class 1, (n1 + 1) / (n + 2), or 0.5 without labels. Null ids are scored and not held out. An empty table gives
no rows. Texts of any length are scored whole, in stretches of ``STRETCH`` words that overlap. Equal hashes are ordered by id. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import pieces

BITS = 18
FIT_ROWS, FIT_FEATURES = 8_000, 40_000_000
COST, PASSES, TOLERANCE = 1.0, 30, 1e-3
STRETCH, KNOWN_WORDS = 200_000, 300_000
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3

_UPPER, _LETTER, _DIGIT, _RUN = re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"[^\W\d_A]"), re.compile(r"\d"), re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """Upper-case letters as A, others as a, digits as 0, runs of one character as one."""
    return _RUN.sub(r"\1", _DIGIT.sub("0", _LETTER.sub("a", _UPPER.sub("A", word))))


class _Words(dict):
    """Numbers of the words seen, with the hashes of their lower-case form and of their shape."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes = np.zeros((2, KNOWN_WORDS + STRETCH), np.uint64)

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.hashes[0, at] = zlib.crc32(word.lower().encode("utf-8", "surrogatepass"))
        self.hashes[1, at] = zlib.crc32(shape(word).encode("utf-8", "surrogatepass"))
        return at

    def look_up(self, words: list[str]) -> np.ndarray:
        """Word hashes and shape hashes of at most ``STRETCH`` words."""
        if len(self) > KNOWN_WORDS:  # keeps the table bounded
            self.clear()
        return self.hashes[:, np.fromiter(map(self.__getitem__, words), np.int64, len(words))]


_WORDS = _Words()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(hashes: np.ndarray, n: int, kind: int) -> np.ndarray:
    """Hashes of all n-grams of a sequence."""
    out = np.full(max(len(hashes) - n + 1, 0), kind * 16 + n, np.uint64)
    for j in range(n):
        out = _mix(out + hashes[j : j + len(out)])
    return out


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """The sorted features of a whole text."""
    words = (text or "").split()
    found, longest = [], 3
    for start in range(0, len(words), STRETCH - longest):
        part = words[start and start - 1 : start + STRETCH - longest + 2]  # one word before, for its mark, and two after
        hashes, shapes = _WORDS.look_up(part)
        marked = shapes.copy()
        marked[1:] += (hashes[1:] == hashes[:-1]).astype(np.uint64) << np.uint64(40)
        if start:
            hashes, marked = hashes[1:], marked[1:]
        grams = [*(_grams(hashes, n, 1) for n in (1, 2)), *(_grams(marked, n, 2) for n in (1, 2, 3))]
        found.append(np.unique((np.concatenate(grams) >> np.uint64(64 - bits)).astype(np.int32)))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Per feature the log ratio of its share of the document counts of class 1 and class 0, each count smoothed by one."""
    counts = np.ones((2, 1 << bits))
    for row, label in zip(rows, labels, strict=True):
        counts[label, row] += 1
    return (np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())).astype(np.float32)


def _scaled(row: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    values = ratios[row]
    length = float(np.sqrt(values @ values))
    return values / np.float32(length) if length else values


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, cost: float = COST, passes: int = PASSES, tolerance: float = TOLERANCE
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (the constant's last) that minimise |w|²/2 + cost * sum(hinge), and the dual variables."""
    signs = np.where(labels == 1, 1.0, -1.0)
    weights, dual = np.zeros(len(ratios) + 1), np.zeros(len(rows))
    order = np.random.default_rng(11)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            values = _scaled(rows[i], ratios)
            square = float(values @ values) + 1.0
            slope = signs[i] * (float(values @ weights[rows[i]]) + weights[-1]) - 1.0
            step = min(max(dual[i] - slope / square, 0.0), cost) - dual[i]
            if step:
                dual[i] += step
                weights[rows[i]] += step * signs[i] * values
                weights[-1] += step * signs[i]
                moved = max(moved, abs(step))
        if moved < tolerance:
            break
    return weights, dual


def margin(row: np.ndarray, ratios: np.ndarray, weights: np.ndarray) -> float:
    return float(_scaled(row, ratios) @ weights[row]) + float(weights[-1])


def logistic_curve(margins: np.ndarray, labels: np.ndarray, sizes: tuple[float, float]) -> tuple[float, float]:
    """(slope, offset) of the curve through margins, each class weighted to its size; targets smoothed by one row of either class."""
    n = np.array([max((labels == c).sum(), 1) for c in (0, 1)])
    weight = (np.array(sizes) / n)[labels]
    target = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    x = np.stack([margins, np.ones(len(margins))])
    at = np.array([1.0, np.log(max(sizes[1], 1) / max(sizes[0], 1))])

    def loss(p: np.ndarray) -> float:
        z = p @ x
        return float((weight * (np.logaddexp(0, z) - target * z)).sum())

    for _ in range(100):
        share = 1 / (1 + np.exp(-np.clip(at @ x, -500, 500)))
        slope = x @ (weight * (share - target))
        curve = (x * (weight * share * (1 - share))) @ x.T + 1e-9 * np.eye(2)
        step, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


@dataclass
class Model:
    """``scales`` are the ratios, ``weights`` the model's (the constant's last), then the curve; ``share`` is the score without a model."""

    ratios: np.ndarray | None
    weights: np.ndarray | None
    slope: float
    offset: float
    share: float

    def score(self, row: np.ndarray) -> float:
        if self.weights is None:
            return self.share
        z = self.slope * margin(row, self.ratios, self.weights) + self.offset
        return float(1 / (1 + np.exp(-z))) if z > -700 else 0.0


def fit(rows: list[np.ndarray], labels: np.ndarray, sizes: tuple[float, float], bits: int = BITS) -> Model:
    """A model of the sample; ``sizes`` are the class sizes it stands for. Every fourth row of a class fits the curve only."""
    share = (sizes[1] + 1) / (sum(sizes) + 2)
    if min((labels == 0).sum(), (labels == 1).sum()) == 0:
        return Model(None, None, 0.0, 0.0, share)
    place = np.empty(len(labels), np.int64)
    for c in (0, 1):
        place[labels == c] = np.arange((labels == c).sum())
    seen = np.flatnonzero(place % 4 != 3)
    apart = np.flatnonzero(place % 4 == 3)
    ratios = log_count_ratios(rows, labels, bits)
    if len(apart) and len(set(labels[apart].tolist())) == 2:
        own = log_count_ratios([rows[i] for i in seen], labels[seen], bits)
        first, _ = dual_coordinate_descent([rows[i] for i in seen], labels[seen], own)
        margins = np.array([margin(rows[i], own, first) for i in apart])
        slope, offset = logistic_curve(margins, labels[apart], sizes)
    else:  # too few rows to hold any apart
        slope, offset = 1.0, 0.0
    weights, _ = dual_coordinate_descent(rows, labels, ratios)
    return Model(ratios, weights.astype(np.float32), slope, offset, share)


def training_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """doc_id, quality (0 or 1) of the training rows; one per id."""
    rows = labels.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("quality"))
    return rows.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def _feature_rows(docs: DataFrame, keep: dict[str, str]) -> DataFrame:
    """The columns ``keep`` and the packed features of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4_000_000):
            packed = [features(t).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(packed, pa.binary())], [*keep, "features"])

    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in keep.items()) + ", features binary")


def fit_classifier(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_features: int = FIT_FEATURES, bits: int = BITS) -> Model:
    """A model of ``docs`` (doc_id, text) and the training labels (doc_id, quality)."""
    known = {r["quality"]: r["count"] for r in labels.groupBy("quality").count().collect()}
    sizes = (float(known.get(0, 0)), float(known.get(1, 0)))
    hashed = labels.withColumn("hash", F.xxhash64("doc_id"))
    per_class = [hashed.filter(F.col("quality") == c).orderBy("hash", "doc_id").limit(fit_rows) for c in (0, 1)]
    place = F.row_number().over(Window.partitionBy("quality").orderBy("hash", "doc_id"))  # of at most fit_rows rows
    sample = per_class[0].unionByName(per_class[1]).select("doc_id", "quality", place.alias("place"))
    chosen = docs.join(F.broadcast(sample), "doc_id")  # at most 2 * fit_rows ids
    rows = _feature_rows(chosen, {"quality": "int", "place": "int"}).groupBy("quality", "place").agg(F.min("features").alias("features"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, classes, total = [], [], 0
        for batch in batches:
            for quality, packed in zip(batch.column("quality").to_pylist(), batch.column("features").to_pylist(), strict=True):
                if total <= fit_features:
                    held.append(np.frombuffer(packed, "<i4"))
                    classes.append(quality)
                    total += len(held[-1])
        model = fit(held, np.array(classes, np.int64), sizes, bits)
        numbers = [np.asarray(x if x is not None else [], "<f4").tobytes() for x in (model.ratios, model.weights)]
        yield pa.RecordBatch.from_pydict({"ratios": [numbers[0]], "weights": [numbers[1]], "slope": [model.slope], "offset": [model.offset], "share": [model.share]})

    one = rows.repartition(1).sortWithinPartitions("place", "quality").mapInArrow(run, "ratios binary, weights binary, slope double, offset double, share double").first()
    ratios, weights = (np.frombuffer(one[c], "<f4") if one[c] else None for c in ("ratios", "weights"))
    return Model(ratios, weights, one["slope"], one["offset"], one["share"])


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4_000_000):
            scores = [model.score(features(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD, **options) -> DataFrame:
    """The report of the contract: doc_id, held_out, score, predicted of every row of ``docs``."""
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    model = fit_classifier(source, training_labels(labels, id_col, label_col), **options)
    return score_texts(source, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
