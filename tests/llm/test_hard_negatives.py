"""Hard negatives against brute force, the tree's ranges, hot vectors, edge rows."""

import math
import random
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbflow.llm import hard_negatives as hn
from ebbflow.llm.common import conf
from ebbflow.llm.queries import op12_hard_negatives
from ebbflow.llm.vector_codes import scaled_vectors

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, anchor=lambda i: i % 100 == 0, positives=5, negatives=10):
    """The result rows for (id, vector, label), all pairs scored."""
    kept = []
    for i, v, label in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            moved = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            kept.append((i, [math.floor(256 * float(x)) for x in v], moved))
    if not kept:
        return []
    d = len(min(kept, key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))[1])
    kept = [r for r in kept if len(r[1]) == d]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for k, (i, v, label) in enumerate(kept):
        if i is None or not anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, x, strict=True)), j, other) for m, (j, x, other) in enumerate(kept) if m != k]
        for ps, p, _ in sorted((s for s in scored if s[2] == label), key=order)[:positives]:
            inside = [s for s in scored if s[2] != label and 30 * ps <= 100 * s[0] <= 90 * ps]
            out += [(i, p, r, j, ps, ns) for r, (ns, j, _) in enumerate(sorted(inside, key=order)[:negatives], 1)]
    return out


def result(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=str)


def test_query_against_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    expected = sorted(brute(rows), key=str)
    assert result(op12_hard_negatives(spark, "/root/testdata/sf0.001")) == expected and len(expected) > 200


def clustered(n, d=6, seed=4):
    """Clusters of rows, so that whole subtrees lie outside an annulus."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, d))
    return [(i, (centres[i % 9] + 0.05 * rng.normal(size=d)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


def test_small_leaves_chunks_and_blocks(spark):
    rows = clustered(600)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = hn.negatives_report(frame, leaf_rows=16, fanout=4, chunk=8, block=2)
    assert result(got) == sorted(brute(rows), key=str)


def test_elimination_never_loses_a_row_and_does_eliminate(spark):
    rows = clustered(900)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    kept = scaled_vectors(frame, {"id": "vec_id", "label": "label"}, "embedding").withColumn("anchor", F.lit(False))
    index = hn.build_index(kept, leaf_rows=30, fanout=4)
    values = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows])
    leaf = index.tree.route(index.tree.lift(values))
    queries = values[:40].astype(float)
    scores = queries @ values.T
    low, high = np.sort(scores, axis=1)[:, [-30]], np.sort(scores, axis=1)[:, [-10]]
    met = index.tree.visits(queries, low, high)
    for q in range(40):
        inside = (scores[q] >= low[q]) & (scores[q] <= high[q])
        assert met[q, leaf[inside]].all()
    assert met.mean() < 0.6 and len(index.tree.paths) > 15


def test_a_vector_with_a_third_of_all_rows(spark):
    rows = clustered(400)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    assert result(hn.negatives_report(frame, leaf_rows=20, chunk=16)) == sorted(brute(rows), key=str)


def test_edge_rows(spark):
    rng = random.Random(1)
    vector = lambda: [rng.choice([-0.5, 0.25, 0.5, 1.0]) for _ in range(4)]  # noqa: E731 many equal scores
    rows = [(i, vector(), i % 3) for i in range(0, 400, 5)]
    rows += [(900 + i, v, 1) for i, v in enumerate([None, [], [None] * 4, [math.nan] * 4, [math.inf, 0.0, 0.0, 0.0], [1.0, 1.0]])]
    rows += [(100, vector(), 2), rows[0], rows[20], rows[20], (None, vector(), 1), (None, vector(), 2), (500, vector(), None), (-100, vector(), 0), (600, [0.0] * 4, 1)]
    frame = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<double>, label int, anchor int, id string")
    assert result(hn.negatives_report(frame)) == sorted(brute(rows), key=str)
    assert result(hn.negatives_report(frame, leaf_rows=8, fanout=3, chunk=4)) == sorted(brute(rows), key=str)
    assert hn.negatives_report(frame.limit(0)).count() == 0
    assert hn.negatives_report(frame.filter("label = 1 AND vec_id % 7 > 0")).count() == 0  # no row of another label
    with pytest.raises(Exception, match="component|too long"):
        hn.negatives_report(spark.createDataFrame([(1, [1e30, 1.0], 1)], "vec_id long, embedding array<double>, label int")).collect()


@contextmanager
def results_of_at_most(spark, size):
    """Within it, a job whose tasks send more than ``size`` to the driver fails."""
    settings, key = spark.sparkContext._jsc.sc().conf(), "spark.driver.maxResultSize"
    before = settings.get(key, "1g")
    settings.set(key, size)
    try:
        yield
    finally:
        settings.set(key, before)


def directions(n, d, step=1):
    values = np.random.default_rng(5).normal(size=(n, d))
    return [(i * step, v.tolist(), i % 4) for i, v in enumerate(values / np.linalg.norm(values, axis=1, keepdims=True))]


def test_the_sample_does_not_come_to_the_driver_from_every_task(spark):
    frame = spark.createDataFrame(directions(8000, 64), "vec_id long, embedding array<double>, label int").repartition(40)
    kept = scaled_vectors(frame, {"id": "vec_id", "label": "label"}, "embedding").withColumn("anchor", F.lit(False))
    with results_of_at_most(spark, "2m"):
        index = hn.build_index(kept, leaf_rows=100, sample=256)
    assert len(index.tree.paths) > 50
    least = kept.select("vector", F.rand(7).alias("k")).orderBy("k").limit(256).collect()
    for n in (8000, 100 * 8000, 1):  # as many rows as said, a hundredth of them, more
        assert hn._sampled(kept, n, 256).tolist() == [r["vector"] for r in least]
    assert len(hn._sampled(kept.filter("id < 90"), 8000, 256)) == 90


def test_visits_are_not_broadcast(spark):
    """The vectors are too large to be broadcast, the requests are not."""
    rows = directions(3000, 64, step=10)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    with results_of_at_most(spark, "1m"), conf(spark, spark__sql__autoBroadcastJoinThreshold="200k"):
        got = result(hn.negatives_report(frame, leaf_rows=15, fanout=4, sample=256))
    assert got == sorted(brute(rows), key=str) and len(got) > 5000
