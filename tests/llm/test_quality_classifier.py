"""Quality classifier: held-out accuracy, the optimum of the dual, plain counts, edge rows."""

import math
import random
import zlib

import numpy as np
import pytest

from ebbflow.llm import quality_classifier as qc
from ebbflow.llm.queries import op11_quality_classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in op11_quality_classifier(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(got) == docs
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for i, r in got.items())
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    apart = [(got[i]["score"], q, got[i]["predicted"]) for i, q in truth.items() if got[i]["held_out"]]
    bad, good = [s for s, q, _ in apart if q == 0], [s for s, q, _ in apart if q == 1]
    assert len(bad) >= 8 and np.mean([a < b for a in bad for b in good]) > 0.97
    assert np.mean([q == p for _, q, p in apart]) > 0.93


def small_problem(n=60, seed=1):
    rng = np.random.default_rng(seed)
    rows = [np.unique(rng.integers(0, 64, 9)).astype(np.int32) for _ in range(n)]
    return rows, np.array([int((r < 20).sum() + rng.integers(0, 3) > 4) for r in rows])


def test_dual_coordinate_descent_reaches_the_optimum():
    """No gap between the primal and the dual value, and all duals in their box."""
    rows, labels = small_problem()
    ratios = qc.log_count_ratios(rows, labels, 6)
    weights, dual = qc.dual_coordinate_descent(rows, labels, ratios, passes=3000, tolerance=1e-9)
    signs = np.where(labels == 1, 1, -1)
    hinge = sum(max(0.0, 1 - s * qc.margin(r, ratios, weights)) for r, s in zip(rows, signs, strict=True))
    primal, own = weights @ weights / 2 + qc.COST * hinge, dual.sum() - weights @ weights / 2
    assert dual.min() >= 0 and dual.max() <= qc.COST and primal == pytest.approx(own, rel=1e-4)


def test_ratios_are_those_of_plain_counts():
    rows, labels = small_problem()
    got = qc.log_count_ratios(rows, labels, 6)
    for f in range(64):
        share = [(1 + sum(f in r for r, y in zip(rows, labels, strict=True) if y == c)) / (64 + sum(len(r) for r, y in zip(rows, labels, strict=True) if y == c)) for c in (0, 1)]
        assert got[f] == pytest.approx(math.log(share[1] / share[0]), abs=1e-5)


def test_features_do_not_depend_on_stretches(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "a", "Bb", "c,", "12", "|", "d!!"]) for _ in range(500))
    whole = qc.features(text)
    monkeypatch.setattr(qc, "STRETCH", 7)
    assert (qc.features(text) == whole).all()
    assert qc.shape("WORD!!") == "A!" and qc.shape("Über12,") == "Aa0,"


def corpus(n=120):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 8)))
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, " ".join(word() + ("###" if bad else "") for _ in range(rng.randrange(5, 60)))))
        labels.append((i, 0 if bad else 1))
    return rows, labels


def test_edge_rows(spark):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "x### " * 300_000), (None, rows[0][1]), rows[3], rows[3]]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows + extra], "doc_id long, text string, quality int, score string")
    tags = spark.createDataFrame([(i, q, 0, "t") for i, q in [*labels, (None, 1), (5, None), (6, 7), labels[1], (9999, 1)]], "doc_id long, quality int, toxic int, text string")
    got = qc.quality_scores(docs, tags).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows + extra)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["predicted"] == q for i, q in labels) and by_id[1003]["predicted"] == 0
    assert by_id[1000]["score"] == by_id[1001]["score"] == by_id[1002]["score"] and not by_id[None]["held_out"]
    again = {r["doc_id"]: r["score"] for r in qc.quality_scores(docs.repartition(5), tags).collect()}
    assert again == {i: r["score"] for i, r in by_id.items()}
    assert qc.quality_scores(docs.limit(0), tags).count() == 0
    assert {r["score"] for r in qc.quality_scores(docs, tags.limit(0)).collect()} == {0.5}
    n = tags.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct().collect()
    n1 = sum(zlib.crc32(str(r[0]).encode()) % 5 != 0 for r in n)
    assert {r["score"] for r in qc.quality_scores(docs, tags.filter("quality = 1")).collect()} == {(n1 + 1) / (n1 + 2)}


def test_held_out_labels_are_never_read(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels]
    one, two = ({r["doc_id"]: r["score"] for r in qc.quality_scores(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()} for x in (labels, turned))
    assert one == two


def test_the_sample_is_bounded(spark):
    rows, labels = corpus()
    docs, tags = spark.createDataFrame(rows, "doc_id long, text string"), qc.training_labels(spark.createDataFrame(labels, "doc_id long, quality int"))
    small = qc.fit_classifier(docs, tags, fit_rows=5)
    assert small.weights is not None and qc.fit_classifier(docs, tags, fit_features=0).weights is None
