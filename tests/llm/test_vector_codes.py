"""Vector codes against a plain version: exact search, rounds, edge rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from ebbflow.llm import vector_codes as vc
from ebbflow.llm.queries import op13_vector_codes


def plain(rows, parts=vc.PARTS, entries=vc.ENTRIES, rounds=vc.ROUNDS):
    """(id, code, error, label_error, digest) of rows (id, vector, label), each step by its definition."""
    kept = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    d = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == d]
    w = d // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(members[k]) for c in zip(*members[k], strict=True)] if k in members else e for k, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, label, [nearest(cut(v, p), books[p]) for p in range(parts)]) for i, v, label in kept]
    sums = {}
    for _, label, f in found:
        sums[label] = sums.get(label, 0) + sum(e for e, _ in f)
    return [(i, "".join(f"{k:02x}" for _, k in f), sum(e for e, _ in f), sums[label], digest) for i, label, f in found]


COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def test_query_against_plain_version(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in op13_vector_codes(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(plain(rows))


def test_search_is_exact_with_ties():
    rng = np.random.default_rng(5)
    for width in (1, 3, 4):
        book = rng.integers(-4, 5, (40, width))
        book[20:30] = book[5]  # equal entries: the lowest index
        parts = rng.integers(-6, 7, (500, width))
        index, best = vc.nearest_entries(parts, book)
        distance = ((parts[:, None, :] - book[None]) ** 2).sum(2)
        assert (index == distance.argmin(1)).all() and (best == distance.min(1)).all()


def test_edge_rows(spark):
    rng = random.Random(3)
    vector = lambda: [rng.uniform(-1, 1) for _ in range(8)]
    rows = [(i, vector(), i % 3 if i % 4 else None) for i in range(40)]
    rows += [(100 + i, v, 1) for i, v in enumerate([None, [], [None] * 8, [float("nan")] * 8, [math.inf] + [0.0] * 7, vector()[:4]])]
    rows += [(None, vector(), None), (None, vector(), 2), rows[3], rows[3], (-5, vector(), 0), (-5, vector(), 0)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, id int, vector string")
    for entries in (1, 7, 64):
        got = [tuple(r[c] for c in COLUMNS) for r in vc.code_report(frame, parts=4, entries=entries).collect()]
        assert sorted(got, key=str) == sorted(plain(rows, 4, entries), key=str)
    assert vc.code_report(frame.limit(0), parts=4).count() == 0
    assert vc.code_report(frame.filter("vec_id >= 100 AND vec_id < 105"), parts=4).count() == 0
    with pytest.raises(ValueError):
        vc.code_report(frame, parts=3)


def test_codes_decode_to_their_entries(spark):
    rows = [(i, [((i * 7 + k * 3) % 11) / 11 for k in range(16)], 0) for i in range(50)]
    vectors = vc.scaled_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), {"id": "vec_id", "label": "label"}, "embedding")
    books = vc.train_codebooks(vectors, 4, 16, 2)
    for row in vc.encode(vectors, books, {"id": "bigint"}).join(vectors, "id").collect():
        assert ((vc.decode(row["code"], books) - np.array(row["vector"])) ** 2).sum() == row["error"]


def test_a_vector_with_most_rows(spark):
    """Copies of one vector are summed within tasks; the result is that of the plain version."""
    rows = [(i, [0.5, -0.25, 0.125, 1.0] if i % 3 else [i / 300, 0.0, -i / 200, 0.25], i % 2) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(7)
    got = [tuple(r[c] for c in COLUMNS) for r in vc.code_report(frame, parts=2, entries=8).collect()]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    assert sorted(got) == sorted(plain(rows, 2, 8))
