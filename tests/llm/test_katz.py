"""Katz backoff against a plain dictionary model; distributions that sum to one; held-out gain."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from ebbflow.llm import katz
from ebbflow.llm.queries import op9_katz


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered(text)), "</s>"]


def is_held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class Plain:
    """The model of the module text, in dictionaries."""

    def __init__(self, rows):
        train = [tokens(t) for i, t in rows if not is_held(i)]
        self.uni = Counter(w for doc in train for w in doc)
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        self.bi = Counter(p for doc in train for p in zip(["<s>", *doc], doc, strict=False))
        self.after = {}
        for (h, w), c in self.bi.items():
            self.after.setdefault(h, {})[w] = c
        of = lambda c: [0, *(sum(1 for x in c.values() if x == r) for r in range(1, 7))]
        self.d1, self.d2 = katz.discounts(of(self.uni)), katz.discounts(of(self.bi))
        self.left = 1 - sum(self.dis(c, self.d1) for c in self.uni.values()) / self.n if self.n else 1
        self.alpha = {}
        for h, seen in self.after.items():
            total = sum(seen.values())
            left = total - sum(self.dis(c, self.d2) for c in seen.values())
            if left <= 1e-9:
                total, left = total + 1, 1
            self.alpha[h] = (total, left / total / (1 - sum(self.p1(w) for w in seen)))

    @staticmethod
    def dis(c, d):
        return c * (d[c] if c < len(d) else 1.0)

    def p1(self, w):
        if not self.n:
            return 1.0
        if self.left <= 1e-12:
            return (self.uni.get(w, 0) + 1) / (self.n + self.v + 1)
        return self.dis(self.uni[w], self.d1) / self.n if w in self.uni else self.left

    def p(self, h, w):
        if h not in self.after:
            return self.p1(w)
        total, alpha = self.alpha[h]
        return self.dis(self.bi[h, w], self.d2) / total if (h, w) in self.bi else alpha * self.p1(w)

    def row(self, doc_id, text):
        t = tokens(text)
        base = sum(math.log10((self.uni.get(w, 0) + 1) / (self.n + self.v + 1)) for w in t)
        score = sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *t], t, strict=False))
        return (doc_id, is_held(doc_id), len(t), sum(w in self.uni for w in t), self.n, base, score)


def check(got, rows, model):
    got = sorted((tuple(r) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    want = sorted((model.row(*r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 30_000, "word_bucket_bytes": 40_000, "event_bucket": 9_000, "hot_tokens": 500}])
def test_scores_match_the_plain_model(spark, options):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(katz.lm_scores(docs, **options).collect(), rows, Plain(rows))


def test_distributions_sum_to_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = Plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    words = [*model.uni, "never seen"]
    assert abs(sum(map(model.p1, words)) - 1) < 1e-9
    for h in ["<s>", *list(model.after)[:20], "never seen"]:
        assert abs(sum(model.p(h, w) for w in words) - 1) < 1e-9


def test_bigrams_help_on_held_out_texts(spark):
    rows = [r for r in op9_katz(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert len(rows) > 50
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "A a É é"), (3, "A a É é"), (None, "x y"), (8, "b " * 20_000), (9, "one two three"), (10, "\t\n")]
    frame = spark.createDataFrame([(*r, True, 1.0) for r in rows], "doc_id long, text string, held boolean, base double")
    check(katz.lm_scores(frame).collect(), rows, Plain(rows))
    held = [i for i in range(1, 60) if is_held(i)][:2]
    only = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    check(katz.lm_scores(only).collect(), [(i, "a b") for i in held], Plain([(i, "a b") for i in held]))
    assert katz.lm_scores(frame.limit(0)).count() == 0


def test_discounts_fall_back():
    assert katz.discounts([0, 10, 5, 3, 2, 1, 1]).tolist()[1:] != []
    assert katz.discounts([0, 0, 5, 3, 2, 1, 1]).tolist() == [1.0]
    assert katz.discounts([0] * 7).tolist() == [1.0]


def test_a_hot_bigram_is_sent_once_per_block_and_document():
    block = katz._Block()
    for doc_id in range(20):
        block.add(doc_id, "b " * 5_000)
    *words, docs = block.rows(0, 1)
    level = katz.Unigrams(100_000, 2, 17, np.ones(1), 0.0)
    *events, _ = katz.block_events(docs, np.array([2], np.uint64), np.array([85_000]), level, np.array([2], np.uint64), 1)
    held = sum(map(is_held, range(20)))
    assert max(len(katz.open_numbers(e[c])) for e in events for c in katz._EVENT_COLUMNS) <= 3 * 20  # three bigrams, 20 documents
    assert sum(katz.open_numbers(e["pair_n"]).sum() for e in events) == (20 - held) * 5_001
    assert sum(katz.open_numbers(e["times"]).sum() for e in events) == 20 * 5_001


def test_heavy_buckets_are_scored_in_parts(spark):
    rows = [(i, f"x y w{i % 50} x y") for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check(katz.lm_scores(frame, block_bytes=700, event_bucket=100, hot_tokens=300).collect(), rows, Plain(rows))


def test_events_of_a_block_take_little_memory():
    """Per token a place and numbers in bucket order, not every column of all tokens at once."""
    block, words = katz._Block(), np.random.default_rng(3).integers(0, 5000, (200, 10_000))
    for i, row in enumerate(words):
        block.add(i, " ".join(map(str, row)))
    row = list(block.rows(0, 1))[-1]
    ids, counts = np.arange(5000, dtype=np.uint64) + katz.FIRST_WORD, np.full(5000, 400)
    level = katz.Unigrams(2_000_200, 5001, 200, np.ones(1), 0.01)
    tracemalloc.start()
    tokens = sum(e.get("n_rows", 0) for e in katz.block_events(row, ids, counts, level, np.array([katz.FIRST_WORD], np.uint64), 64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 1_900_000 < tokens <= 2_000_200 and peak < 45 * 2_000_200
