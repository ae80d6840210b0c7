"""Near duplicates: sketches, alignment against plain edit distance, classes against brute force."""

import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbflow.llm import near_dedup as nd
from ebbflow.llm.components import connected_components
from ebbflow.llm.queries import op2_near_dedup


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("bit_words", [nd.BIT_WORDS, 100])
def test_long_texts_with_few_and_with_many_edits(monkeypatch, bit_words):
    """Bands that widen, and rows where a band has too many cells, agree with one wide band of rows."""
    monkeypatch.setattr(nd, "BIT_WORDS", bit_words)
    rng = random.Random(13)
    base = [f"w{rng.randrange(4000)}" for _ in range(6000)]
    for made in (3, 80, 700, 1190, 1300):
        other = list(base)
        for k in range(made):
            place = rng.randrange(len(other))
            if k % 3 == 0:
                other[place] = base[rng.randrange(6000)]
            elif k % 3 == 1:
                other.insert(place, "the")
            else:
                del other[place]
        a, b = nd.word_hashes(base), nd.word_hashes(other)
        most = nd.allowed_edits(len(a), len(b), 0.8)
        assert nd.hashed_edits(a, b, most) == nd._banded_rows(a, b, most)


words = st.lists(st.sampled_from("abcd"), max_size=14)


@given(words, words, st.integers(0, 8))
@settings(max_examples=400, deadline=None, derandomize=True)
def test_alignment_is_the_banded_edit_distance(a, b, most):
    want = edits(a, b)
    assert nd.alignment_edits(a, b, most) == (want if want <= most else None)
    x, y = nd.word_hashes(a), nd.word_hashes(b)
    assert nd.hashed_edits(x, y, most) == nd._banded_rows(x, y, most) == (want if want <= most else None)
    if a and b:
        assert nd._furthest_reaching(x, y, most) == nd._bit_rows(x, y, most) == (want if want <= most else None)


@given(words.filter(bool), words.filter(bool))
@settings(max_examples=200, deadline=None, derandomize=True)
def test_bounds_never_reject_a_link(a, b):
    h, g = (nd.histogram(nd.word_hashes(x)) for x in (a, b))
    ok = nd._within_bounds(np.array([len(a)]), np.array([len(b)]), h[None], g[None], 0.8)[0, 0]
    assert ok or edits(a, b) > nd.allowed_edits(len(a), len(b), 0.8)
    # longer texts, with finer and with different numbers of bins
    x, y = (nd.word_hashes(t * 60 + [str(k) for k in range(300)]) for t in (a, b))
    bound = nd.least_edits(nd.histogram(x).tobytes(), nd.histogram(y).tobytes())
    assert bound <= nd._banded_rows(x, y, max(len(x), len(y)))


def test_sketch_keeps_order_and_occurrences():
    a = nd.word_hashes([f"w{i}" for i in range(200)])
    moved = np.concatenate([a[100:], a[:100]])
    same = lambda x, y: (nd.order_minhash(nd.kmers(x, 5), 48, 3) == nd.order_minhash(nd.kmers(y, 5), 48, 3)).mean()
    assert same(a, a) == 1
    assert same(a, moved) < 0.6  # nearly the same set of windows, another order
    assert len(set(nd.kmers(np.repeat(a[:1], 40), 5).tolist())) == 36  # equal windows differ by their occurrence


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["id"]: r["label"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in pairs if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_classes(rows):
    """Components over all pairs with an edit similarity of 0.8 or more; wordless rows alone."""
    texts = [(i, nd.words_of(t)) for i, t in rows]
    label = list(range(len(texts)))
    for x in range(len(texts)):
        for y in range(x):
            a, b = texts[x][1], texts[y][1]
            if not a or not b or label[x] == label[y]:
                continue
            most = nd.allowed_edits(len(a), len(b), 0.8)
            if abs(len(a) - len(b)) <= most and nd.alignment_edits(a, b, most) is not None:
                old, new = label[x], label[y]
                label = [new if v == old else v for v in label]
    first = {}
    for (i, _), v in zip(texts, label, strict=True):
        first[v] = min(first.get(v, i), i)
    return {i: first[v] for (i, _), v in zip(texts, label, strict=True)}


def test_query_finds_the_classes_of_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in op2_near_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert got == brute_classes(rows)


def planted(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def test_groups_of_copies_and_shared_passages(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    base, passage = planted(rng, 120), planted(rng, 60)
    for i in range(60):  # near copies with two edits each
        text = list(base)
        for _ in range(2):
            text[rng.randrange(len(text))] = f"new{rng.random()}"
        rows.append((i, " ".join(text)))
        expected[i] = 0
    for i in range(100, 160):  # different texts that share a passage
        rows.append((i, " ".join(planted(rng, 60) + passage + planted(rng, 10))))
        expected[i] = i
    for i in range(200, 300):  # exact copies, other white space and case
        rows.append((i, "  ".join(passage + planted(random.Random(1), 90)).upper()))
        expected[i] = 200
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, class_id string")
    got = nd.class_report(frame, chunk=16)
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == expected
    assert got.filter("representative").count() == len(set(expected.values()))
    kept = nd.one_of_each(frame, chunk=16)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected.values()))


def test_edge_rows(spark):
    long = " ".join(planted(random.Random(9), 30_000))
    rows = [(1, None), (2, ""), (2, ""), (None, "lonely words here"), (3, "a b c"), (3, "a b c"), (4, "a b c"), (None, "a  B c"), (5, long), (6, long + " end"), (7, "x"), (7, "other text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0) for r in nd.class_report(frame).collect())
    assert got == sorted([(1, 1), (2, 2), (2, 2), (0, 0), (3, 3), (3, 3), (4, 3), (0, 3), (5, 5), (6, 5), (7, 7), (7, 7)])
    kept = sorted((r["doc_id"] or 0, (r["text"] or "")[:12]) for r in nd.one_of_each(frame).collect())
    assert kept == sorted([(1, ""), (2, ""), (2, ""), (0, "lonely words"), (3, "a b c"), (5, long[:12]), (7, "x"), (7, "other text")])
    assert nd.class_report(frame.limit(0)).count() == 0 and nd.one_of_each(frame.limit(0)).count() == 0


def test_links_near_the_limit_are_found(spark):
    """All links at 0.80 to 0.85, of short texts and of texts without a common five-word window, against all pairs."""
    rng = random.Random(11)
    rows = []

    def pair(n, places, extra=0):
        a = planted(rng, n)
        b = [f"new{rng.random()}" if i in places else w for i, w in enumerate(a)] + planted(rng, extra)
        rows.extend([(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))])

    for _ in range(40):
        pair(200, set(range(4, 200, 5)))  # every fifth word replaced
        pair(100, set(rng.sample(range(100), 20)))
        pair(200, set(rng.sample(range(200), 34)))
        for n, edits_made in ((10, 1), (12, 2), (15, 3), (33, 6), (40, 8)):
            pair(n, set(rng.sample(range(n), edits_made)))
        pair(5, (), 1)
        pair(6, (), 1)
    want = brute_classes(rows)
    assert len(set(want.values())) == len(rows) // 2
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in nd.class_report(frame).collect()} == want


def test_sketches_alone_find_links_near_the_limit():
    """Of pairs of more than ``SHORT`` words with replaced words, the share with a common bucket."""
    rng = random.Random(7)

    def share(n, similarity, pairs=150):
        met = 0
        for _ in range(pairs):
            a = planted(rng, n)
            places = set(rng.sample(range(n), int((1 - similarity) * n + 1e-9)))
            b = [f"new{rng.random()}" if i in places else w for i, w in enumerate(a)]
            met += bool((nd.sketch_buckets(nd.word_hashes(a)) == nd.sketch_buckets(nd.word_hashes(b))).any())
        return met / pairs

    assert all(share(n, s) >= 0.99 for n in (33, 60, 200) for s in (0.80, 0.85, 0.90))


def test_texts_that_share_half_of_their_identity_stay_apart(spark, monkeypatch):
    """Two texts whose ids would be equal are two texts."""
    whole = nd._identity
    monkeypatch.setattr(nd, "_identity", lambda words: (whole(words)[0] % 3, whole(words)[1]))
    texts = [" ".join(planted(random.Random(i), 40)) for i in range(12)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:4])], "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in nd.class_report(frame).collect()}
    assert got == {i: i % 12 for i in range(16)}


def test_pairs_of_one_head_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(nd, "HEAD_ROWS", 7)
    base = planted(random.Random(4), 80)
    rows = [(i, " ".join([*base, f"own{i}"])) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in nd.class_report(frame).collect()} == {0}


def test_query_finds_the_classes_of_short_texts_too(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(1_000_000 + i, " ".join(nd.words_of(t)[: 2 + i % 30])) for i, t in rows if i % 2]  # short heads of texts
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in nd.class_report(frame).collect()} == brute_classes(rows)


def test_table_of_word_hashes_stays_small():
    nd._WORD_HASHES.clear()
    for at in range(0, 300_000, 1000):
        words = [f"n{i}" for i in range(at, at + 1000)]
        assert nd.word_hashes(words).tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
        assert len(nd._WORD_HASHES) <= nd.HASHED_WORDS + 1000 <= 201_000
