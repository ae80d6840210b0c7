"""Wu-Manber word search against a plain search, and edge rows."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ebbflow.llm import decontaminate as dc
from ebbflow.llm.queries import op10_decontamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items, window=10):
    """(words, hit words, ids of items with occurring windows)."""
    doc, hit, found = words(text), set(), set()
    for item, item_text in items:
        w = words(item_text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            p = w[i : i + window]
            for at in range(len(doc) - len(p) + 1):
                if doc[at : at + len(p)] == p:
                    hit.update(range(at, at + len(p)))
                    found.add(str(item))
    return len(doc), len(hit), found


letters = st.lists(st.sampled_from("abc"), max_size=60).map(" ".join)


@given(letters, st.lists(letters, max_size=4))
@settings(max_examples=150, deadline=None, derandomize=True)
def test_search_finds_every_occurrence(text, item_texts):
    items = [(str(i), t) for i, t in enumerate(item_texts)]
    windows = [(i, tuple(w.encode() for w in words(t)[k : k + 4])) for i, t in items for k in range(max(1, len(words(t)) - 3) if words(t) else 0)]
    ids = set()
    spans = dc.find(dc.searchers(windows), dc.words_of(text.encode()), [], ids)
    n, hit, found = brute_hits(text, items, 4)
    assert (sum(b - a for a, b in spans), ids) == (hit, found)
    assert len(dc.words_of(text.encode())) == n


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None, derandomize=True)
def test_words(text):
    assert [w.decode() for w in dc.words_of(text.encode())] == words(text)


def check(rows, docs, items):
    want = []
    for doc_id, text in docs:
        n, hit, found = brute_hits(text, items)
        want.append((doc_id, n, hit, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), hit > 0))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)


def test_edge_rows_and_blocks_of_patterns(spark):
    phrase = "One two, three four five six seven eight nine ten eleven Twelve."
    items = [(1, phrase), (10, phrase), (2, "tiny item"), (3, None), (4, ""), (5, "solo"), (2, "another text under the same id")]
    docs = [(1, None), (2, ""), (3, "x " + phrase.upper() + " y"), (4, "tiny item tiny item item tiny"), (4, "tiny item tiny item item tiny"), (None, "solo solo"), (6, ("pad " * 9 + "solo ") * 20_000), (7, phrase * 2)]
    frame = spark.createDataFrame([(*d, 1, "h") for d in docs], "doc_id long, text string, n_hit int, hits string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (200_000, 2):
        check(dc.contamination(frame, bench, block_windows=block).collect(), docs, items)
    kept = dc.decontaminate(frame, bench)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]
    assert dc.contamination(frame, bench.limit(0)).filter("contaminated").count() == 0
    assert dc.contamination(frame.limit(0), bench).count() == 0


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    few = [d for d in docs if len(d[1]) < 1500]
    got = {r["doc_id"]: r for r in op10_decontamination(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(docs)
    check([got[i] for i, _ in few], few, items)
