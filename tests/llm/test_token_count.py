"""Token counts against the tokenizers library's Unigram model on whole texts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbflow.llm import token_count as tc
from ebbflow.llm.queries import op4_token_count, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    vocabulary, unknown = tc.read_vocabulary(MODEL)
    return Tokenizer(Unigram(vocabulary, unknown, True))


def library_count(library, text):
    return len(library.encode(tc.normalise(text), add_special_tokens=False).ids)


@given(st.text(alphabet="abcthe nd  ▁<unk>0xA梦é\n\U0001f600ሴ", max_size=40))
@settings(max_examples=300, deadline=None, derandomize=True)
def test_counts_match_the_library(library, text):
    assert tc.counter(MODEL).count(text)[1] == library_count(library, text)


@given(
    st.dictionaries(st.text(alphabet="ab▁c", min_size=1, max_size=4), st.integers(-6, -1), min_size=1, max_size=12),
    st.lists(st.text(alphabet="abcd ▁", max_size=25), max_size=6),
)
@settings(max_examples=200, deadline=None, derandomize=True)
def test_ties_with_small_vocabularies(pieces, texts):
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    vocabulary = [("<unk>", 0.0), *((p, float(s) / 2) for p, s in pieces.items())]
    library, own = Tokenizer(Unigram(vocabulary, 0, False)), tc.Counter(vocabulary, 0, False)
    for text in texts:
        assert own.count(text)[1] == library_count(library, text)


def brute_force(text, vocabulary, lowest):
    """Best score over all segmentations, by recursion."""
    scores, memo = dict(vocabulary), {0: 0.0}
    for end in range(1, len(text) + 1):
        found = [memo[s] + scores[text[s:end]] for s in range(end) if text[s:end] in scores]
        if text[end - 1] not in scores:
            found.append(memo[end - 1] + lowest)
        memo[end] = max(found)
    return memo[len(text)]


def test_query_matches_the_library(spark, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    vocabulary, _ = tc.read_vocabulary(MODEL)
    lowest = min(s for _, s in vocabulary) - 10
    rows = op4_token_count(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["n_tokens"] == library_count(library, text) and r["n_chars"] == len(text)
        if len(text) < 2000:
            assert r["score"] == brute_force(tc.normalise(text), vocabulary, lowest)


def test_edge_rows(spark, library):
    texts = [None, "", " ", "a" * 50_000, "word " * 40_000, "x", "x", "<s>é</s>"]
    frame = spark.createDataFrame([(i, t, 0, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, score string")
    got = {r["doc_id"]: r["n_tokens"] for r in tc.count_tokens(frame, MODEL).collect()}
    assert got == {i: library_count(library, t or "") for i, t in enumerate(texts)}
    assert tc.count_tokens(frame.limit(0), MODEL).count() == 0
