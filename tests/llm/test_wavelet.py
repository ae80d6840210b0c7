"""Token shards: exact encoding, wavelet matrix against plain lists, read-back report."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbflow.llm import wavelet
from ebbflow.llm.queries import op7_token_shards, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")
SMOKE = "/root/testdata/sf0.001"


def plain_tokenizer(special_as_text=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = special_as_text
    return t


@given(st.lists(st.integers(0, 70000), max_size=300))
@settings(max_examples=40, deadline=None, derandomize=True)
def test_matrix_answers_like_a_list(ids):
    m = wavelet.WaveletMatrix.build(np.array(ids, "<u4"))
    assert m.tokens().tolist() == ids
    assert [m.access(i) for i in range(len(ids))] == ids
    for token in {*ids, 5, 1 << 20}:
        places = [i for i, x in enumerate(ids) if x == token]
        assert m.count(token) == len(places) and m.occurrences(token) == places
        assert m.count(token, len(ids) // 2) == sum(x == token for x in ids[: len(ids) // 2])


def test_added_tokens_are_the_librarys():
    texts = ["<|endoftext|> x", "a<|endoftext|>", "<|endoftext|><|endoftext|>", "a <|endoftext |>", " <|endoftext|>\n\n"]
    got = [np.frombuffer(b, "<u4").tolist() for b in wavelet.Encoder.of(PATH).encode(texts)]
    assert got == [e.ids for e in plain_tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert got[0] == [50256, 2124]
    assert np.frombuffer(wavelet.Encoder.of(PATH, True).encode(texts[:1])[0], "<u4").tolist() == plain_tokenizer(True).encode(texts[0], add_special_tokens=False).ids


def test_rank_directory_over_several_blocks():
    ids = np.random.default_rng(1).integers(0, 7, 30000).astype("<u4")
    names, lengths, m = wavelet.from_bytes(wavelet.to_bytes([3, None], [10000, 20000], ids))
    assert names == [3, None] and lengths.tolist() == [10000, 20000]
    assert m.tokens().tolist() == ids.tolist()
    assert m.occurrences(4) == np.flatnonzero(ids == 4).tolist()
    with pytest.raises(IndexError):
        m.select(4, 10**6)


@given(st.lists(st.text(alphabet=" \n\t.,'éßł中a bcdsT09_- 　²x<|endoftext|>", max_size=40), max_size=5))
@settings(max_examples=150, deadline=None, derandomize=True)
def test_pieces_encode_like_whole_texts(texts):
    texts = texts + ["<|endoftext|> x".join(texts)]
    for special_as_text in (False, True):
        want = [e.ids for e in plain_tokenizer(special_as_text).encode_batch(texts, add_special_tokens=False)]
        got = [np.frombuffer(b, "<u4").tolist() for b in wavelet.Encoder.of(PATH, special_as_text).encode(texts)]
        assert got == want
    assert got == want


def test_words_of_many_texts_are_cut_once(monkeypatch):
    cut, pieces = [], wavelet._PIECES

    class Counting:
        def findall(self, text):
            cut.append(text)
            return pieces.findall(text)

    monkeypatch.setattr(wavelet, "_PIECES", Counting())
    texts = ["One fish, two fish. Red fish", "", "fish, red fish.\nBlue  fish "] + ["blue fish, red fish. One fish", " two fish"] * 200
    encoder = wavelet.Encoder(PATH)
    for _ in range(2):
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
        assert got == [e.ids for e in plain_tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert sum(map(len, cut)) < sum(map(len, texts)) / 10
    assert encoder.encode([]) == []


def test_a_word_meets_the_library_once_whatever_follows_it():
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.sent = tokenizer, 0

        def encode_batch_fast(self, texts, **options):
            self.sent += sum(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **options)

    words = [f"{a}{b}{c}" for a in ("fis", "été", "Stra") for b in "abcdeé" for c in ("ß", "ing", "ö")]
    texts = [" ".join(["x", *(w + mark for w in words)]) for mark in ("", ".", ",", "!!", "***", "'s", ";\u2003", "\n", "\n\n", ":\n")]
    want = [e.ids for e in plain_tokenizer().encode_batch(texts, add_special_tokens=False)]
    encoder = wavelet.Encoder(PATH)
    encoder.tokenizer = counting = Counting(encoder.tokenizer)
    for piece in (texts[:4], texts, texts[::-1]):
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(piece)]
        assert got == [want[texts.index(t)] for t in piece]
    assert counting.sent < 2 * len(texts[0])


def expected(rows):
    t, out, start = plain_tokenizer(), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_report_matches_plain_encoding(spark):
    got = op7_token_shards(spark, SMOKE).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    rows = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    assert [tuple(r) for r in got] == expected([tuple(r) for r in rows])


def test_nulls_ties_long_texts_and_small_shards(spark):
    rows = [(2, "b b"), (1, None), (None, "x"), (2, "a"), (2, "a"), (5, ""), (4, "word " * 30000), (3, "<|endoftext|> 's don't")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, part string")
    got = wavelet.token_shards(docs, PATH, shard_tokens=50).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in got] == expected(rows)
    assert wavelet.token_shards(docs.limit(0), PATH).count() == 0
