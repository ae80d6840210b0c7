"""Encoding against a plain Viterbi and the tokenizers library; decoding as a round trip."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ebbflow.llm import sentencepiece_lattice as sp
from ebbflow.llm.packing import pack_numbers
from ebbflow.llm.queries import op6_sentencepiece, tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")


def plain(text, model):
    """Viterbi over the whole text, ties to the earliest start."""
    text, scores = sp.normalise(text), {n: s for n, _, s in model.matching}
    best, back = [0.0], [0]
    for end in range(1, len(text) + 1):
        found = None
        for start in range(max(0, end - model.longest), end):
            gain = scores.get(text[start:end])
            if gain is not None and (found is None or best[start] + gain > found[0]):
                found = (best[start] + gain, end - start)
        if text[end - 1] not in scores and (found is None or best[end - 1] + model.lowest > found[0]):
            found = (best[end - 1] + model.lowest, 0)
        best.append(found[0])
        back.append(found[1])
    return model.word_ids(text, back[1:]) if text else []


def test_query_matches_plain_viterbi_and_the_library(spark):
    from tokenizers import Tokenizer
    from tokenizers.models import Unigram

    from ebbflow.llm.token_count import read_vocabulary

    vocabulary, unknown = read_vocabulary(MODEL)
    library, model = Tokenizer(Unigram(vocabulary, unknown, True)), sp.Model(MODEL)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op6_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["round_trip"] and r["n_pieces"] == len(r["ids"])
        assert r["ids"] == library.encode(sp.normalise(text), add_special_tokens=False).ids
        if len(text) < 1500:
            assert r["ids"] == plain(text, model)


def test_long_words_unknown_characters_and_small_blocks(spark):
    rng, model = random.Random(4), sp.Model(MODEL)
    texts = [None, "", " ", "  two  spaces ", "a" * 3000, "".join(rng.choice("abcdeé梦\U0001f600ሴ=_") for _ in range(2500)), "<s> <unk> <0x41>", "tab\tline\n\nend", "x", "x"]
    texts += [" ".join(rng.choice(["the", "a", "word", "Ünïcode", "🙂", "12"]) for _ in range(rng.randrange(200))) for _ in range(30)]
    frame = spark.createDataFrame([(i, t, "w", 1) for i, t in enumerate(texts)], "doc_id long, text string, word string, block int")
    got = {r["doc_id"]: r for r in sp.encoding_report(frame, MODEL, block_bytes=2000, bucket_bytes=1000).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i]["ids"] == plain(t or "", model) and got[i]["round_trip"]


def test_ties_take_the_earliest_start(spark):
    words = spark.createDataFrame([(1, "▁aaaa"), (2, "▁abab"), (3, "▁" + "ab" * 700)], "word_id long, word string")
    pieces = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("aa", -2.0), ("ab", -2.0), ("aba", -3.0), ("▁a", -2.0)]
    table = spark.createDataFrame(pieces, "piece string, score double")
    edges = sp.lattice(words.repartition("word_id"), table, 3, -50.0)
    got = {r["word_id"]: (r["word"], r["back"]) for r in edges.select("word_id", "word", sp.viterbi(F.col("stretches"), 3).alias("back")).collect()}
    assert got[1] == ("▁aaaa", [1, 2, 2, 2, 2])
    assert got[2] == ("▁abab", [1, 2, 2, 3, 2])
    assert got[3][0] == "▁" + "ab" * 700 and got[3][1][2:] == [2, 3] * 699 + [2]
    short = {r["word_id"]: r["back"] for r in sp.short_words(words.filter("word_id < 3"), table, 3, -50.0).collect()}
    assert short == {i: got[i][1] for i in (1, 2)}


def test_short_and_long_words_fold_alike(spark):
    rng, model = random.Random(6), sp.Model(MODEL)
    made = ["▁" + "".join(rng.choice("abcdeé梦in_t") for _ in range(rng.randrange(1, sp.SHORT_WORD))) for _ in range(300)]
    words = spark.createDataFrame(list(enumerate(made)), "word_id long, word string").repartition("word_id")
    table = sp.piece_table(spark, model)
    long = sp.lattice(words, table, model.longest, model.lowest).select("word_id", sp.viterbi(F.col("stretches"), model.longest).alias("back"))
    want = {r["word_id"]: r["back"] for r in long.collect()}
    assert {r["word_id"]: r["back"] for r in sp.short_words(words, table, model.longest, model.lowest).collect()} == want


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert sp.encoding_report(frame, MODEL).count() == 0


class _Cogrouped:
    """Stands for grouped frames: keeps the function that writes out a block."""

    def filter(self, *_):
        return self

    select = groupBy = cogroup = filter

    def applyInArrow(self, run, _):
        return run


def test_writing_out_a_block_takes_little_memory():
    """Documents of 0 to 20,000 words; beyond the numbers and the ids only slices are held, and no batch has all documents."""
    rng, words = np.random.default_rng(5), 1000
    counts = [0, 0, *rng.integers(0, 20_000, 300).tolist(), 0, 600_000, 0, *[0] * 1500]
    numbers, places = rng.integers(0, words, sum(counts)), rng.permutation(words)
    lengths = rng.integers(1, 3, words)
    flat = rng.integers(0, 30_000, lengths.sum())
    ids = list(range(len(counts)))
    block = {"doc_ids": [ids], "digests": [[b""] * len(ids)], "counts": [counts], "numbers": [pack_numbers(numbers)], "places": [pack_numbers(places)]}
    buckets = {"bucket": [0], "lengths": [pack_numbers(lengths)], "ids": [pack_numbers(flat)]}
    run = sp._assemble(_Cogrouped(), _Cogrouped())
    tracemalloc.start()
    found = run(pa.table(block), pa.table(buckets))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    starts = np.cumsum(lengths) - lengths
    of_word = [flat[starts[p] : starts[p] + lengths[p]].tolist() for p in places]
    got, at = found.column("ids").to_pylist(), 0
    for i, n in enumerate(counts):
        assert got[i] == [x for w in numbers[at : at + n].tolist() for x in of_word[w]]
        at += n
    assert peak < 30 * len(numbers) and max(b.num_rows for b in found.to_batches()) <= 1000


def test_edges_are_grouped_as_numbers(spark, capsys):
    words = spark.createDataFrame([(1, "▁aaaa")], "word_id long, word string")
    sp.short_words(words, spark.createDataFrame([("a", -1.0)], "piece string, score double"), 3, -50.0).explain()
    assert "collect_list(struct" not in capsys.readouterr().out


def test_texts_of_a_batch_are_cut_together_and_each_word_is_looked_up_once(monkeypatch):
    rng, model = random.Random(8), sp.Model(MODEL)
    for at_once in (1, 2, 7, 1_000_000):
        monkeypatch.setattr(sp, "CUT_AT_ONCE", at_once)
        for _ in range(40):
            texts = [sp.normalise("".join(rng.choice("ab é.,▁梦\U0001f642\nß_=the") for _ in range(rng.choice([0, 1, 2, 30])))) for _ in range(rng.randrange(6))]
            words, counts = model.words(texts)
            want = []
            for text in texts:
                cut = [0, *(i for i in range(1, len(text)) if (text[i - 1], text[i]) not in model.pairs), len(text)]
                want.append([text[a:b] for a, b in zip(cut, cut[1:], strict=False) if a < b])
            assert counts.tolist() == list(map(len, want)) and [w.as_py().decode() for w in words] == sum(want, [])

    looked = []

    class Index(dict):
        def __getitem__(self, word):
            looked.append(word)
            return self.setdefault(word, len(self))

    block = sp._Block(model)
    block.index = Index()
    for _ in range(2):
        block.add([1, None, 2], ["one fish, two fish. red fish. " * 50, "", "blue fish, red fish"])
    assert len(looked) == 2 * len(block.index) == 2 * len({*looked})
    numbers = np.concatenate(block.numbers).tolist()
    assert sum(block.counts) == len(numbers) and b"".join(list(block.index)[n] for n in numbers[: block.counts[0]]).decode() == sp.normalise("one fish, two fish. red fish. " * 50)
