"""The pipeline against brute force, stage by stage, and the edge rows of every stage."""

import random

import pytest

import corpus_pipeline
from ebbflow.llm import near_dedup
from ebbflow.llm import sentencepiece_lattice as sp
from ebbflow.llm.common import BATCH_ROWS, materialize, small_batches
from ebbflow.llm.queries import tokenizer_path
from tests.llm.test_decontaminate import brute_hits
from tests.llm.test_near_dedup import brute_classes
from tests.llm.test_quality import brute_kept
from tests.llm.test_sentencepiece_lattice import plain

SMOKE = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    out = {}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = materialize(stage(spark, docs, SMOKE), name)
        assert docs.columns == columns
        out[name] = sorted(r["doc_id"] for r in docs.collect())
    kept = brute_kept([(i, r["text"], r["source"]) for i, r in rows.items()])
    assert out["quality_rules"] == sorted(i for i in rows if kept[i])
    classes = brute_classes([(i, rows[i]["text"]) for i in out["quality_rules"]])
    assert out["near_dedup"] == sorted(i for i, c in classes.items() if i == c)
    assert out["benchmark_decontamination"] == [i for i in out["near_dedup"] if not brute_hits(rows[i]["text"], items)[1]]
    last = corpus_pipeline.run(spark, SMOKE).collect()
    assert sorted(r["doc_id"] for r in last) == out["benchmark_decontamination"]
    model = sp.Model(tokenizer_path("piece_bpe_32k.model"))
    for r in random.Random(1).sample(last, 12):
        assert r["round_trip"] and r["ids"] == plain(rows[r["doc_id"]]["text"], model)


def test_edge_rows(spark, tmp_path):
    good = "Every one of these words is part of a long enough and clean document number %d ."
    texts = [None, "", "short", good % 1, good % 1, good % 2 + " with quite a few other words that make it differ from the rest", "same words again and now " * 80]
    rows = [(i, t, "en", "src", 5, "x") for i, t in enumerate(texts)] + [(4, good % 1, "en", None, 5, "x"), (None, " ".join(f"w{i}" for i in range(5000)), None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, hits string")
    spark.createDataFrame([(1, None), (2, "w1 w2 w3 never w4")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = materialize(stage(spark, frame, str(tmp_path)), name)
        assert frame.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in frame.collect()) == ["3", "5", "None"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


@pytest.mark.parametrize("size", [300])
def test_pipeline_keeps_one_of_each_planted_group(spark, tmp_path, size):
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(5000)}"
    leak = [word() for _ in range(14)]
    base = [word() for _ in range(150)]
    rows = []
    for i in range(size):
        kind = i % 3
        text = list(base) if kind == 0 else [word() for _ in range(100)]
        if kind == 0:
            text[rng.randrange(150)] = "edit"
        if kind == 1 and i < 60:
            text[40:40] = leak
        rows.append((i, " ".join(text), "en", f"s{i % 2}", 1))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(leak))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {0} | {i for i in range(size) if i % 3 == 2 or (i % 3 == 1 and i >= 60)}


def test_texts_go_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual, seen = spark.conf.get(key), {}

    def noting(where, name):
        plain = getattr(where, name)

        def noted(df, *rest):
            seen[rest[-1]] = int(spark.conf.get(key))
            return plain(df, *rest)

        monkeypatch.setattr(where, name, noted)

    noting(corpus_pipeline, "materialize")
    for module in (near_dedup, sp):
        noting(module, "bucketed")
    rows = [(i, f"text number {i} with a few words", "en", "s", 1) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    spark.createDataFrame([(1, "text number 7 with")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [r for r in rows if r[0] != 7]
    near_dedup.near_duplicates(docs.limit(20))
    sp.encode(docs.limit(20), tokenizer_path("piece_bpe_32k.model"))
    assert {n: seen[n] for n in ("decontaminated", "distinct_texts", "text_blocks")} == dict.fromkeys(("decontaminated", "distinct_texts", "text_blocks"), BATCH_ROWS)
    assert spark.conf.get(key) == usual

    def sizes(batches):
        import pyarrow as pa

        yield from (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)

    with small_batches(spark):
        assert max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect()) <= BATCH_ROWS
    spark.conf.set(key, "7")
    try:
        with small_batches(spark):
            assert spark.conf.get(key) == "7"
    finally:
        spark.conf.set(key, usual)
