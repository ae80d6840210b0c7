"""SentencePiece encoding and decoding over a relational lattice.

Encoding is a Viterbi search over the piece table, done once per distinct word by Spark:

1. all substrings of a word of at most the longest piece's length are exploded;
2. an equi-join with the piece table keeps those that are pieces; where no one-character piece fits, an unknown edge over
   that character remains, at the lowest score less 10;
3. the edges are grouped by word;
4. a higher-order ``aggregate`` folds them place by place: its state is, per place, the best score and the length of the best last piece. Of
   equal scores the longest last piece wins, that is the earliest start, as in the tokenizer.

A word of more than ``SHORT_WORD`` characters is cut into stretches of ``STRETCH`` first; its edges are folded one by one in order of their end,
then start, and the fold over stretches is nested, so a word of any length costs linear time.

Texts are cut into words where the lattice can have no edge: between two characters that no piece has next to each other, such as a letter and the space
(U+2581) or the full stop after it. The texts of a batch are cut together, as places in their bytes. Each word is segmented by itself with the same result.

Unknown characters become their UTF-8 bytes (byte pieces). Unknown, control and byte pieces never match text, as in
SentencePiece.

Documents meet their words' ids without one row per occurrence: documents are packed into blocks of about
``BLOCK_BYTES`` of text, each holding its word numbers as one compressed column and its distinct words in hash buckets. A bucket's
words travel once: they become one sorted list, and each block keeps the places of its words in it. The list is encoded, a co-group by bucket turns the places into ids, and
a last co-group by block writes out the ids.

Decoding is a column expression: each id's bytes in hexadecimal from an array literal, joined and read as UTF-8.

Scale: each bucket and each block is a partition of its own. Shuffles carry distinct words per block, packed and compressed, not occurrences. Buckets grow in number with the
text, so a bucket's words stay bounded; a frequent word is one entry per block. The piece table is a model file's, of a size that no input changes, and
is broadcast. Blocks, words and word ids are written to the shared scratch folder.

Defined results: null and empty texts have no ids and decode to the empty text. Texts that hold U+2581 themselves decode with
spaces in its place (``round_trip`` is then false). Repeated rows each give a row. Equal scores are decided as above. An empty table gives no rows. Very long texts and words are
encoded whole. Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.llm.common import BATCH_ROWS, bucketed, conf, cut_at, distinct_of, materialize, pieces, ranges, small_batches
from ebbflow.llm.packing import arrange, open_numbers, open_words, pack_numbers, pack_words

SPACE = "▁"
SHORT_WORD = 48
STRETCH = 512
BLOCK_BYTES = 24_000_000
BUCKET_BYTES = 32_000_000
PARTITION_WORDS = 20_000
CUT_AT_ONCE = 1_000_000
WORDS_AT_ONCE = 500_000
UNKNOWN_PENALTY = 10.0


class Model:
    """The pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(size)]
        self.special = [model.is_unknown(i) or model.is_control(i) or model.is_unused(i) for i in range(size)]
        self.byte = [model.is_byte(i) for i in range(size)]
        scores = [model.get_score(i) for i in range(size)]
        self.matching = [(n, i, s) for i, (n, s) in enumerate(zip(self.names, scores, strict=True)) if not self.special[i] and not self.byte[i]]
        self.ids = {n: i for n, i, _ in self.matching}
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(self.names) if self.byte[i]}
        self.unknown = model.unk_id()
        self.lowest = min(scores) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.ids))
        self.pairs = {pair for n in self.ids for pair in zip(n, n[1:], strict=False)}
        if any(b == SPACE != a for a, b in self.pairs):
            raise ValueError("a piece spans the start of a word")
        # the pairs as a table over the characters that occur in them (0: all others)
        characters = sorted({c for pair in self.pairs for c in pair})
        self.kinds = np.zeros(0x110000, np.int32)
        self.kinds[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self.joined = np.zeros((len(characters) + 1,) * 2, bool)
        for a, b in self.pairs:
            self.joined[self.kinds[ord(a)], self.kinds[ord(b)]] = True

    def words(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The texts cut between characters that no piece has next to each other, as a column of UTF-8 bytes, and the number of words of each."""
        text = "".join(texts)
        limits = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        found, where, size = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0  # places in the text, and in its bytes
        for start in range(0, len(text), CUT_AT_ONCE):
            codes = np.frombuffer(text[start : start + CUT_AT_ONCE + 1].encode("utf-32-le", "surrogatepass"), "<u4")
            kinds = self.kinds[codes]
            cut = ~self.joined.take(kinds[:-1] * self.joined.shape[1] + kinds[1:])
            inside = limits[np.searchsorted(limits, start, "right") : np.searchsorted(limits, start + len(cut), "right")]
            cut[inside - (start + 1)] = True
            after = np.flatnonzero(cut) + 1
            codes = codes[:CUT_AT_ONCE]
            widths = np.ones(len(codes), np.uint8)
            for least in (0x80, 0x800, 0x10000):
                widths += codes >= least
            ends = np.cumsum(widths, dtype=np.int64)
            found.append(after + start)
            where.append(ends[after - 1] + size)
            size += int(ends[-1])
        starts = np.concatenate(found)[: None if text else 0]
        counts = np.diff(np.searchsorted(starts, limits), prepend=0)
        return cut_at(text.encode("utf-8", "surrogatepass"), np.concatenate(where)[: len(starts)]), counts

    def unknown_ids(self, character: str) -> list[int]:
        found = [self.bytes.get(b) for b in character.encode("utf-8", "surrogatepass")]
        return [self.unknown] if None in found else found

    def word_ids(self, word: str, back: list[int]) -> list[int]:
        """Ids of a word from the length of the best last piece at each place (0: an unknown character)."""
        cuts, at = [], len(word)
        while at:
            cuts.append(at)
            at -= back[at - 1] or 1
        out, start = [], 0
        for end in reversed(cuts):
            out += [self.ids[word[start:end]]] if back[end - 1] else self.unknown_ids(word[start:end])
            start = end
        return out


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    return spark.createDataFrame([(n, float(s)) for n, _, s in model.matching], "piece string, score double")


def normalise(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


# --- the lattice -----------------------------------------------------------------------------------------------------


def _edges(substrings: DataFrame, table: DataFrame) -> DataFrame:
    """``substrings`` (a row each: length, piece) that are pieces, with their score; null for a character that is no piece."""
    return substrings.join(F.broadcast(table), "piece", "left").filter(F.col("score").isNotNull() | (F.col("length") == 1))


def short_words(words: DataFrame, table: DataFrame, longest: int, lowest: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, word_id, word and ``back`` (see ``viterbi``) of words of bounded length. ``words`` should be partitioned by word_id."""
    ends = words.select(*keys, "word_id", "word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("end"))
    cut = ends.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), "end"))).alias("length"))
    known = table.select("piece", "score").collect()  # a model file's, of a size that no input changes
    scores = F.split(F.lit(",".join(map(repr, [lowest, *(r["score"] for r in known)]))), ",").cast("array<double>")  # folded to one array literal
    table = words.sparkSession.createDataFrame([(r["piece"], i, r["score"]) for i, r in enumerate(known, 1)], "piece string, place int, score double")
    joined = _edges(cut.withColumn("piece", F.substring("word", F.col("end") - F.col("length") + 1, F.col("length"))), table)
    # Edges are grouped as one number each (end, length, place of the score): as rows they would take several times the memory and time.
    packed = F.shiftleft(F.col("end").cast("bigint"), 48) + F.shiftleft(F.col("length").cast("bigint"), 32) + F.coalesce("place", F.lit(0))
    grouped = joined.groupBy(*keys, "word_id", "word").agg(F.array_sort(F.collect_list(packed)).alias("packed"))

    def edge(e: Column) -> Column:
        at, length = e.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"), F.shiftright(e, 32).cast("int").bitwiseAND(F.lit(0xFFFF))
        return F.struct(F.when(at == 0, 0).otherwise(length).alias("length"), F.get(scores, at).alias("score"))

    edges = grouped.select(*keys, "word_id", "word", F.transform("packed", edge).alias("edges"))
    # where the edges to each place begin: with that of length 1 (0: unknown), which every place has
    begins = F.filter(F.sequence(F.lit(1), F.size("edges")), lambda i: F.element_at("edges", i)["length"] < 2)
    edges = edges.select("*", F.concat(begins, F.array(F.size("edges") + 1)).alias("begins"))

    def place(bests: Column, end: Column) -> Column:
        begin = F.element_at("begins", end)
        gains = F.transform(
            F.slice("edges", begin, F.element_at("begins", end + 1) - begin),
            lambda e: F.struct((F.element_at(bests, -F.greatest(e["length"], F.lit(1)))["gain"] + e["score"]).alias("gain"), e["length"].alias("length")),
        )
        return F.concat(bests, F.array(F.array_max(gains)))

    start = F.array(F.struct(F.lit(0.0).alias("gain"), F.lit(0).alias("length")))
    lengths = F.aggregate(F.sequence(F.lit(1), F.length("word")), start, place, lambda b: F.transform(F.slice(b, 2, F.size(b) - 1), lambda x: x["length"]))
    return edges.select(*keys, "word_id", "word", lengths.alias("back"))


def lattice(words: DataFrame, table: DataFrame, longest: int, lowest: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per word (columns ``keys``, word_id, word): word_id, keys, word and its edges by stretch, in fold order.

    ``words`` should be partitioned by word_id: grouping then needs no shuffle of the edges."""
    n = F.length("word")
    stretches = words.select(*keys, "word_id", "word", n.alias("n"), F.explode(F.sequence(F.lit(0), F.floor((n - 1) / STRETCH).cast("int"))).alias("stretch"))
    left = F.greatest(F.lit(0), F.col("stretch") * STRETCH - (longest - 1))
    last = F.least(F.col("n"), (F.col("stretch") + 1) * STRETCH)
    windows = stretches.select(
        *keys,
        "word_id",
        "stretch",
        left.alias("left"),
        last.alias("last"),
        F.substring("word", left + 1, last - left).alias("window"),
    )
    place = F.explode(F.sequence(F.col("stretch") * STRETCH + 1, F.col("last"))).alias("end")
    ends = windows.select(*keys, "word_id", "stretch", "left", "last", "window", place)
    cut = ends.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), "end"))).alias("length"))
    sub = F.substring("window", F.col("end") - F.col("left") - F.col("length") + 1, F.col("length"))
    joined = _edges(cut.withColumn("piece", sub), table)
    edge = F.struct(
        "end",
        F.col("score").isNull().alias("unknown"),
        (-F.col("length")).alias("back"),
        F.coalesce("score", F.lit(lowest)).alias("score"),
    )
    own = F.substring("window", F.col("stretch") * STRETCH - F.col("left") + 1, F.lit(STRETCH))
    grouped = joined.groupBy(*keys, "word_id", "stretch").agg(F.array_sort(F.collect_list(edge)).alias("edges"), F.first(own).alias("own"))
    by_word = grouped.groupBy(*keys, "word_id").agg(F.array_sort(F.collect_list(F.struct("stretch", "own", "edges"))).alias("stretches"))
    return by_word.select(*keys, "word_id", F.array_join(F.transform("stretches", lambda s: s["own"]), "").alias("word"), "stretches")


def viterbi(stretches: Column, longest: int) -> Column:
    """For every place of a word, the length of the best segmentation's last piece up to it (0: unknown character)."""

    def edge(state: Column, e: Column) -> Column:
        # ``bests`` ends with the best so far of the place ``end``; an edge to a later place appends, a better one replaces.
        # ``back`` is negative: the place that many before the edge's end.
        bests, new = state["bests"], e["end"] != state["end"]
        gain = F.element_at(bests, F.when(new, e["back"]).otherwise(e["back"] - 1))["gain"] + e["score"]
        this = F.array(F.struct(gain.alias("gain"), F.when(e["unknown"], 0).otherwise(-e["back"]).alias("length")))
        kept = (
            F.when(new, F.concat(bests, this))
            .when(gain > F.element_at(bests, -1)["gain"], F.concat(F.slice(bests, 1, F.size(bests) - 1), this))
            .otherwise(bests)
        )
        return F.struct(kept.alias("bests"), e["end"].alias("end"))

    def stretch(state: Column, s: Column) -> Column:
        start = F.struct(F.slice(state["bests"], -longest, longest).alias("bests"), F.lit(0).alias("end"))
        bests = F.aggregate(s["edges"], start, edge, lambda x: x["bests"])
        done = F.transform(F.slice(state["bests"], longest + 1, F.greatest(F.size(state["bests"]) - longest, F.lit(0))), lambda x: x["length"])
        return F.struct(bests.alias("bests"), F.concat(state["lengths"], F.array(done)).alias("lengths"))

    def finish(state: Column) -> Column:
        done = F.transform(F.slice(state["bests"], longest + 1, F.greatest(F.size(state["bests"]) - longest, F.lit(0))), lambda x: x["length"])
        return F.flatten(F.concat(state["lengths"], F.array(done)))

    def place(gain: float) -> Column:
        return F.struct(F.lit(gain).alias("gain"), F.lit(0).alias("length"))

    # ``bests`` always starts with the ``longest`` places before the stretch; before the word only place 0 can be reached
    before = F.concat(F.array_repeat(place(float("-inf")), longest - 1), F.array(place(0.0)))
    begin = F.struct(before.alias("bests"), F.array().cast("array<array<int>>").alias("lengths"))
    return F.aggregate(stretches, begin, stretch, finish)


def segment_words(words: DataFrame, model: Model, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, word_id, word and ``back`` of every word (columns keys, word_id, word)."""
    # Grouping holds the edges of a partition's words in memory, so partitions have a bounded number of words.
    spread = words.repartition(max(1, math.ceil(words.count() / PARTITION_WORDS)), "word_id")
    table = piece_table(words.sparkSession, model)
    short = F.length("word") <= SHORT_WORD
    edges = lattice(spread.filter(~short), table, model.longest, model.lowest, keys)
    long = edges.select(*keys, "word_id", "word", viterbi(F.col("stretches"), model.longest).alias("back"))
    return short_words(spread.filter(short), table, model.longest, model.lowest, keys).unionByName(long)


# --- documents in blocks ---------------------------------------------------------------------------------------------

BLOCKS = "block bigint, bucket int, words binary, doc_ids array<bigint>, digests array<binary>, counts array<int>, numbers binary, places binary"


class _Block:
    """Documents of one task until they hold about a block of text."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.index: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        self.ids, self.digests, self.counts, self.numbers, self.size = [], [], [], [], 0

    def add(self, doc_ids: list[int | None], texts: list[str]) -> None:
        """The documents of a batch: they are cut together, and each distinct word of theirs is looked up once."""
        words, counts = self.model.words(list(map(normalise, texts)))
        places, distinct = distinct_of(words)
        self.numbers.append(np.fromiter(map(self.index.__getitem__, distinct), np.uint32, len(distinct))[places])
        self.ids += doc_ids
        self.counts += counts.tolist()
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass")
            self.digests.append(hashlib.md5(raw).digest())
            self.size += len(raw)

    def rows(self, block: int, buckets: int) -> Iterator[dict]:
        """A row per bucket with its words, then the row of the documents."""
        words = list(self.index)
        groups, numbers, places = arrange(words, self.numbers, buckets)
        for bucket, group in groups:
            yield {"block": block, "bucket": bucket, "words": pack_words([words[i] for i in group])}
        yield {
            "block": block,
            "bucket": -1,
            "doc_ids": self.ids,
            "digests": self.digests,
            "counts": self.counts,
            "numbers": pack_numbers(numbers),
            "places": pack_numbers(places),
        }


def pack_documents(docs: DataFrame, id_col: str, text_col: str, buckets: int, block_bytes: int, model_path: str, parts: int) -> DataFrame:
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, model = TaskContext.get().partitionId(), 0, _model(model_path)
        block = _Block(model)
        for batch in pieces(batches, "text", 2_000_000):
            block.add(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
            if block.size >= block_bytes:
                yield from (pa.RecordBatch.from_pylist([r], schema=_BLOCKS_ARROW) for r in block.rows(part << 24 | number, buckets))
                number, block = number + 1, _Block(model)
        if block.ids:
            yield from (pa.RecordBatch.from_pylist([r], schema=_BLOCKS_ARROW) for r in block.rows(part << 24 | number, buckets))

    # bucketed by block: the documents stay where they are when their words' ids come
    return bucketed(source.mapInArrow(run, BLOCKS), "block", parts, "text_blocks")


_BLOCKS_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        ("words", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("digests", pa.list_(pa.binary())),
        ("counts", pa.list_(pa.int32())),
        ("numbers", pa.binary()),
        ("places", pa.binary()),
    ]
)


def distinct_words(blocks: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The different words of each bucket, once (bucket, word_id, word), and where each block's words stand among them (block, bucket,
    places). The low half of a word_id is the word's place in its bucket."""

    def run(table: pa.Table) -> pa.Table:
        number, held = table.column("bucket")[0].as_py(), [open_words(packed) for packed in table.column("words").to_pylist()]
        known = sorted(set().union(*held))
        place = {w: i for i, w in enumerate(known)}
        packed = [pack_numbers(np.fromiter(map(place.__getitem__, words), np.uint32, len(words)), delta=True) for words in held]
        n, m = len(known), len(held)
        columns = {
            "bucket": pa.array([number] * (n + m), pa.int32()),
            "word_id": pa.array([*((number << 32) + i for i in range(n)), *[None] * m], pa.int64()),
            "word": pa.array([*(w.decode("utf-8", "surrogatepass") for w in known), *[None] * m], pa.string()),
            "block": pa.array([*[None] * n, *table.column("block").to_pylist()], pa.int64()),
            "places": pa.array([*[None] * n, *packed], pa.binary()),
        }
        return pa.table(columns)

    rows = blocks.filter("bucket >= 0").select("block", "bucket", "words").repartition(buckets, "bucket")
    found = rows.groupBy("bucket").applyInArrow(run, "bucket int, word_id bigint, word string, block bigint, places binary")
    found = materialize(found, "distinct-words")
    return found.filter("word IS NOT NULL").select("bucket", "word_id", "word"), found.filter("block IS NOT NULL").select("block", "bucket", "places")


def _ids_of_blocks(places: DataFrame, words: DataFrame, buckets: int, model_path: str) -> DataFrame:
    """block, bucket and the packed ids of its words, in their order."""

    def run(blocks: pa.Table, known: pa.Table) -> pa.Table:
        model = _model(model_path)
        known = known.sort_by("word_id")
        found = list(map(model.word_ids, known.column("word").to_pylist(), known.column("back").to_pylist()))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32)
        starts = np.cumsum(lengths) - lengths
        rows = []
        for block, bucket, packed in zip(*(blocks.column(c).to_pylist() for c in ("block", "bucket", "places")), strict=True):
            at = open_numbers(packed, delta=True)
            ids = flat[ranges(starts[at], lengths[at])]
            rows.append({"block": block, "bucket": bucket, "lengths": pack_numbers(lengths[at].astype(np.uint32)), "ids": pack_numbers(ids)})
        return pa.Table.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("lengths", pa.binary()), ("ids", pa.binary())]))

    known = words.select("bucket", "word_id", "word", "back").repartition(buckets, "bucket").groupBy("bucket")
    return places.repartition(buckets, "bucket").groupBy("bucket").cogroup(known).applyInArrow(run, "block bigint, bucket int, lengths binary, ids binary")


_MODELS: dict[str, Model] = {}


def _model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


ENCODED = "doc_id bigint, digest binary, ids array<int>"


def document_ids(row: dict, lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each document's ids start (and the last one's end), and the ids of all documents of a block.

    ``lengths``: ids of each of the block's words, by place; ``flat``: these ids. Words are looked up ``WORDS_AT_ONCE`` at a time, so that
    beyond the words' numbers and the result only tables of the block's distinct words are held."""
    places, numbers = open_numbers(row["places"]), open_numbers(row["numbers"])
    # by number instead of place
    starts, counts = (np.cumsum(lengths, dtype=np.int64) - lengths)[places], lengths.astype(np.int64)[places]
    stops = np.cumsum(np.array(row["counts"], np.int64))
    slices = [(a, min(a + WORDS_AT_ONCE, len(numbers))) for a in range(0, len(numbers), WORDS_AT_ONCE)]
    ids = np.empty(sum(int(counts[numbers[a:b]].sum()) for a, b in slices), np.int32)
    bounds, done = np.zeros(len(stops) + 1, np.int32), 0
    for a, b in slices:
        count = counts[numbers[a:b]]
        ends = np.cumsum(count) + done
        mine = np.flatnonzero((stops > a) & (stops <= b))
        bounds[mine + 1] = ends[stops[mine] - a - 1]
        ids[done : int(ends[-1])] = flat[ranges(starts[numbers[a:b]], count)]
        done = int(ends[-1])
    return bounds, ids


def _assemble(blocks: DataFrame, returned: DataFrame) -> DataFrame:
    def run(docs: pa.Table, buckets: pa.Table) -> pa.Table:
        row = docs.select(["doc_ids", "digests", "counts", "numbers", "places"]).to_pylist()[0]
        order = np.argsort(buckets.column("bucket").to_numpy(), kind="stable").tolist()
        packed = [(buckets.column("lengths")[i].as_py(), buckets.column("ids")[i].as_py()) for i in order]
        empty = [np.zeros(0, np.uint32)]
        lengths = np.concatenate(empty + [open_numbers(p[0]) for p in packed])
        flat = np.concatenate(empty + [open_numbers(p[1]) for p in packed])
        bounds, ids = document_ids(row, lengths, flat)
        found = pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "digest": pa.array(row["digests"], pa.binary()),
                "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
            }
        )
        return pa.Table.from_batches(found.to_batches(max_chunksize=BATCH_ROWS))

    docs = blocks.filter("bucket < 0").select("block", "doc_ids", "digests", "counts", "numbers", "places")
    return docs.groupBy("block").cogroup(returned.groupBy("block")).applyInArrow(run, ENCODED)


def encode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """doc_id, digest (MD5 of the text) and ids of every document."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    parts = 4 * max(1, math.ceil(size / block_bytes))  # few blocks share one
    with small_batches(docs.sparkSession):
        blocks = pack_documents(docs, id_col, text_col, buckets, block_bytes, model_path, parts)
    settings = {
        "spark__sql__objectHashAggregate__sortBased__fallbackThreshold": str(100 * PARTITION_WORDS),  # no sort of the edges
        "spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true",
    }
    with conf(docs.sparkSession, **settings):
        words, places = distinct_words(blocks, buckets)
        words = materialize(segment_words(words, _model(model_path), ("bucket",)), "segmented-words")
    return _assemble(blocks, _ids_of_blocks(places, words, buckets, model_path))


def decode(ids: Column, model_path: str) -> Column:
    """The text of an array of ids."""
    model = _model(model_path)
    codes = [
        "" if model.special[i] else name[3:5] if model.byte[i] else name.replace(SPACE, " ").encode("utf-8").hex()
        for i, name in enumerate(model.names)
    ]
    table = F.split(F.lit(",".join(codes)), ",")  # folded to one array literal
    text = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.element_at(table, i + 1)), "")), "utf-8")
    return F.when(F.size(ids) == 0, F.lit("")).otherwise(F.substring(text, 2, 2**31 - 1))


def encoding_report(docs: DataFrame, model_path: str, **options) -> DataFrame:
    """One row per document: doc_id, n_pieces, ids, and whether decoding gives the text back."""
    found = encode(docs, model_path, **options)
    same = F.unhex(F.md5(F.encode(decode(F.col("ids"), model_path), "utf-8"))) == F.col("digest")
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids", same.alias("round_trip"))
