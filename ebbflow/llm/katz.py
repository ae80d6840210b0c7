"""Katz backoff language model over words, trained and applied at corpus scale.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased, then one end token. Model (bigrams):

* ``P(w | h) = d(c(hw)) c(hw) / c(h)`` for bigrams seen in training, with Good-Turing discounts ``d`` for counts up to
  ``K_GT`` (Katz's formula; the largest usable cut-off is taken, none on tiny data);
* otherwise ``alpha(h) P(w)``, where ``alpha(h)`` is exactly the mass that the seen words of ``h`` leave over, divided by the
  unigram mass of the words not seen after ``h``. A history whose seen words would leave nothing gets one more count in its
  denominator. Histories without training counts use ``P(w)`` alone;
* ``P(w)`` is the Good-Turing discounted unigram; what it leaves is the probability of the unknown word.

Every distribution sums to one over the training words, the end token and the unknown word.

How it runs. Documents are packed into blocks (word numbers as one compressed column, distinct words in hash buckets).

1. Buckets of words are merged: the unigram table (word, id, count), written partitioned by bucket; ids and counts go
   back to the blocks.
2. Each block writes its bigrams per history bucket, packed, to a table that is bucketed by history bucket, so that the next
   two steps read it without a shuffle: every bigram once with its training count, and once per document with its count there.
3. Each history bucket adds up the training counts: the bigram table (packed, partitioned by history bucket), and the counts of counts.
4. Each history bucket looks every bigram of a block up in its part of the bigram table and sums log probabilities by document;
   sums per block and bucket are added up. Backing off from a bigram to its unigram is the recursion of one token.

Hot histories: a word with more than ``HOT`` training tokens has its events spread over all buckets by their second word.
Its total is its unigram count; its left-over mass is the sum of per-bucket parts, gathered for these few histories
only (at most training tokens / HOT of them).

Hot bigrams: however often a bigram occurs, a block sends it once for the model and once per document for the scores. A
history bucket with more than ``HEAVY`` times ``EVENT_BUCKET`` such document rows is scored in parts, by block, each with
a copy of the bucket's part of the bigram table.

Bigrams are looked up by two word ids below 2**32 in one 64-bit key; more distinct words raise an error.

Defined results: null text is the empty text, one end token. A null document id counts as the empty text for the
hold-out rule. Repeated rows are scored and counted each. With no training document every probability is that of the unknown
word, 1. Equal inputs give equal sums (fixed order). An empty table gives no rows. Texts of any length are read and scored whole. Columns other than the id and
the text are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import bucketed, conf, materialize, pieces, scratch, small_batches
from ebbflow.llm.packing import arrange, open_numbers, open_words, pack_numbers, pack_words

K_GT = 5
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 7, 2
BLOCK_BYTES = 24_000_000
WORD_BUCKET_BYTES = 32_000_000
EVENT_BUCKET = 2_000_000
HEAVY = 4
HOT = 1_000_000
TOKENS_AT_ONCE = 500_000
BEGIN, END, FIRST_WORD = 0, 1, 2
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT_MODULUS == HELD_OUT_REMAINDER


def discounts(counts_of_counts: list[int], most: int = K_GT) -> np.ndarray:
    """d(r) at index r, for r up to the largest usable cut-off; index 0 is unused. ``counts_of_counts[r]``: types seen r times."""
    n = counts_of_counts
    for k in range(min(most, len(n) - 2), 0, -1):
        if min(n[1 : k + 2]) <= 0:
            continue
        cut = (k + 1) * n[k + 1] / n[1]
        if cut >= 1:
            continue
        d = [1.0] + [((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) for r in range(1, k + 1)]
        if all(0 < x <= 1 for x in d):
            return np.array(d)
    return np.ones(1)


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    out = counts.astype(np.float64)
    small = counts < len(d)
    out[small] *= d[counts[small]]
    return out


class Unigrams(NamedTuple):
    """What a task needs of the unigram level."""

    tokens: int
    types: int
    documents: int
    d: np.ndarray
    left: float

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by training count; 0 is the unknown word."""
        if not self.tokens:
            return np.ones(len(counts))
        if self.left <= 0:  # no count to discount: add one
            return (counts + 1) / (self.tokens + self.types + 1)
        return np.where(counts > 0, discounted(counts, self.d) / self.tokens, self.left)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + self.types + 1))


# --- blocks of documents and the unigram table -----------------------------------------------------------------------

BLOCKS = "block bigint, bucket int, words binary, counts binary, doc_ids array<bigint>, held array<boolean>, sizes array<int>, numbers binary, places binary"
_BLOCKS = pa.schema(
    [
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        ("words", pa.binary()),
        ("counts", pa.binary()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int32())),
        ("numbers", pa.binary()),
        ("places", pa.binary()),
    ]
)


class _Block:
    def __init__(self) -> None:
        self.index: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        self.ids, self.held, self.numbers, self.size = [], [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        raw = text.encode("utf-8", "surrogatepass")
        words = words_of(raw)
        self.ids.append(doc_id)
        self.held.append(held_out(doc_id))
        self.numbers.append(np.fromiter(map(self.index.__getitem__, words), np.uint32, len(words)))
        self.size += len(raw)

    def rows(self, block: int, buckets: int) -> Iterator[dict]:
        """A row per word bucket with its words and their training counts, then the row of the documents."""
        words = list(self.index)
        trained = [n for n, held in zip(self.numbers, self.held, strict=True) if not held]
        counts = np.bincount(np.concatenate(trained) if trained else np.zeros(0, np.uint32), minlength=len(words))
        groups, numbers, places = arrange(words, self.numbers, buckets)
        for bucket, group in groups:
            yield {"block": block, "bucket": bucket, "words": pack_words([words[i] for i in group]), "counts": pack_numbers(counts[group])}
        yield {
            "block": block,
            "bucket": -1,
            "doc_ids": self.ids,
            "held": self.held,
            "sizes": [len(n) for n in self.numbers],
            "numbers": pack_numbers(numbers),
            "places": pack_numbers(places),
        }


def pack_documents(docs: DataFrame, id_col: str, text_col: str, buckets: int, block_bytes: int) -> DataFrame:
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, block = TaskContext.get().partitionId(), 0, _Block()
        for batch in pieces(batches, "text", 2_000_000):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                block.add(doc_id, text)
            if block.size >= block_bytes:
                yield from (pa.RecordBatch.from_pylist([r], schema=_BLOCKS) for r in block.rows(part << 24 | number, buckets))
                number, block = number + 1, _Block()
        if block.ids:
            yield from (pa.RecordBatch.from_pylist([r], schema=_BLOCKS) for r in block.rows(part << 24 | number, buckets))

    return materialize(source.mapInArrow(run, BLOCKS), "lm-blocks")


def unigram_table(blocks: DataFrame, buckets: int) -> DataFrame:
    """bucket, word, word_id, n (training count): written partitioned by bucket."""

    def run(table: pa.Table) -> pa.Table:
        total: defaultdict[bytes, int] = defaultdict(int)
        for words, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
            for w, n in zip(open_words(words), open_numbers(counts).tolist(), strict=True):
                total[w] += n
        bucket = table.column("bucket")[0].as_py()
        order = sorted(total, key=lambda w: (-total[w], w))  # frequent words get small ids
        ids = FIRST_WORD + np.arange(len(order), dtype=np.int64) * buckets + bucket
        return pa.table({"bucket": pa.array([bucket] * len(order), pa.int32()), "word": pa.array(order, pa.binary()), "word_id": ids, "n": pa.array([total[w] for w in order], pa.int64())})

    found = blocks.filter("bucket >= 0").select("bucket", "words", "counts").groupBy("bucket").applyInArrow(run, "bucket int, word binary, word_id bigint, n bigint")
    path = scratch(blocks.sparkSession, "unigrams")
    found.write.partitionBy("bucket").option("compression", "zstd").parquet(path)
    return blocks.sparkSession.read.schema("word binary, word_id bigint, n bigint, bucket int").parquet(path)


def unigram_level(unigrams: DataFrame, documents: int) -> Unigrams:
    """Totals and discounts; ``documents`` is the end token's count."""
    row = unigrams.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count(F.when(F.col("n") > 0, 1)).alias("types"),
        F.coalesce(F.max("word_id"), F.lit(0)).alias("last"),
        *[F.count(F.when(F.col("n") == r, 1)).alias(f"n{r}") for r in range(1, K_GT + 2)],
    ).first()
    if row["last"] >= 1 << 32:
        raise ValueError("more distinct words than 32-bit ids")
    tokens, types = row["tokens"] + documents, row["types"] + (documents > 0)
    of_counts = [0, *(row[f"n{r}"] + (documents == r) for r in range(1, K_GT + 2))]
    d = discounts(of_counts)
    left = sum((1 - d[r]) * r * of_counts[r] for r in range(1, len(d))) / tokens if tokens else 1.0
    return Unigrams(tokens, types, documents, d, left)


# --- bigram events ---------------------------------------------------------------------------------------------------

#: Bigrams: history, place of the second word in ``words``, training count. Their documents: place of the bigram, document, count there.
_MODEL_COLUMNS = ("words", "unigrams", "pair_h", "pair_w", "pair_n")
_EVENT_COLUMNS = ("words", "unigrams", "pair_h", "pair_w", "pair_n", "at", "doc", "times")
EVENTS = (
    "hbucket int, block bigint, " + ", ".join(f"{c} binary" for c in _EVENT_COLUMNS)
    + ", n_rows bigint, doc_ids array<bigint>, held array<boolean>, n_tokens array<bigint>, n_known array<bigint>, base array<double>"
)
_EVENTS = pa.schema(
    [
        ("hbucket", pa.int32()),
        ("block", pa.int64()),
        *((c, pa.binary()) for c in _EVENT_COLUMNS),
        ("n_rows", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("n_tokens", pa.list_(pa.int64())),
        ("n_known", pa.list_(pa.int64())),
        ("base", pa.list_(pa.float64())),
    ]
)


def history_bucket(h: np.ndarray, w: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    key = np.where(hot, h * np.uint64(31) + w + np.uint64(1), h)
    return ((key * _SPREAD) >> np.uint64(33)).astype(np.int64) % buckets


def block_events(row: dict, ids: np.ndarray, counts: np.ndarray, level: Unigrams, hot: np.ndarray, buckets: int) -> Iterator[dict]:
    """Event rows of one block, then its documents with base scores. ``ids``, ``counts``: of the block's words by place.

    Per token only the word's place and its number in bucket order are held; ids and counts are looked up for one bucket or one slice of tokens."""
    sizes = np.array(row["sizes"], np.int64)
    stops = np.cumsum(sizes + 1)
    starts = stops - sizes - 1
    places = _token_places(row, stops, len(ids))
    ids, counts = np.append(ids, np.uint64(END)).astype(np.uint64), np.append(counts, level.documents).astype(np.int64)

    def pairs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """History, second word and the second word's place of the tokens ``at``."""
        place, before = places[at], ids[places[at - 1]]
        return np.where(before == END, np.uint64(BEGIN), before), ids[place], place  # a document starts after the last one's end

    bucket = np.empty(len(places), np.min_scalar_type(buckets))
    for a in range(0, len(places), TOKENS_AT_ONCE):
        h, w, _ = pairs(np.arange(a, min(a + TOKENS_AT_ONCE, len(places))))
        bucket[a : a + len(h)] = history_bucket(h, w, np.isin(h, hot), buckets)
    order = np.argsort(bucket, kind="stable").astype(np.min_scalar_type(len(places)))  # documents stay in order
    edges = np.flatnonzero(np.diff(bucket[order], prepend=bucket.dtype.type(0)))
    del bucket
    doc, held = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes + 1), np.array(row["held"], bool)
    edges = np.unique(np.concatenate([[0], edges, [len(places)]])).tolist()
    for a, b in itertools.pairwise(edges):
        at = order[a:b].astype(np.int64)
        h_in, w_in, place = pairs(at)
        inner = np.lexsort((w_in, h_in))
        at, h_in, w_in, place = at[inner], h_in[inner], w_in[inner], place[inner]
        docs = doc[at]
        new_pair = np.concatenate([[True], (h_in[1:] != h_in[:-1]) | (w_in[1:] != w_in[:-1])])
        new_row = new_pair | np.concatenate([[True], docs[1:] != docs[:-1]])
        pair_at, row_at = np.flatnonzero(new_pair), np.flatnonzero(new_row)
        words, index, local = np.unique(w_in[pair_at], return_index=True, return_inverse=True)
        yield {
            "hbucket": int(history_bucket(h_in[:1], w_in[:1], np.isin(h_in[:1], hot), buckets)[0]),
            "block": row["block"],
            "words": pack_numbers(words, delta=True),
            "unigrams": pack_numbers(counts[place[pair_at][index]]),
            "pair_h": pack_numbers(h_in[pair_at], delta=True),
            "pair_w": pack_numbers(local),
            "pair_n": pack_numbers(np.add.reduceat((~held[docs]).astype(np.int64), pair_at)),
            "at": pack_numbers((np.cumsum(new_pair) - 1)[row_at].astype(np.uint64), delta=True),
            "doc": pack_numbers(docs[row_at]),
            "times": pack_numbers(np.diff(np.append(row_at, b - a))),
            "n_rows": len(row_at),
        }
    del order, doc
    known, base, seen, logs = [], [], (counts > 0).astype(np.int64), level.base(counts)
    for a, b in _slices(stops, TOKENS_AT_ONCE):
        place, first = places[starts[a] : stops[b - 1]], starts[a:b] - starts[a]
        known += np.add.reduceat(seen[place], first).tolist()
        base += np.add.reduceat(logs[place], first).tolist()
    yield {
        "hbucket": -1 - row["block"] % buckets,
        "block": row["block"],
        "doc_ids": row["doc_ids"],
        "held": row["held"],
        "n_tokens": (sizes + 1).tolist(),
        "n_known": known,
        "base": base,
    }


def _token_places(row: dict, stops: np.ndarray, end: int) -> np.ndarray:
    """The place of every token's word among the block's words; ``end`` for an end token."""
    places = np.empty(int(stops[-1]), np.uint32)
    is_end = np.zeros(len(places), bool)
    is_end[stops - 1] = True
    places[is_end] = end
    numbers = open_numbers(row["numbers"])
    if len(numbers):
        places[~is_end] = open_numbers(row["places"])[numbers]
    return places


def _slices(stops: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``size`` tokens (one document at least); ``stops``: where each one's tokens end."""
    a = 0
    while a < len(stops):
        b = max(a + 1, int(np.searchsorted(stops, (stops[a - 1] if a else 0) + size, side="right")))
        yield a, b
        a = b


def _returned(blocks: DataFrame, unigrams: DataFrame) -> DataFrame:
    """block, bucket, and the packed ids and training counts of the block's words in that bucket."""

    def run(packed: pa.Table, known: pa.Table) -> pa.Table:
        place = {w: i for i, w in enumerate(known.column("word").to_pylist())}
        ids, counts = known.column("word_id").to_numpy(), known.column("n").to_numpy()
        rows = []
        for block, bucket, data in zip(*(packed.column(c).to_pylist() for c in ("block", "bucket", "words")), strict=True):
            words = open_words(data)
            at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
            rows.append({"block": block, "bucket": bucket, "ids": pack_numbers(ids[at]), "counts": pack_numbers(counts[at])})
        return pa.Table.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary())]))

    left = blocks.filter("bucket >= 0").select("block", "bucket", "words").groupBy("bucket")
    return left.cogroup(unigrams.groupBy("bucket")).applyInArrow(run, "block bigint, bucket int, ids binary, counts binary")


def event_table(blocks: DataFrame, unigrams: DataFrame, level: Unigrams, hot: np.ndarray, buckets: int) -> DataFrame:
    """The events of all blocks, in a table bucketed by history bucket."""

    def run(docs: pa.Table, returned: pa.Table) -> pa.Table:
        row = docs.to_pylist()[0]
        order = np.argsort(returned.column("bucket").to_numpy(), kind="stable").tolist()
        empty = [np.zeros(0, np.uint32)]
        ids, counts = (np.concatenate(empty + [open_numbers(returned.column(c)[i].as_py()) for i in order]) for c in ("ids", "counts"))
        return pa.Table.from_pylist(list(block_events(row, ids.astype(np.uint64), counts.astype(np.int64), level, hot, buckets)), schema=_EVENTS)

    left = blocks.filter("bucket < 0").select("block", "doc_ids", "held", "sizes", "numbers", "places").groupBy("block")
    events = left.cogroup(_returned(blocks, unigrams).groupBy("block")).applyInArrow(run, EVENTS)
    return bucketed(events.repartition(buckets, "hbucket"), "hbucket", buckets, "lm_events")


# --- the bigram table ------------------------------------------------------------------------------------------------

BIGRAMS = "hbucket int, h binary, w binary, n binary, unigrams binary, of_counts array<bigint>, hot_h array<bigint>, hot_parts array<double>"


def _keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return h.astype(np.uint64) << np.uint64(32) | w.astype(np.uint64)


def merge_bigrams(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys, counts, unigram count of the second word) of (h, w, count, unigram count) of blocks."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(_keys(h, w) for h, w, _, _ in parts)])
    n, unigrams = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in (2, 3))
    order = np.argsort(keys, kind="stable")
    keys, n, unigrams = keys[order], n[order], unigrams[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(n, starts) if len(keys) else n, unigrams[starts]


def history_parts(n: np.ndarray, probabilities: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per history: number of types by count 1..K_GT, total count above that, unigram mass of the seen words."""
    columns = [np.add.reduceat((n == r).astype(np.float64), starts) for r in range(1, K_GT + 1)]
    columns += [np.add.reduceat(np.where(n > K_GT, n, 0).astype(np.float64), starts), np.add.reduceat(probabilities, starts)]
    return np.stack(columns, axis=1)


def backoff(parts: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominators of the seen words, log10 alpha) of histories, exactly normalised."""
    r = np.arange(1, K_GT + 1)
    weight = np.array([d[x] if x < len(d) else 1.0 for x in r])
    total = parts[:, :K_GT] @ r + parts[:, K_GT]
    left = parts[:, :K_GT] @ (r * (1 - weight))  # discounted counts
    none = left <= 1e-9
    total, left = np.where(none, total + 1, total), np.where(none, 1.0, left)
    return total, np.log10(left / total) - np.log10(np.maximum(1 - parts[:, K_GT + 1], 1e-300))


def bigram_table(events: DataFrame, level: Unigrams, hot: np.ndarray) -> DataFrame:
    """Merged training bigrams per history bucket, with counts of counts and the parts of hot histories."""

    def run(table: pa.Table) -> pa.Table:
        parts = []
        for words, unigrams, h, w, n in zip(*(table.column(c).to_pylist() for c in _MODEL_COLUMNS), strict=True):
            local, n = open_numbers(w), open_numbers(n).astype(np.int64)
            seen = n > 0
            local = local[seen]
            parts.append((open_numbers(h, delta=True)[seen], open_numbers(words, delta=True)[local], n[seen], open_numbers(unigrams).astype(np.int64)[local]))
        keys, n, counts = merge_bigrams(parts)
        h = keys >> np.uint64(32)
        row = {
            "hbucket": table.column("hbucket")[0].as_py(),
            "h": pack_numbers(h, delta=True),
            "w": pack_numbers(keys & np.uint64(0xFFFFFFFF)),
            "n": pack_numbers(n),
            "unigrams": pack_numbers(counts),
            "of_counts": [int((n == r).sum()) for r in range(1, K_GT + 2)],
            "hot_h": [],
            "hot_parts": [],
        }
        mine = np.isin(h, hot)
        if mine.any():
            starts = np.flatnonzero(np.diff(h[mine], prepend=h[mine][0] + np.uint64(1)))
            row["hot_h"] = h[mine][starts].astype(np.int64).tolist()
            row["hot_parts"] = history_parts(n[mine], level.probability(counts[mine]), starts).ravel().tolist()
        kinds = [pa.int32(), *[pa.binary()] * 4, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64())]
        return pa.Table.from_pylist([row], schema=pa.schema(list(zip(row, kinds, strict=True))))

    rows = events.filter("hbucket >= 0").select("hbucket", *_MODEL_COLUMNS)
    return materialize(rows.groupBy("hbucket").applyInArrow(run, BIGRAMS), "bigrams")


# --- scoring ---------------------------------------------------------------------------------------------------------


class Bigrams:
    """One history bucket's part of the bigram table, ready for lookups."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, counts: np.ndarray, level: Unigrams, d: np.ndarray, hot: dict[int, tuple[float, float]]):
        self.level, self.keys = level, keys
        h = keys >> np.uint64(32)
        starts = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1))) if len(h) else np.zeros(0, np.int64)
        self.histories = h[starts]
        if len(h):
            total, self.alpha = backoff(history_parts(n, level.probability(counts), starts), d)
            for i in np.flatnonzero(np.isin(self.histories, np.array(list(hot), np.uint64))):
                total[i], self.alpha[i] = hot[int(self.histories[i])]
            self.seen = np.log10(discounted(n, d) / np.repeat(total, np.diff(np.append(starts, len(h)))))
        else:
            self.alpha = self.seen = np.zeros(0)
        # histories whose training words are all in other buckets still back off with their own weight
        extra = sorted(set(hot) - set(self.histories.tolist()))
        if extra:
            self.histories = np.concatenate([self.histories, np.array(extra, np.uint64)])
            self.alpha = np.concatenate([self.alpha, [hot[x][1] for x in extra]])
            order = np.argsort(self.histories)
            self.histories, self.alpha = self.histories[order], self.alpha[order]

    def score(self, h: np.ndarray, w: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 P(w | h); ``counts``: unigram training counts of w."""
        out = np.log10(self.level.probability(counts))
        if len(self.histories):
            i = np.minimum(np.searchsorted(self.histories, h), len(self.histories) - 1)
            out += np.where(self.histories[i] == h, self.alpha[i], 0.0)
        if len(self.keys):
            keys = _keys(h, w)
            i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            out = np.where(self.keys[i] == keys, self.seen[i], out)
        return out


def _sums(events: DataFrame, bigrams: DataFrame, level: Unigrams, d: np.ndarray, hot: dict[int, tuple[float, float]], event_bucket: int = EVENT_BUCKET) -> DataFrame:
    """block, hbucket, and the sum of log probabilities of each of the block's documents in that bucket."""

    def run(table: pa.Table, model: pa.Table) -> pa.Table:
        found = model.select(["h", "w", "n", "unigrams"]).to_pylist()
        if found:
            row = found[0]
            keys = _keys(open_numbers(row["h"], delta=True), open_numbers(row["w"]))
            part = Bigrams(keys, open_numbers(row["n"]).astype(np.int64), open_numbers(row["unigrams"]).astype(np.int64), level, d, hot)
        else:
            part = Bigrams(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), level, d, hot)
        rows = []
        for e in table.to_pylist():
            words, counts = open_numbers(e["words"], delta=True), open_numbers(e["unigrams"]).astype(np.int64)
            local = open_numbers(e["pair_w"])
            scores = part.score(open_numbers(e["pair_h"], delta=True).astype(np.uint64), words[local].astype(np.uint64), counts[local])
            weights = scores[open_numbers(e["at"], delta=True).astype(np.int64)] * open_numbers(e["times"])
            total = np.bincount(open_numbers(e["doc"]), weights=weights)
            rows.append({"block": e["block"], "hbucket": e["hbucket"], "sums": total.tolist()})
        return pa.Table.from_pylist(rows, schema=pa.schema([("block", pa.int64()), ("hbucket", pa.int32()), ("sums", pa.list_(pa.float64()))]))

    kind = "block bigint, hbucket int, sums array<double>"
    rows = events.filter("hbucket >= 0").select("hbucket", "block", *_EVENT_COLUMNS)
    right = bigrams.select("hbucket", "h", "w", "n", "unigrams")
    sizes = events.filter("hbucket >= 0").groupBy("hbucket").agg(F.sum("n_rows").alias("n"))
    heavy = sizes.filter(F.col("n") > HEAVY * event_bucket).select("hbucket", F.ceil(F.col("n") / event_bucket).cast("int").alias("parts"))
    heavy = materialize(heavy, "heavy-buckets")
    if heavy.isEmpty():
        return rows.groupBy("hbucket").cogroup(right.groupBy("hbucket")).applyInArrow(run, kind)
    light = rows.join(heavy, "hbucket", "left_anti").groupBy("hbucket")
    light = light.cogroup(right.join(heavy, "hbucket", "left_anti").groupBy("hbucket")).applyInArrow(run, kind)
    spread = rows.join(heavy, "hbucket").withColumn("part", F.pmod(F.xxhash64("block"), F.col("parts")).cast("int")).drop("parts")
    copies = right.join(heavy.toDF("hbucket", "copies"), "hbucket").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    return light.unionByName(spread.groupBy("hbucket", "part").cogroup(copies.groupBy("hbucket", "part")).applyInArrow(run, kind))


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scores(events: DataFrame, sums: DataFrame, level: Unigrams) -> DataFrame:
    def run(docs: pa.Table, parts: pa.Table) -> pa.Table:
        row = docs.to_pylist()[0]
        total = np.zeros(len(row["doc_ids"]))
        for i in np.argsort(parts.column("hbucket").to_numpy(), kind="stable").tolist():
            part = parts.column("sums")[i].values.to_numpy()
            total[: len(part)] += part
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(row["n_tokens"], pa.int64()),
                "n_known": pa.array(row["n_known"], pa.int64()),
                "train_tokens": pa.array([level.tokens] * len(total), pa.int64()),
                "base_score": pa.array(row["base"], pa.float64()),
                "score": total,
            }
        )

    left = events.filter("hbucket < 0").select("block", "doc_ids", "held", "n_tokens", "n_known", "base").groupBy("block")
    return left.cogroup(sums.groupBy("block")).applyInArrow(run, SCORES)


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    word_bucket_bytes: int = WORD_BUCKET_BYTES,
    event_bucket: int = EVENT_BUCKET,
    hot_tokens: int = HOT,
) -> DataFrame:
    """Train on the documents that are not held out and score all of them."""
    with conf(docs.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return _lm_scores(docs, id_col, text_col, block_bytes, word_bucket_bytes, event_bucket, hot_tokens)


def _lm_scores(docs, id_col, text_col, block_bytes, word_bucket_bytes, event_bucket, hot_tokens) -> DataFrame:
    key = F.coalesce(F.col(f"`{id_col}`").cast("bigint").cast("string"), F.lit(""))
    trained = F.crc32(F.encode(key, "utf-8")) % HELD_OUT_MODULUS != HELD_OUT_REMAINDER
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string"))), F.count(F.when(trained, 1))).first()
    word_buckets = max(1, math.ceil((size[0] or 0) / word_bucket_bytes))
    with small_batches(docs.sparkSession):
        blocks = pack_documents(docs, id_col, text_col, word_buckets, block_bytes)
    unigrams = unigram_table(blocks, word_buckets)
    level = unigram_level(unigrams, size[1])
    hot = [(r["word_id"], r["n"]) for r in unigrams.filter(F.col("n") >= hot_tokens).select("word_id", "n").collect()]  # at most tokens / hot_tokens
    hot += [(BEGIN, level.documents)] if level.documents >= hot_tokens else []
    hot_ids = np.array([h for h, _ in hot], np.uint64)
    event_buckets = max(1, math.ceil(level.tokens / event_bucket))
    events = event_table(blocks, unigrams, level, hot_ids, event_buckets)
    bigrams = bigram_table(events, level, hot_ids)
    summed = bigrams.select(F.posexplode("of_counts").alias("r", "types")).groupBy("r").agg(F.sum("types").alias("types")).collect()
    of_counts = [0] * (K_GT + 2)
    for r in summed:
        of_counts[r["r"] + 1] = r["types"]
    d = discounts(of_counts)
    return _scores(events, _sums(events, bigrams, level, d, _hot_weights(bigrams, d), event_bucket), level)


def _hot_weights(bigrams: DataFrame, d: np.ndarray) -> dict[int, tuple[float, float]]:
    """(denominator, log10 alpha) of the hot histories, from their parts in all buckets."""
    width = K_GT + 2
    part = F.explode(F.sequence(F.lit(0), F.size("hot_h") - 1)).alias("i")
    parts = bigrams.filter(F.size("hot_h") > 0).select("hot_h", "hot_parts", part)
    parts = parts.select(F.get("hot_h", F.col("i")).alias("h"), *[F.get("hot_parts", F.col("i") * width + k).alias(f"p{k}") for k in range(width)])
    rows = parts.groupBy("h").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(width)]).collect()
    if not rows:
        return {}
    total, alpha = backoff(np.array([[r[f"p{k}"] for k in range(width)] for r in rows]), d)
    return {r["h"]: (float(t), float(a)) for r, t, a in zip(rows, total, alpha, strict=True)}
