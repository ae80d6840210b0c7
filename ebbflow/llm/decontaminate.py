"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

The patterns are the windows of ten consecutive words of every benchmark item; an item with fewer words is one
window of its own length. A document is searched once per window length ``m`` (ten, and the few shorter ones):

* a shift table maps each block of two adjacent pattern words to the distance from its last place in a pattern to
  the pattern's end. The scan looks at the block that ends at its position and jumps by that distance; a block that
  no pattern has lets it jump ``m - 1`` words, a word that no pattern has ``m`` words;
* distance 0 means that some pattern ends with the block. The bucket of that block holds these patterns, and the
  words are compared directly, so a reported occurrence is one.

Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters of the whole text.

Scale: one narrow pass over the documents, no shuffle. The patterns go to the tasks as a broadcast of at most
``block_windows`` windows. A larger benchmark is cut into blocks of that many windows, and the documents, with the
hits found so far, pass once over each block (written to the shared scratch folder in between). A document that
holds many occurrences costs time in proportion to its words.

Defined results: null and empty texts have no words and no hits. Equal items and repeated items all count under
their ids; a null item id is not reported but its windows still mark words. An empty benchmark marks nothing. Extra
columns of the documents are carried along, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import as_bytes, extended, fresh, materialize, pieces

WINDOW = 10
BLOCK_WINDOWS = 200_000
#: Word bytes after lower-casing A-Z: digits, letters and every byte of a non-ASCII character; others part words.
_TO_WORDS = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256)).lower()
HITS = "struct<n_words: bigint, n_hit: bigint, item_ids: array<string>, spans: array<struct<first: bigint, last: bigint>>>"
HITS_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("item_ids", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
    ]
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class WuManber:
    """Search for word patterns of one length."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]], length: int):
        self.m, self.block = length, min(2, length)
        self.shift: dict[bytes, dict[bytes, int]] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list[str]]] = {}
        for pattern, items in patterns.items():
            for end in range(self.block - 1, length):
                before = pattern[end - 1] if self.block == 2 else b""
                known = self.shift.setdefault(pattern[end], {})
                known[before] = min(known.get(before, length), length - 1 - end)
            if self.block == 2:  # a word that only starts patterns still forbids the long jump
                self.shift.setdefault(pattern[0], {})
            self.buckets.setdefault(pattern[length - self.block :], {})[pattern] = items

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(first word, items) of every occurrence, in text order."""
        m, block, shift, buckets = self.m, self.block, self.shift, self.buckets
        at, n, default = m - 1, len(words), m - self.block + 1
        while at < n:
            known = shift.get(words[at])
            if known is None:
                at += m
                continue
            jump = known.get(words[at - 1] if block == 2 else b"", default)
            if jump:
                at += jump
                continue
            first = at - m + 1
            items = buckets[tuple(words[at - block + 1 : at + 1])].get(tuple(words[first : at + 1]))
            if items is not None:
                yield first, items
            at += 1


def searchers(items: Iterable[tuple[str | None, tuple[bytes, ...]]]) -> list[WuManber]:
    """One searcher per window length."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, window in items:
        ids = by_length.setdefault(len(window), {}).setdefault(window, [])
        if item is not None:
            ids.append(item)
    return [WuManber(patterns, length) for length, patterns in sorted(by_length.items())]


def find(engines: list[WuManber], words: list[bytes], spans: list[tuple[int, int]], ids: set[str]) -> list[tuple[int, int]]:
    """Merged [first, last) spans of hit words, after adding to ``ids`` the items that occur."""
    found = list(spans)
    for engine in engines:
        for first, items in engine.search(words):
            ids.update(items)
            if found and found[-1][0] <= first <= found[-1][1]:
                found[-1] = (found[-1][0], max(found[-1][1], first + engine.m))
            else:
                found.append((first, first + engine.m))
    merged: list[tuple[int, int]] = []
    for first, last in sorted(found):
        if merged and first <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
        else:
            merged.append((first, last))
    return merged


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, block-independent) windows: one row per distinct (item id, window words joined by a space)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            rows = []
            for item, text in zip(ids, texts, strict=True):
                words = words_of(text)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    rows.append((item, b" ".join(words[i : i + window])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["item", "window"])

    source = items.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(cut, "item string, window binary").distinct()


def mark_hits(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_windows: int = BLOCK_WINDOWS,
) -> tuple[DataFrame, str]:
    """Every document row plus a struct column of its hits (see ``HITS``); also returns that column's name."""
    spark = docs.sparkSession
    windows = item_windows(items, item_id, item_text, window)
    total = windows.count()
    n_blocks = max(1, math.ceil(total / block_windows))
    if n_blocks > 1:
        # Range order gives blocks of nearly equal size; pmod of a hash keeps equal windows in one block.
        windows = materialize(windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(n_blocks))), "windows")
    name = fresh(docs, "hits")
    schema = extended(docs.schema, (name, HITS))
    out = docs
    for b in range(n_blocks):
        part = windows if n_blocks == 1 else windows.filter(F.col("block") == b)
        # At most about block_windows rows of ten words each come to the driver and go out as one broadcast.
        bound = spark.sparkContext.broadcast([(r["item"], tuple(bytes(r["window"]).split())) for r in part.select("item", "window").collect()])
        out = _pass(out, bound, text_col, name, schema, first=b == 0)
        if b + 1 < n_blocks:
            out = materialize(out, "decontaminate")
    return out, name


def _pass(docs, bound, text_col, name, schema, first):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engines = searchers(bound.value)
        for batch in pieces(batches, text_col, 4_000_000):
            before = [None] * batch.num_rows if first else batch.column(name).to_pylist()
            rows = []
            for text, old in zip(as_bytes(batch.column(text_col)), before, strict=True):
                words, ids = words_of(text), set(old["item_ids"] if old else ())
                spans = [(s["first"], s["last"]) for s in old["spans"]] if old else []
                spans = find(engines, words, spans, ids)
                rows.append((len(words), sum(b - a for a, b in spans), sorted(ids), spans))
            hits = pa.array([{"n_words": w, "n_hit": h, "item_ids": i, "spans": [{"first": a, "last": b} for a, b in s]} for w, h, i, s in rows], HITS_ARROW)
            kept = [c for c in batch.schema.names if c != name]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), hits], [*kept, name])

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The report of the contract: one row per document."""
    marked, h = mark_hits(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), items, **options)
    return marked.select(
        "doc_id",
        F.col(f"{h}.n_words").alias("n_words"),
        F.col(f"{h}.n_hit").alias("n_hit"),
        F.size(f"{h}.item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", f"{h}.item_ids"), 256).alias("items_sha256"),
        (F.col(f"{h}.n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without any hit, all their columns unchanged."""
    marked, h = mark_hits(docs, items, text_col, **options)
    return marked.filter(F.col(f"{h}.n_hit") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


