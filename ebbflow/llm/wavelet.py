"""Token ids as a wavelet matrix, one compressed file per shard.

The ids of a shard are stored as bit planes, highest bit first. Each plane is followed by a stable partition of the
sequence by that bit (zeros first). With a rank directory per plane, one file answers

* ``access(i)``: the id at a place,
* ``count(id, end)``: how often an id occurs before a place,
* ``select(id, k)``: the place of the k-th occurrence,

in one step per plane, and ``tokens()`` decodes everything. A file holds a JSON header, then zstd sections: document ids,
tokens per document, planes and directories.

Scale: documents are range-partitioned and sorted by id, so the shards follow document order without a global sort in
one task; each task encodes its documents and closes a shard at ``SHARD_TOKENS`` ids (a document is never split).
Files are written below a temporary name and then moved, so a lost executor leaves no half file. Shard places come
from a prefix sum in two steps (within a partition, then over the totals of partitions).

Encoding uses the tokenizers library. Byte-level pre-tokenization never joins characters over certain places (before a
space that a non-space follows, between a letter and a full stop, ...). The texts of a batch are cut there together, as places in their bytes, and
each distinct piece is encoded once per batch or found in a bounded table of earlier pieces; only its distinct pieces become Python objects. Tests compare with whole-text encoding. As the library does, a text is first cut at the strings
of the file's added tokens, which get their own ids; with ``special_as_text`` special ones are ordinary text instead.

Defined results: null text is the empty text and yields only the end id. Documents with equal ids follow each other in
text order, null ids come first; a row given twice gives two documents. An empty table gives no file and no row. Very long texts are encoded whole and may fill a shard
of their own. Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import cut_at, distinct_of, file_system, materialize, pieces, ranges, read_files, scratch, write_file

MAGIC = b"WMTOK001"
SUFFIX = ".wmt"
SHARD_TOKENS = 1 << 21
BLOCK_BITS = 4096
END_ID = 2
CACHE_PIECES = 2_000_000
BATCH_BYTES = 4_000_000
#: Numbers that are parted at once: their places stay near the processor.
PART = 1 << 16
_COUNT = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class WaveletMatrix:
    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], blocks: list[np.ndarray] | None = None):
        self.n, self.planes, self.zeros = n, planes, zeros
        self.blocks = blocks if blocks is not None else [_directory(p) for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n, top = len(ids), int(ids.max()) if len(ids) else 0
        now = ids.astype(np.uint16 if top < 1 << 16 else np.uint32)
        planes, zeros = [], []
        for bit in range(max(1, top.bit_length()) - 1, -1, -1):
            one = (now & now.dtype.type(1 << bit)).view(now.dtype) != 0
            planes.append(np.packbits(one))
            zeros.append(n - int(np.count_nonzero(one)))
            out, at, after = np.empty_like(now), 0, zeros[-1]
            for a in range(0, n, PART):  # places are several times faster than masks, whose bits no one can foresee
                part, ones = now[a : a + PART], one[a : a + PART]
                low, high = part.take(np.flatnonzero(~ones)), part.take(np.flatnonzero(ones))
                out[at : at + len(low)], out[after : after + len(high)] = low, high
                at, after = at + len(low), after + len(high)
            now = out
        return cls(n, planes, zeros)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i``."""
        block = i // BLOCK_BITS
        start = block * (BLOCK_BITS // 8)
        count = int(self.blocks[level][block]) + int(_COUNT[self.planes[level][start : i >> 3]].sum())
        return count + (int(_COUNT[self.planes[level][i >> 3] >> (8 - (i & 7))]) if i & 7 else 0)

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int] | None:
        """First and last place of the token's run after the last plane, counting occurrences before ``end``."""
        levels = len(self.planes)
        if token < 0 or token >> levels:
            return None
        first, last = 0, end
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, first), self._ones(level, last)
            first, last = (zeros + a, zeros + b) if token >> (levels - 1 - level) & 1 else (first - a, last - b)
        return first, last

    def count(self, token: int, end: int | None = None) -> int:
        found = self._range(token, self.n if end is None else min(max(end, 0), self.n)) if self.n else None
        return found[1] - found[0] if found else 0

    def select(self, token: int, k: int) -> int:
        """Place of occurrence ``k`` (from 0)."""
        found = self._range(token, self.n) if self.n else None
        if not found or not 0 <= k < found[1] - found[0]:
            raise IndexError(k)
        i = found[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = i >= self.zeros[level]
            i = self._nth(level, i - self.zeros[level] if one else i, one)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def _nth(self, level: int, k: int, one: bool) -> int:
        """Place of the k-th one (or zero) of a plane: binary search over the rank directory, then within a block."""
        low, high, blocks = 0, len(self.blocks[level]) - 1, self.blocks[level]
        before = (lambda b: int(blocks[b])) if one else (lambda b: b * BLOCK_BITS - int(blocks[b]))
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if before(middle) <= k else (low, middle - 1)
        start = low * (BLOCK_BITS // 8)
        bits = np.unpackbits(self.planes[level][start : start + BLOCK_BITS // 8])
        return low * BLOCK_BITS + int(np.flatnonzero(bits == one)[k - before(low)])

    def tokens(self) -> np.ndarray:
        """All ids, by undoing the partitions from the last plane to the first."""
        levels = len(self.planes)
        now = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n).view(bool)
            out, at, after = np.empty_like(now), 0, self.zeros[level]
            now[after:] |= now.dtype.type(1 << (levels - 1 - level))
            for a in range(0, self.n, PART):
                part, ones = out[a : a + PART], one[a : a + PART]
                low, high = np.flatnonzero(~ones), np.flatnonzero(ones)
                part[low], part[high] = now[at : at + len(low)], now[after : after + len(high)]
                at, after = at + len(low), after + len(high)
            now = out
        return now


def _directory(plane: np.ndarray) -> np.ndarray:
    """Ones before each block of the plane."""
    step = BLOCK_BITS // 8
    padded = np.zeros(-(-len(plane) // step) * step, np.uint8)
    padded[: len(plane)] = _COUNT[plane]
    return np.concatenate([[0], np.cumsum(padded.reshape(-1, step).sum(1, dtype=np.uint32))]).astype(np.uint32)


def to_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, level: int = 1) -> bytes:
    """One shard as a file."""
    matrix, press = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=level).compress
    nulls = np.array([d is None for d in doc_ids], bool)
    sections = [
        press(np.packbits(nulls).tobytes()),
        press(np.array([d or 0 for d in doc_ids], "<i8").tobytes()),
        press(np.array(lengths, "<u4").tobytes()),
        *(press(p.tobytes()) for p in matrix.planes),
        *(press(b.astype("<u4").tobytes()) for b in matrix.blocks),
    ]
    head = {"docs": len(doc_ids), "tokens": matrix.n, "zeros": matrix.zeros, "sections": [len(s) for s in sections]}
    header = json.dumps(head).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, *sections])


def from_bytes(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """(document ids, tokens per document, matrix) of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token shard")
    (size,) = struct.unpack("<I", data[8:12])
    head, at, parts = json.loads(data[12 : 12 + size]), 12 + size, []
    expand = zstandard.ZstdDecompressor().decompress
    for length in head["sections"]:
        parts.append(expand(data[at : at + length]))
        at += length
    nulls = np.unpackbits(np.frombuffer(parts[0], np.uint8), count=head["docs"])
    ids = [None if null else int(d) for d, null in zip(np.frombuffer(parts[1], "<i8"), nulls, strict=True)]
    levels = len(head["zeros"])
    planes = [np.frombuffer(p, np.uint8) for p in parts[3 : 3 + levels]]
    blocks = [np.frombuffer(p, "<u4") for p in parts[3 + levels :]]
    return ids, np.frombuffer(parts[2], "<u4"), WaveletMatrix(head["tokens"], planes, head["zeros"], blocks)


#: Pieces between which byte-level pre-tokenization always cuts: a word of plain letters with its space, a full stop or
#: comma after it, a single line end, or else everything up to the next space before a non-space. For texts with added tokens; ``cuts`` is for all others.
_PIECES = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[ .,\n]|\Z)|[.,](?= \S|\n|\Z)|\n(?=\S)|.+?(?= \S|\Z)", re.S)

_LETTER, _MARK, _SPACE, _LINE, _VISIBLE, _HIGH = (np.uint8(1 << i) for i in range(6))
#: Kinds of a byte: letter, punctuation, space, line end, anything visible in ASCII, first byte of a longer character.
_KINDS = np.zeros(256, np.uint8)
_KINDS[0x21:0x7F] = _MARK | _VISIBLE
_KINDS[0x30:0x3A] = _VISIBLE
_KINDS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER | _VISIBLE
_KINDS[0x20], _KINDS[0x0A], _KINDS[0xC2:] = _SPACE, _LINE, _HIGH
#: White space (or what some tables take for it) beyond ASCII, as its first three bytes (two and 0).
_WIDE_SPACES = np.array(
    [0xC28500, 0xC2A000, 0xE19A80, 0xE1A08E, *range(0xE28080, 0xE28090), 0xE280A8, 0xE280A9, 0xE280AF, *range(0xE2819F, 0xE281A5), 0xE38080], np.uint32
)


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where UTF-8 texts that follow each other, each beginning at one of ``starts``, can be cut: the starts and the places between

    * anything and a space that a non-space follows,
    * a letter and punctuation, or something visible and a line end,
    * a single line end and a non-space.

    Byte-level pre-tokenization has a limit at each of them, whatever is left of the first piece or right of the second."""
    n = len(data)
    found = np.zeros(n + 1, bool)
    if n:
        kinds = _KINDS[data]
        solid = (kinds & (_VISIBLE | _HIGH)) != 0  # begins a non-space
        wide = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
        if len(wide):
            first, second, third = (data[np.minimum(wide + i, n - 1)].astype(np.uint32) for i in range(3))
            solid[wide[np.isin(first << 16 | second << 8 | np.where(first == 0xC2, 0, third), _WIDE_SPACES)]] = False
        letter, mark, space, line, visible = ((kinds & k) != 0 for k in (_LETTER, _MARK, _SPACE, _LINE, _VISIBLE))
        # the last byte of a Latin letter with an accent
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        visible |= letter
        inner = found[1:n]
        inner |= letter[:-1] & mark[1:]
        inner |= visible[:-1] & line[1:]
        found[: n - 1] |= space[:-1] & solid[1:]
        last = starts[1:][starts[1:] > 0] - 1
        found[last[space[last]]] = False  # what follows is in another text
        found[2:n] |= visible[: n - 2] & line[1 : n - 1] & solid[2:]
    found[starts] = True
    return np.flatnonzero(found[:n])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a large_string or large_binary column without nulls, and where each row begins (and the last one ends)."""
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values is not None and offsets[-1] else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Exact ids of whole texts from a byte-level BPE file, with a bounded cache of pieces. Strings of the file's added tokens are those tokens, as the
    library has it, or ordinary text (``special_as_text``)."""

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = {t.content: t for t in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)}
        # a text is cut at its added tokens first; those that take the space around them are left to the library
        self.plain = {c for c, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)}
        self.others = [c for c in added if c not in self.plain]
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for piece, i in vocabulary.items() if piece.startswith("Ġ")]] = True
        self._forget()

    @classmethod
    def of(cls, path: str, special_as_text: bool = False) -> Encoder:
        """One per Python worker, so its cache serves all its tasks."""
        if (path, special_as_text) not in _ENCODERS:
            _ENCODERS[path, special_as_text] = cls(path, special_as_text)
        return _ENCODERS[path, special_as_text]

    def _cut(self, text: str) -> list[str]:
        """Pieces whose ids do not depend on what stands around them."""
        if self.added is None or not self.added.search(text):
            return _PIECES.findall(text)
        if any(c in text for c in self.others):
            return [text]
        return [p for k, part in enumerate(self.added.split(text)) for p in ([part] if k % 2 else _PIECES.findall(part))]

    def _forget(self) -> None:
        """The table of pieces: the place of each, where the ids of each place begin (and the last one's end), and these ids."""
        self.known: dict[bytes, int] = {}
        self.begins, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _learn(self, new: list[bytes]) -> None:
        """Add pieces to the table."""
        pieces = [u.decode() for u in new]
        # Pieces that begin with their only space are encoded in one go: each starts at an id that begins with a space.
        spaced = [len(u) > 1 and u[0] == " " and u.count(" ") == 1 for u in pieces]
        ids = np.array(self._ids("".join(itertools.compress(pieces, spaced))), np.uint32)
        at = np.flatnonzero(self.spaced[ids])
        if len(at) != sum(spaced):
            ids, at, spaced = ids[:0], at[:0], [False] * len(pieces)
        others = [not s for s in spaced]
        apart = [out.ids for out in self.tokenizer.encode_batch_fast(list(itertools.compress(pieces, others)), add_special_tokens=False)]
        counts = np.concatenate([np.diff(at, append=len(ids)), np.fromiter(map(len, apart), np.int64, len(apart))])
        self.known.update(zip([*itertools.compress(new, spaced), *itertools.compress(new, others)], itertools.count(len(self.known))))
        self.flat = np.concatenate([self.flat, ids, np.fromiter(itertools.chain.from_iterable(apart), np.uint32)])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(counts)])

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Place in the table of each of the pieces, which are looked up, or else encoded, once if they are equal."""
        at, distinct = distinct_of(pieces)
        place = np.fromiter(map(self.known.get, distinct, itertools.repeat(-1)), np.int32, len(distinct))
        new = np.flatnonzero(place < 0)
        if len(self.known) + len(new) > CACHE_PIECES:
            self._forget()
            new = np.arange(len(distinct))
        if len(new):
            words = [distinct[i] for i in new.tolist()]
            self._learn(words)
            place[new] = np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
        return place[at]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (a large_string column without nulls), and where those of each text end."""
        odd = np.zeros(len(texts), bool)  # has added tokens
        for content in [*self.plain, *self.others]:
            odd |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        data, offsets = _bytes_of(texts.filter(pa.array(~odd)) if odd.any() else texts)
        starts = cuts(data, offsets[:-1][np.diff(offsets) > 0])
        pieces, counts = cut_at(data, starts), np.zeros(len(texts), np.int64)
        counts[~odd] = np.diff(np.searchsorted(starts, offsets))
        apart = [self._cut(t) for t in texts.filter(pa.array(odd)).to_pylist()]
        if apart:
            counts[odd] = [len(c) for c in apart]
            pieces = pa.concat_arrays([pieces, pa.array(itertools.chain.from_iterable(apart), pa.large_string()).cast(pa.large_binary())])
        place = self._places(pieces)
        if apart:  # back to the order of the texts
            order = np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])
            begins = np.empty(len(texts), np.int64)
            begins[order] = np.cumsum(counts[order]) - counts[order]
            place = place[ranges(begins, counts)]
        n = np.diff(self.begins).astype(np.int32)[place]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(n, dtype=np.int64)])
        return self.flat[ranges(self.begins[place], n)], ends[np.cumsum(counts)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, ends = self.encode_all(pa.array(texts, pa.large_string()))
        return [ids[a:b].astype("<u4").tobytes() for a, b in itertools.pairwise([0, *ends.tolist()])]


def write_shards(
    docs: DataFrame,
    uri: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    special_as_text: bool = False,
) -> DataFrame:
    """Encode ``docs`` and write shard files below ``uri``; returns their index (written, so the files exist):
    part and shard (in document order), documents, tokens."""
    ordered = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(tokenizer, special_as_text), TaskContext.get().partitionId()
        names, data, held, shard = [], [], 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(data)
            write_file(uri, f"part-{part:07d}-{shard:07d}{SUFFIX}", to_bytes(names, [len(d) for d in data], ids))
            return pa.RecordBatch.from_pydict({"part": [part], "shard": [shard], "n_docs": [len(names)], "n_tokens": [len(ids)]}, schema=INDEX_ARROW)

        for batch in pieces(batches, "text", BATCH_BYTES):
            ids, ends = encoder.encode_all(batch.column("text").cast(pa.large_string()))
            ends += np.arange(1, len(ends) + 1)  # each has the end id too
            ended, inner = np.full(len(ids) + len(ends), end_id, np.uint32), np.ones(len(ids) + len(ends), bool)
            inner[ends - 1] = False
            ended[inner] = ids
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), [0, *ends.tolist()], ends.tolist(), strict=False):
                if data and held + b - a > shard_tokens:
                    yield close()
                    names, data, held, shard = [], [], 0, shard + 1
                names.append(doc_id)
                data.append(ended[a:b])
                held += b - a
        if data:
            yield close()

    return materialize(ordered.mapInArrow(run, "part bigint, shard bigint, n_docs bigint, n_tokens bigint"), "shard-index")


INDEX_ARROW = pa.schema([("part", pa.int64()), ("shard", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())])


def read_documents(shards: DataFrame) -> DataFrame:
    """Decode shard files (path, content): part, shard, doc_id, offset in the shard, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                part, shard = re.search(rf"part-(\d+)-(\d+){re.escape(SUFFIX)}$", path.as_py()).groups()
                ids, lengths, matrix = from_bytes(content.as_buffer().to_pybytes())
                tokens = matrix.tokens().astype("<u4")
                ends = np.cumsum(lengths, dtype=np.int64)
                crcs = [zlib.crc32(tokens[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": [int(part)] * len(ids),
                        "shard": [int(shard)] * len(ids),
                        "doc_id": pa.array(ids, pa.int64()),
                        "offset": ends - lengths,
                        "n_tokens": lengths.astype(np.int64),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    return shards.mapInArrow(run, "part bigint, shard bigint, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")


def with_starts(documents: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before each one. The index has one row per shard, its totals one per part."""
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    places = index.select("part", "shard", F.coalesce(inside, F.lit(0)).alias("inside")).join(parts, "part")
    places = places.select("part", "shard", (F.col("before") + F.col("inside")).alias("shard_start"))
    return documents.join(places, ["part", "shard"]).withColumn("start", F.col("shard_start") + F.col("offset"))


def token_shards(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """The report of the contract, read back from freshly written shard files."""
    spark = docs.sparkSession
    uri = scratch(spark, "token-shards")
    uri = uri if ":/" in uri else f"file://{uri}"
    system, folder = file_system(uri)
    system.create_dir(folder, recursive=True)
    index = write_shards(docs, uri, tokenizer, **options)
    found = with_starts(read_documents(read_files(spark, uri, SUFFIX)), index)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "shard")
