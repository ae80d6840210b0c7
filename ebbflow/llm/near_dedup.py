"""Near-duplicate classes by Order MinHash and banded alignment.

**Sketch.** A text's k-mers are its windows of ``KMER`` words (a shorter text is one window), each labelled with its
occurrence number in the text. Each of ``SKETCHES`` hash functions picks the ``PICKS`` labelled k-mers with the least hashes
and keeps them in text order. Two texts share a sketch entry when they picked the same k-mers in the same order, so unlike
a set sketch it falls with moved passages too: it follows edit similarity. One edit changes at most ``KMER`` windows. A link of texts
of n > ``SHORT`` words therefore shares at least 0.6 n of its two-word windows, whatever its edits, and all sketches together miss it with a
chance below 0.05 %. (Windows of five words are too rare at similarity 0.8: an edit in every fifth word leaves none.)

**Short texts** (at most ``SHORT`` words) also meet exactly, by a prefix filter on single occurrence-labelled words: a link
leaves all but the allowed edits of the longer text in common, so the rarest ``allowed edits + 1`` words of both sides, in
one order of rarity, share a word.

**Candidates and verification.** Texts that share an entry are candidates. A candidate pair is a link if a word
alignment confined to the diagonals within the allowed number of edits gives a similarity 1 - edits / longer length of at least
``SIMILARITY``. Word counts and small word histograms, both lower bounds of the number of edits, reject pairs earlier and
never a link. Classes are the connected components of the links.

**No link between different classes is lost, and no bucket is expanded into all pairs.** First each member of a bucket is
verified against the bucket's smallest member, and components are formed; a group of copies collapses here in linear work.
What remains are buckets whose members are in different components, usually texts that share a passage. Their members
are cut into chunks, each pair of chunks is one small task group, and only pairs of different components that pass the bounds
leave it for verification. Chunk tasks read n²/CHUNK rows of a bucket of n, the price of exactness for such buckets.

Scale: exact copies collapse first, on a 128-bit hash of the word sequence, within each task before anything is shuffled. The distinct texts are
written bucketed by their id, so texts are shuffled once; later joins bring ids to them. A pair's texts meet once per member, and a head with very many
members is dealt out over copies of its text. Bucket minima are combined before the shuffle and joined back, where Spark
splits skewed keys. Every step is written to the shared scratch folder.

Defined results: ``class_id`` is the smallest document id of the class. Words are compared lower-cased, separated by white
space. Documents without a word (null or empty texts) are classes of their own. Null ids are never smallest: such
documents carry the class id of their class, null if it has no id. Repeated rows share their class. An empty table gives no rows. Columns of ``docs`` other than
the id and the text are not read, except by ``one_of_each``, which returns them whatever their names. Texts of any length are aligned whole; the
alignment of two texts of n words takes at most n * n / 5 steps, few when they differ in few places; up to ``BIT_WORDS`` words a row is a few operations on long
integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import bucketed, extended, fresh, materialize, pieces, small_batches
from ebbflow.llm.components import connected_components

KMER = 2
PICKS = 2
SKETCHES = 40
SHORT = 32
SIMILARITY = 0.8
BINS, MOST_BINS = 256, 8192
CHUNK = 1024
HEAD_ROWS = 2048
SEEN = 100_000
#: Words that a worker process keeps the hashes of: it stays for later stages, and a million words take 140 MB.
HASHED_WORDS = 100_000
FEW_EDITS = 24
BAND_CELLS = 4_000_000
BIT_WORDS = 20_000

_FACTORS, _SHIFTS = np.random.default_rng(20240501).integers(0, 1 << 32, (2, 512), np.uint64).astype(np.uint32)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


class _WordHashes(dict):
    """64-bit hashes of words, the same in every process, computed when first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = found = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


_WORD_HASHES = _WordHashes()


def word_hashes(words: list[str]) -> np.ndarray:
    if len(_WORD_HASHES) > HASHED_WORDS:  # keeps the table bounded
        _WORD_HASHES.clear()
    return np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(hashes: np.ndarray, k: int = KMER) -> np.ndarray:
    """Hashes of the occurrence-labelled windows of k words, in text order."""
    width = min(k, len(hashes))
    out = np.zeros(len(hashes) - width + 1, np.uint64)
    for j in range(width):
        out = _mix(out + hashes[j : j + len(out)] + np.uint64(j + 1))
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    starts = np.flatnonzero(first)
    label = np.empty(len(out), np.uint64)
    label[order] = (np.arange(len(out)) - np.repeat(starts, np.diff(np.append(starts, len(out))))).astype(np.uint64)
    return _mix(out + label * np.uint64(0x9E3779B97F4A7C15))


def order_minhash(labelled: np.ndarray, sketches: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """One 64-bit entry per hash function: the picked k-mers in text order."""
    take, step = min(picks, len(labelled)), max(1, 1_000_000 // len(labelled))
    picked, short = np.empty((sketches, take), np.uint64), (labelled >> np.uint64(32)).astype(np.uint32)
    for s in range(0, sketches, step):
        rows = np.arange(min(step, sketches - s))
        hashed = np.multiply.outer(_FACTORS[s : s + len(rows)] | np.uint32(1), short)
        hashed += _SHIFTS[s : s + len(rows), None]
        at = np.empty((len(hashed), take), np.int64)
        for k in range(take):  # the least hash, again and again: faster than a partition for a few picks
            at[:, k] = hashed.argmin(axis=1)
            hashed[rows, at[:, k]] = np.iinfo(np.uint32).max
        picked[s : s + len(rows)] = labelled[np.sort(at, axis=1)]
    out = np.arange(sketches, dtype=np.uint64) * np.uint64(16) + np.uint64(take)
    for k in range(take):
        out = _mix(out * np.uint64(31) + picked[:, k])
    return out


def histogram(hashes: np.ndarray) -> np.ndarray:
    """Words per hash bin, at most 255 each (a cap can only lower the bound that is taken from it); at least two bins a word."""
    bins = min(max(BINS, 1 << (2 * len(hashes)).bit_length()), MOST_BINS)
    return np.minimum(np.bincount((hashes % np.uint64(bins)).astype(np.int64), minlength=bins), 255).astype(np.uint8)


def folded(counts: np.ndarray, bins: int) -> np.ndarray:
    """A histogram with fewer bins (a power of two)."""
    return np.minimum(counts.reshape(-1, bins).sum(axis=0, dtype=np.int64), 255)


def least_edits(h: bytes, g: bytes) -> int:
    """A lower bound of the edits between two texts from their histograms: every edit removes at most one word and adds at most one."""
    bins = min(len(h), len(g))
    delta = folded(np.frombuffer(h, np.uint8), bins) - folded(np.frombuffer(g, np.uint8), bins)
    return max(int(delta[delta > 0].sum()), int(-delta[delta < 0].sum()))


def alignment_edits(a: list, b: list, most: int) -> int | None:
    """Word edits between two sequences if at most ``most``, by alignment within that band of diagonals."""
    number: dict = {}
    return hashed_edits(*(np.array([number.setdefault(w, len(number)) for w in side], np.int64) for side in (a, b)), most)


def hashed_edits(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """``alignment_edits`` of two sequences of word hashes."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    same = a[: min(n, m)] == b[: min(n, m)]
    start = len(same) if same.all() else int(same.argmin())
    a, b = a[start:], b[start:]
    short = min(len(a), len(b))
    same = a[len(a) - short :][::-1] == b[len(b) - short :][::-1]
    end = short if same.all() else int(same.argmin())
    a, b = a[: len(a) - end], b[: len(b) - end]
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m) if max(n, m) <= most else None
    # words that one side has and the other lacks: each edit settles one of either side
    bins = 1 << min(max(n, m).bit_length() + 2, 20)
    delta = np.bincount((a % bins).astype(np.int64), minlength=bins) - np.bincount((b % bins).astype(np.int64), minlength=bins)
    least = max(int(delta[delta > 0].sum()), int(-delta[delta < 0].sum()))
    if least > most:
        return None
    band = min(FEW_EDITS, most)
    if least <= band:  # most links have few edits
        found = _furthest_reaching(a, b, band)
        if found is not None or band == most:
            return found
    if max(n, m) <= BIT_WORDS:
        return _bit_rows(a, b, most)
    band = max(4 * FEW_EDITS, least)  # long texts: the band widens until it holds the alignment
    while True:
        band = min(band, most)
        within = _furthest_reaching if (2 * band + 1) * n <= BAND_CELLS else _banded_rows
        found = within(a, b, band)
        if found is not None or band == most:
            return found
        band *= 4


def _furthest_reaching(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The furthest place that each number of edits reaches on each diagonal, all diagonals of the band at once."""
    n, m = len(a), len(b)
    goal = n - m + most  # diagonal k: place in a less place in b is k - most
    if not 0 <= goal <= 2 * most:
        return None
    diagonal, place = np.arange(-most, most + 1, dtype=np.int32), np.arange(n + 1, dtype=np.int32)
    padded = np.concatenate([np.zeros(most, a.dtype), b, np.zeros(n + most + 1, a.dtype)])
    step = padded.strides[0]
    other = np.lib.stride_tricks.as_strided(padded[2 * most :], (2 * most + 1, n + 1), (-step, step))  # row k: what stands in b across from a
    y = place[None, :] - diagonal[:, None]
    match = (other == np.append(a, a[:1])[None, :]) & (y >= 0) & (y < m) & (place < n)
    # stop[k, x]: the first place from x on at which diagonal k does not match
    stop = np.minimum.accumulate(np.where(match, np.int32(n), place)[:, ::-1], axis=1)[:, ::-1]
    never, rows = -(1 << 30), np.arange(2 * most + 1)
    last, valid = np.minimum(n, m + diagonal), (diagonal <= n) & (diagonal >= -m)
    reach = np.full(2 * most + 3, never, np.int64)  # with one more diagonal at either side
    for edits in range(most + 1):
        to = np.maximum(np.maximum(reach[1:-1], reach[:-2]) + 1, reach[2:]) if edits else np.where(diagonal == 0, 0, never)
        to = np.minimum(to, last)
        reach[1:-1] = np.where(valid & (to >= 0) & (to >= diagonal), stop[rows, np.clip(to, 0, n)], never)
        if reach[1 + goal] >= n:
            return edits
    return None


def _bit_rows(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Rows of the edit matrix as differences between neighbours, a bit for each place of a; given up once the last diagonal cannot be reached
    within the band any more."""
    n, places = len(a), {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | (1 << i)
    mask, last = (1 << n) - 1, 1 << (n - 1)
    more, less, edits = mask, 0, n  # where the next place of the column has one edit more, one less; edits of all of a so far
    for left, w in zip(range(len(b) - 1, -1, -1), b.tolist(), strict=True):
        match = places.get(w, 0)
        diagonal = (((match & more) + more) ^ more) | match | less
        up, down = less | (~(diagonal | more) & mask), diagonal & more
        edits += 1 if up & last else -1 if down & last else 0
        if edits - left > most:
            return None
        up, down = (up << 1 | 1) & mask, (down << 1) & mask
        more, less = down | (~(diagonal | up) & mask), up & diagonal
    return edits if edits <= most else None


def _banded_rows(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """For many edits: rows of the edit matrix, ``most`` diagonals to either side, given up once a row exceeds ``most``."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    width = 2 * most + 1  # column k of row i is place i + k - most of b
    step = np.arange(width)
    padded = np.zeros(m + 2 * width, a.dtype)  # what stands outside b is overwritten below
    padded[width : width + m] = b
    far = 1 << 40
    row = np.where(step >= most, step - most, far)
    row[most + m + 1 :] = far
    for i in range(1, n + 1):
        places = padded[width + i - most - 1 : width + i + most]
        up = np.append(row[1:], far) + 1
        new = np.minimum(row + (places != a[i - 1]), up)
        low, high = max(0, most - i), min(width, m - i + most + 1)
        if low > 0 or high < width:
            new[:low] = far
            new[max(high, 0) :] = far
        if most - i >= 0:
            new[most - i] = i  # before the first word of b
        row = np.minimum.accumulate(new - step) + step
        if row.min() > most:
            return None
    found = int(row[m - n + most])
    return found if found <= most else None


def allowed_edits(n: int, m: int, similarity: float) -> int:
    return int((1 - similarity) * max(n, m) + 1e-9)


def similar(a: str, b: str, similarity: float = SIMILARITY) -> bool:
    one, two = words_of(a), words_of(b)
    return alignment_edits(one, two, allowed_edits(len(one), len(two), similarity)) is not None


_IDENTITY = "u1 bigint, u2 bigint, n_words bigint"


def _identity(words: list[str]) -> tuple[int, int]:
    digest = hashlib.blake2b("\n".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def identities(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the 128-bit identity of the word sequence of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", 4_000_000):
            rows = [(*_identity(w), len(w)) for w in map(words_of, batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))], ["doc_id", "u1", "u2", "n_words"])

    return _source(docs, id_col, text_col).mapInArrow(run, f"doc_id bigint, {_IDENTITY}")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def sketch_buckets(hashes: np.ndarray, sketches: int = SKETCHES, picks: int = PICKS) -> np.ndarray:
    """The bucket of each sketch entry of a text."""
    return order_minhash(kmers(hashes), sketches, picks)


def distinct_texts(docs: DataFrame, id_col: str, text_col: str, sketches: int, picks: int) -> DataFrame:
    """One row per different word sequence with a word, bucketed by id: id, identity, words, sketch buckets, histogram, labelled words (of short texts), text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * 3 + [pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.string()]
        names = ["u1", "u2", "n_words", "buckets", "histogram", "labelled", "text"]
        seen: set[tuple[int, int]] = set()  # copies within a task leave it once
        for batch in pieces(batches, "text", 4_000_000):
            rows = []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                key = _identity(words)
                if not words or key in seen:
                    continue
                if len(seen) > SEEN:
                    seen.clear()
                seen.add(key)
                hashes = word_hashes(words)
                labelled = kmers(hashes, 1).view(np.int64) if len(words) <= SHORT else None
                rows.append((*key, len(words), sketch_buckets(hashes, sketches, picks).view(np.int64), histogram(hashes).tobytes(), labelled, text))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    spark = docs.sparkSession
    rows = _source(docs, id_col, text_col).mapInArrow(run, f"{_IDENTITY}, buckets array<bigint>, histogram binary, labelled array<bigint>, text string")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = ("n_words", "buckets", "histogram", "labelled", "text")
    found = rows.repartition(parts, "u1").groupBy("u1", "u2").agg(*[F.first(c).alias(c) for c in names])
    # the first half of the identity is the id, and with it the bucket; of texts that should share it, all but one get another
    nth = F.row_number().over(Window.partitionBy("u1").orderBy("u2"))
    found = found.select("u1", "u2", nth.alias("nth"), *names).withColumn("id", F.when(F.col("nth") == 1, F.col("u1")).otherwise(F.xxhash64("u1", "u2")))
    return bucketed(found.drop("nth"), "id", parts, "distinct_texts")


def _prefix_words(texts: DataFrame, similarity: float) -> DataFrame:
    """id, word of the short texts: as many of the rarest labelled words of each as its links cannot all lose."""
    words = texts.filter("labelled IS NOT NULL").select("id", "n_words", F.explode("labelled").alias("word"))
    shared = words.groupBy("word").agg(F.count(F.lit(1)).alias("texts"))
    ranked = words.join(shared, "word").groupBy("id", "n_words").agg(F.array_sort(F.collect_list(F.struct("texts", "word"))).alias("ranked"))
    first = F.floor(F.lit(1 - similarity) * F.col("n_words") + 1e-9).cast("int") + 1
    prefix = ranked.select("id", F.explode(F.slice("ranked", F.lit(1), first)).alias("k"))
    return prefix.filter("k.texts > 1").select("id", "k.word")


def _within_bounds(n: np.ndarray, m: np.ndarray, h: np.ndarray, g: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the lower bounds of the edits allow a link, for all pairs of two sets of texts."""
    allowed = np.floor((1 - similarity) * np.maximum(n[:, None], m[None, :]) + 1e-9)
    out = np.abs(n[:, None] - m[None, :]) <= allowed
    for i in np.flatnonzero(out.any(axis=1)):
        at = np.flatnonzero(out[i])
        delta = h[i].astype(np.int32) - g[at].astype(np.int32)
        # every edit removes at most one word and adds at most one
        out[i, at] = np.maximum(np.where(delta > 0, delta, 0).sum(1), np.where(delta < 0, -delta, 0).sum(1)) <= allowed[i, at]
    return out


def _meet(pairs: DataFrame, texts: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The pairs (a, b) with the columns of their texts, as one_* of a and two_* of b. Those of b join their pair; those of a follow once for every
    ``HEAD_ROWS`` of its pairs."""
    heads = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HEAD_ROWS).cast("int").alias("copies"))
    one = texts.select(F.col("id").alias("a"), *[F.col(c).alias(f"one_{c}") for c in columns]).join(heads, "a")
    one = one.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
    dealt = pairs.join(heads, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("copy"))
    two = dealt.join(texts.select(F.col("id").alias("b"), *[F.col(c).alias(f"two_{c}") for c in columns]), "b")
    return two.join(one, ["a", "copy"]).drop("copy")


def _plausible(pairs: DataFrame, texts: DataFrame, similarity: float, name: str) -> DataFrame:
    """The pairs (a, b) that the bounds do not reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                n, m = (part.column(c).to_numpy().astype(np.int64) for c in ("one_n_words", "two_n_words"))
                allowed = np.floor((1 - similarity) * np.maximum(n, m) + 1e-9)
                keep = np.abs(n - m) <= allowed
                h, g = (part.column(c).to_pylist() for c in ("one_histogram", "two_histogram"))
                for i in np.flatnonzero(keep).tolist():
                    keep[i] = least_edits(h[i], g[i]) <= allowed[i]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep))

    return materialize(_meet(pairs, texts, ("n_words", "histogram")).mapInArrow(run, "a bigint, b bigint"), name)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, name: str) -> DataFrame:
    """The pairs (a, b) that align."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, one = None, np.zeros(0, np.uint64)  # pairs of a head follow each other
        for batch in pieces(batches, "two_text", 2_000_000):
            keep = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("one_text"), batch.column("two_text").to_pylist(), strict=True):
                if a != head:
                    head, one = a, word_hashes(words_of(x.as_py()))
                two = word_hashes(words_of(y))
                keep.append(hashed_edits(one, two, allowed_edits(len(one), len(two), similarity)) is not None)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = _meet(pairs, texts, ("text",)).select("a", "b", "one_text", "two_text")
    return materialize(found.mapInArrow(run, "a bigint, b bigint"), name)


def _cross_pairs(members: DataFrame, texts: DataFrame, similarity: float, chunk: int) -> DataFrame:
    """Pairs (a, b) of members (bucket, id, label) of a bucket with different labels that the bounds allow, without listing all pairs."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    rows = members.join(sizes, "bucket").withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    rows = rows.join(texts.select("id", "n_words", "histogram", "buckets"), "id")  # the wide columns travel once

    def pairs(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids, labels, n, own = (part.column(c).to_numpy() for c in ("id", "label", "n_words", "own"))
        counts = part.column("histogram").to_pylist()
        h = np.stack([folded(np.frombuffer(c, np.uint8), BINS) for c in counts])
        low, high = part.column("low")[0].as_py(), part.column("high")[0].as_py()
        x = np.flatnonzero(own == low)
        y = x if low == high else np.flatnonzero(own == high)
        ok = _within_bounds(n[x], n[y], h[x], h[y], similarity) & (labels[x][:, None] != labels[y][None, :])
        i, j = np.nonzero(ok)
        i, j = x[i], y[j]
        # of all sketch buckets that a pair shares, that of its first common entry reports it
        here, entries = part.column("bucket")[0].as_py(), part.column("buckets").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        new = [np.zeros(0, bool)]
        for at in range(0, len(i), 20_000):
            one = entries[i[at : at + 20_000]]
            same = one == entries[j[at : at + 20_000]]
            new.append(~same.any(axis=1) | (one[np.arange(len(one)), same.argmax(axis=1)] == here))
        new = np.flatnonzero(np.concatenate(new)).tolist()
        allowed = np.floor((1 - similarity) * np.maximum(n[i], n[j]) + 1e-9)
        new = [k for k in new if least_edits(counts[i[k]], counts[j[k]]) <= allowed[k]]
        return ids[i[new]], ids[j[new]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of (bucket, low, high) follow each other; the last of a batch may go on in the next."""

        def judged(groups: list[pa.Table]) -> pa.RecordBatch:
            found = [pairs(g) for g in groups]
            a, b = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part]).combine_chunks()
            if not part.num_rows:
                continue
            keys = np.stack([part.column(c).to_numpy().astype(np.int64) for c in ("bucket", "low", "high")])
            starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            held = part.slice(starts[-1])
            yield judged([part.slice(i, j - i) for i, j in zip(starts, starts[1:], strict=False)])
        if held is not None and held.num_rows:
            yield judged([held])

    columns = rows.select("bucket", "low", "high", "own", "id", "label", "n_words", "histogram", "buckets")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = columns.repartition(parts, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    similarity: float = SIMILARITY,
    sketches: int = SKETCHES,
    picks: int = PICKS,
    chunk: int = CHUNK,
) -> DataFrame:
    """doc_id, class_id, class_size (documents) and n_words of every row, its identity (u1, u2) and its class's internal
    label (null for documents without a word)."""
    with small_batches(docs.sparkSession):
        texts = distinct_texts(docs, id_col, text_col, sketches, picks)
    entries = texts.select(F.explode("buckets").alias("bucket"), "id")
    entries = entries.unionByName(_prefix_words(texts, similarity).select(F.xxhash64(F.lit("word"), "word").alias("bucket"), "id"))
    heads = entries.groupBy("bucket").agg(F.min("id").alias("head"), F.max("id").alias("tail")).filter("head < tail").select("bucket", "head")
    members = materialize(entries.join(heads, "bucket"), "bucket-members")  # only buckets with two texts or more
    star = materialize(members.filter("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct(), "star-pairs")
    links = _verified(_plausible(star, texts, similarity, "star-plausible"), texts, similarity, "star-links")
    first = connected_components(links, "star-components")

    # Buckets whose members are in different components; exact for whatever the stars could not see.
    labelled = members.select("bucket", "id").join(first, "id", "left").select("bucket", "id", F.coalesce("label", "id").alias("label"))
    labelled = materialize(labelled, "labelled-members")
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("bucket")
    left = materialize(labelled.join(mixed, "bucket"), "mixed-members")
    # pairs that a star has already judged are not judged again
    more = _cross_pairs(left, texts, similarity, chunk).join(star, ["a", "b"], "left_anti")
    more = _verified(materialize(more, "cross-pairs"), texts, similarity, "cross-links")
    # these few links join whole components: only their labels are connected anew
    ends = more.join(first.toDF("a", "x"), "a", "left").join(first.toDF("b", "y"), "b", "left")
    merged = connected_components(ends.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")), "classes")
    merged = merged.toDF("label", "merged")

    by_text = texts.select("id", "u1", "u2").join(first, "id", "left").withColumn("label", F.coalesce("label", "id"))
    by_text = by_text.join(merged, "label", "left").withColumn("label", F.coalesce("merged", "label")).drop("merged")
    with small_batches(docs.sparkSession):
        rows = materialize(identities(docs, id_col, text_col), "identities")
    copies = rows.filter("n_words > 0").groupBy("u1", "u2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_doc"))
    by_text = materialize(by_text.join(copies, ["u1", "u2"]), "texts-by-class")
    classes = by_text.groupBy("label").agg(F.min("first_doc").alias("class_id"), F.sum("copies").alias("class_size"))
    known = by_text.select("label", "u1", "u2").join(classes, "label")
    worded = rows.filter("n_words > 0").join(known, ["u1", "u2"])
    alone = rows.filter("n_words = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"), "n_words", "u1", "u2", F.lit(None).cast("bigint").alias("label")
    )
    return worded.select("doc_id", "class_id", "class_size", "n_words", "u1", "u2", "label").unionByName(alone)


def class_report(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, representative."""
    found = near_duplicates(docs, **options)
    return found.select("doc_id", "class_id", "class_size", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)).alias("representative"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, all columns unchanged: the smallest id's (of several rows with that id, the
    one with the smallest text identity, once). Documents without a word all stay."""
    found = near_duplicates(docs, id_col, text_col, **options)
    first = found.filter("label IS NOT NULL").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    best = first.groupBy("label", "u1", "u2").agg(F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows"))
    best = best.groupBy("label").agg(F.min(F.struct("u1", "u2", "doc_id", "rows")).alias("k")).select("k.*")
    k1, k2, kid, kn = (fresh(docs, n) for n in ("kept_u1", "kept_u2", "kept_id", "kept_rows"))
    best = materialize(best.toDF(k1, k2, kid, kn), "kept")

    name = fresh(docs, "identity")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("u1", pa.int64()), ("u2", pa.int64()), ("worded", pa.bool_())])
        for batch in pieces(batches, text_col, 4_000_000):
            rows = [(*_identity(w), bool(w)) for w in map(words_of, batch.column(text_col).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([dict(zip(("u1", "u2", "worded"), r, strict=True)) for r in rows], kind)], [*batch.schema.names, name])

    keyed = docs.mapInArrow(run, extended(docs.schema, (name, "struct<u1: bigint, u2: bigint, worded: boolean>")))
    same = (F.col(f"{name}.u1") == F.col(k1)) & (F.col(f"{name}.u2") == F.col(k2)) & F.col(f"`{id_col}`").cast("bigint").eqNullSafe(F.col(kid))
    joined = keyed.join(best, same, "left").filter(F.col(kn).isNotNull() | ~F.col(f"{name}.worded"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = joined.filter(F.coalesce(F.col(kn), F.lit(1)) == 1).select(*columns)
    repeated = joined.filter(F.col(kn) > 1).dropDuplicates([k1, k2, kid]).select(*columns)  # rows given twice
    return once.unionByName(repeated)
