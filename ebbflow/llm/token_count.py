"""Token counts of a unigram tokenizer: Viterbi that keeps scores and counts only.

An Aho-Corasick automaton over the vocabulary lists all pieces that end at each place of a text. Dynamic programming
carries two numbers per place, the best score of a segmentation up to it and that segmentation's number of pieces;
no back pointers, no pieces. The tie rules are those of the tokenizers library's Unigram model:

* pieces are tried by their start, from left to right, and replace the best so far only with a higher score, so among
  equal scores the earliest start (the longest last piece) wins;
* where no piece of one character starts, an unknown edge over that character is tried after all pieces that end
  there, at the lowest score of the vocabulary less 10;
* consecutive unknown characters are one unknown piece; with byte fallback they count one piece per UTF-8 byte.

Texts are normalised as the vocabulary expects: spaces become U+2581, one is put in front. Where no piece has U+2581 after
another character, no piece spans the start of a word, so words are segmented apart and a word's result is kept in a
bounded table: natural text repeats its words. Otherwise whole texts go through the automaton.

Scale: one narrow pass in small Arrow batches. The vocabulary, a file of bounded size, is loaded once per Python worker.
Time is linear in the text (a place has at most as many matches as the longest piece has characters); memory is a few
numbers per character of one text.

Defined results: null text counts as the empty text, which has no token (nothing is put in front of it). Ties follow the
rules above; repeated rows each give a row; an empty table gives none. Texts of any length are counted whole. Columns other than the id and the text are not read,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.common import pieces

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_WORDS = 1_000_000


def read_vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) of a SentencePiece model file, in id order, and the unknown id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


def normalise(text: str) -> str:
    return SPACE + text.replace(" ", SPACE) if text else ""


class Counter:
    """Best score and piece count of texts under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float]], unknown: int, byte_fallback: bool = True):
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocabulary):
            if piece:  # a text may spell the unknown piece itself
                self.automaton.add_word(piece, (len(piece), score, i == unknown))
        self.names = {piece for piece, _ in vocabulary}
        self.automaton.make_automaton()
        self.lowest = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in self.names for b in range(256))
        self.single = {piece for piece in self.names if len(piece) == 1}
        # Apart from each other, words give the same sums only if the sums are exact.
        exact = all(float(score).is_integer() for _, score in vocabulary)
        self.by_word = exact and SPACE in self.single and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.names)
        self.known: dict[str, tuple[float, int]] = {}

    def _unknown_tokens(self, run: str) -> int:
        return 1 if not self.bytes or run in self.names else len(run.encode("utf-8", "surrogatepass"))

    def segment(self, text: str) -> tuple[float, int]:
        """(score, pieces) of one normalised text."""
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        run = [-1] * (n + 1)  # where the unknown run that ends here starts
        matches = self.automaton.iter(text)
        following = next(matches, None)
        for end in range(1, n + 1):
            best, before, start = None, 0, -1
            while following is not None and following[0] == end - 1:  # longest first
                length, gain, is_unknown = following[1]
                candidate = score[end - length] + gain
                if best is None or candidate > best:
                    best, before = candidate, end - length
                    start = (run[before] if run[before] >= 0 else before) if is_unknown else -1
                following = next(matches, None)
            if text[end - 1] not in self.single:
                candidate = score[end - 1] + self.lowest
                if best is None or candidate > best:
                    best, before = candidate, end - 1
                    start = run[before] if run[before] >= 0 else before
            score[end], run[end] = best, start
            count[end] = count[before] + 1 if start < 0 else count[start] + self._unknown_tokens(text[start:end])
        return score[n], count[n]

    def count(self, text: str) -> tuple[float, int]:
        """(score, pieces) of a raw text."""
        text = normalise(text)
        if not self.by_word:
            return self.segment(text)
        total, tokens, known = 0.0, 0, self.known
        for word in _WORDS.findall(text):
            found = known.get(word)
            if found is None:
                found = self.segment(word)
                if len(known) >= CACHE_WORDS:
                    known.clear()
                known[word] = found
            total += found[0]
            tokens += found[1]
        return total, tokens


_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One per Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(*read_vocabulary(path))
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, n_tokens and the best segmentation's score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model).count
        for batch in pieces(batches, "text", 4_000_000):
            texts = batch.column("text").to_pylist()
            found = [count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[0] for f in found], pa.float64()),
                ],
                ["doc_id", "n_chars", "n_tokens", "score"],
            )

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n_chars bigint, n_tokens bigint, score double")
