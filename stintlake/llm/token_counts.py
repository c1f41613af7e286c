"""Token counts of a unigram tokenizer by a Viterbi pass that keeps scores and counts only.

Every space becomes the mark U+2581, one is put in front of the text, and the text is cut before each run of marks: no
piece of the vocabulary has a mark behind another character, so the best segmentation of a text is that of its chunks, and
equal chunks are counted once. Inside a chunk an Aho-Corasick automaton names all vocabulary pieces that end at each
character; the dynamic programme keeps, for each position, the best score and the number of pieces that reach it, and no
segmentation.

Tie rules are those of the unigram model of the public ``tokenizers`` library: positions are entered from the left and a
later way into a position replaces an earlier one only if its score is greater, so of equal scores the longest last piece
wins. A position that no single character of the vocabulary leaves gets an unknown piece, ten below the least score. Unknown
pieces side by side are one, and count as the bytes of their characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import small_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Chunks whose counts a worker keeps; when full it starts anew.
REMEMBERED = 400_000
#: Characters from which a chunk is counted without keeping all its positions.
LONG = 10_000
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceCounter:
    """Counts the pieces of texts under a unigram vocabulary of ``(piece, score)``."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        scores: dict[str, float] = {}
        for piece, score in vocabulary:
            if piece:
                scores[piece] = score
        if any(MARK in piece.lstrip(MARK) for piece in scores):
            raise ValueError("a piece with a mark behind another character crosses the chunks")
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.longest = max((len(piece) for piece in scores), default=1)
        self.single = {piece for piece in scores if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if scores:
            self.automaton.make_automaton()
        self.known: dict[str, int] = {}

    def _best(self, chunk: str) -> int:
        if not self.single.issuperset(chunk):
            return self._best_with_unknown(chunk)
        n, lowest = len(chunk), float("-inf")
        score, count = [0.0] + [lowest] * n, [0] * (n + 1)
        for last, (size, piece_score) in self.automaton.iter(chunk):  # of those that end here the longest comes first
            start = last + 1 - size
            reached = score[start] + piece_score
            if reached > score[last + 1]:
                score[last + 1], count[last + 1] = reached, count[start] + 1
        return count[n]

    def _best_with_unknown(self, chunk: str) -> int:
        n, lowest = len(chunk), float("-inf")
        score, count = [0.0] + [lowest] * n, [0] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if len(self.automaton):
            for last, match in self.automaton.iter(chunk):
                ends[last].append(match)
        for end, c in enumerate(chunk, 1):
            for size, piece_score in ends[end - 1]:
                reached = score[end - size] + piece_score
                if reached > score[end]:
                    score[end], count[end] = reached, count[end - size] + 1
            reached = score[end - 1] + self.unknown
            if c not in self.single and reached > score[end]:
                score[end], count[end] = reached, count[end - 1] + len(c.encode("utf-8", "surrogatepass"))
        return count[n]

    def _best_of_long(self, chunk: str) -> int:
        """As above, looking back over the longest piece only."""
        size, lowest, unknown = self.longest + 1, float("-inf"), self.unknown
        score, count = [lowest] * size, [0] * size
        score[0] = 0.0
        matches = self.automaton.iter(chunk) if len(self.automaton) else iter(())
        match = next(matches, None)
        for last, c in enumerate(chunk):
            best, pieces = lowest, 0
            while match is not None and match[0] == last:
                n, piece_score = match[1]
                start = (last + 1 - n) % size
                if score[start] + piece_score > best:
                    best, pieces = score[start] + piece_score, count[start] + 1
                match = next(matches, None)
            if c not in self.single and score[last % size] + unknown > best:
                best, pieces = score[last % size] + unknown, count[last % size] + len(c.encode("utf-8", "surrogatepass"))
            score[(last + 1) % size], count[(last + 1) % size] = best, pieces
        return count[len(chunk) % size]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for chunk in (m.group() for m in _CHUNK.finditer(MARK + text.replace(" ", MARK))):
            n = known.get(chunk)
            if n is None:
                n = self._best(chunk) if len(chunk) < LONG else self._best_of_long(chunk)
                if len(known) >= REMEMBERED:
                    known.clear()
                if len(chunk) < 256:
                    known[chunk] = n
            total += n
        return total


def read_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, without its control and byte pieces.

    Scores are the file's own; where it ranks pieces by merge order, they are whole numbers and ties are common.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [(model.id_to_piece(i), model.get_score(i)) for i in plain]


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    return PieceCounter(read_vocabulary(path))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and ``n_tokens``. Null and empty texts have none; repeated rows are counted each, equal scores by the
    library's rules. Texts are counted whole; one without spaces takes no more memory than its characters and the longest
    piece. Other columns, whatever their names, are not looked at; an empty table has no rows.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter(path).count
        for texts in batches:
            yield pd.Series(np.fromiter((count(t) for t in texts), np.int64, len(texts)))

    return docs.select(F.col(id_col).alias("doc_id"), run(F.col(text_col)).alias("n_tokens"))
