"""Token counts by a Viterbi pass that keeps no tokens.

An Aho-Corasick automaton over a unigram vocabulary gives, for each position
of a word, all pieces that end there, the longest first. Dynamic programming
carries the best score and the number of pieces up to each position. A later,
shorter piece replaces a better-placed one only with a strictly higher score,
which is the tie rule of the tokenizer; a character that no single piece
covers costs the lowest score less ten and counts as its UTF-8 bytes (byte
fallback).

Words begin at each space, as the tokenizer marks them; characters that stand
in no piece cut a word further, as no piece crosses them.

The given model files hold no unigram scores. A piece's score is the logarithm
of its share among the pieces into which the model itself cuts the words of
all documents; the pieces are the model's, less control and byte pieces.
"""

from __future__ import annotations

import collections
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.sources.storage import materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
# Words a task remembers; their counts are found anew beyond it.
REMEMBERED = 200_000
# Added to the count of each piece, so that one that no document needs has a score.
UNSEEN = 0.5


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def vocabulary(path: str = MODEL) -> list[tuple[int, str]]:
    """(id, piece) of a model file, in the order of ids, less what stands for no text of its own: control and byte pieces."""
    model = _model(path)
    other = (model.is_control, model.is_byte, model.is_unknown, model.is_unused)
    return [(i, model.id_to_piece(i)) for i in range(model.get_piece_size()) if not any(f(i) for f in other)]


def piece_counts(df: DataFrame, text: str = "text", model: str = MODEL, remembered: int = REMEMBERED) -> DataFrame:
    """(id, n): how often the model itself uses each piece in the words of all texts.

    A task cuts a word once for as often as it stands in its texts, as far as
    it remembers words.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, words, found = _model(model), collections.Counter(), collections.Counter()

        def settle():
            for ids, n in zip(cut.encode(list(words), num_threads=1), words.values()):
                for i in ids:
                    found[i] += n
            words.clear()

        for batch in batches:
            for value in batch.column(0).to_pylist():
                words.update((value or "").split(" "))
                if len(words) > remembered:
                    settle()
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], names=["id", "n"])

    return df.select(F.col(text)).mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text: str = "text", model: str = MODEL) -> list[tuple[str, float]]:
    """(piece, score) of the model's pieces, by their counts over all texts.

    To the driver comes one count for each piece. Without texts all pieces score alike.
    """
    counts = {r["id"]: r["n"] for r in materialize(piece_counts(df, text, model), "piece-counts").collect()}
    pieces = [(piece, counts.get(i, 0) + UNSEEN) for i, piece in vocabulary(model)]
    total = sum(n for _, n in pieces)
    return [(piece, math.log(n / total)) for piece, n in pieces]


class Counter:
    """Best score and number of pieces of texts under a vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], remembered: int = REMEMBERED):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.singles = {piece for piece, _ in pieces if len(piece) == 1}
        covered = {c for piece, _ in pieces for c in piece}
        self.foreign = re.compile(f"([^{re.escape(''.join(sorted(covered)))}])")
        self.remembered, self.cache = remembered, {}

    def viterbi(self, part: str) -> tuple[float, int]:
        n = len(part)
        score, count = [0.0] + [-math.inf] * n, [0] * (n + 1)
        if self.singles.issuperset(part):
            for last, (length, value) in self.automaton.iter(part):
                end = last + 1
                found = value + score[end - length]
                if found > score[end]:
                    score[end], count[end] = found, count[end - length] + 1
            return score[n], count[n]
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(part):
            ending[last + 1].append(match)
        for end in range(1, n + 1):
            for length, value in ending[end]:
                found = value + score[end - length]
                if found > score[end]:
                    score[end], count[end] = found, count[end - length] + 1
            # A character that no piece covers alone is an unknown one.
            if part[end - 1] not in self.singles and self.unknown + score[end - 1] > score[end]:
                score[end] = self.unknown + score[end - 1]
                count[end] = count[end - 1] + len(part[end - 1].encode())
        return score[n], count[n]

    def word(self, word: str) -> tuple[float, int]:
        known = self.cache.get(word)
        if known is None:
            known = self.viterbi(word)
            if len(self.cache) >= self.remembered:
                self.cache.clear()
            self.cache[word] = known
        return known

    def text(self, text: str | None) -> tuple[float, int]:
        """Score and pieces of a whole text; an empty text has none."""
        if not text:
            return 0.0, 0
        marked = text.replace(" ", SPACE)
        if not marked.startswith(SPACE):
            marked = SPACE + marked
        score, count = 0.0, 0
        for i, part in enumerate(self.foreign.split(marked)):
            if i % 2:
                score, count = score + self.unknown, count + len(part.encode())
                continue
            # What stands before the first mark goes on from the character before.
            head, *rest = part.split(SPACE)
            for word in [head, *[SPACE + w for w in rest]] if head else [SPACE + w for w in rest]:
                found = self.word(word)
                score, count = score + found[0], count + found[1]
        return score, count


def count_tokens(
    df: DataFrame, key: str = "doc_id", text: str = "text", pieces: list[tuple[str, float]] | None = None, model: str = MODEL,
) -> DataFrame:
    """(key, n_tokens, score) for every row; no tokens are added at either end.

    ``pieces`` are (piece, score); without them, the pieces of ``model`` with
    scores by all texts of the frame (``fit``). They are a fixed table and go
    to the tasks. A null or empty text has no tokens and the score zero. Texts are
    counted whole. Repeated rows get equal results; an empty table gives an
    empty result; other columns are not touched.
    """
    kind = df.schema[key].dataType.simpleString()
    pieces = df.sparkSession.sparkContext.broadcast(fit(df, text, model) if pieces is None else pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces.value)
        for batch in batches:
            found = [counter.text(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.float64()),
            ], names=["key", "n_tokens", "score"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, score double").withColumnRenamed("key", key)
