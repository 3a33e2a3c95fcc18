import math
import os
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from medloom.llm import tokens
from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.MODEL), reason="needs the vocabulary file")

TEXTS = [
    "", " ", "a", "Hello world", "  two  spaces ", "line\nbreak\ttab", "ünïcödé straße 東京 😀😀 x", "<s> <0x0A> <unk>", "▁marked",
    "a" * 300, "\n\n\n", "1234567890 3.14 1,000", "don't re-enter", "​  nbsp", "é" * 50, "x" * 5 + " " * 7 + "y",
]


SENTENCES = ["the words of a text are cut into pieces, and pieces are counted", "El texto se corta en piezas.", "über die Straße\nund zurück", "a  b", "東京"]


def own_counts(texts):
    """How often the model itself uses each piece, word by word."""
    cut = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    return Counter(i for t in texts for w in (t or "").split(" ") for i in cut.encode(w))


@pytest.fixture(scope="module")
def pieces():
    counts = own_counts(SENTENCES)
    found = [(p, counts[i] + tokens.UNSEEN) for i, p in tokens.vocabulary()]
    total = sum(n for _, n in found)
    return [(p, math.log(n / total)) for p, n in found]


class Reference:
    """Counts by a unigram tokenizer; what is in no piece counts as its bytes."""

    def __init__(self, pieces):
        self.pieces = {p for p, _ in pieces}
        # The unknown piece has a name that no text holds, and the lowest score, which it must not change.
        scored = [("\uffff" * 9, min(s for _, s in pieces)), *pieces]
        self.model = Tokenizer(models.Unigram(scored, unk_id=0, byte_fallback=False))
        self.model.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)

    def count(self, text):
        return sum(1 if t in self.pieces else len(t.encode()) for t in self.model.encode(text, add_special_tokens=False).tokens)


@pytest.fixture(scope="module")
def reference(pieces):
    return Reference(pieces)


def random_texts(n=400):
    rng = random.Random(8)
    return ["".join(rng.choice("abcdeé the ing\n東😀.,<>0x1") for _ in range(rng.randrange(60))) for _ in range(n)]


def test_counts_as_the_tokenizer(pieces, reference):
    counter = tokens.Counter(pieces)
    for text in TEXTS + random_texts():
        assert counter.text(text)[1] == reference.count(text), repr(text)


def test_ties_prefer_the_longer_piece():
    """Equal scores: the first found, which starts first, stays."""
    reference = Tokenizer(models.Unigram([("<unk>", 0.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("abab", -4.0)], unk_id=0, byte_fallback=False))
    counter = tokens.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("abab", -4.0)])
    for text in ("▁ab", "▁abab", "▁abb", "▁aab"):
        assert counter.viterbi(text)[1] == len(reference.encode(text).ids)


def test_table(docs, pieces, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (None, "a b"), (1, " "), (60, "word " * 30_000)]
    found = sorted(((r.doc_id, r.n_tokens) for r in tokens.count_tokens(docs(rows, clash=True), pieces=pieces).collect()), key=str)
    assert found == sorted(((k, reference.count(t or "")) for k, t in rows), key=str)
    # Scores by the texts themselves.
    texts = [t for _, t in rows] + SENTENCES * 3
    counts = own_counts(texts)
    assert {r["id"]: r.n for r in tokens.piece_counts(docs(list(enumerate(texts))), remembered=5).collect()} == counts
    fitted = tokens.fit(docs(list(enumerate(texts))))
    total = sum(counts[i] + tokens.UNSEEN for i, _ in tokens.vocabulary())
    assert fitted == [(p, pytest.approx(math.log((counts[i] + tokens.UNSEEN) / total))) for i, p in tokens.vocabulary()]
    own = Reference(fitted)
    found = tokens.count_tokens(docs(list(enumerate(texts)))).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in found) == [(i, own.count(t or "")) for i, t in enumerate(texts)]
    assert tokens.count_tokens(docs([])).collect() == []


def test_control_and_byte_pieces_match_no_text():
    held = {p for _, p in tokens.vocabulary()}
    assert not held & {"<unk>", "<s>", "</s>", "<0x0A>", "<0xFF>"} and {"▁the", "<", ">"} <= held


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")
def test_counts_are_near_those_of_the_model(spark):
    """Within a twentieth of the pieces into which the model itself cuts all documents."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    cut = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    own = sum(len(cut.encode(r.text or "")) for r in df.collect())
    assert abs(tokens.count_tokens(df).agg({"n_tokens": "sum"}).first()[0] - own) < 0.05 * own


def test_forgetting_changes_nothing(pieces):
    few, many = tokens.Counter(pieces, remembered=3), tokens.Counter(pieces)
    for text in random_texts(50):
        assert few.text(text) == many.text(text)
