import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from headway.llm import byte_bpe
from headway.llm.token_counts import PieceCounter, counter, pieces, token_counts

from .conftest import LONG, ODD_ROWS


def brute(word, initial, rest):
    n, at = 0, 0
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1)
                     if word[at:at + k] in (rest if at else initial)), 0)
        if not size:
            return 1
        at += size
        n += 1
    return n


@pytest.mark.parametrize("seed", range(12))
def test_counts_match_greedy_longest_match(seed):
    rng = random.Random(seed)

    def some(n, size):
        return {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, size))) for _ in range(n)}
    initial, rest = some(8, 5), some(8, 5)
    automaton = PieceCounter(initial, rest)
    for _ in range(400):
        word = bytes(rng.choice(b"abcd" if seed % 3 == 0 else b"abc") for _ in range(rng.randint(1, 14)))
        assert automaton.count(word) == brute(word, initial, rest), (word, initial, rest)


def test_documents_match_another_library(spark):
    path = byte_bpe.files(None, None)[0]
    initial, rest = pieces(byte_bpe.load_ranks(path))
    shown = byte_bpe.byte_characters()

    def name(piece):
        return "".join(shown[b] for b in piece)
    vocab = {"[UNK]": 0}
    for piece in sorted(initial):
        vocab.setdefault(name(piece), len(vocab))
    for piece in sorted(rest):
        vocab.setdefault("\u0001" + name(piece), len(vocab))
    other = Tokenizer(models.WordPiece(vocab, unk_token="[UNK]", continuing_subword_prefix="\u0001",
                                       max_input_chars_per_word=1 << 30))
    other.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts(docs).collect():
        words = texts[r.doc_id].encode().split()
        assert r.n_words == len(words)
        assert r.n_tokens == len(other.encode(" ".join(map(name, words))).ids)


def test_long_words_take_linear_time():
    automaton = counter(byte_bpe.files(None, None)[0])
    assert automaton.count(b"ab" * 200_000) > 1000
    assert automaton.count(bytes(range(128, 256)) * 50) >= 1


def test_odd_rows(documents):
    initial, rest = pieces(byte_bpe.load_ranks(byte_bpe.files(None, None)[0]))
    got = sorted(map(repr, map(tuple, token_counts(documents(ODD_ROWS, extra=True)).collect())))
    want = []
    for i, t, *_ in ODD_ROWS:
        words = (t or "").encode().split()
        want.append(repr((i, len(words), sum(brute(w, initial, rest) for w in words))))
    assert got == sorted(want)
    assert token_counts(documents([])).collect() == []
    assert len(LONG) > 100_000
