"""Token counts by a linear longest-match automaton.

A word's tokens are the word pieces that greedy longest match gives: the
longest initial piece at its start, then the longest continuation each time.
The pieces form one trie with two roots.  A node that can't go on has a
failure link to the node that the rest of its text leads to once its longest
pieces are popped, and the number of pieces popped on the way is kept with
the link.  A word is then counted in one pass over its bytes, without making
a piece.

The pieces come from a file of byte-level ranks: a token that begins with a
space is an initial piece, one without white space a continuation, and every
single byte that the file has is both.  A word that can't be covered counts
as one unknown token.

Defined results: a null text counts as empty and has no tokens.  Words are
runs of characters other than space, tab, newline, VT, FF and CR, of any
length.  Rows are counted one by one, so repeated rows give repeated
results, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.byte_bpe import files, load_ranks
from headway.llm.tables import ship

KEPT_WORDS = 1 << 18       # counts of short words a task remembers
KEPT_BYTES = 64
_START, _REST = 0, 1       # the trie's roots


class PieceCounter:
    """The automaton over initial and continuation pieces."""

    def __init__(self, initial: Iterable[bytes], rest: Iterable[bytes]) -> None:
        self.child: dict[int, int] = {}     # node * 256 + byte -> node
        ends: set[int] = set()
        n = 2
        for root, pieces in ((_START, initial), (_REST, rest)):
            for piece in sorted(pieces):
                node = root
                for byte in piece:
                    at = node << 8 | byte
                    node = self.child.setdefault(at, n)
                    n += node == n
                ends.add(node)
        self.fail = [-1] * n
        self.popped = [0] * n
        after: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for at, node in self.child.items():
            after[at >> 8].append((at & 255, node))
        queue = deque((_START, _REST))
        while queue:
            above = queue.popleft()
            for byte, node in after[above]:
                queue.append(node)
                if node in ends:
                    self.fail[node], self.popped[node] = _REST, 1
                    continue
                link, popped = self.fail[above], self.popped[above]
                while link >= 0 and (link << 8 | byte) not in self.child:
                    popped += self.popped[link]
                    link = self.fail[link]
                if link >= 0:
                    self.fail[node] = self.child[link << 8 | byte]
                    self.popped[node] = popped

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 (unknown) if it can't be covered."""
        child, fail, popped = self.child, self.fail, self.popped
        node, n = _START, 0
        for byte in word:
            there = child.get(node << 8 | byte)
            while there is None:
                link = fail[node]
                if link < 0:
                    return 1
                n += popped[node]
                node = link
                there = child.get(node << 8 | byte)
            node = there
        while node != _REST:
            if fail[node] < 0:
                return 1
            n += popped[node]
            node = fail[node]
        return n


def pieces(ranks: Iterable[bytes]) -> tuple[set[bytes], set[bytes]]:
    """(initial, continuation) pieces of a byte-level vocabulary."""
    ranks = list(ranks)
    single = {t for t in ranks if len(t) == 1}
    initial = {t[1:] for t in ranks if t[:1] == b" " and len(t) > 1 and t.split() == [t[1:]]}
    return initial | single, {t for t in ranks if t.split() == [t]} | single


@lru_cache(maxsize=2)
def counter(path: str) -> PieceCounter:
    """The automaton of a vocabulary file, once per worker process."""
    return PieceCounter(*pieces(load_ranks(path)))


def counts(text: Column, path: str | None = None) -> Column:
    """A struct (n_words, n_tokens) for each text."""
    place, _ = files(path, "")

    @F.pandas_udf("n_words long, n_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = counter(place)
        known: dict[bytes, int] = {}

        def tokens(word: bytes) -> int:
            n = known.get(word)
            if n is None:
                n = automaton.count(word)
                if len(word) <= KEPT_BYTES:
                    if len(known) >= KEPT_WORDS:
                        known.clear()
                    known[word] = n
            return n

        for batch in batches:
            rows = np.zeros((len(batch), 2), np.int64)
            for i, text in enumerate(batch):
                words = (text or "").encode().split()
                rows[i] = len(words), sum(map(tokens, words))
            yield pd.DataFrame(rows, columns=["n_words", "n_tokens"])

    return counted(text)


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 path: str | None = None) -> DataFrame:
    """One row per document: the id, n_words and n_tokens."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).alias("__id"), counts(F.col(text_col), path).alias("__c")
                       ).select(F.col("__id").alias(id_col), "__c.n_words", "__c.n_tokens")
