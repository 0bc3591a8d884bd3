"""Byte-level BPE encoding and decoding.

Texts go through the ``tokenizers`` library in Arrow batches.  Its model is
made from a file of ranks (one base64 token and its rank a line): a token's
merge is the last pair that is left when the merges of lower rank have been
applied to its bytes.  Texts are split by ``pattern`` first and each match
is encoded separately, so its ids don't depend on what is around it.  Most
matches come again, so texts are cut by the ``regex`` module, which is faster
than the library's splitting, and the library encodes the distinct matches
that a worker doesn't remember.  Texts go to the library whole if they have a
character that the two take differently, if the pattern isn't the public one
or a byte has no rank, and for some slices after one whose matches were
mostly new.  The byte-to-character table maps every byte to a printable
character, as byte-level BPE does; offsets are found from the byte lengths of
the ids and the text's own character bounds, so a token that begins or ends
inside a character is known as such.

Decoding looks each id up in the reversed byte table and joins the bytes, so
characters that are split between tokens come together again.

Texts are encoded in slices of about ``SLICE_CHARS`` characters, so memory is
bounded by a slice or one text, whichever is longer, and the matches that are
remembered.

Defined results: a null text counts as empty and has no tokens.  Special
tokens are not used, so their names in a text are ordinary text.  Each row
is encoded by itself, so ties and repeated rows are no special case, and an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.tables import ship

VOCABULARY = "byte_bpe_50k.tiktoken"
SLICE_CHARS = 1 << 18
KEPT_MATCHES = 1 << 18    # at most twice as many a worker remembers
KEPT_CHARS = 64
PAUSE = 16                # slices encoded whole after one whose matches were mostly new


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: bytes that print
    stand for themselves, the others for characters from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


def merge_of(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The pair whose merge makes ``token``."""
    parts = [token[i:i + 1] for i in range(len(token))]
    own = ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, own), i) for i, (a, b) in
                       enumerate(zip(parts, parts[1:])))
        if rank >= own:
            raise ValueError(f"no pair of lower ranks makes the token {token!r}")
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class Codec:
    """The library's tokenizers for a file of ranks, and what decoding needs."""

    def __init__(self, path: str, pattern: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs the tasks
        import public_tokenizers
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = load_ranks(path)
        shown = byte_characters()
        name = {t: "".join(shown[b] for b in t) for t in ranks}
        order = sorted(ranks, key=ranks.get)
        merges = [tuple(name[p] for p in merge_of(t, ranks)) for t in order if len(t) > 1]
        model = models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges)
        self.split = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.texts, self.matches = Tokenizer(model), Tokenizer(model)
        self.texts.pre_tokenizer = pre_tokenizers.Sequence([
            self.split, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # No byte is shown as a space, and no text has the byte 255.
        self.matches.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.shown = {**dict(enumerate(shown)), 255: " "}
        self.table = np.empty(max(ranks.values()) + 1, object)
        self.table[:] = b""
        for token, rank in ranks.items():
            self.table[rank] = token
        self.sizes = np.array([len(t) for t in self.table], np.int64)
        self.inside = np.array([0x80 <= t[0] < 0xC0 if t else False for t in self.table])
        self.cut = None
        if pattern == public_tokenizers.PATTERN and all(bytes([b]) in ranks for b in range(256)):
            self.cut = regex.compile(pattern).findall
        self.same: set[str] = set()          # characters that both patterns take alike
        self.odd: set[str] = set()
        self.known: dict[str, bytes] = {}    # ids of matches
        self.older: dict[str, bytes] = {}
        self.pause = 0                       # slices that go to the library whole

    def cut_alike(self, text: str) -> bool:
        """Is the text cut by ``regex`` as by the library, whose Unicode may
        be of another version?  The pattern tells letters, numbers, white
        space and other characters apart; one that isn't white space joins
        what is before it just if that is of its kind."""
        chars = set(text)
        if chars <= self.same:
            return True
        for char in chars - self.same - self.odd:
            alike = all(self.cut(x + char) == [p for p, _ in self.split.pre_tokenize_str(x + char)]
                        for x in "a1!")
            (self.same if alike else self.odd).add(char)
        return chars <= self.same

    def learn(self, matches: set[str]) -> list[str]:
        """Have the ids of all ``matches`` among the known; returns the new
        ones.  The library encodes them in one go, and the bytes of their ids
        tell where each begins."""
        new = []
        for match in matches:
            if match not in self.known:
                ids = self.older.get(match)
                if ids is None:
                    new.append(match)
                else:
                    self.known[match] = ids
        if not new:
            return new
        raw = [m.encode() for m in new]
        names = b"\xff".join(raw).decode("latin-1").translate(self.shown)
        ids = ids_of(self.matches, [names])[0]
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(r) for r in raw])) + 1
        ids, ends = ids.tobytes(), (4 * ends).tolist()
        self.known.update(zip(new, [ids[a:b] for a, b in zip([0, *ends], ends)]))
        return new

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text of a slice."""
        if self.cut is None or self.pause:
            self.pause = max(self.pause - 1, 0)
            yield from ids_of(self.texts, texts)
            return
        cuts = [self.cut(t) if self.cut_alike(t) else None for t in texts]
        whole = iter(ids_of(self.texts, [t for t, c in zip(texts, cuts) if c is None]))
        new = self.learn(set(chain.from_iterable(c for c in cuts if c)))
        known = self.known
        for cut in cuts:
            yield (next(whole) if cut is None else
                   np.frombuffer(b"".join(map(known.__getitem__, cut)), "<u4"))
        for match in new:
            if len(match) > KEPT_CHARS:
                del known[match]
        if len(known) >= KEPT_MATCHES:
            self.known, self.older = {}, known
        if 2 * sum(map(len, new)) > sum(map(len, texts)):
            self.pause = PAUSE


def ids_of(tokenizer, texts: list[str]) -> list[np.ndarray]:
    return [np.array(found.ids, "<u4")
            for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """Once per worker process."""
    return Codec(path, pattern)


def slices(texts: list[str], chars: int | None = None) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``chars``, or SLICE_CHARS, characters."""
    out, size = [], 0
    for text in texts:
        out.append(text)
        size += len(text)
        if size >= (chars or SLICE_CHARS):
            yield out
            out, size = [], 0
    if out:
        yield out


def encode_texts(texts: list[str], path: str, pattern: str) -> Iterator[np.ndarray]:
    for part in slices(texts):
        yield from codec(path, pattern).encode(part)


def texts_of(batch: pd.Series) -> list[str]:
    return ["" if t is None else t for t in batch]


def decode_ids(ids: np.ndarray, path: str, pattern: str) -> bytes:
    return b"".join(codec(path, pattern).table[ids])


def character_offsets(text: str, ids: np.ndarray, path: str, pattern: str):
    """(start, end, split): the characters each token touches, and whether
    it begins or ends inside one."""
    raw = np.frombuffer(text.encode(), np.uint8)
    sizes = codec(path, pattern).sizes[ids]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    first = np.append((raw & 0xC0) != 0x80, True)    # byte begins a character
    char = np.append(np.cumsum(first[:-1]) - 1, first[:-1].sum())
    return char[starts], char[ends - 1] + 1, ~(first[starts] & first[ends])


def split_tokens(ids: np.ndarray, path: str, pattern: str) -> int:
    """How many tokens begin or end inside a character: those whose first
    byte, or the next one's, is not a character's first."""
    inside = codec(path, pattern).inside[ids]
    return int((inside | np.append(inside[1:], False)).sum()) if len(ids) else 0


def files(path: str | None, pattern: str | None) -> tuple[str, str]:
    import public_tokenizers
    return path or public_tokenizers.path(VOCABULARY), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, text_col: str = "text", out: str = "ids", path: str | None = None,
           pattern: str | None = None, splits: bool = True) -> DataFrame:
    """``docs`` plus ``out``: ids, and for each token the characters
    [start, end) it touches and, with ``splits``, whether it splits one.
    Equal texts of one slice, and a text that goes on into the next slices,
    are encoded once."""
    ship(docs.sparkSession)
    place, split_by = files(path, pattern)
    names = ["ids", "start", "end"] + ["splits"] * splits
    kind = "ids array<int>, start array<int>, end array<int>" + ", splits array<boolean>" * splits

    @F.pandas_udf(kind)
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Ids and offsets are several times a text's size, so they leave the
        # worker slice by slice; only their order has to be the input's.
        rows: dict[str, tuple] = {}
        for batch in batches:
            for texts in slices(texts_of(batch)):
                rows = {t: rows[t] for t in texts[:1] if t in rows}
                distinct = [t for t in dict.fromkeys(texts) if t not in rows]
                for text, ids in zip(distinct, encode_texts(distinct, place, split_by)):
                    start, end, cut = character_offsets(text, ids, place, split_by)
                    rows[text] = (ids.astype("int32"), start.astype("int32"),
                                  end.astype("int32"), cut)[:len(names)]
                yield pd.DataFrame([rows[t] for t in texts], columns=names)

    return docs.withColumn(out, encoded(F.col(text_col)))


def decoded(ids: Column, path: str | None = None, pattern: str | None = None) -> Column:
    """The bytes that an array of ids stands for."""
    place, split_by = files(path, pattern)

    @F.pandas_udf("binary")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([b"" if i is None else
                             decode_ids(np.asarray(i, np.int64), place, split_by)
                             for i in batch], dtype=object)

    return joined(ids)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row per document: encoded, decoded from the ids again, and both
    digested where they arise, so that no ids leave the worker."""
    ship(docs.sparkSession)
    place, split_by = files(path, pattern)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = texts_of(batch)
            rows = []
            for ids in encode_texts(texts, place, split_by):
                back = decode_ids(ids, place, split_by)
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                             hashlib.sha256(back).hexdigest(),
                             split_tokens(ids, place, split_by)))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256",
                                              "n_split"])

    return docs.select(F.col(id_col), digests(F.col(text_col)).alias("d")).select(
        id_col, "d.n_tokens", "d.ids_sha256", "d.decoded_sha256", "d.n_split")
