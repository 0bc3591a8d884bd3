"""Token ids in ORC files.

Documents are dealt by range of (id, hash of the text), sorted, encoded and
written as one ORC file a task, so the files in their order, and the rows in
each, hold the documents in ascending order of their ids.  A row has the id,
its file's number, the number of ids before it in the file, the number of its
own ids and the ids.  ORC packs integers by run length; each file has stripes
that are read apart, a row index of ``INDEX_ROWS`` rows with the least and
largest document id, and Bloom filters on the document id, so that a search
for some documents reads only the row groups that may hold them.  Beside the
files, the table ``files`` has one row for each: rows, ids, least and largest
document id and the number of ids in all files before it.  A document's start
is its file's plus its own, so no row is moved to find it.

Ids come from the ``tokenizers`` library.  Where the vocabulary's normalizer
and pre-tokenizer are the ones ``parts_of`` knows, no token reaches over
white space.  Arrow cuts a slice of texts into words and numbers the distinct
ones, and each of those is encoded once for a worker: words of plain characters
are cut by the vocabulary's own pattern, and each distinct part goes to the
library's model (letters, alone or before a mark, are one part and need no
pattern); other words go to the library whole, and so does a text that holds
the name of a special token.

Defined results: a null text counts as empty and has the end id alone.  Rows
with a null id come first; rows of one id are ordered by the hash of their
text, then by the text, and repeated rows are repeated.  Many rows of one id,
or of one id and text, are spread over files.  Texts of any length are
encoded whole; memory is bounded by a slice of texts or the longest text.  An
empty table gives no rows.  Other columns are left out, whatever their names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.byte_bpe import byte_characters, slices
from headway.llm.tables import ship, shuffle_partitions

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
INDEX_ROWS = 1000
ORC_OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": str(INDEX_ROWS),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(64 << 20),
    "compression": "zstd",
}
KEPT_WORDS = 1 << 18      # words to be cut, and parts of words, whose ids a worker remembers
KEPT_PARTS = 1 << 19
KEPT_CHARS = 64
SLICE_CHARS = 1 << 23     # of the texts whose distinct words are numbered together

#: Characters that stay as they are under NFC, whose lower case depends on
#: no other character, and whose white space is space, tab, LF, VT, FF, CR.
_PLAIN = re.compile(r"[\t-\r -~À-ɏ]*")
#: Marks that often end a word.
_MARKS = ".,;:!?"


class _Kept(dict):
    """Values by key, each made once.  At least ``kept`` and at most twice as
    many are remembered: those that weren't asked for lately go."""

    def __init__(self, make, kept: int) -> None:
        self.make, self.kept = make, kept
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= KEPT_CHARS:
            if len(self) >= self.kept:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit integers) by a vocabulary file."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs the tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as held:
            spec = json.load(held)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.cut = parts_of(spec)
        self.by_word = self.cut is not None and not any(t.split() != [t] for t in self.special)
        # Are letters one part, and a mark after them another?
        letters = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c == c.lower()
                          and _PLAIN.fullmatch(c))
        self.letters = self.by_word and all(
            self.cut(x) == [x] and self.cut(x + c) == [x, c] for c in _MARKS for x in ("ab", letters))
        self.shown = dict(enumerate(byte_characters()))
        self.parts = _Kept(self._part, KEPT_PARTS)
        self.cuts = _Kept(self._cut, KEPT_WORDS)
        self.words = _Kept(self._word, KEPT_WORDS)

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        # ASCII letters stand for themselves among byte-level characters.
        name = part if part.isascii() and part.isalpha() else (
            part.encode().decode("latin-1").translate(self.shown))
        ids = [t.id for t in self.tokenizer.model.tokenize(name)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _cut(self, word: str) -> bytes:
        return b"".join([self.parts[p] for p in self.cut(word)])

    def _plain(self, word: str) -> bytes:
        if self.letters:
            if word.isalpha():
                return self.parts[word]
            if word[-1:] in _MARKS and word[:-1].isalpha():
                return self.parts[word[:-1]] + self.parts[word[-1]]
        return self.cuts[word]

    def _word(self, word: str) -> bytes:
        return self._plain(word.lower()) if _PLAIN.fullmatch(word) else self._whole(word)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text of a slice."""
        out: list = [None] * len(texts)
        plain, other = [], []
        for i, text in enumerate(texts):
            if not self.by_word or any(t in text for t in self.special):
                out[i] = self._whole(text)
            else:
                (plain if _PLAIN.fullmatch(text) else other).append(i)
        for places, ids_of in ((plain, self._plain), (other, self.words.__getitem__)):
            held = [texts[i].lower() if places is plain else texts[i] for i in places]
            # ASCII white space: all there is in plain texts, and within no character.
            words = pc.ascii_split_whitespace(pa.array(held, pa.large_string()))
            each = words.flatten().dictionary_encode()
            ids = np.array([*map(ids_of, each.dictionary.to_numpy(zero_copy_only=False)), None],
                           object)
            numbers, bounds = each.indices.to_numpy(), words.offsets.to_numpy()
            for i, begin, end in zip(places, bounds, bounds[1:]):
                out[i] = b"".join(ids[numbers[begin:end]].tolist())
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def parts_of(spec: dict):
    """The function that cuts a normalized word into parts as the vocabulary
    does, if its text is normalized by NFC, white space to spaces and lower
    case, and cut by a pattern that matches no white space into byte-level
    parts; else None."""
    import regex

    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if ([s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]
            or (steps[1]["pattern"], steps[1]["content"]) != ({"Regex": r"\s+"}, " ")
            or [c["type"] for c in cuts] != ["Split", "ByteLevel"]
            or (cuts[0]["behavior"], cuts[0]["invert"]) != ("Removed", True)
            or (cuts[1]["add_prefix_space"], cuts[1]["use_regex"]) != (False, False)
            or spec.get("post_processor") or spec["model"]["type"] != "BPE"):
        return None
    found = regex.compile(cuts[0]["pattern"]["Regex"])
    return None if any(found.search(c) for c in " \t\n\v\f\r") else found.findall


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """Once per worker process."""
    return Encoder(path)


_ROWS = pa.schema([("doc_id", pa.int64()), ("file", pa.int32()), ("before", pa.int64()),
                   ("n_tokens", pa.int32()), ("ids", pa.list_(pa.int32()))])


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int | None = END_ID, vocabulary: str | None = None,
                 files: int | None = None) -> DataFrame:
    """Write the ids of every document, each followed by ``end_id`` if there
    is one, to ORC files in ``folder``, replacing what is there; returns the
    table of files.  ``files`` is the number of files, the session's number
    of shuffle partitions unless given."""
    spark = docs.sparkSession
    ship(spark)
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path(VOCABULARY)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        coder = encoder(vocabulary)
        before = 0
        for batch in batches:
            at = 0
            for texts in slices([t or "" for t in batch.column("text").to_pylist()], SLICE_CHARS):
                ids = [i + end for i in coder.encode_all(texts)]
                sizes = np.array([len(i) // 4 for i in ids], np.int64)
                ends = np.cumsum(sizes)
                flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]),
                                             [None, pa.py_buffer(b"".join(ids))])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(at, len(texts)),
                    pa.array(np.full(len(texts), number, np.int32)),
                    pa.array(before + ends - sizes),
                    pa.array(sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), flat),
                ], schema=_ROWS)
                at += len(texts)
                before += int(ends[-1])

    n = files or shuffle_partitions(spark)
    # Rows that are equal throughout are told apart by their place in the
    # input, only to spread them; which of them is where makes no difference.
    dealt = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash"),
                         F.monotonically_increasing_id().alias("place"))
             .repartitionByRange(n, F.asc_nulls_first("doc_id"), "hash", "place")
             .sortWithinPartitions(F.asc_nulls_first("doc_id"), "hash", "text"))
    rows = dealt.select("doc_id", "text").mapInArrow(
        encoded, "doc_id long, file int, before long, n_tokens int, ids array<int>")
    data = f"{folder.rstrip('/')}/ids"
    writer = rows.write.mode("overwrite")
    for name, value in ORC_OPTIONS.items():
        writer = writer.option(name, value)
    writer.orc(data)
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)   # files only
    listed = (spark.read.orc(data).groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("n_tokens"),
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))))
    listed.write.mode("overwrite").orc(f"{folder.rstrip('/')}/files")
    return token_list(spark, folder)


def token_list(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file: file, rows, n_tokens, first_doc, last_doc, start."""
    return spark.read.schema("file int, rows long, n_tokens long, first_doc long, last_doc long, "
                             "start long").orc(f"{folder.rstrip('/')}/files")


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("doc_id long, file int, before long, n_tokens int, ids array<int>"
                             ).orc(f"{folder.rstrip('/')}/ids")


def _placed(rows: DataFrame, files: DataFrame) -> DataFrame:
    return rows.join(files.select("file", "start"), "file").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"), "ids")


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids of every
    document, or of ``doc_ids`` only, by the files' row indexes and Bloom
    filters."""
    rows = _rows(spark, folder)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    return _placed(rows, token_list(spark, folder))


def stream_slice(spark: SparkSession, folder: str, begin: int, end: int) -> DataFrame:
    """The documents that touch the ids [begin, end) of the whole stream, as a
    trainer reads its share: the table of files tells which files they are
    in, and row indexes skip the others."""
    inside = ((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > begin))
    files = token_list(spark, folder).where(inside)
    numbers = [r.file for r in files.select("file").collect()]     # files only
    return _placed(_rows(spark, folder).where(F.col("file").isin(numbers)), files).where(inside)


def crc32_of(ids_col: str = "ids"):
    """Unsigned CRC-32 of an array of ids as little-endian 32-bit integers."""
    @F.pandas_udf("long")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([zlib.crc32(np.asarray(ids, "<u4").tobytes()) for ids in batch],
                            dtype="int64")

    return digest(F.col(ids_col))
