import json
import zlib

import numpy as np
import public_tokenizers
import pytest
from headway.llm import token_files
from headway.llm.token_files import (Encoder, crc32_of, read_tokens, stream_slice, token_list,
                                     write_tokens)
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from .conftest import ODD_ROWS

PATH = public_tokenizers.path(token_files.VOCABULARY)


LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture
def library():
    return LIBRARY


@pytest.fixture(scope="module")
def coder():
    return Encoder(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def decoded(raw):
    return np.frombuffer(raw, "<u4").tolist()


@pytest.mark.parametrize("text", [
    "", " ", "Don't stop, IT'S 3.14!", "a b c", "é ́x Å̧", "ΑΣ ΣΑΣ", "İstanbul ıI",
    "x<|endoftext|>y <|startoftext|>", "<|EndOfText|>", "日本語 テキスト 한국어 한", "\x1c a\x85b c",
    "ſtraße ǅ ǆ ª º ² ½ _x_", "a\x00b \x7f", "👍🏽 ok👍", "we'll 'S 's'T"])
def test_texts_are_encoded_as_the_library_does(library, coder, text):
    assert decoded(coder.encode(text)) == ids_of(library, text)


def test_every_plain_character_beside_others(library, coder):
    plain = [chr(c) for c in range(0x250) if token_files._PLAIN.fullmatch(chr(c))]
    for c in plain:
        text = f"{c} a{c}b 1{c}{c}2 '{c} .{c}A"
        assert decoded(coder.encode(text)) == ids_of(library, text), hex(ord(c))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aB'st .,3é́ \n<|İΣ"), st.characters(
    exclude_categories=["Cs"])), max_size=40))
def test_any_text(text):
    assert decoded(token_files.encoder(PATH).encode(text)) == ids_of(LIBRARY, text)


def test_other_vocabularies_go_through_the_library_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    coder = Encoder(path)
    text = "two  spaces\n\nand 'quotes'"
    assert not coder.by_word
    assert decoded(coder.encode(text)) == ids_of(Tokenizer.from_file(path), text)


def test_a_slice_of_texts_of_every_kind(library, coder):
    texts = ["", "  Be.  be\n\tBE ", "日本 Be. ab3,x", "x<|endoftext|>y", " \x1c a\x85b　c ", "İ ȺB Ⱦ!",
             "the#### +1 a@b.c", "\n", "word" * 100, "é" * 70 + ". é"]
    assert [decoded(i) for i in coder.encode_all(texts)] == [ids_of(library, t) for t in texts]
    assert coder.encode_all([]) == []


def test_a_word_is_looked_up_once_for_a_slice(library, monkeypatch):
    coder, looked = Encoder(PATH), []
    plain = coder._plain
    monkeypatch.setattr(coder, "_plain", lambda word: looked.append(word) or plain(word))
    found = coder.encode_all(["To be, or not to be."] * 500)
    assert {tuple(decoded(i)) for i in found} == {tuple(ids_of(library, "To be, or not to be."))}
    assert sorted(w for w in looked if w) == ["be,", "be.", "not", "or", "to"]


@pytest.mark.parametrize("pattern", [r"[\p{L}]{1,3}|[^\s\p{L}]+", r"[\p{L}]+", r"[\p{L}.]+|[^\s\p{L}.]"])
def test_a_vocabulary_that_cuts_letters_otherwise(tmp_path, pattern):
    with open(PATH, encoding="utf-8") as held:
        spec = json.load(held)
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = pattern
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    text = "whether letters. are, one part 12 naïve!"
    coder = Encoder(str(path))
    assert coder.by_word
    assert decoded(coder.encode(text)) == ids_of(Tokenizer.from_file(str(path)), text)


def test_files_hold_every_document_in_order(spark, documents, library, scratch):
    rows = ODD_ROWS + [(20 + i % 50, f"word{i} <|endoftext|>", "en", "s") for i in range(300)]
    files = write_tokens(documents(rows, extra=True), scratch, files=5)
    got = read_tokens(spark, scratch).withColumn("crc", crc32_of()).collect()
    assert len(got) == len(rows)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, *_ in rows), key=lambda i: (i is not None, i))
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        assert r.crc == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    want = sorted([(i is not None, i, *ids_of(library, t), 1) for i, t, *_ in rows], key=str)
    assert sorted([(r.doc_id is not None, r.doc_id, *r.ids) for r in got], key=str) == want
    listed = sorted(files.collect(), key=lambda r: r.file)
    assert sum(r.n_tokens for r in listed) == at and listed[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(listed, listed[1:]))
    # the rows are in the files' own order, not only sortable into it
    order = spark.read.orc(f"{scratch}/ids").orderBy("file", "before").collect()
    assert [r.ids for r in order] == [r.ids for r in got]


def test_rows_of_one_id_are_spread(spark, documents, scratch):
    write_tokens(documents([(7, "same text", "en", "s")] * 4000), scratch, files=8)
    sizes = [r.rows for r in token_list(spark, scratch).collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1500


def test_search_and_slices_read_a_part(spark, documents, scratch):
    rows = [(3 * i, f"text number {i} of many", "en", "s") for i in range(6000)]
    write_tokens(documents(rows), scratch, files=3)
    every = {r.doc_id: r for r in read_tokens(spark, scratch).collect()}
    found = read_tokens(spark, scratch, [9, 10, 17_997])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert {r.doc_id: r for r in found.collect()} == {i: every[i] for i in (9, 17_997)}
    low, high = every[600].start + 1, every[9000].start
    part = stream_slice(spark, scratch, low, high).collect()
    assert sorted(r.doc_id for r in part) == [i for i in sorted(every) if 600 <= i < 9000]


def test_files_have_stripes_indexes_and_bloom_filters(spark, documents, scratch):
    write_tokens(documents([(i, "a b c", "en", "s") for i in range(5000)]), scratch, files=1)
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    data = jvm.org.apache.hadoop.fs.Path(f"{scratch}/ids")
    listed = data.getFileSystem(conf).globStatus(jvm.org.apache.hadoop.fs.Path(data, "part-*.orc"))
    path = max(listed, key=lambda f: f.getLen()).getPath()
    reader = jvm.org.apache.orc.OrcFile.createReader(path, jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getRowIndexStride() == token_files.INDEX_ROWS
    footer = reader.rows().readStripeFooter(reader.getStripes()[0])
    kinds = [s.getKind().toString() for s in footer.getStreamsList() if s.getColumn() == 1]
    assert "BLOOM_FILTER_UTF8" in kinds and "ROW_INDEX" in kinds
    ids_column = 6                       # the elements of the array
    assert footer.getColumns(ids_column).getKind().toString() == "DIRECT_V2"


def test_empty_table(spark, documents, scratch):
    write_tokens(documents([]), scratch)
    assert read_tokens(spark, scratch).collect() == []
