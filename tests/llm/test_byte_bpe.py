import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import tiktoken

from headway.llm import byte_bpe as b

from .conftest import LONG, ODD_ROWS

FILES = b.files(None, None)
TEXTS = ["", " ", "Hello  world\n\n  again's 'll", "naïve café — 漢字 🎉🎉 é̀", " \x85  x\ty",
         "<|endoftext|> is text", "1234567890 ½ ٣", "a" * 3000, "\x00\x01�", "don'T WE'RE I'd", LONG[:20000]]


def reference():
    ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, open(FILES[0], "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_match_another_library_and_decode_to_the_text():
    own = reference()
    for text, ids in zip(TEXTS, b.encode_texts(TEXTS, *FILES)):
        assert ids.tolist() == own.encode_ordinary(text), text[:40]
        assert b.decode_ids(ids, *FILES) == text.encode()


def test_documents_match_another_library(spark):
    own = reference()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for r, ids in zip(rows, b.encode_texts([r.text for r in rows], *FILES)):
        assert ids.tolist() == own.encode_ordinary(r.text)


def test_offsets_cover_the_text_and_know_split_characters():
    own = reference()
    for text in TEXTS:
        ids = np.array(own.encode_ordinary(text), "<u4")
        start, end, split = b.character_offsets(text, ids, *FILES)
        at, parts = 0, [own.decode_single_token_bytes(i) for i in ids.tolist()]
        for part, s, e, cut in zip(parts, start, end, split):
            prefix = text.encode()[:at].decode(errors="ignore")
            assert s == len(prefix)
            at += len(part)
            whole = text.encode()[:at].decode(errors="ignore")
            assert e == len(whole) + (len(whole.encode()) != at)
            try:
                part.decode()
                assert not cut
            except UnicodeDecodeError:
                assert cut


def test_rows_round_trip(documents):
    own = reference()
    df = documents(ODD_ROWS, extra=True)
    got = sorted(map(repr, (tuple(r)[:4] for r in b.round_trip(df).collect())))
    want = []
    for i, t, *_ in ODD_ROWS:
        ids = np.array(own.encode_ordinary(t or ""), "<u4")
        want.append(repr((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                          hashlib.sha256((t or "").encode()).hexdigest())))
    assert got == sorted(want)
    back = b.encode(df.select("doc_id", "text"), out="t").select(
        "text", b.decoded(b.F.col("t.ids")).cast("string").alias("back")).collect()
    assert all((r.text or "") == r.back for r in back)
    assert b.round_trip(documents([])).collect() == []


def test_copies_side_by_side_are_encoded_alike(documents, monkeypatch):
    monkeypatch.setattr(b, "SLICE_CHARS", 30)
    texts = ["one text of some length é", "two", "two", "two", LONG[:5000], LONG[:5000], "", None, "two"]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    df = documents(rows, extra=True).coalesce(1)
    whole = {r.doc_id: r.tokens for r in b.encode(df, out="tokens").collect()}
    short = {r.doc_id: r.tokens for r in b.encode(df, out="tokens", splits=False).collect()}
    assert "splits" in whole[0].asDict() and "splits" not in short[0].asDict()
    single = {t: next(iter(b.encode_texts([t or ""], *b.files(None, None)))).tolist() for t in texts}
    for i, t in enumerate(texts):
        assert list(whole[i].ids) == list(short[i].ids) == single[t]
        assert (list(whole[i].start), list(whole[i].end)) == (list(short[i].start), list(short[i].end))


def given_to_library(monkeypatch, texts):
    """(ids of the texts, characters that the library got) in a new worker."""
    given = []
    monkeypatch.setattr(b, "ids_of", lambda tokenizer, part, ids_of=b.ids_of: (
        given.extend(map(len, part)), ids_of(tokenizer, part))[1])
    b.codec.cache_clear()
    ids = [i.tolist() for i in b.encode_texts(texts, *FILES)]
    b.codec.cache_clear()
    return ids, sum(given)


def test_the_library_gets_each_match_once(monkeypatch):
    draw = random.Random(1)
    words = [" " + "".join(draw.choices("abcdeé", k=draw.randint(1, 9))) for _ in range(500)]
    texts = ["".join(draw.choices(words, k=200)) + ".\n" for _ in range(200)]
    monkeypatch.setattr(b, "SLICE_CHARS", 10000)
    ids, given = given_to_library(monkeypatch, texts)
    assert ids == list(map(reference().encode_ordinary, texts))
    assert given < sum(map(len, texts)) / 10


def test_slices_after_one_of_new_matches_are_encoded_whole(monkeypatch):
    draw = random.Random(2)
    texts = [" ".join("".join(draw.choices("bcdfgh漢字", k=12)) for _ in range(40)) for _ in range(60)]
    monkeypatch.setattr(b, "SLICE_CHARS", 500)
    ids, given = given_to_library(monkeypatch, texts)
    assert ids == list(map(reference().encode_ordinary, texts))
    assert given <= 1.1 * sum(map(len, texts))


def test_any_characters_and_short_memory_give_the_ids_of_another_library(monkeypatch):
    draw = random.Random(3)
    odd = [chr(c) for c in range(0x250, 0x32400, 97) if not 0xD800 <= c < 0xE000]
    texts = ["".join(draw.choices([*"'''strevmlld   \n\t\r\x0b\x1c\x85\xa0 ​́éßǅ漢字🎉٣½1a!.,",
                                   " the", " of", "-" * 70, "x" * 70, "࢏", *draw.sample(odd, 2)],
                                  k=draw.randint(0, 60))) for _ in range(4000)]
    want = list(map(reference().encode_ordinary, texts))
    monkeypatch.setattr(b, "SLICE_CHARS", 2000)
    assert given_to_library(monkeypatch, texts)[0] == want
    monkeypatch.setattr(b, "KEPT_MATCHES", 50)
    monkeypatch.setattr(b, "PAUSE", 0)
    assert given_to_library(monkeypatch, texts)[0] == want


def test_characters_that_the_patterns_take_differently_are_known(monkeypatch):
    b.codec.cache_clear()
    codec = b.codec(*FILES)
    cuts = codec.split.pre_tokenize_str
    for c in [*range(0x3000), *range(0x3000, 0x32400, 61)]:
        text = f"a{chr(c)}1{chr(c)}! {chr(c)}{chr(c)}" if not 0xD800 <= c < 0xE000 else ""
        if codec.cut_alike(text):
            assert codec.cut(text) == [p for p, _ in cuts(text)], hex(c)


def test_split_tokens_are_those_of_the_offsets():
    for text, ids in zip(TEXTS, b.encode_texts(TEXTS, *FILES)):
        assert b.split_tokens(ids, *FILES) == b.character_offsets(text, ids, *FILES)[2].sum()


def test_other_patterns_and_vocabularies_go_to_the_library(tmp_path):
    ranks = [*(bytes([i]) for i in range(256) if i != 0x7A), b"ab", b" a", b" ab"]
    path = tmp_path / "few.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(ranks)))
    texts = ["ab abzab  zz aé", "z"]
    bytes_of = [[b.decode_ids(ids, *f) for ids in b.encode_texts(texts, *f)]
                for f in ((str(path), P.PATTERN), (str(path), "[a-z]+"), (FILES[0], "[a-z]+"))]
    left_out = [t.replace("z", "").encode() for t in texts]
    assert bytes_of == [left_out, left_out, [t.encode() for t in texts]]
