import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skein.llm import bpe
from skein.llm.queries import QUERIES, tokenizer_file

PATH = tokenizer_file()


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    spec = bpe.read_tokenizer(PATH)
    merger = bpe.Merger(spec)
    words = [w.encode() for w in ["the", " the", " then", " thence", "ing", " ing", " ", "\n", "!", " é", "éé", "1", " 12"]]
    return bpe.Coder(spec, bpe.compile_lexicon([(w, merger.ids(w)) for w in words]))


HARD = ["", " ", "  a", "a  ", "a \n b", "a\n\nb", "\n", " \n", "it's we'll 's", "a\x1cb \x85c", "՘ x࢏ 1\U00011de0",
        "<|endoftext|>a<|endoftext|>", "x" * 3000, "ab" * 700 + " é" * 400, "日本語 テスト", "a\tb", "    a", "a​b", "%%% !!! |||",
        " the then thence\nthe end.\nThe", "\u0000\u0001"]


def check(coder, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    (ids, decoded), = coder.encode([text])
    assert ids == ",".join(map(str, want))
    assert decoded == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(coder, library, text):
    check(coder, library, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(list(" \n\t'theand.s12é"))), max_size=60))
def test_equals_the_library(coder, library, text):
    check(coder, library, text)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(max_size=6), st.lists(st.integers(0, 50_000), max_size=4), max_size=40), st.binary(max_size=6))
def test_lexicon_holds_its_words_alone(entries, other):
    lexicon = bpe.Lexicon(bpe.compile_lexicon(list(entries.items())))
    for word, ids in entries.items():
        assert lexicon.get(word) == ids
    assert lexicon.get(other) == entries.get(other)


def test_suffixes_are_shared():
    words = [p + b"ation" for p in (b"st", b"n", b"rel", b"cre")]
    block = bpe.compile_lexicon([(w, [1]) for w in words])
    states = int.from_bytes(block[4:8], "little")
    assert states < 16   # four copies of the ending alone would be 20


def test_round_trip_in_spark(spark, library):
    rows = [(i, t, "x", 5) for i, t in enumerate([None, *HARD, *HARD])] + [(None, "null key", "y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, decoded string, n_tokens int")
    out = bpe.encode(df, PATH, outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"), lexicon_size=5)
    assert out.columns == ["doc_id", "text", "decoded", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    back = bpe.decode(out, PATH).collect()
    assert len(back) == len(rows)
    for r in back:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want) and r.decoded == (r.text or "")
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe.encode(df.limit(0), PATH).collect() == []


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = QUERIES["op9_bpe_lexicon"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        want = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()


def test_long_words_do_not_reach_the_driver(spark, monkeypatch):
    held = []
    made = bpe.compile_lexicon
    monkeypatch.setattr(bpe, "compile_lexicon", lambda entries: held.extend(w for w, _ in entries) or made(entries))
    words = ["x" * (bpe.LONG_WORD - 1), "x" * bpe.LONG_WORD, "é" * (bpe.LONG_WORD // 2), "junk" * 5_000, "short"]
    df = spark.createDataFrame([(w,) for w in words], "text string")
    bpe.build_lexicon(df, bpe.read_tokenizer(PATH))
    assert sorted(held) == [b"short", b"x" * (bpe.LONG_WORD - 1)]
