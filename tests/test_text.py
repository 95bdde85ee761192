"""Golden rows for cleaning and slang (C1-C11) and token helpers."""
from pyspark.sql import functions as F

from skein import fixed
from skein.functions import text as tx
from skein.functions import tokens as tk


def one(spark, value, fn):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(fn(F.col("t")).alias("x")).first()["x"]


def test_clean_lower_slang_golden(spark):
    src = "hi u fré u/abc-d bob@site.com see https://x.y/z) (lol) awwwesome <b\nc> ok"
    assert one(spark, src, tx.normalise_col) == "hi you fré -d bob see laughing out loud a <b c> ok"


def test_capitals_reintroduced(spark):
    assert one(spark, "idk IM", lambda c: tx.expand_slang(F.lower(c))) == "I don't know I am"


def test_multi_word_keys(spark):
    assert one(spark, "vibe check", tx.expand_slang) == "assessing someone's energy or mood"
    assert one(spark, "cap/no cap", tx.expand_slang) == "lie/no lie"


def test_app_order_keeps_case(spark):
    assert one(spark, "LOL lol", lambda c: tx.normalise_col(c, fixed.SLANG_APP, lower=False)) == \
        "LOL laughing out loud"


def test_only_brackets_and_null(spark):
    assert one(spark, "  ( ) ", tx.clean_text) == ""
    assert one(spark, None, tx.normalise_col) is None


def test_standalone_email_and_mention(spark):
    assert one(spark, "mail bob@site.com now", tx.strip_emails) == "mail  now"
    assert one(spark, "hey @bob!", tx.strip_mentions) == "hey !"
    assert one(spark, "see u/abc-d and xu/y", tx.strip_user_refs) == "see -d and xu/y"


def test_slang_single_pass_and_word_boundaries(spark):
    assert one(spark, "u.s. r/x fré", tx.expand_slang) == "you.s. are/x fré"


def test_clean_properties(spark):
    rows = ["a  (b)  c", "x\t\ty", " lead and trail ", "(((", "a<b>c www.x.y @me http://q"]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    for (out,) in df.select(tx.clean_text("t")).collect():
        assert "  " not in out and out == out.strip()
        assert "(" not in out and ")" not in out and "@" not in out
        assert "http" not in out and "www" not in out


def test_tokens(spark):
    assert one(spark, "  a  b ", tk.tokens) == ["a", "b"]
    assert one(spark, "", tk.tokens) == []
    assert one(spark, None, tk.tokens) == []


def test_word_tokens_and_stops(spark):
    assert one(spark, "The cat, a DOG and 7 x2", tk.word_tokens) == ["the", "cat", "dog", "and", "x2"]
    assert one(spark, "The cat and the dog", lambda c: tk.remove_stops(tk.word_tokens(c))) == ["cat", "dog"]


def test_sentences_and_lead(spark):
    from skein.operators.summarise import lead_k
    assert one(spark, "One. Two!  Three?\nFour\n\nFive", tk.sentences) == ["One.", "Two!", "Three?", "Four", "Five"]
    assert one(spark, "One. Two! Three? Four", lambda c: lead_k(c, 2)) == "One. Two!"


def test_label_thresholds(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,), (None,)], "s double")
    assert [r[0] for r in df.select(tk.sentiment_label("s")).collect()] == ["Positive", "Negative", "Neutral", None]


def test_hashtag_and_share(spark):
    assert one(spark, "New York", tk.hashtag) == "#newyork"
    assert one(spark, "a b", tk.share_url) == fixed.SHARE_PREFIX + "a b"
    assert one(spark, "a b", lambda c: tk.share_url(c, encode=True)) == fixed.SHARE_PREFIX + "a+b"
