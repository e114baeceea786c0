"""Single-text expressions against literal cases."""

import pytest
from pyspark.sql import functions as F

from labelloom.functions import text as tx


def values(spark, texts, column):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[1] for r in df.select("i", column(F.col("t"))).orderBy("i").collect()]


def test_urls(spark):
    texts = ["see http://a.b", "HTTPS://X", "www.site", "WWW.x", "http:// gap", "www. gap", "no link", None]
    assert values(spark, texts, tx.has_url) == [True, True, True, True, False, False, False, None]


def test_mentions_and_hashtags(spark):
    texts = ["@user", "@ user", "@über", "mail@host", "@!", "@٣", "@́"]
    assert values(spark, texts, tx.has_mention) == [True, False, True, True, False, True, False]
    assert values(spark, ["#tag", "# tag", "#ñ", "a#_"], tx.has_hashtag) == [True, False, True, True]


def test_emoji_ranges_by_their_edges(spark):
    every = [chr(c) for c in [*range(0x2500, 0x2C00), *range(0x1F000, 0x1FC00)]]
    assert values(spark, every, tx.has_emoji) == [any(lo <= ord(c) <= hi for lo, hi in tx.EMOJI_RANGES) for c in every]
    inside = [chr(c) for pair in tx.EMOJI_RANGES for c in pair]
    assert all(values(spark, inside, tx.has_emoji))
    outside = [chr(c) for c in (0x25FF, 0x27C0, 0x2B4F, 0x2B56, 0x1F1DF, 0x1F2FF, 0x1F650, 0x1F67F, 0x1F700, 0x1F8FF, 0x1FB00)]
    assert not any(values(spark, outside, tx.has_emoji))


def test_repeated_characters(spark):
    texts = ["aab", "aaab", "a\n\n\nb", "\r\r\r", "😀😀😀", "ababab", "   ", "aAa"]
    assert values(spark, texts, tx.has_repeated_chars) == [False, True, False, True, True, False, True, False]
    assert values(spark, ["aab", "ab"], lambda t: tx.has_repeated_chars(t, 2)) == [True, False]
    with pytest.raises(ValueError):
        tx.has_repeated_chars(F.lit("a"), 1)


def test_non_ascii(spark):
    assert values(spark, ["abc~\x7f", "é", "\x80", ""], tx.has_non_ascii) == [False, True, True, False]


def test_blank_and_words_follow_unicode_white_space(spark):
    texts = ["", " \t\n", "  　", "\x1c\x1f", "x", "​", None]
    assert values(spark, texts, tx.is_blank) == [True, True, True, True, False, False, None]
    # Python's own split is the yardstick.
    words = ["a b", " a b\nc ", "", "\x1cx\x85y", "one"]
    assert values(spark, words, tx.word_count) == [len(w.split()) for w in words]
    assert [chr(c).isspace() for lo, hi in tx.SPACE_RANGES for c in range(lo, hi + 1)].count(False) == 0
    every = [chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    assert values(spark, every, tx.is_blank) == [c.isspace() for c in every]
    assert len(tx.SPACE_CHARS) == sum(chr(c).isspace() for c in range(0x110000))


def test_shorten(spark):
    texts = ["  a\nb  ", "x" * 120, "x" * 121, "　y\t", None]
    assert values(spark, texts, tx.shorten) == ["a b", "x" * 120, "x" * 120 + "…", "y", None]


def test_tokens(spark):
    texts = ["The cat's a_b I ÉTÉ 42!", "a b", None, "x-ray² ½half"]
    assert values(spark, texts, tx.word_tokens) == [["the", "cat", "a_b", "été", "42"], [], [], ["ray²", "½half"]]
    assert values(spark, ["It's a-b\tC\nd  e;", ":-)", None, "a\rb"], tx.sequence_tokens) == [
        ["it's", "a", "b", "c", "d", "e"], [], [], ["a\rb"],
    ]
    every = "a".join(tx.SEQUENCE_SEPARATORS)
    assert values(spark, [every], tx.sequence_tokens) == [["a"] * (len(tx.SEQUENCE_SEPARATORS) - 1)]


def test_masking(spark):
    texts = ["hi @bob_1 see https://x.y/@z and www.q", "nothing"]
    assert values(spark, texts, tx.mask_handles_and_links) == ["hi <USER> see <URL> and <URL>", "nothing"]


@pytest.mark.parametrize("side, expected", [("post", [1, 2, 0, 0]), ("pre", [0, 0, 1, 2])])
def test_pad(spark, side, expected):
    df = spark.range(1).select(tx.pad(F.array(F.lit(1), F.lit(2)), 4, side))
    assert df.first()[0] == expected


@pytest.mark.parametrize("side, expected", [("post", [1, 2]), ("pre", [2, 3])])
def test_truncate(spark, side, expected):
    column = F.array(*[F.lit(i) for i in (1, 2, 3)])
    assert spark.range(1).select(tx.truncate(column, 2, side)).first()[0] == expected
    assert spark.range(1).select(tx.truncate(column, 5, side)).first()[0] == [1, 2, 3]


def test_unknown_sides_are_refused():
    with pytest.raises(ValueError):
        tx.pad(F.array(), 3, "middle")
    with pytest.raises(ValueError):
        tx.truncate(F.array(), 3, "middle")


def test_digest_is_null_for_null_and_equal_for_equal(spark):
    a, b, c, d = values(spark, ["x", "x", "y", None], tx.text_key)
    assert a == b != c and d is None and len(a) == 32
