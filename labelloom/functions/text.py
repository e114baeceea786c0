"""Column expressions over a single text value.

Everything here is a built-in Spark expression, so it runs inside the scan's
own stage and nothing crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on each of them.
# Code-point ranges that count as white space when a text is stripped or cut into words.
SPACE_RANGES = (
    (0x09, 0x0D),
    (0x1C, 0x20),
    (0x85, 0x85),
    (0xA0, 0xA0),
    (0x1680, 0x1680),
    (0x2000, 0x200A),
    (0x2028, 0x2029),
    (0x202F, 0x202F),
    (0x205F, 0x205F),
    (0x3000, 0x3000),
)
# Word characters: letters, numbers, underscore.
WORD = r"\p{L}\p{N}_"
# Code-point ranges that count as emoji.
EMOJI_RANGES = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2700, 0x27BF),
    (0x1F900, 0x1F9FF),
    (0x2600, 0x26FF),
    (0x2B50, 0x2B55),
    (0x1FA00, 0x1FA6F),
    (0x1FA70, 0x1FAFF),
)
# Characters, besides the space, that separate words for id sequences.
SEQUENCE_SEPARATORS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"

SPACE_CHARS = "".join(chr(c) for lo, hi in SPACE_RANGES for c in range(lo, hi + 1))


def _class_body(ranges: tuple[tuple[int, int], ...]) -> str:
    return "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in ranges)


# The white space above for the engine's regular expressions, which must be
# opened with (?U): its Unicode white space and the four separator controls.
SPACE = r"\s\x1C-\x1F"
URL = rf"(?iU)(?:https?://|www\.)[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"
HASHTAG = rf"#[{WORD}]+"
# The surrounding range comes first, so that most characters fail a single test.
EMOJI = (
    rf"[\x{{{min(lo for lo, _ in EMOJI_RANGES):X}}}-\x{{{max(hi for _, hi in EMOJI_RANGES):X}}}"
    rf"&&[{_class_body(EMOJI_RANGES)}]]"
)
NON_ASCII = r"[^\x00-\x7F]"

FLAG_NAMES = ("urls", "mentions", "hashtags", "emojis", "repeated_chars")


def text_key(text: Column) -> Column:
    """32-byte stand-in for a text as a grouping key; null stays null.

    Texts can run to many kilobytes. Grouping and joining on the SHA-256
    digest keeps whole texts out of every shuffle that only counts.
    """
    return F.unhex(F.sha2(text, 256))


# A plain substring search decides most texts; only the others meet a pattern.
def _may_have_url(text: Column) -> Column:
    return text.contains("://") | F.lower(text).contains("www.")


def has_url(text: Column) -> Column:
    return _may_have_url(text) & text.rlike(URL)


def has_mention(text: Column) -> Column:
    return text.contains("@") & text.rlike(MENTION)


def has_hashtag(text: Column) -> Column:
    return text.contains("#") & text.rlike(HASHTAG)


def has_emoji(text: Column) -> Column:
    return text.rlike(EMOJI)


def has_repeated_chars(text: Column, times: int = 3) -> Column:
    """The same character, line feeds aside, ``times`` or more in a row."""
    if times < 2:
        raise ValueError("times must be at least 2")
    return text.rlike(rf"([^\n])\1{{{times - 1},}}")


def has_non_ascii(text: Column) -> Column:
    return text.rlike(NON_ASCII)


def is_blank(text: Column) -> Column:
    """Not null, but nothing except white space."""
    return ~text.rlike(f"(?U)[^{SPACE}]")


def flag_columns(text: Column, repeat: int = 3) -> dict[str, Column]:
    """The five surface flags, in the order of ``FLAG_NAMES``."""
    return dict(
        zip(
            FLAG_NAMES,
            (
                has_url(text),
                has_mention(text),
                has_hashtag(text),
                has_emoji(text),
                has_repeated_chars(text, repeat),
            ),
        )
    )


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space."""
    return F.regexp_count(text, F.lit(f"(?U)[^{SPACE}]+"))


def one_line(text: Column) -> Column:
    return F.translate(text, "\n", " ")


def shorten(text: Column, limit: int = 120) -> Column:
    """One stripped line of at most ``limit`` characters, with an ellipsis when cut."""
    line = F.btrim(one_line(text), F.lit(SPACE_CHARS))
    return F.when(
        F.length(line) > limit, F.concat(F.substring(line, 1, limit), F.lit("…"))
    ).otherwise(line)


def word_tokens(text: Column) -> Column:
    """Lower-case runs of at least two word characters; null gives no tokens."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def sequence_tokens(text: Column) -> Column:
    """Lower-case words between spaces and ``SEQUENCE_SEPARATORS``."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    body = "".join("\\" + c if c in "[]\\^-&" else c for c in SEQUENCE_SEPARATORS)
    return F.regexp_extract_all(lowered, F.lit(f"[^ {body}]+"), F.lit(0))


def mask_handles_and_links(text: Column) -> Column:
    """Links become ``<URL>``, then handles become ``<USER>``."""
    linked = F.when(_may_have_url(text), F.regexp_replace(text, URL, "<URL>")).otherwise(text)
    return F.when(text.contains("@"), F.regexp_replace(linked, MENTION, "<USER>")).otherwise(linked)


def pad(sequence: Column, length: int, padding: str = "post", filler: int = 0) -> Column:
    """Fill a sequence of at most ``length`` entries up to that length."""
    fill = F.array_repeat(F.lit(filler), F.lit(length) - F.size(sequence))
    if padding == "post":
        return F.concat(sequence, fill)
    if padding == "pre":
        return F.concat(fill, sequence)
    raise ValueError(f"padding must be 'post' or 'pre', got {padding!r}")


def truncate(sequence: Column, length: int, truncating: str = "post") -> Column:
    """Keep the first (``post``) or the last (``pre``) ``length`` entries."""
    if truncating == "post":
        return F.slice(sequence, 1, length)
    if truncating == "pre":
        start = F.greatest(F.size(sequence) - (length - 1), F.lit(1))
        return F.slice(sequence, start, F.lit(length))
    raise ValueError(f"truncating must be 'post' or 'pre', got {truncating!r}")
