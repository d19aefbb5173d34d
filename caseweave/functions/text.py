"""Column expressions for cleaning, counting and cutting text. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Character classes are spelled out so that every regex engine agrees on them.
SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\p{Z}"
WORD = r"\p{L}\p{N}_"
NO_SPACES = r"(?U)[^\s\x{1c}-\x{1f}]+"  # a run of anything else; (?U) makes \s Unicode
CONTROL = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}\x{fffd}]"

TOKEN = rf"[{WORD}](?:[{WORD}']*[{WORD}])?"
TOKEN_PLAIN = rf"[{WORD}]+"
MENTION = r"@([A-Za-z0-9_]+)"


def strip_control_chars(c: Column) -> Column:
    """Delete control characters and U+FFFD; tab, line feed and carriage return stay."""
    return F.regexp_replace(c, CONTROL, "")


def normalize_whitespace(c: Column) -> Column:
    """Every run of Unicode whitespace becomes one space; null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(c, rf"[{SPACE}]+", " ")), F.lit(""))


def clean_text(c: Column) -> Column:
    return normalize_whitespace(strip_control_chars(c))


def strip_brand_mention(c: Column, handle: str) -> Column:
    """Drop one leading handle, in any case. There is no word boundary after it."""
    return F.trim(F.regexp_replace(c, rf"(?iu)^\Q{handle}\E\s*", ""))


def clean_customer_text(c: Column, handle: str) -> Column:
    return strip_brand_mention(clean_text(c), handle)


def clean_brand_reply(c: Column) -> Column:
    """Cleaned reply without one leading @name."""
    return F.trim(F.regexp_replace(clean_text(c), rf"^@[{WORD}]+\s*", ""))


def is_blank(c: Column) -> Column:
    return ~F.coalesce(c.rlike(rf"[^{SPACE}]"), F.lit(False))


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words; null counts as 0."""
    return F.coalesce(F.regexp_count(c, F.lit(NO_SPACES)), F.lit(0))


def assign_role(inbound: Column, author: Column, brand: str) -> Column:
    is_brand = ~F.coalesce(inbound, F.lit(False)) | (F.lower(author) == brand.lower())
    return F.when(is_brand, "brand").otherwise("customer")


def parse_created_at(c: Column) -> Column:
    """'Tue Oct 31 22:08:27 +0000 2017' as a timestamp; anything else is null.

    The weekday name is checked by pattern and cut off, because Spark does not parse it.
    """
    dated = F.when(c.rlike(r"^(?i)(mon|tue|wed|thu|fri|sat|sun) "), F.substring(c, 5, 100))
    return F.try_to_timestamp(dated, F.lit("MMM d HH:mm:ss Z yyyy"))


def parent_id(c: Column) -> Column:
    return c.try_cast("bigint")


def tokenize(c: Column, pattern: str = TOKEN) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(pattern), F.lit(0))


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All word n-grams with low <= n <= high, joined by a space.

    Each size is the size before it, put together with the tokens that follow. Pass the tokens as
    a column of their own, so that they are cut once.
    """
    sizes, grams = [], tokens
    for n in range(1, high + 1):
        if n > 1:
            left = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
            grams = F.zip_with(F.slice(grams, F.lit(1), left), F.slice(tokens, F.lit(n), left),
                               lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= low:
            sizes.append(grams)
    return F.concat(*sizes) if len(sizes) > 1 else sizes[0]


def char_wb_ngrams(c: Column, low: int, high: int) -> Column:
    """Character n-grams inside words padded with one space on each side.

    A padded word shorter than n is given once, whole, and its longer sizes are skipped.
    """
    words = F.regexp_extract_all(F.lower(c), F.lit(NO_SPACES), F.lit(0))
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams_of(word: Column) -> Column:
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), F.greatest(F.length(word), F.lit(low))))
        return F.flatten(F.transform(sizes, lambda n: F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(word) - n + 1, F.lit(1))), lambda i: F.substr(word, i, n))))

    return F.flatten(F.transform(padded, grams_of))


def contains_any(c: Column, phrases: list[str]) -> Column:
    """True if the text holds any of the phrases; null text holds none."""
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | c.contains(phrase)
    return F.coalesce(hit, F.lit(False))


def two_decimals(c: Column) -> Column:
    return F.format_string("%.2f", F.round(c.cast("double"), 2))


def normalize_edges(c: Column) -> Column:
    """Cut whitespace of any kind off both ends."""
    return F.regexp_replace(c, rf"^[{SPACE}]+|[{SPACE}]+$", "")
