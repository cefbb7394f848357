"""Text expressions. All are native column expressions, so they stay inside the JVM.

Character classes are spelled out because Java's shorthand classes differ from the wanted ones:
whitespace includes the separators U+001C to U+001F, digits are any decimal digit, word characters
are letters, numerals and the underscore but not combining marks. Classes are built from single
characters below U+0100, which Java looks up in a table, and at most two other parts: a union or a
negated class of many ranges is matched several times slower.

A regular expression that needs a rare substring to match is guarded by a byte search for it, which
costs far less on the many rows that hold no link, phone number or bank word.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_letters, digits

from pyspark.sql import Column, DataFrame, functions as F

from msgrisk.constants import (
    BANK_WORDS, FRAUD_PHRASES, MANUAL_FEATURES, MONEY_UNITS, SHORT_HOSTS, STOP_WORDS, URGENT_WORDS,
)

WHITESPACE = r"\p{IsWhite_Space}\x1c\x1d\x1e\x1f"
NON_SPACE = rf"[^{WHITESPACE}]"
WORD = r"\p{L}\p{N}_"

# The message patterns.
URL = rf"(?iu)https?://{NON_SPACE}+|www\.{NON_SPACE}+"
# A look at the first character alone spares most places of a text the alternatives.
SHORT_URL = (
    "(?iu)(?=[" + "".join(sorted({h[0] for h in SHORT_HOSTS})) + "])(?:" + "|".join(h.replace(".", r"\.") for h in SHORT_HOSTS) + rf")/?{NON_SPACE}*"
)
PHONE = r"(?=[+80])(?:\+?84|0)(?:\p{Nd}[ -]?){8,10}\p{Nd}"
# A digit comes first and the look-behind after it, so that only digits pay for it. The look-behind
# and the possessive runs keep long digit runs linear without changing any match.
MONEY = (
    rf"(?iu)\p{{Nd}}(?<!\p{{Nd}}\p{{Nd}})\p{{Nd}}*+(?:[.,]\p{{Nd}}*+)?[{WHITESPACE}]*(?:" + "|".join(MONEY_UNITS) + ")"
)
ACCOUNT = rf"\p{{Nd}}(?<![{WORD}]\p{{Nd}})\p{{Nd}}{{7,19}}(?![{WORD}])"
# The range runs from U+00C0 to U+1EF8, so it takes in accented lower-case letters as well.
CAPITAL = r"A-Z\u00c0-\u1ef8"
# What is in that range without being a letter.
CAPITAL_NO_LETTER = r"[\u00c0-\u1ef8&&\P{L}]"
# All but digits, Latin and accented letters up to U+1EF9, and brackets. U+1680 is whitespace.
SEPARATOR = "".join(
    rf"\x{ord(c):02x}" for c in map(chr, range(0xC0)) if c not in ascii_letters + digits + "[]"
) + r"\u1680\u1efa-\x{10ffff}"

URL_HINTS = ("://", "www.")
SHORT_URL_HINTS = (".ly", ".co", ".gl", ".at", ".id", ".ıd")
PHONE_HINTS = ("84", "0")

KEPT_STOP_WORDS = tuple(w for w in STOP_WORDS if w not in URGENT_WORDS)


def _contains_any(text: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(p) for p in parts])


def _mask(text: Column, hints, pattern: str, mask: str) -> Column:
    replaced = F.regexp_replace(text, pattern, f" {mask} ")
    return F.when(_contains_any(text, hints), replaced).otherwise(text) if hints else replaced


def _count_literal(text: Column, part: Column) -> Column:
    """Non-overlapping occurrences, by the bytes that removing them saves. Looking for one first is much cheaper."""
    saved = F.octet_length(text) - F.octet_length(F.replace(text, part, F.lit("")))
    return F.when(text.contains(part), (saved / F.octet_length(part)).cast("int")).otherwise(0)


def _count_phrases(lowered: Column, plain: Column) -> Column:
    """Occurrences of all phrases, each counted by itself. Plain text needs only the ASCII ones.

    A loop over the phrases keeps the generated code short enough to be compiled. Texts without any skip it.
    """
    phrases = [p.lower() for p in FRAUD_PHRASES]
    every = F.array(*map(F.lit, phrases))
    ascii_only = F.array(*[F.lit(p) for p in phrases if p.isascii()])
    counted = F.aggregate(
        F.when(plain, ascii_only).otherwise(every), F.lit(0), lambda n, p: n + _count_literal(lowered, p)
    )
    return F.when(_contains_any(lowered, _irreducible(phrases)), counted).otherwise(0)


def _irreducible(words) -> tuple[str, ...]:
    """Words holding no other listed word: the only ones a substring search must try."""
    return tuple(w for w in words if not any(o != w and o in w for o in words))


def safe_text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"[{WHITESPACE}]+", " "))


def strip_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def word_count(text: Column) -> Column:
    """Whitespace-separated words: each becomes one letter with the whitespace around it."""
    letters = F.regexp_replace(text, rf"[{WHITESPACE}]*+{NON_SPACE}++[{WHITESPACE}]*+", "x")
    return F.when(text.rlike(NON_SPACE), F.length(letters)).otherwise(0)


def mask_urls(text: Column) -> Column:
    return _mask(text, URL_HINTS, URL, "[URL]")


def mask_short_urls(text: Column) -> Column:
    return _mask(text, SHORT_URL_HINTS, SHORT_URL, "[SHORTURL]")


def mask_phones(text: Column) -> Column:
    return _mask(text, PHONE_HINTS, PHONE, "[PHONE]")


def mask_money(text: Column) -> Column:
    return _mask(text, None, MONEY, "[MONEY]")


def keep_letters(text: Column) -> Column:
    """Every run of other characters, underscores or whitespace becomes one space."""
    return F.trim(F.regexp_replace(text, f"[{SEPARATOR}]+", " "))


def normalized(df: DataFrame, text: str = "text", output: str = "normalized") -> DataFrame:
    """Append the normalised text: lower case, links, phones and amounts masked, letters kept.

    Every step is its own column. A step looks at its input more than once, so nesting the steps in
    one expression would evaluate the inner ones many times over.
    """
    _require(df, text)
    return (
        df.withColumn("_step", F.lower(safe_text(F.col(text))))
        .withColumn("_step", mask_urls(F.col("_step")))
        .withColumn("_step", mask_short_urls(F.col("_step")))
        .withColumn("_step", mask_phones(F.col("_step")))
        .withColumn(output, keep_letters(mask_money(F.col("_step"))))
        .drop("_step")
    )


def tokenize(normalized: Column) -> Column:
    """Lower-cased tokens of normalised text without stop words."""
    tokens = F.split(F.lower(normalized), " ")
    return F.filter(tokens, lambda t: (t != "") & ~t.isin(*KEPT_STOP_WORDS))


def capital_ratio(text: Column) -> Column:
    """Capitals (by the wide range) over letters, 0 where there are no letters."""
    capitals = F.length(F.regexp_replace(text, f"[^{CAPITAL}]+", ""))
    letters = F.length(F.regexp_replace(text, r"\P{L}+", ""))
    return F.coalesce(capitals / F.nullif(letters, F.lit(0)), F.lit(0.0))


def _whole_capital_ratio(raw: Column, plain: Column) -> Column:
    """The ratio cut to its integer part. In plain text it is 1 or 0, which one look decides.

    Where all capitals are letters and one letter is none of them, it is 0.
    """
    shouted = (~raw.rlike("[a-z]") & raw.rlike("[A-Z]")).cast("int")
    below = raw.rlike("[a-z]") & ~raw.rlike(CAPITAL_NO_LETTER)
    return F.when(plain, shouted).when(below, 0).otherwise(capital_ratio(raw).cast("int"))


def feature_columns(raw: Column, lowered: Column, plain: Column) -> dict[str, Column]:
    """The manual features by name, from non-null text, its lower case and whether it is ASCII."""
    values = {
        "has_url": _contains_any(lowered, URL_HINTS) & raw.rlike(URL),
        "has_shorturl": _contains_any(lowered, SHORT_URL_HINTS) & lowered.rlike(SHORT_URL),
        "has_phone": _contains_any(raw, PHONE_HINTS) & raw.rlike(PHONE),
        "has_money": lowered.rlike(MONEY),
        "has_bank_account": raw.rlike(ACCOUNT),
        "bank_mention": _contains_any(lowered, _irreducible(BANK_WORDS)),
        "fraud_keyword_count": _count_phrases(lowered, plain),
        "exclamation_count": _count_literal(raw, F.lit("!")),
        "capslock_ratio": _whole_capital_ratio(raw, plain),
        "msg_length": word_count(raw),
    }
    return {name: values[name].cast("double") for name in MANUAL_FEATURES}


def message_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Append the ten manual features."""
    _require(df, text)
    staged = df.withColumn("_raw", safe_text(F.col(text))).withColumns(
        {"_lowered": F.lower("_raw"), "_plain": F.octet_length("_raw") == F.length("_raw")}
    )
    features = feature_columns(F.col("_raw"), F.col("_lowered"), F.col("_plain"))
    return staged.withColumns(features).drop("_raw", "_lowered", "_plain")


def preprocess(df: DataFrame, text: str = "text") -> DataFrame:
    """Append clean_text, token_count and the ten manual features, row by row."""
    _require(df, text)
    return (
        normalized(message_features(df, text), text, "_normalized")
        .withColumn("_tokens", tokenize(F.col("_normalized")))
        .withColumn("clean_text", F.array_join("_tokens", " "))
        .withColumn("token_count", F.size("_tokens"))
        .drop("_tokens", "_normalized")
    )


def truncated(text: Column, limit: int) -> Column:
    """Cut to limit characters plus dots where longer, then newlines to spaces."""
    cut = F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("...")))
    return F.translate(F.coalesce(cut, text), "\n", " ")


def _require(df: DataFrame, text: str) -> None:
    if text not in df.columns:
        raise KeyError(f"Missing text column: {text}")
