"""Text functions as column expressions (no Python in the row path)."""

from __future__ import annotations

import operator
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.functions import fixed_values as fixed

# Every character Unicode counts as white space, the four ASCII separators included.
WHITESPACE = (
    r"\t-\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACE = f"[{WHITESPACE}]"
NON_SPACE = f"[^{WHITESPACE}]"


# The same characters as a string, for trimming both ends without a pattern.
WHITESPACE_CHARACTERS = "".join(
    chr(code)
    for first, last in ((9, 13), (28, 32), (133, 133), (160, 160), (0x1680, 0x1680), (0x2000, 0x200A),
                        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))
    for code in range(first, last + 1)
)


def strip(text: Column) -> Column:
    """Trim white space of any kind on both sides."""
    return F.btrim(text, F.lit(WHITESPACE_CHARACTERS))


def pieces(text: Column) -> Column:
    """White-space separated words, with empty ones where white space meets; printable ASCII needs no pattern."""
    plain = F.when(text.rlike(r"[^\x20-\x7E]"), F.regexp_replace(text, SPACE, " ")).otherwise(text)
    return F.split(plain, " ")


def words(text: Column) -> Column:
    """White-space separated words; an empty text has none."""
    return F.filter(pieces(text), lambda word: word != "")


def contains_any(text: Column, parts: Iterable[str]) -> Column:
    """Plain substring tests: far cheaper than a pattern for texts that hold none."""
    return reduce(operator.or_, [F.contains(text, F.lit(part)) for part in parts])


def _blanks(text: Column) -> Column:
    """Lower case, white space as single blanks; blanks that are single are not touched."""
    other = WHITESPACE.replace(r"\x20", r"\x1F")
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[{other}]{SPACE}*| {SPACE}+", " ")


def _no_links(text: Column) -> Column:
    return F.regexp_replace(text, "(?:http|www)[^ ]+", "")


def _no_addresses(text: Column) -> Column:
    """Drop words with an '@' between two characters; possessive, so linear in the text."""
    return F.regexp_replace(text, "(?<![^ ])[^ ][^ @]*+@[^ ]++", "")


def _letters(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[^a-z .,!?;:]+", ""), "  +", " "))


def clean_text(text: Column) -> Column:
    """Lower-case letters and basic punctuation only, single spaced; null becomes ''."""
    return _letters(_no_addresses(_no_links(_blanks(text))))


def _without_phrases(text: Column) -> Column:
    for pattern in fixed.BOILERPLATE_PATTERNS:
        text = F.regexp_replace(text, "(?i)" + pattern.replace(r"\s", SPACE), "")
    return text


def remove_boilerplate(text: Column) -> Column:
    """Fixed phrases removed one after the other, then trimmed."""
    return strip(_without_phrases(text))


# A text that holds none of these, in lower case, holds no fixed phrase.
PHRASE_CORES = [
    pattern.replace(r"\s*-\s*", "").replace("\\", "").split(".*?")[0] for pattern in fixed.BOILERPLATE_PATTERNS
]


# Contractions as written, before the tokenizer parts them.
JOINED_CONTRACTIONS = [pair.replace(" ", "") for pair in fixed.SPLIT_CONTRACTIONS]


def _part_contractions(text: Column) -> Column:
    for pair, whole in zip(fixed.SPLIT_CONTRACTIONS, JOINED_CONTRACTIONS):
        text = F.regexp_replace(text, f"\\b{whole}\\b", pair)
    return text


def _long_words(text: Column, remove_stop_words: bool = True) -> Column:
    """Punctuation splits off words; a run of dots is a token of its own; a single
    closing dot is not part of its word."""
    marked = F.regexp_replace(text, "[,!?;:]", " ")
    runs = F.regexp_replace(marked, r"\.{2,}", " $0 ")
    pieces = F.split(F.regexp_replace(runs, r"\.(?<=[^. ]\.)(?= |$)", ""), " ")
    if remove_stop_words:
        return F.filter(pieces, lambda word: (F.length(word) > 2) & ~word.isin(fixed.ENGLISH_STOP_WORDS))
    return F.filter(pieces, lambda word: F.length(word) > 2)


def tokens(text: Column, remove_stop_words: bool = True) -> Column:
    """Words longer than two characters of a cleaned (single-spaced, lower-case) text."""
    return _long_words(_part_contractions(text), remove_stop_words)


def preprocess_text(text: Column) -> Column:
    return F.array_join(tokens(remove_boilerplate(clean_text(text))), " ")


def with_preprocessed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds preprocessed texts (new name -> text column).

    The same steps as `preprocess_text`, but a step that few texts need is guarded by a
    substring test. A guarded step reads its input twice, so its input is a column of
    its own and computed once.
    """

    def step(frame: DataFrame, change, parts: Iterable[str] | None = None) -> DataFrame:
        def changed(name: str) -> Column:
            column = F.col(name)
            return change(column) if parts is None else F.when(contains_any(column, parts), change(column)).otherwise(column)

        return frame.withColumns({new: changed(new) for new in columns})

    df = df.withColumns({new: _blanks(F.col(old)) for new, old in columns.items()})
    df = step(df, _no_links, ("http", "www"))
    df = step(df, _no_addresses, ("@",))
    df = step(df, _letters)
    df = step(df, _without_phrases, PHRASE_CORES)
    df = step(df, _part_contractions, JOINED_CONTRACTIONS)
    return step(df, lambda column: F.array_join(_long_words(strip(column)), " "))


def remove_headline_prefixes(headline: Column) -> Column:
    for prefix in fixed.HEADLINE_PREFIXES:
        headline = F.replace(headline, F.lit(prefix), F.lit(""))
    return headline


def length_or_zero(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def text_statistics(text: Column) -> dict[str, Column]:
    """Length, words, mean word length, '!' and '?' counts, share of capitals."""
    filled = F.coalesce(text, F.lit(""))
    parts = words(filled)
    chars_in_words = F.aggregate(parts, F.lit(0), lambda total, word: total + F.length(word))
    capitals = F.length(F.regexp_replace(filled, r"\P{IsUppercase}", ""))
    return {
        "text_length": F.length(filled),
        "word_count": F.size(parts),
        "avg_word_length": F.coalesce(F.try_divide(chars_in_words, F.size(parts)), F.lit(0.0)),
        "exclamation_count": F.length(filled) - F.length(F.replace(filled, F.lit("!"), F.lit(""))),
        "question_count": F.length(filled) - F.length(F.replace(filled, F.lit("?"), F.lit(""))),
        "uppercase_ratio": F.coalesce(F.try_divide(capitals, F.length(filled)), F.lit(0.0)),
    }


def credible_source(source: Column) -> Column:
    names = "|".join(name.lower() for name in fixed.CREDIBLE_SOURCES)
    return F.coalesce(F.lower(source).rlike(names), F.lit(False)).cast("int")


def headline_words(headline: Column) -> Column:
    """Lower-case words of a headline without stop words, longer than two characters."""
    found = F.regexp_extract_all(F.lower(headline), F.lit(r"([\p{L}\p{N}_]+)"))
    return F.filter(
        found, lambda word: (F.length(word) > 2) & ~word.isin(fixed.HEADLINE_STOP_WORDS)
    )


def ticker_list(text: Column) -> Column:
    """'amd, gd' -> ['AMD', 'GD']."""
    return F.transform(F.split(text, ","), lambda item: F.upper(F.trim(item)))
