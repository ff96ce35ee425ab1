"""Line-first cleaning: rules per line, removal of failing lines, rejection of documents that lose too much.

Built-in column functions only. A document is one row throughout, so no copy group or
frequent word can load a single task.

Defined cases: null text is empty text; an empty text has no words, zero counts and fails
the base rule; lines without words are kept; repeated rows give repeated results; other
columns of the input pass through `clean_lines` unless they have the name of a result
column, which replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.llm.common import WORD_GAP, let, text_or_empty, words_of

SYMBOLS = r"[#*$%&|<>]+"
SPACES = " \t\n\x0b\x0c\r"
SENTENCE_ENDS = [".", "!", "?", "…", "。", "！", "？", ":", ";", '"', "”", "»", "’", ")"]
SEPARATORS = r"[|»›•·>]+"
BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookie policy|accept cookies|privacy policy|terms of (use|service)|"
    r"subscribe to our|sign up for|log ?in|click here|read more|share (this|on)|enable javascript|skip to content)\b"
)
MIN_WORDS = 50
MAX_REPEAT_SHARE = 50
MAX_LOST_SHARE = 0.5
MIN_OPEN_WORDS = 8
MAX_BOILERPLATE_CHARS = 160
FEW_REPEATS = 24
RESULTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_text", "lost_share", "base_failed", "kept",
)


def count_of(text: Column, pattern: str) -> Column:
    """How many characters the pattern's runs cover."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(text, WORD_GAP, "")).cast("long")


def line_fails(line: Column) -> Column:
    """The punctuation, navigation and boilerplate rules for one line without outer blanks.

    Punctuation: symbols make up a tenth of the characters; or the line has no sentence mark
    at its end and either eight words without any inner mark or fewer than half letters.
    Navigation: two or more separators, at least one for every four words. Boilerplate: a
    stock phrase in a line of at most 160 characters. An empty line passes. The costly
    patterns run only on lines that a cheap test lets through to them.
    """
    words = F.size(F.split(line, WORD_GAP))
    letters = F.length(F.regexp_replace(line, r"[^\p{L}]+", ""))
    bars = count_of(line, SEPARATORS)
    open_end = ~F.right(line, F.lit(1)).isin(SENTENCE_ENDS)
    symbols = line.rlike(SYMBOLS) & (10 * count_of(line, SYMBOLS) >= F.length(line))
    unended = open_end & (((words >= MIN_OPEN_WORDS) & ~line.rlike(r"[.!?,;:]")) | (2 * letters < F.length(line)))
    navigation = line.rlike(SEPARATORS) & (bars >= 2) & (4 * bars >= words)
    boilerplate = (F.length(line) <= MAX_BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    return (F.length(line) > 0) & (symbols | navigation | unended | boilerplate)


def repeated_words(hashes: Column, ordered: Column) -> Column:
    """Words inside three-word windows that occur twice or more, the first occurrence included.

    Windows are compared by 64-bit hash. A few repeated hashes are looked up directly;
    beyond that positions are found by sorting, so the cost stays n log n for any text.
    """

    def covered(starts: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2)))))

    numbered = F.arrays_zip(hashes.alias("h"), F.sequence(F.lit(0), F.size(hashes) - 1).alias("i"))

    def looked_up(twice: Column) -> Column:
        return covered(F.transform(F.filter(numbered, lambda row: F.array_contains(twice, row["h"])), lambda row: row["i"]))

    def by_order(rows: Column) -> Column:
        same = lambda row, at: F.coalesce(row["h"] == F.get(rows, at)["h"], F.lit(False))
        marked = F.transform(rows, lambda row, at: F.when(same(row, at - 1) | same(row, at + 1), row["i"]))
        return covered(F.filter(marked, lambda i: i.isNotNull()))

    def counted(twice: Column) -> Column:
        return F.when(F.size(twice) == 0, 0).when(F.size(twice) <= FEW_REPEATS, looked_up(twice)).otherwise(let(F.sort_array(numbered), by_order))

    twice = F.array_distinct(F.filter(ordered, lambda h, i: h == F.get(ordered, i - 1)))
    return let(twice, counted).cast("long")


def clean_lines(docs: DataFrame, max_lost_share: float = MAX_LOST_SHARE) -> DataFrame:
    """`docs` with its counts, `clean_text`, `lost_share`, `base_failed` and `kept`."""
    text = text_or_empty()
    w, hashes, lines = F.col("words_"), F.col("hashes_"), F.col("lines_")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    none = F.array().cast("array<bigint>")
    # Other columns travel as one struct beside the text and the columns made here.
    others = [name for name in docs.columns if name != "text"]
    row = F.struct(*others) if others else F.lit(None).cast("struct<none:int>")
    split = docs.select(row.alias("row_"), F.col("text")).withColumns({"words_": words_of(text), "lines_": F.split(text, "\n")})
    hashed = split.withColumn("hashes_", F.when(F.size(w) < 3, none).otherwise(windows))
    sorted_ = hashed.withColumns(
        {
            "ordered_": F.sort_array(hashes),
            "worded_": F.filter(lines, lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            "clean_text": F.array_join(F.filter(lines, lambda line: ~line_fails(F.btrim(line, F.lit(SPACES)))), "\n"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
        }
    )
    counted = sorted_.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "n_symbols": count_of(text, SYMBOLS),
            "n_dup_lines": (F.size("worded_") - F.size(F.array_distinct("worded_"))).cast("long"),
            "n_repeat_words": repeated_words(hashes, F.col("ordered_")),
            "clean_chars_": F.when(F.col("clean_text") == text, F.col("word_chars")).otherwise(word_chars(F.col("clean_text"))),
        }
    )
    lost = 1 - F.try_divide(F.col("clean_chars_").cast("double"), F.col("word_chars"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))
    judged = counted.withColumns({"lost_share": F.coalesce(lost, F.lit(0.0)), "base_failed": failed}).drop(
        "words_", "lines_", "hashes_", "ordered_", "worded_", "clean_chars_"
    )
    verdict = judged.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= max_lost_share))
    # An outer explode of one struct: a filter on the results stays above it, instead of being
    # pushed down to the scan with a copy of every expression it needs.
    rest = [name for name in docs.columns if name not in RESULTS]
    return verdict.select("row_", "text", F.explode_outer(F.array(F.struct(*RESULTS))).alias("result_")).select(
        *[F.col("text") if name == "text" else F.col("row_").getField(name).alias(name) for name in rest], *[F.col("result_")[name].alias(name) for name in RESULTS]
    )
