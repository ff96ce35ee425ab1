"""Benchmark decontamination by template canonicalisation.

Numbers (in digits, or single English number words), names (runs of capitalised words, also at a
sentence's start) and units behind numbers become typed placeholders, so a question that was only given other values keeps its template. Any
white space is one blank. The windows of the plain lower-cased words are compared as well and judged
on their own, so a verbatim passage matches in any layout or case. Windows
of five template words of every document are hash-joined with those of the benchmark; for
each (document, item) the replaced values must map consistently. A document is
contaminated by an item if the windows matched in one placement (or all matches together) cover
at least 0.8 of the item's windows and at least that share of their slot values agree on one
counterpart, or if verbatim windows alone cover that much.

Built-in column functions only. A bit table of the benchmark's window hashes (sized by the
benchmark) keeps windows that cannot match from being exploded, so what is shuffled
follows the matches. The join carries hashes and compares the window's words. Matches are
grouped by (document, item): a passage in a third of the documents is that many groups.
Before that, documents are left out that hold none of the anchor words: an item's fifth of
its windows plus one, those with the longest words, has one such word each, and a document
that covers 0.8 of the windows must hold one of them.

The first word of an item may be capitalised or not by what stands before it, so the first
window counts only where it is the only one. If that word is a name, it is still a slot: the word
in front of a match of the second window must then map as the name does elsewhere.

Defined cases: null texts are empty and match nothing; an item of fewer than five words is
compared as one window of all its words against windows of that many words; repeated
item_ids with different texts are items of their own; documents with a null doc_id can't
be reported and are skipped; other columns are ignored by `leaks`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickerloom.llm.bits import BitTable, build
from tickerloom.llm.common import let, stored

WINDOW = 5
MIN_COVER = 0.8
MIN_AGREE = 0.8
# Units recognised behind a number, and words that are numbers.
UNITS = (
    "kilometer kilometers kilometre kilometres meter meters metre metres centimeter centimeters centimetre centimetres "
    "millimeter millimeters millimetre millimetres mile miles inch inches foot feet yard yards acre acres hectare hectares "
    "kilogram kilograms gram grams milligram milligrams pound pounds ounce ounces ton tons tonne tonnes "
    "liter liters litre litres milliliter milliliters millilitre millilitres gallon gallons quart quarts pint pints cup cups "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars euro euros cent cents percent degree degrees "
    "km cm mm kg mg ml mph kph usd eur lb lbs oz ft"
).split()
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
NAME, NUMBER, UNIT = "\u0001", "\u0002", "\u0003"
# Joins the words of one name; a typed text's GAP keeps it.
JOIN = "\u0004"
GAP = r"[^\p{L}\p{N}\x01-\x04]+"


def without_marks(text: Column) -> Column:
    """One blank for any white space, digit groups joined (1,000 is one word) and the placeholder characters removed."""
    marks = F.when(text.rlike(r"[\x01-\x04]|[\s\p{Z}]{2}|[\s\p{Z}&&[^ ]]"), F.regexp_replace(text, r"[\x01-\x04\s\p{Z}]+", " ")).otherwise(text)
    return let(
        marks, lambda t: F.when(t.rlike(r"\d[.,]\d"), F.regexp_replace(t, r"(?<=\d)[.,](?=\d)", "")).otherwise(t)
    )


def joined_names(plain: Column) -> Column:
    """The text with the blanks between capitalised words replaced, so that a run of them is one word."""
    return F.regexp_replace(plain, r" (?=\p{Lu})(?<=(?<![\p{L}\p{N}])\p{Lu}[\p{L}\p{N}]{0,40} )", JOIN)


def canonical(joined: Column) -> Column:
    """The text with placeholders for names and for numbers in digits, a word for a word."""

    def typed(named: Column) -> Column:
        numbered = F.regexp_replace(named, r"(?<![\p{L}\p{N}])\p{Nd}+(?![\p{L}\p{N}])", NUMBER)
        return F.lower(F.when(named.rlike(r"\d"), numbered).otherwise(named))

    return let(F.regexp_replace(joined, r"\p{Lu}(?<![\p{L}\p{N}\x04].)[\p{L}\p{N}\x04]*", NAME), typed)


def measured(words: Column) -> Column:
    """The words of a canonical text, with placeholders also for number words and for units behind a number."""
    return let(
        F.transform(words, lambda w: F.when(w.isin(NUMBER_WORDS), F.lit(NUMBER)).otherwise(w)),
        lambda found: F.transform(
            found,
            lambda w, i: F.when(w.isin(UNITS) & (i > 0) & (F.get(found, i - 1) == NUMBER), F.lit(UNIT)).otherwise(w),
        ),
    )


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(text, GAP), "")


WINDOW_TYPE = "struct<plain:boolean,hash:bigint,at:int,template:array<string>,own:array<string>,before:string>"


def window_rows(texts: DataFrame, ids: list[str], wanted: dict[int, BitTable] | None = None, anchor: BitTable | None = None) -> DataFrame:
    """One row per window of five words: its hash, its start, its template and original words.

    Windows are those of the typed text and, marked `plain`, those of its lower-cased words,
    which hold a verbatim passage in any layout or case. `before` is the name in front of a typed window.

    `wanted` gives the window sizes instead, each with a table of the hashes to keep; other windows are left
    out before rows are made of them, and original words are looked up only for texts with one that
    stays. A text none of whose words is in `anchor` has no windows. All of a text's steps are one
    expression whose parts are bound once (`let`), for all sizes, and rows are made by an outer
    explode, which no filter is inferred from: the optimizer must not copy the costly parts into lambdas.
    """
    none = F.array().cast(f"array<{WINDOW_TYPE}>")

    def windows(template: Column, own: Callable[[], Column], plain: bool) -> Column:
        return let(F.transform(template, lambda w: F.xxhash64(w)), lambda hashes: F.concat(
            *[of_size(template, hashes, own, plain, size) for size in (wanted or [None])]
        ))

    def of_size(template: Column, hashes: Column, own: Callable[[], Column], plain: bool, size: int | None) -> Column:
        width = F.least(F.lit(WINDOW), F.size(template)) if size is None else F.lit(size)

        def hashed(i: Column) -> Column:
            return F.xxhash64(F.lit(plain), F.slice(hashes, i, width))

        starts = F.sequence(F.lit(1), F.size(template) - width + 1)
        kept = starts if wanted is None else F.filter(starts, lambda i: let(hashed(i), wanted[size].may_hold))

        def worded(at: Column, words: Column) -> Column:
            previous = F.when((at > 1) & (F.get(template, at - 2) == NAME), F.substring_index(F.get(words, at - 2), JOIN, -1))
            return F.struct(
                F.lit(plain).alias("plain"),
                hashed(at).alias("hash"),
                at.alias("at"),
                F.slice(template, at, width).alias("template"),
                F.slice(words, at, width).alias("own"),
                (F.lit(None).cast("string") if plain else previous).alias("before"),
            )

        def rows(found: Column) -> Column:
            made = let(own(), lambda words: F.transform(found, lambda at: worded(at, words)))
            return F.when(F.size(found) > 0, made).otherwise(none)

        return F.when((F.size(template) >= width) & (width > 0), let(kept, rows)).otherwise(none)

    def both(text: Column) -> Column:
        typed = let(
            joined_names(text),
            lambda joined: let(measured(tokens(canonical(joined))), lambda t: windows(t, lambda: tokens(F.lower(joined)), False)),
        )

        def with_plain(words: Column) -> Column:
            every = F.concat(typed, windows(words, lambda: words, True))
            # A word that is no placeholder in the typed text is one of the lower-cased words as well.
            return every if anchor is None else F.when(F.exists(words, anchor.may_hold), every).otherwise(none)

        return let(tokens(F.lower(text)), with_plain)

    found = let(without_marks(F.col("text_")), both)
    names = ("plain", "hash", "at", "template", "own", "before")
    return (
        texts.select(*ids, F.explode_outer(found).alias("w_"))
        .where(F.col("w_").isNotNull())
        .select(*ids, *[F.col("w_")[name].alias(name) for name in names])
    )


def anchors(item_windows: DataFrame, min_cover: float) -> DataFrame:
    """The words of which a document with enough of an item's windows holds at least one; null if there is none."""
    words = F.filter("template", lambda w: ~w.isin(NAME, NUMBER, UNIT))
    longest = F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("word"))))
    best = Window.partitionBy("item_key", "plain").orderBy(F.desc_nulls_last(longest["n"]), "at")
    ranked = item_windows.select(
        longest["word"].alias("word"),
        F.row_number().over(best).alias("rank"),
        F.count("*").over(Window.partitionBy("item_key", "plain")).alias("n"),
    )
    return ranked.where(F.col("rank") <= F.floor((1 - min_cover) * F.col("n") + 1e-9) + 1).select("word").distinct()


def anchor_table(item_windows: DataFrame, min_cover: float) -> BitTable | None:
    """The anchor words as a bit table; none if some item has no anchor, so that every text is to be read."""
    words = stored(anchors(item_windows, min_cover), "anchors", item_windows.count())
    count, missing = words.agg(F.count("*"), F.count_if(F.col("word").isNull())).first()
    return None if missing else build(words, "word", count, 64, 3, seed=5)


def leaks(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER, min_agree: float = MIN_AGREE) -> DataFrame:
    """doc_id, item_id, n_windows, n_matched, cover, n_slots, agree, exact: one row per contaminated pair."""
    items = (
        benchmark.where(F.col("item_id").isNotNull())
        .select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text_"))
        .distinct()
        .withColumn("item_key", F.xxhash64("item_id", "text_"))
    )
    counts = Window.partitionBy("item_key", "plain")
    item_windows = stored(
        window_rows(items, ["item_id", "item_key"])
        .withColumns({"size": F.size("template"), "last": F.max("at").over(counts)})
        .where((F.col("at") > 1) | (F.col("last") == 1))
        .drop("last"),
        "bench",
    )
    texts = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", F.col("text").cast("string").alias("text_")
    )
    # At most five sizes: items of fewer words than a window have one of their own length.
    sizes = item_windows.groupBy("size").agg(F.countDistinct("hash").alias("n")).collect()
    if not sizes:
        return texts.join(items, F.lit(False)).selectExpr(
            "doc_id", "item_id", "0L AS n_windows", "0L AS n_matched", "0D AS cover", "0L AS n_slots", "0D AS agree", "true AS exact"
        )
    wanted = {
        row["size"]: build(item_windows.where(F.col("size") == row["size"]).select("hash"), "hash", row["n"], 24, 4, seed=7)
        for row in sizes
    }
    own = window_rows(texts, ["doc_id"], wanted, anchor_table(item_windows, min_cover))
    matched = own.alias("d").join(item_windows.alias("b"), ["plain", "hash", "template"]).select(
        "doc_id", "item_id", "item_key", "plain", F.col("b.at").alias("item_at"), F.col("d.at").alias("doc_at"),
        F.col("d.own").alias("doc_words"), F.col("b.own").alias("item_words"), "template",
        # The item's first word is a slot of its second window if it is a name in both texts.
        F.when(F.col("b.at") == 2, F.struct(F.col("b.before").alias("from"), F.col("d.before").alias("to"))).alias("first"),
    )
    n_windows = item_windows.groupBy("item_key", "plain").agg(F.countDistinct("at").alias("n_windows"))
    # Each placement of the item in the document is judged on its own (equal `shift`), and all matches
    # together (null), where a window prefers its verbatim match: values of a stem that stands before
    # the whole passage are not mixed with the passage's.
    pair = ["doc_id", "item_id", "item_key"]
    same = F.col("doc_words") == F.col("item_words")
    placed = matched.withColumn("shift", F.explode(F.array(F.lit(None).cast("int"), F.col("doc_at") - F.col("item_at"))))
    covered = placed.groupBy(*pair, "plain", "shift", "item_at").agg(
        F.min_by(F.struct("doc_words", "item_words", "template", "first"), F.struct(~same, "doc_at")).alias("m"),
        F.max(same.cast("int")).alias("same"),
    )
    inner = F.transform(
        F.sequence(F.lit(0), F.size("m.template") - 1),
        lambda i: F.when(
            F.get(F.col("m.template"), i).isin(NAME, NUMBER, UNIT),
            F.struct(F.get(F.col("m.item_words"), i).alias("from"), F.get(F.col("m.doc_words"), i).alias("to")),
        ),
    )
    known = F.col("m.first")["from"].isNotNull() & F.col("m.first")["to"].isNotNull()
    slots = F.filter(F.concat(inner, F.array(F.when(known, F.col("m.first")))), lambda slot: slot.isNotNull())
    summed = covered.groupBy(*pair, "plain", "shift").agg(
        F.count("*").alias("n_matched"),
        F.sum("same").alias("n_same"),
        F.array_distinct(F.flatten(F.collect_list(slots))).alias("slots"),
        F.array_distinct(F.flatten(F.collect_list(F.when(F.col("same") == 1, slots)))).alias("same_slots"),
    )
    # Slot values of one item are as many as the item has words; consistent ones have one counterpart.
    # Verbatim windows that cover enough by themselves are accepted with their own slots, which agree.
    judged = summed.join(n_windows, ["item_key", "plain"]).withColumn("verbatim", F.col("n_same") / F.col("n_windows") >= min_cover)
    judged = judged.withColumns(
        {
            "n_matched": F.when(F.col("verbatim"), F.col("n_same")).otherwise(F.col("n_matched")),
            "slots": F.when(F.col("verbatim"), F.col("same_slots")).otherwise(F.col("slots")),
        }
    )
    froms = F.transform("slots", lambda s: s["from"])
    agreeing = F.filter("slots", lambda s: F.size(F.filter(F.col("slots"), lambda o: o["from"] == s["from"])) == 1)
    agree = F.when(F.size("slots") == 0, 1.0).otherwise(F.size(agreeing) / F.size(F.array_distinct(froms)))
    result = ["n_windows", "n_matched", "cover", "n_slots", "agree", "exact"]
    passing = judged.select(
        *pair, "n_windows", "n_matched",
        (F.col("n_matched") / F.col("n_windows")).alias("cover"),
        F.size(F.array_distinct(froms)).cast("long").alias("n_slots"),
        agree.alias("agree"),
        (F.col("verbatim") & (F.col("n_same") == F.col("n_windows"))).alias("exact"),
    ).where((F.col("cover") >= min_cover) & (F.col("agree") >= min_agree))
    best = F.max_by(F.struct(*result), F.struct("exact", "cover", "agree", "n_slots")).alias("r")
    return passing.groupBy(*pair).agg(best).select("doc_id", "item_id", *[F.col("r")[name].alias(name) for name in result]).distinct()
