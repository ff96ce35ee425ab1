"""URL rules by a Bloom filter cascade: exact membership without joins.

Candidate keys of a url are its host suffixes joined with its path prefixes (at the
lengths that rule paths have). Level 1 encodes the listed keys, level 2 those unlisted keys of the
corpus that level 1 lets pass, level 3 the listed keys that level 2 lets pass, and so on
until a level lets nothing wrong pass. A key is listed if the first level it fails is an
even one. Because the levels cover all keys of the corpus, the answer is exact for it.
A second cascade over the listed keys tells block from allow.

Only listed keys and false positives of the first level (about as many, by the choice of
bits) leave the executors; pages are never joined or shuffled.

Defined cases: a null url or one without `://` has empty host and path and meets no rule;
rules with an empty host or a null are ignored; of equal rules with both verdicts block
wins; a url without a rule is allowed. The results replace input columns of their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.llm.bits import BitTable, build
from tickerloom.llm.common import fresh, let, stored

MAX_LEVELS = 64
LATER_BITS, LATER_PROBES = 8, 3


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_host_path(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    return pages.withColumns(
        {
            "host": lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def candidate_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Every host suffix with every path prefix of a listed length, longest first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    none = F.array().cast("array<string>")

    def with_prefix(length: int) -> Column:
        keys = F.transform(suffixes, lambda suffix: F.concat(suffix, F.substring(path, 1, length)))
        return F.when(F.length(path) >= length, keys).otherwise(none)

    per_length = [with_prefix(length) for length in path_lengths]
    keys = F.filter(F.flatten(F.array(*per_length)), lambda key: ~key.startswith("/") & (key != ""))
    return F.when(host != "", keys).otherwise(none)


class Cascade:
    def __init__(self, levels: list[BitTable]):
        self.levels = levels

    def holds(self, key: Column) -> Column:
        """True for listed keys, false for all others of the key universe."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for depth in range(len(self.levels) - 1, -1, -1):
            passes = self.levels[depth].may_hold(key)
            answer = F.when(passes, answer).otherwise(F.lit(depth % 2 == 1))
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, others: int) -> Cascade:
    """The cascade of `listed` against `universe`, both of one column `key`.

    `others` is the size of the universe, which sets the bits of the first level so that
    its false positives are about as many as the listed keys.
    """
    count = max(1, listed.count())
    bits = max(8, math.ceil(1.44 * math.log2(max(2.0, others / count))) + 1)
    levels = [build(listed, "key", count, bits, max(1, round(0.69 * bits)), seed=1)]
    passed = universe.where(levels[0].may_hold(F.col("key"))).distinct()
    inside, outside = listed, stored(passed.join(listed, "key", "left_anti"), "cascade")
    while len(levels) < MAX_LEVELS:
        wrong = outside.count()
        if wrong == 0:
            return Cascade(levels)
        levels.append(build(outside, "key", wrong, LATER_BITS, LATER_PROBES, seed=len(levels) + 1))
        inside, outside = outside, stored(inside.where(levels[-1].may_hold(F.col("key"))), "cascade")
    raise RuntimeError("the cascade did not end")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """`pages` with host, path, the longest fitting rule and its verdict.

    `rules` has host, path (a prefix, such as `/en/`) and
    verdict (allow or block).
    """
    rules = rules.where((F.col("host") != "") & F.col("path").isNotNull() & F.col("verdict").isin("allow", "block"))
    listed = stored(
        rules.select(F.concat(lower_ascii(F.col("host")), "path").alias("key"), F.length("path").alias("n"), "verdict")
        .groupBy("key")
        .agg(F.max("verdict").alias("verdict"), F.max("n").alias("n")),
        "rules",
    )
    lengths = sorted((row["n"] for row in listed.select("n").distinct().collect()), reverse=True)
    parsed = with_host_path(pages)
    if not lengths:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    keys = fresh("keys_", parsed.columns)
    with_keys = parsed.withColumn(keys, candidate_keys(F.col("host"), F.col("path"), lengths))
    universe = with_keys.select(F.explode(keys).alias("key"))
    others = universe.agg(F.approx_count_distinct("key")).first()[0]
    all_rules = build_cascade(listed.select("key"), universe, others)
    blocked = listed.where(F.col("verdict") == "block").select("key")
    block_rules = build_cascade(blocked, listed.select("key"), max(1, listed.count()))

    def longest(keys: Column) -> Column:
        found = F.transform(keys, lambda key: F.struct(F.length(key).alias("n"), key.alias("key")))
        return F.array_max(found)["key"]

    ruled = with_keys.withColumn("rule", let(F.filter(keys, all_rules.holds), longest))
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(block_rules.holds(F.col("rule")), "block").otherwise("allow")
    return ruled.withColumn("verdict", verdict).drop(keys)
