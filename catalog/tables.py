"""Bars and news derived from the driver tables, in Spark and in SQL."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickerloom.operators import technical
from tickerloom.session import written

BARS_SQL = """
SELECT ticker, date, min_by(price, rn) AS open, max(price) AS high, min(price) AS low,
       max_by(price, rn) AS close, sum(qty) AS volume
FROM (SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS date,
             l_extendedprice / l_quantity AS price, l_quantity AS qty,
             row_number() OVER (PARTITION BY p_brand, CAST(l_shipdate AS DATE)
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS rn
      FROM lineitem JOIN part ON l_partkey = p_partkey)
GROUP BY ticker, date
"""

# Headline openings, so prefixes and finance words occur in the invented prose.
OPENINGS = {
    0: "Reuters - Profit growth beat ",
    1: "Bloomberg - loss and decline risk ",
    2: "CNBC - Rally ",
    3: "upgrade despite debt ",
    4: "MarketWatch - bullish momentum strong buy ",
}
_OPENING_CASES = " ".join(f"WHEN {digit} THEN '{words}'" for digit, words in OPENINGS.items())

NEWS_SQL = f"""
SELECT doc_id, concat('Brand#', CAST(1 + doc_id % 25 AS VARCHAR)) AS ticker,
       concat(CASE doc_id % 10 {_OPENING_CASES} ELSE '' END, string_split(text, chr(10))[1]) AS headline,
       text AS content,
       CAST('1998-01-05 00:00:00' AS TIMESTAMP) + ((doc_id * 7919) % 1440) * INTERVAL '1' HOUR AS timestamp,
       CASE WHEN source IN ('src0', 'src1') THEN 'Reuters'
            WHEN source = 'src2' THEN 'The CNBC Desk' ELSE source END AS source,
       concat('https://news.example/', md5(text)) AS url, lang
FROM documents
"""


class Tables:
    """The driver tables and the two derived ones, each read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def bars(self) -> DataFrame:
        """Daily bars per brand: lines are trades, ordered by the line's identity.

        First and last price come from ordered aggregates, so a day with any number of
        trades is reduced before the shuffle.
        """
        order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
        trades = (
            self.read("lineitem")
            .join(self.read("part"), F.col("l_partkey") == F.col("p_partkey"))
            .select(
                F.col("p_brand").alias("ticker"),
                F.to_date("l_shipdate").alias("date"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                F.col("l_quantity").alias("qty"),
                order.alias("line"),
            )
        )
        return trades.groupBy("ticker", "date").agg(
            F.min_by("price", "line").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "line").alias("close"),
            F.sum("qty").alias("volume"),
        )

    def store_bars(self) -> Tables:
        """Write the bars down, for queries that read them more than once: a row per ticker and day
        instead of all lines, joined and aggregated anew for every reader."""
        self.bars = written(self.bars, "bars")
        return self

    @cached_property
    def returns(self) -> DataFrame:
        return self.bars.withColumn("daily_return", technical.simple_return())

    @cached_property
    def documents(self) -> DataFrame:
        return self.read("documents")

    @cached_property
    def news(self) -> DataFrame:
        digit = F.col("doc_id") % 10
        opening = F.lit("")
        for value, words in OPENINGS.items():
            opening = F.when(digit == value, words).otherwise(opening)
        hours = (F.col("doc_id") * 7919) % 1440
        source = (
            F.when(F.col("source").isin("src0", "src1"), "Reuters")
            .when(F.col("source") == "src2", "The CNBC Desk")
            .otherwise(F.col("source"))
        )
        return self.documents.select(
            "doc_id",
            F.concat(F.lit("Brand#"), (1 + F.col("doc_id") % 25).cast("string")).alias("ticker"),
            F.concat(opening, F.get(F.split("text", "\n"), F.lit(0))).alias("headline"),
            F.col("text").alias("content"),
            F.timestamp_seconds(F.lit(883958400) + hours * 3600).alias("timestamp"),
            source.alias("source"),
            F.concat(F.lit("https://news.example/"), F.md5("text")).alias("url"),
            "lang",
        )
