"""Scans of stored tables with declared schemas and column checks."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tickerloom import schemas

# News files in order of preference.
NEWS_FILES = ("combined_news", "alpha_vantage_news", "fmp_news")


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def read_table(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Parquet when the path ends in .parquet, else CSV with a header line.

    `multi_line` is for texts with line breaks; such CSV files cannot be split into
    tasks, so large news tables belong in Parquet.
    """
    reader = spark.read.schema(schema)
    if path.rstrip("/").endswith(".parquet"):
        return reader.parquet(path)
    return reader.csv(path, header=True, multiLine=multi_line, escape='"')


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema  # resolves the path, reads nothing
    except (AnalysisException, Py4JJavaError):
        return False
    return True


def read_news(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """The first news file present; an error when none is, or when it has no rows."""
    for name in NEWS_FILES:
        path = f"{folder}/{name}{suffix}"
        if path_exists(spark, path):
            news = read_table(spark, path, schemas.NEWS, multi_line=True)
            if news.isEmpty():
                raise ValueError(f"no articles in {path}")
            return require_columns(news, schemas.REQUIRED_NEWS)
    raise FileNotFoundError(f"none of {', '.join(NEWS_FILES)} in {folder}")


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    return require_columns(read_table(spark, path, schemas.BARS), schemas.REQUIRED_BARS)


def read_panel(spark: SparkSession, path: str, labels: Iterable[str] = ()) -> DataFrame:
    """A feature panel: `date`, `ticker` and at least one `target_` column. `labels` are text columns of a CSV file."""
    if path.rstrip("/").endswith(".csv"):
        # Names come from the header line; all but the keys and labels are numbers.
        text = spark.read.csv(path, header=True)
        keys = (*schemas.REQUIRED_PANEL, *labels)
        panel = text.withColumns({n: F.col(n).try_cast("double") for n in text.columns if n not in keys})
    else:
        panel = spark.read.parquet(path)
    require_columns(panel, schemas.REQUIRED_PANEL)
    if not any(name.startswith("target_") for name in panel.columns):
        raise ValueError("no target columns in the panel")
    return panel.withColumn("date", F.to_date("date"))


def read_splits(spark: SparkSession, folder: str, scaled: bool = True) -> dict[str, DataFrame]:
    kind = "scaled" if scaled else "raw"
    return {
        part: spark.read.parquet(f"{folder}/{part}_data_{kind}.parquet")
        for part in ("train", "val", "test")
    }


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path, multiLine=True)


def in_range(date: Column, start: str | None = None, end: str | None = None) -> Column:
    """`start <= date < end`; a plain comparison, so it reaches the Parquet scan."""
    condition = F.lit(True)
    if start is not None:
        condition = condition & (date >= F.lit(start).cast("date"))
    if end is not None:
        condition = condition & (date < F.lit(end).cast("date"))
    return condition


def normalise_bars(raw: DataFrame, ticker: str | Column) -> DataFrame:
    """Provider bars (Date, Open, High, ...) in the stored layout; the ticker is a name or a column of many tickers' bars."""
    return raw.select(
        F.to_date("Date").alias("date"),
        (ticker if isinstance(ticker, Column) else F.lit(ticker)).alias("ticker"),
        *[F.col(name).cast("double").alias(name.lower()) for name in ("Open", "High", "Low", "Close", "Volume")],
    )
