"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickerloom.session import checkpoint_folder

# Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"
ROWS_A_FILE = 100_000


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one all executors share."""
    return f"{checkpoint_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write a stage to the shared folder and read it back: it survives lost executors and cuts lineage.

    `rows`: about how many short rows there are at most. A table of so few is written as one file per core,
    a larger one as a file per `ROWS_A_FILE`: on a local file system every file starts processes of its own.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE)))
    path = f"{new_folder(spark, name)}/table"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, also where `body` uses it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(name: str, taken: Iterable[str]) -> str:
    """`name`, with underscores behind it until no column of `taken` has it (in any case)."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAP), "")


def is_held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows whose crc32 of the id, written as text, is a multiple of `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def labels_by_document(labels: DataFrame, column: str) -> DataFrame:
    """One 0/1 label per doc_id; repeated rows vote, ties and nulls give no label."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.avg(F.col(column).cast("double")).alias("vote"))
        .where(F.col("vote") != 0.5)
        .select("doc_id", (F.col("vote") > 0.5).cast("int").alias("label"))
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / "package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
