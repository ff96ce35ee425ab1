"""Documents in doc_id order, each beside its successor, without a sort in one task.

Split points come from a sample of the ids, weighted by the texts' bytes; any split points give the same
order, the sample only balances. Rows go to the bucket of their range in one shuffle; a bucket is
sorted by itself and ends with a copy of the next bucket's first row, its tail, so that a task
meets the successor of every row it holds.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

BUCKET_BYTES = 32 << 20
# The driver holds the split points, SAMPLES_A_BUCKET times as many sampled ids, and one first row a bucket.
MOST_BUCKETS = 50_000
SAMPLES_A_BUCKET = 20


def _share(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *columns), 11) / float(1 << 53)


def split_points(rows: DataFrame, n_buckets: int, total_bytes: int) -> list[tuple[int, int]]:
    """At most n_buckets - 1 pairs (doc_id, digest), ascending, that part the rows into about equal bytes."""
    wanted = F.col("n_bytes") * (SAMPLES_A_BUCKET * n_buckets / max(1, total_bytes))
    sample = rows.where("doc_id IS NOT NULL").where(_share(F.col("doc_id"), F.col("digest")) < wanted)
    pairs = sorted((r["doc_id"], r["digest"]) for r in sample.select("doc_id", "digest").collect())
    return sorted({pairs[len(pairs) * k // n_buckets] for k in range(1, n_buckets)}) if pairs else []


def with_bucket(rows: DataFrame, splits: list[tuple[int, int]]) -> DataFrame:
    """Adds `bucket`: how many split points (doc_id, digest) are not after the row; null ids come first."""
    ids = sorted({doc_id for doc_id, _ in splits})
    if not ids:
        return rows.withColumn("bucket", F.lit(0))
    edges = sorted({float(i) for i in ids})
    placed = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol="place", outputCol="range").transform(
        rows.withColumn("place", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    )
    # Split points up to a range of ids, less those that share the row's own id and come after its digest.
    upto = [bisect_right([float(i) for i, _ in splits], edge) for edge in edges]
    shared: dict[float, list[tuple[int, int]]] = {}
    for doc_id, digest in splits:
        shared.setdefault(float(doc_id), []).append((doc_id, digest))
    session = rows.sparkSession
    bounds = session.createDataFrame(
        [(float(k + 1), upto[k], shared[edge]) for k, edge in enumerate(edges)],
        "range double, upto int, shared array<struct<id:long,digest:long>>",
    )
    mine = F.struct(F.col("doc_id").alias("id"), F.col("digest").alias("digest"))
    after = F.size(F.filter("shared", lambda s: s > mine))
    bucket = F.coalesce(F.col("upto") - after, F.lit(0))
    return placed.join(F.broadcast(bounds), "range", "left").withColumn("bucket", bucket).drop("range", "place", "upto", "shared")


def beside_successors(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Rows (bucket, is_tail, doc_id, text) in doc_id order within each task; a bucket's last row is its tail.

    The row after the last is the first one. Rows with one doc_id follow one another by the text's hash,
    then the text; null ids come first; null texts are empty. Rows equal in both columns share a bucket.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumns(
        {"digest": F.xxhash64("text"), "n_bytes": F.octet_length("text").cast("long") + 64}
    )
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("total")).first()["total"]
    n_buckets = min(max(1, -(-total // bucket_bytes)), MOST_BUCKETS)
    splits = split_points(rows, n_buckets, total) if n_buckets > 1 else []
    placed = with_bucket(rows.drop("n_bytes"), splits)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("doc_id"), F.col("digest").alias("digest"))
    firsts = sorted(
        (r["bucket"], r["first"]["doc_id"], r["first"]["digest"])
        for r in placed.groupBy("bucket").agg(F.min(order).alias("first")).collect()
    )
    before = [firsts[k - 1][0] for k in range(len(firsts))]
    heads = docs.sparkSession.createDataFrame(
        [(bucket, doc_id, digest) for bucket, (_, doc_id, digest) in zip(before, firsts)], "bucket int, head_id long, head_digest long"
    )
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("digest") == F.col("head_digest"))
    # Equal digests of different texts: the first text in order is the head.
    tails = (
        rows.join(F.broadcast(heads), is_head)
        .groupBy("bucket")
        .agg(F.min("text").alias("text"), F.first("doc_id").alias("doc_id"))
        .select("bucket", F.lit(True).alias("is_tail"), "doc_id", "text", F.lit(0).cast("long").alias("digest"))
    )
    body = placed.select("bucket", F.lit(False).alias("is_tail"), "doc_id", "text", "digest")
    return (
        body.unionByName(tails)
        .repartitionById(n_buckets, F.col("bucket"))
        .sortWithinPartitions("bucket", "is_tail", F.asc_nulls_first("doc_id"), "digest", "text")
        .select("bucket", "is_tail", "doc_id", "text")
    )
