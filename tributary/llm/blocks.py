"""Documents in hashed blocks of bounded bytes, so that a block can ask other tasks and get its own answers.

A block is cut by a hash of the document id, so every use of the same frame finds the same documents in it, and
Spark reuses the one exchange. Its size follows from the bytes of all texts: more data means more blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Aimed bytes of text in a block. A block is held whole by one task.
BLOCK_BYTES = 6 << 20


#: Aimed bytes in one Arrow batch between Spark and a Python worker; the default counts rows only.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session by bytes, so that long texts do not make large ones."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def total_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of all texts, one row to the driver."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("n")).first()["n"]


def blocked(docs: DataFrame, id_col: str, text_col: str, size: int | None = None, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """(doc_id, text, block) of all rows and the number of blocks."""
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = max(1, -(-(total_bytes(plain) if size is None else size) // block_bytes))
    return plain.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")), blocks


def bucket_count(docs: DataFrame, blocks: int) -> int:
    """Buckets of hash space: enough for all cores, and growing with the blocks so that one stays bounded."""
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2 * parallel, -(-blocks // 16))
