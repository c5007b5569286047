"""Carrying out object copies on the executors, byte for byte and without decoding."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.functions.rules import copy_error_class
from tributary.session import ship_with_tasks

ship_with_tasks(__name__)

RESULT = "bucket string, object_key string, dst_bucket string, dst_key string, succeeded boolean, error string, superseded boolean"
BLOCK = 4 * 1024 * 1024


def _copy_rows(source_root: str, target_root: str):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        source, source_base = fs.FileSystem.from_uri(source_root)
        target, target_base = fs.FileSystem.from_uri(target_root)

        def copy(row) -> str | None:
            origin = f"{source_base}/{row.bucket}/{row.object_key}"
            bucket = f"{target_base}/{row.dst_bucket}"
            goal = f"{bucket}/{row.dst_key}"
            if target.get_file_info(bucket).type == fs.FileType.NotFound:
                return f"NoSuchBucket: {row.dst_bucket}"
            if source.get_file_info(origin).type == fs.FileType.NotFound:
                return f"NoSuchKey: {row.object_key}"
            target.create_dir(goal.rsplit("/", 1)[0], recursive=True)
            # A copy becomes visible in one step, so a repeated task leaves the same object behind; two attempts of
            # one task never share a part file.
            part = f"{goal}.{row.part}-{attempt}.part"
            with source.open_input_stream(origin, compression=None) as reader:
                with target.open_output_stream(part, compression=None, metadata=dict(row.metadata)) as writer:
                    while block := reader.read(BLOCK):
                        writer.write(block)
            target.move(part, goal)
            return None

        for frame in frames:
            errors = []
            for row in frame.itertuples():
                try:
                    errors.append(copy(row))
                except PermissionError as problem:
                    errors.append(f"AccessDenied: {problem}")
                except OSError as problem:
                    errors.append(str(problem))
            done = frame[["bucket", "object_key", "dst_bucket", "dst_key"]].copy()
            done["succeeded"] = [e is None for e in errors]
            done["error"] = errors
            done["superseded"] = frame["superseded"]
            yield done

    return run


def execute_copies(plan: DataFrame, source_root: str, target_root: str, tasks: int | None = None) -> DataFrame:
    """Copies every planned object from ``source_root/bucket/key`` to ``target_root/dst_bucket/dst_key``.

    Roots are paths or URIs every executor reaches. One result per planned row, with succeeded, error, error_class and
    superseded. Rows with one destination key run in one task, in order of their upload time (if the plan has one), then
    bucket and key: the last one owns the bytes, and the others are superseded. A copy planned twice runs twice. The plan
    is dealt out evenly, whatever tenant owns it.
    """
    spark = plan.sparkSession
    n = tasks or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    uploaded = F.col("upload_ms") if "upload_ms" in plan.columns else F.lit(0)
    goal, order = ["dst_bucket", "dst_key"], [uploaded, "bucket", "object_key"]
    last = Window.partitionBy(*goal).orderBy(*order)
    rows = plan.withColumn("superseded", F.lead(F.lit(True), 1, False).over(last)).select(
        "bucket",
        "object_key",
        *goal,
        "metadata",
        F.md5(F.concat_ws("/", "bucket", "object_key")).alias("part"),
        "superseded",
        uploaded.alias("_uploaded"),
    )
    dealt = rows.repartition(n, *goal).sortWithinPartitions(*goal, "_uploaded", "bucket", "object_key").drop("_uploaded")
    done = dealt.mapInPandas(_copy_rows(source_root, target_root), RESULT)
    return done.withColumn("error_class", copy_error_class(F.col("error")))
