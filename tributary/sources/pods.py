"""Pod log lines as a collector sees them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.operators.ordering import running_total


def select_labelled(df: DataFrame, label: str, value: str, labels: Column | str = "kubernetes.ns_labels") -> DataFrame:
    """Lines of namespaces that carry a label."""
    column = F.col(labels) if isinstance(labels, str) else labels
    return df.filter(F.try_element_at(column, F.lit(label)) == value)


def merge_partial_lines(
    df: DataFrame, key: Sequence[str], order: Sequence[str], partial: str, text: str, chunks: int | None = None
) -> DataFrame:
    """Joins consecutive pieces of a line: pieces run up to the first one that is not partial.

    The run number is the count of finished lines in front of a piece; a group is one merged line.
    """
    ends = F.when(F.col(partial), 0).otherwise(1)
    numbered = running_total(df, key, order, ends, "run", inclusive=False, chunks=chunks)
    pieces = F.sort_array(F.collect_list(F.struct(*order, F.col(text).alias("_text"))))
    return (
        numbered.groupBy(*key, "run")
        .agg(pieces.alias("_pieces"), F.count("*").alias("pieces"))
        .select(*key, "run", F.array_join(F.transform("_pieces", lambda p: p["_text"]), "").alias(text), "pieces")
    )
