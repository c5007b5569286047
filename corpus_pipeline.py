"""Corpus pipeline: from documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it keeps; all but the last return the columns of
``documents``. run() writes every stage as Parquet and rereads it as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import near_dedup, pii, quality_classifier
from tributary.llm.decontaminate import find_leaks
from tributary.llm.packing import pack
from tributary.llm.queries import PSEUDONYM_KEY, tokenizer_path
from tributary.session import configure, scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Labels are never learnt from held-out rows.

    A null or empty text is judged by the model's bias; repeated rows and rows without an id are judged each; texts are read whole. Without labels of both
    classes every text has the same score, and all stay or all go by it. An empty table stays empty. Columns named like the score aren't lost.
    """
    model = quality_classifier.fit_on_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.score_rows(docs, model).where("predicted = 1").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates. Rows without an id stay.

    Texts without words (null, empty, blank) have no duplicates and stay. Of exact copies under several ids, the smallest id stays; rows that repeat one id are that
    document and stay together. Very long texts are compared whole. An empty table stays empty.
    """
    classes = near_dedup.classes(docs)
    return _without(docs, classes.where("class_id < doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay, as do rows without an id, which cannot be named as a leak. If one of several rows of an id leaks, all of them go. Passages
    of very long texts are searched to the end. Without benchmark items, and for an empty table, nothing changes.
    """
    return _without(docs, find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the text.

    A null text stays null, with a null n_chars; an empty one stays empty. Repeated rows are replaced alike; rows without an id too. A clashing
    pii_kinds column isn't one of the returned columns. An empty table stays empty.
    """
    done = pii.pseudonymize(docs, PSEUDONYM_KEY).drop("pii_kinds")
    return done.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens.

    A null or empty text is its end token alone. Repeated rows and rows without an id are packed each; a long text is cut into as many pieces as it reaches
    into sequences. An empty table gives no pieces. Other columns are ignored.
    """
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), with_ids=False)


STAGES = [
    ("quality classifier", classify),
    ("near-dedup", deduplicate),
    ("decontamination", decontaminate),
    ("pii", pseudonymize),
    ("packing", pack_sequences),
]

#: SQL expresses neither the classifier nor the tokenizer; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        kept = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return kept
        path = scratch_path(spark, "stage")
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
