r"""Quality rules with thresholds that follow each language and source.

Every text gives four measures, as whole numbers: symbols and repeated words and lines in thousandths, word length in hundredths.
The sketch of a group counts its rows by measure and value. Values up to ``TOP`` are exact to one unit; larger ones keep their first
``BITS`` binary digits, a relative error below 2 ** (1 - BITS) = 0.1 percent, so counts grow with the logarithm of the largest value.
Rows meet the fences on the same scale. Sketches merge by adding counts. A source with few rows takes the merged
sketch of its language, and a language with few rows that of all rows. A measure fails beyond its quartile by
``SPREAD`` times the quartile range plus a floor, so a clean group loses none of its rows for being the last
percent. Thresholds are joined to the rows; measures are written once and read for both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.session import scratch_path

#: Largest value that is surely kept exactly.
TOP = 2000
#: Binary digits that are kept of larger values.
BITS = 11
SPREAD = 6
#: Rows from which a group's own sketch is used.
ENOUGH = 200
#: Added beyond the fence, in the units of the measure.
FLOORS = {"symbols": 50, "dup_lines": 400, "repeats": 350, "word_length": 150}
_SPACES = " \t\n\x0b\f\r"
_SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(ws: Column) -> Column:
    """Words that lie in a run of three words found twice or more."""
    heads = F.slice(ws, 1, F.greatest(F.size(ws) - 2, F.lit(0)))
    runs = F.transform(heads, lambda w, i: F.struct(F.xxhash64(w, F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i")))

    def covered(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, k: F.coalesce(x["h"] == F.get(ordered, k - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(ordered, k + 1)["h"], F.lit(False)))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        zero = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        step = lambda acc, at: F.struct(at.alias("last"), (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"))
        return F.aggregate(starts, zero, step, lambda acc: acc["n"].cast("bigint"))

    return _let(F.sort_array(runs), covered)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Counts of each row's whole text (null: empty), by column expressions only."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))
    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    by_words = _let(words, lambda ws: F.struct(F.size(ws).cast("bigint").alias("n_words"), _repeat_words(ws).alias("n_repeat_words")))
    by_lines = _let(lines, lambda x: F.struct(F.size(x).cast("bigint").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        by_words.alias("w"),
        by_lines.alias("l"),
        F.length(F.regexp_replace(text, _SPACE, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
    ).select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines", "w.n_repeat_words")


def _ratio(part: str, whole: str, unit: int) -> Column:
    return F.expr(f"CASE WHEN {whole} > 0 THEN ({unit} * {part}) DIV {whole} ELSE 0 END")


def values() -> dict[str, Column]:
    return {
        "symbols": _ratio("n_symbols", "word_chars", 1000),
        "dup_lines": _ratio("n_dup_lines", "n_lines", 1000),
        "repeats": _ratio("n_repeat_words", "n_words", 1000),
        "word_length": _ratio("word_chars", "n_words", 100),
    }


def scaled(value: Column) -> Column:
    """The value as the sketch counts it: the least one with its first BITS binary digits."""
    cut = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(value)) - BITS)
    return F.when(value <= TOP, value).when(F.length(F.bin(value)) <= BITS, value).otherwise(value - value % cut)


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, value, n): the sketch of each group."""
    pairs = F.array(*(F.struct(F.lit(k).alias("measure"), scaled(v).alias("value")) for k, v in values().items()))
    return measured.select("lang", "source", F.inline(pairs)).groupBy("lang", "source", "measure", "value").agg(F.count("*").alias("n"))


def merge(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of wider groups."""
    return sketch.groupBy(*by, "measure", "value").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """Per group: its rows, and low_<measure> and high_<measure>."""
    group = Window.partitionBy(*by, "measure")
    upto = group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.select(*by, "measure", "value", F.sum("n").over(upto).alias("upto"), F.sum("n").over(group).alias("total"))
    quartile = lambda k: F.min(F.when(4 * F.col("upto") >= k * F.col("total"), F.col("value")))
    quartiles = ranked.groupBy(*by, "measure").agg(F.max("total").alias("total"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    floor = F.create_map(*(x for k, v in FLOORS.items() for x in (F.lit(k), F.lit(v))))[F.col("measure")]
    width = SPREAD * (F.col("q3") - F.col("q1")) + floor
    bounds = quartiles.select(*by, "measure", "total", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))
    pick = lambda side, k: F.max(F.when(F.col("measure") == k, F.col(side))).alias(f"{side}_{k}")
    return bounds.groupBy(*by).agg(F.max("total").alias("rows"), *(pick(side, k) for k in FLOORS for side in ("low", "high")))


def thresholds(sketch: DataFrame) -> DataFrame:
    """Per language and source, the fences of the narrowest group with enough rows. (lang and source may be null.)"""
    names = [f"{side}_{k}" for k in FLOORS for side in ("low", "high")]
    own = fences(sketch, "lang", "source")
    by_lang = merge(sketch, "lang")
    lang = fences(by_lang, "lang")
    every = fences(merge(by_lang))
    rename = lambda df, tag: df.select(*(F.col(c).alias(f"{tag}_{c}") for c in df.columns))
    l, e = rename(lang, "l"), rename(every, "e")
    joined = own.join(l, F.col("lang").eqNullSafe(F.col("l_lang"))).join(F.broadcast(e))  # the last is one row
    pick = lambda c: F.when(F.col("rows") >= ENOUGH, F.col(c)).when(F.col("l_rows") >= ENOUGH, F.col(f"l_{c}")).otherwise(F.col(f"e_{c}")).alias(c)
    return joined.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *map(pick, names))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, failed_rules and kept.

    A null or empty text has no words and fails the base. A null language or source is a group of its own. Repeated
    rows and null ids are judged like any other row; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "measures")
    measures(docs, id_col, text_col, lang_col, source_col).write.parquet(path)
    measured = spark.read.parquet(path)
    limits = thresholds(sketches(measured))
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    counted = {k: scaled(v) for k, v in values().items()}
    over = [F.when((v > F.col(f"high_{k}")) | ((v < F.col(f"low_{k}")) if k == "word_length" else F.lit(False)), F.lit(k)) for k, v in counted.items()]
    return joined.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), F.concat_ws(",", *over).alias("failed_rules"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
