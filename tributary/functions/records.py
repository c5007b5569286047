"""JSON lines, records and messages held as variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.constants import METADATA_FIELDS

WHITESPACE = " \t\r\n"
SCALAR = r'^("([^"\\]|\\.)*"|-?\d[-+.\deE]*|true|false|null)$'


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def encloses(text: Column, opening: str, closing: str) -> Column:
    return text.startswith(opening) & text.endswith(closing)


def _wrapped(text: Column) -> Column:
    """Variant array around a text.

    The parser ignores whatever follows the first value of a text. Inside brackets trailing text
    breaks the parse, and a second item shows that the text was a list of values.
    """
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))


def wrapped_object(text: Column) -> Column:
    """One-item variant array of a text that looks like one JSON object; the cheap test comes first."""
    return F.when(text.startswith("{") & F.rtrim(text, F.lit(WHITESPACE)).endswith("}"), _wrapped(text))


def wrapped_value(text: Column) -> Column:
    """One-item variant array of a trimmed text whose ends look like one JSON value."""
    closed = encloses(text, "{", "}") | encloses(text, "[", "]") | text.rlike(SCALAR)
    return F.when(closed, _wrapped(text))


def sole_item(wrapped: Column) -> Column:
    """The value inside, NULL when the text held several."""
    return F.when(F.try_variant_get(wrapped, "$[1]", "variant").isNull(), F.try_variant_get(wrapped, "$[0]", "variant"))


def settle(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns through a one-row explode.

    The optimizer moves filters into column definitions, and a parse inside them would run again for
    every mention. It does not move them below an explode.
    """
    return df.select("*", F.inline_outer(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def with_json_object(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Adds the variant of a text that is one JSON object, parsed once per row."""
    return df.withColumn("_wrapped", wrapped_object(text)).withColumn(out, sole_item(F.col("_wrapped"))).drop("_wrapped")


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def elements(text: Column, parsed: Column) -> Column:
    """Records of one parsed, trimmed text: the items of an array, else the value itself."""
    return F.when(text.startswith("["), parsed.cast("array<variant>")).otherwise(F.array(parsed))


# A JSON string, or a number that may need another form: with a fraction, an exponent or 16 digits.
_STRING_OR_NUMBER = r'"(?:[^"\\]|\\.)*+"|-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?'
_ODD_NUMBER = r"[0-9][.eE]|[0-9]{16}"
# Such a number in a compact text stands at its start or behind one of three signs.
_HOLDS_ODD_NUMBER = r"(?:^|[:,\[])-?(?:[0-9]+[.eE]|[0-9]{16})"


def number_text(token: Column) -> Column:
    """A JSON number as the published encoder prints its 64-bit float: plain from 1e-6 up to below 1e21, else with an exponent.

    The digits are the shortest that give the float back, padded with zeros; so whole numbers above 2**53 are rounded.
    """
    value = token.cast("double")
    printed = F.abs(value).cast("string")  # 123.45, 1.2345E7 or 1.0E-7
    mantissa, tail = F.substring_index(printed, "E", 1), F.regexp_extract(printed, "E(.*)$", 1)
    whole, part = F.substring_index(mantissa, ".", 1), F.regexp_replace(F.substring_index(mantissa, ".", -1), "^0$", "")
    shift = F.when(tail == "", 0).otherwise(tail.try_cast("int"))
    digits, point = F.concat(whole, part), F.length(whole) + shift
    left = F.when(point <= 0, "0").otherwise(F.rpad(F.substr(digits, F.lit(1), point), F.greatest(point, F.lit(1)), F.lit("0")))
    right = F.when(point <= 0, F.concat(F.repeat(F.lit("0"), -point), digits)).otherwise(F.substr(digits, point + 1))
    right = F.regexp_replace(right, "0+$", "")
    plain = F.when(right == "", left).otherwise(F.concat_ws(".", left, right))
    exponent = F.concat(F.when(shift < 0, "-").otherwise("+"), F.abs(shift).cast("string"))
    scientific = F.concat(F.when(part == "", whole).otherwise(mantissa), F.lit("e"), exponent)
    size = F.abs(value)
    out = F.when((size != 0) & ((size < 1e-6) | (size >= 1e21)), scientific).otherwise(plain)
    return F.when(token.startswith("-"), F.concat(F.lit("-"), out)).otherwise(out)


def json_text(value: Column) -> Column:
    """JSON text of a variant or map, the way the published encoder writes it: numbers as 64-bit floats, and <, >, & and the
    separators U+2028 and U+2029 escaped."""

    def written(text: Column) -> Column:
        between = F.split(text, _STRING_OR_NUMBER, -1)
        tokens = F.regexp_extract_all(text, F.lit(_STRING_OR_NUMBER), F.lit(0))
        shown = F.transform(tokens, lambda t: F.when(t.startswith('"') | ~t.rlike(_ODD_NUMBER), t).otherwise(number_text(t)))
        rewritten = F.array_join(F.zip_with(between, shown, lambda b, t: F.concat(b, F.coalesce(t, F.lit("")))), "")
        text = F.when(text.rlike(_HOLDS_ODD_NUMBER), rewritten).otherwise(text)
        for raw, escaped in (("&", "\\u0026"), ("<", "\\u003c"), (">", "\\u003e"), ("\u2028", "\\u2028"), ("\u2029", "\\u2029")):
            text = F.replace(text, F.lit(raw), F.lit(escaped))
        return text

    # An item of an array is computed once, however often it is named.
    return F.element_at(F.transform(F.array(F.to_json(value)), written), 1)


def message_text(value: Column) -> Column:
    """Strings pass, everything else becomes JSON."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise(
        json_text(value)
    )


def without_metadata(record: Column) -> Column:
    fields = record.cast("map<string,variant>")
    return F.map_filter(fields, lambda k, _: ~k.isin(*METADATA_FIELDS))
