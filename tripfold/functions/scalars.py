"""Column functions: decoding, JSON truthiness and tolerant casts.

All are built-in expressions, and none depends on the session's ANSI flag: bad
input gives NULL, and the caller turns that NULL into a quarantine reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, TimestampNTZType

from tripfold.schemas import MONEY

# JSON texts that count as "missing" in an event.
FALSY_JSON = ["null", "false", '""', "[]", "{}", "0", "0.0", "-0.0"]


def base64_bytes(data: Column) -> Column:
    """Strict base64; NULL when `data` is not base64."""
    return F.try_to_binary(data, F.lit("base64"))


def utf8_text(data: Column) -> Column:
    """Strict UTF-8; NULL when the bytes are not valid."""
    return F.try_validate_utf8(data.cast("string"))


def with_json_object(df: DataFrame, name: str, text: str, fields: str) -> DataFrame:
    """Adds the JSON object in column `text` as a struct of `fields`.

    It is NULL when the text is not exactly one object. The text is parsed inside
    brackets because the parser stops after the first value: trailing characters
    then count as errors and a second value shows up.
    """
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    in_brackets = F.concat(F.lit("["), F.col(text), F.lit("]"))
    # a column of its own, so that the parse is not repeated for each mention below
    parsed = df.withColumn("_values", F.from_json(in_brackets, f"array<struct<{fields}>>", strict))
    only = F.when(F.size("_values") == 1, F.get("_values", F.lit(0)))
    return parsed.withColumn(name, only).drop("_values")


def json_reason(text: Column, parsed: Column) -> Column:
    """Why `with_json_object` gave nothing, or NULL; only such texts are parsed again."""
    other = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    single = F.try_variant_get(other, "$[0]", "variant").isNotNull()
    single &= F.try_variant_get(other, "$[1]", "variant").isNull()
    is_object = F.schema_of_variant(F.try_variant_get(other, "$[0]", "variant")).startswith("OBJECT")
    return F.when(parsed.isNull(), F.when(single & ~is_object, "not_object").otherwise("bad_json"))


def is_truthy(field: Column, text: Column | None = None) -> Column:
    """Whether a JSON value counts as present: the string "0" does, the number 0 does not. `text`: its `variant_text`, where a column has it."""
    text = variant_text(field) if text is None else text
    clear = (text != "") & ~text.isin(FALSY_JSON)
    return text.isNotNull() & (clear | ~F.to_json(field).isin(FALSY_JSON))


def variant_text(field: Column) -> Column:
    """A JSON value as text; JSON null is NULL."""
    return F.try_variant_get(field, "$", "string")


def to_number(text: Column, dtype: DataType = MONEY) -> Column:
    """Exact number from text; NULL for text, empty strings, NaN and infinities."""
    if isinstance(dtype, IntegerType):
        return text.try_cast(MONEY).try_cast(dtype)
    return text.try_cast(dtype)


def to_datetime(text: Column) -> Column:
    """Wall-clock datetime; a bare or partly readable date counts as its midnight."""
    midnight = text.try_cast("date").cast("timestamp_ntz")
    return F.coalesce(text.try_cast("timestamp_ntz"), midnight)


def wire_datetime(at: Column) -> Column:
    """A wall-clock datetime as `yyyy-MM-dd HH:mm:ss`.

    A fraction of a second, where there is one, follows. `date_format` would move
    times that the session's zone skips.
    """
    return at.cast("string")


def to_day(text: Column) -> Column:
    return text.try_cast("date")


def sequence_order(text: Column) -> Column:
    """A whole number of any length, delivered as text, in an orderable form; NULL for other text."""
    digits = F.regexp_replace(text, "^0+(?=.)", "")
    return F.when(
        text.rlike("^[0-9]+$"), F.struct(F.length(digits).alias("digits"), digits.alias("number"))
    )


def loses_digits(text: Column, value: Column, dtype: DataType) -> Column:
    """Whether `value`, the number of the type that was made of the text, is rounded.

    Only a text with an exponent, or with more digits behind the point than the type has, is looked at closely.
    """
    scale = 0 if isinstance(dtype, IntegerType) else dtype.scale
    point = F.instr(text, ".")
    many = (point > 0) & (F.length(text) - point > scale) | text.contains("e") | text.contains("E")
    return F.when(many, F.coalesce(text.try_cast("decimal(38,16)") != value, F.lit(False))).otherwise(False)


def typed(text: Column, dtype: DataType) -> Column:
    """Wire text as a schema type."""
    if isinstance(dtype, StringType):
        return text
    if isinstance(dtype, TimestampNTZType):
        return to_datetime(text)
    return to_number(text, dtype)


def unwrap_attributes(image: Column) -> Column:
    """`{"c": {"N": "1"}}` to `{"c": "1"}`; a NULL attribute becomes a null value."""
    return F.transform_values(
        image,
        lambda _, typed_value: F.when(
            ~F.map_contains_key(typed_value, "NULL"), F.get(F.map_values(typed_value), 0)
        ),
    )


def computed_once(df: DataFrame) -> DataFrame:
    """Stops later filters from being pushed below these columns.

    A filter on a parsed column would otherwise be evaluated on the raw text,
    repeating the parse for every mention of the column.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("row")).select("row.*")


def field_warning(text: Column, value: Column, name: str, dtype: DataType) -> Column | None:
    """What is lost when a field's text is typed as `value`: the whole value, digits, or nothing (NULL)."""
    if isinstance(dtype, StringType):
        return None
    short = "fare" if name == "fare_amount" else name
    unreadable = F.when(text.isNotNull() & value.isNull(), f"bad_{short}")
    if isinstance(dtype, TimestampNTZType):
        return unreadable
    return F.coalesce(unreadable, F.when(loses_digits(text, value, dtype), f"rounded_{short}"))


def joined_warnings(warnings: list[Column | None]) -> Column:
    """All warnings of a row in one text; NULL without any."""
    return F.nullif(F.concat_ws(",", *[w for w in warnings if w is not None]), F.lit(""))
