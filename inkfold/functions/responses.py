"""Structured model responses read from text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from inkfold.functions.text import nonempty
from inkfold.params import ResponseParams

_CORRUPT = "_corrupt"


def json_text_v1(response: Column, p: ResponseParams) -> Column:
    """The fenced JSON block if there is one, else the first brace up to the last."""
    return F.coalesce(
        nonempty(F.regexp_extract(response, p.fenced_pattern, 1)), json_text_v2(response, p)
    )


def json_text_v2(response: Column, p: ResponseParams) -> Column:
    return nonempty(F.regexp_extract(response, p.greedy_pattern, 1))


def with_object(df: DataFrame, json_text: Column, schema: StructType, out: str) -> DataFrame:
    """Adds the object as a struct, NULL unless the text is exactly one readable JSON object.

    The reader alone would accept an object followed by other text. Inside an array,
    trailing text is a syntax error and a second object a second element. Whether the
    text is JSON is decided on its elements as plain text, which fit any value; its fields
    are read in a second pass, where one of another type is NULL and the others stay.
    """
    wrapped = F.concat(F.lit('{"v":['), json_text, F.lit("]}"))
    any_value = StructType(
        [
            StructField("v", ArrayType(StringType()), True),
            StructField(_CORRUPT, StringType(), True),
        ]
    )
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    read = F.from_json(wrapped, any_value, {**strict, "columnNameOfCorruptRecord": _CORRUPT})
    values = F.from_json(wrapped, StructType([StructField("v", ArrayType(schema), True)]), strict)
    sound = F.col("_read")[_CORRUPT].isNull() & (F.size(F.col("_read")["v"]) == 1)
    return (
        df.withColumn("_read", read)
        .withColumn("_values", values)
        .withColumn(out, F.when(sound, F.get(F.col("_values")["v"], F.lit(0))))
        .drop("_read", "_values")
    )
