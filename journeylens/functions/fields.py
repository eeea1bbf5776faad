"""JSON fields, column names and journey ids."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_TYPES = {"string": "string", "int": "bigint", "float": "double", "bool": "boolean"}


def json_fields(df: DataFrame, column: str, fields: dict[str, str], strict: bool = False) -> DataFrame:
    """Add one typed column per top-level JSON field; the text is parsed once.

    A value that does not fit its type is NULL, or an error if `strict`; objects and arrays are NULL.
    """
    parsed = F.from_json(F.col(column), ", ".join(f"`{name}` string" for name in fields))
    df = df.withColumn("json_", parsed)
    values = []
    for name, kind in fields.items():
        found, target = F.col("json_").getField(name), JSON_TYPES.get(kind, "string")
        # Text that looks nested may be a plain string: what the field holds decides.
        held = F.schema_of_variant(F.try_variant_get(F.try_parse_json(column), f"$['{name}']", "variant"))
        value = F.when(~(found.rlike(r"^[\[{]") & held.rlike("^(OBJECT|ARRAY)")), found)
        value = F.when(found.rlike(r"^[\[{]"), value).otherwise(found)
        values.append((value.cast(target) if strict else value.try_cast(target)).alias(name))
    return df.select("*", *values).drop("json_")


def sanitized_name(name: str) -> str:
    """Drop decimal numbers such as `_0.3`, then squeeze and trim underscores."""
    without_numbers = re.sub(r"_?\d+\.\d+", "", name)
    return re.sub("_+", "_", without_numbers).strip("_")


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[sanitized_name(name) for name in df.columns])


def dots_to_underscores(df: DataFrame) -> DataFrame:
    return df.toDF(*[re.sub("[. ]", "_", name) for name in df.columns])


def journey_id(user: Column, number: Column) -> Column:
    return F.concat(F.lit("id:"), user, F.lit("_J:"), number.cast("string"))


def user_of_journey(journey: Column, first_only: bool = False) -> Column:
    """The user in a journey id; with `first_only`, NULL for later journeys of the user."""
    pattern = r"id:(.*)_J:0" if first_only else r"id:(.*)_J:\d+"
    return F.nullif(F.regexp_extract(journey, pattern, 1), F.lit(""))
