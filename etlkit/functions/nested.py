"""Arrays, maps, structs and JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from etlkit.runtime import require

__all__ = [
    "CUSTOMER_SCHEMA", "arrays_to_json", "build_map", "explode_rows", "flatten", "flatten_nested",
    "nest", "parse_json", "tag_array", "to_json_row",
]

_ITEM = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
])
_ORDER = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("items", T.ArrayType(_ITEM)),
])
_PERSON = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("email", T.StringType()),
])
# customer -> orders[] -> items[]
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("personal_info", _PERSON),
    T.StructField("orders", T.ArrayType(_ORDER)),
])


def tag_array(columns: Sequence[Column]) -> Column:
    return F.array(*columns)


def build_map(pairs: Mapping[str, Column]) -> Column:
    return F.create_map(*[part for key, value in pairs.items() for part in (F.lit(key), value)])


def arrays_to_json(keys: Column, values: Column) -> Column:
    return F.to_json(F.map_from_arrays(keys, values))


def to_json_row(columns: Sequence[Column]) -> Column:
    return F.to_json(F.struct(*columns))


def parse_json(text: Column, schema: T.StructType | str) -> Column:
    """Struct from JSON text; malformed text gives NULL fields."""
    return F.from_json(text, schema)


def nest(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Move ``columns`` into one struct column."""
    require(df, *columns)
    return df.withColumn(name, F.struct(*columns)).drop(*columns)


def flatten(df: DataFrame, name: str) -> DataFrame:
    """Replace a struct column by its fields."""
    require(df, name)
    return df.select(*[c for c in df.columns if c != name], f"{name}.*")


def explode_rows(
    df: DataFrame, column: str, value: str, position: str | None = None, outer: bool = False
) -> DataFrame:
    """One row per array element, with its position on request; ``outer`` keeps empty arrays."""
    require(df, column)
    if position:
        generate = F.posexplode_outer if outer else F.posexplode
        made = generate(column).alias(position, value)
    else:
        made = (F.explode_outer if outer else F.explode)(column).alias(value)
    return df.select(*[c for c in df.columns if c != column], made)


def flatten_nested(df: DataFrame, column: str = "customer_data") -> DataFrame:
    """customer -> orders -> items, to one row per item."""
    require(df, column)
    orders = df.select(
        F.col(f"{column}.customer_id").alias("customer_id"),
        F.col(f"{column}.personal_info.name").alias("name"),
        F.explode(f"{column}.orders").alias("o"),
    )
    items = orders.select(
        "customer_id", "name",
        F.col("o.order_id").alias("order_id"), F.col("o.date").alias("order_date"),
        F.explode("o.items").alias("i"),
    )
    return items.select("customer_id", "name", "order_id", "order_date", "i.*")
