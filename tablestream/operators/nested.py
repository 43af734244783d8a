"""Arrays, rows and nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .aggs import collect_rows
from .core import Keys, as_list


def unnest(df: DataFrame, col: str, names: Keys, outer: bool = False, position: str | None = None) -> DataFrame:
    """CROSS JOIN UNNEST: one row per element; an array of rows gives one column per field."""
    n = as_list(names)
    el = df.schema[col].dataType.elementType
    rest = [c for c in df.columns if c != col]
    if position:
        gen = (F.posexplode_outer if outer else F.posexplode)(col).alias(position, "__x")
    else:
        gen = (F.explode_outer if outer else F.explode)(col).alias("__x")
    d = df.select(*rest, gen)
    pos = [(F.col(position) + 1).alias(position)] if position else []     # places count from 1
    if isinstance(el, T.StructType):
        return d.select(*rest, *pos, *[F.col(f"__x.{f}").alias(a) for f, a in zip(el.names, n)])
    return d.select(*rest, *pos, F.col("__x").alias(n[0]))


def nest_children(parent: DataFrame, child: DataFrame, on: Keys, fields: Keys, name: str = "children") -> DataFrame:
    """Parent rows with their child rows as a nested array, ``[]`` when there is none."""
    arr = collect_rows(child, on, fields, name)
    out = parent.join(arr, as_list(on), "left")
    return out.withColumn(name, F.coalesce(name, F.array().cast(arr.schema[name].dataType)))


def to_union(df: DataFrame, type_col: str, branches: dict[str, Column], name: str = "detail") -> DataFrame:
    """Tagged union: a struct of nullable structs with only the branch of the row's type filled."""
    parts = [F.when(F.col(type_col) == t, c).alias(t) for t, c in branches.items()]
    return df.withColumn(name, F.struct(*parts))


def split_union(df: DataFrame, col: str) -> dict[str, DataFrame]:
    """One frame per branch of a tagged union, its fields as columns."""
    rest = [c for c in df.columns if c != col]
    return {b: df.filter(F.col(f"{col}.{b}").isNotNull()).select(*rest, F.col(f"{col}.{b}.*"))
            for b in df.schema[col].dataType.names}


def flatten_states(df: DataFrame, array_col: str, fields: Sequence[tuple[str, int, str]]) -> DataFrame:
    """Rows from an array of string arrays: (name, 1-based place, type) per field; a bad value gives NULL."""
    rest = [c for c in df.columns if c != array_col]
    d = df.select(*rest, F.explode(array_col).alias("__s"))
    cols = []
    for name, place, kind in fields:
        raw = F.trim(F.get("__s", F.lit(place - 1)))
        cols.append((F.timestamp_seconds(raw.try_cast("bigint")) if kind == "epoch" else raw.try_cast(kind)).alias(name))
    return d.select(*rest, *cols)


def wrap_rows(cols: dict[str, Column | str]) -> Column:
    """ROW(...) with names."""
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in cols.items()])


def cart_snapshot(events: DataFrame, products: DataFrame, events_order: Keys = ("event_ts",),
                  products_order: Keys = ("updated_at",)) -> DataFrame:
    """Open carts: latest line per (cart, product), current product price, one row per cart."""
    from .dedup import dedup_last
    line = dedup_last(events, ["cart_id", "product_id"], list(events_order))
    line = line.withColumn("quantity", F.when(F.col("action") == "REMOVE", 0).otherwise(F.col("quantity")))
    line = line.filter((F.col("cart_status") != "CLOSED") & (F.col("quantity") > 0))
    current = dedup_last(products, "product_id", list(products_order))
    j = line.join(current.select("product_id", "name", "price", "availability"), "product_id", "left")
    price = F.coalesce(F.col("price"), F.lit(0).cast("decimal(10,2)")) * F.col("quantity")
    return j.groupBy("cart_id").agg(
        F.max("user_id").alias("user_id"), F.max("cart_status").alias("cart_status"), F.max("cart_date").alias("cart_date"),
        F.sum(price).alias("total_price"),
        F.sort_array(F.collect_list(F.struct("product_id", "name", "price", "availability", "quantity"))).alias("products"))
