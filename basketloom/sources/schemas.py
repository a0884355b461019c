"""The six input tables: names, columns and types."""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names of the data set.
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("eval_set", T.StringType()),
        T.StructField("order_number", T.IntegerType()),
        T.StructField("order_dow", T.IntegerType()),
        T.StructField("order_hour_of_day", T.IntegerType()),
    ]
)
LINES = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("add_to_cart_order", T.IntegerType()),
        T.StructField("reordered", T.IntegerType()),
    ]
)
PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("aisle_id", T.IntegerType()),
        T.StructField("department_id", T.IntegerType()),
    ]
)
AISLES = T.StructType(
    [T.StructField("aisle_id", T.IntegerType()), T.StructField("aisle", T.StringType())]
)
DEPARTMENTS = T.StructType(
    [
        T.StructField("department_id", T.IntegerType()),
        T.StructField("department", T.StringType()),
    ]
)

TABLES: dict[str, T.StructType] = {
    "orders": ORDERS,
    "order_products__prior": LINES,
    "order_products__train": LINES,
    "products": PRODUCTS,
    "aisles": AISLES,
    "departments": DEPARTMENTS,
}
