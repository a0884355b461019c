"""Product names for rows with a ``product_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_product_names(df: DataFrame, products: DataFrame, how: str = "inner") -> DataFrame:
    """Add ``product_name``.

    ``inner`` drops unknown products; ``left`` calls them ``Product <id>``. Spark
    broadcasts the names while they are under ``autoBroadcastJoinThreshold`` and
    shuffles on the product otherwise, where AQE splits popular products.
    """
    joined = df.join(products.select("product_id", "product_name"), "product_id", how)
    if how == "left":
        fallback = F.concat(F.lit("Product "), F.col("product_id").cast("string"))
        joined = joined.withColumn("product_name", F.coalesce("product_name", fallback))
    return joined
