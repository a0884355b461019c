"""Typed reading and writing of the six tables, and the check of their columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketloom.sources.schemas import TABLES


# Formats that tell their columns without reading all rows.
FORMATS = ("csv", "parquet", "orc")


@dataclass(frozen=True)
class Tables:
    """The six input tables."""

    orders: DataFrame
    prior: DataFrame
    train: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame

    def named(self) -> dict[str, DataFrame]:
        """The tables under their file names."""
        return dict(zip(TABLES, (getattr(self, f.name) for f in fields(self))))


def table_path(path: str, name: str, fmt: str) -> str:
    return f"{path.rstrip('/')}/{name}.{fmt}"


def _csv_columns(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_table(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """Read one table with declared types; columns are found by name.

    No type inference, so no extra scan. A CSV may hold more columns, in any
    order: the header gives the order, and every file must have the same one.
    """
    if fmt == "csv":
        known = {field.name: field for field in schema}
        full = T.StructType(
            [known.get(c, T.StructField(c, T.StringType())) for c in _csv_columns(spark, path)]
        )
        df = spark.read.schema(full).csv(path, header=True, enforceSchema=False)
    else:
        df = spark.read.format(fmt).load(path)
    return df.select([F.col(field.name).cast(field.dataType) for field in schema])


def load_tables(spark: SparkSession, path: str, fmt: str = "csv") -> Tables:
    """Read ``<path>/<table>.<fmt>`` for the six tables; the format is csv, parquet or orc."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}")
    return Tables(
        *(read_table(spark, table_path(path, name, fmt), fmt, schema)
          for name, schema in TABLES.items())
    )


def found_columns(spark: SparkSession, path: str, fmt: str = "csv") -> dict[str, list[str] | None]:
    """Columns of each expected table under ``path``; ``None`` where there is no such table."""
    found: dict[str, list[str] | None] = {}
    for name in TABLES:
        location = table_path(path, name, fmt)
        try:
            found[name] = (
                _csv_columns(spark, location)
                if fmt == "csv"
                else spark.read.format(fmt).load(location).columns
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found[name] = None
    return found


def schema_contract(
    spark: SparkSession, found: Mapping[str, Sequence[str] | None]
) -> DataFrame:
    """What is missing: ``DF[table_name, column_name, problem]``; no rows when all is there.

    Works on column names only, so it costs the same for any amount of data.
    """
    problems = []
    for name, schema in TABLES.items():
        columns = found.get(name)
        if columns is None:
            problems.append((name, None, "missing table"))
            continue
        problems += [(name, c, "missing column") for c in sorted(set(schema.names) - set(columns))]
    return spark.createDataFrame(
        problems, "table_name string, column_name string, problem string"
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result; CSV files get a header."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_tables(tables: Tables, path: str, fmt: str = "parquet") -> None:
    """Write the six tables so that :func:`load_tables` reads them back."""
    for name, df in tables.named().items():
        write_table(df, table_path(path, name, fmt), fmt)
