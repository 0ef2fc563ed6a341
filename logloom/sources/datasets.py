"""Dataset files by extension, and missing values of tabular files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from logloom.operators.dataset import require_columns, with_validation
from logloom.operators.log_entries import MISSING

READERS = {"csv": "csv", "json": "json", "jsonl": "json", "parquet": "parquet"}


def load_dataset(
    spark: SparkSession,
    path: str,
    required: list[str] | None = None,
    schema: StructType | str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """csv, json, jsonl or parquet by extension, otherwise json; checks the required columns.

    A csv value may hold line breaks; then one task reads a whole file. Without
    ``multi_line`` large csv files are split. With a schema nothing is read ahead.
    """
    extension = os.path.splitext(path.rstrip("/"))[1].lstrip(".").lower()
    fmt = READERS.get(extension, "json")
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line).option("escape", '"')
        if schema is None:
            reader = reader.option("inferSchema", True)
    return require_columns(reader.load(path), required or [])


def load_train_and_validation(spark: SparkSession, train: str, validation: str | None = None, **options) -> DataFrame:
    """Both files with a ``split`` column; without a validation file the train file is read again."""
    held = load_dataset(spark, validation, **options) if validation else None
    return with_validation(load_dataset(spark, train, **options), held)


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN numbers and the texts a CSV reader takes as missing become null."""
    columns = {}
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, (DoubleType, FloatType)):
            columns[field.name] = F.when(~F.isnan(c), c)
        elif isinstance(field.dataType, StringType):
            columns[field.name] = F.when(~c.isin(MISSING), c)
    return df.withColumns(columns)
