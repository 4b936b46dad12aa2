"""Loading the raw CSV tables and reloading the cleaned Parquet ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.schemas import RAW_TABLES

CORRUPT = "_corrupt_record"


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """A headed CSV under a declared schema, columns matched by the file's header order.

    Fields may be quoted, a quote inside is doubled; ``multi_line`` also allows line breaks inside (a
    file is then read by one task). The text NaN in a number becomes null.

    ``keep_corrupt`` adds the raw text of lines that do not fit the schema.
    """
    reader = spark.read.options(header=True, mode="PERMISSIVE", quote='"', escape='"', multiLine=multi_line)
    if keep_corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    read = reader.schema(schema).csv(path)
    numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType | T.FloatType)]
    return read.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in numbers}) if numbers else read


def load_raw(spark: SparkSession, folder: str, keep_corrupt: bool = False) -> dict[str, DataFrame]:
    """The four source tables as ``<folder>/<table>.csv``.

    A file with more columns than the schema names (the order extract has 28, of which 13 are
    used) is read by its own header and narrowed.
    """
    return {
        name: _by_header(spark, f"{folder}/{name}.csv", schema, keep_corrupt)
        for name, schema in RAW_TABLES.items()
    }


def _by_header(
    spark: SparkSession, path: str, schema: T.StructType, keep_corrupt: bool
) -> DataFrame:
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    declared = {f.name: f for f in schema.fields}
    missing = [name for name in declared if name not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    full = T.StructType([declared.get(h, T.StructField(h, T.StringType(), True)) for h in header])
    extra = [CORRUPT] if keep_corrupt else []
    return read_csv_table(spark, path, full, keep_corrupt).select(*schema.names, *extra)


def load_clean(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """Published Parquet tables; types survive the hand-off."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}
