"""Writing tables, views, exports and models, and auditing what was published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.schemas import EXPECTED_COLUMNS

EXPORTS = (
    "customers", "orders", "monthly_revenue", "product_summary",
    "churn_predictions", "shap_importance",
    "v_executive_kpis", "v_churn_by_tier", "v_churn_by_channel", "v_revenue_trend",
)
SINGLE_FILE_VIEWS = tuple(name for name in EXPORTS if name.startswith("v_"))


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """One Parquet directory per table, replacing earlier contents."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}", compression="zstd")


def replace_catalog_tables(
    tables: dict[str, DataFrame],
    database: str | None = None,
    bucket_by: dict[str, tuple[int, str]] | None = None,
) -> None:
    """Replace catalog tables; bucketing on the join key lets later joins skip their shuffle."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format("parquet")
        if bucket_by and name in bucket_by:
            n, key = bucket_by[name]
            writer = writer.bucketBy(n, key).sortBy(key)
        writer.saveAsTable(f"{database}.{name}" if database else name)


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def export_csv(
    spark: SparkSession,
    folder: str,
    names: tuple[str, ...] = EXPORTS,
    single_file: tuple[str, ...] = SINGLE_FILE_VIEWS,
) -> None:
    """Headed CSV per catalog table or view.

    The aggregate views are written as one file; fact and customer tables keep their partitions.
    """
    for name in names:
        df = spark.table(name)
        if name in single_file:
            df = df.coalesce(1)
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def audit_columns(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    expected: dict[str, list[str]] = EXPECTED_COLUMNS,
) -> DataFrame:
    """Expected against actual columns: (table_name, column_name, data_type, status, filled).

    ``filled`` counts the rows that hold a value, in one scan per table; null for a missing column.
    """
    parts, missing = [], []
    for table in sorted(set(tables) | set(expected)):
        actual = dict(tables[table].dtypes) if table in tables else {}
        wanted = expected.get(table, [])
        missing += [(table, c, None, "missing", None) for c in wanted if c not in actual]
        if not actual:
            continue
        counted = tables[table].agg(*[F.count(F.col(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(actual)])
        found = [
            F.struct(
                F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(kind).alias("data_type"),
                F.lit("ok" if c in wanted else "additional").alias("status"), F.col(f"c{k}").alias("filled"),
            )
            for k, (c, kind) in enumerate(actual.items())
        ]
        parts.append(counted.select(F.explode(F.array(*found)).alias("e")).select("e.*"))
    schema = "table_name string, column_name string, data_type string, status string, filled long"
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame(missing, schema))


def catalog_tables(spark: SparkSession, names: list[str]) -> dict[str, DataFrame]:
    """Those of ``names`` that the catalog knows as a table or view."""
    listed = {t.name for t in spark.catalog.listTables()}
    return {name: spark.table(name) for name in names if name in listed}


def audit_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, counted in parallel branches of one plan."""
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
