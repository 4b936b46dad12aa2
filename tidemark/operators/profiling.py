"""Table profiles and data-quality checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numeric import mean, percent, round_half_away, round_half_even, rows, total
from tidemark.functions.quantiles import exact_quantiles
from tidemark.session import settle


def _long(one_row: DataFrame, entries: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def table_shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table."""
    parts = [
        df.agg(
            F.lit(name).alias("table_name"),
            rows().alias("row_count"),
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def shapes_in_one_pass(
    df: DataFrame, name: str, columns: int, derived: dict[str, tuple[list[Column], int]]
) -> DataFrame:
    """Rows and columns of ``df`` and of tables that hold one row per distinct key of it, from one scan.

    ``derived`` names each such table's key columns and number of columns.
    """
    counted = df.agg(
        rows().alias("_0"), *[F.count_distinct(F.struct(*keys)).alias(f"_{k}") for k, (keys, _) in enumerate(derived.values(), 1)]
    )
    widths = {name: columns} | {n: width for n, (_, width) in derived.items()}
    entries = [
        F.struct(F.lit(n).alias("table_name"), F.col(f"_{k}").alias("row_count"), F.lit(width).cast("bigint").alias("column_count"))
        for k, (n, width) in enumerate(widths.items())
    ]
    return _long(counted, entries)


def first_rows(df: DataFrame, key: list[str], n: int = 5) -> DataFrame:
    """The first rows in key order (a distributed table has no file order)."""
    return df.orderBy(*key).limit(n)


def column_info(df: DataFrame) -> DataFrame:
    """Type and non-null count per column, in one pass."""
    counted = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return _long(
        counted,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col(name).alias("non_null"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ],
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, plus the total over all columns."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    everything = reduce(lambda a, b: a + b, [F.col(c) for c in df.columns])
    entries = [(F.lit(c), F.col(c)) for c in df.columns] + [(F.lit("(all columns)"), everything)]
    return _long(
        counted, [F.struct(n.alias("column_name"), v.alias("null_count")) for n, v in entries]
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, quartiles and maximum per column.

    The moments of all columns come from one pass; the exact quartiles of all columns from the
    two passes of the quantile operator over the unpivoted values.
    """
    columns = columns or numeric_columns(df)
    aggregates = []
    for c in columns:
        aggregates += [
            F.count(c).alias(f"{c}__n"),
            mean(F.col(c)).alias(f"{c}__mean"),
            F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__std"),
            F.min(c).cast("double").alias(f"{c}__min"),
            F.max(c).cast("double").alias(f"{c}__max"),
        ]
    moments = _long(
        df.agg(*aggregates),
        [
            F.struct(
                F.lit(c).alias("column_name"),
                *[F.col(f"{c}__{k}").alias(k) for k in ("n", "mean", "std", "min", "max")],
            )
            for c in columns
        ],
    )
    values = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns]
    )
    unpivoted = df.select(F.explode(values).alias("e")).select("e.*")
    quartiles = exact_quantiles(unpivoted, "v", [0.25, 0.5, 0.75], by=["column_name"])
    return moments.join(quartiles.drop("n"), "column_name", "left").select(
        "column_name",
        F.col("n").alias("count"),
        round_half_away(F.col("mean"), 4).alias("mean"),
        round_half_away(F.col("std"), 4).alias("std"),
        F.col("min"),
        *[
            round_half_away(F.col("quantiles")[i], 4).alias(name)
            for i, name in enumerate(("q25", "q50", "q75"))
        ],
        F.col("max"),
    )


def duplicate_count(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows beyond the first of each set of equal rows (or equal keys).

    Wide rows are counted by a 64-bit hash first, so that only hashes are shuffled; whole rows are compared only
    where a hash occurs twice, which also tells rows apart that share one by chance. ``df`` is read twice then, and
    once where no hash does.
    """
    columns = key or df.columns
    if len(columns) > 1:
        hashed = df.withColumn("_hash", F.xxhash64(*columns))
        repeated = hashed.groupBy("_hash").agg(rows().alias("_n")).where("_n > 1").select("_hash")
        repeated = settle(repeated, "repeated-hashes")
        df = hashed.where(F.lit(False)) if repeated.isEmpty() else hashed.join(repeated, "_hash", "left_semi")
    counted = df.groupBy(*columns).agg(rows().alias("_n"))
    return counted.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share per value, missing values left out."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(rows().alias("n"))
    everything = F.sum("n").over(W.partitionBy())
    return counted.withColumn(
        "pct", round_half_away(F.col("n").cast("double") * 100 / everything, 4)
    ).orderBy(F.desc("n"), column)


def value_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """Minimum and maximum per column, as text so that dates and numbers share a table."""
    ends = df.agg(
        *[F.min(c).cast("string").alias(f"{c}__min") for c in columns],
        *[F.max(c).cast("string").alias(f"{c}__max") for c in columns],
    )
    return _long(
        ends,
        [
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}__min").alias("min_value"),
                F.col(f"{c}__max").alias("max_value"),
            )
            for c in columns
        ],
    )


def distinct_counts(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Number of different values per column; ``exact=False`` uses a sketch in a single pass."""
    counter = F.countDistinct if exact else F.approx_count_distinct
    counted = df.agg(*[counter(F.col(c)).alias(c) for c in columns])
    return _long(
        counted,
        [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in columns],
    )


def table_totals(customers: DataFrame, revenue: DataFrame) -> DataFrame:
    """Headline totals, one row; the months carry ``orders`` and ``returned``, so orders are read once."""
    c = customers.agg(percent(F.col("churned"), 2).alias("churn_rate_pct"))
    returned = F.try_divide(F.sum("returned").cast("double"), F.sum("orders").cast("double")) * 100
    r = revenue.agg(
        round_half_away(total(F.col("revenue_usd")), 0).alias("total_revenue"),
        round_half_away(mean(F.col("revenue_usd")), 0).alias("avg_monthly_revenue"),
        round_half_away(returned, 1).alias("return_rate_pct"),
    )
    return r.select(
        "total_revenue", "avg_monthly_revenue", c.scalar().alias("churn_rate_pct"), "return_rate_pct"
    )


def product_category_means(products: DataFrame) -> DataFrame:
    """Mean revenue, rating and return rate of the products of each category."""
    measures = ("total_revenue_usd", "avg_rating", "return_rate")
    return (
        products.where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(*[round_half_even(mean(F.col(m)), 2).alias(m) for m in measures])
        .orderBy("category")
    )


def relationship_check(
    customers: DataFrame, orders: DataFrame, predictions: DataFrame
) -> DataFrame:
    """Violations of: unique customer key, orders belong to customers, one prediction each.

    Orders and predictions are reduced to counted keys before they meet the customers.
    """
    key = "customer_id"
    parents = customers.groupBy(key).agg(rows().alias("n_parent"))
    order_keys = orders.where(F.col(key).isNotNull()).groupBy(key).agg(rows().alias("n"))
    prediction_keys = predictions.groupBy(key).agg(rows().alias("n"))

    def report(name: str, df: DataFrame, violations: Column) -> DataFrame:
        return df.agg(
            F.lit(name).alias("check_name"),
            F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
        )

    parts = [
        report("duplicate customer keys", parents, F.sum(F.col("n_parent") - 1)),
        report("orders without customer", order_keys.join(parents, key, "left_anti"), F.sum("n")),
        report("duplicate prediction keys", prediction_keys, F.sum(F.col("n") - 1)),
        report(
            "predictions without customer",
            prediction_keys.join(parents, key, "left_anti"),
            F.sum("n"),
        ),
        report(
            "customers without prediction",
            parents.join(prediction_keys, key, "left_anti"),
            F.sum("n_parent"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
