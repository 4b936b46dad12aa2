"""Counting and setting apart while tables are written: quality figures without a second scan.

``observed`` attaches counters to the rows on their way into a table; Spark adds them up in the tasks that write,
and they can be read once the table is there. ``split_lines`` reads a CSV once: lines that fit the schema go on,
the others go to a quarantine with their file and what is wrong with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import settle
from tidemark.sources.readers import CORRUPT, read_csv_table


def observed(df: DataFrame, name: str, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` with counters; their values are there after the first action over the result."""
    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in counters.items()]), seen


def counters(spark: SparkSession, seen: dict[str, Observation]) -> DataFrame:
    """The counted values as rows (table_name, counter, value)."""
    rows = [(name, key, int(value or 0)) for name, own in seen.items() for key, value in own.get.items()]
    return spark.createDataFrame(rows, "table_name string, counter string, value long")


@dataclass
class Split:
    """Lines that fit, lines that do not (file, line, reason), and how many there are of each."""

    good: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]


def split_lines(spark: SparkSession, path: str, schema: T.StructType) -> Split:
    """One scan of a headed CSV (a file or a folder); both parts are read from its stored copy."""
    lines = read_csv_table(spark, path, schema, keep_corrupt=True).select("*", F.col("_metadata.file_name").alias("_file"))
    lines, seen = observed(
        lines, "lines", {"lines": F.count(F.lit(1)), "quarantined": F.count(CORRUPT), "kept": F.count_if(F.col(CORRUPT).isNull())}
    )
    stored = settle(lines, "csv-lines")
    good = stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")
    bad = stored.where(F.col(CORRUPT).isNotNull()).select(
        F.col("_file").alias("file"), F.col(CORRUPT).alias("line"), reason(F.col(CORRUPT), schema).alias("reason")
    )
    return Split(good, bad, seen.get)


def reason(line: Column, schema: T.StructType) -> Column:
    """The first thing that keeps a line out: its number of fields, or a field that is not of its type."""
    fields = F.regexp_count(F.regexp_replace(line, '"([^"]|"")*"', ""), F.lit(",")) + 1
    texts = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(schema.fields))])
    read = F.from_csv(line, texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"quote": '"', "escape": '"'})
    found = F.when(fields != len(schema.fields), F.format_string("%d fields instead of %d", fields, F.lit(len(schema.fields))))
    for k, f in enumerate(schema.fields):
        if isinstance(f.dataType, T.StringType):
            continue
        text = read[f"c{k}"]
        found = found.when(text.isNotNull() & text.try_cast(f.dataType).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
    return found.otherwise(F.lit("not readable"))
