"""Publishing all tables of a step at once: versions side by side, one pointer switched last.

A version of a table is a partition ``version=<id>`` of its folder. The folder ``versions`` holds one row per
published version; it is appended to (Spark commits a file as a whole) when every table of the version is
written. Readers take the version with the largest number, so they see all tables before or all after a switch,
never some of each; a run that dies before the switch leaves nothing that is read. Two writers that publish at
once both succeed, and the larger (number, id) is the current one.

Views made by ``create_views`` look the pointer up when they are queried: they are made once and follow every
later version. They are views of the session's catalog, so they outlive the session where that catalog does.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

POINTER = "number long, version string, tables array<string>"


def _pointer(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(POINTER).parquet(f"{root}/versions")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(number, id) of the version that readers see; None before the first."""
    pointer = _pointer(spark, root)
    last = pointer.agg(F.max(F.struct("number", "version")).alias("m")).first()["m"] if pointer is not None else None
    return (last["number"], last["version"]) if last else None


def switch(spark: SparkSession, root: str, version: str, names: Iterable[str] = ()) -> None:
    """Make ``version`` the current one."""
    now = current(spark, root)
    row = [((now[0] if now else 0) + 1, version, sorted(names))]
    spark.createDataFrame(row, POINTER).coalesce(1).write.mode("append").parquet(f"{root}/versions")


def _types(spark: SparkSession, folder: str) -> dict[str, DataType]:
    try:
        return {f.name: f.dataType for f in spark.read.parquet(folder).schema}
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise


def publish_version(
    tables: dict[str, DataFrame], root: str, before_switch: Callable[[str], None] | None = None
) -> str:
    """Write all tables as a new version and switch to it; ``before_switch`` may check the written version first.

    Columns keep the types of the version before: views read all versions by one schema.
    """
    spark = next(iter(tables.values())).sparkSession
    version, now = uuid.uuid4().hex, current(spark, root)
    for name, df in tables.items():
        known = _types(spark, f"{root}/{name}/version={now[1]}") if now else {}
        other = {c: F.col(f"`{c}`").cast(known[c]) for c, kind in ((f.name, f.dataType) for f in df.schema) if known.get(c, kind) != kind}
        df.withColumns(other).write.parquet(f"{root}/{name}/version={version}")
    if before_switch is not None:
        before_switch(version)
    switch(spark, root, version, tables)
    return version


def read_version(spark: SparkSession, root: str, names: Iterable[str], version: str | None = None) -> dict[str, DataFrame]:
    """The tables of one version (the current one if not named), all of the same."""
    if version is None:
        now = current(spark, root)
        if now is None:
            raise ValueError(f"nothing has been published below {root}")
        version = now[1]
    return {name: spark.read.parquet(f"{root}/{name}/version={version}") for name in names}


def create_views(spark: SparkSession, root: str, names: Iterable[str], prefix: str = "") -> None:
    """A catalog view per table over whatever version is current when it is queried."""
    for name in names:
        columns = ", ".join(f"`{c}`" for c in read_version(spark, root, [name])[name].columns)
        spark.sql(
            f"CREATE OR REPLACE VIEW `{prefix}{name}` AS SELECT {columns} FROM parquet.`{root}/{name}` "
            f"WHERE version = (SELECT max(struct(number, version)).version FROM parquet.`{root}/versions`)"
        )
