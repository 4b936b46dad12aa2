"""From feature columns to one model vector: impute, scale, encode.

Everything learned is stored in ordinary Spark ML stages, so the fitted preparation can be saved,
loaded and chained with a model.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    SQLTransformer,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.quantiles import exact_quantiles

VECTOR = "features"


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Median per column (one row per column reaches the driver); 0 for an empty column."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("v")) for c in columns]
    )
    values = df.select(F.explode(entries).alias("e")).select("e.*")
    found = {r["name"]: r["quantiles"][0] for r in exact_quantiles(values, "v", [0.5], ["name"]).collect()}
    return {c: float(found.get(c, 0.0)) for c in columns}


def modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent text per column, the alphabetically first on ties."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    counted = (
        df.select(F.explode(entries).alias("e"))
        .select("e.*")
        .where("v is not null")
        .groupBy("name", "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"]
    found = {r["name"]: r["v"] for r in counted.groupBy("name").agg(best.alias("v")).collect()}
    return {c: found.get(c, "") for c in columns}


def learned_values(preparation: PipelineModel, numeric: tuple[str, ...], categorical: tuple[str, ...]) -> list[tuple]:
    """(column, mean, standard deviation, known labels) as the fitted stages hold them, a row a column."""
    scaler = next(s for s in preparation.stages if isinstance(s, StandardScalerModel))
    rows = [
        (c, float(m), float(d), None) for c, m, d in zip(numeric, scaler.mean.toArray(), scaler.std.toArray())
    ]
    indexer = [s for s in preparation.stages if isinstance(s, StringIndexerModel)]
    labels = indexer[0].labelsArray if indexer else []
    return rows + [(c, None, None, len(known)) for c, known in zip(categorical, labels)]


def vector_names(preparation: PipelineModel, numeric: tuple[str, ...]) -> list[str]:
    """The input behind every entry of the model vector; ``<column>=<label>`` for an indicator."""
    inputs = preparation.stages[-1].getInputCols()
    indexer = next((s for s in preparation.stages if isinstance(s, StringIndexerModel)), None)
    texts = [c.removesuffix("__txt") for c in indexer.getInputCols()] if indexer else []
    names = {f"{c}__ord": c for c in texts}
    for c, labels in zip(texts, indexer.labelsArray if indexer else []):
        names |= {f"{c}__is{k}": f"{c}={label}" for k, label in enumerate(labels)}
    return [*numeric, *[names[c] for c in inputs[1:]]]


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preparation(
    train: DataFrame, numeric: tuple[str, ...], categorical: tuple[str, ...], one_hot: bool = False
) -> PipelineModel:
    """Median-impute and standardise numbers; mode-impute and encode text as sorted ordinals.

    A value not seen in training is encoded as -1. ``one_hot`` replaces the ordinals, whose order
    means nothing to a linear model, by indicator columns.
    """
    median, mode = exact_medians(train, list(numeric)), modes(train, list(categorical))
    filled = [
        f"coalesce(cast(`{c}` as double), cast({median[c]!r} as double)) AS `{c}__num`"
        for c in numeric
    ] + [f"coalesce(cast(`{c}` as string), {_text(mode[c])}) AS `{c}__txt`" for c in categorical]
    fill = SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")
    stages, ready = [fill], fill.transform(train)

    def add(stage):
        nonlocal ready
        fitted = stage.fit(ready) if hasattr(stage, "fit") else stage
        ready = fitted.transform(ready)
        stages.append(fitted)
        return fitted

    add(VectorAssembler(inputCols=[f"{c}__num" for c in numeric], outputCol="numeric__raw"))
    add(StandardScaler(inputCol="numeric__raw", outputCol="numeric__scaled", withMean=True))
    inputs = ["numeric__scaled"]
    if categorical:
        indexer = add(
            StringIndexer(
                inputCols=[f"{c}__txt" for c in categorical],
                outputCols=[f"{c}__idx" for c in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
        encoded = []
        for c, labels in zip(categorical, indexer.labelsArray):
            if one_hot:
                names = [f"{c}__is{i}" for i in range(len(labels))]
                encoded += [
                    f"cast(`{c}__idx` = {i} as double) AS `{name}`" for i, name in enumerate(names)
                ]
                inputs += names
            else:
                encoded.append(
                    f"CASE WHEN `{c}__idx` = {len(labels)} THEN -1D ELSE `{c}__idx` END AS `{c}__ord`"
                )
                inputs.append(f"{c}__ord")
        add(SQLTransformer(statement=f"SELECT *, {', '.join(encoded)} FROM __THIS__"))
    stages.append(VectorAssembler(inputCols=inputs, outputCol=VECTOR))
    return PipelineModel(stages)
