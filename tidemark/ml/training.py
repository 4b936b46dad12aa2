"""Training, comparison, scoring and publishing of the churn model."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.ml.attribution import driver_importance
from tidemark.ml.candidates import BOOSTING, FOREST, LOGISTIC, Settings, logistic
from tidemark.ml.curve import area_under_roc, best_threshold, classification_report
from tidemark.ml.preparation import VECTOR, fit_preparation, vector_names
from tidemark.ml.sampling import class_weights, stratified_folds, stratified_split
from tidemark.ml.trees import TreeModel, bin_rows, grow_boosted, grow_forest, scored_rows
from tidemark.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from tidemark.operators.risk import predictions_from
from tidemark.session import drop_unused, settle, shared_dir

KEY = "customer_id"
TEST, CHOICE = -1, -2  # fold numbers of rows that are scored, never fitted
FOLDS_BESIDE_TREES = 2  # linear folds under way at once, by what the driver's memory holds besides


@dataclass
class Trained:
    """A fitted preparation and classifier with the decision threshold."""

    name: str
    preparation: PipelineModel
    classifier: object
    threshold: float
    feature_names: list[str]

    @property
    def version(self) -> str:
        return self.name.lower().replace(" ", "_") + "_v1"

    def score(self, features: DataFrame) -> DataFrame:
        """Adds the churn probability ``p``."""
        return probability(self.classifier, self.preparation.transform(features))


def probability(classifier, prepared: DataFrame) -> DataFrame:
    """Adds the churn probability ``p`` to prepared rows."""
    if isinstance(classifier, TreeModel):
        return classifier.probabilities(prepared, VECTOR)
    out = classifier.transform(prepared)
    return out.withColumn("p", vector_to_array("probability")[1])


def _columns(df: DataFrame) -> tuple[tuple[str, ...], tuple[str, ...]]:
    numeric = tuple(c for c in NUMERIC_FEATURES if c in df.columns)
    categorical = tuple(c for c in CATEGORICAL_FEATURES if c in df.columns)
    return numeric, categorical


def model_columns(features: DataFrame) -> DataFrame:
    """Key, target and the available model inputs."""
    numeric, categorical = _columns(features)
    return features.select(KEY, TARGET, *numeric, *categorical).where(F.col(TARGET).isNotNull())


def _fit_preparation(train: DataFrame, settings: Settings) -> PipelineModel:
    return fit_preparation(train, *_columns(train), one_hot=settings.one_hot)


def _linear_rows(preparation: PipelineModel, train: DataFrame) -> DataFrame:
    """Prepared training rows of the linear candidate with their class weight."""
    weights = settle(class_weights(train, TARGET).drop("customers"), "class-weights")
    weighted = preparation.transform(train).join(weights, TARGET)
    return weighted.select(KEY, F.col(TARGET).cast("double").alias("label"), VECTOR, "balanced_weight")


def _fit_logistic(preparation: PipelineModel, train: DataFrame, settings: Settings) -> LogisticRegressionModel:
    """The fitted model as read back from storage: a fresh one holds its training summary and with it the session,
    which cannot go to tasks once counters have been observed in that session. What preparing the rows left in the
    driver is dropped first."""
    drop_unused(train.sparkSession.sparkContext)
    rows = settle(_linear_rows(preparation, train), "linear-rows")
    path = f"{shared_dir(train.sparkSession)}/tidemark/linear-{uuid.uuid4().hex}"
    logistic(settings, rows.count()).fit(rows).write().save(path)
    return LogisticRegressionModel.load(path)


def _auc(classifier, prepared: DataFrame) -> float:
    return area_under_roc(probability(classifier, prepared), "label", "p").first()["auc"]


def _labelled_vectors(preparation: PipelineModel, df: DataFrame) -> DataFrame:
    return preparation.transform(df).select(KEY, F.col(TARGET).cast("double").alias("label"), VECTOR)


def linear_fold_auc(folded: DataFrame, settings: Settings, at_once: int | None = None) -> list[float]:
    """AUC of the linear candidate on every fold, preparation and model refitted without it; ``at_once`` (all) side by side.

    Each fold under way holds its own plans and code in the driver's memory.
    """

    def one(fold: int) -> float:
        rest, held = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        preparation = _fit_preparation(rest, settings)
        return _auc(_fit_logistic(preparation, rest, settings), _labelled_vectors(preparation, held))

    with ThreadPool(at_once or settings.folds) as pool:
        return pool.map(one, range(settings.folds), chunksize=1)


def _tree_rows(preparation: PipelineModel, df: DataFrame, settings: Settings) -> DataFrame:
    """Key, label, fold and the prepared entries, null again where the input was missing."""
    numeric, categorical = _columns(df)
    texts = () if settings.one_hot else categorical  # an indicator of a missing text is that of the mode
    gaps = F.array(*[F.col(c).isNull() for c in (*numeric, *texts)])
    vector = F.zip_with(vector_to_array(VECTOR), gaps, lambda v, gap: F.when(~F.coalesce(gap, F.lit(False)), v))
    return preparation.transform(df).select(KEY, F.col(TARGET).cast("double").alias("label"), "fold", vector.alias("x"))


def _filled_values(preparation: PipelineModel, train: DataFrame) -> list[float]:
    """What the preparation puts for a row without any input."""
    empty = train.sparkSession.createDataFrame([tuple(None for _ in train.columns)], train.schema)
    return preparation.transform(empty).select(VECTOR).first()[0].toArray().tolist()


@dataclass
class TreeFit:
    """Fitted tree candidates, and every row scored: by the full fit and, for training rows, by its fold's model."""

    models: dict[str, TreeModel]
    scored: DataFrame  # key, label, fold, model, p, p_held

    def aucs(self) -> dict[tuple[str, int], float]:
        """AUC per (model, fold): held-out predictions of each fold, full-fit predictions of negative folds."""
        value = F.when(F.col("fold") < 0, F.col("p")).otherwise(F.col("p_held"))
        grouped = self.scored.select("model", "fold", "label", value.alias("score"))
        found = area_under_roc(grouped, "label", "score", ["model", "fold"]).collect()
        return {(r["model"], r["fold"]): r["auc"] for r in found}


def fit_trees(preparation: PipelineModel, train: DataFrame, rows: DataFrame, settings: Settings, folds: int) -> TreeFit | None:
    """Forest and boosted trees for all folds and the full fit in shared passes over ``rows`` (with ``fold``)."""
    wanted = [m for m in (FOREST, BOOSTING) if m in settings.models]
    if not wanted:
        return None
    ordinals = 0 if settings.one_hot else len(_columns(train)[1])
    binned = bin_rows(_tree_rows(preparation, rows, settings), KEY, folds, _filled_values(preparation, train), ordinals)

    def forest():
        return grow_forest(binned, settings.forest_trees, settings.forest_depth, settings.seed)

    def boosting():
        ratio = class_weights(train, TARGET).where(F.col(TARGET) == 1).select("boosting_weight").first()
        return grow_boosted(
            binned, settings.boosting_rounds, settings.boosting_depth, settings.boosting_step, settings.boosting_sample,
            float(ratio[0]) if ratio else 1.0, settings.seed,
        )

    with ThreadPool(2) as pool:  # side by side: their passes share the cluster
        grown = [pool.apply_async(grow) if m in wanted else None for m, grow in ((FOREST, forest), (BOOSTING, boosting))]
        forests = grown[0].get() if grown[0] else None
        boosted, scored = grown[1].get() if grown[1] else (None, binned)
    models = {}
    drop_unused(train.sparkSession.sparkContext)
    if forests:
        models[FOREST] = TreeModel("forest", forests[-1], binned.edges)
    if boosted:
        models[BOOSTING] = TreeModel("boosting", boosted[-1], binned.edges)
    own = {FOREST: "forest", BOOSTING: "boosting"}
    rows = scored_rows(scored, KEY, forests, boosted is not None).select(
        KEY, "label", "fold", F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(own[m]).alias("by_model")) for m in wanted])).alias("s")
    )
    by_model = F.col("s.by_model")
    held = F.when((F.col("fold") >= 0) & F.lit(folds > 0), F.get(by_model, F.col("fold")))
    predicted = rows.select(KEY, "label", "fold", "s.model", F.element_at(by_model, -1).alias("p"), held.alias("p_held"))
    predicted = settle(predicted, "tree-predictions")
    for kept in (binned, scored):
        kept.blocks.unpersist()
    return TreeFit(models, predicted)


def cross_validated_auc(train: DataFrame, settings: Settings) -> dict[str, float]:
    """Mean AUC per candidate over label-stratified folds; each fold's rows are scored by models fitted without them."""
    folded = settle(stratified_folds(train, KEY, TARGET, settings.folds, settings.seed + 1), "folds")
    found = {}
    if LOGISTIC in settings.models:
        found[LOGISTIC] = sum(linear_fold_auc(folded, settings)) / settings.folds
    fitted = fit_trees(_fit_preparation(train, settings), train, folded, settings, settings.folds)
    return found | _fold_means(fitted, settings)


def _fold_means(fitted: TreeFit | None, settings: Settings) -> dict[str, float]:
    if fitted is None:
        return {}
    aucs = fitted.aucs()
    return {m: sum(aucs[m, f] for f in range(settings.folds)) / settings.folds for m in fitted.models}


@dataclass
class Comparison:
    """Outcome of ``compare``: candidate scores, the champion and the evaluated rows."""

    scores: dict[str, dict[str, float | None]]
    fitted: Mapping[str, Trained]
    best: str
    train: DataFrame
    test: DataFrame
    prepared_test: DataFrame

    @property
    def champion(self) -> Trained:
        return self.fitted[self.best]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (name, round(s["test_auc"], 4), None if s["cv_auc"] is None else round(s["cv_auc"], 4),
             name == self.best)
            for name, s in self.scores.items()
        ]
        return spark.createDataFrame(
            rows, "model string, test_auc double, cv_auc double, champion boolean"
        )


def compare(
    features: DataFrame,
    settings: Settings = Settings(),
    selection: str = "test",
    cross_validate: bool = True,
) -> Comparison:
    """Fit the candidates, pick the best by AUC and its threshold by F-beta.

    ``selection="test"`` chooses model and threshold on the same rows that are later reported,
    which flatters the report; ``selection="validation"`` sets a further part aside for it.
    ``features`` is read several times: pass a stored table.
    """
    data = model_columns(features)
    numeric, _ = _columns(data)
    train, test = stratified_split(data, KEY, TARGET, settings.test_share, settings.seed)
    chosen_on = None
    if selection == "validation":
        share = settings.test_share / (1 - settings.test_share)
        train, chosen_on = stratified_split(train, KEY, TARGET, share, settings.seed + 2)
    elif selection != "test":
        raise ValueError(f"unknown selection {selection!r}")
    train = settle(train, "train")
    preparation = _fit_preparation(train, settings)
    held = {TEST: test} if chosen_on is None else {TEST: test, CHOICE: chosen_on}
    vectors = {k: settle(_labelled_vectors(preparation, df), "held-rows") for k, df in held.items()}
    choice = CHOICE if CHOICE in held else TEST
    folded = train.withColumn("fold", F.lit(0))
    if cross_validate:
        folded = settle(stratified_folds(train, KEY, TARGET, settings.folds, settings.seed + 1), "folds")
    rows = reduce(DataFrame.unionByName, [folded, *(df.withColumn("fold", F.lit(k)) for k, df in held.items())])
    folds = settings.folds if cross_validate else 0

    def linear() -> tuple[dict, dict]:
        if LOGISTIC not in settings.models:
            return {}, {}
        model = _fit_logistic(preparation, train, settings)
        return {LOGISTIC: model}, {(LOGISTIC, k): _auc(model, rows) for k, rows in vectors.items()}

    def linear_folds() -> dict:
        if LOGISTIC not in settings.models or not folds:
            return {}
        at_once = FOLDS_BESIDE_TREES if len(settings.models) > 1 else None
        return {LOGISTIC: sum(linear_fold_auc(folded, settings, at_once)) / folds}

    drop_unused(features.sparkSession.sparkContext)  # what making and splitting the features left in the driver
    with ThreadPool(2) as pool:  # the linear candidate and its folds beside the trees
        side, in_folds = pool.apply_async(linear), pool.apply_async(linear_folds)
        trees = fit_trees(preparation, train, rows, settings, folds)
        (fitted, aucs), cv = side.get(), in_folds.get()
    if trees is not None:
        fitted |= trees.models
        aucs |= trees.aucs()
        cv |= _fold_means(trees, settings) if cross_validate else {}
    fitted = {name: fitted[name] for name in settings.models}
    best = max(fitted, key=lambda name: round(aucs[name, choice], 4))
    names = vector_names(preparation, numeric)

    def trained(name: str) -> Trained:
        if trees is not None and name in trees.models:
            chosen = trees.scored.where((F.col("model") == name) & (F.col("fold") == choice))
        else:
            chosen = probability(fitted[name], vectors[choice])
        cut = best_threshold(chosen, "label", "p", settings.beta).first()
        return Trained(name, preparation, fitted[name], cut["threshold"], names)

    drop_unused(features.sparkSession.sparkContext)
    scores = {n: {"test_auc": aucs[n, TEST], "cv_auc": cv.get(n)} for n in fitted}
    return Comparison(scores, {n: trained(n) for n in fitted}, best, train, test, vectors[TEST])


class StoredModels(Mapping):
    """Stored candidates by name, each read when it is first asked for."""

    def __init__(self, spark: SparkSession, folders: dict[str, str]):
        self.spark, self.folders, self.read = spark, folders, {}

    def __getitem__(self, name: str) -> Trained:
        if name not in self.read:
            self.read[name] = load_model(self.spark, self.folders[name])
        return self.read[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.folders)

    def __len__(self) -> int:
        return len(self.folders)


def save_comparison(result: Comparison, folder: str) -> None:
    """All candidates, their scores and the rows they were compared on."""
    spark = SparkSession.active()
    with ThreadPool(max(1, len(result.fitted))) as pool:  # each is many small files
        pool.map(lambda own: save_model(own[1], f"{folder}/candidate-{own[0]}"), list(enumerate(result.fitted.values())), chunksize=1)
    rows = [(k, n, n == result.best, s["test_auc"], s["cv_auc"]) for k, (n, s) in enumerate(result.scores.items())]
    schema = "place int, model string, best boolean, test_auc double, cv_auc double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/scores")
    for name in ("train", "test", "prepared_test"):
        getattr(result, name).write.parquet(f"{folder}/{name}")


def load_comparison(spark: SparkSession, folder: str) -> Comparison:
    rows = spark.read.parquet(f"{folder}/scores").orderBy("place").collect()
    frames = [spark.read.parquet(f"{folder}/{name}") for name in ("train", "test", "prepared_test")]
    return Comparison(
        {r["model"]: {"test_auc": r["test_auc"], "cv_auc": r["cv_auc"]} for r in rows},
        StoredModels(spark, {r["model"]: f"{folder}/candidate-{r['place']}" for r in rows}),
        next(r["model"] for r in rows if r["best"]), *frames,
    )


def importance(result: Comparison) -> DataFrame:
    return driver_importance(
        result.champion.classifier, result.prepared_test, result.champion.feature_names
    )


def predict_all(champion: Trained, features: DataFrame) -> DataFrame:
    """The prediction table for every customer, training rows included."""
    return predictions_from(champion.score(features), "p", champion.threshold, champion.version)


def test_report(result: Comparison) -> DataFrame:
    """Classification report of the champion on the test rows at its threshold."""
    scored = probability(result.champion.classifier, result.prepared_test)
    called = scored.withColumn("called", (F.col("p") >= result.champion.threshold).cast("int"))
    return classification_report(called, "label", "called")


def save_model(champion: Trained, folder: str) -> None:
    """Preparation and classifier, with threshold and name beside them; trees are stored as a table."""
    spark, trees = SparkSession.active(), isinstance(champion.classifier, TreeModel)
    stages = [*champion.preparation.stages, *([] if trees else [champion.classifier])]
    PipelineModel(stages).write().overwrite().save(f"{folder}/model")
    if trees:
        champion.classifier.save(spark, f"{folder}/trees")
    meta = [(champion.name, champion.version, champion.threshold, champion.feature_names, trees)]
    spark.createDataFrame(
        meta, "name string, version string, threshold double, feature_names array<string>, trees boolean"
    ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/metadata")


def load_model(spark: SparkSession, folder: str) -> Trained:
    fused = PipelineModel.load(f"{folder}/model")
    meta = spark.read.parquet(f"{folder}/metadata").first()
    if meta["trees"]:
        preparation, classifier = fused, TreeModel.load(spark, f"{folder}/trees")
    else:
        preparation, classifier = PipelineModel(fused.stages[:-1]), fused.stages[-1]
    return Trained(meta["name"], preparation, classifier, meta["threshold"], list(meta["feature_names"]))


def train_and_publish(
    features: DataFrame, folder: str, settings: Settings = Settings(), selection: str = "test",
    cross_validate: bool = True,
) -> dict[str, DataFrame]:
    """Train, explain, score and write model, predictions and importances."""
    return publish_comparison(compare(features, settings, selection, cross_validate), features, folder)


def publish_comparison(result: Comparison, features: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Write the champion's model, predictions of all ``features`` and importances."""
    drivers = importance(result)
    predictions = predict_all(result.champion, features)
    save_model(result.champion, folder)
    tables = {"churn_predictions": predictions, "shap_importance": drivers}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    spark = features.sparkSession
    written = {name: spark.read.parquet(f"{folder}/{name}") for name in tables}
    return written | {"comparison": result.table(spark), "report": test_report(result)}
