"""Every operator as a named query over a star-schema folder."""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial, reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import binning as b
from tidemark.functions.numeric import round_half_away
from tidemark.ml import attribution, curve, preparation, sampling, training
from tidemark.ml.candidates import FOREST, LOGISTIC, Settings
from tidemark.operators import commerce, correlation, distinct, features, profiling, risk, segments
from tidemark.operators.cleaning import clean_all, clean_customers, parse_date, rejected_customers, rejection_counters
from tidemark.plans import library
from tidemark.plans.inputs import CUSTOMER_COLUMNS, ROLLUP_COLUMNS, Inputs
from tidemark.session import settle, shared_dir
from tidemark.sources import colocated, publish, quarantine, readers, versions
from tidemark.sources.schemas import EXPECTED_COLUMNS, RAW_TABLES
from tidemark.sources.star_schema import SOURCES
from tidemark.streaming import timers, triggers

Query = Callable[[SparkSession, str], DataFrame]
Plan = Callable[[Inputs], DataFrame]

SPEND = ("total_spend_usd", "churned")
EXPORTED_ORDERS = (
    "order_id", "customer_id", "category", "order_status", "total_amount_usd", "discount_pct", "customer_rating", "returned",
    "session_duration_minutes", "pages_viewed_before_purchase",
)
CATEGORY_COLUMNS = ("order_id", "category", "total_amount_usd", "customer_rating", "returned")


def _first_customers(i: Inputs) -> DataFrame:
    columns = ("customer_id", "country", "membership_tier", "total_orders", "churned")
    return profiling.first_rows(i.customers(*columns), ["customer_id"])


def _shapes(i: Inputs) -> DataFrame:
    """Customers, and order lines with the months and products among them from one scan of the lines."""
    date = F.col("order_date")
    derived = {
        "monthly_revenue": ([F.year(date), F.month(date)], len(i.star.monthly_revenue().columns)),
        "product_summary": ([F.col("product_id")], len(i.products().columns)),
    }
    lines = profiling.shapes_in_one_pass(
        i.star.orders("order_date", "product_id"), "orders", len(i.star.orders().columns), derived
    )
    return profiling.table_shapes({"customers": i.raw_customers()}).unionByName(lines)


def _publication_counters(i: Inputs) -> DataFrame:
    """Customers and order lines cleaned and published; what was read, turned away and written, counted on the way."""
    folder = f"{shared_dir(i.spark)}/tidemark/counted-{uuid.uuid4().hex}"
    raw, read = quarantine.observed(
        i.raw_customers(*CUSTOMER_COLUMNS), "customers_read", {"rows": F.count(F.lit(1))} | rejection_counters()
    )
    customers, kept = quarantine.observed(
        clean_customers(raw, i.star.snapshot), "customers_written",
        {"rows": F.count(F.lit(1)), "no_review_score": F.count_if(F.col("avg_review_score").isNull())},
    )
    orders, lines = quarantine.observed(
        i.orders(*EXPORTED_ORDERS), "orders_written",
        {"rows": F.count(F.lit(1)), "imputed_ratings": F.sum("rating_imputed"), "discounted": F.sum("is_discounted")},
    )
    publish.write_tables({"customers": customers, "orders": orders}, folder)
    return quarantine.counters(i.spark, {"customers_read": read, "customers_written": kept, "orders_written": lines})


def _csv_quarantine(i: Inputs) -> DataFrame:
    """Order lines out to CSV, some of them spoilt, and back: lines read and kept, and why the others were not."""
    folder = f"{shared_dir(i.spark)}/tidemark/spoilt-{uuid.uuid4().hex}"
    schema = RAW_TABLES["orders"]
    spoilt = {"total_amount_usd": (7, "n/a"), "customer_rating": (16, "good, mostly"), "returned": (25, "1.5")}
    place = F.pmod(F.col("order_id"), F.lit(1000))
    lines = i.star.orders().select(
        *[F.when(place == spoilt[c][0], spoilt[c][1]).otherwise(F.col(c).cast("string")).alias(c) if c in spoilt else F.col(c) for c in schema.names]
    )
    lines.write.option("header", True).csv(f"{folder}/orders.csv")
    split = quarantine.split_lines(i.spark, f"{folder}/orders.csv", schema)
    counted = i.spark.createDataFrame([(k, v) for k, v in split.counts.items()], "item string, lines long")
    return counted.unionByName(split.quarantine.groupBy(F.col("reason").alias("item")).agg(F.count(F.lit(1)).alias("lines")))


def _ranges(i: Inputs) -> DataFrame:
    customers = i.customers("age", "total_spend_usd")
    parts = [
        profiling.value_range(customers, ["age", "total_spend_usd"]),
        profiling.value_range(i.star.orders("order_date"), ["order_date"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def _totals(i: Inputs) -> DataFrame:
    return profiling.table_totals(i.customers("churned"), i.star.monthly_revenue(with_returned=True))


def _relationships(i: Inputs) -> DataFrame:
    customers, predictions = i.scored()
    return profiling.relationship_check(
        customers, i.star.orders("customer_id"), settle(predictions.select("customer_id"), "predictions")
    )


def _revenue_table(i: Inputs) -> DataFrame:
    return i.revenue().withColumn("revenue_mom_pct", round_half_away(F.col("revenue_mom_pct"), 6))


def _customer_bins(i: Inputs) -> DataFrame:
    columns = (
        "customer_id", "days_since_last_purchase", "total_orders", "wishlist_items",
        "avg_review_score", "returns_made", "age", "customer_tenure_days",
    )
    return i.customers(*columns).select(
        "customer_id",
        b.RECENCY.of(F.col("days_since_last_purchase")).alias("recency_score"),
        b.FREQUENCY.of(F.col("total_orders")).alias("frequency_score"),
        b.WISHLIST.of(F.col("wishlist_items")).alias("wishlist_bucket"),
        b.REVIEW.of(F.col("avg_review_score")).alias("rating_bucket"),
        b.RETURNS.of(F.col("returns_made")).alias("return_bucket"),
        b.AGE.of(F.col("age")).alias("age_group"),
        b.tenure_cohort(F.col("customer_tenure_days")).alias("tenure_cohort"),
    )


def _spend_bins(i: Inputs) -> DataFrame:
    customers = i.settled_customers("customer_id", "total_spend_usd")
    spend = F.col("total_spend_usd").cast("double")
    ranked = customers.withColumn("_ranks", features.spend_ranks(customers))
    quartile = segments.quantile_label(customers, "total_spend_usd", b.SPEND_QUARTILES)
    return ranked.select(
        "customer_id",
        features.monetary_score(spend, F.col("_ranks")).alias("monetary_score"),
        features.value_segment(spend, F.col("_ranks")).alias("value_segment"),
        quartile.alias("spend_quartile"),
    )


def _pairs(i: Inputs) -> DataFrame:
    stored = settle(correlation.correlation_input(i.customers()), "correlated")
    return correlation.correlation_pairs(stored)


def _targets(i: Inputs) -> DataFrame:
    return correlation.target_correlations(correlation.correlation_input(i.customers()))


def _centres(i: Inputs) -> DataFrame:
    out = segments.class_centres(i.settled_customers(*SPEND), "total_spend_usd")
    return out.withColumn("median_value", round_half_away(F.col("median_value"), 4))


def _histogram(column: str, bins: int, upper: float | None, by_class: bool = True) -> Plan:
    columns = (column, "churned") if by_class else (column,)
    return lambda i: segments.histogram(
        i.settled_customers(*columns), column, bins, upper, by_class
    )


def _scored(plan: Callable[[DataFrame, DataFrame], DataFrame], *columns: str) -> Plan:
    """A report over customers and predictions."""
    return lambda i: plan(*i.scored(*columns))


def _tier_activity(i: Inputs) -> DataFrame:
    """Per risk tier: customers, spend, and orders, from tables stored in common buckets."""
    customers, predictions = i.scored("customer_id", "total_spend_usd")
    rollup = features.order_rollup(i.orders(*ROLLUP_COLUMNS)).select("customer_id", "order_count")
    stored = colocated.colocate(
        {"customers": customers.select("customer_id", "total_spend_usd"), "rollup": rollup,
         "predictions": predictions.select("customer_id", "risk_tier")}, "customer_id", 16,
    )
    joined = stored["customers"].join(stored["rollup"], "customer_id", "left").join(stored["predictions"], "customer_id")
    return joined.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum(F.col("total_spend_usd").cast("decimal(18,2)")).cast("double").alias("spend"),
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("orders"),
        F.count_if(F.col("order_count").isNull()).alias("without_orders"),
    )


def _loss_by(key: str) -> Plan:
    return _scored(lambda c, p: risk.revenue_at_risk(c, p, key), "total_spend_usd", key)


def _insights(i: Inputs) -> DataFrame:
    """The report on the champion's predictions and drivers."""
    result, features = _champion(i)
    predictions = settle(training.predict_all(result.champion, features), "predictions")
    return risk.insight_report(i.settled_customers(*CUSTOMER_COLUMNS), predictions, training.importance(result))


def _rule_insights(i: Inputs) -> DataFrame:
    customers, predictions = i.scored(*CUSTOMER_COLUMNS)
    predictions = settle(predictions, "predictions")
    return risk.insight_report(customers, predictions, i.importance(customers), 0.5)


def _report(i: Inputs) -> DataFrame:
    customers, predictions = i.scored("churned")
    scored = predictions.join(customers.select("customer_id", "churned"), "customer_id")
    return curve.classification_report(scored, "churned", "predicted_churn")


def _auc(i: Inputs) -> DataFrame:
    out = curve.area_under_roc(i.risk_scores(), "churned", "churn_risk_score")
    return out.select(round_half_away(F.col("auc"), 9).alias("auc"))


def _monthly_bitmaps(i: Inputs, lines: DataFrame) -> DataFrame:
    numbers = distinct.numbered(i.raw_customers("customer_id"), "customer_id")
    return distinct.monthly_bitmaps(lines.join(numbers, "customer_id"), "number")


def _active_periods(i: Inputs) -> DataFrame:
    """All periods from the stored monthly bitmaps and sketches; the order lines are read once."""
    month = F.trunc("order_date", "month").alias("order_date")
    lines = settle(i.star.orders("customer_id", "order_date").select("customer_id", month).distinct(), "active-months")
    bitmaps = settle(_monthly_bitmaps(i, lines), "monthly-members")
    return distinct.active_periods(bitmaps, settle(distinct.monthly_sketches(lines, "customer_id"), "monthly-sketches"))


def _annual_members(i: Inputs) -> DataFrame:
    """Years merged from monthly bitmaps."""
    return distinct.members(_monthly_bitmaps(i, i.star.orders("customer_id", "order_date")), "year").orderBy("year")


def _events(i: Inputs) -> DataFrame:
    return i.star.source("events").select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
    )


def _dormancy(i: Inputs) -> DataFrame:
    events = _events(i)
    now = events.agg(F.max("ts")).scalar()
    spells = triggers.dormant_by_now(triggers.dormancy(events, gap=dt.timedelta(hours=12)), now)
    return spells.select(
        "customer_id",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("active_from", "last_event", "dormant_at")],
        "events",
    )


def _follow_ups(i: Inputs) -> DataFrame:
    """The stream, run over the event file until nothing is left."""
    stream = (
        i.spark.readStream.schema(SOURCES["events"])
        .parquet(f"{i.star.folder}/event[s].parquet")  # a pattern may match a file or a folder
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    folder = f"{shared_dir(i.spark)}/tidemark/follow-ups-{uuid.uuid4().hex}"
    ups = triggers.return_follow_ups(stream, trigger="error")
    triggers.run_available(ups, folder)
    return triggers.written(i.spark, folder, ups.schema).select("event_id", "user_id", "event_type")


def _published(i: Inputs) -> tuple[str, dict[str, DataFrame]]:
    """Write the cleaned tables to shared storage; the order lines behind them are joined once."""
    i.star.store_lines()
    folder = f"{shared_dir(i.spark)}/tidemark/published-{uuid.uuid4().hex}"
    tables = {
        "customers": i.customers(),
        "orders": i.orders(),
        "monthly_revenue": i.revenue(),
        "product_summary": i.products(),
    }
    publish.write_tables(tables, folder)
    return folder, tables


def _published_rows(i: Inputs) -> DataFrame:
    folder, tables = _published(i)
    return publish.audit_rows(readers.load_clean(i.spark, folder, list(tables)))


def _published_columns(i: Inputs) -> DataFrame:
    folder, tables = _published(i)
    written = readers.load_clean(i.spark, folder, list(tables))
    expected = {k: v for k, v in EXPECTED_COLUMNS.items() if k in tables}
    return publish.audit_columns(i.spark, written, expected)


def _csv_reload(i: Inputs) -> DataFrame:
    """Raw order lines out to CSV and back under the declared schema, totalled per category."""
    folder = f"{shared_dir(i.spark)}/tidemark/csv-{uuid.uuid4().hex}"
    raw = i.star.orders().select(*RAW_TABLES["orders"].names)
    raw.write.option("header", True).csv(f"{folder}/orders.csv")
    back = readers.read_csv_table(i.spark, f"{folder}/orders.csv", RAW_TABLES["orders"])
    typed = back.withColumn("order_date", F.to_date(parse_date(back, "order_date")))
    return typed.groupBy("category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("returned").alias("returned"),
        F.sum(F.col("total_amount_usd").cast("decimal(18,4)")).cast("double").alias("revenue"),
        F.min("order_date").alias("first_order"),
    )


def _raw_csv(i: Inputs) -> str:
    """The four raw tables as headed CSV below shared storage."""
    folder = f"{shared_dir(i.spark)}/tidemark/raw-{uuid.uuid4().hex}"
    i.star.store_lines()
    tables = {
        "customers": i.raw_customers(),
        "orders": i.star.orders(),
        "monthly_revenue": i.star.monthly_revenue(),
        "product_summary": i.products(),
    }
    for name, df in tables.items():
        df.select(*RAW_TABLES[name].names).write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


def _clean_from_csv(i: Inputs) -> DataFrame:
    """The whole cleaning step from CSV, totalled per table."""
    cleaned = clean_all(readers.load_raw(i.spark, _raw_csv(i)), i.star.snapshot)
    measures = {
        "customers": "customer_tenure_days", "orders": "customer_rating",
        "monthly_revenue": "unique_customers", "product_summary": "total_orders",
    }
    parts = [
        cleaned[name].agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col(c).cast("double")).alias("measure"),
        )
        for name, c in measures.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _catalog_rows(i: Inputs) -> DataFrame:
    """Two tables published, read through catalog views, replaced by other rows, read through the same views."""
    root = f"{shared_dir(i.spark)}/tidemark/catalog-{uuid.uuid4().hex}"
    prefix = f"tidemark_{uuid.uuid4().hex[:12]}_"
    tables = {
        "customers": i.settled_customers("customer_id", "churned", "total_spend_usd"),
        "revenue": settle(i.revenue().select("year", "month", "revenue_usd"), "revenue"),
    }

    def seen(state: str) -> DataFrame:
        views = {n: i.spark.table(prefix + n) for n in tables}
        spend, revenue = (F.sum(F.col(c).cast("decimal(18,2)")).cast("double") for c in ("total_spend_usd", "revenue_usd"))
        parts = [
            views["customers"].agg(F.lit("customers").alias("table_name"), F.count(F.lit(1)).alias("row_count"), spend.alias("total")),
            views["revenue"].agg(F.lit("revenue").alias("table_name"), F.count(F.lit(1)).alias("row_count"), revenue.alias("total")),
        ]
        return settle(reduce(DataFrame.unionByName, parts).select(F.lit(state).alias("state"), "*"), "catalog-rows")

    versions.publish_version(tables, root)
    versions.create_views(i.spark, root, tables, prefix)
    first = seen("first")
    replaced = {
        "customers": tables["customers"].where("churned = 0").withColumn("total_spend_usd", F.col("total_spend_usd") * 2),
        "revenue": tables["revenue"].where("month <= 6"),
    }
    versions.publish_version(replaced, root)
    both = first.unionByName(seen("replaced"))
    for name in tables:
        i.spark.sql(f"DROP VIEW `{prefix}{name}`")
    return both


def _column_sums(tables: dict[str, DataFrame], numeric: dict[str, set[str]]) -> DataFrame:
    """Per table and column: rows with a value, and the sum (of a text: of its lengths)."""
    parts = []
    for name, df in tables.items():
        amount = lambda c: F.col(c).cast("double") if c in numeric[name] else F.length(F.col(c)).cast("double")  # noqa: E731, B023
        entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).isNotNull().cast("long").alias("n"), amount(c).alias("v")) for c in df.columns])
        parts.append(
            df.select(F.explode(entries).alias("e")).groupBy("e.column_name").agg(
                F.sum("e.n").alias("filled"), round_half_away(F.sum("e.v"), 2).alias("total")
            ).select(F.lit(name).alias("table_name"), "column_name", "filled", "total")
        )
    return reduce(DataFrame.unionByName, parts)


def _exported_views(i: Inputs) -> DataFrame:
    """All ten tables and views published, exported as CSV, read back and summed by column."""
    folder = f"{shared_dir(i.spark)}/tidemark/export-{uuid.uuid4().hex}"
    i.star.store_lines()
    customers, predictions = i.scored(*CUSTOMER_COLUMNS)
    tables = {
        "customers": customers.select(*CUSTOMER_COLUMNS), "orders": i.orders(*EXPORTED_ORDERS).select(*EXPORTED_ORDERS), "monthly_revenue": i.revenue(),
        "product_summary": i.products(), "churn_predictions": predictions, "shap_importance": _rounded_contributions(i),
    }
    publish.write_tables(tables, folder)
    written = readers.load_clean(i.spark, folder, list(tables))
    written |= library.business_views(written)
    publish.register_views(written)
    publish.export_csv(i.spark, f"{folder}/csv")
    numeric = {n: {c for c, t in df.dtypes if t not in ("string", "date", "timestamp", "timestamp_ntz", "boolean")} for n, df in written.items()}
    back = {n: i.spark.read.option("header", True).csv(f"{folder}/csv/{n}") for n in publish.EXPORTS}
    return _column_sums(back, numeric)


def _model_round_trip(i: Inputs) -> DataFrame:
    """Every candidate published, its saved model loaded again: customers, drivers, and scores that differ."""
    result, table = _champion(i)
    parts = []
    for name in result.fitted:
        folder = f"{shared_dir(i.spark)}/tidemark/model-{uuid.uuid4().hex}"
        written = training.publish_comparison(replace(result, best=name), table, folder)
        again = training.predict_all(training.load_model(i.spark, folder), table)
        both = written["churn_predictions"].join(
            again.select("customer_id", F.col("churn_probability").alias("p")), "customer_id", "full"
        )
        differs = ~F.col("churn_probability").eqNullSafe(F.col("p"))
        drivers = written["shap_importance"].agg(F.count(F.lit(1))).scalar()
        parts.append(both.agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("customers"), F.count_if(differs).alias("differing"), drivers.alias("drivers")
        ))
    return reduce(DataFrame.unionByName, parts)


def _dormancy_stream(i: Inputs, by_timer: bool = False) -> DataFrame:
    """Spells that the watermark (a day behind the last event) has passed, by session windows or keyed timers."""
    stream = (
        i.spark.readStream.schema(SOURCES["events"])
        .parquet(f"{i.star.folder}/event[s].parquet")
        .select(F.col("user_id").alias("customer_id"), F.col("ts").cast("timestamp").alias("ts"))
    )
    folder = f"{shared_dir(i.spark)}/tidemark/dormancy-{uuid.uuid4().hex}"
    spells = (timers.timed_dormancy if by_timer else triggers.dormancy)(stream, gap=dt.timedelta(hours=12))
    triggers.run_available(spells, folder)
    return triggers.written(i.spark, folder, spells.schema).select(
        "customer_id",
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("active_from", "last_event", "dormant_at")],
        "events",
    )


def _sizes(i: Inputs) -> DataFrame:
    customers = i.settled_customers("customer_id", "churned")
    train, test = sampling.stratified_split(customers, "customer_id", "churned")
    counted = [
        df.groupBy("churned").agg(F.count(F.lit(1)).alias(name))
        for df, name in ((train, "train_rows"), (test, "test_rows"))
    ]
    return counted[0].join(counted[1], "churned")


# Settings of the registered model queries: the full ones, as on the command line.
ENSEMBLES = Settings()


def _champion(i: Inputs, models=ENSEMBLES.models, cross_validate=True) -> tuple[training.Comparison, DataFrame]:
    """The fitted comparison and the features, fitted once per application and state of the source files, and stored."""
    settings = replace(ENSEMBLES, models=models)
    known = f"{i.spark.sparkContext.applicationId} {i.fingerprint()} {settings} {cross_validate}"
    state = hashlib.sha256(known.encode()).hexdigest()[:32]
    root = f"{shared_dir(i.spark)}/tidemark/fits/{state}"
    if versions.current(i.spark, root) is None:
        version = uuid.uuid4().hex
        features = settle(i.features(), "features")
        features.write.parquet(f"{root}/{version}/features")
        training.save_comparison(training.compare(features, settings, cross_validate=cross_validate), f"{root}/{version}")
        versions.switch(i.spark, root, version)
    folder = f"{root}/{versions.current(i.spark, root)[1]}"
    return training.load_comparison(i.spark, folder), i.spark.read.parquet(f"{folder}/features")


def _model_comparison(i: Inputs) -> DataFrame:
    """All candidates with test AUC and AUC by five folds; the best on the test rows is the champion."""
    return _champion(i)[0].table(i.spark)


def _cross_validation(i: Inputs) -> DataFrame:
    data = training.model_columns(settle(i.features(), "features"))
    scores = training.cross_validated_auc(data, Settings(models=(LOGISTIC,)))
    return i.spark.createDataFrame(list(scores.items()), "model string, cv_auc double")


def _churn_scores(i: Inputs) -> DataFrame:
    result, features = _champion(i)
    return training.predict_all(result.champion, features)


def _permutation(i: Inputs) -> DataFrame:
    result = _champion(i, (FOREST,), cross_validate=False)[0]
    score = partial(training.probability, result.champion.classifier)
    return attribution.permutation_importance(score, result.prepared_test, result.champion.feature_names)


# Whole-number coefficients of a score for checking the exchange of features.
EXCHANGED = {"days_since_last_purchase": 3, "total_orders": -40, "wishlist_items": 7, "age": -1}


def _exchange_losses(i: Inputs) -> DataFrame:
    """Loss of AUC of a fixed linear score when one of its inputs is exchanged, all inputs in one job."""
    customers = i.settled_customers("customer_id", "churned", *EXCHANGED)
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in EXCHANGED])
    prepared = customers.select("customer_id", F.col("churned").alias("label"), array_to_vector(values).alias(preparation.VECTOR))
    weights = F.array(*[F.lit(float(w)) for w in EXCHANGED.values()])

    def score(df: DataFrame) -> DataFrame:
        terms = F.zip_with(vector_to_array(preparation.VECTOR), weights, lambda x, w: x * w)
        return df.withColumn("p", F.aggregate(terms, F.lit(0.0), lambda total, x: total + x))

    losses = attribution.permutation_importance(score, prepared, list(EXCHANGED))
    return losses.select("feature", round_half_away(F.col("auc_loss"), 9).alias("auc_loss"))


@dataclass(frozen=True)
class FixedLinear:
    """A linear model with given coefficients, for checking what is derived from a fitted one."""

    coefficients: tuple[float, ...]


NUMERIC, CATEGORICAL = features.NUMERIC_FEATURES, features.CATEGORICAL_FEATURES
# Fixed values: -0.6 to 0.6 in steps of 0.3, repeating.
FIXED_COEFFICIENTS = FixedLinear(tuple((j % 5 - 2) * 0.3 for j in range(len(NUMERIC + CATEGORICAL))))


def _preparation_values(i: Inputs) -> DataFrame:
    data = settle(training.model_columns(i.features()), "model-columns")
    fitted = preparation.fit_preparation(data, NUMERIC, CATEGORICAL)
    medians = preparation.exact_medians(data, list(NUMERIC))
    modes = preparation.modes(data, list(CATEGORICAL))
    rows = [
        (c, medians.get(c), m, d, modes.get(c), n)
        for c, m, d, n in preparation.learned_values(fitted, NUMERIC, CATEGORICAL)
    ]
    learned = i.spark.createDataFrame(
        rows, "column_name string, median double, mean double, std double, mode string, labels int"
    )
    return learned.select(
        "column_name", *[round_half_away(F.col(c), 4).alias(c) for c in ("median", "mean", "std")], "mode", "labels"
    )


def _encoded_rows(i: Inputs) -> DataFrame:
    """Ordinals of all customers under a preparation that never saw one of the tiers."""
    data = settle(training.model_columns(i.features()), "model-columns")
    seen = data.where(F.coalesce(F.col("membership_tier") != "Platinum", F.lit(True)))
    encoded = preparation.fit_preparation(seen, NUMERIC, CATEGORICAL).transform(data)
    return encoded.select("customer_id", *[F.col(f"{c}__ord").cast("int").alias(c) for c in CATEGORICAL])


def _fold_sizes(i: Inputs) -> DataFrame:
    folded = sampling.stratified_folds(
        i.settled_customers("customer_id", "churned"), "customer_id", "churned"
    )
    return folded.groupBy("churned", "fold").agg(F.count(F.lit(1)).alias("customers"))


def _linear_contributions(i: Inputs) -> DataFrame:
    data = settle(training.model_columns(i.features()), "model-columns")
    fitted = preparation.fit_preparation(data, NUMERIC, CATEGORICAL)
    names = list(NUMERIC + CATEGORICAL)
    return attribution.linear_importance(FIXED_COEFFICIENTS, fitted.transform(data), names)


def _rounded_contributions(i: Inputs) -> DataFrame:
    out = _linear_contributions(i)
    return out.select("feature", round_half_away(F.col("mean_abs_shap"), 6).alias("mean_abs_shap"))


PLANS: dict[str, Plan] = {
    # profiling
    "table_shapes": _shapes,
    "first_customers": _first_customers,
    "column_info": lambda i: profiling.column_info(i.customers()),
    "describe_customers": lambda i: profiling.describe(
        i.settled_customers(*[c for c in CUSTOMER_COLUMNS if c != "registration_date"]),
        ["age", "total_orders", "total_spend_usd", "avg_order_value_usd",
         "days_since_last_purchase", "reviews_given", "avg_review_score", "returns_made",
         "wishlist_items", "newsletter_subscribed", "churned"],
    ),
    "null_counts": lambda i: profiling.null_counts(i.star.orders()),
    "duplicate_rows": lambda i: profiling.duplicate_count(i.star.orders()),
    "duplicate_keys": lambda i: profiling.duplicate_count(i.star.orders("order_id"), ["order_id"]),
    "distinct_tiers": lambda i: profiling.distinct_values(
        i.customers("membership_tier"), "membership_tier"
    ),
    "churn_value_counts": lambda i: profiling.value_counts(i.customers("churned"), "churned"),
    "order_status_counts": lambda i: profiling.value_counts(i.star.orders("order_status"), "order_status"),
    "value_ranges": _ranges,
    "distinct_counts": lambda i: profiling.distinct_counts(
        i.star.orders("category", "order_status", "customer_id"), ["category", "order_status", "customer_id"]
    ),
    "table_totals": _totals,
    "product_category_means": lambda i: profiling.product_category_means(i.products()),
    "relationship_check": _relationships,
    # cleaning
    "cleaned_customers": lambda i: i.customers(),
    "rejected_customers": lambda i: rejected_customers(
        i.raw_customers("age", "total_orders", "total_spend_usd", "avg_review_score")
    ),
    "cleaned_orders": lambda i: i.orders(),
    "cleaned_revenue": _revenue_table,
    # bins
    "customer_bins": _customer_bins,
    "spend_bins": _spend_bins,
    "age_quartiles": lambda i: segments.age_quartiles(
        i.settled_customers("customer_id", "age"), ["customer_id"]
    ),
    # business library
    "executive_kpis": lambda i: segments.executive_kpis(i.customers(*SPEND)),
    "churn_by_tier": lambda i: segments.churn_by_tier(i.customers("membership_tier", *SPEND)),
    "churn_by_channel": lambda i: segments.churn_by_channel(
        i.customers("acquisition_channel", *SPEND)
    ),
    "revenue_trend": lambda i: commerce.revenue_trend(i.revenue()),
    "revenue_per_user": lambda i: commerce.revenue_per_user(commerce.revenue_trend(i.revenue())),
    "category_performance": lambda i: commerce.category_performance(
        i.star.orders(*CATEGORY_COLUMNS, "discount_pct", "delivery_days")
    ),
    "order_status_funnel": lambda i: commerce.order_status_funnel(i.star.orders("order_status", "total_amount_usd")),
    "device_payment_matrix": lambda i: segments.device_payment_matrix(
        i.customers("preferred_device", "preferred_payment_method", *SPEND)
    ),
    "tenure_cohorts": lambda i: segments.tenure_cohorts(
        i.customers("customer_tenure_days", *SPEND)
    ),
    "product_quadrants": lambda i: commerce.product_quadrants(
        settle(i.products(), "products"), ["product_id"]
    ),
    "quadrant_sizes": lambda i: commerce.quadrant_sizes(settle(i.products(), "products")),
    # findings
    "churn_split": lambda i: segments.churn_split(i.customers(*SPEND)),
    "ltv_gap": lambda i: segments.ltv_gap(i.customers(*SPEND)),
    "tier_breakdown": lambda i: segments.tier_breakdown(
        i.customers("customer_id", "membership_tier", *SPEND)
    ),
    "channel_stats": lambda i: segments.channel_stats(
        i.customers("customer_id", "acquisition_channel", *SPEND)
    ),
    "recency_by_class": lambda i: segments.recency_by_class(
        i.customers("churned", "days_since_last_purchase")
    ),
    "churn_by_engagement": lambda i: segments.churn_by_engagement(
        i.customers("churned", "newsletter_subscribed", "wishlist_items", "reviews_given")
    ),
    "churn_by_wishlist": lambda i: segments.churn_by_wishlist(
        i.customers("churned", "wishlist_items")
    ),
    "churn_by_spend_quartile": lambda i: segments.churn_by_spend_quartile(
        i.settled_customers(*SPEND)
    ),
    "top_spender_churn": lambda i: segments.top_spender_churn(i.settled_customers(*SPEND)),
    "churn_by_review": lambda i: segments.churn_by_review(
        i.customers("churned", "avg_review_score", "reviews_given")
    ),
    "churn_by_returns": lambda i: segments.churn_by_returns(
        i.customers("churned", "returns_made")
    ),
    "primary_category": lambda i: features.primary_category(i.star.orders("customer_id", "category")),
    "churn_by_primary_category": lambda i: segments.churn_by_primary_category(
        i.customers("customer_id", "churned"),
        features.primary_category(i.star.orders("customer_id", "category")),
    ),
    "category_returns": lambda i: commerce.category_returns(i.star.orders(*CATEGORY_COLUMNS)),
    "most_returned_category": lambda i: commerce.most_returned_categories(
        i.star.orders("category", "returned")
    ),
    "rolling_revenue": lambda i: commerce.rolling_revenue(i.star.monthly_revenue()),
    "annual_summary": lambda i: commerce.annual_summary(i.star.monthly_revenue()),
    "annual_unique_customers": _annual_members,
    "active_periods": _active_periods,
    "category_revenue": lambda i: commerce.category_revenue(i.star.orders(*CATEGORY_COLUMNS)),
    "top_categories": lambda i: commerce.top_categories(i.star.orders(*CATEGORY_COLUMNS)),
    "churn_by_age": lambda i: segments.churn_by_age(i.customers("churned", "age")),
    "top_countries": lambda i: segments.top_values(i.customers("country"), "country", 8),
    "churn_by_top_countries": lambda i: segments.churn_by_top_countries(
        i.settled_customers("country", "churned")
    ),
    "churn_by_gender": lambda i: segments.churn_by_gender(i.customers("gender", "churned")),
    "recency_histogram": _histogram("days_since_last_purchase", 40, 600),
    "spend_histogram": _histogram("total_spend_usd", 45, 5000),
    "spend_histogram_overall": _histogram("total_spend_usd", 30, None, by_class=False),
    "spend_centres": _centres,
    "recency_box": lambda i: segments.box_stats(
        i.settled_customers("churned", "days_since_last_purchase"), "days_since_last_purchase"
    ),
    "correlation_matrix": lambda i: correlation.correlation_matrix(settle(_pairs(i), "pairs")),
    "correlation_triangle": _pairs,
    "target_correlations": _targets,
    "strongest_correlations": lambda i: correlation.strongest(_targets(i)),
    "collinear_pairs": lambda i: correlation.collinear_pairs(_pairs(i)),
    # features
    "order_rollup": lambda i: features.order_rollup(i.orders(*ROLLUP_COLUMNS)),
    "feature_table": lambda i: i.features(),
    # scored customers
    "prediction_table": lambda i: i.predictions(),
    "at_risk_list": _scored(risk.at_risk_list, *risk.AT_RISK_COLUMNS[1:]),
    "risk_tier_revenue": _scored(risk.risk_tier_revenue, "total_spend_usd"),
    "tier_activity": _tier_activity,
    "tier_counts": lambda i: risk.tier_counts(i.predictions()),
    "revenue_at_risk": _scored(risk.revenue_at_risk, "total_spend_usd"),
    "revenue_at_risk_by_country": _loss_by("country"),
    "revenue_at_risk_by_membership_tier": _loss_by("membership_tier"),
    "revenue_at_risk_by_acquisition_channel": _loss_by("acquisition_channel"),
    "cohort_profile": _scored(
        lambda c, p: risk.cohort_profile(c, p, 0.5),
        *risk.PROFILE_KEYS, "returns_made", "total_orders", "avg_review_score",
    ),
    "top_linear_drivers": lambda i: risk.top_drivers(_linear_contributions(i)),
    "retention_list": _scored(
        risk.retention_list, "membership_tier", "total_spend_usd", "days_since_last_purchase"
    ),
    "retention_list_by_spend": _scored(
        lambda c, p: risk.retention_list(c, p, "total_spend_usd", 50),
        "membership_tier", "total_spend_usd", "days_since_last_purchase",
    ),
    "high_risk_sample": lambda i: risk.high_risk_sample(i.predictions(), 0.5),
    "insight_report_by_rule": _rule_insights,
    # model quality, on the rule-based score
    "best_threshold": lambda i: curve.best_threshold(
        i.risk_scores(), "churned", "churn_risk_score"
    ),
    "precision_recall_curve": lambda i: curve.precision_recall(
        i.risk_scores(), "churned", "churn_risk_score"
    ),
    "risk_score_auc": _auc,
    "classification_report": _report,
    "split_sizes": _sizes,
    "fold_sizes": _fold_sizes,
    "preparation_values": _preparation_values,
    "encoded_rows": _encoded_rows,
    "linear_contributions": _rounded_contributions,
    "exchange_losses": _exchange_losses,
    "class_weights": lambda i: sampling.class_weights(i.customers("churned"), "churned"),
    # storage
    "csv_quarantine": _csv_quarantine,
    "publication_counters": _publication_counters,
    "csv_reload": _csv_reload,
    "published_rows": _published_rows,
    "published_columns": _published_columns,
    "clean_from_csv": _clean_from_csv,
    "catalog_rows": _catalog_rows,
    "exported_views": _exported_views,
    "model_round_trip": _model_round_trip,
    # event-driven triggers
    "dormancy_spells": _dormancy,
    "dormancy_stream": _dormancy_stream,
    "dormancy_timers": lambda i: _dormancy_stream(i, by_timer=True),
    "return_follow_ups": _follow_ups,
}

# Model fits: no SQL equivalent.
MODEL_PLANS: dict[str, Plan] = {
    "churn_scores": _churn_scores,
    "driver_importance": lambda i: training.importance(_champion(i)[0]),
    "top_drivers": lambda i: risk.top_drivers(training.importance(_champion(i)[0])),
    "insight_report": _insights,
    "model_report": lambda i: training.test_report(_champion(i)[0]),
    "forest_importance": lambda i: training.importance(_champion(i, (FOREST,), cross_validate=False)[0]),
    "permutation_importance": _permutation,
    "logistic_cross_validation": _cross_validation,
    "model_comparison": _model_comparison,
}


def as_query(plan: Plan) -> Query:
    return lambda spark, folder: plan(Inputs(spark, folder))


def all_queries() -> dict[str, Query]:
    return {name: as_query(plan) for name, plan in (PLANS | MODEL_PLANS).items()}


# Timed by the benchmark: one or more per operator family, without near-duplicates.
HEADLINE = (
    "executive_kpis", "churn_by_tier", "churn_by_channel", "revenue_per_user",
    "category_performance", "order_status_funnel", "device_payment_matrix", "tenure_cohorts",
    "product_quadrants", "at_risk_list", "risk_tier_revenue", "top_linear_drivers",
    "table_shapes", "column_info", "describe_customers", "null_counts", "duplicate_rows",
    "distinct_counts", "table_totals", "relationship_check",
    "cleaned_customers", "cleaned_orders", "cleaned_revenue",
    "customer_bins", "spend_bins", "age_quartiles",
    "tier_breakdown", "recency_by_class", "churn_by_engagement", "churn_by_spend_quartile",
    "churn_by_primary_category", "churn_by_top_countries", "churn_by_age",
    "rolling_revenue", "annual_unique_customers", "top_categories",
    "recency_histogram", "recency_box", "correlation_matrix", "target_correlations",
    "order_rollup", "feature_table", "prediction_table", "cohort_profile", "insight_report_by_rule",
    "best_threshold", "risk_score_auc", "classification_report", "split_sizes", "csv_reload",
    "dormancy_spells", "return_follow_ups", "published_rows", "clean_from_csv", "preparation_values",
    "linear_contributions", "active_periods", "exchange_losses", "publication_counters", "dormancy_timers",
    "model_comparison", "churn_scores", "insight_report", "permutation_importance",
)
