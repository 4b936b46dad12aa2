"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in hash order, followed by the same documents once more.
A document's virtual finish time is the words its source has sent so far divided by the source's
weight. All queues are range-sorted by finish time and cut where the total budget is used up: a
source that runs out simply leaves its share to the others, which is what resharing by weight means.
The document at the head of a queue after the cut is taken too if its middle lies before the target.

Nothing is gathered per source: running totals are taken inside hash slices of bounded size and
offset by the slices before them, and the global cut is looked for in one slice of the range sort.
What leaves the range sort is one cut per source, so whole documents are joined with a small table.

Defined results: a null text has size 0; a null source is a source of its own, ranked last; rows
with equal ids follow each other by size and text, so that reruns agree, and are taken together; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_PATTERN, shuffle_parts, store

KEY_BITS = 60


@dataclass(frozen=True)
class MixRules:
    weights: tuple[int, ...] = (3, 1, 2)  # by source in code point order, repeating
    budget: float = 1.5  # words taken, as a multiple of all words
    repeats: int = 2  # a source gives at most this many times its words
    slice_rows: int = 4096  # documents of one source in a slice, on average at most
    seed: str = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def order_key(id_col: str, seed: str) -> Column:
    """60 hash bits of the id: the shuffled order inside a source."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, rules: MixRules) -> DataFrame:
    """One row per source: rank, weight, size, rows and target (the water level of the weights)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weights = F.array(*(F.lit(float(w)) for w in rules.weights))
    ranked = ranked.withColumn("weight", F.element_at(weights, (F.col("rank") - 1) % len(rules.weights) + 1))
    ranked = ranked.withColumn("most", (F.col("source_size") * rules.repeats).cast("double"))
    full = Window.orderBy("full_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    same = Window.partitionBy("full_at")
    level = (
        ranked.withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("goal", F.sum("source_size").over(every) * F.lit(rules.budget))
        .withColumn("closed", F.sum("most").over(full))
        .withColumn("open", F.sum("weight").over(every) - F.sum("weight").over(full))
        .withColumn("closed_below", F.col("closed") - F.sum("most").over(same))
        .withColumn("open_from", F.col("open") + F.sum("weight").over(same))
        .withColumn("reached", F.col("closed") + F.col("open") * F.col("full_at") >= F.col("goal"))
        .withColumn("candidate", (F.col("goal") - F.col("closed_below")) / F.col("open_from"))
        .withColumn("level", F.min(F.when(F.col("reached"), F.struct("full_at", "candidate"))).over(every)["candidate"])
    )
    target = F.least("most", F.col("weight") * F.col("level"))
    return level.select("source", "rank", "weight", "source_size", "n_rows", "goal", target.alias("target"))


def plan_mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    rules: MixRules = MixRules(),
) -> tuple[DataFrame, DataFrame]:
    """(stored sizes: id, source, size, order key; per source: target and the last key of each round)."""
    if rules.repeats != 2:
        raise ValueError("two rounds of each source are queued")
    spark = df.sparkSession
    narrow = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), order_key(id_col, rules.seed).alias("key"),
        F.xxhash64(text_col).alias("tie"),
    )
    sizes = store(narrow, "mix-sizes")
    targets = store(source_targets(sizes, rules), "mix-targets")
    most = targets.agg(F.max("n_rows"), F.max("goal"), F.sum("n_rows")).first()
    if not most[0]:
        return sizes, targets.withColumn("last_1", F.lit(-1)).withColumn("last_2", F.lit(-1))
    bits = max(0, (most[0] // rules.slice_rows).bit_length())
    sliced = sizes.join(targets.select("source", "rank"), sizes["source"].eqNullSafe(targets["source"])).select(
        "rank", "key", "id", "size", "tie", F.shiftright("key", KEY_BITS - bits).alias("slice")
    )
    sums = sliced.groupBy("rank", "slice").agg(F.sum("size").alias("slice_size"))
    ahead = Window.partitionBy("rank").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("rank", "slice", F.coalesce(F.sum("slice_size").over(ahead), F.lit(0)).alias("before"))
    inside = Window.partitionBy("rank", "slice").orderBy("key", "id", "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    sent = (
        sliced.withColumn("inside", F.sum("size").over(inside))
        .join(sums, ["rank", "slice"])
        .join(targets.select("rank", "weight", "source_size"), "rank")
        .withColumn("sent", F.col("before") + F.col("inside"))
    )
    queued = sent.select(
        "rank", "key", "size",
        F.explode(F.array(
            F.struct(F.lit(1).alias("round"), (F.col("sent") / F.col("weight")).alias("finish")),
            F.struct(F.lit(2).alias("round"), ((F.col("source_size") + F.col("sent")) / F.col("weight")).alias("finish")),
        )).alias("turn"),
    ).select("rank", "key", "size", "turn.round", "turn.finish")
    parts = max(shuffle_parts(spark), most[2] * 2 // 100_000)
    line = store(
        queued.repartitionByRange(parts, "finish", "rank", "key").withColumn("part", F.spark_partition_id()), "mix-queue"
    )
    finish, rank, key = budget_cut(line, most[1])
    within = (F.col("finish") < finish) | (
        (F.col("finish") == finish) & ((F.col("rank") < rank) | ((F.col("rank") == rank) & (F.col("key") <= key)))
    )
    own = targets.select("rank", "weight", "target")
    nearer = F.col("finish") * F.col("weight") - F.col("size") / 2 <= F.col("target")
    last = line.join(own, "rank").filter(within | nearer).groupBy("rank").agg(
        *(F.max(F.when(F.col("round") == n, F.col("key"))).alias(f"last_{n}") for n in (1, 2))
    )
    return sizes, targets.join(last, "rank", "left").fillna(-1, ["last_1", "last_2"])


def budget_cut(line: DataFrame, goal: float) -> tuple[float, int, int]:
    """Place (finish, rank, key) of the last queued document whose middle lies inside the budget."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = line.groupBy("part").agg(
        F.sum("size").alias("part_size"), F.max(F.struct("finish", "rank", "key")).alias("end")
    )
    parts = store(parts.withColumn("before", F.coalesce(F.sum("part_size").over(before), F.lit(0))), "mix-parts")
    cut = parts.filter(F.col("before") <= goal).orderBy(F.col("part").desc()).first()
    own = Window.partitionBy("part").orderBy("finish", "rank", "key").rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        line.filter(F.col("part") == cut["part"])
        .withColumn("middle", F.lit(cut["before"]) + F.sum("size").over(own) - F.col("size") / 2)
        .filter(F.col("middle") <= goal)
        .agg(F.max(F.struct("finish", "rank", "key")).alias("end"))
        .first()["end"]
    )
    if inside is None:
        earlier = parts.filter(F.col("part") < cut["part"]).orderBy(F.col("part").desc()).first()
        inside = earlier["end"] if earlier else (-1.0, 0, 0)
    return float(inside[0]), int(inside[1]), int(inside[2])


def copies(key: Column) -> Column:
    return (key <= F.col("last_1")).cast("int") + (key <= F.col("last_2")).cast("int")


def mix_report(df: DataFrame, id_col="doc_id", text_col="text", source_col="source", rules=MixRules()) -> DataFrame:
    """One row per document: id, source, size, source_size, target and taken (words, repeats counted)."""
    sizes, plan = plan_mix(df, id_col, text_col, source_col, rules)
    plan = plan.withColumnRenamed("source", "plan_source")
    joined = sizes.join(plan, sizes["source"].eqNullSafe(plan["plan_source"]))
    taken = (F.col("size") * copies(F.col("key"))).alias("taken")
    return joined.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", taken)


def mix_documents(df: DataFrame, id_col="doc_id", text_col="text", source_col="source", rules=MixRules()) -> DataFrame:
    """The mixed documents, all columns unchanged: a document taken twice is two rows."""
    _, plan = plan_mix(df, id_col, text_col, source_col, rules)
    # stored, so that its size is known: a small plan is broadcast, a large one joined with skew splitting
    plan = store(plan.select(F.struct(F.col("source").alias("source"), "last_1", "last_2").alias("_mix_plan")), "mix-plan")
    joined = df.join(plan, df[source_col].eqNullSafe(plan["_mix_plan"]["source"]))
    key, cut = order_key(id_col, rules.seed), F.col("_mix_plan")
    times = (key <= cut["last_1"]).cast("int") + (key <= cut["last_2"]).cast("int")
    names = [df[c] for c in df.columns]
    return joined.select(*names, F.explode(F.array_repeat(F.lit(True), times)).alias("_mix_copy")).select(
        *(F.col(f"`{c}`") for c in df.columns)
    )
