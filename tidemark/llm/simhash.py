"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 fingerprint bits are dealt into groups of correlated bits. Two fingerprints within ``distance``
bits agree, in at least one group i, on all but t_i bits whenever the thresholds t_i add up to
``distance - groups + 1``; a threshold of -1 leaves a group out. A dynamic programme picks the number
of groups and the thresholds with the least estimated work, from the corpus's bit statistics and the
pair distances of a bounded sample; the choice affects cost only, never the result.

Every distinct fingerprint is filed under its value in each group and also looks under the values
within t_i bits. What meets under a value is verified in full, and only links that join what is not yet
joined leave the task. A value with many entries is split into blocks, and pairs of blocks are
separate pieces of work, so no entry is dropped and no task grows with a hot value.

Defined results: a text without words has fingerprint zero and is linked like any other; equal texts
share a class; null ids take part but never name a class that has another id; an empty table gives
no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import LOWER, Words, bound_batches, shuffle_parts, store, text_slices, tidy
from tidemark.llm.components import components

BITS = 64
SEED = 42
VOTE_ROWS = 2048


@dataclass(frozen=True)
class SimHashRules:
    shingle: int = 3
    distance: int = 3
    sample: int = 2048  # fingerprints whose pair distances estimate candidate counts
    block: int = 8192  # entries of one value handled together
    small: int = 16  # values with at most so many entries are compared in vectors
    probe_cost: float = 1.0
    pair_cost: float = 0.01


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles of a slice, and the row of each."""
    low = LOWER[data]
    words = Words(low, offsets)
    sizes = words.ends - words.starts
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    joined = np.full(int((sizes + 1).sum()), 32, dtype=np.uint8)
    joined[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = low[words.inside]
    counts = np.where(words.counts >= width, words.counts - width + 1, np.minimum(words.counts, 1))
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    head = words.first[:-1][row] + within
    tail = head + np.minimum(words.counts[row], width) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    limits = zip(begin[head].tolist(), (begin[tail] + sizes[tail]).tolist())
    return np.fromiter((digest(text[a:b], SEED) for a, b in limits), np.uint64, len(row)), row


def fingerprints(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """The 64-bit fingerprint of each text: a bit is set if it is in over half of the shingle hashes."""
    hashes, row = shingle_hashes(data, offsets, width)
    rows = len(offsets) - 1
    limits = np.searchsorted(row, np.arange(rows + 1))
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
    out = np.zeros(rows, dtype=np.uint64)
    for first in range(0, rows, VOTE_ROWS):
        last = min(rows, first + VOTE_ROWS)
        own = hashes[limits[first] : limits[last]].view(np.uint8).reshape(-1, 8)
        place = (row[limits[first] : limits[last]] - first) << 8
        half = np.diff(limits[first : last + 1]) / 2
        for k in range(8):
            seen = np.bincount(place | own[:, k], minlength=(last - first) << 8).reshape(-1, 256)
            votes = (seen @ bits > half[:, None]).astype(np.uint8)
            byte = np.packbits(votes, axis=1, bitorder="little")[:, 0]
            out[first:last] |= byte.astype(np.uint64) << np.uint64(8 * k)
    return out


def fingerprint_documents(df: DataFrame, text_col: str = "text", width: int = 3) -> DataFrame:
    """The other columns of ``df`` with ``fingerprint`` (signed 64-bit) in place of the text."""
    bound_batches(df.sparkSession)
    others = [c for c in df.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for a, b, data, offsets in text_slices(batch.column(0)):
                found = fingerprints(data, offsets, width).view(np.int64)
                kept = [batch.column(k)[a:b] for k in range(1, batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], names=[*others, "fingerprint"])

    fields = [df.schema[c] for c in others] + [T.StructField("fingerprint", T.LongType())]
    return df.select(text_col, *others).mapInArrow(run, T.StructType(fields))


def bit_matrix(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def co_occurrence(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, over all of them, how often bits i and j are set together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((BITS, BITS)), 0
        for batch in tidy(batches):
            own = bit_matrix(batch.column(0).to_numpy().view(np.uint64)).astype(np.float32)
            total += own.T @ own
            rows += len(own)
        if rows:
            where = pa.array(np.arange(BITS * BITS + 1))
            yield pa.RecordBatch.from_arrays(
                [where, pa.array(np.append(total.ravel(), rows).astype(np.int64))], names=["place", "times"]
            )

    sums = nodes.select("fingerprint").mapInArrow(run, "place long, times long").groupBy("place").agg(F.sum("times"))
    out = np.zeros(BITS * BITS + 1)
    for place, times in sums.collect():
        out[place] = times
    return int(out[-1]), out[:-1].reshape(BITS, BITS)


def correlated_groups(count: int, together: np.ndarray, groups: int) -> list[list[int]]:
    """The bits in ``groups`` groups of near equal width, correlated bits together."""
    p = np.diag(together) / max(1, count)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(together / max(1, count) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for k in range(groups):
        width = BITS // groups + (k < BITS % groups)
        own = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(own[0])
        while len(own) < width:
            own.append(max(free, key=lambda b: (corr[b, own].sum(), -b)))
            free.remove(own[-1])
        out.append(sorted(own))
    return out


def allot(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Least cost and thresholds (-1 or more) adding up to ``total``; costs[i][t + 1] is group i at t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for k, extra in enumerate(own):
                at = done + k - 1
                if at not in step or cost + extra < step[at][0]:
                    step[at] = (cost + extra, [*chosen, k - 1])
        best = step
    return best[total]


def probing_plan(nodes: DataFrame, rules: SimHashRules) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each group that is looked up."""
    count, together = co_occurrence(nodes)
    draw = F.pmod(F.xxhash64(F.lit(7), "fingerprint"), F.lit(max(1, count))) < rules.sample
    sample = np.array([r[0] for r in nodes.filter(draw).limit(4 * rules.sample).collect()], dtype=np.int64).view(np.uint64)
    pairs = count * count / 2
    left, right = np.triu_indices(len(sample), 1)
    differ = sample[left] ^ sample[right]
    best = None
    for m in range(2, rules.distance + 2):
        groups, costs = correlated_groups(count, together, m), []
        for own in groups:
            mask = np.uint64(sum(1 << b for b in own))
            apart = np.bitwise_count(differ & mask)
            row = [0.0]
            for t in range(rules.distance + 1):
                probes = sum(comb(len(own), k) for k in range(t + 1))
                seen = float((apart <= t).mean()) if len(apart) else 0.0
                share = max(seen, probes / 2 ** len(own))
                row.append(rules.probe_cost * count * probes + rules.pair_cost * pairs * share)
            costs.append(row)
        cost, limits = allot(costs, rules.distance - m + 1)
        if best is None or cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, limits) if t >= 0])
    return best[1]


def group_value(values: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(values), dtype=np.int64)
    for k, b in enumerate(bits):
        out |= ((values >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return out


def entries(nodes: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """(value, probe, fingerprint): where a fingerprint is filed (probe 0) and where it looks (probe 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            own = batch.column(0).to_numpy().view(np.uint64)
            for k, (bits, most) in enumerate(plan):
                base = group_value(own, bits) | (k << 60)
                for t in range(most + 1):
                    for flips in combinations(range(len(bits)), t):
                        value = base ^ sum(1 << b for b in flips)
                        probe = pa.array(np.full(len(own), t > 0, dtype=np.int8))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(value), probe, batch.column(0)], names=["value", "probe", "fingerprint"]
                        )

    return nodes.select("fingerprint").mapInArrow(run, "value long, probe byte, fingerprint long")


def join_group(own: np.ndarray, filed: int, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that join one value's entries (the first ``filed`` are filed there, the rest look there)."""
    left = np.ones(len(own), dtype=bool)
    for seed in range(filed):
        if not left[seed]:
            continue
        left[seed] = False
        front = [seed]
        while front:
            node = front.pop()
            # looking entries need no comparison with each other: that pair meets elsewhere
            rest = np.flatnonzero(left if node < filed else left[:filed])
            hit = rest[np.bitwise_count(own[rest] ^ own[node]) <= distance]
            if len(hit):
                left[hit] = False
                front.extend(hit.tolist())
                yield np.full(len(hit), own[node]), own[hit]


def link_entries(rows: DataFrame, rules: SimHashRules) -> DataFrame:
    """(u, v) links among rows (value, a, b, probe, fingerprint) that are sorted inside partitions."""

    def links(key: np.ndarray, probe: np.ndarray, own: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        size = np.repeat(sizes, sizes)
        found = []
        for d in range(1, rules.small):
            i = np.flatnonzero((key[d:] == key[:-d]) & (probe[:-d] == 0) & (size[:-d] <= rules.small))
            hit = i[np.bitwise_count(own[i] ^ own[i + d]) <= rules.distance]
            found.append((own[hit], own[hit + d]))
        for at in np.flatnonzero(sizes > rules.small):
            a, b = starts[at], starts[at] + sizes[at]
            found += join_group(own[a:b], int((probe[a:b] == 0).sum()), rules.distance)
        u = np.concatenate([f[0] for f in found]).view(np.int64)
        v = np.concatenate([f[1] for f in found]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in tidy(batches):
            now = [batch.column(k).to_numpy() for k in range(5)]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            if not len(now[0]):
                continue
            same = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) & (now[2] == now[2][-1])
            cut = int(np.argmax(same))
            held = [x[cut:] for x in now]
            if cut:
                yield from links(*numbered([x[:cut] for x in now]))
        if held is not None:
            yield from links(*numbered(held))

    def numbered(x: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = (np.diff(x[0]) != 0) | (np.diff(x[1]) != 0) | (np.diff(x[2]) != 0)
        return np.append(0, np.cumsum(new)), x[3], x[4].view(np.uint64)

    return rows.select("value", "a", "b", "probe", "fingerprint").mapInArrow(run, "u long, v long")


def fingerprint_links(nodes: DataFrame, rules: SimHashRules) -> DataFrame:
    """Links (u, v) that join all fingerprints within ``distance`` bits of each other."""
    spark = nodes.sparkSession
    plan = probing_plan(nodes, rules)
    filed = entries(nodes, plan)
    hot = filed.groupBy("value").count().filter(F.col("count") > rules.block)
    hot = store(hot.select("value", F.ceil(F.col("count") / rules.block).cast("int").alias("blocks")), "simhash-hot")
    zero = F.lit(0)
    if hot.isEmpty():
        dealt = filed.select("value", zero.alias("a"), zero.alias("b"), "probe", "fingerprint")
    else:
        own = F.pmod(F.xxhash64("fingerprint"), F.coalesce("blocks", F.lit(1))).cast("int")
        spread = filed.join(hot, "value", "left").withColumn("own", own)
        spread = spread.withColumn("other", F.explode(F.sequence(zero, F.coalesce("blocks", F.lit(1)) - 1)))
        dealt = spread.select(
            "value", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "probe", "fingerprint"
        )
    parts = shuffle_parts(spark)
    return link_entries(dealt.repartition(parts, "value", "a", "b").sortWithinPartitions("value", "a", "b", "probe"), rules)


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: SimHashRules = SimHashRules(), *carry: str
) -> DataFrame:
    """Per document: id, ``carry`` columns, ``fingerprint`` (16 hex digits) and ``component_id``,
    the smallest id reachable over links."""
    marked = store(
        fingerprint_documents(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *carry), "text", rules.shingle),
        "simhash-documents",
    )
    nodes = store(marked.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash-nodes")
    roots = components(fingerprint_links(nodes, rules))
    classes = nodes.join(roots, nodes["fingerprint"] == roots["u"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("class")
    )
    smallest = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    named = store(classes.join(smallest, "class").select("fingerprint", "class", "component_id"), "simhash-classes")
    text = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return marked.join(named, "fingerprint").select(
        F.col("id").alias(id_col), *carry, text.alias("fingerprint"), "component_id", "class"
    )


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: SimHashRules = SimHashRules()) -> DataFrame:
    """The rows without near copies: of each class the row with the smallest id, all columns unchanged."""
    digest = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")), F.col(text_col).isNull())
    named = df.select(F.col(id_col).alias("_sim_id"), F.col(text_col).alias("_sim_text"), digest.alias("_sim_digest"))
    found = near_duplicates(named, "_sim_id", "_sim_text", rules, "_sim_digest")
    pick = F.min(F.struct(F.col("_sim_id").isNull().alias("none"), "_sim_id", "_sim_digest"))
    best = found.groupBy("class").agg(pick.alias("best"))
    keys = store(best.select("best._sim_id", "best._sim_digest"), "simhash-kept")
    kept = df.join(
        keys.hint("shuffle_hash"), df[id_col].eqNullSafe(keys["_sim_id"]) & (digest == keys["_sim_digest"]), "left_semi"
    )
    again = found.groupBy("_sim_id", "_sim_digest").count().filter("count > 1")
    again = store(again, "simhash-repeats")
    if again.isEmpty():
        return kept
    # equal rows under one id: only these are gathered by id and text
    twice = again.hint("shuffle_hash")
    match = df[id_col].eqNullSafe(again["_sim_id"]) & (digest == again["_sim_digest"])
    return kept.join(twice, match, "left_anti").unionByName(
        kept.join(twice, match, "left_semi").dropDuplicates([id_col, text_col])
    )
