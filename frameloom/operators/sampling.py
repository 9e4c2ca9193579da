"""Seeded, quota-aware and diversity-preserving sampling.

Ranks come from hashes, so a sample doesn't depend on partitioning; the shuffles of Python's generator can be had exactly for inputs small
enough to be numbered on the driver. Top-k by group filters on partial tops first (see top_by_group), so a group that holds a third of all rows
is never ordered in one task.
"""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import even_positions, prefix_endpoint, prefix_sample, sha1_seed
from ..session import BROADCAST_ROWS

#: Partial tops of a group are made in so many parts.
PARTS = 32
#: Rows of each source in a full build, in build order.
QUOTAS = {"d3": 9000, "sorec": 6000, "refer_kitti": 2400, "lamot": 300, "lasot": 100, "tnl2k": 100, "mevis": 1900}
#: Offsets of the base seed by source, and of the final shuffle.
SEED = 42
SEED_OFFSETS = {"d3": 11, "sorec": 23, "tnl2k": 29, "lasot": 31, "refer_kitti": 37, "lamot": 41, "mevis": 43}
FINAL_OFFSET = 101
#: Prefix ranges (start, end) and anchors by temporal scale.
SCALE_RANGES = {"wide": (0.10, 0.25), "long": (0.35, 0.65), "full": (0.75, 1.00)}
SCALE_ANCHORS = {"wide": 0.15, "long": 0.50, "full": 1.00}
#: Window lengths that variants rotate through, and frames of a sample.
SPANS, FRAMES = (24, 48, 96, 192), 6


def shuffle_key(seed: int, *keys: Column) -> Column:
    """What rows are ordered by in a seeded shuffle."""
    return F.sha1(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def top_by_group(df: DataFrame, group: list[str], order: list[Column], k: Column | int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group by order, with their rank from 1. Ties have to be excluded by order.

    Each group is cut into PARTS by hash and only the first k of each part go on, so the last step sees at most k * PARTS rows of a group.
    """
    part = F.pmod(F.xxhash64(*[F.col(c) for c, t in df.dtypes if not t.startswith(("map", "variant"))]), F.lit(PARTS))
    first = df.withColumn("__part", part).withColumn("__r", F.row_number().over(Window.partitionBy(*group, "__part").orderBy(*order))).where(F.col("__r") <= k)
    return first.drop("__part", "__r").withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= k)


def hash_rank(df: DataFrame, hashed: Column, ties: list[str], group: list[str] | None = None, rank: str = "rank") -> DataFrame:
    """df with the rank of each row (of its group) by a hexadecimal hash, from 1, without ordering a whole group in one task.

    Rows are counted by the hash's first three digits; each such range is ordered by itself and starts where those before it end.
    """
    group = group or []
    marked = df.withColumn("__h", hashed).withColumn("__b", F.substring("__h", 1, 3))
    sums = marked.groupBy(*group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    # a window over at most 4,096 rows a group
    base = sums.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__b").alias("__c"), F.coalesce(F.sum("__n").over(Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    on = F.col("__b") == F.col("__c")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inner = F.row_number().over(Window.partitionBy(*group, "__b").orderBy("__h", *ties))
    return marked.join(base, on).withColumn(rank, F.col("__base") + inner).drop("__h", "__b", "__c", "__base", *[f"__g{i}" for i in range(len(group))])


def seeded_topk(df: DataFrame, key: str, k: int, seed: int = SEED, by: str | None = None) -> DataFrame:
    """k rows (of each group of by) in seeded random order, with rank. Rows with equal keys tie, so keys should be unique."""
    order = [shuffle_key(seed, F.col(key)), F.col(key)]
    if by:
        return top_by_group(df, [by], order, k)
    top = df.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))  # at most k rows


def quota_sample(df: DataFrame, group: str, key: str, quotas: dict[str, int], seed: int = SEED) -> DataFrame:
    """As many rows of each group as its quota says, in one pass for all groups; groups without quota give none."""
    table = F.create_map(*[F.lit(x) for kv in quotas.items() for x in kv])
    there = df.where(F.col(group).isin(list(quotas)))
    return top_by_group(there, [group], [shuffle_key(seed, F.col(key)), F.col(key)], F.element_at(table, F.col(group)))


def limit_then_keep(df: DataFrame, key: str, k: int, exists: DataFrame, on: str, seed: int = SEED) -> DataFrame:
    """k random rows, of which those with a partner stay: missing ones aren't made up for."""
    return seeded_topk(df, key, k, seed).join(exists.select(on).distinct(), on, "left_semi")


def keep_after_rank(df: DataFrame, key: str, k: int, exists: DataFrame, on: str, seed: int = SEED) -> DataFrame:
    """The first k rows with a partner, by a random order of all rows: later rows make up for missing ones."""
    return seeded_topk(df.join(exists.select(on).distinct(), on, "left_semi"), key, k, seed)


def unique_first(df: DataFrame, image: str, key: str, k: int | None, seed: int = SEED) -> DataFrame:
    """k rows in seeded order, the first of each image before any repeat; with no k, or one not below the number of rows, simply shuffled."""
    order = [shuffle_key(seed, F.col(key)), F.col(key)]
    if k is None or df.limit(k + 1).count() <= k:
        return hash_rank(df, order[0], [key])
    # the first of an image by an aggregate with partial minima, so that a common image costs no large window
    firsts = df.groupBy(image).agg(F.min(F.struct(order[0].alias("h"), F.col(key).alias("k"))).alias("f")).select(F.col("f.k").alias(key), F.lit(False).alias("again"))
    marked = df.join(firsts, key, "left").withColumn("again", F.coalesce("again", F.lit(True)))
    top = marked.orderBy("again", *order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy("again", *order))).drop("again")


def round_robin(df: DataFrame, group: str, key: str, k: int, seed: int = SEED, keep: Column | None = None) -> DataFrame:
    """k rows by turns: the first of each group (in seeded order of groups and members), then the second of each, and so on.

    keep filters after ranking and before the limit, so later rows make up for those it drops.
    """
    member = shuffle_key(seed, F.col(group), F.col(key))
    deep = top_by_group(df, [group], [member, F.col(key)], k, "depth") if keep is None else hash_rank(df, member, [key], [group], "depth")
    turn = [F.col("depth"), shuffle_key(seed, F.col(group)), F.col(group)]
    top = (deep if keep is None else deep.where(keep)).orderBy(*turn).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*turn)))


def variants_per(limit: int, units: int) -> int:
    """Variants that each unit has to give for limit rows; 1 at least. No units is an error."""
    if units < 1:
        raise ValueError("there is nothing to make variants of")
    return max(1, -(-limit // units))


def prefix_groups(df: DataFrame, sequence: str, frames: str, scales: tuple[str, ...] = ("long",), variants: int = 1, count: int = 5) -> DataFrame:
    """For each sequence, scale and variant the frames spread evenly over a prefix; equal groups of a sequence keep the first.

    df has one row a sequence with its ordered frames. Sequences without frames are left out. Columns added: scale, variant, endpoint, group.
    """
    table = []
    for position, scale in enumerate(scales):
        a, b = SCALE_RANGES[scale]
        ratios = [SCALE_ANCHORS[scale]] if variants == 1 else [a + (b - a) * i / (variants - 1) for i in range(variants)]
        table += [F.struct(F.lit(position).alias("position"), F.lit(scale).alias("scale"), F.lit(i).alias("variant"), F.lit(r).alias("ratio")) for i, r in enumerate(ratios)]
    each = df.where(F.size(frames) > 0).withColumn("s", F.explode(F.array(*table))).select(*df.columns, "s.*")
    made = each.withColumn("endpoint", prefix_endpoint(F.size(frames), F.col("ratio"))).withColumn("group", prefix_sample(F.col(frames), F.col("ratio"), count))
    first = F.row_number().over(Window.partitionBy(sequence, F.xxhash64("group")).orderBy("position", "variant"))
    return made.withColumn("r", first).where("r = 1").drop("r", "ratio", "position")


def window_variants(df: DataFrame, key: str, ids: str, count: int, seed: int = SEED) -> DataFrame:
    """Up to count variants of each row's ordered ids: all if they are few; else the even sample of all, then even samples of windows.

    Windows have the lengths SPANS in turn and starts from a hash of key and attempt; equal variants count once; ten attempts a variant at
    most. Columns added: variant (from 0), chosen.
    """
    n = F.size(ids)
    at = lambda i: F.get(F.array(*[F.lit(x) for x in SPANS]), F.pmod(i, F.lit(len(SPANS))).cast("int"))

    def window(i: Column) -> Column:
        span = F.least(at(i), n)
        start = F.pmod(sha1_seed(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), i.cast("string"))), (n - span + 1).cast("long")).cast("int")
        return F.transform(even_positions(span, FRAMES), lambda p: F.get(F.col(ids), start + p))

    tries = F.transform(F.sequence(F.lit(0), F.lit(count * 10 - 1)), window)
    whole = F.transform(even_positions(n, FRAMES), lambda p: F.get(F.col(ids), p))
    made = F.when(n <= FRAMES, F.array(F.col(ids))).otherwise(F.slice(F.array_distinct(F.concat(F.array(whole), tries)), 1, count))
    return df.select("*", F.posexplode_outer(made).alias("variant", "chosen"))


def exact_permutation(df: DataFrame, ordinal: str, n: int, seed: int) -> DataFrame:
    """The order that Python's random.Random(seed).shuffle gives to n rows numbered from 0: column shuffled, from 0.

    The permutation is made on the driver, so n may be BROADCAST_ROWS at most; larger inputs use shuffle_key.
    """
    if n > BROADCAST_ROWS:
        raise ValueError(f"an exact permutation is for {BROADCAST_ROWS} rows at most")
    order = list(range(n))
    random.Random(seed).shuffle(order)
    table = df.sparkSession.createDataFrame(pd.DataFrame({ordinal: order, "shuffled": range(n)}), f"{ordinal} long, shuffled long")
    return df.join(F.broadcast(table), ordinal)


def even_rows(df: DataFrame, group: str, order: str, count: int = FRAMES) -> DataFrame:
    """(group, chosen): count items of each group's order column, spread evenly. A group's items have to fit one array, as a sequence does."""
    arrays = df.where(F.col(order).isNotNull()).groupBy(group).agg(F.array_sort(F.collect_list(order)).alias("items"))
    return arrays.select(group, F.transform(even_positions(F.size("items"), count), lambda p: F.get("items", p)).alias("chosen"))
