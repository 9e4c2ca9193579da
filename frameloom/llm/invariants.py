"""What has to hold for results that aren't fixed by the data, as tables that SQL can tell beforehand."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from . import mixing, pii, sampling, splits

#: How far a share may lie from its target where whole components or blocks have to be taken.
NEAR = 0.01


def splits_hold(spark: SparkSession, built: DataFrame, targets: DataFrame) -> DataFrame:
    """(samples, assigned, parted_groups, near_targets) in one row: every sample has one new split, no group is parted, shares are met."""
    rows = stage(splits.assigned(spark, built, targets))
    parted = rows.groupBy("root").agg(F.min("new_split").alias("a"), F.max("new_split").alias("b")).where("a != b").count()
    goals = {r["split"]: r["target_share"] for r in targets.collect()}
    there, total = {r["new_split"]: r["count"] for r in rows.groupBy("new_split").count().collect()}, max(1, rows.count())
    near = all(abs(there.get(s, 0) / total - share) <= NEAR for s, share in goals.items())
    n = rows.agg(F.count_distinct("sample_key").alias("k"), F.count("new_split").alias("n")).first()
    return spark.createDataFrame([(n["k"], n["n"], parted, near)], "samples long, assigned long, parted_groups long, near_targets boolean")


def sample_holds(spark: SparkSession, rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(dataset, available, floor, reachable, drawn_once, floor_kept, goal_kept): of each target what there is, and whether the sample keeps to it.

    goal_kept: a target within reach is met, or missed by less than a row, unless the floors of other targets leave too few rows for all.
    """
    drawn = stage(sampling.sample(spark, rows, targets))
    got = drawn.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("sample_key").alias("k"))
    n, k = F.coalesce("n", F.lit(0)), F.coalesce("k", F.lit(0))
    wanted = sampling.report(spark, rows, targets)
    need = wanted.agg(F.sum(F.greatest("floor", F.least("target_rows", "available")))).first()[0] or 0
    met = wanted.join(got, "dataset", "left")
    goal = F.lit(need > drawn.count()) | F.when(F.col("reachable"), n > F.col("target_rows") - 1).otherwise(n == F.col("available"))
    return met.select("dataset", "available", "floor", "reachable", (n == k).alias("drawn_once"), (n >= F.col("floor")).alias("floor_kept"), goal.alias("goal_kept"))


def mix_holds(spark: SparkSession, documents: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, max_repeats, within_cap, whole_blocks, share_kept): of each target whether its blocks keep to its cap and its share.

    whole_blocks: each block holds as many token ids as it says. share_kept: a source takes its share, or all that its cap allows.
    """
    mixed = stage(mixing.mixture(spark, documents, targets).select("source", "block", "tokens", F.octet_length("ids").alias("bytes"), F.size("spans").alias("parts")))
    used = mixed.groupBy("source", "block").agg(F.count(F.lit(1)).alias("times"), F.min((F.col("bytes") == F.col("tokens") * 2) & (F.col("parts") > 0)).alias("good"))
    per = used.groupBy("source").agg(F.max("times").alias("most"), F.min("times").alias("least"), F.min("good").alias("good"))
    reached = mixing.report(spark, documents, targets).select("source", "target_share", "reached_share", "max_repeats")
    met = reached.join(per, "source", "left")
    most = F.coalesce("most", F.lit(0))
    near = NEAR + 2 / max(1, mixed.count())  # a block more or less, and a shorter last one
    kept = (F.col("reached_share") >= F.col("target_share") - near) | (F.coalesce("least", F.lit(0)) >= F.col("max_repeats")) | (most == 0)
    return met.select("source", "max_repeats", (most <= F.col("max_repeats")).alias("within_cap"), F.coalesce("good", F.lit(True)).alias("whole_blocks"), kept.alias("share_kept"))


_PLACE = re.compile("|".join(re.escape(f"[{t.upper()}]") for t in pii.TYPES))


def _outside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        kept = []
        for before, after in zip(pdf["text"], pdf["clean"], strict=True):
            if before is None or after is None:
                kept.append(before is after)
                continue
            pieces, at = _PLACE.split(after), 0
            good = before.startswith(pieces[0]) and before.endswith(pieces[-1])
            for piece in pieces:
                at = before.find(piece, at) + len(piece) if good and before.find(piece, at) >= 0 else -1
                if at < 0:
                    good = False
                    break
            kept.append(good)
        yield pdf[["doc_id"]].assign(kept=kept)


def text_holds(documents: DataFrame, annotators: DataFrame | None) -> DataFrame:
    """(doc_id, kept): of each document whether all text outside its placeholders stands in the original, in order and from end to end."""
    clean = pii.sanitised(documents, annotators).withColumnRenamed("text", "clean")
    return documents.select("doc_id", "text").join(clean, "doc_id").mapInPandas(_outside, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, kept boolean")

