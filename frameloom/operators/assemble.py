"""Chat-format rows, metadata, union and global order."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import strip
from .sampling import FINAL_OFFSET, SEED, hash_rank, shuffle_key

#: Prompts by source: (system, user). Configuration; a build may pass its own.
SYSTEM = "You describe visual targets. Use plain words and only what can be seen."
PROMPTS: dict[str, tuple[str, str]] = {
    "d3": (SYSTEM, "<image>Name the described target of this picture in one phrase."),
    "sorec": (SYSTEM, "<image><image>The second picture is cut from the first. Describe that target in one phrase."),
    "tnl2k": (SYSTEM, "<image><image>The second picture is the target of the first. Describe it in one sentence."),
    "lasot": (SYSTEM, "<image><video>The picture is the target at the start. Describe it so that it can be followed."),
    "refer_kitti": (SYSTEM, "<video>Describe the road users that belong together in this clip in one expression."),
    "lamot": (SYSTEM, "<video>Describe what is followed in this clip in one line."),
    "mevis": (SYSTEM, "<video>Single out the targets of this clip by their motion in one expression."),
}
#: Metadata keys by source.
METADATA = {
    "d3": ("image_id", "category_id"),
    "sorec": ("sequence", "source_index", "bbox_xywh"),
    "tnl2k": ("sequence", "source_index", "bbox_xywh"),
    "lasot": ("sequence", "temporal_scale", "scale_variant", "sampled_frames"),
    "refer_kitti": ("sequence", "expression_file", "raw_sentence", "sampled_frames"),
    "lamot": ("sequence", "annotation_file", "sampled_frames"),
    "mevis": ("video_id", "expression_id", "sampled_frames"),
}
#: Share of validation groups by source; other sources take DEFAULT_RATIO, lamot keeps the split of its files.
DEFAULT_RATIO = 0.1
RATIOS = {"d3": 0.05}


def make_row(dataset: Column, response: Column, images: Column | None = None, video: Column | None = None, prompts: Mapping[str, tuple[str, str]] = PROMPTS) -> Column:
    """struct(messages, images, videos): three messages, media that are null where there are none; a video is one array of frames inside an array.

    to_json leaves null fields out, so a key without media is absent.
    """
    table = lambda i: F.create_map(*[F.lit(x) for k, v in prompts.items() for x in (k, v[i])])
    said = [("system", F.element_at(table(0), dataset)), ("user", F.element_at(table(1), dataset)), ("assistant", strip(response))]
    none = F.lit(None).cast("array<string>")
    pictures, frames = (none if images is None else images), (none if video is None else video)
    return F.struct(
        F.array(*[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in said]).alias("messages"),
        F.when(F.size(pictures) > 0, pictures).alias("images"),
        F.when(F.size(frames) > 0, F.array(frames)).alias("videos"),
    )


def metadata_json(df: DataFrame, dataset: str, key: str = "sample_id") -> Column:
    """The source's metadata with the sample's identifier, as JSON text; null keys stay, as null."""
    there = [c for c in METADATA[dataset] if c in df.columns]
    return F.to_json(F.struct(F.col(key).alias("sample_id"), *[F.col(c) for c in there]), {"ignoreNullFields": "false"})


def union_samples(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def global_order(df: DataFrame, key: list[str], seed: int = SEED) -> DataFrame:
    """df with ordinal, from 0 by seeded hash over all sources, without ordering all rows in one task.

    See hash_rank.
    """
    ranked = hash_rank(df, shuffle_key(seed + FINAL_OFFSET, *[F.col(k) for k in key]), key, None, "ordinal")
    return ranked.withColumn("ordinal", F.col("ordinal") - 1)


def by_dataset(df: DataFrame, dataset: str = "dataset") -> DataFrame:
    """(dataset, samples), with a null dataset for the total."""
    return df.rollup(dataset).agg(F.count(F.lit(1)).alias("samples"))
