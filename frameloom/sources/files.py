"""File listings, sequences of frames, and first lines."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import natural_key, path_name, path_suffix

#: Suffixes of image files.
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".webp")


def plain_path(c: Column) -> Column:
    return F.regexp_replace(c, "^file:/+", "/")


def listing(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, size) of the files below root; their contents aren't read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(root)
    return read.select(plain_path(F.col("path")).alias("path"), F.col("length").alias("size"))


def images(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, size, name, key): image files; key orders names naturally."""
    there = listing(spark, root, recursive).where(path_suffix(F.col("path")).isin(*IMAGE_SUFFIXES))
    return there.withColumn("name", path_name(F.col("path"))).withColumn("key", natural_key(F.col("name")))


def image_index(spark: SparkSession, root: str) -> DataFrame:
    """(name, path): of each file name the first path in order."""
    return images(spark, root).groupBy("name").agg(F.min("path").alias("path"))


def dataset_folder(root: str, name: str, parent: str = "cv_datasets") -> str:
    """The folder of a dataset: below parent, else directly below root; an error if there is neither."""
    for path in (os.path.join(root, parent, name), os.path.join(root, name)):
        if os.path.isdir(path):
            return path
    raise FileNotFoundError(f"no folder {name} below {root}")


def first_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, line): the first line of each file without byte-order mark and white space; an empty one is an error."""
    whole = spark.read.text(paths, wholetext=True).select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("value"))
    line = F.trim(F.regexp_replace(F.get(F.split("value", "\r?\n"), 0), "^﻿", ""))
    return whole.select("path", F.when(line != "", line).otherwise(F.raise_error(F.concat(F.lit("empty first line: "), F.col("path")))).alias("line"))


def sequence_frames(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """(sequence, frames): of each sequence below root the paths of its frames in natural order; sequences without frames are left out.

    A sequence's frames make one array, as it is one recording.
    """
    pattern = rf"/([^/]+)/{folder}/[^/]+$" if folder else r"/([^/]+)/[^/]+$"
    there = images(spark, root).withColumn("sequence", F.regexp_extract("path", pattern, 1)).where("sequence != ''")
    return there.groupBy("sequence").agg(F.transform(F.array_sort(F.collect_list(F.struct("key", "name", "path"))), lambda x: x["path"]).alias("frames"))


def sequences(spark: SparkSession, root: str, folder: str, truth: str = "groundtruth.txt", language: str = "language.txt") -> DataFrame:
    """(sequence, frames, box_line, text): sequences that have frames, a ground-truth line and a language line."""
    frames = sequence_frames(spark, root, folder)
    of = lambda name, out: first_lines(spark, f"{root}/*/{name}").select(F.element_at(F.split("path", "/"), -2).alias("sequence"), F.col("line").alias(out))
    return frames.join(of(truth, "box_line"), "sequence").join(of(language, "text"), "sequence")


def prefer(first: DataFrame, second: DataFrame, on: str, value: str) -> DataFrame:
    """(on, value) of the first table where it has the key, else of the second."""
    return first.select(on, F.col(value).alias("__a")).join(second.select(on, F.col(value).alias("__b")), on, "full_outer").select(on, F.coalesce("__a", "__b").alias(value))


def absolute_media(path: Column, dataset: str, media_root: str | None = None) -> Column:
    """A media path for requests: absolute ones as they are, others below media_root or else beside the dataset; existence isn't tested."""
    base = media_root or os.path.dirname(dataset)
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))
