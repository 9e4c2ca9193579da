"""Queries that run builders, readers and writers of files over trees of annotations made from the driver's tables.

The trees lie in the shared folder, each in a folder of its own that goes when the session ends.
"""

from __future__ import annotations

import json as js
import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import bundle
from ..session import read_table, scratch, ship
from ..sources import json, sinks
from . import pipelines

Query = Callable[[SparkSession, str], DataFrame]


def _root(spark: SparkSession) -> str:
    """A new folder, as a path of this machine's file system, which all executors share."""
    path = re.sub("^file:/+", "/", scratch(spark, f"tree-{uuid.uuid4().hex}"))
    os.makedirs(path)
    return path


def _document(path: str, parts: dict[str, Iterable]) -> None:
    """One JSON object of lists, written row by row."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        for i, (name, rows) in enumerate(parts.items()):
            f.write(("," if i else "{") + js.dumps(name) + ":[")
            for k, row in enumerate(rows):
                f.write(("," if k else "") + js.dumps(row))
            f.write("]")
        f.write("}")


def _files(df: DataFrame, root: str) -> int:
    """Writes files (path below root, text) where the rows are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                place = os.path.join(root, path)
                os.makedirs(os.path.dirname(place), exist_ok=True)
                with open(place, "w", encoding="utf-8") as f:
                    f.write(text)
            yield pdf[["path"]]

    ship(df.sparkSession)
    return df.select("path", "text").mapInPandas(run, "path string").count()


def _said(samples: DataFrame) -> list:
    return [F.col("sample_id"), F.col("split"), F.element_at("row.messages", -1)["content"].alias("answer")]


def built_d3(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as images, nations as categories, orders as annotations; the images of a segment's customers are missing."""
    root = _root(spark)
    customers = read_table(spark, sf, "customer")
    image = F.concat(F.lit("c"), "c_custkey", F.lit(".jpg"))
    _document(
        f"{root}/d3/annotations.json",
        {
            "images": ({"id": r[0], "file_name": r[1]} for r in customers.select("c_custkey", image).toLocalIterator()),
            "categories": ({"id": r[0], "name": r[1]} for r in read_table(spark, sf, "nation").select("n_nationkey", "n_name").toLocalIterator()),
            "annotations": ({"image_id": r[0], "category_id": r[1]} for r in read_table(spark, sf, "orders").select("o_custkey", F.length("o_orderpriority")).toLocalIterator()),
        },
    )
    _files(customers.where("c_mktsegment != 'MACHINERY'").select(F.concat(F.lit("d3/images/"), image).alias("path"), F.lit("x").alias("text")), root)
    samples = pipelines.build_d3(pipelines.Build(spark, root))
    return samples.select(*_said(samples), X.path_name(F.get("row.images", 0)).alias("image"))


def built_sorec(spark: SparkSession, sf: str) -> DataFrame:
    """The template records of sorec, one of each sample_id, as the manifest that its builder reads."""
    root = _root(spark)
    records = read_table(spark, sf, "template_records").where("source = 'sorec' and sample_id is not null and source_image is not null and template_image is not null and source_text is not null")
    one = records.groupBy("sample_id").agg(F.min_by(F.struct("source", F.col("sequence_name").alias("sequence"), "source_index", "source_image", "template_image", "bbox_xywh", "source_text"), "record_id").alias("r")).select("sample_id", "r.*")
    sinks.write_json_files(one.select(F.lit("sorec").alias("name"), F.col("sample_id").alias("line"), F.to_json(F.struct(*one.columns)).alias("value")), f"{root}/templates")
    samples = pipelines.build_from_templates("sorec")(pipelines.Build(spark, root))
    return samples.select(*_said(samples), F.array_join(F.transform("row.images", lambda p: X.relative_path(p, root)), ",").alias("images"))


def built_mevis(spark: SparkSession, sf: str) -> DataFrame:
    """Users as videos, their events as frames, and kinds of events as expressions."""
    root = _root(spark)
    by = read_table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_list("event_id")).alias("frames"), F.array_sort(F.collect_set("event_type")).alias("kinds"))  # of one recording
    path = f"{root}/mevis/meta_expressions.json"
    os.makedirs(os.path.dirname(path))
    with open(path, "w", encoding="utf-8") as f:
        f.write('{"videos":{')
        for i, r in enumerate(by.toLocalIterator()):
            video = {"expressions": {k: {"exp": f"who did {k}"} for k in r["kinds"]}, "frames": [f"{e:05d}" for e in r["frames"]]}
            f.write(("," if i else "") + f'"u{r["user_id"]}":{js.dumps(video)}')
        f.write("}}")
    samples = pipelines.build_mevis(pipelines.Build(spark, root, "out"))
    return samples.select(*_said(samples), F.array_join(F.get("row.videos", 0), ",").alias("frames"))


def built_refer_kitti(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as files of expressions by nation; frames of every sixth have no target."""
    root = _root(spark)
    s = read_table(spark, sf, "supplier").withColumn("k", F.col("s_suppkey") % 6)
    label = F.map_from_arrays(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: i.cast("string")), F.transform(F.sequence(F.lit(1), F.lit(9)), lambda i: F.when((F.col("k") > 0) & (i % F.col("k") == 0), F.array("s_suppkey")).otherwise(F.array().cast("array<bigint>"))))
    row = F.to_json(F.struct(F.concat(F.lit("The Car "), F.col("s_suppkey") % 40).alias("sentence"), label.alias("label")))
    path = F.concat(F.lit("refer_kitti/expression/n"), "s_nationkey", F.lit("/e"), "s_suppkey", F.lit(".json"))
    _files(s.select(path.alias("path"), row.alias("text")), root)
    samples = pipelines.build_refer_kitti(pipelines.Build(spark, root, "out", quotas={"refer_kitti": 60}))
    return samples.select(*_said(samples), F.array_join(F.get("row.videos", 0), ",").alias("frames"))


def _tracks(spark: SparkSession, sf: str, root: str, name: str) -> DataFrame:
    """Suppliers as sequences of 5 to 11 frames, each with a box and a line of text; (s_suppkey, sequence)."""
    s = read_table(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("s"), F.format_string("%05d", "s_suppkey")).alias("sequence"), "s_name")
    each = F.transform(F.sequence(F.lit(1).cast("long"), F.col("s_suppkey") % 7 + 5), lambda i: F.struct(F.concat(F.lit("img/"), F.format_string("%03d", i), F.lit(".jpg")).alias("file"), F.lit("x").alias("text")))
    k = F.col("s_suppkey")
    box = F.concat_ws(",", *[x.cast("string") for x in (k % 50, k % 30 + 1, k % 20 + 4, k % 9 + 5)])
    more = F.array(F.struct(F.lit("groundtruth.txt").alias("file"), F.concat(box, F.lit("\n1,1,1,1")).alias("text")), F.struct(F.lit("language.txt").alias("file"), F.concat(F.lit(" The "), "s_name", F.lit(" \nmore")).alias("text")))
    rows = s.select("sequence", F.explode(F.concat(each, more)).alias("f"))
    _files(rows.select(F.concat_ws("/", F.lit(name), "sequence", "f.file").alias("path"), "f.text"), root)
    return s


def built_lasot(spark: SparkSession, sf: str) -> DataFrame:
    """Prefixes of sequences on three scales, with the cut-outs of a manifest."""
    root = _root(spark)
    s = _tracks(spark, sf, root, "lasot")
    record = F.to_json(F.struct("sequence", F.concat(F.lit("cut/"), "sequence", F.lit(".jpg")).alias("template_image"), F.concat(F.lit("the "), "s_name").alias("source_text")))
    sinks.write_json_files(s.select(F.lit("lasot").alias("name"), F.col("s_suppkey").alias("line"), record.alias("value")), f"{root}/templates")
    samples = pipelines.build_lasot(pipelines.Build(spark, root, quotas={"lasot": 7}, scales=("wide", "long", "full")))
    return samples.select(*_said(samples), F.array_join(F.transform(F.get("row.videos", 0), X.path_name), ",").alias("frames"), F.array_join("row.images", ",").alias("images"))


def built_lamot(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as annotation files of 3 to 11 frames over nations' sequences, of which ten frames are there."""
    root = _root(spark)
    s = read_table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    targets = F.map_from_entries(F.transform(F.sequence(F.lit(1).cast("long"), k % 9 + 3), lambda i: F.struct(i.cast("string").alias("key"), F.array(F.lit(1)).alias("value"))))
    row = F.to_json(F.struct(F.concat(F.lit("follow "), "s_name").alias("language"), targets.alias("targets")))
    path = F.concat(F.when(k % 3 == 0, "lamot/val").otherwise("lamot/train"), F.lit("/MOT17/n"), "s_nationkey", F.lit("_"), k, F.lit(".json"))
    _files(s.select(path.alias("path"), row.alias("text")), root)
    frames = read_table(spark, sf, "nation").select(F.concat(F.lit("lamot/frames/train/n"), "n_nationkey", F.lit("/img1/")).alias("home"), F.explode(F.sequence(F.lit(1), F.lit(10))).alias("i"))
    _files(frames.select(F.concat("home", X.numbered_frame(F.col("i"), ".jpg")).alias("path"), F.lit("x").alias("text")), root)
    samples = pipelines.build_lamot(pipelines.Build(spark, root, quotas={"lamot": 8}))
    return samples.select(*_said(samples), F.array_join(F.transform(F.get("row.videos", 0), lambda p: F.substring_index(p, "/", -3)), ",").alias("frames"))


def _templates(records: DataFrame) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return records.select("sample_id", "sequence", "source_index", "source_image", "template_image", text(F.col("crop_xyxy")).alias("crop"), "source_text")


def templates_tracking(spark: SparkSession, sf: str) -> DataFrame:
    """Template records of sequences, from their first frame, box and line of text."""
    root = _root(spark)
    s = _tracks(spark, sf, root, "tnl2k")
    sizes = s.select(F.concat(F.lit(f"{root}/tnl2k/"), "sequence", F.lit("/img/001.jpg")).alias("path"), F.lit(64).alias("width"), (F.col("s_suppkey") % 20 + 40).cast("int").alias("height"))
    return _templates(pipelines.tracking_templates(spark, root, "tnl2k", "img", sizes=sizes))


def templates_small(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as small objects on 200 images: first one of each image, then repeats, up to 300."""
    root = _root(spark)
    parts = read_table(spark, sf, "part").select("p_partkey", F.concat(F.lit("p"), F.col("p_partkey") % 200, F.lit(".png")).alias("image"), "p_size", "p_name").orderBy("p_partkey")
    os.makedirs(f"{root}/sorec")
    with open(f"{root}/sorec/train.json", "w", encoding="utf-8") as f:
        for i, r in enumerate(parts.toLocalIterator()):
            f.write(("," if i else "[") + js.dumps({"image": r["image"], "bbox": [float(r["p_partkey"] % 80), float(r["p_size"]), r["p_size"] / 2 + 1, 6.0], "ref": f" {r['p_name']} "}))
        f.write("]")
    names = parts.select("image").distinct()
    _files(names.select(F.concat(F.lit("sorec/Images/deep/"), "image").alias("path"), F.lit("x").alias("text")), root)
    sizes = names.select(F.concat(F.lit(f"{root}/sorec/Images/deep/"), "image").alias("path"), F.lit(120).alias("width"), F.lit(90).alias("height"))
    return _templates(pipelines.small_object_templates(spark, root, f"{root}/sorec/train.json", f"{root}/sorec/Images", sizes, 300))


def packed_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of built_samples with their media moved into a bundle, as lines of JSON that keep all else."""
    raw = read_table(spark, sf, "built_samples").select("sample_key", F.col("row_json").alias("value")).where("value is not null")
    good = raw.where(F.from_json("value", "messages string, _bad string", {"columnNameOfCorruptRecord": "_bad"})["_bad"].isNull())
    paths = bundle.line_references(good, "sample_key", "value").distinct()
    moves = paths.groupBy("sample_key").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("path", X.bundle_path(F.col("path")))))).alias("moves"))  # of one row
    moved = bundle.lines_moved(good.join(moves, "sample_key", "left"), "value", "moves")
    r = F.from_json("value", "messages array<struct<role:string,content:string>>, images array<string>, videos array<array<string>>")
    return moved.select("sample_key", r.alias("r")).select("sample_key", F.array_join("r.images", ",").alias("images"), F.array_join(F.flatten("r.videos"), ",").alias("videos"), F.array_join(F.transform("r.messages", lambda m: F.concat_ws(":", m["role"], F.length(m["content"]).cast("string"))), ",").alias("said"))


def checked_lines(spark: SparkSession, sf: str) -> DataFrame:
    """built_samples as a file of JSON lines in the order of sample_key, blank where a row is null, read again with line numbers and errors."""
    root = _root(spark)
    rows = read_table(spark, sf, "built_samples").select(F.lit("all").alias("name"), F.col("sample_key").alias("line"), F.regexp_replace(F.coalesce("row_json", F.lit("")), r"[\r\n]+", " ").alias("value"))
    sinks.write_json_files(rows, f"{root}/rows")
    read = json.numbered_lines(spark, f"{root}/rows", "messages string", ordinal=True)
    return read.select(F.col("line").cast("long").alias("line"), "ordinal", F.col("error").isNull().alias("good"))


NAMES = "built_d3 built_sorec built_mevis built_refer_kitti built_lasot built_lamot templates_tracking templates_small packed_fields checked_lines".split()


def queries() -> dict[str, Query]:
    return {name: globals()[name] for name in NAMES}
