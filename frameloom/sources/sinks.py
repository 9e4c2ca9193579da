"""Writers."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html_escape
from ..session import ship


def write_lines(df: DataFrame, path: str, order: str | None = None, mode: str = "overwrite") -> None:
    """JSON lines in a folder of part files, all or nothing; null fields are left out. With order, parts follow one another in it."""
    made = df.repartitionByRange(order).sortWithinPartitions(order) if order else df
    made.select(F.to_json(F.struct(*[c for c in df.columns if c != order])).alias("value")).write.mode(mode).text(path)


def write_file(df: DataFrame, path: str, order: str | None = None, keep_order: bool = False) -> int:
    """One named JSON-lines file, in order, renamed when it is complete; the number of rows. See write_json_files.

    The column of the order is left out unless keep_order.
    """
    folder, name = os.path.split(os.path.abspath(path))
    stem = name.removesuffix(".jsonl")
    if stem == name:
        raise ValueError("the file's name ends with .jsonl")
    value = F.to_json(F.struct(*[c for c in df.columns if keep_order or c != order])).alias("value")
    made = write_json_files(df.select(F.lit(stem).alias("name"), (F.col(order) if order else F.lit(0)).alias("line"), value), folder)
    if not made:
        os.makedirs(folder, exist_ok=True)
        open(path, "w").close()
    return made.get(stem, 0)


def write_json_files(df: DataFrame, root: str, name: str = "name", order: str = "line", value: str = "value") -> dict[str, int]:
    """Rows by file: for each name a file root/name.jsonl of its values in order, below a folder that all executors share.

    A file is written by one task, which streams its rows and renames it when it is complete; rows never pass the driver.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, rows, half, done = None, None, 0, "", []

        def close() -> None:
            if held is not None:
                held.close()
                os.replace(half, os.path.join(root, f"{now}.jsonl"))
                done.append((now, rows))

        for pdf in batches:
            for file, text in zip(pdf[name], pdf[value], strict=True):
                if file != now:
                    close()
                    now, rows = file, 0
                    half = os.path.join(root, f"{file}.jsonl.{uuid.uuid4().hex}.part")
                    os.makedirs(os.path.dirname(half), exist_ok=True)
                    held = open(half, "w", encoding="utf-8", newline="\n")
                held.write(text + "\n")
                rows += 1
        close()
        yield pd.DataFrame(done, columns=["name", "n"])

    ship(df.sparkSession)
    ordered = df.select(F.col(name).cast("string").alias(name), order, value).repartition(name).sortWithinPartitions(name, order)
    return {r["name"]: r["n"] for r in sorted(ordered.mapInPandas(run, "name string, n long").toLocalIterator())}


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_samples(samples: DataFrame, path: str, mode: str = "full") -> None:
    """Samples (dataset, split, ordinal, row, metadata) by split and dataset, rows and metadata side by side in the same order.

    full: folders split=/dataset= below rows and meta; demo: every split is named demo.
    """
    there = samples if mode == "full" else samples.withColumn("split", F.lit("demo"))
    ordered = there.repartition("split", "dataset").sortWithinPartitions("split", "dataset", "ordinal")
    ordered.select("split", "dataset", F.to_json("row").alias("value")).write.mode("overwrite").partitionBy("split", "dataset").text(f"{path}/rows")
    ordered.select("split", "dataset", F.col("metadata").alias("value")).write.mode("overwrite").partitionBy("split", "dataset").text(f"{path}/meta")


def write_manifest(records: DataFrame, path: str) -> None:
    """Template records by source; sources that aren't among the records keep theirs."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source").json(path)


def write_extract_list(names: DataFrame, path: str, name: str = "image") -> None:
    """Distinct image names in order, one "Images\\name" a line."""
    names.select(name).where(F.col(name).isNotNull()).distinct().orderBy(name).select(F.concat(F.lit("Images\\"), F.col(name))).write.mode("overwrite").text(path)


def write_object(row: dict, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        json.dump(row, f, ensure_ascii=False, indent=2)
    os.replace(f"{path}.part", path)


def write_bundle_readme(path: str) -> None:
    text = "# Bundle\n\nRows lie in `data`, media in `media/files`. Resolve the paths on this host before use (needs Python only):\n\n    python resolve.py\n"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def write_bundle_resolver(path: str) -> None:
    """A program beside the bundle that makes its paths absolute where neither Spark nor this package is installed."""
    shutil.copyfile(os.path.join(os.path.dirname(os.path.abspath(__file__)), "bundle_resolver.py"), path)


def media_cards(images: Column, videos: Column) -> Column:
    """HTML of a row's images and of its videos' frames."""
    tag = lambda p, alt: F.concat(F.lit('<img src="'), html_escape(F.concat(F.lit("file://"), F.replace(p, F.lit(" "), F.lit("%20")))), F.lit(f'" alt="{alt}">'))
    pictures = F.array_join(F.transform(F.coalesce(images, F.array().cast("array<string>")), lambda p: tag(p, "image")), "")
    clips = F.array_join(F.transform(F.coalesce(videos, F.array().cast("array<array<string>>")), lambda v: F.concat(F.lit('<div class="clip">'), F.array_join(F.transform(v, lambda p: tag(p, "frame")), ""), F.lit("</div>"))), "")
    return F.concat(pictures, clips)


def preview_card(dataset: Column, sample_id: Column, messages: Column, images: Column, videos: Column) -> Column:
    """One sample as an HTML article, everything escaped."""
    said = lambda role: html_escape(F.coalesce(F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"], F.lit("")))
    return F.concat(F.lit("<article><h2>"), html_escape(dataset), F.lit(" / "), html_escape(sample_id), F.lit("</h2>"), media_cards(images, videos), F.lit("<h3>Request</h3><p>"), said("user"), F.lit("</p><h3>Target</h3><p>"), said("assistant"), F.lit("</p></article>"))


def write_preview(cards: DataFrame, path: str) -> None:
    """A page of all cards (columns ordinal, card), in order; rows stream through the driver."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(f"{path}.part", "w", encoding="utf-8") as f:
        f.write('<!doctype html><meta charset="utf-8"><title>Preview</title><style>img{width:220px}.clip{display:flex}</style>')
        for r in cards.orderBy("ordinal").toLocalIterator():
            f.write(r["card"])
    os.replace(f"{path}.part", path)
