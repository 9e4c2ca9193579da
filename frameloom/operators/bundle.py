"""Relocatable bundles: deduplicated media, rewritten references, and the way back."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bundle_path, gib, normal_path
from ..session import ship, small
from .quality import media_of

#: Fields of a row that hold media.
MEDIA_FIELDS = ("images", "videos", "audios", "rejected_images", "rejected_videos", "rejected_audios")


def references(df: DataFrame, key: str) -> DataFrame:
    """(key, field, video, position, path) of all media fields that df has; a field is an array of paths or an array of such arrays."""
    parts = []
    kinds = dict(df.dtypes)
    for name in MEDIA_FIELDS:
        if kinds.get(name) == "array<string>":
            parts.append(df.select(key, F.lit(name).alias("field"), F.lit(0).alias("video"), F.posexplode(name).alias("position", "path")))
        elif kinds.get(name) == "array<array<string>>":
            parts.append(df.select(key, F.posexplode(name).alias("video", "frames")).select(key, F.lit(name).alias("field"), "video", F.posexplode("frames").alias("position", "path")))
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    return made.where("path is not null")


def _moved(value, move: Callable[[str], str]):
    if value is None:
        return None
    if isinstance(value, str):
        return move(value)
    if isinstance(value, list):
        return [_moved(v, move) for v in value]
    raise TypeError(f"not a media value: {type(value).__name__}")


def moved_line(text: str, move: Callable[[str], str], place: str = "") -> str:
    """A JSON object with move(path) for each path in its media fields, however nested; all other keys and values stay."""
    try:
        row = json.loads(text)
        for name in MEDIA_FIELDS:
            if name in row:
                row[name] = _moved(row[name], move)
    except (TypeError, ValueError) as e:
        raise ValueError(f"{e}: {place}") from e
    made = json.dumps(row, ensure_ascii=False)
    try:
        made.encode()
    except UnicodeEncodeError:  # half of a surrogate pair, which only an escape can hold
        return json.dumps(row)
    return made


def line_references(df: DataFrame, key: str, line: str) -> DataFrame:
    """(key, path): each media reference of each JSON object in the column line, in all media fields."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for k, text in zip(pdf[key], pdf[line], strict=True):
                moved_line(text, lambda p, k=k: found.append((k, p)) or p, str(k))
            yield pd.DataFrame(found, columns=[key, "path"])

    ship(df.sparkSession)
    return df.select(key, line).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, path string")


def lines_moved(df: DataFrame, line: str, moves: str | None = None, root: str | None = None) -> DataFrame:
    """df with the media paths in its JSON objects replaced: as moves (a JSON object by path) says, or, with root, put below it if they are relative."""
    base = (root or "").rstrip("/") + "/"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            tables = [json.loads(m or "{}") for m in pdf[moves]] if moves else [None] * len(pdf)
            made = [moved_line(t, table.__getitem__ if moves else lambda p: p if p.startswith("/") else base + p) for t, table in zip(pdf[line], tables, strict=True)]
            yield pdf.assign(**{line: pd.Series(made, index=pdf.index, dtype=object)})

    ship(df.sparkSession)
    return df.mapInPandas(run, df.schema)


def resolved(paths: DataFrame, files: DataFrame, folders: list[Column], path: str = "path") -> DataFrame:
    """paths with source: the first file that exists among the path itself (if absolute) and the path below each folder, in order; null if none.

    files: (path) of what exists. One join serves all candidates. Steps such as .. and . are taken out first, so a file has one source.
    """
    tries = [F.when(F.col(path).startswith("/"), normal_path(F.col(path)))] + [F.when(~F.col(path).startswith("/"), normal_path(F.concat_ws("/", F.regexp_replace(f, "/+$", ""), F.col(path)))) for f in folders]
    wanted = paths.select(path, *[t.alias(f"__t{i}") for i, t in enumerate(tries)]).distinct()
    each = wanted.select("*", F.posexplode(F.array(*[F.col(f"__t{i}") for i in range(len(tries))])).alias("__i", "__c")).where("__c is not null")
    there = each.join(files.select(F.col("path").alias("__c")).distinct(), "__c").groupBy(path, *[f"__t{i}" for i in range(len(tries))]).agg(F.min_by("__c", "__i").alias("source"))
    best = there.groupBy(path).agg(F.min("source").alias("source"))
    return paths.join(best, path, "left")


def manifest(refs: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(source_path, bundle_path, size_bytes, reference_count): one row a media file, counted over all references.

    refs: (path); sizes: (path, size). References of a path that a third of all rows use are counted by partial sums.
    """
    counted = refs.groupBy(F.col("path").alias("source_path")).agg(F.count(F.lit(1)).alias("reference_count"))
    named = counted.withColumn("bundle_path", bundle_path(F.col("source_path")))
    if sizes is None:
        return named.select("source_path", "bundle_path", F.lit(None).cast("long").alias("size_bytes"), "reference_count")
    known = sizes.groupBy(F.col("path").alias("source_path")).agg(F.max("size").alias("size_bytes"))
    return named.join(known, "source_path", "left").select("source_path", "bundle_path", "size_bytes", "reference_count")


def media_totals(entries: DataFrame) -> DataFrame:
    """(unique_media_files, media_bytes, gib) of a manifest, in one row."""
    total = F.coalesce(F.sum("size_bytes"), F.lit(0))
    return entries.agg(F.count(F.lit(1)).alias("unique_media_files"), total.alias("media_bytes"), gib(total).alias("gib"))


def missing_bytes(entries: DataFrame, present: DataFrame) -> DataFrame:
    """(files, missing): how many files and bytes of a manifest aren't among the bundle's files (column path) yet."""
    absent = entries.join(present.select(F.col("path").alias("bundle_path")).distinct(), "bundle_path", "left_anti")
    return absent.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("missing"))


def require_space(entries: DataFrame, present: DataFrame, folder: str, free: int | None = None) -> int:
    """The bytes still to copy; an error if the folder's disk has fewer."""
    need = missing_bytes(entries, present).first()["missing"]
    room = shutil.disk_usage(folder).free if free is None else free
    if need > room:
        raise OSError(f"{need / 2**30:.2f} GiB are needed, {room / 2**30:.2f} GiB are free")
    return need


def rewritten(df: DataFrame, expr) -> DataFrame:
    """df with each media path replaced by expr(path), in every media field; other columns stay as they are."""
    kinds = dict(df.dtypes)
    for name in MEDIA_FIELDS:
        if kinds.get(name) == "array<string>":
            df = df.withColumn(name, F.transform(name, lambda p: expr(p)))
        elif kinds.get(name) == "array<array<string>>":
            df = df.withColumn(name, F.transform(name, lambda v: F.transform(v, lambda p: expr(p))))
    return df


def packed(df: DataFrame) -> DataFrame:
    """Rows whose media point into the bundle. The bundle path follows from the source path alone, so no join is needed."""
    return rewritten(df, bundle_path)


def unpacked(df: DataFrame, root: str) -> DataFrame:
    """Rows of a bundle with absolute media paths below its place on this host."""
    base = root.rstrip("/") + "/"
    return rewritten(df, lambda p: F.when(p.startswith("/"), p).otherwise(F.concat(F.lit(base), p)))


def restored(df: DataFrame, key: str, entries: DataFrame) -> DataFrame:
    """Rows of a bundle with their source paths again, in all media fields, looked up in the manifest; order and nesting stay. An unknown path is an error."""
    known = small(entries.select(F.col("bundle_path").alias("path"), "source_path"))
    met = references(df, key).select(key, "path").distinct().join(known, "path", "left").withColumn("source_path", F.coalesce("source_path", F.raise_error(F.concat(F.lit("not in the manifest: "), F.col("path")))))
    table = met.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("path", "source_path"))).alias("__back"))  # of one row
    return rewritten(df.join(table, key, "left"), lambda p: F.element_at("__back", p)).drop("__back")


def unresolved(df: DataFrame, key: str, files: DataFrame) -> DataFrame:
    """References to media that files (column path) doesn't list."""
    return media_of(df, key).join(files.select("path").distinct(), "path", "left_anti")


def metadata(entries: DataFrame, rows: DataFrame, source_root: str, source_data: str) -> DataFrame:
    """One row about a bundle: format, roots, numbers of files, rows and media, bytes, and its two data folders.

    rows: (file) one row for each row of any file.
    """
    media = media_totals(entries).first()
    files = rows.agg(F.count_distinct("file").alias("jsonl_files"), F.count(F.lit(1)).alias("rows_across_files"))
    fixed = {"format": "relocatable-bundle-1", "source_root": source_root, "source_data": source_data, "canonical_data_directory": "data", "runtime_data_directory": "runtime_data"}
    totals = [F.lit(media[k]).cast("long").alias(k) for k in ("unique_media_files", "media_bytes")]
    return files.select(*[F.lit(v).alias(k) for k, v in fixed.items()], "jsonl_files", "rows_across_files", *totals)


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def publish(entries: DataFrame, root: str, mode: str = "copy", checksum: bool = False, repair: bool = False) -> DataFrame:
    """(source_path, bundle_path, size_bytes, reference_count, sha256, action): copies or links each media file of a manifest into the bundle.

    Runs where the rows are, so the folder has to be shared. A file of the same size (and, with checksum, digest) is left as it is; another one
    is an error, or is replaced with repair. Copies are made under another name and then renamed, so a repeated task does no harm.
    """
    if mode not in ("copy", "hardlink"):
        raise ValueError("mode is copy or hardlink")

    def place(source: str, target: str) -> str:
        os.makedirs(os.path.dirname(target), exist_ok=True)
        if os.path.exists(target):
            same = os.path.getsize(target) == os.path.getsize(source) and (not checksum or file_digest(target) == file_digest(source))
            if same:
                return "kept"
            if not repair:
                raise FileExistsError(f"{target} differs from {source}")
        half = f"{target}.{os.getpid()}.part"
        if mode == "copy":
            shutil.copyfile(source, half)
        else:
            os.link(source, half)
        os.replace(half, target)
        return "placed"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            done = [place(s, os.path.join(root, b)) for s, b in zip(pdf["source_path"], pdf["bundle_path"], strict=True)]
            sums = [file_digest(os.path.join(root, b)) if checksum else None for b in pdf["bundle_path"]]
            sizes = [os.path.getsize(os.path.join(root, b)) for b in pdf["bundle_path"]]
            yield pdf[["source_path", "bundle_path"]].assign(size_bytes=sizes, reference_count=pdf["reference_count"], sha256=pd.Series(sums, dtype=object, index=pdf.index), action=done)

    ship(entries.sparkSession)
    return entries.mapInPandas(run, "source_path string, bundle_path string, size_bytes long, reference_count long, sha256 string, action string")
