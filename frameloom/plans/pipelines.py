"""Whole pipelines: one builder for each source, the build, templates, packing, checking and evaluation.

Builders read annotations and file listings and give samples (dataset, sample_id, split, row, metadata); nothing is written until a sink is called,
and files are unpacked, cut or copied by actions of their own.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import assemble, bundle, quality, sampling
from ..session import small
from ..sources import archives, files, json, schemas, sinks

Builder = Callable[["Build"], DataFrame]


@dataclass
class Build:
    """What a build needs: the session, the data's root, quotas, seed, temporal scales, and where unpacked frames go."""

    spark: SparkSession
    root: str
    output: str = "dataset"
    seed: int = sampling.SEED
    quotas: dict[str, int] = field(default_factory=lambda: dict(sampling.QUOTAS))
    scales: tuple[str, ...] = ("long",)

    def seed_of(self, dataset: str) -> int:
        return self.seed + sampling.SEED_OFFSETS[dataset]

    def folder(self, name: str) -> str:
        return files.dataset_folder(self.root, name)


def _samples(df: DataFrame, dataset: str, group: Column, response: Column, images: Column | None = None, video: Column | None = None, seed: int = sampling.SEED, split: Column | None = None) -> DataFrame:
    part = X.split_for_group(group.cast("string"), seed, assemble.RATIOS.get(dataset, assemble.DEFAULT_RATIO)) if split is None else split
    return df.select(F.lit(dataset).alias("dataset"), "sample_id", part.alias("split"), assemble.make_row(F.lit(dataset), response, images, video).alias("row"), assemble.metadata_json(df, dataset).alias("metadata"))


def build_d3(b: Build) -> DataFrame:
    """Distinct pairs of image and category, in random order up to the quota; then those whose image is there."""
    base = b.folder("d3")
    images, categories, pairs = json.described_objects(json.document(b.spark, os.path.join(base, "annotations.json"), schemas.DESCRIBED_OBJECTS))
    top = sampling.seeded_topk(pairs.withColumn("key", F.concat_ws(":", "image_id", "category_id")), "key", b.quotas["d3"], b.seed_of("d3"))
    named = top.join(images, "image_id").join(categories, "category_id").withColumn("path", F.concat(F.lit(f"{os.path.join(base, 'images')}/"), "file_name"))
    there = named.join(files.listing(b.spark, os.path.join(base, "images")).select("path"), "path", "left_semi")
    keyed = there.withColumn("sample_id", F.concat(F.lit("d3_"), "image_id", F.lit("_"), "category_id"))
    return _samples(keyed, "d3", F.col("image_id"), F.col("name"), F.array("path"), seed=b.seed)


def build_from_templates(dataset: str) -> Builder:
    """Scene and cut-out of template records, in random order up to the quota."""

    def build(b: Build) -> DataFrame:
        records = json.lines(b.spark, os.path.join(b.root, "templates", f"{dataset}.jsonl"), schemas.TEMPLATE)
        top = sampling.seeded_topk(records, "sample_id", b.quotas[dataset], b.seed_of(dataset))
        below = lambda c: F.when(F.col(c).startswith("/"), F.col(c)).otherwise(F.concat(F.lit(b.root.rstrip("/") + "/"), F.col(c)))
        group = F.coalesce(F.nullif(F.col("sequence"), F.lit("")), F.col("source_image"))
        return _samples(top, dataset, group, F.col("source_text"), F.array(below("source_image"), below("template_image")), seed=b.seed)

    return build


def build_lasot(b: Build) -> DataFrame:
    """A cut-out of the start and frames of prefixes of each sequence; equal frame groups of a sequence count once."""
    base = b.folder("lasot")
    records = json.lines(b.spark, os.path.join(b.root, "templates", "lasot.jsonl"), schemas.TEMPLATE).select("sequence", "template_image", "source_text")
    frames = files.sequence_frames(b.spark, base, "img").join(records, "sequence")
    variants = sampling.variants_per(b.quotas["lasot"], frames.select("sequence").distinct().count() * len(b.scales))
    made = sampling.prefix_groups(frames, "sequence", "frames", b.scales, variants)
    keyed = made.select("sequence", F.col("scale").alias("temporal_scale"), F.col("variant").alias("scale_variant"), F.transform("group", X.path_name).alias("sampled_frames"), "group", "template_image", "source_text").withColumn(
        "sample_id", F.concat_ws("_", F.lit("lasot"), "sequence", "temporal_scale", F.concat(F.lit("v"), "scale_variant"))
    )
    top = sampling.seeded_topk(keyed, "sample_id", b.quotas["lasot"], b.seed_of("lasot"))
    return _samples(top, "lasot", F.col("sequence"), F.col("source_text"), F.array("template_image"), F.col("group"), b.seed)


def build_refer_kitti(b: Build) -> DataFrame:
    """Expressions by turns over equal sentences; files without active frames are passed over; six frames each, from an archive."""
    base = b.folder("refer_kitti")
    read = json.annotation_files(b.spark, os.path.join(base, "expression", "*", "*.json"), schemas.EXPRESSION)
    said = F.lower(X.strip(F.coalesce(F.nullif(F.col("raw_sentence"), F.lit("")), F.col("sentence"))))
    each = read.withColumn("group", said).withColumn("ids", X.active_keys(F.col("label"))).withColumn("place", X.relative_path(F.col("file"), base))  # so that the order doesn't depend on where the data lie
    top = sampling.round_robin(each, "group", "place", b.quotas["refer_kitti"], b.seed_of("refer_kitti"), keep=F.size("ids") > 0)
    sequence, stem = X.path_parent(F.col("file")), X.path_stem(F.col("file"))
    keyed = top.withColumn("sequence", sequence).withColumn("sample_id", F.concat_ws("_", F.lit("refer_kitti"), sequence, stem)).withColumn("sampled_frames", X.even_sample(F.col("ids"), sampling.FRAMES))
    keyed = keyed.withColumn("expression_file", X.relative_path(F.col("file"), base))
    video = F.transform("sampled_frames", lambda i: F.concat(F.lit(f"{b.output}/frames/refer_kitti/"), F.col("sequence"), F.lit("/"), X.numbered_frame(i, ".png")))
    return _samples(keyed, "refer_kitti", F.col("sequence"), F.col("sentence"), None, video, b.seed)


def build_lamot(b: Build) -> DataFrame:
    """Variants of frames of each annotation file; the official split; samples with a missing frame are dropped after numbering."""
    base = b.folder("lamot")
    read = json.annotation_files(b.spark, os.path.join(base, "*", "MOT17", "*.json"), schemas.TRACKING)
    relative = X.relative_path(F.col("file"), base)
    each = read.withColumn("annotation_file", relative).withColumn("sequence", X.without_last_part(X.path_stem(F.col("file")))).withColumn("ids", X.active_keys(F.col("targets")))
    frames = files.images(b.spark, os.path.join(base, "frames")).withColumn("sequence", F.regexp_extract("path", r"/(?:train|test)/([^/]+)/", 1))
    homes = frames.groupBy("sequence").agg(F.max(F.regexp_extract("path", r"^(.*)/[^/]+$", 1)).alias("home"))  # train comes after test in order, so it is preferred
    there = each.join(small(homes), "sequence").where(F.size("ids") > 0)
    count = sampling.variants_per(b.quotas["lamot"], max(1, read.count()))
    made = sampling.window_variants(there, "annotation_file", "ids", count, b.seed).where("chosen is not null").withColumn("key", F.concat_ws("#", "annotation_file", F.col("variant").cast("string")))
    top = sampling.seeded_topk(made, "key", b.quotas["lamot"], b.seed_of("lamot"))
    keyed = top.withColumn("sampled_frames", F.col("chosen")).withColumn("sample_id", F.concat_ws("_", F.lit("lamot"), X.path_stem(F.col("annotation_file")), F.format_string("%04d", F.col("rank") - 1)))
    keyed = keyed.withColumn("video", F.transform("chosen", lambda i: F.concat(F.col("home"), F.lit("/"), X.numbered_frame(i, ".jpg"))))
    lost = keyed.select("sample_id", F.explode("video").alias("path")).join(frames.select("path"), "path", "left_anti").select("sample_id").distinct()
    whole = keyed.join(lost, "sample_id", "left_anti")
    split = F.when(X.under_segment(F.col("annotation_file"), "val"), "val").otherwise("train")
    return _samples(whole, "lamot", F.col("sequence"), F.col("language"), None, F.col("video"), b.seed, split)


def build_mevis(b: Build) -> DataFrame:
    """Expressions of videos in random order up to the quota, six frames each, from an archive."""
    base = b.folder("mevis")
    each = json.motion_expressions(json.document(b.spark, os.path.join(base, "meta_expressions.json"), schemas.MOTION))
    keyed = each.withColumn("sample_id", F.concat_ws("_", F.lit("mevis"), "video_id", "expression_id")).withColumn("sampled_frames", X.even_sample(F.col("frames"), sampling.FRAMES))
    top = sampling.seeded_topk(keyed, "sample_id", b.quotas["mevis"], b.seed_of("mevis"))
    video = F.transform("sampled_frames", lambda f: F.concat(F.lit(f"{b.output}/frames/mevis/"), F.col("video_id"), F.lit("/"), f, F.lit(".jpg")))
    return _samples(top, "mevis", F.col("video_id"), F.col("expression"), None, video, b.seed)


#: Builders by source, in build order; a source is added by adding a builder.
BUILDERS: dict[str, Builder] = {
    "d3": build_d3,
    "sorec": build_from_templates("sorec"),
    "refer_kitti": build_refer_kitti,
    "lamot": build_lamot,
    "lasot": build_lasot,
    "tnl2k": build_from_templates("tnl2k"),
    "mevis": build_mevis,
}


def build(b: Build, datasets: tuple[str, ...] = tuple(BUILDERS), mode: str = "full", per_dataset: int = 3, media: DataFrame | None = None) -> DataFrame:
    """All samples with ordinal, in the final random order; an error if one of them is faulty.

    demo: per_dataset samples of each source, all in a split named demo. media (column path): files that have to be there.
    """
    if mode == "demo":
        b.quotas = dict.fromkeys(b.quotas, per_dataset)
    samples = assemble.union_samples([BUILDERS[d](b) for d in datasets])
    if mode == "demo":
        samples = samples.withColumn("split", F.lit("demo"))
    ordered = assemble.global_order(samples, ["dataset", "sample_id"], b.seed)
    flat = ordered.select("ordinal", "row.messages", "row.images", "row.videos")
    quality.assert_no_errors(quality.check_report(quality.checked(flat, "ordinal", media, (quality.ROLES[0],)).withColumn("file", F.lit("build")), "file", "ordinal"))
    return ordered


def write_build(samples: DataFrame, output: str, mode: str = "full") -> None:
    sinks.write_samples(samples, output, mode)
    sinks.write_lines(samples.select("ordinal", "row.messages", "row.images", "row.videos"), f"{output}/merged", "ordinal")
    if mode == "demo":
        card = sinks.preview_card(F.col("dataset"), F.col("sample_id"), F.col("row.messages"), F.col("row.images"), F.col("row.videos"))
        sinks.write_preview(samples.select("ordinal", card.alias("card")), f"{output}/preview.html")


def tracking_templates(spark: SparkSession, root: str, name: str, folder: str, scale: float = 2.0, size: int = 336, sizes: DataFrame | None = None, language: str = "language.txt") -> DataFrame:
    """Template records of a tracking dataset: the box of each sequence's first frame.

    sizes (path, width, height): of the frames; by default read from the images' headers. A box outside its image is an error.
    """
    base = files.dataset_folder(root, name)
    each = files.sequences(spark, base, folder, language=language).withColumn("path", F.get("frames", 0)).withColumn("box", X.parse_box(F.col("box_line")))
    known = sizes if sizes is not None else archives.verified(spark, base).where("width is not null").select("path", "width", "height")
    met = each.join(known, "path").withColumn("crop", X.square_crop(F.col("width"), F.col("height"), F.col("box.x"), F.col("box.y"), F.col("box.w"), F.col("box.h"), scale))
    inside = (F.col("box.x") < F.col("width")) & (F.col("box.y") < F.col("height")) & (F.col("box.x") + F.col("box.w") > 0) & (F.col("box.y") + F.col("box.h") > 0)
    checked = F.when(inside, F.col("sequence")).otherwise(F.raise_error(F.concat(F.lit("the box lies outside the image: "), F.col("path"))))
    return _records(met.withColumn("sequence", checked), F.concat_ws("_", F.lit(name), "sequence"), name, F.col("sequence"), F.lit(None).cast("int"), X.relative_path(F.col("path"), root), F.col("text"), scale, size)


def small_object_templates(spark: SparkSession, root: str, annotations: str, images_root: str, sizes: DataFrame, limit: int | None = 6000, scale: float = 3.0, size: int = 336, seed: int = sampling.SEED) -> DataFrame:
    """Template records of small objects: the first of each image before any repeat, up to a limit; a missing image is an error."""
    rows = json.elements(spark, annotations, schemas.SMALL_OBJECTS)
    top = sampling.unique_first(rows, "image", "position", limit, seed)
    met = top.join(files.image_index(spark, images_root), top["image"] == F.col("name"), "left")
    lost = met.where("path is null").select("image").distinct()
    if n := lost.count():
        first = [r["image"] for r in lost.orderBy("image").limit(5).collect()]
        raise FileNotFoundError(f"{n} images are missing, such as {', '.join(first)}")
    box = F.struct(*[F.get("bbox", i).alias(k) for i, k in enumerate("xywh")])
    sized = met.join(sizes.select("path", "width", "height"), "path").withColumn("box", box)
    sized = sized.withColumn("crop", X.square_crop(F.col("width"), F.col("height"), F.col("box.x"), F.col("box.y"), F.col("box.w"), F.col("box.h"), scale))
    identifier = X.template_id(F.col("position"), F.col("image"), F.col("box.x"), F.col("box.y"), F.col("box.w"), F.col("box.h"))
    return _records(sized, identifier, "sorec", F.lit(None).cast("string"), F.col("position"), X.relative_path(F.col("path"), root), X.strip(F.col("ref")), scale, size)


def _records(df: DataFrame, sample_id: Column, source: str, sequence: Column, index: Column, image: Column, text: Column, scale: float, size: int) -> DataFrame:
    return df.select(
        sample_id.alias("sample_id"),
        F.lit(source).alias("source"),
        sequence.alias("sequence"),
        index.cast("int").alias("source_index"),
        image.alias("source_image"),
        F.concat(F.lit(f"templates/{source}/"), sample_id, F.lit(".jpg")).alias("template_image"),
        F.array("box.x", "box.y", "box.w", "box.h").alias("bbox_xywh"),
        F.array("crop.left", "crop.top", "crop.right", "crop.bottom").alias("crop_xyxy"),
        F.array("width", "height").alias("original_size"),
        F.lit(scale).alias("context_scale"),
        F.lit(size).alias("output_size"),
        text.alias("source_text"),
    )


def read_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(file, line, raw, error, messages) of all JSON-lines files below a folder; raw is the line itself, with all keys."""
    return json.numbered_lines(spark, folder, "messages string", raw=True)


def pack(spark: SparkSession, source_root: str, data: str, output: str, mode: str = "copy", checksum: bool = False, repair: bool = False, dry_run: bool = False) -> dict:
    """Packs the rows below data and their media into a bundle; what was packed, as a dictionary. A line that can't be read is an error. dry_run: nothing is written."""
    read = read_rows(spark, data)
    if read.where("error is null").isEmpty():
        raise FileNotFoundError(f"no rows below {data}")
    rows = json.readable(read).withColumn("id", F.concat_ws("#", "file", F.col("line").cast("string")))
    found = files.listing(spark, source_root)
    refs = bundle.line_references(rows, "id", "raw")
    sources = bundle.resolved(refs.select("path").distinct(), found, [F.lit(data), F.lit(source_root)])
    if lost := sources.where("source is null").count():
        raise FileNotFoundError(f"{lost} media files are missing")
    counted = refs.join(sources, "path").select(F.col("source").alias("path"))
    entries = bundle.manifest(counted, found)
    about = bundle.metadata(entries, rows.select("file"), source_root, data).first().asDict()
    if dry_run:
        return about
    os.makedirs(output, exist_ok=True)
    present = files.listing(spark, output).withColumn("path", X.relative_path(F.col("path"), output))
    if mode == "copy":
        bundle.require_space(entries, present, output)
    placed = bundle.publish(entries, output, mode, checksum, repair)
    placed.orderBy("bundle_path").select("source_path", "bundle_path", "size_bytes", "reference_count", "sha256").write.mode("overwrite").json(f"{output}/manifest")
    table = small(sources.select("path", bundle.bundle_path(F.col("source")).alias("bundle_path")))
    moves = refs.distinct().join(table, "path").groupBy("id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("path", "bundle_path")))).alias("moves"))  # of one row
    name = F.regexp_replace(X.relative_path(F.col("file"), data), r"\.jsonl$", "")
    packed = bundle.lines_moved(rows.join(moves, "id", "left").select(name.alias("name"), "line", F.col("raw").alias("value"), "moves"), "value", "moves")
    sinks.write_json_files(packed, f"{output}/data")
    sinks.write_object(about, f"{output}/bundle.json")
    sinks.write_bundle_readme(f"{output}/README.md")
    sinks.write_bundle_resolver(f"{output}/resolve.py")
    return about


def _below(root: str, folder: str) -> str:
    return folder if folder.startswith("/") or ":/" in folder else f"{root.rstrip('/')}/{folder}"


def resolve(spark: SparkSession, root: str, data: str = "data", output: str = "runtime_data", check_only: bool = False) -> dict[str, int]:
    """Rows of a bundle with absolute paths on this host, in their files and order; rows by file. A missing media file or an unreadable line is an error."""
    folder = _below(root, data)
    read = json.readable(read_rows(spark, folder))
    name = F.regexp_replace(X.relative_path(F.col("file"), folder), r"\.jsonl$", "")
    rows = bundle.lines_moved(read.select(name.alias("name"), "line", F.col("raw").alias("value")), "value", root=root)
    if rows.isEmpty():
        raise FileNotFoundError(f"no rows below {folder}")
    lost = bundle.line_references(rows, "name", "value").join(files.listing(spark, f"{root}/media").select("path").distinct(), "path", "left_anti").count()
    if lost:
        raise FileNotFoundError(f"{lost} references to media are broken")
    if not check_only:
        return sinks.write_json_files(rows, _below(root, output))
    return {r["name"]: r["n"] for r in rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).orderBy("name").toLocalIterator()}


def check(spark: SparkSession, root: str, data: str = "runtime_data", verify_images: bool = False, max_errors: int = 20) -> DataFrame:
    """The report on a bundle's rows: (file, rows, image_rows, video_rows, audio_rows, error_rows, errors), errors with their line numbers.

    A line that can't be read is an error of its file. Media of all fields have to be there.
    """
    folder = _below(root, data)
    read = json.numbered_lines(spark, folder, "messages string, images string, videos string, audios string", raw=True)
    name = F.regexp_replace(X.relative_path(F.col("file"), folder), r"\.jsonl$", "")
    rows = read.select(name.alias("file"), "line", F.concat_ws("#", "file", F.col("line").cast("string")).alias("id"), "raw", "error", F.from_json("messages", schemas.MESSAGES).alias("messages"), F.from_json("images", "array<string>").alias("images"), F.from_json("videos", "array<array<string>>").alias("videos"), "audios")
    refs = bundle.line_references(rows.where("error is null"), "id", "raw")

    def listed(paths: DataFrame, column: str) -> DataFrame:
        return paths.groupBy("id").agg(F.array_sort(F.collect_set("path")).alias(column))  # of one row

    met = rows.join(listed(refs.join(files.listing(spark, f"{root}/media").select("path").distinct(), "path", "left_anti"), "missing"), "id", "left")
    bad: Column | None = None
    if verify_images:
        wrong = archives.verified(spark, f"{root}/media").where("error is not null").select("path")
        met, bad = met.join(listed(refs.join(small(wrong), "path"), "corrupt"), "id", "left"), F.col("corrupt")
    errors = F.when(F.col("error").isNotNull(), F.array("error")).otherwise(quality.row_errors(F.col("messages"), F.col("images"), F.col("videos"), quality.ROLES, F.col("missing"), bad))
    return quality.check_report(met.withColumn("errors", errors), "file", "line", max_errors)


def evaluate(references: DataFrame, predictions: DataFrame, ordinal: str = "ordinal", model: str = "model", field_name: str = "auto", max_words: int = 80, max_sentences: int = 2, embed: Callable[[Column], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """Per-sample records and their summary; scores of meaning need a provider of token vectors."""
    p = predictions.select(ordinal, quality.prediction_text(predictions, field_name, strict=True).alias("prediction"))
    r = references.select(ordinal, quality.reference_text(references, strict=True).alias("reference"))
    both = quality.paired(p, r, ordinal)
    rows = quality.evaluated(quality.scored(both, embed) if embed else both, max_words, max_sentences)
    return rows, quality.summary(rows).withColumn("model", F.lit(model))
