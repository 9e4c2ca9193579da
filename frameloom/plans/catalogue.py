"""Queries that run the engine's operators over the driver's tables, whole tables each; oracles.py has SQL for them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as X
from ..operators import assemble, bundle, infer, quality, sampling
from ..session import read_table, scratch, stage
from ..sources import schemas, sinks
from ..streaming import run_available
from . import trees

Query = Callable[[SparkSession, str], DataFrame]


def parsed_samples(spark: SparkSession, sf: str) -> DataFrame:
    """built_samples with messages, images and videos; rows whose JSON can't be read are left out."""
    raw = read_table(spark, sf, "built_samples").where("row_json is not null")
    read = raw.select("sample_key", "dataset", "sample_id", "split", "batch_no", F.from_json("row_json", f"{schemas.ROW}, _bad string", {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return read.where("r._bad is null").select("sample_key", "dataset", "sample_id", "split", "batch_no", "r.messages", "r.images", "r.videos")


def _joined(c: Column, sep: str = ",") -> Column:
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").withColumn("part", X.split_for_group(F.col("doc_id"), 42, 0.1))
    return docs.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"))


def hash_fractions(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders").select("o_orderkey", F.round(X.hash_fraction(F.col("o_orderkey")), 12).alias("fraction"), X.sha1_seed(F.col("o_orderkey")).alias("seed"))


def group_split_leakage(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").withColumn("part", X.split_for_group(F.col("user_id"), 42, 0.1))
    return events.groupBy("user_id").agg(F.count_distinct("part").alias("parts"), F.min("part").alias("part"), F.count(F.lit(1)).alias("n"))


def distinct_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select("user_id", "event_type").distinct()


def annotation_join(spark: SparkSession, sf: str) -> DataFrame:
    pairs = read_table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    parts, suppliers = read_table(spark, sf, "part"), read_table(spark, sf, "supplier")
    return pairs.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("p_brand", "s_nationkey").agg(F.count(F.lit(1)).alias("pairs"))


def seeded_topk(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.seeded_topk(read_table(spark, sf, "documents").select("doc_id", "source"), "doc_id", 5, 42, by="source").select("source", "doc_id", "rank")


def quota_by_source(spark: SparkSession, sf: str) -> DataFrame:
    quotas = {"click": 40, "view": 30, "purchase": 20, "error": 10}
    return sampling.quota_sample(read_table(spark, sf, "events").select("event_id", "event_type"), "event_type", "event_id", quotas, 53).select("event_type", "event_id", "rank")


def limit_then_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    return sampling.limit_then_keep(read_table(spark, sf, "customer").select("c_custkey"), "c_custkey", 200, orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", 7).select("c_custkey", "rank")


def filter_after_rank(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'")
    return sampling.keep_after_rank(read_table(spark, sf, "customer").select("c_custkey"), "c_custkey", 200, orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", 7).select("c_custkey", "rank")


def unique_first_topk(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.unique_first(read_table(spark, sf, "events").select("event_id", "user_id"), "user_id", "event_id", 400, 42).select("event_id", "user_id", "rank")


def round_robin(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    return sampling.round_robin(docs, "source", "doc_id", 100, 79).select("source", "doc_id", "depth", "rank")


def round_robin_kept(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "n_chars")
    return sampling.round_robin(docs, "source", "doc_id", 100, 79, keep=F.col("n_chars") > 800).select("source", "doc_id", "depth", "rank")


def even_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.even_rows(read_table(spark, sf, "events"), "user_id", "event_id", 6).select("user_id", _joined(F.col("chosen")).alias("chosen"))


def _frames(spark: SparkSession, sf: str) -> DataFrame:
    # a user's events stand for the frames of a sequence
    return read_table(spark, sf, "events").groupBy("user_id").agg(F.array_sort(F.collect_list("event_id")).alias("frames"))


def prefix_groups(spark: SparkSession, sf: str) -> DataFrame:
    made = sampling.prefix_groups(_frames(spark, sf), "user_id", "frames", ("wide", "long", "full"), 1, 5)
    return made.select("user_id", "scale", "variant", "endpoint", _joined(F.col("group")).alias("chosen"))


def window_variants(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.window_variants(_frames(spark, sf), "user_id", "frames", 3, 83).select("user_id", "variant", _joined(F.col("chosen")).alias("chosen"))


def active_keys(spark: SparkSession, sf: str) -> DataFrame:
    made = F.create_map((F.col("user_id") + 1000).cast("string"), F.when(F.col("value") > 20, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")), F.lit("900"), F.array(F.lit(2)), F.lit("7"), F.when(F.col("event_type") == "click", F.array(F.lit(3))))
    return read_table(spark, sf, "events").select("event_id", _joined(X.active_keys(made)).alias("keys"))


def unnest_map(spark: SparkSession, sf: str) -> DataFrame:
    props = read_table(spark, sf, "events").select("event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("name", "value"))
    return props.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def bbox_parse(spark: SparkSession, sf: str) -> DataFrame:
    items = read_table(spark, sf, "lineitem")
    four = F.concat_ws(",", "l_quantity", "l_tax", "l_quantity", "l_discount")
    eight = F.concat_ws(" ", "l_tax", "l_discount", "l_quantity", "l_discount", "l_quantity", "l_quantity", "l_tax", "l_quantity")
    line = F.when(F.col("l_linenumber") % 2 == 0, four).otherwise(eight)
    return items.select("l_orderkey", "l_linenumber", X.parse_box(line, strict=False).alias("b")).groupBy("l_linenumber").agg(
        F.count("b").alias("boxes"), F.count_if(F.col("b").isNull()).alias("faulty"), F.round(F.sum("b.x"), 3).alias("x"), F.round(F.sum("b.y"), 3).alias("y"), F.round(F.sum("b.w"), 3).alias("w"), F.round(F.sum("b.h"), 3).alias("h")
    )


def square_crop(spark: SparkSession, sf: str) -> DataFrame:
    """The crops of all records that have a box, a size and a scale, each by its own scale."""
    return _crops(read_table(spark, sf, "template_records").where("context_scale is not null"))


def _crops(records: DataFrame) -> DataFrame:
    there = records.where("bbox_xywh is not null and original_size is not null and size(bbox_xywh) = 4")
    b = [F.get("bbox_xywh", i) for i in range(4)]
    c = X.square_crop(F.get("original_size", 0), F.get("original_size", 1), *b, F.col("context_scale"))
    return there.select("record_id", c["left"].alias("crop_left"), c["top"].alias("crop_top"), c["right"].alias("crop_right"), c["bottom"].alias("crop_bottom"))


def template_ids(spark: SparkSession, sf: str) -> DataFrame:
    there = read_table(spark, sf, "template_records").where("bbox_xywh is not null and size(bbox_xywh) = 4 and source_index is not null and source_image is not null")
    return there.select("record_id", X.template_id(F.col("source_index"), F.col("source_image"), *[F.get("bbox_xywh", i) for i in range(4)]).alias("template_id"))


def natural_sort(spark: SparkSession, sf: str) -> DataFrame:
    names = read_table(spark, sf, "part").select("p_partkey", "p_type", F.concat(F.col("p_brand"), F.lit(" x"), F.col("p_size").cast("string"), F.lit(" "), F.col("p_name")).alias("name"))
    order = Window.partitionBy("p_type").orderBy(X.natural_key(F.col("name")), "name", "p_partkey")
    return names.select("p_partkey", F.row_number().over(order).alias("place"))


def path_parts(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("source_image")
    return read_table(spark, sf, "template_records").where("source_image is not null").select("record_id", X.path_stem(p).alias("stem"), X.path_parent(p).alias("parent"), X.path_suffix(p).alias("suffix"), X.without_last_part(X.path_stem(p)).alias("base"), X.relative_path(p, "sorec").alias("relative"), X.under_segment(p, "Images").alias("held"))


def frame_names(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders").select("o_orderkey", X.numbered_frame(F.col("o_orderkey") * 97, ".png").alias("frame"))


def build_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "template_records").where("source in ('sorec', 'tnl2k') and source_text is not null")
    r = assemble.make_row(F.col("source"), F.col("source_text"), F.array("source_image", "template_image"))
    return rows.select("record_id", r.alias("r")).select("record_id", _joined(F.transform("r.messages", lambda m: m["role"])).alias("roles"), F.get("r.messages", 1)["content"].alias("request"), F.get("r.messages", 2)["content"].alias("answer"), F.size("r.images").alias("image_count"), F.col("r.videos").isNull().alias("no_video"))


def sample_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "template_records").where("source = 'sorec'").select("record_id", "sample_id", "source_index", F.col("sequence_name").alias("sequence"))
    back = F.from_json(assemble.metadata_json(rows, "sorec"), "sample_id string, source_index int, sequence string")
    return rows.select("record_id", back.alias("m")).select("record_id", "m.sample_id", "m.source_index", "m.sequence")


def union_counts(spark: SparkSession, sf: str) -> DataFrame:
    built = read_table(spark, sf, "built_samples").select("dataset", F.col("sample_key").alias("key"))
    records = read_table(spark, sf, "template_records").select(F.col("source").alias("dataset"), F.col("record_id").alias("key"), "output_size")
    named = assemble.union_samples([built, records]).withColumn("dataset", F.coalesce("dataset", F.lit("none")))
    return assemble.by_dataset(named).withColumn("dataset", F.coalesce("dataset", F.lit("all")))


def global_order(spark: SparkSession, sf: str) -> DataFrame:
    return assemble.global_order(read_table(spark, sf, "documents").select("doc_id"), ["doc_id"], 42)


def role_validation(spark: SparkSession, sf: str) -> DataFrame:
    roles = _joined(F.transform("messages", lambda m: m["role"]))
    return parsed_samples(spark, sf).groupBy(roles.alias("roles")).agg(F.count(F.lit(1)).alias("n")).withColumn("valid", F.col("roles").isin("system,user,assistant", "user,assistant"))


def placeholder_check(spark: SparkSession, sf: str) -> DataFrame:
    user = quality.said_by(F.col("messages"), "user")
    n = lambda c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))
    return parsed_samples(spark, sf).select("sample_key", X.count_of(user, "<image>").alias("image_marks"), n("images").alias("images"), X.count_of(user, "<video>").alias("video_marks"), n("videos").alias("videos"))


def check_report_of_broken_rows(spark: SparkSession, sf: str) -> DataFrame:
    # as the tables hold no faulty rows, some lose their answer, media or first message here
    rows = parsed_samples(spark, sf).withColumn("file", F.coalesce(F.trim("dataset"), F.lit("none")))
    k = F.col("sample_key")
    broken = rows.withColumn("messages", F.when(k % 11 == 0, F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.when(m["role"] == "assistant", " ").otherwise(m["content"]).alias("content")))).when(k % 13 == 0, F.slice("messages", 2, 1)).otherwise(F.col("messages"))).withColumn("images", F.when(k % 17 == 0, F.lit(None)).otherwise(F.col("images")))
    report = quality.check_report(quality.checked(broken, "sample_key"), "file", "sample_key", 5)
    return report.select("file", "rows", "image_rows", "video_rows", "error_rows", F.size("errors").alias("listed"))


def _faulty(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    files = read_table(spark, sf, "media_manifest").select(F.col("source_path").alias("path")).where("path is not null")
    return quality.checked(rows.select("sample_key", "messages", "images", "videos"), "sample_key", files).where(F.size("errors") > 0).select("sample_key", F.size("errors").alias("errors"))


def check_errors(spark: SparkSession, sf: str) -> DataFrame:
    """(sample_key, errors): the faulty samples of all datasets, however spelled or missing. Media that the manifest doesn't list are missing."""
    return _faulty(spark, sf, parsed_samples(spark, sf))


def format_check(spark: SparkSession, sf: str) -> DataFrame:
    return quality.evaluated(read_table(spark, sf, "eval_records").select("eval_id", "prediction")).select("eval_id", "format_success", F.array_join("format_fail_reasons", ",").alias("reasons"))


def format_measures(spark: SparkSession, sf: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return read_table(spark, sf, "documents").select("doc_id", X.word_count(t).alias("words"), X.sentence_count(t).alias("sentences"), X.is_cjk(t).alias("cjk"))


def format_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.evaluated(read_table(spark, sf, "eval_records").select("model_name", "prediction", "bertscore_p", "bertscore_r", "bertscore_f1"))
    return quality.summary(rows, ["model_name"]).select("model_name", "num_samples", F.round("bertscore_p", 6).alias("p"), F.round("bertscore_r", 6).alias("r"), F.round("bertscore_f1", 6).alias("f1"), F.round("format_success_rate", 6).alias("rate"), "format_success_count", "format_failure_count")


def extract_text(spark: SparkSession, sf: str) -> DataFrame:
    rows = parsed_samples(spark, sf)
    return rows.select("sample_key", quality.reference_text(rows).alias("reference"), quality.message_first(F.col("messages"), "user").alias("request"))


def extract_prediction(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "eval_records").select("eval_id", F.when(F.col("eval_id") % 3 == 0, F.col("prediction")).alias("response"), "prediction", F.col("reference").alias("answer"))
    return rows.select("eval_id", quality.prediction_text(rows).alias("text"))


def positional_pair(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "eval_records")
    left, right = rows.select(F.col("eval_id").alias("ordinal"), "prediction"), rows.select(F.col("eval_id").alias("ordinal"), "reference")
    return quality.paired(left, right).select("ordinal", F.coalesce(F.trim("prediction") == F.trim("reference"), F.lit(False)).alias("same"))


def prompt_parts(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.transform(X.placeholder_tokens(F.col("prompt")), lambda t: F.when(t.isin("<image>", "<video>"), t).otherwise(F.length(t).cast("string")))
    return read_table(spark, sf, "eval_records").where("prompt is not null").select("eval_id", F.array_join(kinds, "|").alias("parts"))


def _sound(spark: SparkSession, sf: str) -> DataFrame:
    """Samples without errors: only these can be sent to a model."""
    return quality.checked(parsed_samples(spark, sf), "sample_key").where(F.size("errors") == 0).drop("errors")


def content_parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _sound(spark, sf)
    sent = rows.select("sample_key", infer.request_messages(F.col("messages"), F.col("images"), F.col("videos")).alias("r"))
    return sent.select("sample_key", F.length("r.system").alias("system_length"), _joined(F.transform("r.user", lambda p: p["type"])).alias("kinds"), F.aggregate("r.user", F.lit(0), lambda a, p: a + F.greatest(F.coalesce(F.size(p["video"]), F.lit(0)), F.lit(0))).alias("frames"))


def predicted_stub(spark: SparkSession, sf: str) -> DataFrame:
    return infer.predicted(_sound(spark, sf), "sample_key", wait=0.0).select("index", "response", "reference", "model", F.col("usage.total_tokens").alias("tokens"), "dataset")


def media_manifest(spark: SparkSession, sf: str) -> DataFrame:
    refs = bundle.references(parsed_samples(spark, sf), "sample_key")
    sizes = read_table(spark, sf, "media_manifest").select(F.col("source_path").alias("path"), F.col("size_bytes").alias("size"))
    return bundle.manifest(refs, sizes)


def media_totals(spark: SparkSession, sf: str) -> DataFrame:
    return bundle.media_totals(media_manifest(spark, sf))


def missing_bytes(spark: SparkSession, sf: str) -> DataFrame:
    entries = media_manifest(spark, sf)
    present = entries.where(F.substring("bundle_path", 13, 1) < "8").select(F.col("bundle_path").alias("path"))
    return bundle.missing_bytes(entries, present)


def bundle_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = parsed_samples(spark, sf).select(F.coalesce(F.trim("dataset"), F.lit("none")).alias("file"))
    return bundle.metadata(media_manifest(spark, sf), rows, "/data", "full").select("format", "jsonl_files", "rows_across_files", "unique_media_files", "media_bytes")


def rewrite_refs(spark: SparkSession, sf: str) -> DataFrame:
    packed = bundle.packed(parsed_samples(spark, sf))
    return packed.select("sample_key", F.array_join("images", "|").alias("images"), F.array_join(F.flatten("videos"), "|").alias("frames"))


def round_trip(spark: SparkSession, sf: str) -> DataFrame:
    rows = parsed_samples(spark, sf).select("sample_key", "images", "videos")
    entries = stage(bundle.manifest(bundle.references(rows, "sample_key")).select("source_path", "bundle_path"))
    back = bundle.restored(bundle.packed(rows), "sample_key", entries)
    return back.select("sample_key", F.array_join("images", "|").alias("images"), F.array_join(F.flatten("videos"), "|").alias("frames"))


def resolved_refs(spark: SparkSession, sf: str) -> DataFrame:
    back = bundle.unpacked(bundle.packed(parsed_samples(spark, sf)), "/mnt/bundle")
    refs = bundle.references(back, "sample_key")
    return refs.groupBy("field").agg(F.count(F.lit(1)).alias("refs"), F.count_if(F.col("path").startswith("/mnt/bundle/media/files/")).alias("below"))


def missing_refs(spark: SparkSession, sf: str) -> DataFrame:
    files = read_table(spark, sf, "media_manifest").select(F.col("source_path").alias("path")).where("path is not null")
    return bundle.unresolved(parsed_samples(spark, sf), "sample_key", files).groupBy("field").agg(F.count(F.lit(1)).alias("missing"), F.count_distinct("path").alias("paths"))


def greedy_match(spark: SparkSession, sf: str) -> DataFrame:
    # eight vectors stand for the tokens of a candidate, the next eight for those of its reference
    e = read_table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 16).alias("pair"), (F.floor(F.col("vec_id") / 8) % 2).alias("side"), "vec_id", "embedding")
    tokens = lambda s: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct("vec_id", "embedding")))), lambda x: x["embedding"])
    both = e.groupBy("pair").agg(tokens(0).alias("c"), tokens(1).alias("r")).where((F.size("c") > 0) & (F.size("r") > 0))
    return both.select("pair", quality.greedy_match(F.col("c"), F.col("r")).alias("s")).select("pair", F.round("s.p", 6).alias("p"), F.round("s.r", 6).alias("r"), F.round("s.f1", 6).alias("f1"))


def resume_missing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").alias("ordinal"), "lang")
    done = docs.where("ordinal % 4 != 0").select(F.col("ordinal").alias("index"))
    return infer.still_to_do(docs, done, "ordinal").select("ordinal", "lang")


def demo_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "built_samples").select("dataset", "sample_key").where("dataset is not null")
    return sampling.seeded_topk(rows, "sample_key", 3, 42, by="dataset").select("dataset", "sample_key", "rank")


def preview_html(spark: SparkSession, sf: str) -> DataFrame:
    rows = parsed_samples(spark, sf)
    return rows.select("sample_key", sinks.preview_card(F.coalesce("dataset", F.lit("")), F.coalesce("sample_id", F.lit("")), F.col("messages"), F.col("images"), F.col("videos")).alias("card")).select("sample_key", F.length("card").alias("length"), F.md5("card").alias("card"))


def data_urls(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".JPG").otherwise(".bin"))
    return read_table(spark, sf, "documents").where("text is not null").select("doc_id", F.md5(X.to_data_url(name, F.encode("text", "UTF-8"))).alias("url"))


def extract_list(spark: SparkSession, sf: str) -> DataFrame:
    names = read_table(spark, sf, "template_records").where("source = 'sorec' and source_image is not null")
    return names.select(F.concat(F.lit("Images\\"), X.path_name(F.col("source_image"))).alias("line")).distinct()


def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "template_records").groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("source_image").alias("images"))


def image_index(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "media_manifest").where("source_path is not null").groupBy(X.path_name(F.col("source_path")).alias("name")).agg(F.min("source_path").alias("path"))


def indexed_images(spark: SparkSession, sf: str) -> DataFrame:
    there = image_index(spark, sf)
    rows = read_table(spark, sf, "template_records").where("source = 'sorec'").select("record_id", X.path_name(F.col("source_image")).alias("name"))
    return rows.join(there, "name", "left").select("record_id", F.col("path").isNotNull().alias("found"))


def resume_state(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "eval_records").select((F.col("eval_id") - 1).alias("index"))
    done = docs.where("index < 1000")
    return spark.createDataFrame([(infer.contiguous(done, docs.count()),)], "done long")


def exact_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    nations = read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("ordinal"), "n_name")
    return sampling.exact_permutation(nations, "ordinal", 25, 42).select("ordinal", "n_name", "shuffled")


def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch(spark, f"stream-{uuid.uuid4().hex}")
    source = f"{base}/source"
    events = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    count = lambda df: df.where("value > 1").withColumn("split", X.split_for_group(F.col("user_id")))
    read = 0
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):  # the second delivery is all that the second run reads
        events.where(part).write.mode("append").parquet(source)
        read += run_available(spark, source, events.schema, f"{base}/out", f"{base}/checkpoint", count)
    return spark.read.parquet(f"{base}/out").groupBy("event_type", "split").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("events")).withColumn("read", F.lit(read))


NAMES = (
    "hash_split hash_fractions group_split_leakage distinct_pairs annotation_join seeded_topk quota_by_source limit_then_filter filter_after_rank unique_first_topk "
    "round_robin round_robin_kept even_sample prefix_groups window_variants active_keys unnest_map bbox_parse square_crop  template_ids natural_sort path_parts frame_names "
    "build_messages sample_metadata union_counts global_order role_validation placeholder_check check_report_of_broken_rows check_errors  format_check format_measures format_summary "
    "extract_text extract_prediction positional_pair prompt_parts content_parts predicted_stub media_manifest media_totals missing_bytes bundle_metadata rewrite_refs "
    "round_trip resolved_refs missing_refs greedy_match resume_missing demo_sample preview_html data_urls extract_list source_counts image_index indexed_images resume_state exact_shuffle stream_resume"
).split()


def queries() -> dict[str, Query]:
    return {name: globals()[name] for name in NAMES} | trees.queries()
