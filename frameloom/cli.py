"""Command line: python -m frameloom.cli COMMAND --help.

The session takes its settings from spark-submit or spark-defaults; on one machine a local one is started.
"""

from __future__ import annotations

import argparse
import importlib
import json as js
import os
import shutil
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import assemble, infer, quality, sampling
from .plans import pipelines
from .session import ship, stage
from .sources import archives, files, json, schemas, sinks


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="frameloom")
    commands = p.add_subparsers(dest="command", required=True)

    c = commands.add_parser("build", help="build samples from annotations")
    c.add_argument("--root", default=".")
    c.add_argument("--output", default="dataset/rows")
    c.add_argument("--mode", choices=("demo", "full"), default="demo")
    c.add_argument("--demo-per-dataset", type=int, default=3)
    c.add_argument("--seed", type=int, default=sampling.SEED)
    c.add_argument("--lasot-scales", nargs="+", choices=tuple(sampling.SCALE_RANGES), default=["long"])
    c.add_argument("--datasets", nargs="+", choices=tuple(pipelines.BUILDERS), default=list(pipelines.BUILDERS))

    c = commands.add_parser("templates", help="make template records")
    c.add_argument("--root", default=".")
    c.add_argument("--output", default="templates")
    c.add_argument("--datasets", nargs="+", choices=("sorec", "lasot", "tnl2k"), default=["sorec", "lasot", "tnl2k"])
    c.add_argument("--output-size", type=int, default=336)
    c.add_argument("--sorec-split", default="trainL")
    c.add_argument("--sorec-limit", type=int, default=6000)
    c.add_argument("--write-sorec-extract-list", action="store_true")
    c.add_argument("--render", action="store_true", help="cut the images too (needs Pillow)")
    c.add_argument("--seed", type=int, default=sampling.SEED)

    c = commands.add_parser("pack", help="pack rows and media into a bundle")
    c.add_argument("--root", default=".")
    c.add_argument("--source-data", default="dataset/rows")
    c.add_argument("--output", default="portable")
    c.add_argument("--mode", choices=("copy", "hardlink"), default="copy")
    c.add_argument("--checksum", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    c.add_argument("--repair", action="store_true")

    c = commands.add_parser("resolve", help="make a bundle's paths absolute")
    c.add_argument("--bundle-root", required=True)
    c.add_argument("--data-dir", default="data")
    c.add_argument("--output-dir", default="runtime_data")
    c.add_argument("--check-only", action="store_true")

    c = commands.add_parser("check", help="check a bundle's rows and media")
    c.add_argument("--bundle-root", required=True)
    c.add_argument("--data-dir", default="runtime_data")
    c.add_argument("--verify-images", action="store_true")
    c.add_argument("--max-errors", type=int, default=20)

    c = commands.add_parser("evaluate", help="check and score predictions")
    c.add_argument("--reference", required=True)
    c.add_argument("--prediction", required=True)
    c.add_argument("--model-name", default="model")
    c.add_argument("--prediction-field", default="auto")
    c.add_argument("--max-words", type=int, default=80)
    c.add_argument("--max-sentences", type=int, default=2)
    c.add_argument("--output-dir", default="evaluation")
    c.add_argument("--embedder", help="module:function, called with texts and the options below, gives the vectors of each text's tokens; without it nothing is scored")
    c.add_argument("--bert-model", default="roberta-large")
    c.add_argument("--bert-num-layers", type=int, default=24)
    c.add_argument("--device")
    c.add_argument("--batch-size", type=int, default=32)

    c = commands.add_parser("infer", help="ask a model; without a client or a server a stub answers")
    _asking(c)
    c.add_argument("--output", required=True)
    c.add_argument("--client", help="module:function, called with (system, user parts)")
    c.add_argument("--model", default="stub")

    c = commands.add_parser("compare", help="ask a model with and without an adapter, after checking that all is there")
    _asking(c)
    c.add_argument("mode", nargs="?", choices=("base", "lora", "both"), default="both")
    c.add_argument("--output-dir", required=True)
    c.add_argument("--base-client", help="module:function of the model")
    c.add_argument("--lora-client", help="module:function of the model with its adapter")
    return p


def _asking(c: argparse.ArgumentParser) -> None:
    c.add_argument("--dataset", required=True)
    c.add_argument("--media-root", help="where relative media paths lie; by default beside the dataset")
    c.add_argument("--paths-only", action="store_true", help="send media paths instead of their bytes")
    c.add_argument("--base-url", help="a server of the chat-completions protocol")
    c.add_argument("--api-key-env", default="API_KEY", help="the environment variable that holds its key")
    c.add_argument("--max-tokens", type=int, default=128)
    c.add_argument("--temperature", type=float, default=0.0)
    c.add_argument("--max-retries", type=int, default=5)
    c.add_argument("--retry-wait-seconds", type=float, default=5.0)
    c.add_argument("--request-interval", type=float, default=0.1)
    c.add_argument("--max-samples", type=int)
    c.add_argument("--resume", action=argparse.BooleanOptionalAction, default=True)


def _function(spec: str):
    module, name = spec.split(":")
    return getattr(importlib.import_module(module), name)


def _build(spark: SparkSession, a: argparse.Namespace) -> None:
    b = pipelines.Build(spark, a.root, a.output, a.seed, scales=tuple(a.lasot_scales))
    samples = pipelines.build(b, tuple(a.datasets), a.mode, a.demo_per_dataset)
    samples = stage(samples)
    pipelines.write_build(samples, a.output, a.mode)
    counts = {r["dataset"] or "all": r["samples"] for r in assemble.by_dataset(samples).collect()}  # a row a source
    print(js.dumps({"mode": a.mode, "output": a.output, "samples": counts}))


def _templates(spark: SparkSession, a: argparse.Namespace) -> None:
    parts = []
    if "sorec" in a.datasets:
        base = files.dataset_folder(a.root, "sorec")
        annotations = f"{base}/{a.sorec_split}.json"
        if a.write_sorec_extract_list:
            rows = json.elements(spark, annotations, schemas.SMALL_OBJECTS)
            sinks.write_extract_list(sampling.unique_first(rows, "image", "position", a.sorec_limit, a.seed), f"{a.output}/extract_list", "image")
            return
        sizes = archives.verified(spark, f"{base}/Images").where("width is not null")
        parts.append(pipelines.small_object_templates(spark, a.root, annotations, f"{base}/Images", sizes, a.sorec_limit, 3.0, a.output_size, a.seed))
    for name, folder, language in (("lasot", "img", "nlp.txt"), ("tnl2k", "imgs", "language.txt")):
        if name in a.datasets:
            parts.append(pipelines.tracking_templates(spark, a.root, name, folder, 2.0, a.output_size, language=language))
    records = parts[0]
    for part in parts[1:]:
        records = records.unionByName(part)
    sinks.write_manifest(records, f"{a.output}/manifest")
    lines = records.select(F.col("source").alias("name"), F.col("sample_id").alias("line"), F.to_json(F.struct(*records.columns)).alias("value"))
    sinks.write_json_files(lines, a.output)
    if a.render:
        crops = records.select("source_image", "template_image", *[F.get("crop_xyxy", i).alias(k) for i, k in enumerate(("left", "top", "right", "bottom"))])
        archives.render(crops, a.root, a.output_size).count()
    print(js.dumps({r["source"]: r["n"] for r in records.groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy("source").collect()}))  # a row a source


def _evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    read = lambda path: json.readable(json.numbered_lines(spark, path, schemas.PREDICTION, ordinal=True))
    embed = quality.embedder(a.embedder, model=a.bert_model, layers=a.bert_num_layers, device=a.device, batch_size=a.batch_size) if a.embedder else None
    rows, summary = pipelines.evaluate(read(a.reference), read(a.prediction), "ordinal", a.model_name, a.prediction_field, a.max_words, a.max_sentences, embed)
    rows = stage(rows.withColumn("index", F.col("ordinal")))
    lines = rows.select(F.lit(f"{a.model_name}_per_sample").alias("name"), F.col("ordinal").alias("line"), F.to_json(F.struct(*[c for c in rows.columns if c != "ordinal"])).alias("value"))
    sinks.write_json_files(lines, a.output_dir)
    used = {"bert_model": a.bert_model, "bert_num_layers": a.bert_num_layers, "idf": False, "rescale_with_baseline": False} if embed else {}
    about = quality.summary(rows).withColumn("model", F.lit(a.model_name)).first().asDict() | {"metric_config": {**used, "max_words": a.max_words, "max_sentences": a.max_sentences}}
    sinks.write_object(about, f"{a.output_dir}/{a.model_name}_summary.json")
    print(js.dumps(about))


def _ask(spark: SparkSession, a: argparse.Namespace, output: str, client, model: str) -> None:
    rows = json.readable(json.numbered_lines(spark, a.dataset, schemas.ROW, ordinal=True))
    rows = infer.head_rows(rows, "ordinal", a.max_samples)
    if not a.resume:
        shutil.rmtree(output, ignore_errors=True)
    todo, done = rows, infer.answers(spark, output)
    if done is not None:
        if other := done.join(rows.select(F.col("ordinal").alias("index")), "index", "left_anti").count():
            raise ValueError(f"{other} answers are of rows that aren't in the dataset")
        todo = infer.still_to_do(rows, done, "ordinal")
    folder = a.media_root or os.path.dirname(os.path.abspath(a.dataset))
    made = infer.predicted(todo, "ordinal", client, model, a.max_retries, a.retry_wait_seconds, a.request_interval, media_folder=None if a.paths_only else folder, log=output)
    made.write.format("noop").mode("overwrite").save()  # answers are logged as they come
    there = infer.answers(spark, output)
    print(js.dumps({"model": model, "output": output, "answers": there.count() if there is not None else 0}))


def _client(a: argparse.Namespace, spec: str | None, model: str):
    if spec:
        return _function(spec)
    return infer.ChatClient(a.base_url, model, a.api_key_env, a.max_tokens, a.temperature) if a.base_url else infer.stub_client


def _infer(spark: SparkSession, a: argparse.Namespace) -> None:
    _ask(spark, a, a.output, _client(a, a.client, a.model), a.model)


def _compare(spark: SparkSession, a: argparse.Namespace) -> None:
    """The runs of a mode; everything that any of them needs is checked before the first."""
    if not os.path.exists(a.dataset):
        raise FileNotFoundError(f"no dataset {a.dataset}")
    specs = {"base": a.base_client, "lora": a.lora_client}
    modes = ("base", "lora") if a.mode == "both" else (a.mode,)
    if lacking := [m for m in modes if not specs[m]]:
        raise ValueError(f"no client for {', '.join(lacking)}")
    clients = {m: _function(specs[m]) for m in modes}
    for m in modes:
        _ask(spark, a, os.path.join(a.output_dir, m), clients[m], m)


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("frameloom").getOrCreate()
    ship(spark)
    if a.command == "build":
        _build(spark, a)
    elif a.command == "templates":
        _templates(spark, a)
    elif a.command == "pack":
        print(js.dumps(pipelines.pack(spark, a.root, a.source_data, a.output, a.mode, a.checksum, a.repair, a.dry_run)))
    elif a.command == "resolve":
        print(js.dumps(pipelines.resolve(spark, a.bundle_root, a.data_dir, a.output_dir, a.check_only)))
    elif a.command == "check":
        report = pipelines.check(spark, a.bundle_root, a.data_dir, a.verify_images, a.max_errors).collect()  # a row a file
        print(js.dumps([r.asDict() for r in report]))
        return int(any(r["error_rows"] for r in report))
    else:
        {"evaluate": _evaluate, "infer": _infer, "compare": _compare}[a.command](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
