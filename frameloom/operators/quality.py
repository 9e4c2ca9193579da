"""Validation of rows, extraction of texts, and scores of predictions."""

from __future__ import annotations

import importlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_of, format_reasons, let, strip
from .sampling import top_by_group

#: Keys of a prediction row that may hold its text, in the order they are tried.
PREDICTION_KEYS = ("response", "predict", "prediction", "generated_text", "output", "answer")
#: Keys of a reference row, tried after its last assistant message.
REFERENCE_KEYS = ("reference", "label", "answer")
#: Role orders that a checked row may have.
ROLES = (("system", "user", "assistant"), ("user", "assistant"))


def message_last(messages: Column, role: str) -> Column:
    """The content of the last message with a role, without white space around it; null if there is none."""
    return strip(F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(-1))["content"])


def message_first(messages: Column, role: str) -> Column:
    """The content of the first message with a role, as it is; "" if there is none."""
    return F.coalesce(F.try_element_at(F.filter(messages, lambda m: m["role"] == role), F.lit(1))["content"], F.lit(""))


def said_by(messages: Column, role: str) -> Column:
    """All contents of a role, joined."""
    return F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == role), lambda m: F.coalesce(m["content"], F.lit(""))), "")


def _first_text(columns: list[Column]) -> Column:
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in columns], F.lit(None).cast("string"))


def prediction_text(df: DataFrame, field: str = "auto", strict: bool = False) -> Column:
    """An explicit field as it is but for white space around it (it may be empty); auto: the first text that isn't blank among PREDICTION_KEYS, else the last assistant message.

    Without any text: null, or an error if strict.
    """
    if field != "auto":
        found = strip(F.col(field)) if field in df.columns else F.lit(None).cast("string")
    else:
        there = [F.col(k) for k in PREDICTION_KEYS if k in df.columns]
        found = _first_text(there + ([message_last(F.col("messages"), "assistant")] if "messages" in df.columns else []))
    return F.coalesce(found, F.raise_error(F.lit("a row has no prediction"))) if strict else found


def reference_text(df: DataFrame, strict: bool = False) -> Column:
    """The last assistant message, else the first text among REFERENCE_KEYS."""
    columns = ([message_last(F.col("messages"), "assistant")] if "messages" in df.columns else []) + [F.col(k) for k in REFERENCE_KEYS if k in df.columns]
    found = _first_text(columns)
    return F.coalesce(found, F.raise_error(F.lit("a row has no reference"))) if strict else found


def _prefixed(items: Column, text: str) -> Column:
    return F.transform(items, lambda p: F.concat(F.lit(text), p))


def row_errors(messages: Column, images: Column, videos: Column, roles: tuple[tuple[str, ...], ...] = ROLES, missing: Column | None = None, corrupt: Column | None = None) -> Column:
    """All errors of a row, as an array: messages, roles, empty answer, placeholders against media, missing and corrupt media (arrays of paths)."""
    n = F.coalesce(F.size(messages), F.lit(-1))
    said = F.transform(messages, lambda m: F.coalesce(m["role"], F.lit("null")))
    known = F.coalesce(F.array_join(said, ",").isin([",".join(r) for r in roles]), F.lit(False))
    good = n >= 2
    user = said_by(messages, "user")
    pictures, clips = F.coalesce(F.size(images), F.lit(0)), F.coalesce(F.size(videos), F.lit(0))
    pictures, clips = F.greatest(pictures, F.lit(0)), F.greatest(clips, F.lit(0))
    marks = lambda kind, n: F.format_string(f"%d marks for {kind}s, but %d {kind}s", count_of(user, f"<{kind}>"), n)
    tests = [
        F.when(~good, F.lit("no list of at least two messages")),
        F.when(good & ~known, F.concat(F.lit("roles out of order: "), F.array_join(said, ","))),
        F.when(good & (strip(said_by(messages, "assistant")) == ""), F.lit("no answer")),
        F.when(good & (count_of(user, "<image>") != pictures), marks("image", pictures)),
        F.when(good & (count_of(user, "<video>") != clips), marks("video", clips)),
    ]
    found = F.array_compact(F.array(*tests))
    for paths, text in ((missing, "media not found: "), (corrupt, "image unreadable: ")):
        if paths is not None:
            found = F.concat(found, F.coalesce(_prefixed(paths, text), F.array().cast("array<string>")))
    return found


def media_of(df: DataFrame, key: str, images: str = "images", videos: str = "videos") -> DataFrame:
    """(key, field, video, position, path): each media reference of each row, in depth-first order; null paths are left out."""
    pictures = df.select(key, F.lit("images").alias("field"), F.lit(0).alias("video"), F.posexplode(images).alias("position", "path"))
    clips = df.select(key, F.posexplode(videos).alias("video", "frames")).select(key, F.lit("videos").alias("field"), "video", F.posexplode("frames").alias("position", "path"))
    return pictures.unionByName(clips).where("path is not null")


def missing_media(df: DataFrame, key: str, files: DataFrame, path: str = "path", images: str = "images", videos: str = "videos") -> DataFrame:
    """(key, missing): of each row with any, the media paths that files doesn't list, in order."""
    refs = media_of(df, key, images, videos).join(files.select(F.col(path).alias("path")).distinct(), "path", "left_anti")
    return refs.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("field", "video", "position", "path"))), lambda x: x["path"]).alias("missing"))  # of one row


def checked(df: DataFrame, key: str, files: DataFrame | None = None, roles: tuple[tuple[str, ...], ...] = ROLES) -> DataFrame:
    """df with errors: an empty array for sound rows; files lists the media that are there (column path)."""
    if files is None:
        return df.withColumn("errors", row_errors(F.col("messages"), F.col("images"), F.col("videos"), roles))
    met = df.join(missing_media(df, key, files), key, "left")
    return met.withColumn("errors", row_errors(F.col("messages"), F.col("images"), F.col("videos"), roles, F.col("missing"))).drop("missing")


def check_report(rows: DataFrame, file: str, line: str, max_errors: int = 20) -> DataFrame:
    """(file, rows, image_rows, video_rows, error_rows, errors): one row a file; errors has the first max_errors of its faulty rows.

    All rows are counted; only the list is capped. A row's errors are joined by " | " after its line number.
    """
    sounds = [F.count("audios").alias("audio_rows")] if "audios" in rows.columns else []
    counts = rows.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), F.count("images").alias("image_rows"), F.count("videos").alias("video_rows"), *sounds, F.count_if(F.size("errors") > 0).alias("error_rows"))
    faulty = rows.where(F.size("errors") > 0).select(F.col(file), F.col(line).alias("l"), F.concat(F.col(line).cast("string"), F.lit(": "), F.array_join("errors", " | ")).alias("text"))
    first = top_by_group(faulty, [file], [F.col("l")], max_errors)
    lists = first.groupBy(file).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]).alias("errors"))  # capped
    return counts.join(lists, file, "left").withColumn("errors", F.coalesce("errors", F.array().cast("array<string>")))


def assert_no_errors(report: DataFrame) -> int:
    """The rows of all files; an error if any is faulty."""
    got = report.agg(F.sum("rows").alias("rows"), F.sum("error_rows").alias("bad")).first()
    if got["bad"]:
        raise ValueError(f"{got['bad']} of {got['rows']} rows are faulty")
    return got["rows"] or 0


def paired(predictions: DataFrame, references: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Predictions and references with the same place; a place that only one side has is an error when the rows are read."""
    p, r = predictions.withColumnRenamed(ordinal, "__p"), references.withColumnRenamed(ordinal, "__r")
    both = p.join(r, F.col("__p") == F.col("__r"), "full_outer")
    checked = F.when(F.col("__p").isNotNull() & F.col("__r").isNotNull(), F.col("__p")).otherwise(F.raise_error(F.lit("predictions and references differ in number or order")))
    return both.withColumn(ordinal, checked).drop("__p", "__r")


def evaluated(pairs: DataFrame, max_words: int = 80, max_sentences: int = 2, strict: bool = False) -> DataFrame:
    """pairs with format_success and format_fail_reasons of the column prediction."""
    why = pairs.withColumn("format_fail_reasons", format_reasons(F.col("prediction"), max_words, max_sentences, strict))
    return why.withColumn("format_success", F.size("format_fail_reasons") == 0)


def summary(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts, success rate (0 without rows) and mean scores; the mean F1 is that of the rows' F1."""
    means = [F.avg(c).alias(c) for c in ("bertscore_p", "bertscore_r", "bertscore_f1") if c in rows.columns]
    ok = F.count_if("format_success")
    made = [F.count(F.lit(1)).alias("num_samples"), *means, F.coalesce(F.avg(F.col("format_success").cast("double")), F.lit(0.0)).alias("format_success_rate"), ok.alias("format_success_count"), (F.count(F.lit(1)) - ok).alias("format_failure_count")]
    return rows.groupBy(*(by or [])).agg(*made)


def greedy_match(candidate: Column, reference: Column) -> Column:
    """struct(p, r, f1) of two arrays of token vectors: the mean best cosine of each side's tokens, and their harmonic mean; null without tokens."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    def unit(v: Column) -> Column:
        wide = F.transform(v, lambda x: x.cast("double"))
        return let(wide, lambda w: let(F.sqrt(dot(w, w)), lambda n: F.transform(w, lambda x: x / F.when(n > 0, n).otherwise(1.0))))

    mean = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x) / F.nullif(F.size(xs), F.lit(0))

    def scores(table: Column) -> Column:
        # rows are the candidate's tokens, columns the reference's
        wide = F.size(F.get(table, 0))
        p = mean(F.transform(table, lambda row: F.array_max(row)))
        r = F.when(wide > 0, mean(F.transform(F.sequence(F.lit(0), wide - 1), lambda j: F.array_max(F.transform(table, lambda row: F.get(row, j))))))
        return let(F.struct(p.alias("p"), r.alias("r")), lambda s: F.struct(s["p"].alias("p"), s["r"].alias("r"), F.when(s["p"] + s["r"] > 0, 2 * s["p"] * s["r"] / (s["p"] + s["r"])).when((s["p"] + s["r"]).isNotNull(), 0.0).alias("f1")))

    table = let(F.transform(reference, unit), lambda ref: F.transform(candidate, lambda c: let(unit(c), lambda u: F.transform(ref, lambda y: dot(u, y)))))
    return let(table, scores)


def embedder(spec: str, **options) -> Callable[[Column], Column]:
    """A provider of token vectors from module:function, called with a list of texts and the options, in Arrow batches where the rows are.

    The function gives a list of vectors (lists of numbers) for each text.
    """
    module, name = spec.split(":")

    @F.pandas_udf("array<array<float>>")
    def embed(texts: pd.Series) -> pd.Series:
        made = getattr(importlib.import_module(module), name)(texts.fillna("").tolist(), **options)
        return pd.Series([[list(map(float, v)) for v in vectors] for vectors in made])

    return embed


def scored(pairs: DataFrame, embed: Callable[[Column], Column]) -> DataFrame:
    """pairs with bertscore_p, bertscore_r and bertscore_f1 from any provider of token vectors (text column to array<array<float>>)."""
    held = pairs.withColumn("__p", embed(F.col("prediction"))).withColumn("__r", embed(F.col("reference")))
    made = held.withColumn("__s", greedy_match(F.col("__p"), F.col("__r"))).drop("__p", "__r")
    return made.withColumns({f"bertscore_{k}": F.col(f"__s.{k}") for k in ("p", "r", "f1")}).drop("__s")


def next_turn(df: DataFrame, group: str, order: str, role: str, text: str) -> DataFrame:
    """Each user turn with the assistant turn that follows it directly; null if another role does."""
    w = Window.partitionBy(group).orderBy(order)
    return df.withColumn("__r", F.lead(role).over(w)).withColumn("__t", F.lead(text).over(w)).where(F.col(role) == "user").select(group, order, F.col(text).alias("question"), F.when(F.col("__r") == "assistant", F.col("__t")).alias("answer"))
