"""Requests to a model, and runs that can be taken up again."""

from __future__ import annotations

import base64
import json
import os
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from contextlib import ExitStack

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import let, placeholder_tokens, strip
from ..functions.text import MEDIA_TYPES
from ..session import ship
from .quality import message_first, message_last

ANSWER = "index long, response string, reference string, model string, usage struct<prompt_tokens:int,completion_tokens:int,total_tokens:int>"
PART = "struct<type:string,text:string,image_url:struct<url:string>,video:array<string>>"


def content_parts(prompt: Column, images: Column, videos: Column, url: Callable[[Column], Column] = lambda p: p) -> Column:
    """A prompt as an array of parts: texts (stripped, blank ones left out), images and videos in the order of their placeholders.

    The n-th placeholder of a kind takes the n-th medium. Media that don't match the placeholders in number are an error.
    """
    pictures, clips = F.coalesce(images, F.array().cast("array<string>")), F.coalesce(videos, F.array().cast("array<array<string>>"))

    def parts(tokens: Column) -> Column:
        before = lambda i, kind: F.size(F.filter(F.slice(tokens, F.lit(1), i + 1), lambda t: t == kind)) - 1
        number = lambda kind: F.size(F.filter(tokens, lambda t: t == kind))

        def part(t: Column, i: Column) -> Column:
            text = F.when(~t.isin("<image>", "<video>"), strip(t))
            image = F.when(t == "<image>", F.struct(url(F.get(pictures, before(i, "<image>"))).alias("url")))
            video = F.when(t == "<video>", F.transform(F.get(clips, before(i, "<video>")), lambda p: url(p)))
            kind = F.when(t == "<image>", "image_url").when(t == "<video>", "video").otherwise("text")
            return F.struct(kind.alias("type"), text.alias("text"), image.alias("image_url"), video.alias("video"))

        made = F.filter(F.transform(tokens, part), lambda p: (p["type"] != "text") | (p["text"] != ""))
        match = (number("<image>") == F.size(pictures)) & (number("<video>") == F.size(clips))
        return F.when(match, made).otherwise(F.raise_error(F.lit("media don't match the placeholders in number")))

    return let(placeholder_tokens(F.coalesce(prompt, F.lit(""))), parts)


def request_messages(messages: Column, images: Column, videos: Column, url: Callable[[Column], Column] = lambda p: p) -> Column:
    """struct(system, user): what a model is sent; system is null without a system message, and the assistant's message is never sent."""
    return F.struct(F.nullif(message_first(messages, "system"), F.lit("")).alias("system"), content_parts(message_first(messages, "user"), images, videos, url).alias("user"))


def stub_client(system: str | None, user: list) -> dict:
    """A client for tests: answers with the first words of the request."""
    text = " ".join(p["text"] for p in user if p["type"] == "text")
    return {"response": " ".join(text.split()[:8]), "usage": {"prompt_tokens": len(text.split()), "completion_tokens": min(8, len(text.split())), "total_tokens": len(text.split()) + min(8, len(text.split()))}}


def data_url(path: str) -> str:
    """A file of a shared folder as a data URL; an error if it isn't there."""
    kind = MEDIA_TYPES.get(path.rsplit(".", 1)[-1].lower(), "application/octet-stream")
    with open(path, "rb") as f:
        return f"data:{kind};base64,{base64.b64encode(f.read()).decode()}"


def with_media(parts: list, folder: str) -> list:
    """Request parts with the bytes of their media in place of paths; relative ones lie below folder."""
    inline = lambda p: data_url(os.path.join(folder, p))
    out = []
    for part in parts:
        part = {k: v for k, v in part.items() if v is not None}
        if "image_url" in part:
            part["image_url"] = {"url": inline(part["image_url"]["url"])}
        if "video" in part:
            part["video"] = [inline(p) for p in part["video"]]
        out.append(part)
    return out


class ChatClient:
    """A client of any server that speaks the chat-completions protocol over HTTP; the key is read from an environment variable where the tasks run."""

    def __init__(self, base_url: str, model: str, api_key_env: str = "API_KEY", max_tokens: int = 128, temperature: float = 0.0, timeout: float = 120.0):
        self.base_url, self.model, self.api_key_env = base_url.rstrip("/"), model, api_key_env
        self.options, self.timeout = {"max_tokens": max_tokens, "temperature": temperature}, timeout

    def __call__(self, system: str | None, user: list) -> dict:
        messages = ([{"role": "system", "content": system}] if system else []) + [{"role": "user", "content": user}]
        body = json.dumps({"model": self.model, "messages": messages, **self.options}).encode()
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get(self.api_key_env, '')}"}
        with urllib.request.urlopen(urllib.request.Request(f"{self.base_url}/chat/completions", body, headers), timeout=self.timeout) as held:  # noqa: S310
            got = json.load(held)
        usage = got.get("usage") or {}
        return {"response": (got["choices"][0]["message"]["content"] or "").strip(), "usage": {k: usage.get(k) for k in ("prompt_tokens", "completion_tokens", "total_tokens")} if usage else None}


def predicted(
    df: DataFrame,
    ordinal: str,
    client: Callable[[str | None, list], dict] = stub_client,
    model: str = "stub",
    retries: int = 5,
    wait: float = 5.0,
    interval: float = 0.0,
    keep: tuple[str, ...] = ("dataset", "source", "eval_meta"),
    media_folder: str | None = None,
    log: str | None = None,
) -> DataFrame:
    """(index, response, reference, model, usage, kept columns): each row's answer from a client (system, user parts) -> {response, usage}.

    A failed call is repeated after wait seconds times the number of failures; after retries the run fails. interval seconds pass between
    the calls of a task. Rows go through in Arrow batches, so a task holds one batch at a time. media_folder: media are sent as data URLs, relative
    paths taken below it; without it paths are sent. log: a shared folder where each answer is written as soon as it is there, one file a task, so a run
    that fails loses none (see answers()).
    """
    ship(df.sparkSession)
    kept = [c for c in keep if c in df.columns]
    sent = df.select(F.col(ordinal).cast("long").alias("index"), request_messages(F.col("messages"), F.col("images"), F.col("videos")).alias("r"), message_last(F.col("messages"), "assistant").alias("reference"), *kept)
    asked = sent.select("index", F.col("r.system").alias("system"), F.to_json("r.user").alias("user"), "reference", *kept)
    kinds = dict(df.dtypes)
    schema = ANSWER + "".join(f", {c} {kinds[c]}" for c in kept)

    def ask(system: str | None, user: str) -> dict:
        parts = json.loads(user)
        for attempt in range(1, retries + 1):
            try:
                return client(system, parts if media_folder is None else with_media(parts, media_folder))
            except FileNotFoundError:
                raise
            except Exception:
                if attempt == retries:
                    raise
                time.sleep(wait * attempt)
        raise ValueError("retries has to be at least 1")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ExitStack() as stack:
            book = None
            for pdf in batches:
                answers = []
                for i, (system, user) in enumerate(zip(pdf["system"], pdf["user"], strict=True)):
                    got = ask(system, user)
                    answers.append(got)
                    if log:
                        if book is None:
                            os.makedirs(log, exist_ok=True)
                            book = stack.enter_context(open(os.path.join(log, f"part-{uuid.uuid4().hex}.json"), "a", encoding="utf-8"))
                        row = {"index": int(pdf["index"].iloc[i]), "response": got["response"], "reference": pdf["reference"].iloc[i], "model": model, "usage": got.get("usage")}
                        book.write(json.dumps(row | {c: pdf[c].iloc[i] for c in kept}, ensure_ascii=False, default=str) + "\n")
                        book.flush()
                    if interval:
                        time.sleep(interval)
                out = pdf[["index", "reference", *kept]].assign(response=[a["response"] for a in answers], model=model)
                out["usage"] = pd.Series([a.get("usage") for a in answers], dtype=object, index=pdf.index)
                yield out[["index", "response", "reference", "model", "usage", *kept]]

    return asked.mapInPandas(run, schema)


def answers(spark: SparkSession, log: str) -> DataFrame | None:
    """The answers that runs have logged, one for each row; None if there are none. A line that a lost task left half written is left out."""
    if not os.path.isdir(log) or not any(x.endswith(".json") for x in os.listdir(log)):
        return None
    read = spark.read.schema(f"{ANSWER}, dataset string, source string, eval_meta string").option("mode", "DROPMALFORMED").option("pathGlobFilter", "*.json").json(log)
    return read.where("index is not null and response is not null").dropDuplicates(["index"])


def still_to_do(df: DataFrame, done: DataFrame, ordinal: str) -> DataFrame:
    """Rows without a prediction yet."""
    return df.join(done.select(F.col("index").alias(ordinal)).distinct(), ordinal, "left_anti")


def contiguous(done: DataFrame, total: int | None = None) -> int:
    """The number of predictions; an error unless their indexes are 0, 1, 2 ... without gap or repetition, or if there are more than rows.

    Told from aggregates alone, without ordering.
    """
    got = done.agg(F.count("index").alias("n"), F.count_distinct("index").alias("d"), F.min("index").alias("a"), F.max("index").alias("b")).first()
    if got["n"] and (got["n"] != got["d"] or got["a"] != 0 or got["b"] != got["n"] - 1):
        raise ValueError("predictions aren't a contiguous start of the rows")
    if total is not None and got["n"] > total:
        raise ValueError("there are more predictions than rows")
    return got["n"]


def head_rows(df: DataFrame, ordinal: str, n: int | None) -> DataFrame:
    return df if n is None else df.where(F.col(ordinal) < n)
