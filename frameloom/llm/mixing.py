"""Problem 9: mixing sources to target weights.

Method: each source's tokens are packed into blocks of fixed length; every output shard draws its counts of slots by source from a multinomial;
a slot of a source is mapped to a block through pseudorandom permutations of the source's block numbers, one for each repetition; slots and
blocks are joined by source and block number.

Counts by shard are drawn without replacement from the mix's totals, that is from the multinomial given its totals (a multivariate hypergeometric
draw), so that shares are exact over all shards. Any shard's counts follow from the totals by halving the range of shards, so tasks draw them by themselves.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fixed_rows, stage
from . import common as C

#: Tokens of a block, and slots of an output shard.
BLOCK, SHARD = 512, 256
#: Sources that targets may name; bounds what the driver keeps.
SOURCES = 10_000
#: Rows of a source that are numbered in one task.
BUCKET = 50_000
#: Folder of the tokenizers' files and the one that is used: token bytes and ranks. The token after the last rank ends a document.
TOKENIZERS = os.environ.get("FRAMELOOM_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k.tiktoken"
#: How that tokenizer parts a text.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEED = 9


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), len(ranks)


def width(path: str) -> int:
    """Bytes of a token in packed ids."""
    with open(path, "rb") as f:
        return 2 if sum(1 for line in f if line.strip()) < 1 << 16 else 4


def packed_ids(name: str, size: int):
    """A mapInPandas function: (doc_id, source, text) to (doc_id, source, tokens, ids); ids are packed, of size bytes each, lowest first.

    The tokenizer's file is one that the session has sent to the workers (addFile).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, end = _tokenizer(SparkFiles.get(name))
        kind = np.dtype(f"<u{size}")
        for pdf in batches:
            ids = [np.array([*made.encode_ordinary(text), end], kind) for text in pdf["text"]]
            yield pdf[["doc_id", "source"]].assign(tokens=np.fromiter((len(x) for x in ids), np.int64, len(ids)), ids=pd.Series([x.tobytes() for x in ids], dtype=object, index=pdf.index))

    return run


def blocks(documents: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """(source, block, tokens, ids, spans: (doc_id, start, length)) and (source, docs, tokens, blocks).

    A source's documents follow one another in hash order; a block holds BLOCK of their tokens, so a document may span blocks; the rest at
    a source's end makes a shorter block. Offsets come from sums over buckets of the hash, so that no source is ordered in one task.
    """
    size = width(path)
    documents.sparkSession.sparkContext.addFile(path)
    docs = documents.select(F.col("doc_id").alias("doc_id"), C.canon_name(F.col("source")).alias("source"), F.col("text").alias("text")).where("source is not null and text is not null and text != ''")
    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.mapInPandas(packed_ids(os.path.basename(path), size), f"doc_id {kind}, source string, tokens long, ids binary")
    # numbered once and written, so the number stays the same; documents that recur are told apart by it
    counted = stage(counted.withColumn("h", F.xxhash64(F.lit(SEED), "doc_id")).withColumn("tie", F.xxhash64("ids")).withColumn("row", F.monotonically_increasing_id()))
    light = counted.select("row", "doc_id", "source", "tokens", "h", "tie")
    totals = light.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("tokens"))
    # each bucket of a source holds few rows: their number follows the source's size
    per = totals.select("source", F.greatest(F.lit(1), F.ceil(F.col("docs") / BUCKET)).cast("long").alias("buckets"))
    placed = light.join(F.broadcast(per), "source").withColumn("bucket", F.floor((F.col("h").cast("double") / float(1 << 64) + 0.5) * F.col("buckets")).cast("long"))  # totals: as many rows as sources, see mix()
    sums = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
    before = sums.withColumn("base", F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("source", "bucket", F.coalesce("base", F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "tie", "row").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).join(before, ["source", "bucket"]).select("row", (F.col("base") + F.col("inner")).alias("at"))
    met = counted.select("row", "doc_id", "source", "tokens", "ids").join(starts, "row")
    first, last = F.floor(F.col("at") / BLOCK), F.floor((F.col("at") + F.col("tokens") - 1) / BLOCK)
    cut = met.withColumn("block", F.explode(F.sequence(first, last)))
    low, high = F.greatest("at", F.col("block") * BLOCK), F.least(F.col("at") + F.col("tokens"), (F.col("block") + 1) * BLOCK)
    start, length = (low - F.col("at")).cast("int"), (high - low).cast("int")
    span = F.struct((low - F.col("block") * BLOCK).alias("place"), "doc_id", start.alias("start"), length.alias("length"), F.substring(F.col("ids"), start * size + 1, length * size).alias("ids"))
    made = cut.select("source", "block", span.alias("span")).groupBy("source", "block").agg(F.array_sort(F.collect_list("span"), lambda x, y: (x["place"] - y["place"]).cast("int")).alias("s"), F.sum("span.length").alias("tokens"))  # at most BLOCK spans
    whole = F.aggregate("s", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return made.select("source", "block", "tokens", whole.alias("ids"), F.transform("s", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length"))).alias("spans")), totals.withColumn("blocks", F.ceil(F.col("tokens") / BLOCK))


def budget(goals: list[tuple[str, float, int]], there: dict[str, int]) -> dict[str, int]:
    """Slots of each source: the largest mix that follows the shares as far as the caps on repetition allow.

    goals: (source, share, most repetitions); there: blocks by source. The whole mix has as many slots as all sources have blocks; a source whose
    cap is below its share gives what it may, and the others share what is left in proportion.
    """
    size = sum(there.get(s, 0) for s, _, _ in goals)
    cap = {s: max(0, most) * there.get(s, 0) for s, _, most in goals}
    share = {s: max(0.0, x) for s, x, _ in goals}
    slots: dict[str, int] = {}
    while True:
        free = [s for s in share if s not in slots]
        rest, whole = size - sum(slots.values()), sum(share[s] for s in free)
        full = [s for s in free if whole > 0 and rest * share[s] / whole > cap[s]]
        if not full:
            return slots | {s: min(cap[s], int(round(rest * share[s] / whole))) if whole > 0 else 0 for s in free}
        slots |= {s: cap[s] for s in full}


def mix(spark: SparkSession, documents: DataFrame, targets: DataFrame, path: str | None = None) -> tuple[DataFrame, dict[str, int], list, dict[str, int]]:
    """Blocks, their number by source, goals (source, share, most repetitions, name as given), and slots by source."""
    goals_rows = fixed_rows(targets.select(C.canon_name(F.col("source")).alias("s"), F.col("source").alias("name"), F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)), F.coalesce(F.col("max_repeats").cast("int"), F.lit(1))).where("s is not null"), SOURCES)
    goals = [(r[0], r[2], r[3]) for r in goals_rows]
    wanted = documents.where(C.canon_name(F.col("source")).isin([g[0] for g in goals]))
    made, totals = blocks(wanted, path or f"{TOKENIZERS}/{TOKENIZER}")
    there = {r["source"]: int(r["blocks"]) for r in totals.collect()}  # at most SOURCES rows
    slots = budget(goals, there)
    return made, there, [(*g, r[1]) for g, r in zip(goals, goals_rows, strict=True)], slots


def hypergeometric(random: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Good ones among n drawn; beyond what numpy takes, by the normal distribution that such large numbers follow."""
    if good + bad < 10**9:
        return int(random.hypergeometric(good, bad, n)) if n else 0
    total = good + bad
    spread = (n * (good / total) * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5
    return min(good, n, max(0, n - bad, round(n * (good / total) + spread * random.standard_normal())))


def shard_counts(totals: list[int], size: int, low: int, high: int, seed: int = SEED) -> Iterator[tuple[int, list[int], list[int]]]:
    """(shard, first slot of each source, slots of each source) of shards low .. high - 1; each but the last has size slots in all.

    The counts of a range of shards are divided between its halves by a draw whose seed is the range's place, so any shard's counts are the same
    wherever they are drawn.
    """

    def walk(a: int, b: int, first: list[int], counts: list[int], place: int) -> Iterator[tuple[int, list[int], list[int]]]:
        if b <= low or high <= a:
            return
        if b - a == 1:
            yield a, first, counts
            return
        middle, random = (a + b) // 2, np.random.default_rng([seed, place])
        rest, want, left = sum(counts), (middle - a) * size, []
        for n in counts:
            rest -= n
            left.append(hypergeometric(random, n, rest, want))
            want -= left[-1]
        yield from walk(a, middle, first, left, 2 * place)
        yield from walk(middle, b, [x + y for x, y in zip(first, left, strict=True)], [x - y for x, y in zip(counts, left, strict=True)], 2 * place + 1)

    shards = -(-sum(totals) // size)
    if shards:
        yield from walk(0, shards, [0] * len(totals), list(totals), 1)


@lru_cache(maxsize=100_000)
def _key(source: str, repetition: int) -> int:
    return xxhash.xxh64_intdigest(f"{SEED}:{source}:{repetition}")


def _slots(sources: list[str], slots: list[int], blocks_: list[int]):
    """A mapInPandas function: shards (id) to their slots (shard, slot, source, repetition, block)."""
    names, sizes = np.array(sources, dtype=object), np.array(blocks_, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = pdf["id"].tolist()
            if not ids:
                continue
            out = []
            # ids of a batch follow one another
            for shard, first, counts in shard_counts(slots, SHARD, min(ids), max(ids) + 1):
                n = np.array(counts, np.int64)
                source = np.repeat(np.arange(len(n)), n)
                i = np.array(first, np.int64)[source] + np.arange(len(source)) - np.repeat(np.cumsum(n) - n, n)
                repetition, x = i // sizes[source], i % sizes[source]
                keys = np.array([_key(sources[s], r) for s, r in zip(source.tolist(), repetition.tolist(), strict=True)], np.uint64)
                block = permutation(x, sizes[source], keys) if len(x) else x
                slot = np.random.default_rng([SEED, shard, 1]).permutation(len(source))
                out.append(pd.DataFrame({"shard": np.full(len(source), shard, np.int64), "slot": slot, "source": names[source], "repetition": repetition, "block": block}))
                if len(out) == 64:
                    yield pd.concat(out, ignore_index=True)
                    out = []
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def mixture(spark: SparkSession, documents: DataFrame, targets: DataFrame, path: str | None = None) -> DataFrame:
    """(shard, slot, source, repetition, block, tokens, ids, spans): the mix's blocks in order, with their tokens (packed, see packed_ids) and documents.

    Documents without source or text, and of sources without target, aren't mixed. No block is used more than its source's
    max_repeats times, so no document is. Shares of sources are met in blocks, so in tokens up to a block a source.
    """
    made, there, goals, slots = mix(spark, documents, targets, path)
    used = sorted(s for s in slots if slots[s] > 0)
    shards = -(-sum(slots.values()) // SHARD)
    each = spark.range(0, shards, 1, max(1, min(shards, 4 * spark.sparkContext.defaultParallelism)))
    mapped = each.mapInPandas(_slots(used, [slots[s] for s in used], [there[s] for s in used]), "shard long, slot int, source string, repetition long, block long")
    names = spark.createDataFrame([(s, name) for s, _, _, name in goals] or [("", "")], "source string, name string")
    return mapped.join(made, ["source", "block"]).join(F.broadcast(names), "source").select("shard", "slot", F.col("name").alias("source"), "repetition", "block", "tokens", "ids", "spans")


def _mixed(x: np.ndarray, key: np.ndarray, r: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = x + key + np.uint64(0x9E3779B97F4A7C15) * np.uint64(r + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def permutation(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places of x in pseudorandom permutations of 0 .. n - 1, chosen by key: a Feistel network whose cycles are walked until they are below n."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    y, out = x.astype(np.uint64), np.ones(len(x), bool)
    while out.any():
        left, right = y >> half, y & mask
        for r in range(4):
            left, right = right, (left ^ _mixed(right, key, r)) & mask
        y = np.where(out, (left << half) | right, y)
        out = y >= n.astype(np.uint64)
    return y.astype(np.int64)


def report(spark: SparkSession, documents: DataFrame, targets: DataFrame, path: str | None = None) -> DataFrame:
    """(source, target_share, reached_share, tokens, slots, max_repeats): shares of the mix in tokens, by target."""
    goals = targets.select("source", F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)).alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats")).where(C.canon_name(F.col("source")).isNotNull())
    rows = stage(mixture(spark, documents, targets, path).groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("slots")))  # a row a source
    whole = rows.agg(F.sum("tokens")).first()[0] or 1
    tokens = F.coalesce("tokens", F.lit(0))
    return goals.join(rows, "source", "left").select("source", "target_share", (tokens / whole).alias("reached_share"), tokens.alias("tokens"), F.coalesce("slots", F.lit(0)).alias("slots"), "max_repeats")
