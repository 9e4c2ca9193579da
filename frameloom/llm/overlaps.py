"""Problem 4: the same or nearly the same texts in training and evaluation splits.

Method: texts are made canonical (case, punctuation, white space), hashed, and evaluation hashes are joined with training hashes. A hash of
a whole text finds equal ones only, so nearly equal texts are found by more hashes of the same kind: a text within e word edits of
another keeps at least one of any e + 1 of its disjoint word grams, hence each training text gives one more disjoint grams than edits are allowed,
chosen so that few evaluation texts have them, and each evaluation text all its grams. Pairs that share a hash pass bounds on length, position and a sketch of their words before their word edit distance is computed exactly. No link is lost.

The result is links between classes of equal texts, with the rows of each class beside them; pairs of rows are made from those at the very end. Grams,
identifiers and classes that very many rows share are spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common as C

#: Of 100 words of the longer text, so many may be inserted, removed or replaced; shorter texts than LEAST words don't count.
EDITS, LEAST = 15, 12
#: Words a gram; where a text is too short for enough of them, it gives grams of SHORT words as well.
GRAM, SHORT = 5, 4
#: Size of the table of gram counts, from which the rarest grams are chosen (a fixed bound: 4 MB). It never drops a gram.
TABLE = 1 << 20
#: Texts of at most so many words have their rarest disjoint grams chosen optimally, longer ones the rarest of each of equal parts, as the optimal
#: choice takes time by the square of the words. Either choice finds all links.
OPTIMAL = 256
#: A gram's place and its text's words are one number: words * 2^PLACE + place.
PLACE = 31
#: Bytes that choosing grams takes at once.
MEMORY = 64 << 20


def allowed(n: int) -> int:
    return n * EDITS // 100


def most(n: int) -> int:
    """The most edits that a text of n words and one of any length may differ by."""
    return allowed(n * 100 // (100 - EDITS))


def pieces(n: int) -> list[tuple[int, int]]:
    """(words a gram, grams) that a training text of n words has to give."""
    need, fit = most(n) + 1, n // GRAM
    return [(GRAM, min(need, fit))] + ([(SHORT, min(need, n // SHORT))] if fit < need else [])


def short_partners(n: int) -> list[int]:
    """Lengths of evaluation texts that need SHORT grams to meet a training text of n words: GRAM words don't fit once more than edits are allowed."""
    return [m for m in range(max(LEAST, n - most(n)), n + most(n) + 1) if abs(m - n) <= allowed(max(m, n)) and n // GRAM < allowed(max(m, n)) + 1]


#: All such lengths. Beyond 120 words GRAM words always fit often enough.
SHORT_LENGTHS = sorted({m for n in range(LEAST, 140) for m in short_partners(n)})


def grams(hashes: Column, size: int) -> Column:
    """Hashes of all grams of so many words, by position, from the hashes of the words."""
    made = F.transform(F.sequence(F.lit(0), F.size(hashes) - size), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]))
    return F.when(F.size(hashes) >= size, made).otherwise(F.array().cast("array<long>"))


def sketch(hashes: Column, shift: int) -> Column:
    """64 bits, one set for each word."""
    bit = lambda x: F.pmod(F.shiftright(x, shift), F.lit(64)).cast("int")
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit(x))))


def texts(built: DataFrame, templates: DataFrame) -> DataFrame:
    """(key, side, class, text): each text of a sample in train (side false) or in val or test (true), canonical.

    A sample without split or text of enough words gives none; a template belongs to the samples with exactly its sample_id.
    """
    part = C.canon_split(F.col("split"))
    of = built.select(F.col("sample_key").alias("key"), part.isin("val", "test").alias("side"), part.alias("part"), F.col("sample_id").alias("id"), F.col("row_json").alias("json")).where(F.col("part").isin("train", "val", "test"))
    said = C.parsed(of.select("key", "side", "json"), "json", "row", C.MESSAGES).select("key", "side", C.assistant_text(F.col("row")).alias("raw"))
    # each text of an identifier once; an identifier may have a third of all rows
    other = templates.select(F.col("sample_id").alias("id"), F.col("source_text").alias("raw")).where(F.col("id").isNotNull() & F.col("raw").isNotNull()).distinct()
    named = C.spread_join(of.select("key", "side", "id"), other, "id", C.hot_keys(of, "id").unionByName(C.hot_keys(other, "id"))).select("key", "side", "raw")
    w = C.words(F.col("raw"))
    made = said.unionByName(named).where(F.col("raw").isNotNull()).select("key", "side", w.alias("w")).where(F.size("w") >= LEAST).select("key", "side", F.array_join("w", " ").alias("text"))
    return made.withColumn("class", C.digest(F.col("text")))


def _rarest(matrix: np.ndarray, size: int, k: int) -> np.ndarray:
    """For each row of counts the positions of k disjoint grams with the least sum of counts."""
    rows, n = matrix.shape
    best = np.full((k + 1, n + size, rows), np.inf)
    best[0] = 0
    took = np.zeros((k + 1, n + size, rows), bool)
    for j in range(1, k + 1):
        for i in range(n):
            # best[j][i + size]: j grams in the words before i + size
            take, skip = best[j - 1][i] + matrix[:, i], best[j][i + size - 1]
            took[j][i + size] = take < skip
            best[j][i + size] = np.minimum(take, skip)
    out, at, j = np.zeros((rows, k), np.int64), np.full(rows, n + size - 1), np.full(rows, k)
    each = np.arange(rows)
    for _ in range(n + size):
        live = j > 0
        if not live.any():
            break
        hit = live & took[j, at, each]
        out[each[hit], j[hit] - 1] = at[hit] - size
        at, j = np.where(hit, at - size, np.where(live, at - 1, at)), np.where(hit, j - 1, j)
    return out


def choose(counts: np.ndarray, optimal: int = OPTIMAL, memory: int = MEMORY):
    """A function for mapInPandas: (class, n, g, h, a) to the rows of the gram index, rarest disjoint grams first."""

    def picked(weight: np.ndarray, n: int, size: int, k: int) -> np.ndarray:
        if n > optimal:
            edges = np.linspace(0, n, k + 1).astype(int)
            return np.stack([lo + weight[:, lo : hi - size + 1].argmin(axis=1) for lo, hi in zip(edges[:-1], edges[1:], strict=True)], axis=1)
        step = max(1, memory // (9 * (k + 1) * (n + size)))
        return np.concatenate([_rarest(weight[i : i + step], size, k) for i in range(0, len(weight), step)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for n, part in pdf.groupby("n", sort=False):
                for size, k in pieces(int(n)):
                    hashes = np.stack([np.asarray(x, np.int64) for x in part["g" if size == GRAM else "h"]])
                    at = picked(counts[hashes & (TABLE - 1)].astype(float) + 1, int(n), size, k)
                    rows = np.arange(len(part)).repeat(k)
                    out.append(pd.DataFrame({"train": part["class"].to_numpy()[rows], "tplace": (np.int64(n) << PLACE) + at.ravel(), "gram": np.take_along_axis(hashes, at, axis=1).ravel(), "ta": part["a"].to_numpy()[rows]}))
            if out:
                yield pd.concat(out, ignore_index=True)

    return run


def edits_within(a: list[str], b: list[str], limit: int) -> bool:
    """Whether so many insertions, removals and replacements of words turn a into b.

    Bit-parallel: a column of the distances lies in two whole numbers of as many bits as a has words (Hyyrö, 2003).
    """
    if abs(len(a) - len(b)) > limit:
        return False
    if a == b:
        return True
    if not a or not b:
        return len(a) + len(b) <= limit
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    top, full = 1 << (len(a) - 1), (1 << len(a)) - 1
    up, down, distance, rest = full, 0, len(a), len(b)
    for w in b:
        equal = where.get(w, 0)
        vertical = equal | down
        level = (((equal & up) + up) ^ up) | equal
        more, less = down | (full & ~(level | up)), up & level
        if more & top:
            distance += 1
        elif less & top:
            distance -= 1
        more, less = more << 1 | 1, less << 1
        up, down = (less | ~(vertical | more)) & full, more & vertical & full
        rest -= 1
        if distance - rest > limit:
            return False
    return distance <= limit


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keep = []
        for left, right in zip(pdf["l"], pdf["r"], strict=True):
            a, b = left.split(" "), right.split(" ")
            keep.append(edits_within(a, b, allowed(max(len(a), len(b)))))
        yield pdf.loc[keep, ["train", "other"]]


def linked(classes: DataFrame) -> DataFrame:
    """(train, other): classes of equal texts, one with training rows and the other with evaluation rows, whose texts are alike.

    classes: class, text, train, other (whether it has such rows).
    """
    base = classes.select("class", "train", "other", F.transform(F.split("text", " "), lambda w: F.xxhash64(w)).alias("w")).withColumn("n", F.size("w"))
    w, none = F.col("w"), F.array().cast("array<long>")
    mark = sketch(w, 0)
    placed = lambda g: F.transform(g, lambda x, i: F.struct((F.shiftleft(F.col("n").cast("long"), PLACE) + i).alias("place"), x.alias("gram")))
    # inline_outer, as every text has grams: for inline Spark would compute them once more to filter empty ones
    # grams of SHORT words are told apart from the others by their hash alone: an equal hash by chance only adds a pair to check
    seen = base.where("other")
    both = F.concat(placed(grams(w, GRAM)), placed(F.when(F.col("n").isin(SHORT_LENGTHS), grams(w, SHORT)).otherwise(none)))
    every = seen.select(F.col("class").alias("other"), mark.alias("ea"), both.alias("g")).select("other", "ea", F.inline_outer("g")).withColumnRenamed("place", "eplace")
    slot = F.col("gram").bitwiseAND(F.lit(TABLE - 1).cast("long")).cast("int")
    table = np.zeros(TABLE, np.int64)
    for r in seen.select(F.inline_outer(both)).groupBy(slot.alias("k")).agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        table[r["k"]] = r["n"]
    short = F.when((F.col("n") < 140) & ~F.col("n").isin([n for n in range(140) if len(pieces(n)) == 1]), grams(w, SHORT)).otherwise(none)
    index = stage(base.where("train").select("class", "n", grams(w, GRAM).alias("g"), short.alias("h"), mark.alias("a")).mapInPandas(choose(table), "train binary, tplace long, gram long, ta long"))
    # a gram is hot if very many evaluation texts have it, which the table tells but for equal places, or very many training texts chose it
    many = int(min(max(C.HOT_ROWS, C.HOT_SHARE * table.sum()), C.HOT_MOST))
    hot = C.hot_keys(index, "gram").select("gram")
    if len(heavy := np.flatnonzero(table >= many)):
        hot = hot.unionByName(seen.select(F.inline_outer(both)).where(slot.isin(heavy.tolist())).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= many).select("gram"))
    hot = stage(hot.distinct())
    # rows of a hot gram are spread over cells, which stand for it in its place; that an equal number may come about by chance only adds a pair to check
    few = F.broadcast(hot.withColumn("hot", F.lit(True)))

    def spread(df: DataFrame, own: str, mine: bool) -> DataFrame:
        cell = F.pmod(F.xxhash64(own), F.lit(C.CELLS))
        key = lambda i: F.xxhash64("gram", *((cell, i) if mine else (i, cell)))
        keys = F.when(F.col("hot"), F.transform(F.sequence(F.lit(0).cast("long"), F.lit(C.CELLS - 1).cast("long")), key)).otherwise(F.array("gram"))
        return df.join(few, "gram", "left").withColumn("key", F.explode(keys)).drop("gram", "hot")

    if hot.isEmpty():
        met = index.join(every, "gram")
    else:
        met = spread(index, "train", True).join(spread(every, "other", False), "key")
    words = lambda c: F.shiftright(c, PLACE)
    place = lambda c: F.col(c).bitwiseAND(F.lit((1 << PLACE) - 1))
    limit = F.floor(F.greatest(words("tplace"), words("eplace")) * EDITS / 100)
    near = (F.abs(words("tplace") - words("eplace")) <= limit) & (F.abs(place("tplace") - place("eplace")) <= limit) & (F.bit_count(F.col("ta").bitwiseXOR(F.col("ea"))) <= 2 * limit) & (F.col("train") != F.col("other"))
    found = stage(met.where(near).select("train", "other").distinct())
    # a class may be near very many others
    left = classes.where("train").select(F.col("class").alias("train"), F.col("text").alias("l"))
    right = classes.where("other").select(F.col("class").alias("other"), F.col("text").alias("r"))
    both_texts = C.lookup(C.lookup(found, left, "train", C.hot_keys(found, "train")), right, "other", C.hot_keys(found, "other"))
    checked = both_texts.select("train", "other", "l", "r").mapInPandas(_verify, "train binary, other binary")
    same = classes.where(F.col("train") & F.col("other")).select(F.col("class").alias("train"), F.col("class").alias("other"))
    return checked.unionByName(same)


def prepare(built: DataFrame, templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, side, class): each sample's texts, and the linked classes (train, other); both written."""
    said = stage(texts(built, templates))
    flags = [F.first("text").alias("text"), F.max(~F.col("side")).alias("train"), F.max("side").alias("other")]
    links = stage(linked(stage(said.groupBy("class").agg(*flags))))
    return said.select("key", "side", "class").distinct(), links


def class_links(built: DataFrame, templates: DataFrame) -> DataFrame:
    """(train_class, other_class, train_rows, other_rows): linked classes of equal texts, each named by its least sample_key on that side, with its rows there."""
    members, links = prepare(built, templates)
    about = stage(members.groupBy("class", "side").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("rows")))
    mine = about.where(~F.col("side")).select(F.col("class").alias("train"), F.col("first").alias("train_class"), F.col("rows").alias("train_rows"))
    theirs = about.where("side").select(F.col("class").alias("other"), F.col("first").alias("other_class"), F.col("rows").alias("other_rows"))
    met = C.lookup(C.lookup(links, mine, "train", C.hot_keys(links, "train")), theirs, "other", C.hot_keys(links, "other"))
    return met.select("train_class", "other_class", "train_rows", "other_rows")


def pairs(built: DataFrame, templates: DataFrame) -> DataFrame:
    """(left_key, right_key): each pair of samples, one in train and the other in val or test, with a text in common; smaller key first.

    Rows without split, text or enough words give none; a sample has no pair with itself. Of n equal training texts and m equal
    evaluation texts all n times m pairs come out, as the result is defined so; they are expanded from the links of classes at the very end.
    """
    members, links = prepare(built, templates)
    mine = members.where(~F.col("side")).select(F.col("class").alias("train"), F.col("key").alias("k"))
    theirs = members.where("side").select(F.col("class").alias("other"), F.col("key").alias("v"))
    half = C.spread_join(links, mine, "train", C.hot_keys(mine, "train").unionByName(C.hot_keys(links, "train")))
    both = C.spread_join(half, theirs, "other", C.hot_keys(theirs, "other").unionByName(C.hot_keys(links, "other")))
    made = both.select(F.least("k", "v").alias("left_key"), F.greatest("k", "v").alias("right_key"))
    return made.where("left_key != right_key").distinct()


def report(built: DataFrame, templates: DataFrame) -> DataFrame:
    """(split, dataset, samples, overlapping): of each evaluation split and dataset its samples, and those with a text in training.

    Spellings of split and dataset are canonical; samples without dataset are counted under an empty name.
    """
    members, links = prepare(built, templates)
    seen = members.where("side").select("key", F.col("class").alias("other"))
    hit = C.lookup(seen, links.select("other").distinct(), "other", C.hot_keys(seen, "other")).select("key").distinct().withColumn("hit", F.lit(1))
    part = C.canon_split(F.col("split"))
    rows = built.select(F.col("sample_key").alias("key"), part.alias("split"), F.coalesce(C.canon_name(F.col("dataset")), F.lit("")).alias("dataset")).where(F.col("split").isin("val", "test"))
    return rows.join(hit, "key", "left").groupBy("split", "dataset").agg(F.count(F.lit(1)).alias("samples"), F.count("hit").alias("overlapping"))
