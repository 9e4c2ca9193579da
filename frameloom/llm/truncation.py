"""Problem 1: text cut off by field limits or during transfer.

Method: discrete hazards of the length (in characters, UTF-8 bytes and words) are computed by window functions over each source's histogram
and tested against the hazards of neighbouring lengths with control of the false-discovery rate; texts of a significant length are flagged
if their ending is incomplete. Texts cut during transfer have no length in common, so no hazard shows them; for these the same model of the
ending decides, with the source's share of unmistakable cuts as prior in place of the hazard's excess.

The ending model is fitted to texts that are known to be whole: how often each word (after the one before it) ends a sentence, and how often each
form of ending (hanging sign, broken word, sentence without stop ...) stands at the end of all whole texts and of the same texts cut at random.
"""

from __future__ import annotations

import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, stage
from . import common as C

#: Neighbours on each side with which a length's hazard is compared.
REACH, CLOSE = 8, 1
#: A hazard of all other sources below this is the language's own.
SHARED = 0.5
#: False-discovery rate, and the least ratio of a significant hazard to that of its neighbours.
FDR, LIFT = 0.001, 2.5
#: Odds from which an ending counts as incomplete, and those of one that is unmistakable whatever the source.
ODDS, SURE = 1.0, 100.0
#: A word pair seen less often says nothing; its last word is looked at alone.
PAIRS = 30
#: Letters and digits from which a text that its prompt holds repeats it; fewer may stand in both by chance.
REPEATED = 16
#: Rows of token counts that a task keeps before it passes them on.
HELD = 100_000
#: Bits of a string's number in a Chain, which has at most 3 for each of 2 * HELD + 2 tokens.
WIDE = 20
#: How the last token of a text counts in a Chain: as any other, as an end, as an end of no known word, not at all; a stop makes it an end.
GOES_ON, WHOLE, ALONE, OPEN = range(4)
#: Answers that stand for no answer.
FILLERS = ("", "-", "--", "...", "…", '""', "''", "[]", "{}", "()", "null", "none", "nil", "nan", "n/a", "na", "n.a.", "<empty>", "<none>", "<null>", "(no answer)", "(empty)", "(none)", "no answer", "empty", "undefined", "tbd", "?")
#: Signs with which a text ends as intended.
CLOSED = frozenset(".!?。！？…»”\"'’)]}>")
_ENDS = re.compile(r"[.!?。][)\"'’”\]}]*\Z")
_NUMBER = re.compile(r"\W*\d+\W*\Z")
_HANGING = frozenset(",;:([{-–—")
_HELD = re.compile(r'\{\s*"[^"]*"\s*:\s*"')
#: Letters of scripts without spaces between words: Thai to Lao, Chinese and Japanese.
_DENSE = re.compile("[\u0e00-\u0eff\u2e80-\u9fff]")
_FILLERS = frozenset(FILLERS)
_LONGEST = max(map(len, FILLERS))
#: Forms of endings (see form) of which the last words tell more; those of all others aren't looked at.
LOOSE = ("plain", "sentence")


def bare(c: Column) -> Column:
    """Text without white space and invisible signs around it."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^[\p{Z}\s\p{C}]+|[\p{Z}\s\p{C}]+$", "")


def is_filler(c: Column) -> Column:
    """Null, blank or only a filler for no answer."""
    return F.lower(bare(c)).isin(*FILLERS)


def bare_text(text: str) -> str:
    """bare() of a Python text."""
    text = text.strip()
    while text and not text[0].isprintable() and unicodedata.category(text[0])[0] in "ZC":
        text = text[1:].lstrip()
    while text and not text[-1].isprintable() and unicodedata.category(text[-1])[0] in "ZC":
        text = text[:-1].rstrip()
    return text


def inner(text: str) -> str:
    """The text inside a JSON object with one string, or the text itself."""
    if text[:1] != "{" or not (m := _HELD.match(text)):
        return text
    held = text[m.end() :]
    if held.endswith("}") and (said := held[:-1].rstrip()).endswith('"'):
        return said[:-1] or text
    return held.removesuffix('"') or text


def _fills(text: str) -> bool:
    """Whether a text without white space around it is a filler."""
    return len(text) <= _LONGEST and text.lower() in _FILLERS


def stem(token: str) -> str:
    """A token in lower case without signs around it."""
    token = token.lower()
    if token.isalnum():
        return token
    a, b = 0, len(token)
    while a < b and not token[a].isalnum():
        a += 1
    while a < b and not token[b - 1].isalnum():
        b -= 1
    return token[a:b]


def _letters(text: str) -> str:
    return "".join(filter(str.isalnum, text.lower()))


_prompt_letters = lru_cache(maxsize=4096)(_letters)


class Tokens(dict):
    """Of each token met: its stem, what stands for it in the model at a sentence's start and inside one, and whether it ends a sentence.

    Names inside a sentence are alike in the model, and so are numbers. The table starts anew when it is large.
    """

    def __missing__(self, token: str) -> tuple[str, str, str, bool]:
        if len(self) > HELD:
            self.clear()
        word = stem(token)
        first = "<number>" if _NUMBER.match(token) else word
        i = next((i for i, x in enumerate(token) if x.isalnum()), len(token))
        name = token[i : i + 1].isupper() and token[i + 1 : i + 2].islower()
        self[token] = made = (word, first, "<name>" if name else first, bool(_ENDS.search(token)))
        return made


class Chain(dict):
    """Counts of tokens by the kind of the one before. Of each token met: its number; tokens are counted by arrays of those, some at once."""

    def __init__(self):
        super().__init__()
        self.info, self.strings, self.made = Tokens(), {"": 0}, array("q")
        self.begin()

    def begin(self) -> None:
        #: Tokens not counted yet, and of their pieces of text: the place after the last, how many of the first were counted before, how the last counts.
        self.tokens, self.ends, self.skips, self.modes = array("q"), [], [], []
        self.keys, self.times = np.zeros(0, "int64"), np.zeros(0, "int64")

    def __missing__(self, token: str) -> int:
        word, first, inside, end = self.info[token]
        self.made.extend([*(self.strings.setdefault(x, len(self.strings)) for x in (word, first, inside)), end])
        self[token] = n = len(self)
        return n

    def add(self, parts: list[str], skip: int, mode: int) -> None:
        """A text, or a piece of one that begins with skip tokens counted before; its last token is one of GOES_ON, WHOLE, ALONE, OPEN."""
        self.tokens.extend(map(self.__getitem__, parts))
        self.ends.append(len(self.tokens))
        self.skips.append(skip)
        self.modes.append(mode)
        if len(self.tokens) > HELD:
            self.count()

    def full(self) -> bool:
        return len(self) > HELD or len(self.keys) > 2 * HELD

    def count(self) -> None:
        if not self.ends:
            return
        word, first, inside, stop = np.array(self.made, "int64").reshape(-1, 4)[np.array(self.tokens, "int64")].T
        last = np.array(self.ends) - 1
        start = np.ones(len(word), bool)
        start[1:] = stop[:-1] > 0
        start[last[:-1] + 1] = True
        kind = np.where(start, first, inside)
        before = np.zeros(len(word), "int64")
        before[1:] = kind[:-1]
        before[last[:-1] + 1] = 0
        final, kept, mode, skip = stop > 0, np.ones(len(word), bool), np.array(self.modes), np.array(self.skips)
        first_of = np.concatenate([[0], last[:-1] + 1])
        kept[first_of[skip > 0]] = False
        kept[first_of[skip > 1] + 1] = False
        # of a text that may go on, only the place of its end counts, or nothing
        unsure = ~final[last]
        word = word.copy()
        word[last[unsure & (mode == ALONE)]] = 0
        kept[last[unsure & (mode == OPEN)]] = False
        final[last[mode != GOES_ON]] = True
        keys, times = np.unique(((before << WIDE | kind) << WIDE | word)[kept] << 1 | final[kept], return_counts=True)
        self.tokens, self.ends, self.skips, self.modes = array("q"), [], [], []
        self.keys, places = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        self.times = np.bincount(places, np.concatenate([self.times, times])).astype("int64")

    def taken(self) -> pd.DataFrame:
        """(before, kind, word, total, final) of all tokens so far; the counts start anew."""
        self.count()
        names = np.array(list(self.strings), object)
        part = lambda i: names[self.keys >> (1 + WIDE * i) & ((1 << WIDE) - 1)]
        made = pd.DataFrame({"before": part(2), "kind": part(1), "word": part(0), "total": self.times, "final": np.where(self.keys & 1, self.times, 0)})
        if len(self) > HELD:
            self.clear()
            self.strings, self.made = {"": 0}, array("q")
        self.begin()
        return made


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(text, whole, alone, at) to (role, form, before, kind, word, total, final): counts of a task's tokens (role null), whole texts' last tokens
    being ends; and of the endings of texts with an at, as they are (role whole) and cut after so many characters (role cut).

    Whether the last token of another text is an end isn't known, so only a stop makes it one; without whole texts (alone) it counts as one all the
    same, as few texts are cut, but doesn't make its word known.
    """
    chain, ends = Chain(), {}
    names = ["role", "form", "before", "kind", "word", "total", "final"]

    def rows() -> Iterator[pd.DataFrame]:
        yield chain.taken().assign(role=None, form=None)[names]
        yield pd.DataFrame([(*k, n, 0) for k, n in ends.items()], columns=names)
        ends.clear()

    def ended(role: str, text: str, parts: list[str]) -> None:
        how = form(text, parts, chain.info)
        key = (role, how, *(_ending(parts, chain.info) if how in LOOSE else ("", "", "")))
        ends[key] = ends.get(key, 0) + 1

    for pdf in batches:
        for raw, whole, alone, at in zip(pdf["text"], pdf["whole"].tolist(), pdf["alone"].tolist(), pdf["at"].tolist(), strict=True):
            text = bare_text(raw)
            if not _fills(text):
                parts = inner(text).split()
                # very long texts in pieces, each with the two tokens before it, which tell its first one's kind
                for i in range(0, len(parts), HELD):
                    chain.add(parts[max(0, i - 2) : i + HELD], min(i, 2), GOES_ON if i + HELD < len(parts) else WHOLE if whole else ALONE if alone else OPEN)
                    if chain.full():
                        yield from rows()
                if at:
                    ended("whole", text, parts)
            if at and not _fills(text := bare_text(raw[:at])):
                ended("cut", text, inner(text).split())
            if len(ends) > HELD:
                yield from rows()
    yield from rows()


def context_model(texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, float, DataFrame]:
    """From all texts (text, whole: known to be complete, alone: there are no such, at: where to cut those to which the forms of endings are fitted, else
    0): counts by (before, kind), by kind, and the words known, with the share of final tokens, and counts n of the endings (role, form, word, kind, before)."""
    made = [F.sum("total").alias("total"), F.sum("final").alias("final")]
    counted = texts.where("text is not null").mapInPandas(_counts, "role string, form string, before string, kind string, word string, total long, final long")
    both = stage(counted.groupBy("role", "form", "before", "kind", "word").agg(*made))
    seen = both.where("role is null")
    pair = seen.groupBy("before", "kind").agg(*made).where(F.col("total") >= PAIRS)
    alone = seen.groupBy("kind").agg(*made)
    known = seen.where("word != ''").select("word").distinct()
    whole = seen.agg(F.sum("final"), F.sum("total")).first()
    ends = both.where("role is not null").select("role", "form", "word", "kind", "before", F.col("total").alias("n"))
    return pair, alone, known, (whole[0] or 0) / (whole[1] or 1) or 0.05, ends


def _dense(text: str) -> bool:
    """Whether most letters are of a script that writes no spaces between words."""
    if text.isascii():
        return False
    n = len(_DENSE.findall(text)) if _DENSE.search(text) else 0
    return n > 0 and 2 * n >= sum(map(str.isalpha, text))


def form(text: str, parts: list[str], info: Tokens) -> str:
    """How a text ends: closed (closed-dense where there are no spaces between words), open (an object or list in JSON without end), hanging (a sign or bracket that more has to follow), sentence (in a
    text written in sentences, which has no stop at its end), dense (no spaces between words), plain."""
    end = parts[-1] if parts else ""
    if text[0] in "[{" and text[-1] not in "]}":
        return "open"
    if text[-1] in CLOSED or (text[0] == "{" and end[-1:] in CLOSED):
        return "closed-dense" if _dense(text) else "closed"
    if end[-1:] in _HANGING or text.count("(") > text.count(")"):
        return "hanging"
    if _dense(text):
        return "dense"
    # a stop before a capital letter: the text is written in sentences, so its last one has a stop too
    if len(parts) > 3 and any(x in text for x in ".!?。") and any(len(x) > 3 and info[x][3] and next((c for c in y if c.isalnum()), "").isupper() for x, y in zip(parts, parts[1:], strict=False)):
        return "sentence"
    return "plain"


def _ending(parts: list[str], info: Tokens) -> tuple[str, str, str]:
    """The kind of a text's last word but one, that of the last one, and the last word."""
    n = len(parts)
    if not n:
        return "", "", ""
    word, first, inside, _ = info[parts[-1]]
    if n == 1:
        return "", first, word
    _, first_before, inside_before, end = info[parts[-2]]
    return first_before if n == 2 or info[parts[-3]][3] else inside_before, first if end else inside, word


def _shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, source, raw, prompt) to the same without texts, with sizes and what tells of the ending; fillers are left out."""
    info = Tokens()
    names = ["key", "source", "characters", "bytes", "words", "word", "kind", "before", "form", "copied"]
    for pdf in batches:
        out = []
        for key, source, raw, prompt in zip(pdf["key"], pdf["source"], pdf["raw"], pdf["prompt"], strict=True):
            text = bare_text(raw)
            if _fills(text):
                continue
            parts = inner(text).split()
            how = form(text, parts, info)
            before, kind, word = _ending(parts, info) if how in LOOSE else ("", "", "")
            copied = how[:6] != "closed" and bool(prompt) and len(said := _letters(text)) >= REPEATED and said in _prompt_letters(prompt)
            out.append((key, source, len(raw), len(raw.encode()), len(raw.split()), word, kind, before, how, copied))
        yield pd.DataFrame(out, columns=names)


def _step_up(tested: DataFrame, m: int) -> float | None:
    """The largest p that Benjamini and Hochberg's rule lets pass among m tests; tested has those that can.

    Values are ranked inside classes of their logarithm, of which there are 4,097 at most, on top of the counts of smaller classes, so no task ranks all.
    """
    level = F.when(F.col("p") > 0, F.least(F.floor(-F.ln("p") * 8), F.lit(4096))).otherwise(F.lit(4096)).cast("int")
    there = stage(tested.select("p", level.alias("level")))
    counts = {r["level"]: r["n"] for r in there.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    below, so_far = [], 0
    for k in sorted(counts, reverse=True):
        below.append((k, so_far))
        so_far += counts[k]
    base = there.sparkSession.createDataFrame(below, "level int, base long")
    # those of the last class, below 1e-222, pass whatever their rank
    ranked = there.where("level < 4096").join(F.broadcast(base), "level").withColumn("r", F.col("base") + F.row_number().over(Window.partitionBy("level").orderBy("p")))
    passed = ranked.where(F.col("p") * m <= FDR * F.col("r")).select("p").unionByName(there.where("level = 4096").select("p"))
    return passed.agg(F.max("p")).first()[0]


def hazards(lengths: DataFrame) -> DataFrame:
    """(source, unit, length, n, at_risk, expected, p, significant): the hazard of each length that occurs, against its neighbours.

    expected: rows that the neighbours' hazard lets end here; p: an upper bound of the binomial tail (Chernoff's); significant: by
    Benjamini and Hochberg's rule over all sources, units and lengths, and LIFT times its neighbours at least.
    """
    counts = stage(lengths.groupBy("source", "unit", "length").agg(F.count(F.lit(1)).alias("n")))
    by = Window.partitionBy("source", "unit").orderBy("length")
    risk = counts.withColumn("at_risk", F.sum("n").over(by.rowsBetween(0, Window.unboundedFollowing)))

    def hazard(reach: int) -> Column:
        # lengths that don't occur had no row ending but all longer ones at risk
        low, high = by.rangeBetween(-reach, -1), by.rangeBetween(1, reach)
        there = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
        absent = (reach - F.count("n").over(low)) * F.col("at_risk") + (reach - F.count("n").over(high)) * (F.col("at_risk") - F.col("n"))
        return (there("n", low) + there("n", high) + 0.5) / (there("at_risk", low) + there("at_risk", high) + absent + 1.0)

    # lengths of usual phrases make broad bumps, limits make single spikes: so the wider and the closest neighbours both have to be exceeded
    # and what all sources have at a length belongs to the language, not to a channel, unless nearly all texts end there in every source
    same = Window.partitionBy("unit", "length")
    others = (F.sum("n").over(same) - F.col("n")) / (F.sum("at_risk").over(same) - F.col("at_risk") + 1.0)
    near = risk.withColumn("h0", F.least(F.greatest(hazard(REACH), hazard(CLOSE), F.when(others < SHARED, others).otherwise(0.0)), F.lit(0.999)))
    h0 = F.col("h0")
    h = F.col("n") / F.col("at_risk")
    rest = F.when(h < 1, (1 - h) * F.ln((1 - h) / (1 - h0))).otherwise(0.0)
    tested = near.withColumn("expected", h0 * F.col("at_risk")).withColumn("p", F.when(h > h0, F.exp(-F.col("at_risk") * (h * F.ln(h / h0) + rest))).otherwise(1.0))
    # only values below the rate can be significant, so only those few are ranked
    cut = _step_up(tested.where(F.col("p") <= FDR), counts.count())
    passed = F.lit(False) if cut is None else F.col("p") <= cut
    return tested.withColumn("significant", passed & (F.col("n") >= LIFT * F.col("expected"))).drop("h0")


def _rates(endings: DataFrame, pair: DataFrame, alone: DataFrame, known: DataFrame, share: float) -> DataFrame:
    """(ending, fragment, rate) of endings (ending, word, kind, before): whether the last word is broken, and how often it ends a sentence."""
    # a last word that never stands elsewhere and begins a known word is a fragment; of known words only beginnings of the strange ones' lengths are
    # needed. d distinct lengths of single words take d * d / 2 characters of text, so there are few of them
    strange = stage(endings.select("word").where(F.col("word") != "").distinct().join(known, "word", "left_anti"))
    sizes = sorted(r[0] for r in strange.select(F.length("word")).distinct().collect())
    starts = known.select(F.explode(F.transform(F.filter(F.array(*[F.lit(n) for n in sizes]).cast("array<int>"), lambda n: n < F.length("word")), lambda n: F.substring(F.col("word"), F.lit(1), n))).alias("word")).distinct()
    broken = strange.join(starts, "word", "left_semi").withColumn("fragment", F.lit(True))
    # kinds such as names have very many words and neighbours, so each table is joined by a lookup safe from hot keys
    contexts = stage(endings.select("kind", "before").distinct())
    counts = C.lookup(contexts, alone.select("kind", "total", "final"), "kind", C.hot_keys(contexts, "kind"), "left")
    counts = counts.join(pair.select("before", "kind", F.col("total").alias("pt"), F.col("final").alias("pf")), ["before", "kind"], "left")
    n, k = F.coalesce("pt", "total", F.lit(0)), F.coalesce("pf", "final", F.lit(0))  # null: the word was never seen
    rate = counts.select(F.concat_ws("\u0000", "kind", "before").alias("context"), ((k + 2 * share) / (n + 2)).alias("rate"))
    met = endings.withColumn("context", F.concat_ws("\u0000", "kind", "before")).join(broken, "word", "left")
    met = stage(met.select("ending", "context", F.coalesce("fragment", F.lit(False)).alias("fragment")))
    return C.lookup(met, rate, "context", C.hot_keys(met, "context"), "left").select("ending", "fragment", "rate")


def _likelihood(rows: DataFrame, share: float) -> Column:
    """How many times likelier an ending is in a cut text than in a whole one: of its form, as counted (n) by role, and for plain words of the last word's rate."""
    seen = {(r["role"], r["form"]): r["n"] for r in rows.groupBy("role", "form").agg(F.sum("n").alias("n")).collect()}  # a few forms
    total = {role: sum(n for (x, _), n in seen.items() if x == role) for role in ("whole", "cut")}
    part = lambda role, f: (seen.get((role, f), 0) + 0.5) / (total[role] + 1)
    ratio = {f: part("cut", f) / part("whole", f) for f in {f for _, f in seen}}
    # an object without its end isn't whole by its grammar; no whole text may be dense, so the records' own tell how often those end without a stop
    ratio["open"] = 1e6
    ratio["dense"] = (seen.get(("record", "closed-dense"), 0) + seen.get(("record", "dense"), 0) + 1.0) / (seen.get(("record", "dense"), 0) + 0.5)
    of_form = F.lit(1.0)
    for f, x in sorted(ratio.items()):
        of_form = F.when(F.col("form") == f, float(x)).otherwise(of_form)
    return F.when(F.col("form").isin(*LOOSE), of_form * share / F.col("rate")).otherwise(of_form)


def judged(df: DataFrame, key: str, source: str, text: str, complete: str | None = None, prompt: str | None = None, lexicon: DataFrame | None = None) -> DataFrame:
    """(key, source, limit, cut): each record with a text that isn't a filler, whether it was cut, and at which limit (null: none).

    source: canonical name of the channel, "" for null. complete: a column of texts that are known to be whole, to which the model of endings is
    fitted; without it, the records' own texts are taken for whole, as few are cut. prompt: texts that only repeat a part of it count as whole.
    lexicon (column text): whole texts from elsewhere, which teach more words and how they stand at ends. All whole texts are read, and each is
    compared with itself cut at one place that a hash tells.
    Nulls, blanks and fillers are left out; ties and repeated rows are judged each for itself; very long texts are read to their end.
    """
    kind = df.schema[key].dataType.simpleString()
    none = F.lit(None).cast("string")
    base = df.select(F.col(key).alias("key"), F.coalesce(C.canon_name(F.col(source)), F.lit("")).alias("source"), F.col(text).alias("raw"), (F.col(prompt) if prompt else none).alias("prompt")).where("raw is not null")
    shapes = base.mapInPandas(_shapes, f"key {kind}, source string, characters int, bytes int, words int, word string, kind string, before string, form string, copied boolean")
    shaped = stage(shapes.withColumn("ending", F.concat_ws("\u0000", "word", "kind", "before")))
    sized = shaped.select("key", "source", F.explode(F.create_map(F.lit("characters"), "characters", F.lit("bytes"), "bytes", F.lit("words"), "words")).alias("unit", "length"))
    found = stage(hazards(sized.select("source", "unit", "length")).where("significant"))
    limits = found.select("source", "unit", "length", ((F.col("n") - F.col("expected")) / F.greatest(F.col("expected"), F.lit(0.1))).alias("excess"))
    # limits are few; should they be very many, a third of all rows may still have one and the same
    spot = lambda: F.concat_ws("\u0000", "source", "unit", F.col("length").cast("string")).alias("spot")
    limits = stage(limits.select(spot(), "excess"))
    sized = sized.withColumn("spot", spot())
    near = sized.join(F.broadcast(limits), "spot") if limits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else C.lookup(sized, limits, "spot", C.hot_keys(sized, "spot"))
    reached = near.groupBy("key").agg(F.max_by(F.concat_ws(" ", F.col("length").cast("string"), F.col("unit")), "excess").alias("limit"), F.max("excess").alias("excess"))

    # whole texts count as they are and cut at a place that a hash tells
    at = lambda key, c: F.when(F.length(c) > 1, F.lit(1) + F.pmod(F.xxhash64(F.lit(18), key, c), F.length(c) - 1)).otherwise(0).cast("int").alias("at")
    corpus = df.select(F.col(text).alias("text"), F.lit(False).alias("whole"), F.lit(complete is None).alias("alone"), F.lit(0).alias("at") if complete else at(F.col(key), F.col(text)))
    if complete:
        corpus = corpus.unionByName(df.select(F.col(complete).alias("text"), F.lit(True).alias("whole"), F.lit(False).alias("alone"), at(F.col(key), F.col(complete))))
    if lexicon is not None:
        corpus = corpus.unionByName(lexicon.select("text", F.lit(True).alias("whole"), F.lit(False).alias("alone"), at(F.lit(None).cast(kind), F.col("text"))))
    pair, alone, known, share, ends = context_model(corpus)
    ends = ends.withColumn("ending", F.concat_ws("\u0000", "word", "kind", "before"))
    # loose endings are judged once each, so that a common one costs no large join, and come back to the rows by a lookup safe from hot keys
    loose = F.col("form").isin(*LOOSE)
    distinct = shaped.where(loose).select("ending", "word", "kind", "before").unionByName(ends.where(loose).select("ending", "word", "kind", "before")).distinct()
    rates = stage(_rates(stage(distinct), pair, alone, known, share))
    counted = ends.select(none.cast(kind).alias("key"), none.alias("source"), "role", "form", F.lit(False).alias("copied"), "ending", "n")
    every = shaped.select("key", "source", F.lit("record").alias("role"), "form", "copied", "ending", F.lit(1).cast("long").alias("n")).unionByName(counted)
    rated = C.lookup(every.where(loose), rates, "ending", C.hot_keys(every.where(loose), "ending"))
    rated = rated.unionByName(every.where(~loose).withColumns({"fragment": F.lit(False), "rate": F.lit(None).cast("double")}))
    rows = stage(rated.select("key", "source", "role", "copied", F.when(F.col("fragment"), "fragment").otherwise(F.col("form")).alias("form"), "rate", "n"))
    odds = _likelihood(rows, share)
    clear = F.sum(F.when(odds >= SURE, F.col("n")).otherwise(0)) / F.sum("n")
    told = {r["role"]: r["x"] or 0.0 for r in rows.where("role != 'record'").groupBy("role").agg(clear.alias("x")).collect()}
    met = rows.where("role = 'record'").join(reached, "key", "left").select("key", "source", "limit", "excess", "copied", F.col("form").startswith("closed").alias("closed"), odds.alias("odds"))
    # of each source: the share of cuts without a limit, from its unmistakable endings and how many of all cuts (and of whole texts) have such
    right, wrong = told.get("cut", 0.0), told.get("whole", 0.0)
    share_cut = (F.avg((~F.col("copied") & (F.col("odds") >= SURE)).cast("double")) - wrong) / max(right - wrong, 0.05)
    prior = stage(met.where("limit is null").groupBy("source").agg(F.least(F.greatest(share_cut, F.lit(0.0)), F.lit(0.5)).alias("q")))
    met = C.lookup(met, prior, "source", C.hot_keys(met, "source"), "left")
    before = F.coalesce("excess", F.col("q") / (1 - F.col("q")))
    return met.select("key", "source", "limit", (~F.col("copied") & ~F.col("closed") & (before * F.col("odds") > ODDS)).alias("cut"))


def found(records: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """(eval_id): rows of eval_records whose prediction was cut; see judged()."""
    return judged(records, "eval_id", "source", "prediction", "reference", "prompt", lexicon).where("cut").select(F.col("key").alias("eval_id"))


def report(records: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """(source, rows, cut, cut_share, at_limit): by channel, its rows with a prediction, the cut ones, their share, and those at a limit."""
    n = F.count(F.lit(1))
    rows = judged(records, "eval_id", "source", "prediction", "reference", "prompt", lexicon).groupBy("source")
    return rows.agg(n.alias("rows"), F.count_if("cut").alias("cut"), F.avg(F.col("cut").cast("double")).alias("cut_share"), F.count_if(F.col("cut") & F.col("limit").isNotNull()).alias("at_limit"))
