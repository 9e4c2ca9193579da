"""Problem 2: broken prompt and response pairs.

Method: each response is compressed with its prompt as a zstandard dictionary to detect copies; dictionaries of languages, learned from labelled texts,
tell languages; a dictionary of refusals tells answers that decline, and the terminal-context model of problem 1 tells cut ones.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common as C
from . import truncation

#: Of a copy, the bytes left after compression with its prompt are at most this share of those left without it.
COPY = 0.45
#: Level of compression: dictionaries of a prompt's size gain nothing from higher ones.
LEVEL = 3
#: Unknown words that are kept beside a dictionary, and the occurrences that a term of one needs.
TERMS, SEEN = 40_000, 3
#: How much one word says at most, and how far the best language has to lie before the second (natural logarithms).
MOST, MARGIN = 3.0, 3.0

#: Frequent function words by language, for use without labelled texts.
WORDS = {
    "en": "the a an of and that is in on at by with to from which this it its as not was are be for but or they he she his her you i we",
    "de": "der die das und ist im am auf den dem ein eine einen einem einer nicht mit von zu zum zur sich sind wie für ich sie er es wir auch als nach bei",
    "fr": "le la les un une des du et est dans qui que sur au aux avec pour pas ne ce cette il elle nous vous je sont par plus son sa ses",
    "es": "el la los las un una del de y está es que en con por para no se su sus al lo más como pero ella nosotros son ser este esta",
}

#: How an answer declines, by language.
REFUSALS = [
    r"\bi\s?(?:a|')?m (?:(?:very |so |truly )?sorry|unable to|not able to|afraid i)\b",
    r"\bi (?:can ?not|can't|cannot|won't|will not|would not|must decline|have to decline|must refuse|decline to|refuse to|do not feel comfortable|don't feel comfortable|am not comfortable|am unable|am not able|am not permitted|am not allowed)\b",
    r"^(?:i'm |i am )?(?:sorry|apologies|my apologies|unfortunately|regrettably)\b[, ]",
    r"\bas an? (?:ai|language|artificial)[\w ]*\b(?:model|assistant)?\b.*\b(?:not|cannot|can't|unable)\b",
    r"\b(?:this|that|your|the) (?:request|question|task)\b.*\b(?:can ?not|can't|cannot|must not|may not) be (?:fulfilled|answered|processed|completed|met)\b",
    r"\brequest (?:was |is |has been )?(?:declined|denied|refused|rejected)\b",
    r"^(?:can ?not|can't|cannot|unable to|not able to) (?:assist|help|comply|answer|describe|do|provide|process|identify|comment|fulfil)\b",
    r"\bno (?:answer|description|response) (?:can|could|will) be (?:given|provided|made)\b",
    r"\bsomething i (?:have to|must|need to) (?:refuse|decline)\b",
    r"\b(?:would|is|was) not be? ?(?:appropriate|possible) for me to\b",
    r"\b(?:against|violates?|due to) my (?:guidelines|policy|policies|rules)\b",
    r"\b(?:es )?tut mir leid\b|\b(?:kann|darf|möchte) ich (?:leider |dabei |hier )*nicht\b|\bich (?:kann|darf|möchte) (?:\w+ ){0,5}nicht\b|\bleider (?:kann|darf|ist es|nicht)\b|\bnicht (?:beantworten|helfen|möglich|beschreiben)\b.*\banfrage\b|\banfrage\b.*\b(?:nicht|abgelehnt)\b",
    r"\bje (?:suis désolée?|regrette|ne (?:peux|puis|suis|veux))\b|\bdésolée?\b,|\bil (?:m'est|n'est pas) (?:im)?possible\b|\bje refuse\b|\bdemande (?:refusée|rejetée)\b",
    r"\blo siento\b|\bno (?:puedo|me es posible|es posible|se puede) (?:\w+ )?(?:responder|describir|ayudar|atender|contestar|procesar)\b|\bno me es posible\b|\bme niego\b|\bsolicitud (?:rechazada|denegada)\b",
    r"(?:抱歉|对不起|很遗憾).*(?:不能|无法)|^(?:我)?(?:无法|不能)(?:回答|描述|提供|协助|帮助)",
]
_REFUSAL = re.compile("|".join(f"(?:{x})" for x in REFUSALS), re.DOTALL)
#: Parts of words one of which stands in every refusal above; they are looked for first.
_HINTS = tuple(x.replace("+", " ") for x in "sorry apolog unable afraid declin refus comfortable permitted allowed unfortunately regrettably as+a cannot can+not can't won't will+not would+not must+not may+not not+able request answer+c answer+w description+c description+w response+c response+w something+i is+not was+not be+appropriate be+possible guideline polic rules leid nicht leider anfrage désolé regrette je+ne je+suis possible posible rejet siento puedo puede niego solicitud 抱歉 对不起 很遗憾 无法 不能".split())
_LETTERS = re.compile(r"[^\W\d_]+")
_FOREIGN = re.compile("[\u0250-\U0010ffff]")
_WORD = re.compile(r"\w+")
_MARKS = re.compile(r"<(?:image|video)>")


def plain(text: str) -> str:
    """The words of a text in lower case, without signs and placeholders."""
    return " ".join(_WORD.findall(_MARKS.sub(" ", text.lower())))


def script(text: str) -> str:
    """The script of most letters, as its name in Unicode ("LATIN", "CYRILLIC" ...; "JAPANESE" for Chinese signs among kana); "" without letters."""
    letters = "".join(_LETTERS.findall(text))
    if not letters:
        return ""
    if letters.isascii():
        return "LATIN"
    foreign = _FOREIGN.findall(letters)
    if 2 * len(foreign) < len(letters):
        return "LATIN"
    seen = Counter(unicodedata.name(x, "").split(" ")[0].split("-")[0] for x in foreign)
    if seen["HIRAGANA"] + seen["KATAKANA"] > 0.1 * len(foreign):
        return "JAPANESE"
    return max(seen, key=lambda x: (seen[x], x))


def _terms(word: str) -> list[str]:
    """The three-letter parts of a word with its edges."""
    edged = f"_{word}_"
    return [edged[i : i + 3] for i in range(len(edged) - 2)]


def words_of(text: str) -> list[str]:
    """Words in lower case; elisions such as qu'une are two."""
    return _LETTERS.findall(text.lower())


class Languages:
    """Dictionaries of languages: what each word, or for unknown words their three-letter parts, tell for each language.

    counts: {language: {term: occurrences}}, parts of words with a leading "#". Languages are told apart within their script only.
    """

    #: Weights of all languages lie side by side in one whole number, as thousandths above zero, so that a text's words are simply summed up.
    LANE, UNIT = 48, 1000

    def __init__(self, counts: dict[str, dict[str, int]]):
        self.names = sorted(counts)
        whole = {x: {part: sum(n for t, n in counts[x].items() if (t[0] == "#") == part) or 1 for part in (True, False)} for x in self.names}
        self.parts, words = {}, {}
        for t in {t for c in counts.values() for t in c}:
            logs = [math.log((counts[x].get(t, 0) + 0.5) / (whole[x][t[0] == "#"] + 0.5)) for x in self.names]
            mean = sum(logs) / len(logs)
            weights = [max(-MOST, min(MOST, v - mean)) for v in logs]
            if t[0] == "#":
                self.parts[t[1:]] = weights
            else:
                words[t] = self._packed(weights)
        self.packed = _Packed(self, words)

    def _packed(self, weights: list[float]) -> int:
        return sum(int((w + MOST) * self.UNIT) << (self.LANE * i) for i, w in enumerate(weights))

    def by_parts(self, word: str) -> int:
        """What a word that no dictionary has tells by its parts."""
        held = [w for t in _terms(word) if (w := self.parts.get(t))]
        return self._packed([sum(v) / max(2, len(held)) for v in zip(*held, strict=True)] if held else [0.0] * len(self.names))

    def tell(self, text: str) -> str:
        """A language, a script in capitals for texts that aren't in Latin letters, or "" where the text doesn't tell."""
        text = truncation.inner(text.strip())
        kind = script(text)
        if kind != "LATIN":
            return kind
        if len(self.names) == 1:
            return self.names[0]
        total = sum(map(self.packed.__getitem__, words_of(text)))
        scores = [(total >> (self.LANE * i) & ((1 << self.LANE) - 1)) / self.UNIT for i in range(len(self.names))]
        best, second = sorted(scores, reverse=True)[:2]
        return self.names[scores.index(best)] if best - second >= MARGIN else ""


class _Packed(dict):
    """Packed weights by word; those of unknown words are kept too, up to TERMS of them."""

    def __init__(self, languages: Languages, words: dict[str, int]):
        super().__init__(words)
        self.languages, self.words, self.most = languages, words, len(words) + TERMS

    def __missing__(self, word: str) -> int:
        if len(self) > self.most:
            self.clear()
            self.update(self.words)
        self[word] = made = self.languages.by_parts(word)
        return made

    def __reduce__(self):
        return _Packed, (self.languages, self.words)


#: For use without labelled texts.
COMMON = Languages({x: dict.fromkeys(v.split(), 100) for x, v in WORDS.items()})


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, text) to (lang, word, n): counts of a task's words in texts of Latin letters."""
    seen: dict[str, Counter] = {}

    def rows() -> pd.DataFrame:
        made = pd.DataFrame([(lang, w, n) for lang, words in seen.items() for w, n in words.items()], columns=["lang", "word", "n"])
        seen.clear()
        return made

    for pdf in batches:
        for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
            if script(text) == "LATIN":
                seen.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, seen.values())) > truncation.HELD:
            yield rows()
    yield rows()


def _part_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, word, n) to (lang, term, n): the words' three-letter parts."""
    for pdf in batches:
        seen: Counter = Counter()
        for lang, word, n in zip(pdf["lang"], pdf["word"], pdf["n"], strict=True):
            for t in _terms(word):
                seen[lang, "#" + t] += n
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["lang", "term", "n"])


def learned(labelled: DataFrame) -> Languages:
    """Dictionaries from all labelled texts (lang, text): all their words and parts of words.

    Labels are compared in lower case without signs; those without any term, and terms seen less than SEEN times, say nothing.
    """
    there = labelled.select(C.canon_name(F.col("lang")).alias("lang"), "text").where("lang is not null and text is not null")
    words = stage(there.mapInPandas(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    parts = words.mapInPandas(_part_counts, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n"))
    # vocabularies grow much slower than texts; they come as columns, which takes the driver a few dozen bytes a term
    counted = words.withColumnRenamed("word", "term").unionByName(parts).where(F.col("n") >= SEEN).toPandas()
    counts: dict[str, dict[str, int]] = {}
    for lang, term, n in zip(counted["lang"], counted["term"], counted["n"].tolist(), strict=True):
        counts.setdefault(lang, {})[term] = n
    for lang, common in WORDS.items():  # function words that a small corpus may lack
        if lang in counts:
            typical = max(1, sum(counts[lang].values()) // 1000)
            for w in common.split():
                counts[lang][w] = max(typical, counts[lang].get(w, 0))
    return Languages(counts) if counts else COMMON


def refuses(text: str) -> bool:
    said = " ".join(text.replace("’", "'").lower().split())
    return any(h in said for h in _HINTS) and bool(_REFUSAL.search(said))


@lru_cache(maxsize=1024)
def _compressor(prompt: str) -> tuple:
    """Of a prompt: its plain words, a compressor with them as dictionary, and the bytes that any text takes."""
    words = plain(prompt)
    said = zstandard.ZstdCompressionDict(words.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    said.precompute_compress(level=LEVEL)
    with_it = zstandard.ZstdCompressor(level=LEVEL, dict_data=said, write_content_size=False, write_checksum=False, write_dict_id=False)
    return words, with_it, len(with_it.compress(b""))


_ALONE = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
_ALONE_LEAST = len(_ALONE.compress(b""))


def copy_ratio(prompt: str, text: str) -> float:
    """Bytes left of text when compressed with its prompt as dictionary, as a share of those left without it (both made plain).

    0 where it is the prompt once or several times over, of any length.
    """
    if not prompt or not (t := plain(text)):
        return 1.0
    words, with_it, least = _compressor(prompt)
    if not words:
        return 1.0
    if t == words or (len(t) > len(words) and not t.replace(words, "").strip()):
        return 0.0
    data = t.encode()
    left = max(0, len(with_it.compress(data)) - least)
    # text can't shrink below that without its prompt, so the second compression is needed only for what may be a copy
    return 1.0 if left > COPY * (len(data) + 3) else left / max(1, len(_ALONE.compress(data)) - _ALONE_LEAST)


def _labels(languages: Languages):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            refusal, copy, other = [], [], []
            for prompt, reference, text in zip(pdf["prompt"], pdf["reference"], pdf["text"], strict=True):
                declined = refuses(text)
                refusal.append(declined)
                copy.append(not declined and copy_ratio(prompt or "", text) <= COPY)
                if not reference or reference == text:
                    other.append(False)
                else:
                    a, b = languages.tell(reference), languages.tell(text)
                    other.append(bool(a and b and a != b))
            yield pdf[["key"]].assign(refusal=refusal, copy=copy, other_language=other)

    return run


def defects(df: DataFrame, labelled: DataFrame | None = None, key: str = "eval_id", source: str = "source", prompt: str = "prompt", reference: str = "reference", prediction: str = "prediction") -> DataFrame:
    """(key, defect_type): one row for each defect of a record: empty, truncated, refusal, copy, other_language.

    labelled (text, lang): whole texts of known languages, from which dictionaries of languages and the model of endings learn; without them
    languages are told by their most frequent words. A pair with a null, blank or filler prediction or reference is empty; an empty prediction
    has no other defect. Truncated is what truncation.judged calls cut, whatever other defects there are. Languages are compared only where both
    texts tell theirs. The column of reasons from elsewhere is often wrong, so it isn't used; rows that recur are judged each for itself, and
    very long texts are read whole.
    """
    rows = df.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(prompt).alias("prompt"), F.col(reference).alias("reference"), F.col(prediction).alias("text"))
    hollow = truncation.is_filler(F.col("text"))
    empty = rows.where(hollow | truncation.is_filler(F.col("reference"))).select("key", F.lit("empty").alias("defect_type"))
    languages = COMMON if labelled is None else learned(labelled)
    said = rows.where(~hollow).select("key", "prompt", "reference", "text").mapInPandas(_labels(languages), f"key {rows.schema['key'].dataType.simpleString()}, refusal boolean, copy boolean, other_language boolean")
    kinds = F.array_compact(F.array(*[F.when(F.col(x), F.lit(x)) for x in ("refusal", "copy", "other_language")]))
    cut = truncation.judged(rows, "key", "source", "text", "reference", "prompt", labelled).where("cut").select("key", F.lit("truncated").alias("defect_type"))
    return empty.unionByName(said.select("key", F.explode(kinds).alias("defect_type"))).unionByName(cut).withColumnRenamed("key", key)
