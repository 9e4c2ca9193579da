"""Problem 10: personal information inside free text.

Method: information-theoretic sanitisation. E-mail addresses, phone numbers, street addresses and labelled identity numbers are personal by their
form. All else is judged by corpus co-occurrence, which estimates how strongly a term reveals a protected entity: words reveal identity
numbers if they stand about labelled ones, so numbers of such a form without a label are taken beside such words only; phrases reveal people if known
people (of a table, or with a title) follow them; and words reveal people by the share of their occurrences (in any case) that are part of a name
after such a phrase. What exceeds the disclosure thresholds is replaced; names of places, shops and methods stay, as they don't.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common as C

TYPES = ("email", "phone", "id_number", "street_address", "person_name")
#: A term discloses an entity if it stands for one in at least this share of its occurrences, and says so with at least so many bits.
REVEAL, BITS = 0.25, 2.0
#: Protected entities that a phrase has to precede before it counts as evidence.
EVIDENCE = 2
#: Words before and after an identity number that may tell of it, inside its sentence.
BEFORE, AFTER = 6, 4
#: Term counts that a task keeps before it passes them on.
HELD = 100_000

_S = r"[\s>]+"  # white space, over the line breaks of quoted text too
_UP = "A-ZÀ-ÖØ-Þ"
_LOW = "a-zß-öø-ÿ"
_WORD = rf"(?:[{_UP}][{_LOW}]+(?:['’\-][{_UP}]?[{_LOW}]+)*|[{_UP}]{{2,}}(?:['’\-][{_UP}]{{2,}})*)"

#: Kinds of streets, as they are written after or before a name.
STREETS_EN = "street|st|road|rd|avenue|ave|drive|dr|lane|ln|close|row|terrace|court|ct|place|pl|way|crescent|square|gardens|hill|boulevard|blvd|parade|walk|mews|grove"
STREETS_FR = "rue|avenue|boulevard|chemin|place|allée|impasse|quai|route|cours"
STREETS_DE = "straße|strasse|str\\.|weg|platz|allee|gasse|damm|ring|ufer|steig|chaussee"
STREETS_ES = "calle|c/|avda\\.|avenida|plaza|paseo|camino|carrera|ronda"
#: Names of identity numbers.
ID_LABELS = (
    r"social security (?:no\.?|number)|ssn|tax (?:number|no\.?|id)|tin|passport(?: (?:no\.?|number))?|id card|identity (?:card|number|no\.?)|national id|personal id|driving licen[cs]e|driver'?s licen[cs]e|licen[cs]e no\.?|"
    r"steuer-?id|steuernummer|ausweis(?:nummer|-?nr\.?)?|personalausweis\w*|führerschein\w*|reisepass\w*|sozialversicherungs\w*|"
    r"n° d['’]identité|numéro (?:d['’]identité|fiscal|de sécurité sociale)|permis n°|permis de conduire|matricule|passeport(?: n°)?|carte d['’]identité|n° fiscal|"
    r"nif|dni|nie|n\.º de identificación|número de (?:identificación|identidad)|pasaporte|licencia|permiso de conducir|carn[eé] de conducir|carn[eé]"
)
EMAIL = re.compile(
    r"[A-Za-z0-9](?:[A-Za-z0-9._+%\-]*[A-Za-z0-9_])?(?:@|\s*[\[({]\s*at\s*[\])}]\s*|\s+AT\s+|\s+at\s+(?=[A-Za-z0-9\-]+\s+dot\s))"
    r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:(?:\.|\s*[\[({]\s*dot\s*[\])}]\s*|\s+DOT\s+|\s+dot\s+)[A-Za-z0-9\-]*[A-Za-z][A-Za-z0-9\-]*)+",
)
#: A house number and street as in English, French, German and Spanish.
ADDRESS_EN = re.compile(
    rf"(?:(?i:p\.o\. (?:address|box))\s+|(?i:flat|unit|apt\.?|suite)\s+\d+[a-z]?,?\s+)?(?<![\w.,#])\d{{1,5}}[a-zA-Z]?,?{_S}(?:{_WORD}{_S}){{1,3}}(?i:{STREETS_EN})\b\.?(?!{_S}(?i:market|bakery|station|sign)\b)(?:,{_S}(?i:flat|unit|apt\.?|suite){_S}\d+[a-z]?)?(?:,{_S}{_WORD}(?![\w@])(?:{_S}\d{{4,6}}\b)?)?",
)
ADDRESS_FR = re.compile(rf"(?<![\w.,#])\d{{1,5}}(?:\s*(?:bis|ter|quater))?,?{_S}(?i:{STREETS_FR}){_S}(?:(?i:de la|de l['’]|du|des|de|d['’])\s*)?{_WORD}(?:,?{_S}\d{{4,5}}{_S}{_WORD})?")
ADDRESS_DE = re.compile(rf"(?:(?:Am|An der|Auf dem|Zum|Zur|Im|In der){_S})?(?:[{_UP}][\w\-]*(?i:{STREETS_DE})|{_WORD}[\s\-](?i:{STREETS_DE}))\s*\d{{1,4}}\s?[a-z]?\b(?:,?{_S}\d{{4,5}}{_S}{_WORD})?")
ADDRESS_ES = re.compile(rf"(?<!\w)(?i:{STREETS_ES}){_S}(?:(?i:de la|de los|de las|del|de)\s+)?{_WORD}(?:{_S}{_WORD})?,?{_S}(?:n\.?º\s*)?\d{{1,4}}\b(?:,{_S}\d{{1,2}}\.?º(?:{_S}[A-Z]\b)?)?(?:,{_S}(?:\d{{5}}{_S})?{_WORD})?")
_UNITS = ("flat", "unit", "apt", "apt.", "suite", "suit", "address", "box")
_ID_LEAD = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ-")
ID_LABELLED = re.compile(rf"(?<!\w)(?i:{ID_LABELS})\s*[:#]?{_S.replace('+', '*')}((?=[A-Z0-9])[A-Z0-9](?:[ .\-/]?[A-Z0-9]){{5,17}})(?![\w])")
ID_BARE = re.compile(r"(?<![\w.\-/#+])(?:\d{3}-\d{2}-\d{4}|\d{2}[\s>]+\d{4}[\s>]+\d{3}[A-Z]|[A-Z]\d{8}|[A-Z]{2,5}-\d{6}-\d{2})(?![\w\-])")
PHONE = re.compile(
    "|".join(
        (
            r"(?<![\w.+\-/])(?:\+|00(?=\d{1,3}[\s.\-/(]))\d{1,3}[\s>.\-/]{0,3}(?:\(\d{1,4}\)|\d{1,4})(?:[\s>.\-/]{0,3}(?:\(\d{1,4}\)|\d{2,11})){1,6}(?![\w])",
            r"(?<![\w.+\-/])(?:1[\s.\-])?(?:\(\d{3}\)[\s>]?|\d{3}[\s.\-])\d{3}[\s.\-]\d{4}(?![\w.\-]*\d)(?:[\s>]*(?:ext\.?|x)[\s>]*\d{1,5})?",
            r"(?<![\w.+\-/])\(0\d{1,4}\)[\s>]?\d{3,4}[\s>\-]?\d{3,4}(?!\w)",
            r"(?<![\w.+\-/])0\d{2,4}[\s>]\d{3,4}[\s>]\d{3,4}(?!\w)",
            r"(?<![\w.+\-/])0\d(?:[\s.\-]\d{2}){4}(?![\w])",
            r"(?<![\w.+\-/])0\d{2,5}/[\s>]?\d{3,8}(?:-\d{1,5})?(?!\w)",
        )
    )
)
PHONE_CUED = re.compile(r"(?i:tel|tél|telefon|telephone|téléphone|teléfono|phone|call|line|answers on|rückruf unter|rappeler au|llamar al|mobile|fax)\.?:?[\s>]+(\d{7,15})(?![\w.\-]*\d)")

#: Titles of persons.
TITLES = frozenset("dr. dr prof. prof mr. mr mrs. mrs ms. ms mme. mme m. madame monsieur herr frau sr. sr sra. sra señor señora don doña".split())
_NAME = re.compile(rf"(?:[{_UP}]\.[\s>]*(?:[{_UP}]\.[\s>]*)?{_WORD}|{_WORD}{_S}(?:[{_UP}]\.{_S})?{_WORD}|{_WORD},{_S}{_WORD})(?![\w@])")
_SINGLE = re.compile(rf"{_WORD}(?![\w@])")
_UPPER = re.compile(rf"[{_UP}]")
_NUMBER = re.compile(r"[+(]?\d+")
_GAP = re.compile(r"[\s>]+\Z")
#: The end of a sentence; short words before a stop are abbreviations such as no. and nr.
_STOP = re.compile(r"(?:[^\W\d_]{3}|[\d)\"'\x00])[.!?][\s>]")
_WORDS = re.compile(r"[^\W\d_]+(?:['’\-][^\W\d_]+)*")
_TERM = re.compile(rf"(?<![\w@]){_WORD}(?![\w@])")
_ID_STEMS = tuple("security|ssn|tax|tin|passport|id card|identity|national id|personal id|licen|steuer|ausweis|führerschein|reisepass|sozialvers|identité|fiscal|permis|matricule|passeport|nif|dni|nie|identifi|identidad|pasaporte|carn".split("|"))
_PHONE_STEMS = tuple("tel tél phone line call fax mobile answers rückruf rappeler llamar".split())
_AT = ("@", "AT", "(at", "( at", "[at", "[ at", "{at", "{ at")
_STREETS_BEFORE = tuple(x.replace("\\", "") for x in STREETS_DE.split("|"))
_STREETS_ES = tuple(x.replace("\\", "") for x in STREETS_ES.split("|"))


def typed(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, type) of what is personal by its form, none overlapping; earlier kinds in the list win. Type "id" needs evidence.

    All forms but e-mail addresses hold a number, so patterns are tried at numbers only, and those that begin before one in the words about it.
    """
    spans: list[tuple[int, int, str]] = []

    def take(start: int, end: int, kind: str) -> None:
        if end > start and not any(a < end and start < b for a, b, _ in spans):
            spans.append((start, end, kind))

    if any(x in text for x in _AT) or (" dot" in text and " at" in text):
        for m in EMAIL.finditer(text):
            take(m.start(), m.end(), "email")
    numbers = [m.start() for m in _NUMBER.finditer(text)]
    if not numbers:
        return spans
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in ("street_address", "id_number", "id", "phone", "called")}

    def about(pattern: re.Pattern, low: int, high: int, kind: str, group: int = 0) -> None:
        for m in pattern.finditer(text, low, high):
            if m.end(group) < high or high >= len(text):
                found[kind].append((m.start(group), m.end(group)))

    for i in numbers:
        before = text[max(0, i - 70) : i].lower()
        near = _GAP.sub("", before[-24:])
        first = i if text[i].isdigit() else i + 1
        for pattern in (ADDRESS_EN, ADDRESS_FR):
            if m := pattern.match(text, first):
                found["street_address"].append((m.start(), m.end()))
        if first == i:
            if near.endswith(_UNITS):
                about(ADDRESS_EN, max(0, i - 40), min(len(text), i + 160), "street_address")
            if near.endswith(_STREETS_BEFORE):
                about(ADDRESS_DE, max(0, i - 70), min(len(text), i + 90), "street_address")
            if any(x in before for x in _STREETS_ES):
                about(ADDRESS_ES, max(0, i - 90), min(len(text), i + 120), "street_address")
            if any(x in before for x in _ID_STEMS):
                about(ID_LABELLED, max(0, i - 70), min(len(text), i + 80), "id_number", 1)
            if any(x in before for x in _PHONE_STEMS):
                about(PHONE_CUED, max(0, i - 30), min(len(text), i + 40), "called", 1)
        start = i
        while start and i - start < 6 and text[start - 1] in _ID_LEAD:
            start -= 1
        for at in {i, start}:
            if m := ID_BARE.match(text, at):
                found["id"].append((m.start(), m.end()))
        if (m := PHONE.match(text, i)) and 9 <= sum(x.isdigit() for x in m.group()) <= 20:
            found["phone"].append((m.start(), m.end()))
    for kind, spots in found.items():
        for start, end in sorted(set(spots)):
            if kind != "id_number" or sum(x.isdigit() for x in text[start:end]) >= 5:
                take(start, end, "phone" if kind == "called" else kind)
    return spans


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """text with signs that no pattern takes in place of the spans."""
    out, last = [], 0
    for start, end, _ in sorted(spans):
        out += [text[last:start], "\x00" * (end - start)]
        last = end
    return "".join(out) + text[last:]


def _terms(name: str) -> list[str]:
    return [x.lower() for x in _TERM.findall(name)]


def window(text: str, start: int, end: int) -> list[str]:
    """The words about a span in its sentence, in lower case."""
    left, right = text[max(0, start - 120) : start], text[end : end + 80]
    left = left[max([m.end() for m in _STOP.finditer(left)], default=0) :]
    if m := _STOP.search(right):
        right = right[: m.end()]
    return [x.lower() for x in _WORDS.findall(left)[-BEFORE:] + _WORDS.findall(right)[:AFTER]]


def candidates(text: str) -> list[tuple[int, int, list[str], str, list[str], bool]]:
    """(start, end, terms, name, phrases, titled) of what may be a name in a masked text; phrases: the word and the two words before it."""
    out = []
    for u in _UPPER.finditer(text):
        i = u.start()
        if i and (text[i - 1].isalnum() or text[i - 1] in "_.@"):
            continue
        m = _NAME.match(text, i)
        left = text[max(0, i - 40) : i].replace(">", " ")
        said = left.lower().split()[-2:] if not left or left[-1].isspace() else []
        titled = bool(said) and said[-1] in TITLES
        if m is None and (not titled or (m := _SINGLE.match(text, i)) is None):
            continue
        terms = _terms(m.group())
        if terms:
            name = " ".join(reversed(terms) if "," in m.group() else terms)
            phrases = [said[-1], " ".join(said)] if len(said) == 2 else said
            out.append((i, m.end(), terms, name, phrases, titled))
    return out


_COLUMNS = ["doc_id", "kind", "a", "b", "terms", "name", "phrases", "titled", "n", "labelled"]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, text) to spans, candidates, and counts of words: all occurrences, and those about labelled identity numbers."""
    counts: Counter = Counter()
    labelled: Counter = Counter()

    def rows(out: list, flush: bool) -> pd.DataFrame:
        if flush:
            out += [(None, "term", None, None, [t], None, None, None, n, labelled[t]) for t, n in counts.items()]
            out += [(None, "term", None, None, [t], None, None, None, 0, n) for t, n in labelled.items() if t not in counts]
            counts.clear()
            labelled.clear()
        return pd.DataFrame(out, columns=_COLUMNS, dtype=object)

    for pdf in batches:
        out: list[tuple] = []
        for key, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            spans = typed(text)
            clear = masked(text, spans) if spans else text
            counts.update(_WORDS.findall(clear.lower()))
            for a, b, kind in spans:
                words = None
                if kind == "id":
                    words = window(clear, a, b)
                elif kind == "id_number":
                    labelled.update(window(clear, a, b))
                out.append((key, kind, a, b, words, None, None, None, None, None))
            out += [(key, "name", *c, None, None) for c in candidates(clear)]
        yield rows(out, len(counts) > HELD)
    yield rows([], True)


def _names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"name": [" ".join(_terms(x)) for x in pdf["name"]]})


def _disclosing(counts: DataFrame, term: str, hits: str, all_: str = "n") -> DataFrame:
    """(term) of those that disclose an entity: hits of all their occurrences exceed both thresholds."""
    total = counts.agg(F.sum(all_), F.sum(hits)).first()
    base = max(1e-9, (total[1] or 0) / (total[0] or 1))
    share = F.col(hits) / (F.col(all_) + 1.0)
    return counts.where((share >= REVEAL) & (F.log2(F.greatest(share, F.lit(1e-12)) / base) >= BITS)).select(term)


def mentions(documents: DataFrame, annotators: DataFrame | None = None, doc: str = "doc_id", text: str = "text", name: str = "full_name") -> DataFrame:
    """(doc_id, pii_type, start, end): each piece of personal information, as a span of characters.

    annotators: known people, any number of them. Null or empty texts have none; texts are read whole; rows that recur give the same spans.
    """
    kind = documents.schema[doc].dataType.simpleString()
    docs = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")).where("text is not null and text != ''")
    scanned = stage(docs.mapInPandas(_scan, f"doc_id {kind}, kind string, a long, b long, terms array<string>, name string, phrases array<string>, titled boolean, n long, labelled long"))
    spot = ["doc_id", "a", "b"]
    counts = stage(scanned.where("kind = 'term'").groupBy(F.col("terms")[0].alias("term")).agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled")))

    def met(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
        return C.lookup(rows, table, key, C.hot_keys(rows, key), how)

    # numbers of an identity number's form without a label, beside words that disclose labelled ones
    bare = scanned.where("kind = 'id'").select(*spot, F.explode("terms").alias("term")).distinct()
    ids = met(bare, _disclosing(counts, "term", "labelled"), "term").select(*spot).distinct()
    # phrases that known people and people with a title follow
    named = scanned.where("kind = 'name'").select(*spot, "terms", "name", "phrases", "titled").distinct()
    if annotators is None:
        named = named.withColumn("known", F.lit(False))
    else:
        known = annotators.select(F.col(name).alias("name")).where("name is not null").mapInPandas(_names, "name string").where("name != ''").distinct()
        named = met(named, known.withColumn("known", F.lit(True)), "name", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    named = stage(named.withColumn("seed", F.col("known") | F.col("titled")))
    phrases = named.select(*spot, "seed", F.explode(F.array_distinct("phrases")).alias("phrase"))
    after = phrases.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"), F.count_if("seed").alias("seeds"))
    total = named.agg(F.count(F.lit(1)), F.count_if("seed")).first()
    base = max(1e-9, total[1] / max(1, total[0]))
    telling = stage(after.where((F.col("seeds") >= EVIDENCE) & (F.log2(F.col("seeds") / (F.col("n") + 1.0) / base) >= BITS)).select("phrase"))
    cued = met(phrases.select(*spot, "phrase"), telling, "phrase").select(*spot).unionByName(named.where("seed").select(*spot)).distinct().withColumn("cued", F.lit(True))
    named = stage(named.join(cued, spot, "left").select(*spot, "terms", "known", F.coalesce("cued", F.lit(False)).alias("cued")))
    # words that stand for people: how many of all their occurrences are part of a name after such a phrase
    person = named.where("cued").select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("person"))
    reveal = stage(_disclosing(counts.join(person, "term", "left").withColumn("person", F.coalesce("person", F.lit(0))), "term", "person"))
    # a name after such a phrase is taken if one of its words discloses a person, another one if each does; a word that is new to such phrases
    # is judged by how often it stands beside one that does
    words = named.select(*spot, "known", "cued", F.size("terms").alias("k"), F.explode("terms").alias("term"))
    told = met(words, reveal.withColumn("tells", F.lit(1)), "term", "left").groupBy(*spot, "known", "cued", "k").agg(F.count("tells").alias("m"), F.max(F.when(F.col("tells").isNull(), F.col("term"))).alias("other"))
    sure = F.col("known") | (F.col("cued") & (F.col("m") >= 1)) | (F.col("m") == F.col("k"))
    told = stage(told.where(sure | ((F.col("m") >= 1) & (F.col("m") == F.col("k") - 1))).withColumn("sure", sure))
    unsure = told.where(~F.col("sure"))
    beside = unsure.groupBy(F.col("other").alias("term")).agg(F.count(F.lit(1)).alias("beside")).join(counts, "term").where(F.col("beside") / (F.col("n") + 1.0) >= REVEAL).select(F.col("term").alias("other"))
    names = told.where("sure").select(*spot).unionByName(met(unsure.select(*spot, "other"), beside, "other").select(*spot))
    typed_ones = scanned.where(F.col("kind").isin(*TYPES)).select("doc_id", F.col("kind").alias("pii_type"), "a", "b")
    found = typed_ones.unionByName(ids.select("doc_id", F.lit("id_number").alias("pii_type"), "a", "b")).unionByName(names.select("doc_id", F.lit("person_name").alias("pii_type"), "a", "b"))
    return found.select("doc_id", "pii_type", F.col("a").alias("start"), F.col("b").alias("end")).distinct()


def found(documents: DataFrame, annotators: DataFrame | None = None) -> DataFrame:
    """(doc_id, pii_type): one row for each document and type of personal information in it."""
    return mentions(documents, annotators).select("doc_id", "pii_type").distinct()


def _replace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for text, spans in zip(pdf["text"], pdf["spans"], strict=True):
            if text is not None and spans is not None:
                # overlapping spans are one; the type is that of the first
                parts, last = [], 0
                merged: list[list] = []
                for start, end, kind in sorted((s["start"], s["end"], s["pii_type"]) for s in spans):
                    if merged and start < merged[-1][1]:
                        merged[-1][1] = max(end, merged[-1][1])
                    else:
                        merged.append([start, end, kind])
                for start, end, kind in merged:
                    parts += [text[last:start], f"[{kind.upper()}]"]
                    last = end
                text = "".join(parts) + text[last:]
            out.append(text)
        yield pdf[["doc_id"]].assign(text=pd.Series(out, dtype=object, index=pdf.index))


def sanitised(documents: DataFrame, annotators: DataFrame | None = None) -> DataFrame:
    """(doc_id, text): every document with placeholders such as [EMAIL] in place of personal information, the rest as it was; null stays null.

    Spans that overlap, such as those of a name of three words, get one placeholder.
    """
    spans = mentions(documents, annotators).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "pii_type")).alias("spans"))  # of one document
    docs = documents.select("doc_id", "text")
    return docs.join(spans, "doc_id", "left").mapInPandas(_replace, f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, text string")
