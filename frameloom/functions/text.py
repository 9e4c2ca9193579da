"""Texts, paths and the checks on answers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an answer must not mention; whole words, ignoring case, and tuples of two or four numbers.
FORBIDDEN = (
    r"\bbbox\b",
    r"\bbounding boxes?\b",
    r"\bcoordinates?\b",
    r"\bmasks?\b",
    r"\btrack[_ ]?ids?\b",
    r"\bsegmentation mask\b",
    r"\(\s*-?\d+(?:\.\d+)?\s*,\s*-?\d+(?:\.\d+)?(?:\s*,\s*-?\d+(?:\.\d+)?\s*,\s*-?\d+(?:\.\d+)?)?\s*\)",
)
#: The singular of the second is let pass above; an option of format_reasons() forbids it too.
STRICT = (r"\bbounding box\b",)
#: Media types by suffix.
MEDIA_TYPES = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "bmp": "image/bmp", "webp": "image/webp", "gif": "image/gif", "mp4": "video/mp4"}


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def count_of(c: Column, part: str) -> Column:
    """How often a fixed part occurs, without overlaps; 0 for null."""
    quoted = "".join(f"\\{x}" if not x.isalnum() and x not in "<> " else x for x in part)
    return F.coalesce(F.regexp_count(c, F.lit(quoted)), F.lit(0))


# The two patterns below, and the names of reasons in format_reasons.
def word_count(c: Column) -> Column:
    """Runs of ASCII letters, with one more run after an apostrophe or hyphen counted with the first."""
    return F.regexp_count(c, F.lit(r"[A-Za-z]+(?:['-][A-Za-z]+)?"))


def sentence_count(c: Column) -> Column:
    """Parts between stops that white space or the end follows, blank ones left out; 1 at least unless the text is blank."""
    parts = F.filter(F.split(strip(c), r"(?U)[.!?]+(?:\s+|$)"), lambda p: p.rlike(r"(?U)\S"))
    return F.when(strip(c) == "", 0).otherwise(F.greatest(F.lit(1), F.size(parts)))


def is_cjk(c: Column) -> Column:
    return c.rlike(r"[㐀-鿿]")


def is_json_like(c: Column) -> Column:
    return c.startswith("{") | c.startswith("[")


def mentions_annotation(c: Column, strict: bool = False) -> Column:
    patterns = FORBIDDEN + (STRICT if strict else ())
    return reduce(lambda a, b: a | b, [c.rlike(f"(?iU){p}") for p in patterns])


def format_reasons(c: Column, max_words: int = 80, max_sentences: int = 2, strict: bool = False) -> Column:
    """Why an answer fails the format check, in fixed order; an empty array is success, and null counts as empty."""
    t = strip(F.coalesce(c, F.lit("")))
    tests = (
        (t == "", "empty"),
        (word_count(t) > max_words, "too_long"),
        (sentence_count(t) > max_sentences, "too_many_sentences"),
        (is_cjk(t), "non_english"),
        (is_json_like(t), "json_like"),
        (mentions_annotation(t, strict), "forbidden_annotation_output"),
    )
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in tests]))


def natural_key(c: Column) -> Column:
    """A key that orders names by their runs of digits as numbers and other runs in lower case."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\d+|\D+)"), F.lit(1))
    digits = lambda r: r.rlike(r"^\d")
    # a name that begins with digits begins with an empty text, so texts meet texts and numbers meet numbers
    lead = F.when(digits(F.coalesce(F.get(runs, 0), F.lit(""))), F.array(F.lit("")).cast("array<string>")).otherwise(F.array().cast("array<string>"))
    return F.transform(F.concat(lead, runs), lambda r: F.struct(F.when(digits(r), "").otherwise(r).alias("s"), F.when(digits(r), r.try_cast("decimal(38,0)")).alias("d")))


def path_name(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def path_parent(c: Column) -> Column:
    """The name of the folder that holds the file."""
    return F.substring_index(F.substring_index(c, "/", -2), "/", 1)


def path_stem(c: Column) -> Column:
    return F.regexp_replace(path_name(c), r"(?<=.)\.[^.]*$", "")


def path_suffix(c: Column) -> Column:
    return F.lower(F.regexp_extract(path_name(c), r"(?<=.)(\.[^.]+)$", 1))


def without_last_part(c: Column, sep: str = "_") -> Column:
    return F.regexp_replace(c, f"{sep}[^{sep}]*$", "")


def numbered_frame(i: Column, suffix: str = "") -> Column:
    """At least six digits; longer numbers keep theirs."""
    return F.concat(F.format_string("%06d", i), F.lit(suffix))


def relative_path(path: Column, root: str) -> Column:
    """Below root without it; other paths as they are."""
    base = root.rstrip("/") + "/"
    return F.when(path.startswith(base), F.substring(path, F.lit(len(base) + 1), F.length(path))).otherwise(path)


def under_segment(path: Column, segment: str) -> Column:
    return F.array_contains(F.split(path, "/"), segment)


def placeholder_tokens(prompt: Column) -> Column:
    """A prompt in parts: each <image> and <video>, and the texts between them."""
    return F.regexp_extract_all(prompt, F.lit(r"(?s)<image>|<video>|(?:(?!<image>|<video>).)+"), F.lit(0))


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def to_data_url(name: Column, content: Column) -> Column:
    """A data URL of a file's bytes; the media type follows the suffix. Lines aren't broken, whatever the session's setting."""
    kinds = F.create_map(*[F.lit(x) for kv in MEDIA_TYPES.items() for x in kv])
    kind = F.coalesce(F.get(F.array(F.try_element_at(kinds, F.lower(F.substring_index(name, ".", -1)))), 0), F.lit("application/octet-stream"))
    return F.concat(F.lit("data:"), kind, F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def gib(size: Column) -> Column:
    return F.round(size / F.lit(float(1 << 30)), 2)
