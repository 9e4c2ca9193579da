"""Hashes that decide splits, names and seeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_fraction(value: Column, seed: int = 42) -> Column:
    """A number in [0, 1): the first 8 bytes of SHA-1 over "seed:value", as a share of 2^64. Null for a null value."""
    first = F.substring(F.sha1(F.concat(F.lit(f"{seed}:"), value.cast("string"))), 1, 16)
    return F.conv(first, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def split_for_group(group: Column, seed: int = 42, ratio: float = 0.1) -> Column:
    """val if the group's fraction is below ratio, else train, so that a group is never parted."""
    return F.when(hash_fraction(group, seed) < ratio, "val").when(group.isNotNull(), "train")


def sha1_prefix(value: Column, digits: int) -> Column:
    return F.substring(F.sha1(value.cast("string")), 1, digits)


def sha1_seed(value: Column, base: int = 0) -> Column:
    """base plus the first 8 hexadecimal digits of SHA-1 as a number."""
    return F.conv(sha1_prefix(value, 8), 16, 10).cast("long") + F.lit(base)


def python_float(x: Column) -> Column:
    """A double as Python writes it: plain between 1e-4 and 1e16, else with a two-digit exponent.

    The digits are those of the JVM, which has one more than needed for some values beyond 1e16 before Java 19.
    """
    raw = x.cast("string")
    mantissa = F.regexp_extract(raw, r"^(-?[\d.]+)E(-?\d+)$", 1)
    power = F.regexp_extract(raw, r"^(-?[\d.]+)E(-?\d+)$", 2)
    digits = F.regexp_replace(mantissa, r"[-.]", "")
    digits = F.regexp_replace(digits, r"(?<=\d)0+$", "")
    sign = F.when(raw.startswith("-"), "-").otherwise("")
    n = power.try_cast("int")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), F.greatest(-n - 1, F.lit(0))), digits)
    large = F.concat(sign, F.when(F.length(digits) > n + 1, F.concat(F.substring(digits, F.lit(1), n + 1), F.lit("."), F.substring(digits, n + 2, F.lit(40)))).otherwise(F.concat(F.rpad(digits, n + 1, "0"), F.lit(".0"))))
    lead = F.concat(F.substring(digits, 1, 1), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), F.lit(40)))).otherwise(""))
    far = F.concat(sign, lead, F.lit("e"), F.when(n < 0, "-").otherwise("+"), F.when(F.abs(n) < 10, F.concat(F.lit("0"), F.abs(n).cast("string"))).otherwise(F.abs(n).cast("string")))
    return F.when(mantissa == "", raw).when((n >= -4) & (n < 0), small).when((n >= 0) & (n < 16), large).otherwise(far)


def template_id(index: Column, image: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """The identifier of a cut-out: position in its file and 10 digits of a hash over position, image and box."""
    box = F.concat(F.lit("("), F.concat_ws(", ", *[python_float(v) for v in (x, y, w, h)]), F.lit(")"))
    return F.concat(F.lit("sorec_"), F.format_string("%06d", index), F.lit("_"), sha1_prefix(F.concat_ws(":", index.cast("string"), image, box), 10))


def safe_basename(name: Column) -> Column:
    """Letters, digits, dots, underscores and hyphens stay, other signs become underscores; the last 120 signs; media.bin for none."""
    clean = F.right(F.regexp_replace(name, r"(?U)[^\p{IsAlphabetic}\p{N}._-]", "_"), F.lit(120))
    return F.coalesce(F.nullif(clean, F.lit("")), F.lit("media.bin"))


def normal_path(path: Column) -> Column:
    """An absolute path without empty and . steps, each .. taken back with the step before it; links aren't followed."""
    steps = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda a, x: F.when(x.isin("", "."), a).when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(x))),
    )
    return F.concat(F.lit("/"), F.array_join(steps, "/"))


def bundle_path(source: Column, name: Column | None = None) -> Column:
    """Where a media file lies in a bundle: two folder levels and a name from the digest of its source path."""
    digest = F.sha2(source, 256)
    base = F.substring_index(source, "/", -1) if name is None else name
    return F.concat(F.lit("media/files/"), F.substring(digest, 1, 2), F.lit("/"), F.substring(digest, 1, 20), F.lit("_"), safe_basename(base))
