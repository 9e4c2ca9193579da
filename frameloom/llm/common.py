"""What the operators on training data share: canonical spellings, words, parsed rows, joins safe from skew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = T.StructType(
    [
        T.StructField("messages", T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]))),
        T.StructField("images", T.ArrayType(T.StringType())),
        T.StructField("videos", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("_corrupt", T.StringType()),
    ]
)


def canon_name(c: Column) -> Column:
    """Letters and digits only, in lower case; null if none are left."""
    return F.nullif(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", ""), F.lit(""))


def canon_entity(c: Column) -> Column:
    """canon_name without the zeros that pad a number."""
    name = canon_name(c)
    return F.when(name.rlike(r"^\d+$"), F.regexp_replace(name, r"^0+(?=\d)", "")).otherwise(name)


def canon_split(c: Column) -> Column:
    name = canon_name(c)
    return F.when(name == "training", "train").when(name.isin("valid", "validation"), "val").otherwise(name)


def words(c: Column) -> Column:
    """Words apart from case and punctuation: dashes and slashes part words, other signs vanish; null gives none.

    A hyphen or apostrophe inside a word joins its parts.
    """
    spaced = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[‒-―…/|]+", " ")
    kept = F.regexp_replace(spaced, r"[^\p{L}\p{M}\p{N}\p{Z}\s]+", "")
    return F.filter(F.split(kept, r"[\p{Z}\s]+"), lambda w: w != "")


def parsed(df: DataFrame, c: str, name: str, schema: T.StructType = ROW) -> DataFrame:
    """df with the struct name in place of the JSON column c; null if that is null or can't be read.

    The parsed struct is a projection of its own, so that it isn't parsed again for each use.
    """
    rest = [x for x in df.columns if x != c]
    read = df.select(*rest, F.from_json(c, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("_row"))
    return read.select(*rest, F.when(F.col("_row")["_corrupt"].isNull(), F.col("_row")).alias(name))


def assistant_text(row: Column) -> Column:
    """The last assistant message of a parsed row."""
    said = F.filter(row["messages"], lambda m: m["role"] == "assistant")
    return F.try_element_at(said, F.lit(-1))["content"]


def digest(*c: Column) -> Column:
    """16 bytes that stand for the given strings."""
    return F.unhex(F.md5(F.concat_ws("\u0000", *c)))


#: The same, for operators that need the messages only.
MESSAGES = T.StructType([ROW["messages"], ROW["_corrupt"]])

#: A key is hot if it has this share of all rows, and HOT_ROWS at least, but always from HOT_MOST rows, which one task can hold. So at most
#: 1 / HOT_SHARE or rows / HOT_MOST keys are hot, which bounds what is broadcast: 100,000 keys at 10^11 rows.
HOT_SHARE, HOT_ROWS, HOT_MOST = 0.001, 5_000, 1_000_000
#: Partial counts of key buckets find the few buckets that can hold a hot key.
BUCKETS = 1 << 14


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, least: int = HOT_ROWS) -> DataFrame:
    """The hot keys of df with their exact counts (columns: key, n).

    First the rows of each of BUCKETS hash buckets are counted (map-side partial counts, so BUCKETS rows a task leave it);
    a hot key can only lie in a bucket with as many rows, so exact counts are made for the keys of those buckets alone.
    Null keys are never hot.
    """
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS))
    there = df.where(F.col(key).isNotNull())
    floor = min(least, HOT_MOST)
    counts = there.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") >= floor, F.struct("b", "n"))).alias("large")).first()  # at most BUCKETS
    limit = min(max(least, int(share * (counts["n"] or 0))), max(least, HOT_MOST))
    heavy = [r["b"] for r in counts["large"] if r["n"] >= limit]
    if not heavy:
        return there.select(key).limit(0).withColumn("n", F.lit(0).cast("long"))
    return there.where(bucket.isin(heavy)).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= limit)


def lookup(rows: DataFrame, table: DataFrame, key: str, hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with table (one row a key) on key, safe from hot keys.

    hot: what hot_keys(rows, key) gave. Rows of hot keys meet the few matching rows of the table by broadcast, which its bound
    allows; the others are shuffled.
    """
    few = F.broadcast(hot.select(key))
    if hot.isEmpty():
        return rows.join(table, key, how)
    cold = rows.join(few, key, "left_anti").join(table, key, how)
    return cold.unionByName(rows.join(few, key, "left_semi").join(F.broadcast(table.join(few, key, "left_semi")), key, how))


#: Cells into which the rows of a hot key are spread on each side of spread_join.
CELLS = 8


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """left joined with right on key, of which both sides may have many rows, safe from hot keys.

    hot: keys that are hot on either side (its column key). Rows of those get one of CELLS places by a hash of the row and are repeated over the CELLS
    places of the other side, so each pair meets in exactly one of CELLS * CELLS tasks. Other columns need different names.
    """
    if hot.isEmpty():
        return left.join(right, key)
    few = F.broadcast(hot.select(key).distinct().withColumn("__hot", F.lit(True)))

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(CELLS)).cast("int")
        met = df.join(few, key, "left").withColumn(own, F.when(F.col("__hot"), place).otherwise(0))
        return met.withColumn(other, F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(CELLS - 1))).otherwise(F.array(F.lit(0))))).drop("__hot")

    return placed(left, "__l", "__r").join(placed(right, "__r", "__l"), [key, "__l", "__r"]).drop("__l", "__r")
