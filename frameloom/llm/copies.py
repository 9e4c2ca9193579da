"""Problem 6: records that differ only in formatting.

Method: hot canonical keys are detected exactly from partial counts and aggregated in two levels (salted first, then by key);
all other keys take a one-level shuffle. The representative of a class is its smallest identifier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from . import common as C

#: Parts into which the rows of one hot key are spread.
SALTS = 64


def letters(c: Column) -> Column:
    """Letters and digits in order, ignoring case."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", "")


def sample_content(row: Column) -> Column:
    """What makes two parsed samples copies: images, videos and, by role, letters and digits of the messages; field order doesn't count.

    Null for null or unreadable JSON, and for rows without any message, image or video.
    """
    said = F.array_sort(F.transform(F.coalesce(row["messages"], F.array()), lambda m, i: F.struct(F.coalesce(m["role"], F.lit("")).alias("role"), i.alias("i"), letters(m["content"]).alias("said"))))
    empty = (F.coalesce(F.size(row["messages"]), F.lit(0)) < 1) & (F.coalesce(F.size(row["images"]), F.lit(0)) < 1) & (F.coalesce(F.size(row["videos"]), F.lit(0)) < 1)
    parts = F.struct(F.transform(said, lambda m: F.struct(m["role"], m["said"])).alias("m"), F.coalesce(row["images"], F.array()).alias("i"), F.coalesce(row["videos"], F.array()).alias("v"))
    return F.when(row.isNotNull() & ~empty, F.to_json(parts))


def template_content(source_image: Column, source_text: Column) -> Column:
    """Null if the text is null or has no letter or digit; a null image equals only a null image."""
    said = letters(source_text)
    return F.when(said != "", F.to_json(F.struct(source_image.alias("i"), said.alias("t")), {"ignoreNullFields": "false"}))


def keyed(df: DataFrame, table: str, key: str, content: Column) -> DataFrame:
    """(table_name, key, content): one row a record that can have copies; content as 16 bytes."""
    made = df.select(F.lit(table).alias("table_name"), F.col(key).cast("long").alias("key"), content.alias("content")).where(F.col("content").isNotNull() & F.col("key").isNotNull())
    return made.withColumn("content", C.digest(F.lit(table), F.col("content")))


def classes(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """(content, table_name, keep_key, copies) of keyed rows: one row a class, copies counting the kept record too."""
    few = F.broadcast(hot.select("content"))
    made = [F.min("keep_key").alias("keep_key"), F.sum("copies").alias("copies")]
    first = [F.min("key").alias("keep_key"), F.count(F.lit(1)).alias("copies")]
    cold = rows.join(few, "content", "left_anti").groupBy("content", "table_name").agg(*first)
    salted = rows.join(few, "content", "left_semi").groupBy("content", "table_name", F.pmod(F.xxhash64("key"), F.lit(SALTS)).alias("salt")).agg(*first)
    return cold.unionByName(salted.groupBy("content", "table_name").agg(*made))


def copies(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """(table_name, keep_key, copy_key): one row for each record that isn't its class's smallest.

    A cold key's rows meet in one shuffle, where a window gives the smallest identifier; a hot key's rows stay where they are and
    meet their class's representative by broadcast (at most 1 / HOT_SHARE of them).
    """
    few = F.broadcast(hot.select("content"))
    least = F.min("key").over(Window.partitionBy("content", "table_name"))
    cold = rows.join(few, "content", "left_anti").withColumn("keep_key", least)
    warm = rows.join(few, "content", "left_semi")
    kept = classes(warm, hot).select("content", "keep_key")
    spread = warm.join(F.broadcast(kept), "content")
    both = cold.select("table_name", "keep_key", "key").unionByName(spread.select("table_name", "keep_key", "key"))
    return both.where(F.col("key") != F.col("keep_key")).select("table_name", "keep_key", F.col("key").alias("copy_key"))


def prepare(built: DataFrame, templates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keyed rows of both tables, staged so that JSON is parsed once, and their hot keys."""
    rows = stage(
        keyed(C.parsed(built.select("sample_key", "row_json"), "row_json", "row"), "built_samples", "sample_key", sample_content(F.col("row"))).unionByName(
            keyed(templates, "template_records", "record_id", template_content(F.col("source_image"), F.col("source_text")))
        )
    )
    return rows, C.hot_keys(rows, "content").select("content", "n")


def find_copies(built: DataFrame, templates: DataFrame) -> DataFrame:
    """(table_name, keep_key, copy_key).

    Null, blank or unreadable contents have no copies; identifiers are unique, and rows that recur with the same identifier count as
    one record here. Empty tables give no rows. Extra columns are ignored.
    """
    return copies(*prepare(built, templates))


def collapse(built: DataFrame, templates: DataFrame) -> DataFrame:
    """(table_name, keep_key, copies): one row a class of equal records, with the number of its records."""
    rows, hot = prepare(built, templates)
    return classes(rows, hot).select("table_name", "keep_key", "copies")
