"""JSON documents and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import small, stage
from .files import plain_path


def document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file (or each of several) that is one JSON document: an object gives a row, an array a row an element."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def elements(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The elements of a file that is one JSON array, with their position; the order in the file is the identity of a row."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", f"array<struct<{_inner(schema)}>>", {"mode": "FAILFAST"})).alias("position", "e")).select("position", "e.*")


def _inner(schema: str) -> str:
    return ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields)


def lines(spark: SparkSession, path: str | list[str], schema: str, strict: bool = False, recursive: bool = False) -> DataFrame:
    """JSON lines; blank lines are skipped and a line that can't be read is an error. strict: so is one that isn't an object.

    The error comes when rows are read.
    """
    corrupt = "_corrupt_record"
    reader = spark.read.schema(f"{schema}, {corrupt} string" if strict else schema).option("mode", "PERMISSIVE" if strict else "FAILFAST")
    if strict:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    if recursive:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl")
    df = reader.json(path)
    if not strict:
        return df
    file = F.col("_metadata.file_path")
    first = df.columns[0]
    checked = F.when(F.col(corrupt).isNotNull(), F.raise_error(F.concat(F.lit("not an object: "), file, F.lit(": "), F.col(corrupt))))
    return df.withColumn(first, F.coalesce(checked.cast(df.schema[first].dataType), F.col(first))).drop(corrupt)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(p) and files.getFileStatus(p).isDirectory()


def numbered_lines(spark: SparkSession, path: str, schema: str, raw: bool = False, ordinal: bool = False) -> DataFrame:
    """(file, line, error, row columns): JSON lines with their numbers from 1, blank lines counted but left out; unreadable ones have an error.
    raw: the line itself (column raw) comes too. ordinal: so does the place from 0 among all rows, by file and line.

    A folder's files are those named *.jsonl at any depth. Files are read in blocks by many tasks: the lines of a block are counted, those before it in its
    file give its first number, and inside a block lines follow one another by the identifiers that the scan gives them.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if _is_folder(spark, path):
        reader = reader.option("pathGlobFilter", "*.jsonl")
    read = reader.text(path).select(plain_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), F.col("value").alias("__text"))
    there = F.col("__text").rlike(r"(?U)\S")
    counts = read.groupBy(F.col("file").alias("__file"), F.col("__block").alias("__at")).agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("n"), F.count_if(there).alias("rows"))
    before = Window.partitionBy("__file").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    blocks = counts.withColumn("__base", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("__rows", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    if ordinal:
        per = counts.groupBy(F.col("__file").alias("__name")).agg(F.sum("rows").alias("__n"))
        places = per.select("__name", F.coalesce(F.sum("__n").over(Window.orderBy("__name").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__start"))  # a row a file
        blocks = blocks.join(places, F.col("__file") == F.col("__name")).withColumn("__rows", F.col("__rows") + F.col("__start"))
    blocks = small(stage(blocks.select("__file", "__at", "__first", "__base", "__rows")))  # written, so files are read twice in all
    met = read.where(there).join(blocks, (F.col("file") == F.col("__file")) & (F.col("__block") == F.col("__at")))
    lines_ = met.withColumn("line", (F.col("__base") + F.col("__id") - F.col("__first") + 1).cast("int"))
    if ordinal:
        lines_ = lines_.withColumn("ordinal", (F.col("__rows") + F.row_number().over(Window.partitionBy("file", "__block").orderBy("line")) - 1).cast("long"))
    extra = ["ordinal"] * ordinal
    rows = lines_.select("file", "line", *extra, F.col("__text").alias("raw"), F.from_json("__text", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("row"))
    return rows.select("file", "line", *extra, *["raw"] * raw, F.when(F.col("row").isNull() | F.col("row._bad").isNotNull(), F.lit("not a JSON object")).alias("error"), "row.*").drop("_bad")


def readable(rows: DataFrame) -> DataFrame:
    """The rows of numbered_lines without their column error; a row that has one is an error with its file and line."""
    if bad := rows.where("error is not null").orderBy("file", "line").select("file", "line", "error").first():
        raise ValueError(f"{bad['error']}: {bad['file']}:{bad['line']}")
    return rows.drop("error")


def described_objects(doc: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(image_id, file_name), (category_id, name) and the distinct (image_id, category_id) of an annotation document."""
    images = doc.select(F.inline("images")).toDF("image_id", "file_name")
    categories = doc.select(F.inline("categories")).toDF("category_id", "name")
    return images, categories, doc.select(F.inline("annotations")).distinct()


def motion_expressions(doc: DataFrame) -> DataFrame:
    """(video_id, frames, expression_id, expression) of a motion document."""
    videos = doc.select(F.explode("videos").alias("video_id", "v"))
    return videos.select("video_id", F.col("v.frames").alias("frames"), F.explode("v.expressions").alias("expression_id", "e")).select("video_id", "frames", "expression_id", F.col("e.exp").alias("expression"))


def annotation_files(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """One row a file that a glob matches, with its path (column file)."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(pattern).select("*", plain_path(F.col("_metadata.file_path")).alias("file"))
