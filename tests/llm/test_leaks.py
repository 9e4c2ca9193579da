from collections import defaultdict

from frameloom.llm import leaks
from frameloom.session import read_table

DOCS = "doc_id long, text string, shingle long, item_id long, w string"
ITEMS = "item_id long, dataset string, item_text string, doc_id long, size int"


def w(a, b):
    return " ".join(f"word{i}" for i in range(a, b))


def test_passages(spark):
    items = [(1, "d", w(0, 40), 0, 0), (2, "d", w(100, 110), 0, 0), (3, "d", w(200, 209), 0, 0), (4, "d", None, 0, 0), (5, "d", "", 0, 0), (6, "e", w(0, 40), 0, 0), (7, "d", "a b a b a b a b a b a b", 0, 0)]
    docs = [
        (1, f"x {w(10, 20)} y"),
        (2, f"x {w(10, 19)} y {w(20, 29)}"),
        (3, w(100, 110).upper().replace(" ", ",\n> ")),
        (4, w(200, 209)),
        (5, None),
        (6, ""),
        (7, w(300, 9000) + " " + w(25, 40)),
        (8, "b a b a b a b a b a"),
        (9, "a b a b a b a b a"),
        (1, f"x {w(10, 20)} y"),
        (10, w(30, 40) + w(0, 5)),
        (11, w(31, 41)),
    ]
    got = {tuple(r) for r in leaks.leaks(spark.createDataFrame([(*d, None, None, None) for d in docs], DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == {(1, 1), (1, 6), (3, 2), (7, 1), (7, 6), (8, 7)} | set()
    assert leaks.leaks(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0
    assert leaks.leaks(spark.createDataFrame([(1, "a", None, None, None)], DOCS), spark.createDataFrame([], ITEMS)).count() == 0


def test_shuffle_path_gives_the_same(spark, data, monkeypatch):
    docs, items = read_table(spark, data, "documents"), read_table(spark, data, "benchmark_items")
    one = {tuple(r) for r in leaks.leaks(docs, items).collect()}
    monkeypatch.setattr(leaks, "small", lambda df: df)
    assert {tuple(r) for r in leaks.leaks(docs, items).collect()} == one


def test_against_brute_force(spark, data):
    from pyspark.sql import functions as F

    from frameloom.llm import common as C

    grams = defaultdict(set)
    for r in read_table(spark, data, "benchmark_items").select("item_id", C.words(F.col("item_text")).alias("w")).collect():
        for i in range(len(r.w) - 9):
            grams[tuple(r.w[i : i + 10])].add(r.item_id)
    expected = set()
    for r in read_table(spark, data, "documents").select("doc_id", C.words(F.col("text")).alias("w")).collect():
        for i in range(len(r.w) - 9):
            expected |= {(r.doc_id, x) for x in grams.get(tuple(r.w[i : i + 10]), ())}
    assert {tuple(r) for r in leaks.leaks(read_table(spark, data, "documents"), read_table(spark, data, "benchmark_items")).collect()} == expected
