import json

from pyspark.sql import functions as F

from frameloom.llm import common as C


def test_names(spark):
    rows = [("Refer-KITTI ",), ("00012/",), ("0",), ("000",), ("LM17_01",), (" - ",), ("",), (None,), ("Éa 1",)]
    df = spark.createDataFrame(rows, "v string")
    got = [tuple(r) for r in df.select(C.canon_name(F.col("v")), C.canon_entity(F.col("v"))).collect()]
    assert got == [("referkitti", "referkitti"), ("00012", "12"), ("0", "0"), ("000", "0"), ("lm1701", "lm1701"), (None, None), (None, None), (None, None), ("éa1", "éa1")]
    parts = spark.createDataFrame([("TRAINING",), (" valid",), ("validation",), ("Test",), (None,), ("demo",)], "v string").select(C.canon_split(F.col("v"))).collect()
    assert [r[0] for r in parts] == ["train", "val", "val", "test", None, "demo"]


def test_words(spark):
    rows = [("A sand-coloured, CAT…now – it's/on",), (None,), ("",), (" ...\n>  x",), ("中文 字",)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").select(C.words(F.col("v"))).collect()]
    assert got == [["a", "sandcoloured", "cat", "now", "its", "on"], [], [], ["x"], ["中文", "字"]]


def test_parsed(spark):
    good = {"messages": [{"role": "assistant", "content": "é"}], "images": ["a"], "x": 1}
    rows = [(1, json.dumps(good)), (2, json.dumps(good)[:-5]), (3, None), (4, "[]x"), (5, "{}")]
    got = {r.k: r.row for r in C.parsed(spark.createDataFrame(rows, "k int, j string"), "j", "row").collect()}
    assert got[1].messages[0].content == "é" and got[1].videos is None and got[2] is None and got[3] is None
    text = C.parsed(spark.createDataFrame(rows[:1], "k int, j string"), "j", "row", C.MESSAGES).select(C.assistant_text(F.col("row"))).first()[0]
    assert text == "é"


def test_hot_keys_and_lookup(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, F.lit(None)).otherwise((F.col("id") % 500).cast("string")).alias("k"))
    hot = C.hot_keys(rows, "k", share=0.1, least=10)
    assert [tuple(r) for r in hot.collect()] == [("hot", 1334)]
    table = spark.createDataFrame([("hot", 1), ("7", 2), ("absent", 3)], "k string, v int")
    for how in ("inner", "left"):
        assert sorted(map(str, C.lookup(rows, table, "k", hot, how).select("id", "k", "v").collect())) == sorted(map(str, rows.join(table, "k", how).select("id", "k", "v").collect()))
    assert C.hot_keys(rows.limit(0), "k").count() == 0 and C.hot_keys(rows, "k", share=0.9, least=10).count() == 0


def test_spread_join(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"))
    right = spark.range(60).select(F.col("id").alias("v"), F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    hot = C.hot_keys(left, "k", share=0.1, least=10)
    rows = lambda df: sorted((r.id, r.k, r.v) for r in df.collect())
    assert rows(C.spread_join(left, right, "k", hot)) == rows(left.join(right, "k")) == rows(C.spread_join(left, right, "k", hot.limit(0)))


def test_hot_from_a_fixed_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT_MOST", 100)
    df = spark.range(4000).select((F.col("id") % 30).cast("string").alias("k"))
    assert C.hot_keys(df, "k", share=0.5, least=10).count() == 30
