import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from frameloom.operators import assemble, bundle, infer, quality, sampling
from frameloom.sources import schemas

MESSAGES = schemas.MESSAGES


def said(user, assistant, system="s"):
    return [("system", system), ("user", user), ("assistant", assistant)]


def test_top_by_group_is_exact_for_hot_groups(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"))
    got = sampling.top_by_group(df, ["g"], [F.col("id").desc()], 4).collect()
    expected = defaultdict(list)
    for i in range(4999, -1, -1):
        g = "hot" if i % 3 == 0 else str(i % 50)
        if len(expected[g]) < 4:
            expected[g].append(i)
    by = defaultdict(dict)
    for r in got:
        by[r.g][r["rank"]] = r.id
    assert {g: [m[k] for k in sorted(m)] for g, m in by.items()} == expected


def test_hash_rank_equals_one_window(spark):
    df = spark.range(3000).select("id", (F.col("id") % 4).alias("g")).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    key = sampling.shuffle_key(1, F.col("id"))
    got = {r.id: r["rank"] for r in sampling.hash_rank(df, key, ["id"], ["g"]).collect()}
    from pyspark.sql import Window

    plain = {r.id: r.x for r in df.withColumn("x", F.row_number().over(Window.partitionBy("g").orderBy(key, "id"))).collect()}
    assert got == plain


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(800).select("id", (F.col("id") % 7).alias("g"))
    for pick in (lambda d: sampling.seeded_topk(d, "id", 20), lambda d: sampling.unique_first(d, "g", "id", 30), lambda d: sampling.round_robin(d, "g", "id", 25), lambda d: sampling.quota_sample(d, "g", "id", {1: 3, 2: 90, 9: 1})):
        assert sorted(map(tuple, pick(df).collect())) == sorted(map(tuple, pick(df.repartition(13)).collect()))


def test_round_robin_equals_the_loop(spark):
    rows = [(i, "abcde"[min(i % 9, 4)]) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, g string")
    members = defaultdict(list)
    import hashlib

    key = lambda *v: hashlib.sha1(":".join(map(str, v)).encode()).hexdigest()
    for i, g in rows:
        members[g].append(i)
    order = sorted(members, key=lambda g: key(42, g))
    for g in members:
        members[g].sort(key=lambda i: key(42, g, i))
    turns = [members[g][d] for d in range(100) for g in order if d < len(members[g])]
    for k in (1, 7, 99, 500):
        assert [r.id for r in sampling.round_robin(df, "g", "id", k).orderBy("rank").collect()] == turns[:k]
    kept = [i for i in turns if i % 2]
    assert [r.id for r in sampling.round_robin(df, "g", "id", 20, keep=F.col("id") % 2 == 1).orderBy("rank").collect()] == kept[:20]


def test_unique_first(spark):
    df = spark.createDataFrame([(i, "xxyxz"[i]) for i in range(5)], "id long, image string")
    got = sampling.unique_first(df, "image", "id", 4).orderBy("rank").collect()
    assert {r.image for r in got[:3]} == set("xyz") and got[3].image == "x"
    assert sampling.unique_first(df, "image", "id", None).count() == 5 == sampling.unique_first(df, "image", "id", 9).count()


def test_exact_permutation(spark):
    order = list(range(200))
    random.Random(7).shuffle(order)
    got = sampling.exact_permutation(spark.range(200).withColumnRenamed("id", "ordinal"), "ordinal", 200, 7).orderBy("shuffled").collect()
    assert [r.ordinal for r in got] == order
    with pytest.raises(ValueError):
        sampling.exact_permutation(spark.range(1), "id", 10**9, 1)


def test_prefix_groups_drop_equal_ones(spark):
    df = spark.createDataFrame([("s", [str(i) for i in range(10)]), ("e", []), ("n", None)], "sequence string, frames array<string>")
    assert [(r.scale, r.endpoint) for r in sampling.prefix_groups(df, "sequence", "frames", ("wide", "long")).collect()] == [("wide", 4)]
    assert sampling.prefix_groups(df, "sequence", "frames", ("wide", "long", "full"), 3).count() > 3


def test_window_variants(spark):
    df = spark.createDataFrame([("a", list(range(300))), ("b", [1, 2, 3]), ("c", [])], "k string, ids array<int>")
    got = defaultdict(list)
    for r in sampling.window_variants(df, "k", "ids", 4).orderBy("k", "variant").collect():
        got[r.k].append(r.chosen)
    assert len(got["a"]) == 4 and all(len(x) == 6 and x == sorted(set(x)) for x in got["a"]) and got["a"][0] == [0, 60, 120, 179, 239, 299]
    assert got["b"] == [[1, 2, 3]] and got["c"] == [[]]
    with pytest.raises(ValueError):
        sampling.variants_per(5, 0)
    assert sampling.variants_per(10, 4) == 3 and sampling.variants_per(0, 4) == 1


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id long, g string, rank int")
    base = df.drop("rank")
    assert sampling.seeded_topk(base, "id", 3).count() == sampling.round_robin(base, "g", "id", 3).count() == sampling.unique_first(base, "g", "id", 3).count() == assemble.global_order(base, ["id"]).count() == 0


def test_make_row_and_order(spark):
    df = spark.createDataFrame([("d3", " a red car　", ["/a.jpg"], None), ("mevis", "moves", None, ["/1.jpg", "/2.jpg"])], "dataset string, text string, images array<string>, frames array<string>")
    rows = df.select(assemble.make_row(F.col("dataset"), F.col("text"), F.col("images"), F.col("frames")).alias("r")).select("r.*", F.to_json("r").alias("j")).collect()
    assert [m.role for m in rows[0].messages] == ["system", "user", "assistant"] and rows[0].messages[2].content == "a red car"
    assert rows[0].videos is None and '"videos"' not in rows[0].j and rows[1].videos == [["/1.jpg", "/2.jpg"]] and rows[1].images is None
    ordered = assemble.global_order(spark.range(1000), ["id"]).collect()
    assert sorted(r.ordinal for r in ordered) == list(range(1000))
    assert Counter(assemble.by_dataset(df).select("samples").rdd.map(lambda r: r[0]).collect()) == {1: 2, 2: 1}


def test_row_errors(spark):
    rows = [
        (1, said("<image>q", "a"), ["x.jpg"], None),
        (2, said("q", " "), ["x.jpg"], None),
        (3, [("user", "q")], None, None),
        (4, None, None, None),
        (5, [("user", "<video>q"), ("assistant", "a")], None, [["x.jpg", "y.jpg"]]),
        (6, [("assistant", "a"), ("user", "q")], [], []),
        (7, said(None, None), None, None),
    ]
    df = spark.createDataFrame(rows, f"id long, messages {MESSAGES}, images array<string>, videos array<array<string>>")
    files = spark.createDataFrame([("x.jpg",)], "path string")
    got = {r.id: r.errors for r in quality.checked(df, "id", files).collect()}
    assert got[1] == [] and got[3] == got[4] == ["no list of at least two messages"] and got[5] == ["media not found: y.jpg"]
    assert got[2] == ["no answer", "0 marks for images, but 1 images"]
    assert got[6] == ["roles out of order: assistant,user"] and got[7] == ["no answer"]
    report = quality.check_report(quality.checked(df, "id", files).withColumn("file", F.lit("f")), "file", "id", 2).first()
    assert report["rows"] == 7 and report["error_rows"] == 6 and len(report["errors"]) == 2 and report["errors"][0].startswith("2: ")
    with pytest.raises(ValueError):
        quality.assert_no_errors(spark.createDataFrame([report], quality.check_report(quality.checked(df, "id").withColumn("file", F.lit("f")), "file", "id").schema))


def test_extraction(spark):
    df = spark.createDataFrame([(None, " p ", said("q", " old ") + [("assistant", "new ")]), (" ", None, said("q", "m")), (None, None, None)], f"response string, output string, messages {MESSAGES}")
    assert [r[0] for r in df.select(quality.prediction_text(df)).collect()] == ["p", "m", None]
    assert [r[0] for r in df.select(quality.prediction_text(df, "response")).collect()] == [None, "", None]
    assert [r[0] for r in df.select(quality.reference_text(df)).collect()] == ["new", "m", None]
    assert df.select(quality.message_first(F.col("messages"), "assistant")).first()[0] == " old "
    with pytest.raises(Exception, match="no prediction"):
        df.select(quality.prediction_text(df, strict=True)).collect()


def test_pairing_and_summary(spark):
    p, r = spark.createDataFrame([(0, "a b."), (1, "(1, 2)")], "ordinal long, prediction string"), spark.createDataFrame([(1, "x"), (0, "y")], "ordinal long, reference string")
    rows = quality.evaluated(quality.paired(p, r)).withColumns({"bertscore_f1": F.lit(0.5)})
    s = quality.summary(rows).first()
    assert (s.num_samples, s.format_success_count, s.format_failure_count, s.format_success_rate, s.bertscore_f1) == (2, 1, 1, 0.5, 0.5)
    assert quality.summary(rows.limit(0)).first().format_success_rate == 0.0
    with pytest.raises(Exception, match="differ"):
        quality.paired(p, r.limit(1)).collect()


def test_greedy_match(spark):
    df = spark.createDataFrame([([[1.0, 0.0], [0.0, 2.0]], [[3.0, 0.0]]), ([], [[1.0]]), ([[0.0, 0.0]], [[1.0, 0.0]])], "c array<array<double>>, r array<array<double>>")
    got = [tuple(x[0]) for x in df.select(quality.greedy_match(F.col("c"), F.col("r"))).collect()]
    assert got[0] == (0.5, 1.0, pytest.approx(2 / 3)) and got[1][0] is None and got[2] == (0.0, 0.0, 0.0)


def test_bundle_round_trip(spark):
    rows = spark.createDataFrame([(1, ["/a/x.jpg", "/a/x.jpg"], None), (2, None, [["/b/1.jpg", "/b/2.jpg"], ["/a/x.jpg"]]), (3, [], [])], "id long, images array<string>, videos array<array<string>>")
    entries = bundle.manifest(bundle.references(rows, "id"), spark.createDataFrame([("/a/x.jpg", 5), ("/b/1.jpg", 7)], "path string, size long"))
    got = {r.source_path: (r.reference_count, r.size_bytes) for r in entries.collect()}
    assert got == {"/a/x.jpg": (3, 5), "/b/1.jpg": (1, 7), "/b/2.jpg": (1, None)}
    back = bundle.restored(bundle.packed(rows), "id", entries).orderBy("id").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in rows.orderBy("id").collect()]
    assert bundle.missing_bytes(entries, entries.where("source_path = '/b/1.jpg'").select(F.col("bundle_path").alias("path"))).first().asDict() == {"files": 2, "missing": 5}
    with pytest.raises(OSError):
        bundle.require_space(entries, entries.limit(0).select(F.col("bundle_path").alias("path")), "/", free=3)
    files = spark.createDataFrame([("/root/data/a.jpg",), ("/root/b.jpg",), ("/c.jpg",)], "path string")
    paths = spark.createDataFrame([("a.jpg",), ("b.jpg",), ("/c.jpg",), ("d.jpg",), ("/d.jpg",)], "path string")
    found = {r.path: r.source for r in bundle.resolved(paths, files, [F.lit("/root/data/"), F.lit("/root")]).collect()}
    assert found == {"a.jpg": "/root/data/a.jpg", "b.jpg": "/root/b.jpg", "/c.jpg": "/c.jpg", "d.jpg": None, "/d.jpg": None}


def test_publish(spark, tmp_path):
    for name, text in (("a.txt", "one"), ("b.txt", "three")):
        (tmp_path / name).write_text(text)
    rows = spark.createDataFrame([(1, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")], None)], "id long, images array<string>, videos array<array<string>>")
    entries = bundle.manifest(bundle.references(rows, "id"))
    root = str(tmp_path / "out")
    assert {r.action for r in bundle.publish(entries, root, checksum=True).collect()} == {"placed"}
    assert {(r.action, r.size_bytes) for r in bundle.publish(entries, root).collect()} == {("kept", 3), ("kept", 5)}
    (tmp_path / "a.txt").write_text("other")
    with pytest.raises(Exception, match="differs"):
        bundle.publish(entries, root).collect()
    assert bundle.publish(entries, root, repair=True).where("action = 'placed'").count() == 1


def test_requests(spark):
    rows = spark.createDataFrame([(0, said(" <image> look <video><image>", "a"), ["i1", "i2"], [["f1", "f2"]]), (1, said("only text", "b", ""), None, None)], f"ordinal long, messages {MESSAGES}, images array<string>, videos array<array<string>>")
    got = rows.select(infer.request_messages(F.col("messages"), F.col("images"), F.col("videos")).alias("r")).collect()
    assert [p.type for p in got[0].r.user] == ["image_url", "text", "video", "image_url"] and got[0].r.user[1].text == "look" and got[0].r.user[3].image_url.url == "i2" and got[0].r.user[2].video == ["f1", "f2"]
    assert got[1].r.system is None and got[1].r.user[0].text == "only text"
    with pytest.raises(Exception, match="placeholders"):
        rows.select(infer.request_messages(F.col("messages"), F.array(F.lit("i1")), F.col("videos")).alias("r")).collect()


def test_predictions_retry_and_resume(spark):
    rows = spark.createDataFrame([(i, said(f"text {i}", f"a{i}"), None, None, "src") for i in range(4)], f"ordinal long, messages {MESSAGES}, images array<string>, videos array<array<string>>, source string")
    calls = []

    def shaky(system, user):
        calls.append(1)
        if len(calls) % 2:
            raise OSError("try again")
        return {"response": user[0]["text"].upper()}

    got = infer.predicted(rows.coalesce(1), "ordinal", shaky, "m", retries=2, wait=0.0).orderBy("index").collect()
    assert [(r["index"], r.response, r.reference, r.usage, r.source) for r in got][2] == (2, "TEXT 2", "a2", None, "src")
    done = spark.createDataFrame([(0,), (1,)], "index long")
    assert infer.contiguous(done, 4) == 2 and {r.ordinal for r in infer.still_to_do(rows, done, "ordinal").collect()} == {2, 3} and infer.contiguous(done.limit(0)) == 0
    for bad in ([(0,), (2,)], [(0,), (0,)], [(1,)]):
        with pytest.raises(ValueError):
            infer.contiguous(spark.createDataFrame(bad, "index long"))
    with pytest.raises(ValueError):
        infer.contiguous(done, 1)
    assert infer.head_rows(rows, "ordinal", 3).count() == 3 and infer.head_rows(rows, "ordinal", None).count() == 4
    turns = spark.createDataFrame([(1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "r"), (1, 4, "user", "s")], "c long, t long, role string, text string")
    assert [(r.question, r.answer) for r in quality.next_turn(turns, "c", "t", "role", "text").orderBy("t").collect()] == [("q", "a"), ("r", None), ("s", None)]
