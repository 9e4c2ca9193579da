import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from frameloom import functions as X


def one(spark, schema, rows, *exprs):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*exprs).collect()]


def test_hash_fraction_and_split(spark):
    got = one(spark, "v string", [("g1",), (None,), ("",)], X.hash_fraction(F.col("v")), X.split_for_group(F.col("v")))
    assert got[0] == (0.19917135646004325, "train") and got[1] == (None, None)
    values = [f"k{i}" for i in range(200)]
    expected = [int.from_bytes(hashlib.sha1(f"42:{v}".encode()).digest()[:8], "big") / 2**64 for v in values]
    assert [r[0] for r in one(spark, "v string", [(v,) for v in values], X.hash_fraction(F.col("v")))] == expected
    seeds = one(spark, "v string", [(v,) for v in values], X.sha1_seed(F.col("v"), 42))
    assert seeds[5][0] == 42 + int(hashlib.sha1(b"k5").hexdigest()[:8], 16)


@pytest.mark.parametrize("count", [5, 6])
def test_even_sample_matches_python(spark, count):
    rows = [(n,) for n in range(0, 400)]
    got = one(spark, "n int", rows, X.even_positions(F.col("n"), count))
    for (n,), (places,) in zip(rows, got, strict=True):
        assert places == (list(range(n)) if n <= count else [round(i * (n - 1) / (count - 1)) for i in range(count)])
    assert one(spark, "a array<string>", [(list("abcdefgh"),), ([],), (None,)], X.even_sample(F.col("a"), 5)) == [(["a", "c", "e", "f", "h"],), ([],), (None,)]


def test_prefix_sample(spark):
    frames = list(range(12))
    got = one(spark, "a array<int>, r double", [(frames, 0.15), (frames, 0.5), (frames, 1.0)], X.prefix_endpoint(F.size("a"), F.col("r")), X.prefix_sample(F.col("a"), F.col("r")))
    assert got == [(4, [0, 1, 2, 3, 4]), (6, [0, 2, 3, 4, 6]), (11, [0, 3, 6, 8, 11])]
    assert one(spark, "x int", [(1,)], X.even_values(0.1, 0.25, 1), X.even_values(0.0, 1.0, 5)) == [([0.175], [0.0, 0.25, 0.5, 0.75, 1.0])]


def test_active_keys(spark):
    got = one(spark, "m map<string,array<bigint>>", [({"10": [1], "9": [2], "3": [], "4": None},), ({},), (None,)], X.active_keys(F.col("m")))
    assert got == [([9, 10],), ([],), (None,)]


def test_boxes(spark):
    rows = [("0,0,10,0,10,5,0,5",), ("1 2\t3,4",), ("1 2 0 4",), ("1 2 3",), ("nan 1 2 3",), ("inf,1,2,3",), ("",), (None,), ("a b c d",)]
    got = [tuple(r[0]) if r[0] else None for r in one(spark, "s string", rows, X.parse_box(F.col("s"), strict=False))]
    assert got == [(0, 0, 10, 5), (1, 2, 3, 4), None, None, None, None, None, None, None]
    with pytest.raises(Exception, match="no box"):
        one(spark, "s string", [("1 2 0 4",)], X.parse_box(F.col("s")))


def test_crops(spark):
    rows = [(100, 80, 10.0, 10.0, 20.0, 10.0, 2), (100, 80, 90.0, 70.0, 20.0, 10.0, 2), (100, 80, 10.5, 10.5, 5.0, 5.0, 3)]
    for row, expected in zip(rows, [(0, 0, 40, 40), (60, 40, 100, 80), (5, 5, 21, 21)], strict=True):
        c = X.square_crop(*[F.col(k) for k in ("iw", "ih", "x", "y", "bw", "bh")], row[-1])
        assert tuple(one(spark, "iw int, ih int, x double, y double, bw double, bh double", [row[:-1]], c)[0][0]) == expected


def test_crop_lies_in_the_image(spark):
    rng = random.Random(4)
    rows = [(rng.randint(2, 3000), rng.randint(2, 3000), rng.uniform(0, 3000), rng.uniform(0, 3000), rng.uniform(0.1, 3000), rng.uniform(0.1, 3000)) for _ in range(500)]
    c = X.square_crop(*[F.col(k) for k in ("iw", "ih", "x", "y", "bw", "bh")], 2.0)
    for (iw, ih, *_), (crop,) in zip(rows, one(spark, "iw int, ih int, x double, y double, bw double, bh double", rows, c), strict=True):
        assert 0 <= crop[0] < crop[2] <= iw and 0 <= crop[1] < crop[3] <= ih


def test_text_measures(spark):
    texts = ["well-to-do don't", "3.5 m tall. Red", "...", "", None, "One. Two! Three?  ", "a masked man", "A mask.", "at (1, 2)", "at (1, 2, 3)", "at (1,2,3,4)", "trackids", "track-id", "bounding box", "bounding boxes", "émask", "中文", "[1]", " \t", "word " * 81]
    rows = [(t,) for t in texts]
    measured = one(spark, "t string", rows, X.word_count(F.col("t")), X.sentence_count(F.col("t")), X.format_reasons(F.col("t")), X.format_reasons(F.col("t"), strict=True))
    by = dict(zip(texts, measured, strict=True))
    assert by["well-to-do don't"][0] == 3 and by["3.5 m tall. Red"][1] == 2 and by["..."][1] == 1 and by[""][1] == 0
    assert by[None][2] == by[""][2] == by[" \t"][2] == ["empty"] and by["One. Two! Three?  "][2] == ["too_many_sentences"]
    for text in ("A mask.", "at (1, 2)", "at (1,2,3,4)", "trackids", "bounding boxes"):
        assert by[text][2] == ["forbidden_annotation_output"]
    for text in ("a masked man", "at (1, 2, 3)", "track-id", "bounding box", "émask"):
        assert by[text][2] == []
    assert by["bounding box"][3] == ["forbidden_annotation_output"] and by["中文"][2] == ["non_english"] and by["[1]"][2] == ["json_like"] and by["word " * 81][2] == ["too_long"]


def test_natural_key(spark):
    names = ["img10", "IMG2", "a-", "a1", "x", "2b", "10b", "", "007", "7", "img"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r.n for r in df.orderBy(X.natural_key(F.col("n")), "n").collect()]
    key = lambda s: [int(p) if p.isdigit() else p.lower() for p in re.split(r"(\d+)", s)]
    python = sorted(names, key=lambda s: (key(s), s))
    assert [g for g in got if g not in ("a-",)] == [p for p in python if p not in ("a-",)] and got.index("a1") < got.index("a-")


def test_paths(spark):
    p = F.col("p")
    got = one(spark, "p string", [("/r/seq_a/file_01.tar.JPG",), ("plain",), (".hidden",)], X.path_stem(p), X.path_parent(p), X.path_suffix(p), X.without_last_part(X.path_stem(p)), X.relative_path(p, "/r/"), X.under_segment(p, "seq_a"))
    assert got[0] == ("file_01.tar", "seq_a", ".jpg", "file", "seq_a/file_01.tar.JPG", True) and got[1] == ("plain", "plain", "", "plain", "plain", False) and got[2][0] == ".hidden"
    assert one(spark, "i long", [(7,), (1234567,)], X.numbered_frame(F.col("i"), ".png")) == [("000007.png",), ("1234567.png",)]


def test_bundle_paths(spark):
    got = one(spark, "p string", [("/a/ü b?.jpg",), ("/a/",), ("/x/" + "y" * 200,)], X.bundle_path(F.col("p")))
    digest = hashlib.sha256("/a/ü b?.jpg".encode()).hexdigest()
    assert got[0][0] == f"media/files/{digest[:2]}/{digest[:20]}_ü_b_.jpg" and got[1][0].endswith("_media.bin") and got[2][0].endswith("_" + "y" * 120)


def test_python_float(spark):
    rng = random.Random(5)
    values = [0.0, -0.0, 1.0, 505.3, 1e7, 12345678.5, 5e-4, 1.5e-5, -2.25e-7, 1e15, 1e16, 1e22, 123456789012.25, 0.0001] + [round(rng.uniform(-5000, 5000), 3) for _ in range(300)] + [round(rng.uniform(0, 1) * 10.0 ** rng.randint(-8, 12), 12) for _ in range(300)]
    assert [r[0] for r in one(spark, "x double", [(v,) for v in values], X.python_float(F.col("x")))] == [repr(v) for v in values]


def test_small_ones(spark):
    got = one(spark, "t string", [("a<image>b<image><video>",)], X.count_of(F.col("t"), "<image>"), X.placeholder_tokens(F.col("t")), X.html_escape(F.lit("<a href='x'>&\"")))
    assert got == [(2, ["a", "<image>", "b", "<image>", "<video>"], "&lt;a href=&#x27;x&#x27;&gt;&amp;&quot;")]
    url = one(spark, "b binary", [(b"x" * 300,)], X.to_data_url(F.lit("a.PNG"), F.col("b")), X.to_data_url(F.lit("a.zzz"), F.col("b")))[0]
    assert url[0].startswith("data:image/png;base64,") and "\n" not in url[0] and url[1].startswith("data:application/octet-stream;")
