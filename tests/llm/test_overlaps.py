import itertools
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from frameloom.llm import common as C
from frameloom.llm import overlaps
from frameloom.session import read_table

BUILT = "sample_key long, dataset string, sample_id string, split string, row_json string, text string, class string"
TEMPLATES = "record_id long, sample_id string, source_text string, key long"


def said(text):
    return json.dumps({"messages": [{"role": "assistant", "content": text}]})


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=14), st.lists(st.sampled_from("abcd"), max_size=14), st.integers(0, 6))
def test_edits_within(a, b, limit):
    assert overlaps.edits_within(a, b, limit) == (distance(a, b) <= limit)


@pytest.mark.parametrize("n", range(overlaps.LEAST, 200))
def test_enough_pieces(n):
    most = overlaps.most(n)
    assert any(size * k <= n and k >= most + 1 for size, k in overlaps.pieces(n))
    for m in range(overlaps.LEAST, n + most + 1):
        edits = overlaps.allowed(max(m, n))
        if abs(m - n) <= edits and overlaps.pieces(n)[0][1] < edits + 1:
            assert m in overlaps.SHORT_LENGTHS and overlaps.pieces(n)[1][1] >= edits + 1


def test_rarest_is_optimal():
    import numpy as np

    rng = np.random.default_rng(1)
    counts = rng.integers(1, 50, (20, 14)).astype(float)
    at = overlaps._rarest(counts, 5, 3)
    for row, places in zip(counts, at, strict=True):
        best = min(sum(row[list(c)]) for c in itertools.combinations(range(14), 3) if c[1] - c[0] >= 5 and c[2] - c[1] >= 5)
        assert sum(row[places]) == best and (places[1:] - places[:-1] >= 5).all()


def test_choice_of_grams():
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(2)
    counts = np.ones(overlaps.TABLE, np.int64)
    rows = pd.DataFrame({"class": [b"%d" % i for i in range(40)], "n": [60] * 40, "g": [rng.integers(0, 400, 56) for _ in range(40)], "h": [rng.integers(0, 400, 57) for _ in range(40)], "a": [0] * 40})
    frames = [pd.concat(overlaps.choose(counts, *how)([rows])).reset_index(drop=True) for how in ((256, 64 << 20), (256, 1), (10, 64 << 20))]
    assert frames[0].equals(frames[1])  # a bound on memory changes nothing
    for f in frames:  # places don't overlap
        assert all((np.diff(sorted(p["tplace"] & ((1 << overlaps.PLACE) - 1))) >= 4).all() for _, p in f.groupby("train"))


def test_cases(spark):
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    near = base.replace("three", "tree").replace("nine", "")  # 2 edits of 14 words: 14 per cent
    far = near.replace("five", "hive")
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (1, "d3", "a", "TRAIN ", said(base.upper() + "!"), None, None),
        (2, "d3", "b", "valid", said("One, two; three four five six seven eight nine ten - eleven twelve thirteen fourteen"), None, None),
        (3, "d3", "c", "test", said(near), None, None),
        (4, "d3", "d", "test", said(far), None, None),
        (5, "d3", "e", None, said(base), None, None),
        (6, "d3", "f", "val", "{oops", None, None),
        (7, None, None, "training", None, None, None),
        (8, "d3", "g", "val", said("too short a text"), None, None),
        (9, "d3", "h", "train", said("too short a text"), None, None),
        (10, "d3", "i", "train", said(long), None, None),
        (11, "d3", "j", "test", said(long.replace("w7 ", "x ").replace("w100 ", "")), None, None),
        (12, "d3", "f", "train", said(base), None, None),
    ]
    templates = spark.createDataFrame([(1, "g", base, None), (2, "g", "  ", None), (3, None, base, None), (4, "zz", base, None), (5, "h", None, None)], TEMPLATES)
    built = spark.createDataFrame(rows, BUILT)
    got = sorted(tuple(r) for r in overlaps.pairs(built, templates).collect())
    assert got == [(1, 2), (1, 3), (1, 8), (2, 12), (3, 12), (8, 12), (10, 11)]
    counts = {(r.split, r.dataset): (r.samples, r.overlapping) for r in overlaps.report(built, templates).collect()}
    assert counts == {("val", "d3"): (3, 2), ("test", "d3"): (3, 2)}
    links = sorted(tuple(r) for r in overlaps.class_links(built, templates).collect())
    assert links == [(1, 2, 2, 2), (1, 3, 2, 1), (10, 11, 1, 1)]


def test_empty_tables(spark):
    assert overlaps.pairs(spark.createDataFrame([], BUILT), spark.createDataFrame([], TEMPLATES)).count() == 0


@pytest.mark.parametrize("hot", [False, True])
def test_loses_no_link(spark, monkeypatch, hot):
    """Random texts from few words, so that grams are shared everywhere, with random edits up to and above the limit; with and without spreading."""
    if hot:
        monkeypatch.setattr(C, "HOT_ROWS", 3)
        monkeypatch.setattr(C, "HOT_MOST", 3)
        monkeypatch.setattr(C.hot_keys, "__defaults__", (C.HOT_SHARE, 3))
    random.seed(3)
    vocabulary = [f"v{i}" for i in range(12)]
    train = [[random.choice(vocabulary) for _ in range(random.randint(12, 44))] for _ in range(60)]
    rows, sides = [], []
    for k, w in enumerate(train):
        rows.append((k, "d", None, "train", said(" ".join(w)), None, None))
        sides.append((k, False, w))
    for k in range(200):
        w = list(random.choice(train))
        for _ in range(random.randint(0, len(w) * 15 // 100 + 3)):
            i = random.randrange(len(w))
            kind = random.random()
            if kind < 0.34:
                w[i] = random.choice(vocabulary)
            elif kind < 0.67:
                w.insert(i, random.choice(vocabulary))
            else:
                del w[i]
        rows.append((1000 + k, "d", None, "test", said(" ".join(w)), None, None))
        sides.append((1000 + k, True, w))
    expected = set()
    for (a, _, x), (b, _, y) in itertools.product([s for s in sides if not s[1]], [s for s in sides if s[1]]):
        if min(len(x), len(y)) >= 12 and distance(x, y) <= max(len(x), len(y)) * 15 // 100:
            expected.add((a, b))
    got = {tuple(r) for r in overlaps.pairs(spark.createDataFrame(rows, BUILT), spark.createDataFrame([], TEMPLATES)).collect()}
    assert got == expected and len(expected) > 100


def test_real_rows_have_links(spark, data):
    got = overlaps.pairs(read_table(spark, data, "built_samples"), read_table(spark, data, "template_records"))
    assert got.columns == ["left_key", "right_key"] and got.where("left_key >= right_key").count() == 0
