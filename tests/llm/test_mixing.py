import os
from collections import Counter, defaultdict

import numpy as np
import pytest

from frameloom.llm import mixing
from frameloom.session import read_table

pytestmark = pytest.mark.skipif(not os.path.exists(f"{mixing.TOKENIZERS}/{mixing.TOKENIZER}"), reason="no tokenizer here")
DOCS = "doc_id long, source string, text string, tokens long, block long, h long"
TARGETS = "source string, target_share double, max_repeats int, name string"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    for key in (0, 7, 2**63):
        got = mixing.permutation(np.arange(n), np.full(n, n), np.full(n, key, np.uint64))
        assert sorted(got) == list(range(n))
    assert n < 64 or (mixing.permutation(np.arange(n), np.full(n, n), np.full(n, 1, np.uint64)) != np.arange(n)).any()


def test_budget_caps_and_fills():
    slots = mixing.budget([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 4), ("none", 0.1, 4)], {"a": 600, "b": 50, "c": 350})
    assert slots["b"] == 100 and slots["none"] == 0 and slots["a"] <= 600 and slots["c"] <= 1400
    assert slots["a"] == 600 and slots["c"] == 300 and mixing.budget([], {}) == {}


def test_draws_add_up():
    drawn = list(mixing.shard_counts([700, 300, 0], 256, 0, 4))
    so_far = [0, 0, 0]
    for k, (shard, first, n) in enumerate(drawn):
        assert shard == k and first == so_far and sum(n) == (256 if k < 3 else 232)
        so_far = [x + y for x, y in zip(so_far, n, strict=True)]
    assert so_far == [700, 300, 0] and [d for k in range(4) for d in mixing.shard_counts([700, 300, 0], 256, k, k + 1)] == drawn
    assert list(mixing.shard_counts([], 256, 0, 1)) == []


def test_draws_of_very_many_slots():
    totals = [7 * 10**10, 3 * 10**10]
    shard, first, n = next(iter(mixing.shard_counts(totals, 256, 12_345_678, 12_345_679)))
    assert shard == 12_345_678 and sum(n) == 256 and sum(first) == shard * 256 and 130 < n[0] < 230 and abs(first[0] / sum(first) - 0.7) < 0.001


def test_mixture(spark):
    rows = [(i, ("Big", "big ", "BIG")[i % 3], "word " * (20 + i % 90), 1, 1, 1) for i in range(400)] + [(1000 + i, "small", "other words here " * 30, 1, 1, 1) for i in range(12)]
    rows += [(2000, "small", None, 1, 1, 1), (2001, "small", "", 1, 1, 1), (2002, None, "lost", 1, 1, 1), (2003, "unwanted", "x", 1, 1, 1), (2004, "small", "long " * 20_000, 1, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("big", 0.5, 1, "n"), ("Small", 0.5, 3, "n"), ("none", 0.1, 2, "n"), (None, 0.1, 2, "n")], TARGETS)
    got = mixing.mixture(spark, docs, targets).collect()
    used = Counter((r.source, r.block) for r in got)
    assert max(n for (s, _), n in used.items() if s == "big") == 1 and max(n for (s, _), n in used.items() if s == "Small") <= 3
    assert len({(r.shard, r.slot) for r in got}) == len(got) and all(sum(x.length for x in r.spans) == r.tokens <= mixing.BLOCK for r in got)
    whole = defaultdict(dict)
    for r in got:
        for x in r.spans:
            whole[x.doc_id][x.start] = x.length
    assert sum(whole[2004].values()) >= 20_000 - mixing.BLOCK or used
    again = mixing.mixture(spark, docs.repartition(7), targets).collect()
    assert {(r.shard, r.slot, r.source, r.block, bytes(r.ids)) for r in again} == {(r.shard, r.slot, r.source, r.block, bytes(r.ids)) for r in got}
    assert all(len(r.ids) == 2 * r.tokens for r in got)
    report = {r.source: r for r in mixing.report(spark, docs, targets).collect()}
    assert report["none"].tokens == 0 and abs(sum(r.reached_share for r in report.values()) - 1) < 1e-9
    assert mixing.mixture(spark, spark.createDataFrame([], DOCS), targets).count() == 0
    assert mixing.mixture(spark, docs, spark.createDataFrame([], TARGETS)).count() == 0


def test_blocks_hold_every_token(spark, data):
    docs = read_table(spark, data, "documents").where("text is not null and source is not null")
    made, totals = mixing.blocks(docs, f"{mixing.TOKENIZERS}/{mixing.TOKENIZER}")
    per = {r.source: r for r in totals.collect()}
    seen, blocks, parts = Counter(), Counter(), defaultdict(dict)
    for r in made.collect():
        seen[r.source] += r.tokens
        blocks[r.source] += 1
        ids, at = np.frombuffer(r.ids, "<u2").tolist(), 0
        for x in r.spans:
            parts[x.doc_id][x.start] = ids[at : at + x.length]
            at += x.length
        assert at == len(ids) == r.tokens
    assert seen == {s: r.tokens for s, r in per.items()} and blocks == {s: r.blocks for s, r in per.items()}
    # documents come back from their blocks as they were
    made, end = mixing._tokenizer(f"{mixing.TOKENIZERS}/{mixing.TOKENIZER}")
    for r in docs.where("text != ''").collect():
        ids = [t for _, part in sorted(parts[r.doc_id].items()) for t in part]
        assert ids.pop() == end and made.decode(ids) == r.text
