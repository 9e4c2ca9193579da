import json
import re
from collections import defaultdict

from frameloom.llm import common as C
from frameloom.llm import copies
from frameloom.session import read_table

BUILT = "sample_key long, row_json string, content string, n long, salt int, key string"
TEMPLATES = "record_id long, source_image string, source_text string, content string"


def row(said, images=("a.jpg",), swap=False, **more):
    message = [{"role": "user", "content": "q"}, {"content": said, "role": "assistant"}]
    held = {"messages": message, "images": list(images)}
    return json.dumps(dict(reversed(held.items())) if swap else held, **more)


def test_classes_and_copies(spark):
    built = spark.createDataFrame(
        [
            (5, row("A red car, left."), "x", 1, 1, "k"),
            (2, row("a RED  car left", swap=True, indent=2), None, None, None, None),
            (9, row("a red car left", images=("b.jpg",)), None, None, None, None),
            (3, "{broken", None, None, None, None),
            (4, "{broken", None, None, None, None),
            (6, None, None, None, None, None),
            (7, "", None, None, None, None),
            (8, row("é" * 20_000), None, None, None, None),
            (10, row("É" * 20_000 + "!"), None, None, None, None),
            (2, row("a red car left"), None, None, None, None),
        ],
        BUILT,
    )
    templates = spark.createDataFrame([(1, "i", "Ab-c", None), (4, "i", "a bc", None), (5, "j", "abc", None), (6, None, "abc", None), (7, None, "ABC", None), (8, "i", " ", None), (9, "i", None, None)], TEMPLATES)
    got = {tuple(r) for r in copies.find_copies(built, templates).collect()}
    assert got == {("built_samples", 2, 5), ("built_samples", 8, 10), ("template_records", 1, 4), ("template_records", 6, 7)}
    sizes = {(r.table_name, r.keep_key): r.copies for r in copies.collapse(built, templates).collect()}
    assert sizes[("built_samples", 8)] == 2 and sizes[("built_samples", 9)] == 1 and sizes[("template_records", 1)] == 2


def test_hot_keys_take_two_levels(spark):
    rows = spark.range(3000).selectExpr("'built_samples' as table_name", "id as key", "unhex(md5(cast(if(id % 3 = 0, 0, id) as string))) as content")
    hot = C.hot_keys(rows, "content", share=0.1, least=100)
    assert [r.n for r in hot.collect()] == [1000]
    pairs = copies.copies(rows, hot.select("content")).collect()
    assert len(pairs) == 999 and {r.keep_key for r in pairs} == {0}
    assert sum(r.copies for r in copies.classes(rows, hot.select("content")).collect()) == 3000


def test_empty_tables(spark):
    empty = copies.find_copies(spark.createDataFrame([], BUILT), spark.createDataFrame([], TEMPLATES))
    assert empty.columns == ["table_name", "keep_key", "copy_key"] and empty.count() == 0


def test_against_brute_force(spark, data):
    def letters(s):
        return re.sub(r"[\W_]+", "", (s or "").lower())

    groups = defaultdict(list)
    for r in read_table(spark, data, "built_samples").select("sample_key", "row_json").collect():
        try:
            j = json.loads(r.row_json)
        except (TypeError, ValueError):
            continue
        said = tuple(sorted((m["role"], i, letters(m["content"])) for i, m in enumerate(j["messages"])))
        groups["built_samples", tuple((a, c) for a, _, c in said), str(j.get("images")), str(j.get("videos"))].append(r.sample_key)
    for r in read_table(spark, data, "template_records").collect():
        if letters(r.source_text):
            groups["template_records", r.source_image, letters(r.source_text)].append(r.record_id)
    expected = {(k[0], min(v), x) for k, v in groups.items() for x in v if x != min(v)}
    got = {tuple(r) for r in copies.find_copies(read_table(spark, data, "built_samples"), read_table(spark, data, "template_records")).collect()}
    assert got == expected and expected
