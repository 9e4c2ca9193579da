import json
import time
from collections import Counter, defaultdict

from frameloom.llm import splits
from frameloom.llm.components import components
from frameloom.llm.flow import min_cost_flow
from frameloom.session import read_table

BUILT = "sample_key long, dataset string, split string, metadata string, node string, root string, label string"
TARGETS = "split string, target_share double"


def parted(spark, built):
    return splits.parted(spark, built, spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1)], TARGETS))


def sample(key, dataset, split, **meta):
    return (key, dataset, split, json.dumps(meta) if meta else None, "x", None, "y")


def test_parted(spark):
    rows = [
        sample(1, "refer_kitti", "train", sequence="0407"),
        sample(2, "Refer-KITTI", "TEST", sequence=" 000407/"),
        sample(3, "d3", "train", image_id=7),
        sample(4, "D-3 ", "training", image_id="0007"),
        sample(5, "sorec", "val", source_image="Images/sd_1.jpg"),
        sample(6, "sorec", "train", source_image="./IMAGES/SD_1.JPG"),
        sample(7, "lasot", "train", sequence="kite-1"),
        sample(8, "lamot", None, sequence="LM1", derived_from="lasot/ KITE 1"),
        sample(9, "mevis", "val", video_id="v1", derived_from="lamot:lm1/"),
        sample(10, None, "test", sequence="kite-1"),
        sample(11, "lasot", "test"),
        sample(12, "tnl2k", "val", sequence="kite-1"),
        (13, "d3", "val", "{broken", "x", None, "y"),
        sample(14, "d3", "test", category_id=7),
    ]
    got = {r.sample_key for r in parted(spark, spark.createDataFrame(rows, BUILT)).collect()}
    assert got == {1, 2, 5, 6, 7, 9}
    assert parted(spark, spark.createDataFrame([], BUILT)).count() == 0


def test_assign_keeps_groups(spark):
    rows = [sample(i, "d3", "train", image_id=i % 70) for i in range(700)] + [sample(1000 + i, "mevis", None, video_id="big") for i in range(400)]
    rows += [sample(2000 + i, "lasot", "val", sequence=f"s{i}", derived_from=f"d3/{i}") for i in range(10)] + [sample(3000 + i, None, None) for i in range(90)]
    built, targets = spark.createDataFrame(rows, BUILT), spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1), (None, 0.5)], TARGETS)
    got = {r.sample_key: r.new_split for r in splits.assign(spark, built, targets).collect()}
    assert set(got) == {r[0] for r in rows}
    assert len({got[1000 + i] for i in range(400)}) == 1
    for i in range(700):
        assert got[i] == got[i % 70]
    for i in range(10):
        assert got[2000 + i] == got[i]
    shares = Counter(got.values())
    assert abs(shares["train"] - 960) <= 12 and abs(shares["val"] - 120) <= 12
    again = {r.sample_key: r.new_split for r in splits.assign(spark, built.repartition(7), targets).collect()}
    assert again == got
    assert splits.assign(spark, spark.createDataFrame([], BUILT), targets).count() == 0


def test_real_rows(spark, data):
    built = read_table(spark, data, "built_samples")
    fate = splits.assign(spark, built, read_table(spark, data, "split_targets"))
    moved = built.drop("split").join(fate.withColumnRenamed("new_split", "split"), "sample_key")
    assert fate.count() == built.count() and parted(spark, moved).count() == 0


def test_components(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [("hub", f"x{i}") for i in range(50)] + [("a", "a"), ("b", None), (None, None), ("p", "q"), ("q", "p")]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a string, b string"), "a", "b").collect()}
    groups = defaultdict(set)
    for node, root in got.items():
        groups[root].add(node)
    assert sorted(map(len, groups.values())) == [2, 41, 51] and all(root == min(g) for root, g in groups.items())
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_flow_takes_the_cheapest_way():
    arcs = [(0, 1, 10, 0), (1, 2, 4, 0), (1, 3, 10, 3), (2, 4, 10, 1), (3, 4, 5, 0)]
    assert min_cost_flow(5, arcs, 0, 4, 8) == [8, 4, 4, 4, 4]
    assert min_cost_flow(5, arcs, 0, 4, 100) == [9, 4, 5, 4, 5]


def test_plan_rounds_to_whole_components():
    bundles = [(("a", 1), 1000, 1000), (("a", 300), 1, 300), (("b", 7), 90, 630)]
    out = splits.plan(bundles, [0.8, 0.1, 0.1])
    assert all(sum(out[key]) == n for key, n, _ in bundles)
    rows = [sum(out[key][s] * r / n for key, n, r in bundles) for s in range(3)]
    assert abs(rows[0] - 1544) <= 10 and abs(rows[1] - 193) <= 10


def test_plan_of_many_bundles():
    # large components are bundles as all others; smaller ones make good what they can't
    bundles = [((f"l{i % 7}", i), 1 + i % 40, (1 + i % 40) * (1 + i // 7)) for i in range(25_000)] + [(("l0", -1), 1, 20_000_000)]
    began = time.time()
    out = splits.plan(bundles, [0.8, 0.1, 0.1])
    assert time.time() - began < 5 and all(sum(out[key]) == n for key, n, _ in bundles)
    total = sum(r for _, _, r in bundles)
    shares = [sum(out[key][s] * r / n for key, n, r in bundles) / total for s in range(3)]
    assert abs(shares[0] - 0.8) < 1e-3 and abs(shares[1] - 0.1) < 1e-3


def test_report(spark, data):
    got = splits.report(spark, read_table(spark, data, "built_samples"), read_table(spark, data, "split_targets")).collect()
    assert abs(sum(r.share for r in got) - 1) < 1e-9 and all(abs(r.share - r.target_share) < 0.02 for r in got)
