import threading
import time

import pytest
from collections import Counter

from frameloom.llm import sampling
from frameloom.session import read_table

BUILT = "sample_key long, dataset string, split string, sample_id string, batch_no int, u double, c string, id string"
TARGETS = "dataset string, target_share double, min_rows int, c string"


def rows_of(**sizes):
    out = []
    for name, n in sizes.items():
        out += [(len(out) + i, name, ("train", "val", None)[i % 3], f"{name}_{i}", i % 10, None, None, None) for i in range(n)]
    return out


def test_targets_floors_and_report(spark):
    rows = rows_of(big=3000, mid=800, rare=6) + [(90001, None, None, None, None, None, None, None), (90002, "BIG ", "x", None, None, None, None, None)]
    built = spark.createDataFrame(rows, BUILT)
    targets = spark.createDataFrame([("big", 0.5, 5, None), ("Mid", 0.48, 5, None), ("rare", 0.02, 10, None), ("none", 0.0, 3, None), (None, 0.1, 1, None), ("absent", 0.01, 1, None)], TARGETS)
    report = {r.dataset: r for r in sampling.report(spark, built, targets).collect()}
    total = 3807
    assert {d for d, r in report.items() if not r.reachable} == {"rare", "absent"} == {r.dataset for r in sampling.unreachable(spark, built, targets).collect()}
    assert report["rare"].sampled == 6 and report["rare"].floor == 6 and report["absent"].sampled == 0
    assert sum(r.sampled for r in report.values()) == round(0.2 * total)
    got = sampling.sample(spark, built, targets).collect()
    counts = Counter(r.dataset for r in got)
    assert counts == {d: r.sampled for d, r in report.items() if r.sampled} and len({r.sample_key for r in got}) == len(got)
    again = sampling.sample(spark, built.repartition(5), targets).collect()
    assert {tuple(r) for r in again} == {tuple(r) for r in got}


def test_empty(spark):
    built, targets = spark.createDataFrame([], BUILT), spark.createDataFrame([], TARGETS)
    assert sampling.sample(spark, built, targets).count() == 0 and sampling.report(spark, built, targets).count() == 0
    assert sampling.unreachable(spark, built, spark.createDataFrame([("a", 0.5, 2, None)], TARGETS)).count() == 0
    assert sampling.stable(spark, built).count() == 0


def test_repair_ends_near_goals():
    there = {("a", ""): 100, ("b", ""): 100, ("c", ""): 3}
    out = sampling.repair({("a", ""): 60, ("b", ""): 0, ("c", ""): 0}, there, {"a": 30.0, "b": 20.0, "c": 10.0}, {"a": 5})
    assert sum(out.values()) == 60 and out[("c", "")] == 3 and abs(out[("a", "")] - 33) <= 1


def test_stable_sample_grows(spark, tmp_path):
    rows = [(i, "d", None, (f"ID_{i % 900}", f" id-{i % 900}\n")[i % 2], i // 100, 0.5, None, "x") for i in range(1800)] + [(5000, "d", None, None, 1, None, None, None), (5001, "d", None, "late", None, None, None, None)]
    built = spark.createDataFrame(rows, BUILT)
    early = {r.sample_key: r.u for r in sampling.stable(spark, built.where("batch_no < 9"), path=str(tmp_path / "a")).collect()}
    late = {r.sample_key: r.u for r in sampling.stable(spark, built.repartition(9), (0.1, 0.05, 0.2), str(tmp_path / "b")).collect()}
    assert set(early) <= set(late) and all(late[k] == u for k, u in early.items())
    assert 0.05 < len(early) / 900 < 0.16 and 0.14 < len(late) / 1800 < 0.27
    for i in range(900):
        assert (i in late) == (i + 900 in late)


def test_registry_keeps_values(spark, tmp_path):
    registry = sampling.Registry(spark, str(tmp_path / "r"))
    assert registry.table().count() == 0
    registry.insert(spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string"))
    first = {r.id: r.u for r in registry.table().collect()}
    registry.seed = "another"
    registry.insert(spark.createDataFrame([("b",), ("c",)], "id string"))
    now = {r.id: r.u for r in registry.table().collect()}
    assert set(now) == {"a", "b", "c"} and all(now[k] == u for k, u in first.items())


def test_registry_is_taken_up_again(spark, tmp_path):
    path = str(tmp_path / "r")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    sampling.Registry(spark, path).insert(ids("a", "b"))
    first = {r.id: r.u for r in sampling.Registry(spark, path).table().collect()}
    (tmp_path / "r" / "part=1").mkdir()  # left by a run that failed
    second = sampling.Registry(spark, path, "another")
    second.insert(ids("b", "c"))
    rows = sampling.Registry(spark, path).table().collect()
    assert sorted(r.id for r in rows) == ["a", "b", "c"] and first.items() <= {r.id: r.u for r in rows}.items()
    assert second.admit(0.3) == 0.3 == sampling.Registry(spark, path).admit(0.2)


def test_registry_takes_turns(spark, tmp_path):
    path = str(tmp_path / "r")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    first, second = sampling.Registry(spark, path), sampling.Registry(spark, path, "another")
    both = [threading.Thread(target=first.insert, args=(ids("a", "b"),)), threading.Thread(target=second.insert, args=(ids("b", "c"),))]
    for t in both:
        t.start()
    for t in both:
        t.join()
    rows = sampling.Registry(spark, path).table().collect()
    assert sorted(r.id for r in rows) == ["a", "b", "c"] and not (tmp_path / "r" / "_turn").exists()
    (tmp_path / "r" / "_turn").write_text("held")
    third = sampling.Registry(spark, path)
    third.PATIENCE = 0.1
    with pytest.raises(TimeoutError):
        third.insert(ids("d"))
    third.LEASE, third.PATIENCE = -1, 60  # its run has failed
    third.insert(ids("d"))
    assert sampling.Registry(spark, path).table().count() == 4


def test_a_turn_is_renewed(spark, tmp_path):
    registry = sampling.Registry(spark, str(tmp_path / "r"))
    registry.LEASE = 2
    with registry.turn():
        first = (tmp_path / "r" / "_turn").stat().st_mtime
        time.sleep(2.6)
        assert (tmp_path / "r" / "_turn").stat().st_mtime > first
    assert not (tmp_path / "r" / "_turn").exists()


def test_stable_over_runs(spark, tmp_path):
    path = str(tmp_path / "r")
    made = lambda n: spark.createDataFrame([(i, "d", None, f"id_{i}", i // 100, None, None, None) for i in range(n)], BUILT)
    chosen = lambda df: {r.sample_key: r.u for r in df.collect()}
    early = chosen(sampling.stable(spark, made(600), (0.1, 0.3), path))
    late = chosen(sampling.stable(spark, made(900), (0.05,), path, "another"))
    assert early and {k: u for k, u in late.items() if k < 600} == early  # with a lower rate and another seed
    assert 0.2 < sum(k >= 600 for k in late) / 300 < 0.4


def test_real_rows(spark, data):
    built, targets = read_table(spark, data, "built_samples"), read_table(spark, data, "sample_targets")
    assert sampling.sample(spark, built, targets).count() == sum(r.sampled for r in sampling.report(spark, built, targets).collect())
