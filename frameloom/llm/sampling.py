"""Problems 5 and 7: samples that follow target proportions, and samples that stay stable as data grow."""

from __future__ import annotations

import math
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fixed_rows, shared_dir
from . import common as C
from .mixing import hypergeometric

#: Share of all rows with a category that a sample has.
RATE = 0.2
#: Categories that targets may name, which bounds what the driver keeps.
CATEGORIES = 10_000
#: Folder of the registry inside the shared one.
REGISTRY = "frameloom-registry"


def uniform(seed: str, *c: Column) -> Column:
    """A number in [0, 1) that depends on seed and values only."""
    return F.conv(F.substring(F.sha1(F.concat_ws(":", F.lit(seed), *[x.cast("string") for x in c])), 1, 13), 16, 10).cast("double") / float(1 << 52)


# --- problem 5 -----------------------------------------------------------------------------------------------------------------------


def repair(start: dict[tuple, int], there: dict[tuple, int], goals: dict[str, float], floors: dict[str, int]) -> dict[tuple, int]:
    """Counts of a sample by signature (category, ...), after exchanges between signatures that bring the categories nearest to their goals.

    start: a floor-satisfying sample; there: how many rows each signature has. Each exchange takes rows of the category most above its goal
    and gives as many to the one most below it that still has rows, as many as lower the sum of squared deviations; no category falls below
    its floor, and the size stays the same. It ends when no exchange improves.
    """
    now = dict(start)
    total = {c: sum(n for s, n in now.items() if s[0] == c) for c in {s[0] for s in there}}
    have = {c: sum(n for s, n in there.items() if s[0] == c) for c in total}
    while True:
        off = {c: total[c] - goals.get(c, 0.0) for c in total}
        over, under = [c for c in total if total[c] > floors.get(c, 0)], [c for c in total if total[c] < have[c]]
        if not over or not under:
            return now
        a, b = max(over, key=lambda c: (off[c], c)), min(under, key=lambda c: (off[c], c))
        move = min(math.floor((off[a] - off[b]) / 2 + 1e-9), total[a] - floors.get(a, 0), have[b] - total[b])
        if move < 1:
            return now
        for category, step in ((a, -move), (b, move)):
            rest = abs(step)
            # within a category signatures change in proportion to the rows they can give or take
            pool = {s: now[s] if step < 0 else there[s] - now[s] for s in there if s[0] == category}
            room = sum(pool.values())
            for s in sorted(pool, key=lambda s: (-pool[s], str(s))):
                part = min(pool[s], math.ceil(pool[s] * abs(step) / room), rest)
                now[s] += part if step > 0 else -part
                rest -= part
            total[category] += step


def _goals(targets: DataFrame) -> list[tuple[str, str, float, int]]:
    """(category, name as given, share, floor), at most CATEGORIES."""
    rows = fixed_rows(targets.select(C.canon_name(F.col("dataset")).alias("c"), F.col("dataset").alias("name"), F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)).alias("share"), F.coalesce(F.col("min_rows").cast("int"), F.lit(0)).alias("floor")).where("c is not null"), CATEGORIES)
    return [tuple(r) for r in rows]


def composition(rows: DataFrame, targets: DataFrame, rate: float = RATE, seed: str = "mix-1") -> tuple[DataFrame, dict[tuple, int], dict[tuple, int], list]:
    """Rows of built_samples with category and signature, wanted counts by signature, counts that are there, and the goals.

    The signature of a row is its category and its split, so that a sample keeps the splits' proportions.
    """
    goals = _goals(targets)
    marked = rows.select("sample_key", C.canon_name(F.col("dataset")).alias("c"), F.when(C.canon_split(F.col("split")).isin("train", "val", "test"), C.canon_split(F.col("split"))).otherwise("").alias("s")).where("c is not null")
    # four signatures for each target, and the sum of all else
    counts = marked.withColumn("c", F.when(F.col("c").isin([g[0] for g in goals]), F.col("c")).otherwise("")).groupBy("c", "s").agg(F.count(F.lit(1)).alias("n")).orderBy("c", "s").collect()
    total = sum(r["n"] for r in counts)
    there = {(r["c"], r["s"]): r["n"] for r in counts if r["c"]}
    size = int(round(rate * total))
    by = {g[0]: sum(n for s, n in there.items() if s[0] == g[0]) for g in goals}
    floors = {g[0]: min(g[3], by[g[0]]) for g in goals}
    wanted = {g[0]: g[2] * rate * total for g in goals}
    # a random sample that satisfies the floors: of each category its floor is drawn, the rest of the sample from all rows that are left
    random = np.random.default_rng([ord(x) for x in seed])
    left = dict(there)
    start = dict.fromkeys(there, 0)

    def draw(pool: list[tuple], n: int) -> None:
        rest = sum(left[s] for s in pool)
        n = max(0, min(n, rest))
        for s in pool:
            rest -= left[s]
            got = hypergeometric(random, left[s], rest, n)
            start[s], left[s], n = start[s] + got, left[s] - got, n - got

    for c, floor in floors.items():
        draw(sorted(s for s in there if s[0] == c), floor)
    draw(sorted(there), size - sum(start.values()))
    return marked, repair(start, there, wanted, floors), there, [(*g, wanted[g[0]], by[g[0]], floors[g[0]]) for g in goals]


def sample(spark: SparkSession, rows: DataFrame, targets: DataFrame, rate: float = RATE, seed: str = "mix-1") -> DataFrame:
    """(sample_key, dataset): a random sample whose categories follow the targets, with min_rows of each where it has them.

    Rows without dataset, or of one without target, aren't drawn. Of each signature the rows with the least hashes are taken: hashes are
    compared with a threshold from histograms of fixed size, and only the one of 2^24 bins that the threshold cuts is ordered.
    """
    marked, wanted, _, goals = composition(rows, targets, rate, seed)
    bins = 1 << 12
    drawn = marked.where(F.col("c").isin([g[0] for g in goals])).withColumn("u", uniform(seed, F.col("sample_key")))
    rest, parts = drawn.withColumn("x", F.col("u")), []
    left = dict(wanted)
    for _ in range(2):
        # all of the bins below the threshold are taken; the one that it cuts is divided again
        rest = rest.withColumn("bin", F.least(F.floor(F.col("x") * bins), F.lit(bins - 1)).cast("int"))
        ends: dict[tuple, tuple[int, int]] = {}
        level = dict.fromkeys(left, 0)
        for r in rest.groupBy("c", "s", "bin").agg(F.count(F.lit(1)).alias("n")).orderBy("c", "s", "bin").toLocalIterator():
            s = (r["c"], r["s"])
            if s in ends or s not in left:
                continue
            if level[s] + r["n"] >= left[s]:
                ends[s] = (r["bin"], left[s] - level[s])
            level[s] += r["n"]
        table = spark.createDataFrame([(*s, b, k) for s, (b, k) in ends.items()] or [("", "", -1, 0)], "c string, s string, last int, k int")  # as many rows as signatures
        met = rest.join(F.broadcast(table), ["c", "s"])
        parts.append(met.where("bin < last").select("sample_key", "c"))
        rest = met.where("bin = last").withColumn("x", F.col("x") * bins - F.col("bin")).drop("bin", "last", "k")
        left = {s: k for s, (_, k) in ends.items()}
    cut = met.where("bin = last").withColumn("r", F.row_number().over(Window.partitionBy("c", "s").orderBy("u", "sample_key"))).where("r <= k")
    taken = parts[0].unionByName(parts[1]).unionByName(cut.select("sample_key", "c"))
    names = spark.createDataFrame([(g[0], g[1]) for g in goals] or [("", "")], "c string, dataset string")
    return taken.join(F.broadcast(names), "c").select("sample_key", "dataset")


def report(spark: SparkSession, rows: DataFrame, targets: DataFrame, rate: float = RATE) -> DataFrame:
    """(dataset, target_rows, available, sampled, floor, reachable): what each target wants and gets."""
    _, wanted, _, goals = composition(rows, targets, rate)
    got = {g[0]: sum(k for s, k in wanted.items() if s[0] == g[0]) for g in goals}
    # a target is out of reach if the repaired sample is short of it and no more rows are there
    made = [(name, float(goal), int(n), int(got[c]), int(floor), not (got[c] < goal - 1e-9 and n < goal - 1e-9)) for c, name, _, _, goal, n, floor in goals]
    return spark.createDataFrame(made, "dataset string, target_rows double, available long, sampled long, floor long, reachable boolean")


def unreachable(spark: SparkSession, rows: DataFrame, targets: DataFrame, rate: float = RATE) -> DataFrame:
    """(dataset): targets that want more rows than there are."""
    return report(spark, rows, targets, rate).where(~F.col("reachable")).select("dataset")


# --- problem 7 -----------------------------------------------------------------------------------------------------------------------


class Registry:
    """Permanent random numbers: each identifier has a uniform value, written when it is first seen and never changed.

    The table lies in a folder that all executors share, one part for each insert, so an insert only appends. What earlier runs committed there
    counts: their identifiers keep their values, whatever the seed now, and the threshold never falls below theirs. Runs at the same time take turns: an
    insert holds a file that only one of them can create and that it keeps renewing, and sees what the others have committed. A file that wasn't renewed
    for LEASE seconds is of a run that failed; PATIENCE seconds are waited for others.
    """

    LEASE, PATIENCE = 90, 3 * 3600

    SCHEMA = "id string, u double"
    THRESHOLDS = "threshold double"

    def __init__(self, spark: SparkSession, path: str, seed: str = "stable-1"):
        self.spark, self.path, self.seed = spark, path, seed
        self.refresh()

    def refresh(self) -> None:
        """Takes up what is committed."""
        spark, path = self.spark, self.path
        there = self._names(path)
        self.parts = sorted(int(n[5:]) for n in there if n[:5] == "part=" and n[5:].isdigit() and "_SUCCESS" in self._names(f"{path}/{n}"))
        stored = spark.read.schema(self.THRESHOLDS).parquet(f"{path}/thresholds").agg(F.max("threshold")).first()[0] if "thresholds" in there else None
        self.threshold = stored or 0.0

    @contextmanager
    def turn(self) -> Iterator[None]:
        """The right to write, held by one run at a time; what others have committed is taken up."""
        jvm, token = self.spark.sparkContext._jvm, uuid.uuid4().hex
        lock = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_turn")
        files = lock.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        end = time.time() + self.PATIENCE
        while True:
            try:
                out = files.create(lock, False)
                out.writeBytes(token)
                out.close()
                held = files.open(lock)
                mine = jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8") == token
                held.close()
                if mine:
                    break
            except Exception as e:
                if "Exist" not in str(e) and "lease" not in str(e).lower():
                    raise
            if time.time() > end:
                raise TimeoutError(f"another run holds {lock.toString()}")
            try:
                if time.time() - files.getFileStatus(lock).getModificationTime() / 1000 > self.LEASE:
                    files.delete(lock, False)
            except Exception as e:  # released meanwhile
                if "NotFound" not in str(e):
                    raise
            time.sleep(0.5)
        over = threading.Event()

        def renew() -> None:
            while not over.wait(max(1.0, self.LEASE / 4)):
                out = files.create(lock, True)
                out.writeBytes(token)
                out.close()

        keeper = threading.Thread(target=renew, daemon=True)
        keeper.start()
        try:
            self.refresh()
            yield
        finally:
            over.set()
            keeper.join()
            files.delete(lock, False)

    def _names(self, path: str) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(p)] if files.exists(p) else []

    def table(self) -> DataFrame:
        parts = [f"{self.path}/part={i}" for i in self.parts]
        return self.spark.read.schema(self.SCHEMA).parquet(*parts) if parts else self.spark.createDataFrame([], self.SCHEMA)

    def insert(self, identifiers: DataFrame) -> None:
        """Gives a value to those of the identifiers (column id) that have none yet; nulls get none."""
        with self.turn():
            new = identifiers.select("id").where("id is not null").distinct()
            if self.parts:
                new = new.join(self.table(), "id", "left_anti")
            k = self.parts[-1] + 1 if self.parts else 0
            # the mark shows that a part is complete; one without it is what a failed run left, and is replaced
            new.select("id", uniform(self.seed, F.col("id")).alias("u")).write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.path}/part={k}")
            self.parts.append(k)

    def admit(self, rate: float) -> float:
        """The threshold, raised to rate and stored if that is larger."""
        with self.turn():
            if rate > self.threshold:
                self.spark.createDataFrame([(float(rate),)], self.THRESHOLDS).coalesce(1).write.mode("append").parquet(f"{self.path}/thresholds")
                self.threshold = float(rate)
        return self.threshold


def stable(spark: SparkSession, rows: DataFrame, rates: tuple[float, ...] = (0.1, 0.1), path: str | None = None, seed: str = "stable-1") -> DataFrame:
    """(sample_key, sample_id, batch_no, u): rows of built_samples whose sample_id is selected.

    Batches come in as many portions as rates has, in the order of batch_no; with each the registry gets the identifiers that are new. The threshold is
    the largest rate so far, in this and all earlier runs on the same path, so it never falls, and what was selected stays selected. Identifiers are compared without case, separators,
    padding and surrounding spaces, so all deliveries of one share its fate; rows without identifier aren't selected, rows without batch
    come with the first portion. path: an existing or new folder for the registry; by default REGISTRY in the shared folder, so runs
    with the same shared folder have one registry. seed: of the values of new identifiers.
    """
    base = rows.select("sample_key", "sample_id", F.coalesce("batch_no", F.lit(-1)).alias("batch_no"), C.canon_name(F.col("sample_id")).alias("id")).where("id is not null")
    ends = base.agg(F.min("batch_no"), F.max("batch_no")).first()
    registry = Registry(spark, path or f"{shared_dir(spark).rstrip('/')}/{REGISTRY}", seed)
    k = len(rates)
    if ends[0] is None:
        return base.withColumn("u", F.lit(None).cast("double")).select("sample_key", "sample_id", "batch_no", "u")
    step = (ends[1] - ends[0] + 1) / k
    for i, rate in enumerate(rates):
        low, high = ends[0] + step * i, ends[0] + step * (i + 1)
        registry.insert(base.where((F.col("batch_no") >= low) & (F.col("batch_no") < (high if i + 1 < k else ends[1] + 1))))
        registry.admit(rate)
    chosen = registry.table().where(F.col("u") < registry.threshold)
    return C.lookup(base, chosen, "id", C.hot_keys(base, "id")).select("sample_key", "sample_id", F.col("batch_no").cast("int").alias("batch_no"), "u")
