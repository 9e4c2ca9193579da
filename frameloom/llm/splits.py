"""Problem 3: splits that keep related records together.

Method: components of related records are bundled by identical size and label profile; a minimum-cost flow spreads the bundles over
the splits with a cost for each row beyond a split's quota; the flow is rounded to whole components; members are assigned by hash.
All bundles of a label have the same arcs, so the flow is solved for labels and shared out over their bundles.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import hash_rank, shuffle_key
from ..session import fixed_rows, stage
from . import common as C
from .components import components
from .flow import min_cost_flow

#: Sizes of components that make one bundle differ by less than this factor, so those up to 1 / (STEP - 1) rows make one each. That bounds the
#: bundles of a label, which the driver shares out, by about log(rows) / log(STEP); their exact sum of rows is kept.
STEP = 1.01
#: Labels with quotas of their own: the largest ones by rows; the others share one.
LABELS = 200
#: Share of all rows by which whole components may leave the flow before it is solved again.
DRIFT = 0.001
SEED = 1


def entities(built: DataFrame) -> DataFrame:
    """(sample_key, part, label, node, origin): the entity of each sample, and the one it was derived from; both as dataset/entity."""
    label = C.canon_name(F.col("dataset"))
    meta = F.from_json("metadata", "image_id string, source_image string, video_id string, sequence string, derived_from string")

    def of(kind, m):
        named = F.when(kind == "d3", m["image_id"]).when(kind == "sorec", m["source_image"]).when(kind == "mevis", m["video_id"]).otherwise(m["sequence"])
        return named

    def node(kind, name):
        # a path counts by its file name; a closing slash is only a way of writing
        file = F.regexp_extract(F.regexp_replace(name, r"[\s/\\]+$", ""), r"([^/\\]*)$", 1)
        entity = C.canon_entity(F.when(kind == "sorec", file).otherwise(name))
        return F.when(kind.isNotNull() & entity.isNotNull(), F.concat(kind, F.lit("/"), entity))

    came = F.col("m")["derived_from"]
    kind = C.canon_name(F.regexp_extract(came, r"^([^/:]*)[/:]", 1))
    return (
        built.select(F.col("sample_key").alias("sample_key"), C.canon_split(F.col("split")).alias("part"), label.alias("label"), meta.alias("m"))
        .withColumn("node", node(F.col("label"), of(F.col("label"), F.col("m"))))
        .withColumn("origin", F.when(F.col("node").isNotNull(), node(kind, F.regexp_extract(came, r"^[^/:]*[/:](.*)$", 1))))
        .drop("m")
    )


def groups(rows: DataFrame) -> DataFrame:
    """(node, root) of each entity of entities()."""
    links = rows.where(F.col("origin").isNotNull()).select("node", "origin").distinct()
    roots = components(links, "node", "origin")
    return rows.where(F.col("node").isNotNull()).select("node").distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def quotas(rows: dict[str, float], wanted: dict[str, list[float]], missing: list[float]) -> dict[str, list[float]]:
    """Rows of each label (label: rows) that go to each split, by a minimum-cost flow.

    wanted: rows of each label that each split should get; missing: rows that each split should get. The graph has a node for each label, each label in
    a split, and each split; each row beyond what a split should get costs 2, beyond what a label should give to it 1.
    """
    labels, k = sorted(rows), len(missing)
    amount = {x: round(rows[x]) for x in labels}
    first = 1 + len(labels)
    split_at = first + len(labels) * k
    sink, total = split_at + k, sum(amount.values())
    arcs = []
    for j, x in enumerate(labels):
        arcs.append((0, 1 + j, amount[x], 0))
        for s in range(k):
            own, at = first + j * k + s, split_at + s
            arcs += [(1 + j, own, amount[x], 0), (own, at, math.ceil(max(0.0, wanted[x][s])), 0), (own, at, amount[x], 1)]
    for s in range(k):
        arcs += [(split_at + s, sink, math.ceil(max(0.0, missing[s])), 0), (split_at + s, sink, total, 2)]
    flow = min_cost_flow(sink + 1, arcs, 0, sink, total)
    return {x: [float(flow[j * (1 + 3 * k) + 1 + 3 * s]) for s in range(k)] for j, x in enumerate(labels)}


def plan(bundles: list[tuple[tuple, int, int]], shares: list[float]) -> dict[tuple, list[int]]:
    """How many components of each bundle (key, components, rows; key[0] is the label) go to each split.

    The flow gives each label's rows by split. They are shared out over the label's bundles, largest components first: each bundle is divided in
    proportion to what its label still has to give to the splits, rounded down to whole components, and those left over go one by one where most
    rows of the label are missing. Whenever whole components have taken DRIFT of all rows more than the flow gave them, the flow
    is solved again for what is left, so smaller components make good what larger ones couldn't.
    """
    k, total = len(shares), sum(n for _, _, n in bundles)
    left: dict[str, float] = {}
    for key, _, n in bundles:
        left[key[0]] = left.get(key[0], 0) + n
    wanted = {x: [share * n for share in shares] for x, n in left.items()}
    missing = [share * total for share in shares]
    owed, drift, out = quotas(left, wanted, missing), 0.0, {}
    for key, n, size in sorted(bundles, key=lambda b: (-b[2] / b[1], str(b[0]))):
        x, each = key[0], size / n
        if drift > DRIFT * total:
            owed, drift = quotas(left, wanted, missing), 0.0
        mine = owed[x]
        open_rows = [max(0.0, v) for v in mine]
        whole = sum(open_rows) or 1.0
        got = [int(n * v / whole + 1e-9) for v in open_rows]
        for _ in range(n - sum(got)):
            s = max(range(k), key=lambda s: (mine[s] - got[s] * each, missing[s]))
            drift += max(0.0, min(each, (got[s] + 1) * each - open_rows[s]))
            got[s] += 1
        for s in range(k):
            mine[s] -= got[s] * each
            missing[s] -= got[s] * each
            wanted[x][s] -= got[s] * each
        left[x] -= size
        out[key] = got
    return out


def bundled(built: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows, (node, root), and the components (root, label, size, b): label is the dataset with most rows."""
    rows = stage(entities(built).withColumn("node", F.coalesce("node", F.concat(F.lit("#"), F.col("sample_key").cast("string")))))
    there = stage(groups(rows))
    common = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("label is not null").orderBy(F.desc("n"), "label").limit(LABELS).collect()
    label = F.when(F.col("label").isin([r["label"] for r in common]), F.col("label"))
    by = rows.withColumn("label", label).groupBy("node", "label").agg(F.count(F.lit(1)).alias("n")).join(there, "node").groupBy("root", "label").agg(F.sum("n").alias("n"))
    size = F.sum("n").alias("size")
    whole = by.groupBy("root").agg(size, F.max_by(F.coalesce("label", F.lit("")), F.struct("n", "label")).alias("label"))
    return rows, there, stage(whole.withColumn("b", F.floor(F.log(STEP, F.col("size")) + 1e-9)))


def assigned(spark: SparkSession, built: DataFrame, targets: DataFrame) -> DataFrame:
    """(sample_key, part, root, new_split): every sample with its split now, its group and its new split; related samples get the same one.

    targets: split, target_share; shares are scaled to 1, null ones count as 0. Samples with null dataset, metadata or entity are
    components of their own. Ties are decided by hash, so the result is the same for any partitioning.
    """
    goals = sorted((r["split"], float(r["target_share"] or 0)) for r in fixed_rows(targets.select("split", "target_share"), 1000) if r["split"] is not None)
    scale = sum(x for _, x in goals)
    if not goals or scale <= 0:
        raise ValueError("split targets need a positive share")
    rows, there, whole = bundled(built)
    bundles = [((r["label"], r["b"]), r["n"], r["rows"]) for r in whole.groupBy("label", "b").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("rows")).orderBy("label", "b").collect()]
    counts = plan(bundles, [x / scale for _, x in goals]) if bundles else {}
    table = []
    for (key, n, _) in bundles:
        table.append((*key, [sum(counts[key][: s + 1]) for s in range(len(goals))]))
    ends = F.broadcast(spark.createDataFrame(table, "label string, b long, ends array<long>"))  # bounded: see STEP and LABELS
    met = whole.select("root", "label", "b").join(ends, ["label", "b"])
    names = F.array(*[F.lit(x) for x, _ in goals])
    drawn = hash_rank(met, shuffle_key(SEED, F.col("root")), ["root"], ["label", "b"])
    chosen = drawn.withColumn("s", F.size(F.filter("ends", lambda e: e < F.col("rank")))).select("root", F.get(names, F.col("s")).alias("new_split"))
    # a component may hold a third of all entities, and an entity a third of all rows
    fate = C.lookup(there, chosen, "root", C.hot_keys(there, "root")).select("node", "root", "new_split")
    pairs = rows.select("sample_key", "part", "node")
    return C.lookup(pairs, fate, "node", C.hot_keys(pairs, "node")).select("sample_key", "part", "root", "new_split")


def assign(spark: SparkSession, built: DataFrame, targets: DataFrame) -> DataFrame:
    """(sample_key, new_split): the new split of every sample; see assigned()."""
    return assigned(spark, built, targets).select("sample_key", "new_split")


def parted(spark: SparkSession, built: DataFrame, targets: DataFrame) -> DataFrame:
    """(sample_key): samples whose group has samples in more than one split now, which assigned() brings together.

    Samples without dataset, metadata or entity stand alone; samples without split aren't listed, but their derived_from joins groups.
    Unreadable metadata counts as none; an empty table gives no rows.
    """
    rows = stage(assigned(spark, built, targets).where("part is not null").select("sample_key", "part", "root"))
    bad = rows.groupBy("root").agg(F.min("part").alias("l"), F.max("part").alias("h")).where(F.col("l") < F.col("h")).select("root")
    return C.lookup(rows, bad, "root", C.hot_keys(rows, "root")).select("sample_key")


def report(spark: SparkSession, built: DataFrame, targets: DataFrame) -> DataFrame:
    """(split, target_share, rows, share): what each split of assign() wants and gets."""
    got = assign(spark, built, targets).groupBy(F.col("new_split").alias("split")).agg(F.count(F.lit(1)).alias("rows"))
    there = built.count() or 1
    rows = F.coalesce("rows", F.lit(0))
    return targets.where("split is not null").select("split", F.coalesce(F.col("target_share").cast("double"), F.lit(0.0)).alias("target_share")).join(got, "split", "left").select("split", "target_share", rows.alias("rows"), (rows / there).alias("share"))
