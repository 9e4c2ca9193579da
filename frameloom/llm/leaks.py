"""Problem 8: evaluation texts that stand in a training corpus.

Method: prefix-filtered set join. The shingles of each item are ordered by their rarity in the whole corpus. Any run of RUN shared words holds
RUN - SHINGLE + 1 consecutive shingles, so it holds the rarest of those; only these necessary prefix tokens are joined with the corpus. A match is
kept if positions and lengths of document and item leave room for a run, and is verified word by word over a window of the item's size.

The corpus is read once for its shingles: those that any item has are written with their places, which gives both the counts over all documents and the
matches. Documents that have a match are read again for the words about it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import BROADCAST_ROWS, small, stage
from . import common as C

#: Words of a shingle, and of the shortest shared passage.
SHINGLE, RUN = 5, 10
#: Shingles of items that meet the corpus at once, by broadcast: each is one number, so they take some 50 MB. More of them take more readings of the
#: corpus, one for each such block.
BLOCK = 1_000_000


def _exploded(df: DataFrame, key: str, *more: str) -> DataFrame:
    """(key, at, shingle, more) of df's words w, for texts of RUN words at least."""
    there = df.where(F.size("w") >= RUN).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    held = F.transform(F.sequence(F.lit(0), F.size("w") - SHINGLE), lambda i: F.struct(i.alias("at"), F.xxhash64(*[F.get(F.col("h"), i + j) for j in range(SHINGLE)]).alias("shingle")))
    return there.select(key, *more, F.inline_outer(held))  # never empty here; for inline Spark would compute it twice


def occurrences(corpus: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, length, at, shingle): where shingles of wanted (one row each) stand in corpus (doc_id, w), written.

    Other shingles never leave their task. Any number of wanted shingles is met, in blocks by hash.
    """
    n = -(-wanted.count() // BLOCK) or 1
    every = _exploded(corpus.withColumn("length", F.size("w")), "doc_id", "length")
    block = F.pmod(F.xxhash64(F.lit(23), "shingle"), F.lit(n))
    parts = [every.join(F.broadcast(wanted.where(block == i)), "shingle") for i in range(n)]  # BLOCK of them each
    made = parts[0]
    for part in parts[1:]:
        made = made.unionByName(part)
    return stage(made.select("doc_id", "length", "at", "shingle"))


def prefixes(mine: DataFrame, there: DataFrame) -> DataFrame:
    """(item_id, size, at, shingle): the rarest shingle of each window of RUN words of an item, in the corpus; ties take the smallest hash.

    mine: shingles of the items; there: occurrences() of them.
    """
    counts = there.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    ranked = mine.join(counts, "shingle", "left").withColumn("rank", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "at"))
    # windows over one item's shingles: an item is one passage
    window = Window.partitionBy("item_id").orderBy("at").rowsBetween(0, RUN - SHINGLE)
    least = ranked.withColumn("least", F.min("rank").over(window)).withColumn("full", F.count(F.lit(1)).over(window))
    # a shingle that no document has can't be in a shared passage, nor can a window that holds it
    return least.where((F.col("full") == RUN - SHINGLE + 1) & (F.col("least.n") > 0)).select("item_id", "size", F.col("least.at").alias("at"), F.col("least.shingle").alias("shingle")).distinct()


def leaks(documents: DataFrame, benchmark: DataFrame, doc: str = "doc_id", text: str = "text", item: str = "item_id", passage: str = "item_text") -> DataFrame:
    """(doc_id, item_id): documents that share RUN consecutive words with an item, apart from case, punctuation and white space.

    Null and empty texts, and texts of fewer than RUN words, share nothing. Texts are read whole. A document or item that recurs with
    the same identifier counts once.
    """
    corpus = documents.select(F.col(doc).alias("doc_id"), C.words(F.col(text)).alias("w"))
    items = stage(benchmark.select(F.col(item).alias("item_id"), C.words(F.col(passage)).alias("w")))
    mine = stage(_exploded(items.withColumn("size", F.size("w")), "item_id", "size"))
    there = occurrences(corpus, mine.select("shingle").distinct())
    tokens = stage(prefixes(mine, there))
    spot = lambda: F.concat_ws(":", F.col("item_id").cast("string"), F.col("there").cast("string")).alias("spot")
    held = tokens.join(items, "item_id").select("item_id", F.col("at").alias("there"), F.col("w").alias("iw")).select(spot(), "iw").dropDuplicates(["spot"])
    # the window of an item's size around a match: before it at most as many words as the item has before its own shingle, and so after it
    wanted = tokens.select("shingle", F.col("at").alias("there"), "size", "item_id")
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    met = there.join(F.broadcast(wanted), "shingle") if few else C.spread_join(there, wanted, "shingle", C.hot_keys(there, "shingle"))
    room = F.least("at", "there") + F.least(F.col("length") - F.col("at"), F.col("size") - F.col("there"))
    found = met.where(room >= RUN).select("doc_id", "item_id", "at", "there")
    found = stage(found)
    # few documents have a match; only these are read again for the words around it, and their words are parted after the join
    spots = small(stage(found.groupBy("doc_id").agg(F.collect_set(F.struct("item_id", "at", "there")).alias("spots"))))
    raw = documents.select(F.col(doc).alias("doc_id"), F.col(text).alias("text")).join(spots, "doc_id")
    near = raw.select("doc_id", C.words(F.col("text")).alias("w"), "spots").select("doc_id", "w", F.inline_outer("spots"))
    span = F.greatest(F.lit(0), F.col("at") - F.col("there"))
    # written first, as the condition below would else be pushed down and part the words again for each use; an item may stand in a third of all documents
    held, near = stage(held), near.withColumn("spot", spot())
    beside = near.join(F.broadcast(held), "spot") if held.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else C.lookup(near, held, "spot", C.hot_keys(found.select(spot()), "spot"))
    window = beside.select("doc_id", "item_id", (F.col("at") - span).alias("at"), "there", F.slice("w", span + 1, F.size("iw") + SHINGLE).alias("w"), "iw")
    window = stage(window)
    reach = RUN - SHINGLE
    same = lambda d: F.get(F.col("w"), F.col("at") + d).eqNullSafe(F.get(F.col("iw"), F.col("there") + d)) & F.get(F.col("w"), F.col("at") + d).isNotNull()
    equal = F.transform(F.sequence(F.lit(-reach), F.lit(RUN - 1)), lambda d: same(d))
    full = F.exists(F.sequence(F.lit(0), F.lit(reach)), lambda s: F.forall(F.slice(equal, s + 1, RUN), lambda x: x))
    return window.where(full).select("doc_id", "item_id").distinct()


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(item_id, dataset, documents): of each item that leaked, in how many documents."""
    hits = leaks(documents, benchmark).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))
    return benchmark.select("item_id", "dataset").distinct().join(hits, "item_id")
