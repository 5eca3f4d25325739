"""Mixing sources to target weights by minimum-cost flow.

Documents may belong to several sources. They are aggregated by membership
pattern, so the network has a node for each pattern and each source: patterns
supply their words up to three times, the k-th pass over them at cost k - 1
(convex costs: repetition only where it is needed), and sources take their
targets. The flow says how many words each pattern gives; documents are then
selected by a seeded hash.

Within a pattern, every size class (powers of two) gives the same share. A class
is cut at a hash bucket, and what the cut leaves over or takes too much is carried to the next
smaller class, so the sum of a pattern misses its flow by little more than one
small document. Only sums by pattern, size class and hash bucket are moved.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.frames import WORD, cut, table

PASSES, BUCKETS, SEED = 3, 256, 20
#: Rows of the selection plan up to which it is broadcast.
PLAN_MOST = 100_000


def targets_of(sizes: dict[str | None, int], weights: tuple[int, ...] = (1, 2, 3), most: int = PASSES) -> dict[str | None, float]:
    """Targets that share all words by weight; a target stops at ``most`` times its source's size and the excess is shared anew."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    active, left = list(names), float(sum(sizes.values()))
    while active:
        total = sum(weight[s] for s in active)
        over = [s for s in active if left * weight[s] / total > most * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in active}
        for s in over:
            out[s] = float(most * sizes[s])
        left -= sum(out[s] for s in over)
        active = [s for s in active if s not in out]
    return out


def flow(supply: dict[tuple, int], quotas: dict, passes: int = PASSES) -> dict[tuple, dict]:
    """Minimum-cost flow from patterns (tuples of sources) to sources: {pattern: {source: words}}.

    Successive shortest paths; every arc source -> pattern has ``passes`` parallel
    copies of the pattern's words at costs 0, 1, 2...
    """
    patterns, sources = list(supply), list(quotas)
    node = {("p", p): i + 2 for i, p in enumerate(patterns)} | {("s", s): i + 2 + len(patterns) for i, s in enumerate(sources)}
    graph: list[list[int]] = [[] for _ in range(2 + len(node))]
    to, room, cost = [], [], []

    def arc(a: int, b: int, cap: int, c: int) -> int:
        for x, y, r, k in ((a, b, cap, c), (b, a, 0, -c)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(k)
        return len(to) - 2

    middle = {}
    for p in patterns:
        for k in range(passes):
            arc(0, node["p", p], supply[p], k)
        for s in p:
            if s in quotas:
                middle[p, s] = arc(node["p", p], node["s", s], passes * supply[p], 0)
    for s in sources:
        arc(node["s", s], 1, int(round(quotas[s])), 0)
    while True:
        far: list[float] = [float("inf")] * len(graph)
        via = [-1] * len(graph)
        far[0], queue, queued = 0, deque([0]), {0}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for e in graph[a]:
                if room[e] > 0 and far[a] + cost[e] < far[to[e]]:
                    far[to[e]], via[to[e]] = far[a] + cost[e], e
                    if to[e] not in queued:
                        queued.add(to[e])
                        queue.append(to[e])
        if via[1] < 0:
            break
        path, at = [], 1
        while at:
            path.append(via[at])
            at = to[via[at] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    out: dict[tuple, dict] = {p: {} for p in patterns}
    for (p, s), e in middle.items():
        if room[e ^ 1]:
            out[p][s] = room[e ^ 1]
    return out


def cuts(sums: pd.DataFrame, share: float) -> list[tuple[int, int]]:
    """(class, first bucket not taken) of one pattern: ``sums`` has class, bucket and words."""
    out, carry = [], 0.0
    for size_class, own in sorted(sums.groupby("class"), reverse=True):
        own = own.sort_values("bucket")
        want = share * own["words"].sum() + carry
        upto = own["words"].cumsum().to_numpy()
        taken, at = 0, 0
        for total, bucket in zip(upto.tolist(), own["bucket"].tolist(), strict=True):
            # the bucket that crosses the wanted sum is taken where that comes nearer
            if abs(total - want) <= abs(taken - want):
                taken, at = total, bucket + 1
            else:
                break
        out.append((int(size_class), int(at)))
        carry = want - taken
    return out


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame, membership: Column, seed: int = SEED) -> DataFrame:
    """``docs`` with pattern (sorted distinct sources; null last), size, class and bucket."""
    pattern = F.array_sort(F.array_distinct(membership))
    size = words_in(F.col("text"))
    return docs.withColumn("_pattern", pattern).withColumn("_size", size).withColumn("_class", F.when(F.col("_size") > 0, F.floor(F.log2("_size")).cast("int")).otherwise(-1)).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(BUCKETS)).cast("int"))


class Mix:
    """The plan of a mix: ``targets``, ``sizes`` by source and ``plan`` (pattern, class, copies, cut)."""

    def __init__(self, rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3)):
        spark = rows.sparkSession
        sums = cut(rows.groupBy("_pattern", "_class", "_bucket").agg(F.sum("_size").alias("words")))
        supply = {tuple(r[0]): int(r[1]) for r in sums.groupBy("_pattern").agg(F.sum("words")).collect()}
        self.sizes: dict[str | None, int] = {}
        for p, words in supply.items():
            for s in p:
                self.sizes[s] = self.sizes.get(s, 0) + words
        self.targets = targets_of(self.sizes, weights)
        self.flow = flow(supply, self.targets)
        shares = []
        for p, to in self.flow.items():
            words = sum(to.values())
            full = words // supply[p] if supply[p] else 0
            shares.append((list(p), int(full), (words - full * supply[p]) / supply[p] if supply[p] else 0.0))
        share = spark.createDataFrame(shares, "_pattern array<string>, full int, share double")
        key = F.to_json(F.struct("_pattern"))

        def each(own: pd.DataFrame) -> pd.DataFrame:
            found = cuts(own, float(own["share"].iloc[0])) if len(own) else []
            return pd.DataFrame({"_key": own["_key"].iloc[0], "_class": [c for c, _ in found], "_full": int(own["full"].iloc[0]), "_cut": [b for _, b in found]})

        ready = sums.withColumn("_key", key).join(F.broadcast(share.withColumn("_key", key).drop("_pattern")) if len(shares) <= PLAN_MOST else share.withColumn("_key", key).drop("_pattern"), "_key")
        ready = ready.select("_key", F.col("_class").alias("class"), F.col("_bucket").alias("bucket"), "words", "full", "share")
        self.plan = cut(ready.groupBy("_key").applyInPandas(each, "_key string, _class int, _full int, _cut int"))
        self.small = self.plan.count() <= PLAN_MOST

    def copies(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_copies``: how often the mix takes a document."""
        plan = F.broadcast(self.plan) if self.small else self.plan
        rows = rows.withColumn("_key", F.to_json(F.struct("_pattern"))).join(plan, ["_key", "_class"], "left")
        return rows.withColumn("_copies", F.coalesce(F.col("_full") + (F.col("_bucket") < F.col("_cut")).cast("int"), F.lit(0))).drop("_key", "_full", "_cut")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a null text has size 0. Rows are weighed one by one, so repeated rows count as often as they occur."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    rows = cut(sized(docs, F.array("source")).drop("text"))
    mix = Mix(rows)
    known = spark.createDataFrame([(s, n, mix.targets[s]) for s, n in mix.sizes.items()], "_source string, source_size long, target double")
    known = F.broadcast(known) if len(mix.sizes) <= PLAN_MOST else known
    return mix.copies(rows).join(known, F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them. Columns of any name pass through; null texts have no words and are not taken."""
    # One struct holds the row, so that no name clashes with its columns.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    rows = sized(rows, F.array("source"))
    plan = Mix(cut(rows.select("_pattern", "_size", "_class", "_bucket")))
    taken = plan.copies(rows).where("_copies > 0").select("row", F.explode(F.expr("sequence(1, _copies)")))
    return taken.select("row.*").select(*[F.col(f"`{c}`") for c in docs.columns])
