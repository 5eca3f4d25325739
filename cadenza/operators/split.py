"""Session-aware splitting: whole sessions go to train, val or test, deterministically."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.config import SPLITS

REPAIR_LEAST, DONOR_LEAST = 3, 2


def session_sizes(rows: DataFrame, session: str = "session_id") -> DataFrame:
    return rows.groupBy(F.col(session).alias("session_id")).agg(F.count("*").alias("n"))


def hash_key(session: Column, seed: int = 0) -> Column:
    """Sort key of a session: SHA-256 of ``seed:session``."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), session).cast("binary"), 256)


def water_filled(sizes: DataFrame, split: dict) -> DataFrame:
    """(session_id, n, hash_rank, split): in hash order, each session goes to the split with the largest deficit, the leftmost of equals.

    One row per session is gathered (sessions are few against samples) and folded by ``aggregate``.
    """
    ordered = sizes.select(F.struct(hash_key(F.col("session_id"), split["seed"]).alias("key"), "session_id", "n").alias("s")).agg(F.array_sort(F.collect_list("s")).alias("all"))
    ordered = ordered.withColumn("total", F.aggregate("all", F.lit(0).cast("long"), lambda t, s: t + s["n"]))
    target = {name: F.lit(float(split[name])) * F.col("total") for name in SPLITS}
    empty = F.expr("cast(array() as array<string>)")
    start = F.struct(*[F.lit(0).cast("long").alias(name) for name in SPLITS], empty.alias("out"))

    def step(acc: Column, s: Column) -> Column:
        need = {name: target[name] - acc[name] for name in SPLITS}
        best = F.greatest(*need.values())
        chosen = F.when(need["train"] == best, "train").when(need["val"] == best, "val").otherwise("test")
        return F.struct(*[F.when(chosen == name, acc[name] + s["n"]).otherwise(acc[name]).alias(name) for name in SPLITS], F.concat(acc["out"], F.array(chosen)).alias("out"))

    placed = ordered.withColumn("placed", F.aggregate("all", start, step, lambda acc: acc["out"]))
    pairs = placed.select(F.posexplode(F.arrays_zip("all", "placed")).alias("rank", "p"))
    return pairs.select("p.all.session_id", "p.all.n", (F.col("rank") + 1).cast("long").alias("hash_rank"), F.col("p.placed").alias("split"))


@dataclass(frozen=True)
class Outcome:
    """A finished split: rows (session_id, n) in hash order, where each went, and how."""

    order: tuple[tuple[str, int], ...]
    assigned: dict[str, str]
    targets: dict[str, float]
    moves: tuple[tuple[str, str, str], ...]
    overlaps: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def total(self) -> int:
        return sum(n for _, n in self.order)

    @property
    def too_few(self) -> bool:
        return len(self.order) < REPAIR_LEAST

    def samples(self) -> dict[str, int]:
        return {name: sum(n for s, n in self.order if self.assigned[s] == name) for name in SPLITS}


def repaired(order: list[tuple[str, int]], assigned: dict[str, str], targets: dict[str, float]) -> list[tuple[str, str, str]]:
    """Gives an empty val, then an empty test, the smallest session of the split with the largest surplus that holds at least two; changes ``assigned``."""
    moves: list[tuple[str, str, str]] = []
    if len(order) < REPAIR_LEAST:
        return moves
    for name in SPLITS[1:]:
        members = {s: [(n, rank, session) for rank, (session, n) in enumerate(order) if assigned[session] == s] for s in SPLITS}
        if members[name]:
            continue
        donors = [(targets[s] - sum(m[0] for m in members[s]), rank, s) for rank, s in enumerate(SPLITS) if len(members[s]) >= DONOR_LEAST]
        if donors:
            donor = min(donors)[2]
            session = min(members[donor])[2]
            assigned[session] = name
            moves.append((session, donor, name))
    return moves


def split_sessions(rows: DataFrame, split: dict) -> Outcome:
    """Splits ``rows`` (session_id, speaker_id)."""
    filled = water_filled(session_sizes(rows), split).orderBy("hash_rank").collect()
    order = [(r["session_id"], r["n"]) for r in filled]
    assigned = {r["session_id"]: r["split"] for r in filled}
    total = sum(n for _, n in order)
    targets = {name: split[name] * total for name in SPLITS}
    moves = repaired(order, assigned, targets)
    overlaps: tuple = ()
    if order:
        placed = rows.sparkSession.createDataFrame(list(assigned.items()), "session_id string, split string")
        found = speaker_overlaps(rows.join(placed, "session_id")).orderBy("speaker_id").collect()
        overlaps = tuple((r["speaker_id"], tuple(r["splits"])) for r in found)
    return Outcome(tuple(order), assigned, targets, tuple(moves), overlaps)


def speaker_overlaps(placed: DataFrame) -> DataFrame:
    """(speaker_id, splits in order) of speakers in more than one split; none where there is one speaker."""
    sets = placed.groupBy("speaker_id").agg(F.collect_set("split").alias("found"))
    ordered = F.filter(F.array(*[F.lit(s) for s in SPLITS]), lambda s: F.array_contains(F.col("found"), s))
    several = placed.agg(F.count_distinct("speaker_id").alias("speakers"))
    one = several.where("speakers >= 2").select(F.lit(1).alias("_one"))
    return sets.where(F.size("found") > 1).withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").select("speaker_id", ordered.alias("splits"))  # one row is broadcast


def split_counts(assigned: DataFrame) -> DataFrame:
    """(split, sessions, samples) for all three splits, zeros included; ``assigned`` has session_id, n and split."""
    spark = assigned.sparkSession
    every = spark.createDataFrame([(i, s) for i, s in enumerate(SPLITS)], "place int, split string")
    sums = assigned.groupBy("split").agg(F.count("*").alias("sessions"), F.sum("n").alias("samples"))
    return every.join(sums, "split", "left").select("split", F.coalesce("sessions", F.lit(0)).alias("sessions"), F.coalesce("samples", F.lit(0)).alias("samples"))
