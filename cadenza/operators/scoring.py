"""Scoring of hypotheses: per sample, pooled, broken down and averaged over groups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.config import SPLITS
from cadenza.errors import HardError
from cadenza.functions.alignment import align, operations
from cadenza.functions.text import NORMALIZERS, TIER_A

#: Axes of the breakdowns in order, and their columns (fixed values).
AXES = {"split": "split", "session": "session_id", "prompt": "prompt_id", "device": "device", "environment": "environment"}
COUNTS = tuple(f"{unit}_{part}" for unit in ("word", "char") for part in ("s", "d", "i", "n"))
STEPS = "array<struct<step:string,reference:string,hypothesis:string>>"


def in_scope(rows: DataFrame, split: str | None) -> DataFrame:
    return rows if split is None else rows.where(F.col("split") == split)


def scored(rows: DataFrame, tiers=NORMALIZERS, steps: bool = False) -> DataFrame:
    """One row per sample with a hypothesis and tier: normalized texts, edit counts of words and characters and ``sentence_error``.

    ``rows`` has id, reference, hypothesis and any other columns, which are kept. ``steps`` adds the word alignment.
    """
    done = rows.where("hypothesis is not null")
    kept = [f for f in done.schema.fields if f.name not in ("tier", "ref", "hyp", *COUNTS, "sentence_error", "steps")]
    done = done.select(*[F.col(f"`{f.name}`") for f in kept])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", tier string, ref string, hyp string, " + ", ".join(f"{c} long" for c in COUNTS) + ", sentence_error boolean" + (f", steps {STEPS}" if steps else "")
    functions = dict(tiers)

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            for tier, normalize in functions.items():
                out = frame.copy()
                out["tier"] = tier
                out["ref"], out["hyp"] = frame["reference"].map(normalize), frame["hypothesis"].map(normalize)
                pairs = list(zip(out["ref"], out["hyp"], strict=True))
                words = [align(a.split(" ") if a else [], b.split(" ") if b else []) for a, b in pairs]
                chars = [align(a, b) for a, b in pairs]
                for unit, found in (("word", words), ("char", chars)):
                    for k, part in enumerate("sdin"):
                        out[f"{unit}_{part}"] = [x[k] for x in found]
                out["sentence_error"] = [a != b for a, b in pairs]
                if steps:
                    out["steps"] = [[{"step": s, "reference": r, "hypothesis": h} for s, r, h in operations(a.split(" ") if a else [], b.split(" ") if b else [])] for a, b in pairs]
                yield out

    return done.mapInPandas(each, schema)


def rate(unit: str) -> Column:
    """Errors over reference tokens; null without tokens, never clamped."""
    return F.try_divide(F.col(f"{unit}_s") + F.col(f"{unit}_d") + F.col(f"{unit}_i"), F.col(f"{unit}_n"))


def with_rates(rows: DataFrame) -> DataFrame:
    return rows.withColumn("wer", rate("word")).withColumn("cer", rate("char")).withColumn("ser", F.try_divide(F.col("sentence_errors"), F.col("samples")))


def breakdowns(scores: DataFrame, axes: dict[str, str] = AXES) -> DataFrame:
    """(tier, axis, value, samples, counts, sentence_errors, wer, cer, ser): all axes and the whole (axis ``all``) in one GROUPING SETS pass."""
    columns = list(axes.values())
    spread = scores.groupingSets([["tier"], *[["tier", c] for c in columns]], "tier", *columns)
    sums = spread.agg(*[F.sum(c).alias(c) for c in COUNTS], F.sum(F.col("sentence_error").cast("long")).alias("sentence_errors"), F.count("*").alias("samples"), *[F.grouping(c).alias(f"_{c}") for c in columns])
    axis, value = F.lit("all"), F.lit(None).cast("string")
    for name, c in axes.items():
        axis = F.when(F.col(f"_{c}") == 0, F.lit(name)).otherwise(axis)
        value = F.when(F.col(f"_{c}") == 0, F.col(c)).otherwise(value)
    return with_rates(sums.select("tier", axis.alias("axis"), value.alias("value"), "samples", *COUNTS, "sentence_errors"))


def macro(groups: DataFrame) -> DataFrame:
    """Per tier and axis and rate: mean, population deviation and median over groups, leaving out undefined rates, and how many were left out."""
    rates = groups.where("axis <> 'all'").select("tier", "axis", F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("x")) for r in ("wer", "cer", "ser")])).alias("r")).select("tier", "axis", "r.rate", "r.x")
    return rates.groupBy("tier", "axis", "rate").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("stddev"), F.median("x").alias("median"), F.count_if(F.col("x").isNull()).alias("excluded_groups"))


def in_order(groups: DataFrame) -> DataFrame:
    """Axes in their order; splits train, val, test first; other values ascending."""
    axis = F.array_position(F.array(*[F.lit(a) for a in ("all", *AXES)]), F.col("axis"))
    known = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("value"))
    split = F.when(F.col("axis") != "split", 0).when(known > 0, known).otherwise(len(SPLITS) + 1)
    return groups.orderBy("tier", axis, split, "value")


def check_scope(groups: DataFrame) -> None:
    """A scope without reference tokens under Tier A cannot be scored."""
    whole = groups.where((F.col("axis") == "all") & (F.col("tier") == TIER_A)).select("word_n").first()
    if whole is None or not whole[0]:
        raise HardError("the Scope has zero total Reference tokens under Tier A; no rate is defined")


def worklist(scores: DataFrame) -> DataFrame:
    """Samples with word errors under Tier A, worst rate first, then by id; an undefined rate (no reference) counts as worst."""
    rows = scores.where((F.col("tier") == TIER_A) & (F.col("word_s") + F.col("word_d") + F.col("word_i") > 0)).withColumn("wer", rate("word"))
    return rows.select("id", "wer", "word_s", "word_d", "word_i", "word_n").orderBy(F.desc_nulls_first("wer"), "id")


def counts(rows: DataFrame) -> DataFrame:
    """in_scope, scored, failed and long_form."""
    return rows.agg(F.count("*").alias("in_scope"), F.count("hypothesis").alias("scored"), F.count_if(F.col("hypothesis").isNull()).alias("failed"), F.count_if("long_form").alias("long_form"))


def splits_present(rows: DataFrame) -> list[str]:
    found = {r[0] for r in rows.select("split").distinct().collect()}
    return [s for s in SPLITS if s in found] + sorted(found - set(SPLITS))


def paired_delta(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rates of two runs' scored samples by id and tier, and b minus a."""
    left, right = (x.select("id", "tier", rate("word").alias(f"wer_{n}"), rate("char").alias(f"cer_{n}")) for x, n in ((a, "a"), (b, "b")))
    return left.join(right, ["id", "tier"]).withColumn("wer_delta", F.col("wer_b") - F.col("wer_a")).withColumn("cer_delta", F.col("cer_b") - F.col("cer_a"))


def tier_delta(groups: DataFrame, low: str, high: str) -> DataFrame:
    """Per axis and value: the second tier's rates minus the first's."""
    a, b = (groups.where(F.col("tier") == t).select("axis", "value", *[F.col(r).alias(f"{r}_{n}") for r in ("wer", "cer", "ser")]) for t, n in ((low, "a"), (high, "b")))
    both = a.alias("a").join(b.alias("b"), (F.col("a.axis") == F.col("b.axis")) & F.col("a.value").eqNullSafe(F.col("b.value")))
    return both.select("a.axis", "a.value", *[(F.col(f"{r}_b") - F.col(f"{r}_a")).alias(f"{r}_delta") for r in ("wer", "cer", "ser")])


def masked_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of two records that differ beyond hypothesis and error, with the side that has them."""
    a, b = a.drop("hypothesis", "error"), b.drop("hypothesis", "error")
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def reference_mismatches(record: DataFrame, manifest: DataFrame) -> DataFrame:
    """Ids that only one side has, or whose references differ."""
    a, b = record.select("id", F.col("reference").alias("recorded")), manifest.select("id", F.col("text").alias("manifest"))
    return a.join(b, "id", "full_outer").where(~F.col("recorded").eqNullSafe(F.col("manifest")))


def character_errors(rows: DataFrame) -> DataFrame:
    """Edit totals without Python: adds ``errors`` (Levenshtein over code points), ``n`` and ``sentence_error`` for rows with a hypothesis.

    The built-in distance gives the sum of an alignment's errors, which is all that rates need.
    """
    done = rows.where("hypothesis is not null")
    return done.withColumns({"errors": F.levenshtein("reference", "hypothesis").cast("long"), "n": F.length("reference").cast("long"), "sentence_error": (F.col("reference") != F.col("hypothesis")).cast("long")})
