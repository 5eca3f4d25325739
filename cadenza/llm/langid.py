"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An
n-gram binds the permuted (rotated) vectors of its letters by elementwise
product; a text bundles (adds) the vectors of its n-grams; a language prototype
bundles all n-grams of its training texts. A text has the language whose
prototype has the largest cosine with the text's vector.

Training sums integer vectors, per task first and then per language and
dimension, so it is exact in any order and only languages x dimensions numbers
reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.frames import table
from cadenza.llm.ngram_join import pieces
from cadenza.llm.textkit import mixed

DIMENSIONS, NGRAM = 1024, 3
#: Letters that a prediction needs.
UNKNOWN = "und"


def letter_vectors(points: np.ndarray, dims: int) -> np.ndarray:
    """A +1/-1 vector of each code point (0: a boundary between words)."""
    lanes = np.arange(dims // 64, dtype=np.uint64)
    bits = mixed(mixed(points.astype(np.uint64) + np.uint64(0xA11CE))[:, None] + lanes[None, :] * np.uint64(0x9E3779B97F4A7C15))
    return (np.unpackbits(bits.view(np.uint8).reshape(len(points), -1), axis=1).astype(np.int8) * 2 - 1).reshape(len(points), dims)


def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)


def letters(texts: list[str | None], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lower-cased letters as code points, runs of anything else as one 0, each text between 0s; first of n + 1)."""
    lowered = [("\n" + t.lower() + "\n") if t else "\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    first = np.concatenate(([0], np.cumsum([len(t) for t in lowered]))).astype(np.int64)
    small = points < (1 << 16)
    good = is_letter[np.where(small, points, 0)]
    if not small.all():
        others = np.flatnonzero(~small)
        good[others] = [chr(p).isalpha() for p in points[others]]
    points = np.where(good, points, 0)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    keep[first[:-1][first[:-1] < len(points)]] = True
    ends = np.concatenate(([0], np.cumsum(keep)))
    return points[keep], ends[first]


class Grams:
    """n-grams of a batch: ``codes`` per position, ``doc`` of each, and the alphabet that turns codes into letters."""

    def __init__(self, texts: list[str | None], is_letter: np.ndarray, n: int):
        points, first = letters(texts, is_letter)
        self.alphabet = np.unique(points) if len(points) and points.max() >= (1 << 21) else np.flatnonzero(np.bincount(points, minlength=1))
        ids = np.zeros(int(self.alphabet[-1]) + 1 if len(self.alphabet) else 1, np.int64)
        ids[self.alphabet] = np.arange(len(self.alphabet))
        x = ids[points]
        size = max(len(self.alphabet), 1)
        self.n, self.size = n, size
        count = max(0, len(x) - n + 1)
        codes = np.zeros(count, np.int64)
        for k in range(n):
            codes = codes * size + x[k : k + count]
        doc = np.repeat(np.arange(len(texts)), np.diff(first))
        inside = doc[:count] == doc[n - 1 : n - 1 + count] if count else np.zeros(0, bool)
        lettered = np.zeros(count, bool)
        for k in range(n):
            lettered |= points[k : k + count] != 0
        keep = inside & lettered
        self.codes, self.doc = codes[keep], doc[:count][keep]
        self.with_letters = np.bincount(doc[points != 0], minlength=len(texts)) > 0

    def vectors(self, codes: np.ndarray, dims: int) -> np.ndarray:
        """Bound vectors of n-gram codes."""
        base = letter_vectors(self.alphabet, dims)
        out = np.ones((len(codes), dims), np.int8)
        for k in range(self.n):
            letter = codes // self.size ** (self.n - 1 - k) % self.size
            out *= np.roll(base, self.n - 1 - k, axis=1)[letter]
        return out


def counted(codes: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray]:
    if space <= 4_000_000:
        c = np.bincount(codes, minlength=1)
        found = np.flatnonzero(c)
        return found, c[found]
    return np.unique(codes, return_counts=True)


def _bundles(batches: Iterator[pa.RecordBatch], dims: int, n: int) -> Iterator[pa.RecordBatch]:
    """Per task: one vector a language."""
    from cadenza.llm import langid as own

    table, sums = own._is_letter(), {}
    for batch in own.pieces(batches, 2 << 20):
        grams = own.Grams(batch.column("text").to_pylist(), table, n)
        langs, at = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
        for k, lang in enumerate(langs):
            codes, counts = own.counted(grams.codes[at[grams.doc] == k], grams.size**n)
            total = sums.setdefault(lang, np.zeros(dims, np.int64))
            # Both kinds hold the sums exactly.
            kind = np.float32 if counts.sum() < 1 << 24 else np.float64
            for lo in range(0, len(codes), 2048):
                total += np.rint(counts[lo : lo + 2048].astype(kind) @ grams.vectors(codes[lo : lo + 2048], dims).astype(kind)).astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])


class Prototypes:
    """Languages in ascending order and their unit vectors."""

    def __init__(self, langs: list[str], vectors: np.ndarray, n: int):
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        self.langs, self.n = langs, n
        self.vectors = (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)


def learned(labelled: DataFrame, dims: int = DIMENSIONS, n: int = NGRAM) -> Prototypes:
    """Prototypes of all languages of ``labelled`` (text, lang; rows with a null in either teach nothing)."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    parts = rows.mapInArrow(partial(_bundles, dims=dims, n=n), "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()
    langs = sorted({r[0] for r in sums})
    place = {lang: k for k, lang in enumerate(langs)}
    vectors = np.zeros((len(langs), dims))
    for lang, i, x in sums:
        vectors[place[lang], i] = x
    return Prototypes(langs, vectors, n)


def scores(texts: list[str | None], prototypes: Prototypes, is_letter: np.ndarray, block: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """(index of the best prototype, -1 without letters or prototypes; its cosine, 0 at least)."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if not len(prototypes.langs):
        return best, score
    dims = prototypes.vectors.shape[1]
    grams = Grams(texts, is_letter, prototypes.n)
    found, _ = counted(grams.codes, grams.size**prototypes.n)
    vectors = grams.vectors(found, dims)
    at = np.searchsorted(found, grams.codes)
    cuts = np.searchsorted(grams.doc, np.arange(0, len(texts) + block, block))
    for k in range(len(cuts) - 1):
        lo, hi = cuts[k], cuts[k + 1]
        if lo == hi:
            continue
        own, where = np.unique(at[lo:hi], return_inverse=True)
        rows = min(block, len(texts) - k * block)
        counts = np.bincount((grams.doc[lo:hi] - k * block) * len(own) + where, minlength=rows * len(own)).reshape(rows, len(own)).astype(np.float32)
        bundle = np.zeros((rows, dims), np.float32)
        for c in range(0, len(own), 4096):
            bundle += counts[:, c : c + 4096] @ vectors[own[c : c + 4096]].astype(np.float32)
        norm = np.linalg.norm(bundle, axis=1)
        cosines = bundle @ prototypes.vectors.T / np.where(norm > 0, norm, 1)[:, None]
        lettered = grams.with_letters[k * block : k * block + rows]
        here = slice(k * block, k * block + rows)
        best[here] = np.where(lettered, cosines.argmax(axis=1), -1)
        score[here] = np.where(lettered, np.clip(cosines.max(axis=1), 0.0, 1.0), 0.0)
    return best, score


def _predict(batches: Iterator[pa.RecordBatch], prototypes: Prototypes, named: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    from cadenza.llm import langid as own

    is_letter, langs = own._is_letter(), np.array([*prototypes.langs, own.UNKNOWN], dtype=object)
    for batch in own.pieces(batches, 1 << 20):
        best, score = own.scores(batch.column("text").to_pylist(), prototypes, is_letter)
        names = [c for c in batch.schema.names if c not in named]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(langs[best].tolist(), pa.string()), pa.array(score, pa.float64())], names=[*names, *named])


def predicted(docs: DataFrame, prototypes: Prototypes, named: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score under the names of ``named`` (columns of these names are replaced).

    A text without letters (null, empty, digits) has ``und`` and 0, and so has
    every text where nothing was learned. Ties go to the first language by code point. Repeated rows
    have equal predictions.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    kept = [f for f in docs.schema.fields if f.name not in named]
    schema = StructType([*kept, StructField(named[0], StringType()), StructField(named[1], DoubleType())])
    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(partial(_predict, prototypes=prototypes, named=named), schema)


def remainder(modulus: int) -> Column:
    """crc32(doc_id as text) modulo ``modulus``; a null doc_id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    docs = docs.withColumn("held_out", remainder(4) == 2)
    prototypes = learned(docs.where("not held_out"))
    return predicted(docs.select("doc_id", "held_out", "text"), prototypes).select("doc_id", "held_out", "lang_pred", "score")


#: Of texts in an unlearned script, this share passes, about. Texts of one or two words of a learned language may be lost as well.
PASSING = 0.01


def least_score(prototypes: Prototypes) -> float:
    """Cosines of unrelated texts scatter around 0 by 1 / sqrt(dimensions); the largest of one a language is above this in PASSING of cases."""
    count = max(len(prototypes.langs), 1)
    return NormalDist().inv_cdf((1 - PASSING) ** (1 / count)) / math.sqrt(DIMENSIONS)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language: those with letters whose best cosine is at least ``least_score``."""
    prototypes = learned(docs.where(remainder(4) != 2))
    named = tuple(next(n for k in range(len(docs.columns) + 1) if (n := f"_{name}{k}") not in docs.columns) for name in ("lang", "score"))
    found = predicted(docs, prototypes, named)
    return found.where((F.col(named[0]) != UNKNOWN) & (F.col(named[1]) >= least_score(prototypes))).select(*[F.col(f"`{c}`") for c in docs.columns])
