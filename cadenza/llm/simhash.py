"""Document fingerprints: 64-bit SimHash in DataFrame functions only.

Terms are words; a term weighs the square of its length (to 15 letters), so that
short function words hardly vote. Its 64-bit hash votes on 64 signed bits. The
votes of two bits share one 64-bit sum (bits j and j + 32), so a word costs 32
additions inside generated code, summed before any row leaves its task; bit j is set where
more than half of the document's weight voted for it. (A sum holds 2**31 / 225,
about 9.5 million long words a document.)

``near_pairs`` finds all fingerprints within a Hamming radius by permuted block
tables: of ``radius + 2`` blocks at least two agree, so the tables of all block
pairs, each an equi-join on the two blocks, contain every pair.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm.frames import Buckets, table, written

BITS, HALF = 64, 32
LONGEST = 15
_SEPARATOR = r"[\x20\x09-\x0D]+"


def with_fingerprints(texts: DataFrame, keys: list[str], text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``keys`` (unique together, ids of rows) and the fingerprint as a long; a text without words (null, empty) has 0."""
    words = texts.select(*keys, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), _SEPARATOR, -1)).alias("word"))
    length = F.least(F.length("word"), F.lit(LONGEST)).cast("long")
    words = words.select(*keys, F.xxhash64("word").alias("h"), (length * length).alias("w"))
    pair = F.lit((1 << HALF) | 1)
    votes = [F.sum(F.shiftright("h", j).bitwiseAND(pair) * F.col("w")).alias(f"v{j}") for j in range(HALF)]
    summed = words.groupBy(*keys).agg(F.sum("w").alias("all"), *votes)
    bit = lambda votes, j: F.when(votes * 2 > F.col("all"), F.shiftleft(F.lit(1).cast("long"), j)).otherwise(F.lit(0).cast("long"))
    bits = [bit(F.col(f"v{j}").bitwiseAND(F.lit((1 << HALF) - 1)), j) for j in range(HALF)] + [bit(F.shiftrightunsigned(f"v{j}", HALF), j + HALF) for j in range(HALF)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return summed.select(*keys, out.alias(name))


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def near_pairs(fingerprints: DataFrame, radius: int = 3) -> DataFrame:
    """All pairs of different fingerprints within ``radius`` bits: ``a`` < ``b`` (as signed longs) and ``distance``.

    Equal fingerprints are one row before the join (membership is the join of
    ids with fingerprints), nulls are left out; an empty table gives no pair.
    """
    if not 0 <= radius <= 20:
        raise ValueError("radius from 0 to 20")
    distinct = fingerprints.select(F.col("fingerprint").alias("f")).where("f is not null").distinct()
    count = radius + 2
    cuts = [BITS * i // count for i in range(count + 1)]
    mask = lambda i: ((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i]
    tables = [(i, mask(a) | mask(b)) for i, (a, b) in enumerate(combinations(range(count), 2))]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    blocks = F.array(*[F.struct(F.lit(i).alias("t"), F.col("f").bitwiseAND(F.lit(signed(m)).cast("long")).alias("key")) for i, m in tables])
    keyed = distinct.select("f", F.explode(blocks).alias("k")).select("f", "k.t", "k.key")
    pairs = keyed.alias("x").join(keyed.alias("y"), (F.col("x.t") == F.col("y.t")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.f") < F.col("y.f")))
    distance = F.bit_count(F.col("x.f").bitwiseXOR(F.col("y.f")))
    return pairs.where(distance <= radius).select(F.col("x.f").alias("a"), F.col("y.f").alias("b"), distance.alias("distance")).distinct()


def followed(docs: DataFrame) -> DataFrame:
    """Each row with the next one by ascending doc_id (text settles repeated ids; after the last comes the first).

    Adds ``bucket`` and ``row`` (a key of the row), ``next_bucket`` and ``next_row`` and
    ``next_text``. Rows are dealt to many order-preserving buckets by one
    shuffle; each bucket also gets a copy of the first row of the next one, so no
    row has to look beyond its bucket. Rows without a doc_id have no next
    document and an empty next text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = Buckets(docs.select("doc_id"), "doc_id")
    home = docs.withColumn("bucket", buckets.column())
    heads = sorted((r[0], r[1]) for r in home.where("doc_id is not null").groupBy("bucket").agg(F.min("doc_id")).collect())
    # At most one row a bucket, of which Buckets makes a bounded number.
    before = docs.sparkSession.createDataFrame([(first, heads[i - 1][0]) for i, (_, first) in enumerate(heads)], "doc_id long, also int")
    home = home.join(F.broadcast(before), "doc_id", "left")
    both = F.array(F.struct(F.col("bucket").alias("at"), F.lit(0).alias("ghost")), F.struct(F.col("also").alias("at"), F.lit(1).alias("ghost")))
    dealt = home.select("doc_id", "text", F.col("bucket").alias("home"), F.explode(both).alias("p")).select("doc_id", "text", "home", F.col("p.at").alias("bucket"), F.col("p.ghost").alias("ghost")).where("bucket is not null")
    order = Window.partitionBy("bucket").orderBy("ghost", "doc_id", "text")
    dealt = dealt.withColumn("row", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))
    dealt = dealt.withColumn("next_bucket", F.lead("home").over(order)).withColumn("next_row", F.when(F.lead("ghost").over(order) == 1, 1).otherwise(F.lead("row").over(order)))
    dealt = dealt.where("ghost = 0")
    known = F.col("doc_id").isNotNull()
    return dealt.select("doc_id", "text", "bucket", "row", F.when(known, F.col("next_text")).otherwise("").alias("next_text"), F.when(known, F.col("next_bucket")).alias("next_bucket"), F.when(known, F.col("next_row")).alias("next_row"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited texts and likenesses; one row per input row.

    Nulls: a null text is empty; a row without a doc_id loses its last half and has a null ``near_next``.
    """
    rows = followed(docs)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)))
    own = ["bucket", "row", "doc_id", "n_chars", "edited_sha256", "next_bucket", "next_row"]
    rows = rows.select("bucket", "row", "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "next_bucket", "next_row", "text", "edited")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("t")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("t")))
    texts = rows.select(*own, F.explode(sides).alias("s")).select(*own, "s.side", "s.t")
    prints = with_fingerprints(texts, [*own, "side"], "t", "f")
    prints = prints.groupBy(*own).agg(F.max(F.when(F.col("side") == 0, F.col("f"))).alias("f"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("e"))
    # Two branches read the prints.
    prints = written(prints, "prints")
    nexts = prints.select(F.col("bucket").alias("next_bucket"), F.col("row").alias("next_row"), F.col("f").alias("next_f"))
    return prints.join(nexts, ["next_bucket", "next_row"], "left").select(
        "doc_id", "n_chars", "edited_sha256", hexadecimal(F.col("f")).alias("fingerprint"), hexadecimal(F.col("e")).alias("edited_fingerprint"), likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("next_f")).alias("near_next")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
