import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cadenza.llm import ctw
from cadenza.llm.textkit import Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def coded_bytes(text):
    return " ".join(re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))).encode() + b"\n"


def test_stream_holds_the_tokens():
    texts = ["Hello  World\t", "", None, " x", "É b\nC", "   "]
    words = Words(pa.array(texts))
    data, first, last = ctw.stream(words, 3)
    assert [bytes(data[a:b]) for a, b in zip(first, last, strict=True)] == [coded_bytes(t) for t in texts]
    assert all(bytes(data[a - 3 : a]) == b"\n\n\n" for a in first)
    mask = ctw.coded(first, last, len(data))
    assert mask.sum() == sum(len(coded_bytes(t)) for t in texts)
    keys = ctw.runs(data, mask, 2)
    assert int(keys[1]) == ord("e") | ord("h") << 8 | 0x0A << 16


class Slow:
    """Context-tree weighting by recursion over dictionaries of counts, one node at a time."""

    def __init__(self, texts, depth, least):
        self.depth, self.least, self.counts = depth, least, {}
        for t in texts:
            data = b"\n" * depth + coded_bytes(t)
            for p in range(depth, len(data)):
                for d in range(depth + 1):
                    self.counts.setdefault(data[p - d : p], Counter())[data[p]] += 1

    def kept(self, context):
        return sum(self.counts.get(context, {}).values()) >= self.least

    def children(self, context):
        return [c for c in self.counts if len(c) == len(context) + 1 and c[1:] == context and self.kept(c)] if len(context) < self.depth else []

    @staticmethod
    def split(counts, prefix, bit):
        zero = sum(n for b, n in counts.items() if b >> (8 - bit) == prefix and not b >> (7 - bit) & 1)
        one = sum(n for b, n in counts.items() if b >> (8 - bit) == prefix and b >> (7 - bit) & 1)
        return zero, one

    @staticmethod
    def kt(zero, one):
        return math.lgamma(zero + 0.5) + math.lgamma(one + 0.5) - math.lgamma(zero + one + 1) - math.log(math.pi)

    def rest(self, context):
        left = Counter(self.counts.get(context, {}))
        for c in self.children(context):
            left.subtract(self.counts[c])
        return left

    def weighted(self, context, prefix, bit):
        own = self.kt(*self.split(self.counts.get(context, {}), prefix, bit))
        below = self.children(context)
        if not below:
            return own
        product = self.kt(*self.split(self.rest(context), prefix, bit)) + sum(self.weighted(c, prefix, bit) for c in below)
        return np.logaddexp(own, product) - math.log(2)

    def probability(self, history, byte):
        total = 0.0
        for bit in range(8):
            prefix, want = byte >> (8 - bit), byte >> (7 - bit) & 1

            def ahead(counts):
                zero, one = self.split(counts, prefix, bit)  # noqa: B023
                return ((one if want else zero) + 0.5) / (zero + one + 1)  # noqa: B023

            def mix(context):
                below = self.children(context)
                if not below:
                    return ahead(self.counts.get(context, {}))
                share = math.exp(self.kt(*self.split(self.counts[context], prefix, bit)) - math.log(2) - self.weighted(context, prefix, bit))  # noqa: B023
                longer = history[len(history) - len(context) - 1 :]
                return share * ahead(self.counts[context]) + (1 - share) * (mix(longer) if longer in below else ahead(self.rest(context)))  # noqa: B023

            total += math.log10(mix(b""))
        return total


def test_tree_equals_recursion(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(25))) for _ in range(12)]
    depth, contexts = 2, 12
    data = [coded_bytes(t) for t in texts]
    total = sum(map(len, data))
    slow = Slow(texts, depth, total / contexts)
    docs = spark.createDataFrame([(k, t, False) for k, t in enumerate(texts)] + [(99, "cab zz b", True)], "doc_id long, text string, held_out boolean")
    for r in ctw.scored(docs, depth=depth, contexts=contexts).collect():
        text = "cab zz b" if r.doc_id == 99 else texts[r.doc_id]
        whole = b"\n" * depth + coded_bytes(text)
        want = sum(slow.probability(whole[p - depth : p], whole[p]) for p in range(depth, len(whole)))
        assert abs(r.score - want) < 1e-4 * abs(want) + 1e-5


def test_distributions_sum_to_one(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.lit(False).alias("held_out"))
    words = Words(pa.array([r.text for r in docs.collect()]))
    data, first, last = ctw.stream(words, 3)
    keys, counts = np.unique(ctw.runs(data, ctw.coded(first, last, len(data)), 3), return_counts=True)
    tree = ctw.grown(spark.createDataFrame([(int(k), int(n)) for k, n in zip(keys, counts, strict=True)], "key long, n long"), int(counts.sum()), 3, 500)
    assert np.abs((10.0 ** tree.logs.astype(float)).sum(axis=1) - 1).max() < 1e-5


def test_query_base_score(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    tokens = {d: [*coded_bytes(t).split(), b"\n"] for d, t in docs.items()}
    counts = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    rows = ctw.op4_lm_scoring(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in counts for w in ws), n)
        assert abs(r.base_score - sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6 * len(ws)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
        assert r.score < 0 and r.bits_per_byte < 8


def test_edges(edge, empty, edge_rows):
    marked = edge.withColumn("held_out", F.coalesce(F.col("doc_id") == 2, F.lit(False)))
    got = ctw.scored(marked, depth=2, contexts=64, heavy=50).collect()
    assert len(got) == len(edge_rows)
    same = {(round(r.score, 6), round(r.base_score, 6)) for r in got if r.doc_id in (1, 2)}
    assert len(same) == 1
    assert {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {1}
    untaught = ctw.scored(marked, learn="false", depth=2).collect()
    assert {r.base_score for r in untaught} == {0.0} and {r.train_tokens for r in untaught} == {0}
    for r in untaught:
        assert abs(r.score + r.n_bytes * 8 * math.log10(2)) < 1e-3 * r.n_bytes
    assert ctw.scored(empty.withColumn("held_out", F.lit(False))).count() == 0


def test_tree_grows_with_the_corpus(spark):
    """Contexts that occur LEAST times are kept, however small their share of the corpus: about 50,000 at the depth of the test, beyond the 32,768 of the former cap."""
    rng = random.Random(5)
    letters = "".join(map(chr, range(0x21, 0x7F))).translate(LOWER)
    texts = [" ".join(["".join(rng.choice(letters) for _ in range(7))] * 2) for _ in range(12_000)]
    docs = spark.createDataFrame([(k, t, False) for k, t in enumerate(texts)], "doc_id long, text string, held_out boolean")
    mean = lambda **more: ctw.scored(docs, depth=4, **more).agg(F.avg("bits_per_byte")).first()[0]
    assert mean() < mean(contexts=1 << 15) - 0.3


def test_blocks_equal_recursion_on_all_contexts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randrange(25))) for _ in range(12)]
    slow = Slow(texts, 4, ctw.LEAST)
    docs = spark.createDataFrame([(k, t, False) for k, t in enumerate(texts)] + [(99, "cab zz b", True)], "doc_id long, text string, held_out boolean")
    for r in ctw.scored(docs, depth=4).collect():
        whole = b"\n" * 4 + coded_bytes("cab zz b" if r.doc_id == 99 else texts[r.doc_id])
        want = sum(slow.probability(whole[p - 4 : p], whole[p]) for p in range(4, len(whole)))
        assert abs(r.score - want) < 1e-4 * abs(want) + 1e-5
