import hashlib
import random

from cadenza.llm import simhash
from cadenza.llm.frames import Buckets


def test_edited_texts_and_next_documents(spark, sf_dir):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r.doc_id: r for r in simhash.op5_simhash(spark, sf_dir).collect()}
    prints = {d: int(got[d].fingerprint, 16) for d, _ in docs}
    for k, (d, t) in enumerate(docs):
        after, other = docs[(k + 1) % len(docs)]
        half = len(t) // 2
        edited = t[: len(t) - half] + other[:half]
        r = got[d]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == 1 - (prints[d] ^ int(r.edited_fingerprint, 16)).bit_count() / 64
        assert r.near_next == 1 - (prints[d] ^ prints[after]).bit_count() / 64
    mean = lambda name: sum(getattr(r, name) for r in got.values()) / len(got)
    assert mean("near_edited") > mean("near_next") + 0.08


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(["a bb ccc", "a  bb\tccc ", "", None, "x" * 40])], "k long, text string")
    got = {r.k: r.fingerprint for r in simhash.with_fingerprints(df, ["k"]).collect()}
    assert got[0] == got[1] != got[4]
    assert got[2] == got[3] == 0


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for p in prints[:20]:
        for _ in range(3):
            for _ in range(rng.randrange(6)):
                p ^= 1 << rng.randrange(64)
            prints.append(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed] + [(None,)], "fingerprint long")
    for radius in (0, 1, 3, 5):
        want = {(a, b, ((a ^ b) & ((1 << 64) - 1)).bit_count()) for a in set(signed) for b in set(signed) if a < b}
        assert {tuple(r) for r in simhash.near_pairs(df, radius).collect()} == {w for w in want if w[2] <= radius}


def test_buckets_keep_order(spark):
    ids = [0, 1, 2, 3, *range(10_000, 10_400), 10**12, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = sorted((r[0], r[1]) for r in df.select("doc_id", Buckets(df, "doc_id", 16).column()).collect() if r[0] is not None)
    assert [b for _, b in got] == sorted(b for _, b in got)
    counts = [sum(x == b for _, x in got) for b in {b for _, b in got}]
    assert len(counts) > 8 and max(counts) < 60


def test_edges(spark, edge, empty, edge_rows):
    rows = simhash.edited_fingerprints(edge).collect()
    assert len(rows) == len(edge_rows)
    assert sorted(r.n_chars for r in rows) == sorted(len(t or "") for _, t, _, _ in edge_rows)
    assert all(r.near_next is None for r in rows if r.doc_id is None)
    assert all(r.near_next is not None for r in rows if r.doc_id is not None)
    assert simhash.edited_fingerprints(empty).count() == 0
    one = spark.createDataFrame([(7, "just one document")], "doc_id long, text string")
    (r,) = simhash.edited_fingerprints(one).collect()
    assert r.near_next == 1.0
