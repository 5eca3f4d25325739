import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cadenza.llm.frames import components
from cadenza.llm.ngram_join import band_of, block_keys, blocks_of, jaccard_components, near_duplicate_stage, reduced
from cadenza.llm.textkit import Words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, size, num, den):
    """(doc_id, set size, component) by comparing all pairs of documents."""
    sets = {}
    for d, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets.setdefault(d, []).append(grams)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[i:]:
            if any(a and b and den * len(a & b) >= num * len(a | b) for a in sets[x] for b in sets[y]):
                p, q = sorted((root(x), root(y)))
                parent[q] = p
    return sorted((d, len(s), root(d)) for d, own in sets.items() for s in own)


def corpus(seed, count=60):
    rng = random.Random(seed)
    rows = []
    for k in range(count):
        if rows and rng.random() < 0.7:
            words = list(rng.choice(rows)[1].split())
            for _ in range(rng.randrange(0, 6)):
                at = rng.randrange(len(words) + 1)
                words[at : at + rng.randrange(2)] = [f"w{rng.randrange(50)}"] * rng.randrange(2)
        else:
            words = [f"W{rng.randrange(300)}" for _ in range(rng.choice([1, 2, 3, 5, 9, 20, 60, 200]))]
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("size, num, den", [(3, 9, 10), (5, 8, 10), (1, 1, 2)])
def test_equals_brute_force(spark, size, num, den):
    rows = corpus(size)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size, num, den).collect()
    assert sorted(map(tuple, got)) == brute(rows, size, num, den)


def test_large_group_is_chunked(spark):
    """A group of near copies that spans several chunks; some members link only through others."""
    rng = random.Random(5)
    base = [f"x{i}" for i in range(90)]
    rows = []
    for k in range(300):
        words = list(base)
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(90)] = f"y{rng.randrange(1000)}"
        rows.append((k, " ".join(words)))
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 9, 10)


@pytest.mark.parametrize("num, den", [(9, 10), (8, 10), (1, 2)])
def test_pairs_share_a_key(num, den):
    """The pigeonhole argument: any pair at the threshold meets in some band."""
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 9, 10, 19, 40, 137, 800):
        for _ in range(30):
            a = rng.integers(0, 1 << 63, n).astype(np.uint64)
            for gone in range(n + 1):
                b = a[gone:]
                if den * len(b) < num * len(a) or not len(b):
                    break
                x, y = (int(v) for v in band_of(np.array([len(a), len(b)]), num, den))
                assert y in (x, x - 1)
                assert set(block_keys(a, y, num, den)) & set(block_keys(b, y, num, den))
                if gone > 3 and n > 100:
                    break
    assert blocks_of(0, num, den)[0] >= 1


def test_edges(edge, edge_rows, empty):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard_components(edge, 3, 9, 10).collect()}
    assert got[2, 9] == got[1, 9] == 1
    assert got[3, 0] == 3 and got[4, 0] == 4 and got[5, 0] == 5
    assert got[9, 1] == 9
    assert got[None, 3] is None and got[None, 0] is None
    assert jaccard_components(edge, 3, 9, 10).count() == len(edge_rows)
    assert jaccard_components(empty).count() == 0


def test_repeated_ids_are_one_document(spark):
    rows = [(1, "a b c d"), (1, "e f g h"), (2, "e f g h"), (3, "a b c d")]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10).collect()
    assert {r.component_id for r in got} == {1}


def test_stage_keeps_one_of_each_class(spark, edge, empty):
    kept = near_duplicate_stage(spark, edge, "")
    assert kept.columns == edge.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8, 9, 10]
    assert kept.where("doc_id is null").count() == 2
    assert near_duplicate_stage(spark, empty, "").count() == 0


def test_stage_keeps_different_texts_of_one_id(spark):
    a, b, c = ("one two three four five six seven", "alpha beta gamma delta epsilon zeta eta", "red green blue black white grey brown")
    rows = [(1, b, "x"), (1, a, "y"), (1, a, "x"), (2, a, "z"), (3, c, "z"), (None, a, "z")]
    for n in (1, 5):
        kept = near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(n), "")
        assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, b, "x"), (1, a, "x"), (3, c, "z"), (None, a, "z")], key=str)


def test_chain_of_links(spark):
    """Two hundred documents, each linked to the next alone; the smallest id is at the far end."""
    rows = [(k % 200 + 1, " ".join(f"v{i}" for i in range(9 * k, 9 * k + 90))) for k in range(200)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 8, 10).collect()
    assert {r.component_id for r in got} == {1}
    ends = [(r.doc_id - 1, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").where("doc_id <> 100"), 1, 8, 10).collect()]
    assert all(c == (1 if d < 99 else 101) for d, c in ends)


def test_components_of_chains_and_hubs(spark):
    """Orders in which labels travel badly: a chain with its smallest id at the end, and a hub with the largest id."""
    chain = [(0, k, k + 1) for k in range(1, 300)] + [(0, 0, 300)]
    hub = [(1, 999, k) for k in range(400)]
    got = components(spark.createDataFrame(chain + hub, "g int, a long, b long").repartition(8), ["g"]).collect()
    assert sorted(map(tuple, got)) == sorted([(0, k, 0) for k in range(301)] + [(1, k, 0) for k in [*range(400), 999]])


def test_a_key_of_all_rows_is_one_row_a_task():
    keys, ids = np.array([256] * 1000 + [512, 512]), np.array([*range(1000), 3, 2])
    got = pa.Table.from_batches(reduced(keys, ids)).to_pylist()
    assert [(r["key"], r["id"]) for r in got if r["least"] is None] == [(256, 0), (512, 2)]
    assert sorted((r["id"], r["least"]) for r in got if r["least"] is not None) == sorted([(k, 0) for k in range(1, 1000)] + [(3, 2)])


@pytest.mark.parametrize("n", [1024, 2048, 4096, 8192])
def test_thue_morse_words_differ(n):
    """Words that a polynomial modulo 2**64 cannot tell apart."""
    word = "".join("ab"[k.bit_count() & 1] for k in range(n))
    other = word.translate(str.maketrans("ab", "ba"))
    found = Words(pa.array([f"{word} {other}", other])).hashes()
    assert found[0] != found[1] == found[2]
