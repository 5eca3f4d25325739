"""N-gram Jaccard join by parity sketches.

Each document is the set of its distinct word n-grams. The set is XOR-hashed
into a bit sketch of ``K`` blocks: an n-gram toggles bits of the block that its
hash names, so the Hamming distance of two sketches never exceeds the sets'
symmetric difference. Jaccard >= num/den bounds that difference by
``d = floor(s * (den - num) / num)``, s the smaller size, so of ``K = d + 1 + t``
blocks at least ``t + 1`` agree (pigeonhole). Blocks are joined by the XOR of
their n-grams' 64-bit hashes, per size band: band g holds sizes of one geometric
step num/den, and a document joins in its own band and the one below, where its
smaller partners are.

Blocks with fewer than two n-grams say little. A document leaves them out where
it has at most ``t`` of them: if all agreeing blocks of a pair were such, each
side would have more than ``t``, and then it emits them. No pair is lost.

Equal sets have one name and are one node from the start. Nodes that share a block key
are chained to clusters inside their band (connected components, a superset of all
links). A task reduces the keys of its documents to one row a key and the links
among its own nodes, so a key that a third of all rows hold makes a row a task. Clusters
are dealt out in chunks, and every pair of chunks is one unit of work. A first round moves only
sketches: pairs whose Hamming distance exceeds the bound are out, and what is left
makes smaller clusters, still a superset. A second round moves the texts of those
and verifies by exact set intersection. Only a local spanning forest leaves
a unit, so a group of near copies never becomes a list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.frames import SALT, components, cut, written
from cadenza.llm.textkit import Words, distinct, frugal, mixed, shingles

#: Fewest n-grams of a block that says much.
RICH = 2
#: Documents of a chunk: least and most. Between them, a chunk of a band's largest sets holds CHUNK_GRAMS n-grams.
CHUNK_LEAST, CHUNK_MOST, CHUNK_GRAMS = 64, 4096, 1 << 21
#: Block keys that a task holds before it sends them on.
KEYS_HELD = 1 << 21

SKETCHED = "doc_id long, n_shingles long, hi long, lo long, sketch binary"


def band_of(sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Geometric size bands: sizes a <= b with a/b >= num/den lie in the same or in neighbouring bands."""
    edges = _edges(int(sizes.max()) if len(sizes) else 1, num, den)
    return np.searchsorted(edges, sizes, side="right") - 1


def _edges(most: int, num: int, den: int) -> np.ndarray:
    # edges[g + 1] > edges[g] * den / num: no partner of a size under edges[g + 1] reaches edges[g + 2].
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, edges[-1] * den // num + 1))
    return np.array(edges, np.int64)


def blocks_of(band: int, num: int, den: int) -> tuple[int, int]:
    """(K, t) of a band."""
    edges = [1]
    while len(edges) < band + 2:
        edges.append(max(edges[-1] + 1, edges[-1] * den // num + 1))
    d = (edges[band + 1] - 1) * (den - num) // num
    mean = num / (den - num)  # n-grams a block, about
    share = 0.25 if mean < 6 else 0.05
    t = int((d + 1) * share / (1 - share))
    return d + 1 + t, t


def block_keys(values: np.ndarray, band: int, num: int, den: int) -> np.ndarray:
    """The join keys of one set of n-gram hashes in one band."""
    count, t = blocks_of(band, num, den)
    block = (mixed(values ^ np.uint64(0xB10C)) % np.uint64(count)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    block, sorted_values = block[order], values[order]
    held = np.bincount(block, minlength=count)
    sketch = np.zeros(count, np.uint64)
    at = np.flatnonzero(held)
    if len(at):
        starts = np.concatenate(([0], np.cumsum(held[at])[:-1]))
        sketch[at] = np.bitwise_xor.reduceat(sorted_values, starts)
    rich = held >= RICH
    if np.count_nonzero(~rich) > t:
        rich[:] = True
    chosen = np.flatnonzero(rich)
    salt = np.uint64((band + 1) * 1_000_003) + chosen.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(sketch[chosen] ^ mixed(salt)).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per document: set size, 128 bits that name the set, and the parity sketch."""
    from cadenza.llm import ngram_join as own

    for batch in own.pieces(batches):
        sets = own.Sets(batch.column("text"), size)
        n = len(sets.sizes)
        hi, lo, sketches = np.zeros(n, np.int64), np.zeros(n, np.int64), [b""] * n
        for i in np.flatnonzero(sets.sizes).tolist():
            values = sets[i]
            hi[i] = own.name_of(values)
            lo[i] = np.bitwise_xor.reduce(mixed(values ^ np.uint64(0x5E7))).view(np.int64)
            sketches[i] = own.sketch_of(values)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sets.sizes, pa.int64()), pa.array(hi), pa.array(lo), pa.array(sketches, pa.binary())], names=["doc_id", "n_shingles", "hi", "lo", "sketch"])


def name_of(values: np.ndarray) -> np.int64:
    """64 bits that name a set; if two sets share them, their node stands for both, and links are only sought in more places."""
    return np.uint64(values.sum(dtype=np.uint64)).view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch], size: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, id, least) of the nodes' blocks, in a node's own band and the one below.

    Of each key one row with the smallest id that holds it here; for every other holder
    a link (id, least) inside the key's band. A key's lowest 8 bits are its band.
    """
    from cadenza.llm import ngram_join as own

    keys, ids, held = [], [], 0
    seen: set[int] = set()
    for batch in own.pieces(batches):
        sets = own.Sets(batch.column("text"), size)
        bands = own.band_of(sets.sizes, num, den)
        for i in np.flatnonzero(sets.sizes).tolist():
            name = own.name_of(sets[i])
            if int(name) in seen:
                continue
            seen.add(int(name))
            for band in range(max(0, int(bands[i]) - 1), int(bands[i]) + 1):
                keys.append((own.block_keys(sets[i], band, num, den) & ~0xFF) | (band & 0xFF))
                ids.append(np.full(len(keys[-1]), name, np.int64))
                held += len(keys[-1])
        if held >= own.KEYS_HELD:
            yield from own.reduced(np.concatenate(keys), np.concatenate(ids))
            # The names seen are forgotten as well: an equal set then only sends its keys once more.
            keys, ids, held, seen = [], [], 0, set()
    if held:
        yield from own.reduced(np.concatenate(keys), np.concatenate(ids))


def reduced(keys: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row a key, and the distinct links of the other holders to its smallest id."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    least = ids[new][np.cumsum(new) - 1]
    other = np.flatnonzero(ids != least)
    band, one, to = keys[other] & 0xFF, ids[other], least[other]
    order = np.lexsort((to, one, band))
    band, one, to = band[order], one[order], to[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (band[1:] != band[:-1]) | (one[1:] != one[:-1]) | (to[1:] != to[:-1])
    band, one, to = band[fresh], one[fresh], to[fresh]
    # A link's row needs no partner: its key only spreads it.
    apart = (mixed(one.view(np.uint64) ^ mixed(to.view(np.uint64))).view(np.int64) & ~0xFF) | band
    all_keys, all_ids = np.concatenate((keys[new], apart)), np.concatenate((ids[new], one))
    links = pa.array(np.concatenate((np.zeros(int(new.sum()), np.int64), to)), mask=np.concatenate((np.ones(int(new.sum()), bool), np.zeros(len(to), bool))))
    whole = pa.RecordBatch.from_arrays([pa.array(all_keys), pa.array(all_ids), links], names=["key", "id", "least"])
    for at in range(0, whole.num_rows, 200_000):
        yield whole.slice(at, 200_000)


def sketch_of(values: np.ndarray) -> bytes:
    """Parity sketch of a set: a power of two of bits, two to four for each n-gram."""
    width = min(1 << 16, max(256, 1 << (2 * len(values) - 1).bit_length()))
    return np.packbits(np.bincount((values % np.uint64(width)).astype(np.int64), minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(sketch: bytes, width: int) -> np.ndarray:
    """A sketch as 64-bit words, folded to ``width`` bits: halves are XORed, so distances only shrink."""
    words = np.frombuffer(sketch, np.uint64)
    while len(words) * 64 > width:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def pieces(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes, to bound the memory of wide batches; before and after all, the worker gives free memory back."""
    frugal()
    for batch in batches:
        if not batch.num_rows:
            continue
        step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)
    frugal()


class Sets:
    """n-gram sets of some documents."""

    def __init__(self, texts: pa.Array, size: int):
        words = Words(texts)
        self.values, self.first = distinct(*shingles(words, words.hashes(), size))
        self.sizes = np.diff(self.first)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.values[self.first[i] : self.first[i + 1]]


def parity(sets: Sets, at: np.ndarray, width: int) -> np.ndarray:
    """Parity sketches of ``width`` bits as rows of 64-bit words."""
    out = np.zeros((len(at), width // 8), np.uint8)
    for k, i in enumerate(at):
        out[k] = np.packbits(np.bincount((sets[i] % np.uint64(width)).astype(np.int64), minlength=width).astype(np.uint8) & 1)
    return out.view(np.uint64)


def verified(sets: Sets, left: np.ndarray, right: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``left`` and ``right`` (all pairs inside, where they are the same)."""
    same = left is right
    group = np.arange(len(sets.sizes))  # a smaller name of each document's links so far
    links = []

    def judge(i: int, others: np.ndarray) -> None:
        """Links ``i`` with the groups of ``others`` that it reaches; one link to each is enough."""
        done = set()
        for j in others[group[others] != group[i]].tolist():
            if group[j] == group[i] or group[j] in done:
                continue
            x, y = sets[i], sets[j]
            both = np.concatenate((x, y))
            both.sort()
            common = int(np.count_nonzero(both[1:] == both[:-1]))
            if den * common >= num * (len(x) + len(y) - common) and common:
                done.add(group[j])
                links.append((i, j))
        if done:
            group[np.isin(group, list(done))] = group[i]

    sizes = sets.sizes
    if len(left) * len(right) <= 64:
        for k, i in enumerate(left):
            rest = right[k + 1 :] if same else right
            judge(int(i), rest[np.minimum(sizes[i], sizes[rest]) * den >= np.maximum(sizes[i], sizes[rest]) * num])
        return links
    widest = int(max(sizes[left].max(), sizes[right].max()))
    width = min(16384, max(1024, 1 << (4 * widest - 1).bit_length()))
    a = parity(sets, left, width)
    b = a if same else parity(sets, right, width)
    size_b = sizes[right]
    for k, i in enumerate(left):
        rest = slice(k + 1, None) if same else slice(None)
        far = np.bitwise_count(b[rest] ^ a[k]).sum(axis=1, dtype=np.int64)
        total = size_b[rest] + sizes[i]
        # J >= num/den: the symmetric difference is at most (|A| + |B|)(den - num)/(den + num).
        near = np.flatnonzero((far * (den + num) <= total * (den - num)) & (np.minimum(size_b[rest], sizes[i]) * den >= np.maximum(size_b[rest], sizes[i]) * num))
        judge(int(i), right[rest][near[np.argsort(far[near], kind="stable")]])
    return links


def near(sizes: np.ndarray, sketches: list[bytes], left: np.ndarray, right: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that their sketches do not rule out."""
    same = left is right
    group = np.arange(len(sizes))
    width = 8 * min(len(sketches[i]) for i in {*left.tolist(), *right.tolist()})
    a = np.array([folded(sketches[i], width) for i in left])
    b = a if same else np.array([folded(sketches[i], width) for i in right])
    links = []
    for k, i in enumerate(left.tolist()):
        rest = slice(k + 1, None) if same else slice(None)
        others = sizes[right[rest]]
        far = np.bitwise_count(b[rest] ^ a[k]).sum(axis=1, dtype=np.int64)
        # J >= num/den: the symmetric difference is at most (|A| + |B|)(den - num)/(den + num).
        fits = (far * (den + num) <= (others + sizes[i]) * (den - num)) & (np.minimum(others, sizes[i]) * den >= np.maximum(others, sizes[i]) * num)
        others = right[rest][fits]
        found, one = np.unique(group[others], return_index=True)
        fresh = found != group[i]
        if fresh.any():
            links += [(i, j) for j in others[one[fresh]].tolist()]
            group[np.isin(group, found[fresh])] = group[i]
    return links


def _sieve(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit: doc_id, g, unit, side, n, sketch -> pairs (g, a, b) that may link."""
    from cadenza.llm import ngram_join as own

    for table in own.units_of(batches):
        ids, g, side, sizes = (table[c].to_numpy() for c in ("doc_id", "g", "side", "n"))
        sketches = table["sketch"].to_pylist()
        found = []
        for at in own.cuts_of(table):
            left, right = at[side[at] == 0], at[side[at] == 1]
            found += own.near(sizes, sketches, left, right if len(right) else left, num, den)
        one, other = [i for i, _ in found], [j for _, j in found]
        yield pa.RecordBatch.from_arrays([pa.array(g[one], pa.int32()), pa.array(ids[one], pa.int64()), pa.array(ids[other], pa.int64())], names=["g", "a", "b"])


def _verify(batches: Iterator[pa.RecordBatch], size: int, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by unit: doc_id, text, unit, side -> links (a, b)."""
    from cadenza.llm import ngram_join as own

    for table in own.units_of(batches):
        sets = own.Sets(table["text"], size)
        ids, side = table["doc_id"].to_numpy(), table["side"].to_numpy()
        found = []
        for at in own.cuts_of(table):
            left, right = at[side[at] == 0], at[side[at] == 1]
            found += own.verified(sets, left, right if len(right) else left, num, den)
        yield pa.RecordBatch.from_arrays([pa.array(ids[[i for i, _ in found]], pa.int64()), pa.array(ids[[j for _, j in found]], pa.int64())], names=["a", "b"])


def cuts_of(table: pa.Table) -> list[np.ndarray]:
    """Row numbers of each unit in turn."""
    unit = table["unit"].to_numpy()
    cuts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1], [True])))
    return [np.arange(lo, hi) for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)]


def units_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole units, from rows sorted by unit."""
    held: list[pa.RecordBatch] = []
    for batch in pieces(batches):
        unit = batch.column("unit").to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(unit[1:] != unit[:-1])
        if held and held[-1].column("unit")[-1].as_py() != unit[0]:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if len(ends):
            cutting = int(ends[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cutting)]).combine_chunks()
            held = [batch.slice(cutting)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def dealt(clusters: DataFrame, num: int, den: int) -> DataFrame:
    """Members of clusters (g, id, label) -> id, g, unit and side: every pair of a cluster's chunks is a unit."""
    sizes = cut(clusters.groupBy("g", "label").agg(F.count("*").alias("m")))
    edges = [1]
    while len(edges) < 257:
        edges.append(max(edges[-1] + 1, edges[-1] * den // num + 1))
    chunks = F.lit([max(CHUNK_LEAST, min(CHUNK_MOST, CHUNK_GRAMS // most)) for most in edges[1:]])
    members = clusters.join(sizes, ["g", "label"]).withColumn("parts", F.ceil(F.col("m") / F.get(chunks, F.col("g"))).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    return members.select("id", "g", F.xxhash64("g", "label", F.least("own", "other"), F.greatest("own", "other")).alias("unit"), F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"))


def jaccard_components(docs: DataFrame, size: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """Near-duplicate classes: documents link when den * |A & B| >= num * |A | B|.

    Returns one row per input row: ``doc_id``, ``n_shingles`` (set size) and
    ``component_id`` (the smallest doc_id reachable by links). Texts without
    words (null, empty, white space) have the empty set and link with nothing.
    Rows with the same doc_id are one document and so one class. Rows without a
    doc_id link with nothing and have a null component_id. Other columns, whatever their
    names, are not read.
    """
    if not 0 < num <= den:
        raise ValueError("0 < num <= den is needed")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = written(read.mapInArrow(partial(_sketch, size=size), SKETCHED), "sketches")
    live = sketched.where("n_shingles > 0 and doc_id is not null")
    sets = cut(live.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    keys = read.where("text is not null and doc_id is not null").mapInArrow(partial(_keys, size=size, num=num, den=den), "key long, id long, least long")
    stars = keys.withColumn("least", F.coalesce("least", F.min(F.when(F.col("least").isNull(), F.col("id"))).over(Window.partitionBy("key")))).where("id <> least")
    clusters = components(stars.select(F.col("key").bitwiseAND(0xFF).cast("int").alias("g"), F.col("id").alias("a"), F.col("least").alias("b")), ["g"])
    # Of equal sets one goes on: the copies link to it by their names.
    marks = live.select("doc_id", F.col("n_shingles").alias("n"), "hi", "lo", "sketch").join(sets.select("hi", "lo", F.col("rep").alias("doc_id")), ["hi", "lo", "doc_id"], "left_semi")
    near_units = marks.join(dealt(clusters, num, den).withColumnRenamed("id", "hi"), "hi").select("doc_id", "g", "unit", "side", "n", "sketch").repartition("unit").sortWithinPartitions("unit")
    close = near_units.mapInArrow(partial(_sieve, num=num, den=den), "g int, a long, b long")
    refined = components(close, ["g"])
    units = read.where("text is not null and doc_id is not null").join(dealt(refined, num, den).drop("g").withColumnRenamed("id", "doc_id"), "doc_id").select("doc_id", "text", "unit", "side")
    units = units.repartition("unit").sortWithinPartitions("unit")
    links = units.mapInArrow(partial(_verify, size=size, num=num, den=den), "a long, b long")
    # The copies of one set are spread over SALT tasks.
    spread = sets.where("copies > 1").select("hi", "lo", "rep", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<long>")).alias("salt"))
    same = live.select("doc_id", "hi", "lo", F.pmod(F.xxhash64("doc_id"), F.lit(SALT)).alias("salt")).join(spread, ["hi", "lo", "salt"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b")
    labels = components(links, [])
    copies = same.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALT)))
    known = labels.select(F.col("id").alias("b"), "label", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<long>")).alias("salt"))
    reps = copies.join(known, ["b", "salt"], "left").select(F.col("a").alias("id"), F.coalesce("label", "b").alias("label"))
    # One document may have several sets (rows that share a doc_id): join their classes too.
    repeated = live.groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeated:
        every = labels.select(F.col("id").alias("a"), F.col("label").alias("b")).unionByName(reps.select(F.col("id").alias("a"), F.col("label").alias("b")))
        found = components(every, [])
    else:
        found = labels.unionByName(reps)
    return sketched.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates (five words, 0.8): the one with the smallest doc_id, one row of it.

    Where doc_id repeats, each pair of doc_id and text is a document of its own: the smallest text settles ties of
    doc_id, the other columns those of equal rows.
    """
    if docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count():
        return _one_row_a_class(docs)
    found = jaccard_components(docs, size=5, num=8, den=10)
    gone = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def _one_row_a_class(docs: DataFrame) -> DataFrame:
    """The near-duplicate stage for repeated ids. Documents are named by a hash of doc_id and text, so the least row of a class is found by its columns."""
    name = F.shiftrightunsigned(F.xxhash64("doc_id", F.col("text").isNull(), "text"), 1)
    columns = ["doc_id", "text", *(c for c in docs.columns if c not in ("doc_id", "text"))]
    # One struct holds the row, so that no name clashes with its columns.
    rows = docs.where("doc_id is not null").select(name.alias("name"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    found = jaccard_components(rows.select(F.col("name").alias("doc_id"), F.col("row.text").alias("text")), size=5, num=8, den=10)
    classes = found.groupBy(F.col("doc_id").alias("name")).agg(F.min("component_id").alias("class"))
    least = rows.join(classes, "name").groupBy("class").agg(F.min("row").alias("row"))
    kept = least.select("row.*").select(*[F.col(f"`{c}`") for c in docs.columns])
    # rows without a doc_id are no copies of each other
    return docs.where("doc_id is null").unionByName(kept)


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Word 3-shingles, Jaccard of 0.9 or more, over all documents."""
    from cadenza.llm.frames import table

    return jaccard_components(table(spark, sf_dir, "documents"), size=3, num=9, den=10)


#: The same by an inverted index of shingles, for small tables.
OP1_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 3 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end) as sh from w
), n as (select doc_id, count(*) as n from s group by doc_id
), i as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2
), l as (select i.a, i.b from i join n x on x.doc_id = i.a join n y on y.doc_id = i.b where 100 * c >= 90 * (x.n + y.n - c)
), r as (select doc_id, doc_id as root from documents union select r.doc_id, l.b from r join l on l.a = r.root)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, (select min(root) from r where r.doc_id = d.doc_id) as component_id
from documents d left join n on n.doc_id = d.doc_id
"""
