"""Token ids in files of interleaved range asymmetric numeral systems (rANS).

Format. A file set is a Parquet table of chunks in ascending document order and
a table of shared symbol frequencies (summing to 2**SCALE). A chunk holds whole
documents: their ids and lengths, the number of ids of all chunks before it, and
its payload, a row of independent blocks. A block holds up to BLOCK ids, coded by
LANES interleaved 64-bit states over 32-bit words. For each block there is a
checkpoint (byte offset in the payload, number of ids) and a CRC-32 of its bytes, so any block
can be found, checked and decoded by itself.

Block: lanes' final states (uint64 each), then the words of all steps in
decoding order, little-endian.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.frames import Buckets, new_path, table, written
from cadenza.llm.ngram_join import pieces

SCALE, BLOCK, LANES = 20, 1 << 18, 1 << 12
LOW = 1 << 31
#: Ids of a chunk, about; a longer document is a chunk of many blocks.
CHUNK = 1 << 19
#: Distinct pre-tokens that a worker remembers.
REMEMBERED = 700_000

CHUNKS = "bucket int, part int, first_id long, docs binary, lengths binary, payload binary, offsets binary, counts binary, checks binary"


def frequencies(counts: dict[int, int], scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(symbols in ascending order, frequencies of at least 1 that sum to 2**scale), in proportion to the counts."""
    symbols = np.array(sorted(counts), np.int64)
    if not len(symbols):
        return symbols, symbols
    seen = np.array([counts[int(s)] for s in symbols], np.float64)
    room = (1 << scale) - len(symbols)
    if room < 0:
        raise ValueError("more symbols than slots")
    share = seen / seen.sum() * room
    out = np.floor(share).astype(np.int64)
    order = np.lexsort((symbols, -(share - out)))
    out[order[: room - int(out.sum())]] += 1
    return symbols, out + 1


class Coder:
    """Encodes and decodes blocks of ids with one table of frequencies."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray, scale: int = SCALE):
        self.scale = np.uint64(scale)
        self.symbols = symbols
        self.freq = freqs.astype(np.uint64)
        self.start = np.concatenate(([0], np.cumsum(freqs)[:-1])).astype(np.uint64) if len(freqs) else self.freq
        self.index = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, np.int64)
        self.index[symbols] = np.arange(len(symbols))
        self.slots = np.repeat(np.arange(len(freqs), dtype=np.int32), freqs)

    def encode(self, ids: np.ndarray) -> bytes:
        lanes = min(LANES, max(1, len(ids)))
        steps = -(-len(ids) // lanes)
        place = self.index[ids]
        state = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        for t in range(steps - 1, -1, -1):
            now = place[t * lanes : (t + 1) * lanes]
            live = state[: len(now)]
            freq = self.freq[now]
            full = live >= (freq << np.uint64(63 - int(self.scale)))
            if full.any():
                words.append((live[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                live[full] >>= np.uint64(32)
            else:
                words.append(np.empty(0, "<u4"))
            times, rest = np.divmod(live, freq)
            state[: len(now)] = (times << self.scale) + rest + self.start[now]
        return state.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))

    def decode(self, block: bytes, count: int) -> np.ndarray:
        lanes = min(LANES, max(1, count))
        state = np.frombuffer(block, "<u8", lanes).astype(np.uint64)
        words = np.frombuffer(block, "<u4", offset=8 * lanes).astype(np.uint64)
        out = np.empty(count, np.int64)
        mask, at = np.uint64((1 << int(self.scale)) - 1), 0
        for lo in range(0, count, lanes):
            live = state[: min(lanes, count - lo)]
            slot = live & mask
            found = self.slots[slot.astype(np.int64)]
            out[lo : lo + len(live)] = found
            live = self.freq[found] * (live >> self.scale) + slot - self.start[found]
            short = live < np.uint64(LOW)
            n = int(np.count_nonzero(short))
            if n:
                live[short] = (live[short] << np.uint64(32)) | words[at : at + n]
                at += n
            state[: len(live)] = live
        return self.symbols[out]


class Crowded(Exception):
    """A space before white space or the end, where pre-tokens need the whole text."""


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100 in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


def word_encoder(path: str):
    """(text -> ids as bytes, their numpy type) of a byte-level BPE file. The library's model codes each distinct pre-token once, for pre-tokens are coded independently."""
    import os

    import regex
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    coded = tokenizer.model.tokenize
    letters = byte_letters()
    # The library's own byte-level pattern (GPT-2's, fixed).
    pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
    blank = regex.compile(r"\s").match
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    kind = "<u2" if max(tokenizer.get_vocab().values()) < 1 << 16 else "<u4"
    width = int(kind[2])

    spelled = [i.to_bytes(width, "little") for i in range(max(tokenizer.get_vocab().values()) + 1)]

    class Tokens(dict):
        """Pre-token -> its ids, as bytes."""

        def __missing__(self, token: str) -> bytes:
            ids = b"".join([spelled[t.id] for t in coded(token.encode().decode("latin-1").translate(letters))])
            if len(token) <= 64 and len(self) < REMEMBERED:
                self[token] = ids
            return ids

    tokens = Tokens()

    class Stretches(dict):
        """What follows a space, up to the next one -> its ids."""

        def __missing__(self, stretch: str) -> bytes:
            if not stretch or blank(stretch):
                raise Crowded
            if stretch.isalpha():
                ids = tokens[" " + stretch]
            elif stretch[-1:] in (",", ".") and stretch[:-1].isalpha():
                ids = tokens[" " + stretch[:-1]] + tokens[stretch[-1]]
            else:
                ids = b"".join(map(tokens.__getitem__, pattern.findall(" " + stretch)))
            if len(stretch) <= 32 and len(self) < REMEMBERED:
                self[stretch] = ids
            return ids

    stretches = Stretches()

    def encode(text: str) -> bytes:
        if any(map(text.__contains__, added)):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids, kind).tobytes()
        # The pattern begins a pre-token at every space that something else than white space follows.
        first, *others = text.split(" ")
        try:
            return b"".join(map(tokens.__getitem__, pattern.findall(first))) + b"".join(map(stretches.__getitem__, others))
        except Crowded:
            return b"".join(map(tokens.__getitem__, pattern.findall(text)))

    return encode, kind


def _tokenize(batches: Iterator[pa.RecordBatch], path: str | None, end: int) -> Iterator[pa.RecordBatch]:
    from cadenza.llm import rans as own

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    # One encoder a worker process: its memory of tokens serves the worker's later tasks.
    kept = sys.modules.setdefault("_cadenza_encoders", types.ModuleType("_cadenza_encoders")).__dict__
    if path not in kept:
        kept[path] = own.word_encoder(path)
    encode, kind = kept[path]
    kind = "<u4" if end >= 1 << 16 else kind
    last, width = np.array([end], kind).tobytes(), int(kind[2])
    for batch in own.pieces(batches, 4 << 20):
        ids = [(encode(text) if text else b"") + last for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("bucket"), pa.array([len(x) // width for x in ids], pa.int64()), pa.array([width > 2] * len(ids)), pa.array(ids, pa.binary())], names=["doc_id", "bucket", "n", "wide", "ids"])


def _numbers(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u4" if w else "<u2").astype(np.int64) for x, w in zip(batch.column("ids").to_pylist(), batch.column("wide").to_pylist(), strict=True)]


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from cadenza.llm import rans as own

    counts = np.zeros(1, np.int64)
    for batch in own.pieces(batches):
        new = np.bincount(np.concatenate(own._numbers(batch)))
        if len(new) > len(counts):
            new, counts = counts, new
        counts[: len(new)] += new
    found = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found], pa.int64())], names=["symbol", "n"])


def _encode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and document -> chunks."""
    from cadenza.llm import rans as own

    symbols, freqs, before = shared.value
    coder = own.Coder(symbols, freqs)
    bucket, part, first, docs, ids, size = None, 0, 0, [], [], 0

    def chunk() -> pa.RecordBatch:
        nonlocal part, first, docs, ids, size
        flat = np.concatenate(ids)
        blocks = [flat[lo : lo + own.BLOCK] for lo in range(0, len(flat), own.BLOCK)]
        coded = [coder.encode(b) for b in blocks]
        row = [bucket, part, first, np.array([d if d is not None else -(1 << 63) for d in docs], "<i8").tobytes(), np.array([len(x) for x in ids], "<i8").tobytes(), b"".join(coded), np.cumsum([0] + [len(c) for c in coded[:-1]]).astype("<i8").tobytes(), np.array([len(b) for b in blocks], "<i8").tobytes(), np.array([zlib.crc32(c) for c in coded], "<u4").tobytes()]
        part, first, docs, ids, size = part + 1, first + len(flat), [], [], 0
        kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=["bucket", "part", "first_id", "docs", "lengths", "payload", "offsets", "counts", "checks"])

    for batch in own.pieces(batches):
        for b, d, x in zip(batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist(), own._numbers(batch), strict=True):
            if docs and (b != bucket or size + len(x) > own.CHUNK):
                yield chunk()
            if b != bucket:
                bucket, part, first = b, 0, before[b]
            docs.append(d)
            ids.append(x)
            size += len(x)
    if docs:
        yield chunk()


def decoded(row: dict, coder: Coder) -> np.ndarray:
    """All ids of a chunk; every block is checked first."""
    offsets, counts, checks = np.frombuffer(row["offsets"], "<i8"), np.frombuffer(row["counts"], "<i8"), np.frombuffer(row["checks"], "<u4")
    ends = [*offsets[1:].tolist(), len(row["payload"])]
    out = []
    for lo, hi, n, check in zip(offsets.tolist(), ends, counts.tolist(), checks.tolist(), strict=True):
        block = row["payload"][lo:hi]
        if zlib.crc32(block) != check:
            raise ValueError(f"a block of chunk {row['bucket']}.{row['part']} is damaged")
        out.append(coder.decode(block, n))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _decode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    from cadenza.llm import rans as own

    coder = own.Coder(*shared.value[:2])
    for batch in batches:
        for row in batch.to_pylist():
            ids = own.decoded(row, coder).astype("<u4")
            docs, lengths = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["lengths"], "<i8")
            ends = np.cumsum(lengths)
            sums = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64(), mask=docs == -(1 << 63)), pa.array(row["first_id"] + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


class Written:
    """A file set: its path and the shared tables."""

    def __init__(self, path: str, shared):
        self.path, self.shared = path, shared

    def chunks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(CHUNKS).parquet(f"{self.path}/chunks")


def write(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, end: int = 2) -> Written:
    """Tokenizes ``docs`` (doc_id, text) and writes their ids, ``end`` appended to each document, in ascending order of doc_id.

    Null and empty texts have the end id alone. Rows without a doc_id come
    first; repeated ids are ordered by their ids' bytes. An empty table makes an
    empty file set. ``tokenizer``: a file of the tokenizers library.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = Buckets(docs.select("doc_id"), "doc_id", cells=1024)
    read = docs.withColumn("bucket", buckets.column())
    ids = written(read.mapInArrow(partial(_tokenize, path=tokenizer, end=end), "doc_id long, bucket int, n long, wide boolean, ids binary"), "ids", compression="zstd")
    counts = {r[0]: r[1] for r in ids.select("wide", "ids").mapInArrow(_tallied, "symbol long, n long").groupBy("symbol").agg(F.sum("n")).collect()}
    symbols, freqs = frequencies(counts)
    sums = sorted((r[0], r[1]) for r in ids.groupBy("bucket").agg(F.sum("n")).collect())
    before, total = {}, 0
    for b, n in sums:
        before[b] = total
        total += n
    shared = spark.sparkContext.broadcast((symbols, freqs, before))
    path = path or new_path(spark, "tokens")
    ordered = ids.repartition("bucket").sortWithinPartitions("bucket", "doc_id", "ids")
    ordered.mapInArrow(partial(_encode, shared=shared), CHUNKS).write.option("compression", "none").parquet(f"{path}/chunks")
    spark.createDataFrame([(int(s), int(f)) for s, f in zip(symbols, freqs, strict=True)], "symbol long, freq long").write.parquet(f"{path}/frequencies")
    return Written(path, shared)


def opened(spark: SparkSession, path: str) -> Written:
    """A file set that was written before."""
    rows = sorted((r[0], r[1]) for r in spark.read.schema("symbol long, freq long").parquet(f"{path}/frequencies").collect())
    return Written(path, spark.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64))))


def summaries(files: Written, spark: SparkSession) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32."""
    return files.chunks(spark).mapInArrow(partial(_decode, shared=files.shared), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries(write(table(spark, sf_dir, "documents").select("doc_id", "text")), spark)
