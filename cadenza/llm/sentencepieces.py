"""SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text with one space in front is cut into units, each a run of spaces with the
run of other characters behind it, or a character that is in no piece; no piece
of the vocabulary crosses into the next unit, so the lattice of a text is the chain of its units' lattices. A piece
of rank r weighs 1 / (r + FLAT) to the power ``alpha`` (Zipf's law over merge
ranks); a character that is no piece weighs as its byte pieces. The forward
filter sums all segmentations up to each position, once for each distinct unit of
a slice; backward sampling then draws pieces from the end with the exact
posterior. Each draw is a hash of seed, row key and the piece's end position, so
results do not depend on slices, partitions or retries.

U+2581 in a text is coded by its bytes, never as the mark of a space, so decoding
returns every text exactly.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.frames import table
from cadenza.llm.ngram_join import pieces
from cadenza.llm.textkit import PRIME, mixed, slice_hashes

ALPHA, FLAT, SEED = 1.0, 100.0, 10
SPACE, LITERAL = 0x2581, 0x110001


def _symbol_codes(symbols: np.ndarray) -> np.ndarray:
    return mixed(symbols.astype(np.uint64) + np.uint64(0x51AB))


class Vocabulary:
    """Pieces of a SentencePiece model file with byte fallback."""

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes = np.full(256, -1, np.int64)
        self.surface: list[bytes] = []
        texts, ids = [], []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
                self.surface.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                self.surface.append(piece.replace("▁", " ").encode())
                texts.append(piece)
                ids.append(i)
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte fallback")
        self.longest = max(map(len, texts), default=1)
        self.points = np.zeros(0x110002, bool)
        self.points[[ord(c) for c in sorted(set("".join(texts)))]] = True
        # The rank of a piece is its place among the pieces of the file.
        weight = -alpha * np.log(np.arange(len(texts)) + FLAT)
        self.byte_weight = -alpha * np.log(len(texts) + FLAT)
        keys = np.array([self.key(t) for t in texts], np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids, self.weights = keys[order], np.array(ids, np.int64)[order], weight[order]
        if len(np.unique(keys)) != len(keys):
            raise ValueError("piece keys collide")
        # A table of the keys' high bits, for a first look that nearly always decides.
        self.shift = np.uint64(64 - 20)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> self.shift] = True

    @staticmethod
    def key(text: str) -> int:
        total = 0
        codes = _symbol_codes(np.array([ord(c) for c in text], np.uint64))
        for k, c in enumerate(codes.tolist()):
            total = (total + c * pow(PRIME, k, 1 << 64)) % (1 << 64)
        return int(mixed(np.array([total], np.uint64))[0])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place in ``keys`` of the sorted pieces, or -1."""
        out = np.full(len(keys), -1, np.int64)
        likely = np.flatnonzero(self.seen[keys >> self.shift])
        at = np.minimum(np.searchsorted(self.keys, keys[likely]), len(self.keys) - 1)
        good = self.keys[at] == keys[likely]
        out[likely[good]] = at[good]
        return out


def symbols_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(code points with a mark in front of each text and for each space, first of n + 1); an empty text has none."""
    marked = [" " + t if t else "" for t in texts]
    x = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.int64)
    x = np.where(x == SPACE, LITERAL, x)
    x[x == 0x20] = SPACE
    return x, np.concatenate(([0], np.cumsum([len(t) for t in marked]))).astype(np.int64)


class Lattices:
    """Lattices of distinct units. For each position and piece length, of the pieces that end there: the cumulative posterior and the id."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary):
        total, most = len(symbols), vocabulary.longest
        self.first = np.cumsum(lengths) - lengths
        left = np.repeat(self.first + lengths, lengths) - np.arange(total)  # characters from here to the unit's end
        codes = _symbol_codes(symbols)
        self.piece = np.full((total, most), -1, np.int32)
        self.until = np.full((total, most), -np.inf, np.float32)  # first the pieces' log weights
        at, rolling, power = np.arange(total), np.zeros(total, np.uint64), 1
        for k in range(most):
            rolling += codes[at + k] * np.uint64(power)
            power = power * PRIME % (1 << 64)
            found = vocabulary.find(mixed(rolling))
            good = np.flatnonzero(found >= 0)
            ends, found = at[good] + k, found[good]
            self.piece[ends, k] = vocabulary.ids[found]
            self.until[ends, k] = vocabulary.weights[found]
            more = left[at] > k + 1
            at, rolling = at[more], rolling[more]
        # A character that is no piece: its bytes (marked -2, spelled out later).
        alone = self.piece[:, 0] < 0
        self.piece[alone, 0] = -2
        self.until[alone, 0] = vocabulary.byte_weight * widths(symbols[alone])
        # Forward filter, all units at once, longest units first; `last` holds the sums up to the positions before.
        order = np.argsort(-lengths, kind="stable")
        first, size = self.first[order], lengths[order]
        last = np.full((len(size), most), -np.inf, np.float32)
        last[:, :1] = 0
        for j in range(int(size[0]) if len(size) else 0):
            n = int(np.searchsorted(-size, -j, side="left"))
            last = last[:n]
            each = last + self.until[first[:n] + j]
            top = each.max(axis=1, keepdims=True)
            each -= top
            np.exp(each, out=each)
            np.cumsum(each, axis=1, out=each)
            total_j = each[:, -1:].copy()
            each /= total_j
            last = np.concatenate((top + np.log(total_j), last[:, :-1]), axis=1)
            self.until[first[:n] + j] = each

    def draw(self, end: np.ndarray, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(length, piece) for pieces that end before flat position ``end``; ``chance`` in [0, 1)."""
        at = np.count_nonzero(self.until[end - 1] <= chance[:, None], axis=1)
        return at + 1, self.piece[end - 1, at]


def widths(symbols: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of each symbol."""
    points = np.where(symbols == LITERAL, SPACE, symbols)
    return 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)


class Store:
    """Lattices of the units seen so far, up to MOST characters; those of later units are made for one slice.

    Their tables lie behind the kept ones and are written over by the next slice, so no slice copies what is kept.
    """

    MOST = 1 << 19

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.held = vocabulary, 0
        self.hashes, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.until = np.empty((0, vocabulary.longest), np.float32)
        self.piece = np.empty((0, vocabulary.longest), np.int32)

    def ready(self, hashes: np.ndarray, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[Lattices, np.ndarray]:
        """(lattices, place of each distinct unit in them)."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        known = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        fresh = np.flatnonzero(~known)
        sizes = lengths[fresh]
        ends = np.cumsum(sizes)
        made = Lattices(x[np.arange(int(sizes.sum())) + np.repeat(starts[fresh] - ends + sizes, sizes)], sizes, self.vocabulary)
        n = len(made.until)
        if self.held + n > len(self.until):
            room = max(self.held + n, min(2 * len(self.until), self.MOST))
            for name in ("until", "piece"):
                old = getattr(self, name)
                new = np.empty((room, old.shape[1]), old.dtype)
                new[: self.held] = old[: self.held]
                setattr(self, name, new)
        self.until[self.held : self.held + n], self.piece[self.held : self.held + n] = made.until, made.piece
        made.until, made.piece = self.until, self.piece
        places = np.empty(len(hashes), np.int64)
        places[fresh] = self.held + made.first
        if known.any():
            places[known] = self.places[at[known]]
        kept = int(np.searchsorted(ends, self.MOST - self.held, side="right"))
        if kept:
            self.held += int(ends[kept - 1])
            self.hashes = np.concatenate((self.hashes, hashes[fresh[:kept]]))
            order = np.argsort(self.hashes)
            self.places = np.concatenate((self.places, places[fresh[:kept]]))[order]
            self.hashes = self.hashes[order]
        return made, places


def sampled(texts: list[str | None], keys: np.ndarray, store: Store, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(piece ids of all texts, first of n + 1); ``keys`` are the rows' 64-bit keys."""
    vocabulary = store.vocabulary
    x, first = symbols_of(texts)
    if not len(x):
        return np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    begins = x == SPACE
    begins[1:] &= x[:-1] != SPACE
    begins[first[:-1][first[:-1] < first[1:]]] = True
    # Nor does a piece hold a character that is in no piece.
    strange = ~vocabulary.points[x]
    begins |= strange
    begins[1:] |= strange[:-1]
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, len(x)))
    # Distinct units by a hash of their symbols.
    hashes = slice_hashes(np.ascontiguousarray(x, "<u4").view(np.uint8), 4 * starts, 4 * (starts + lengths))
    hashes, one, unit = np.unique(hashes, return_index=True, return_inverse=True)
    lattices, base = store.ready(hashes, x, starts[one], lengths[one])
    # Backward sampling of all occurrences at once.
    doc = np.searchsorted(first, starts, side="right") - 1
    salt = mixed(keys.astype(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
    out = np.full(len(x), -1, np.int64)
    live = np.arange(len(starts))
    left = lengths.copy()
    while len(live):
        end = starts[live] + left[live]
        chance = (mixed(salt[doc[live]] ^ ((end - first[doc[live]]).astype(np.uint64) * np.uint64(PRIME))) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
        length, piece = lattices.draw(base[unit[live]] + left[live], chance)
        out[end - 1] = piece
        left[live] -= length
        live = live[left[live] > 0]
    # In the order of end positions; characters without a piece become their bytes.
    at = np.flatnonzero(out != -1)
    ids = out[at]
    lone = ids == -2
    if lone.any():
        points = np.where(x[at] == LITERAL, SPACE, x[at])
        count = np.where(lone, widths(points), 1)
        places = np.cumsum(count) - count
        wide = np.repeat(ids, count)
        raw = np.frombuffer("".join(map(chr, points[lone].tolist())).encode(), np.uint8)
        slots = np.repeat(places[lone] - (np.cumsum(count[lone]) - count[lone]), count[lone]) + np.arange(len(raw))
        wide[slots] = vocabulary.bytes[raw]
        ends = np.concatenate(([0], np.cumsum(count)))
        return wide, ends[np.searchsorted(at, first)]
    return ids, np.searchsorted(at, first)


def decode(ids: list[int], vocabulary: Vocabulary) -> bytes:
    """The UTF-8 text of piece ids."""
    return b"".join(map(vocabulary.surface.__getitem__, ids))[1:]


def _encoded(batches: Iterator[pa.RecordBatch], path: str | None, alpha: float, seed: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    from cadenza.llm import sentencepieces as own

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = own.Vocabulary(path, alpha)
    store = own.Store(vocabulary)
    for batch in own.pieces(batches, 1 << 18):
        texts = batch.column("text").to_pylist()
        keys = batch.column("doc_id").fill_null(-1).to_numpy(zero_copy_only=False).view(np.uint64)
        ids, first = own.sampled(texts, keys, store, seed)
        lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))
        little = ids.astype("<u4")
        sums, digests, same = [], [], []
        for k, text in enumerate(texts):
            sums.append(zlib.crc32(little[first[k] : first[k + 1]].tobytes()))
            back = own.decode(ids[first[k] : first[k + 1]].tolist(), vocabulary)
            digests.append(hashlib.sha256(back).hexdigest())
            same.append(back == (text or "").encode())
        columns = [batch.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(sums, pa.int64()), pa.array(digests), pa.array(same)]
        names = ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "lossless"]
        more = [c for c in batch.schema.names if c not in ("doc_id", "text")]
        yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in more), *([lists] if with_ids else [])], names=[*names, *more, *(["ids"] if with_ids else [])])


def encoded(docs: DataFrame, path: str | None = None, alpha: float = ALPHA, seed: int = SEED, with_ids: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pieces, ids_crc32 (of ids as little-endian 32-bit integers), decoded_sha256, lossless, the columns of ``keep`` and ``ids``.

    ``path``: a SentencePiece model with byte fallback (default: the public
    32k model). Null and empty texts have no pieces and decode to the empty text. Rows
    with the same doc_id and text are segmented alike; a null doc_id is the key -1. Higher
    ``alpha`` draws nearer to the best segmentation.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`") for c in keep])
    kinds = dict(read.dtypes)
    schema = "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean" + "".join(f", `{c}` {kinds[c]}" for c in keep) + (", ids array<int>" if with_ids else "")
    return read.mapInArrow(partial(_encoded, path=path, alpha=alpha, seed=seed, with_ids=with_ids), schema)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), with_ids=False)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of all documents, with their language and source."""
    return encoded(docs, keep=("lang", "source"))
