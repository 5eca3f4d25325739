"""Language-model scoring with context-tree weighting over bytes.

A text is coded as its words, A-Z lower-cased, each followed by one space, the
last by a line feed (the end); so the bytes carry exactly the tokens. Each byte is
decomposed into eight binary decisions. A context is the run of up to ``depth``
preceding bytes; in every context every binary decision has a Krichevsky-Trofimov
estimate, and the weighting mixes the estimates of all depths: a node's weighted
probability is half its own estimate and half the product over its longer contexts.

Training counts all runs of depth + 1 bytes in the corpus. The context tree keeps every
context that occurs ``LEAST`` times or more, so it grows with the corpus. The
occurrences of a node that lie in no kept longer context form one remainder leaf
below it, so no count is lost.

No process holds the tree. Texts are dealt to chunks; each chunk sends its distinct
runs, and a shuffle sums them to one row a run (with the chunks that ask for it).
Contexts of CUT bytes and longer are weighted in blocks of whole subtrees, dealt by their
nearest CUT bytes. The driver weights only the shorter contexts: their runs of CUT bytes
are a table that the alphabet bounds, not the corpus. A second pass over the blocks
gives each run its logarithm, which goes back to the chunks that ask; a
text's score is the sum of its runs' logarithms.

The base score is a unigram model with add-one counts over the same tokens; tokens
travel the same way as runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.frames import cut, table, written
from cadenza.llm.langid import remainder
from cadenza.llm.ngram_join import pieces
from cadenza.llm.textkit import Words, mixed

DEPTH, LEAST, CUT = 5, 2, 3
#: Bytes of text in a chunk, about; runs in a block, about.
CHUNK, BLOCK = 16 << 20, 400_000
END = 0x0A
#: The hash of the end token; no word hashes through it but by chance.
END_HASH = int(mixed(np.array([0xE0D], np.uint64)).view(np.int64)[0])
#: Distinct keys that a task holds before it sends them on.
HELD = 3_000_000
#: The keys of tokens have this bit, those of runs (48 bits) do not.
TOKEN = np.uint64(1 << 63)


def stream(words: Words, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with ``depth`` line feeds before each text, first coded byte of each text, one past its last)."""
    lengths = words.ends - words.starts
    counts = np.diff(words.first)
    n = len(counts)
    doc = np.repeat(np.arange(n), counts)
    before = np.concatenate(([0], np.cumsum(lengths + 1)))
    empties = np.concatenate(([0], np.cumsum(counts == 0)))
    first = before[words.first[:-1]] + empties[:-1] + depth * np.arange(1, n + 1)
    last = before[words.first[1:]] + empties[1:] + depth * np.arange(1, n + 1)
    out = np.full(int(last[-1]) if n else 0, END, np.uint8)
    start = before[:-1] + empties[doc] + depth * (doc + 1)
    at = np.repeat(start - words.starts + 0, lengths)
    source = np.repeat(words.starts, lengths) + _ranges(lengths)
    out[source + at] = words.raw[source]
    inner = np.ones(len(lengths), bool)
    inner[words.first[1:][counts > 0] - 1] = False
    out[(start + lengths)[inner]] = 0x20
    return out, first, last


def _ranges(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for each length in turn."""
    total = np.cumsum(lengths)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - lengths, lengths)


def coded(first: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    """Mask of the coded bytes of a stream."""
    marks = np.zeros(size + 1, np.int8)
    np.add.at(marks, first, 1)
    np.add.at(marks, last, -1)
    return np.cumsum(marks[:-1]) > 0


def runs(data: np.ndarray, mask: np.ndarray, depth: int) -> np.ndarray:
    """For each coded byte: itself in the lowest 8 bits, the bytes before it above, the nearest lowest."""
    key = data.astype(np.uint64)
    for k in range(1, depth + 1):
        key[k:] |= data[:-k].astype(np.uint64) << np.uint64(8 * k)
    return key[mask]


class Tally:
    """Sums of counts by 64-bit key; keys that are seen but not learned count 0."""

    def __init__(self) -> None:
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, learned: bool = True) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.keys.append(found)
        self.counts.append(counts * learned)
        self.size += len(found)

    def merge(self) -> None:
        if len(self.keys) > 1:
            keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.keys, self.counts = [keys[new]], [np.add.reduceat(counts, new)]
            self.size = len(new)

    def taken(self, chunk: int) -> Iterator[pa.RecordBatch]:
        self.merge()
        if self.size:
            keys, counts = self.keys[0].view(np.int64), self.counts[0]
            for lo in range(0, len(keys), 200_000):
                k = keys[lo : lo + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(counts[lo : lo + 200_000].astype(np.int64)), pa.array(np.full(len(k), chunk, np.int32))], names=["key", "n", "chunk"])
        self.keys, self.counts, self.size = [], [], 0


def _keys(words: Words, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of the words, of the coded bytes' runs, number of coded bytes of each text)."""
    data, first, last = stream(words, depth)
    return words.hashes() | TOKEN, runs(data, coded(first, last, len(data)), depth), last - first


def _count(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Tokens and runs of bytes, by chunk."""
    from cadenza.llm import ctw as own

    tally, at = own.Tally(), None
    for batch in own.pieces(batches, 4 << 20):
        chunks, taught = batch.column("chunk").to_numpy(), batch.column("taught").to_numpy(zero_copy_only=False)
        for chunk in np.unique(chunks).tolist():
            if chunk != at:
                if at is not None:
                    yield from tally.taken(at)
                at = chunk
            for learned in (True, False):
                rows = (chunks == chunk) & (taught == learned)
                if rows.any():
                    part = batch.filter(pa.array(rows))
                    tokens, found, _ = own._keys(own.Words(part.column("text")), depth)
                    tally.add(np.concatenate((tokens, np.full(part.num_rows, own.END_HASH, np.int64).view(np.uint64) | own.TOKEN)), learned)
                    tally.add(found, learned)
            if tally.size > own.HELD:
                tally.merge()
                if tally.size > own.HELD // 2:
                    yield from tally.taken(at)
    if at is not None:
        yield from tally.taken(at)


def _blocks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.Table]:
    """Tables of about ``most`` rows or more; rows that share ``column``, by which the batches are sorted, stay together."""
    held, rows = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            whole = pa.Table.from_batches(held)
            values = batch.column(column).to_numpy()
            new = np.flatnonzero(values[1:] != values[:-1])
            if len(new):
                end = rows - batch.num_rows + int(new[-1]) + 1
                yield whole.slice(0, end)
                held = whole.slice(end).to_batches()
                rows -= end
    if rows:
        yield pa.Table.from_batches(held)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a key: its count, and the chunks that hold it."""
    from cadenza.llm import ctw as own

    for block in own._blocks(batches, "key", own.BLOCK):
        keys, counts, chunks = (block.column(c).to_numpy() for c in ("key", "n", "chunk"))
        order = np.lexsort((chunks, keys))
        keys, counts, chunks = keys[order], counts[order], chunks[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        other = new | np.concatenate(([True], chunks[1:] != chunks[:-1]))
        starts = np.flatnonzero(new)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.add.reduceat(other.astype(np.int64), starts)))), pa.int32()), pa.array(chunks[other]))
        yield pa.RecordBatch.from_arrays([pa.array(keys[starts]), pa.array(np.add.reduceat(counts, starts)), lists], names=["key", "n", "chunks"])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5: recurrence up to 8, then Stirling's series."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        shift[low] += np.log(y[low])
        y[low] += 1
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y - shift


def _decisions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of 0 and 1 at the 255 binary decisions, root first: node 1, then 2 and 3 ..., in columns 0..254."""
    zero, one = [], []
    for bit in range(8):
        halves = counts.reshape(len(counts), 1 << bit, 2, -1).sum(axis=3)
        zero.append(halves[:, :, 0])
        one.append(halves[:, :, 1])
    return np.concatenate(zero, axis=1), np.concatenate(one, axis=1)


def _kt(counts: np.ndarray, step: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """(log of the Krichevsky-Trofimov probability of the counts, probability of a 1 next); in slices, to bound memory."""
    log, ones = np.empty((len(counts), 255)), np.empty((len(counts), 255), np.float32)
    for lo in range(0, len(counts), step):
        zero, one = _decisions(counts[lo : lo + step].astype(np.float64))
        log[lo : lo + step] = _log_gamma(zero + 0.5) + _log_gamma(one + 0.5) - _log_gamma(zero + one + 1.0) - np.log(np.pi)
        ones[lo : lo + step] = (one + 0.5) / (zero + one + 1.0)
    return log, ones


_SMALL = 1 << 12
_HALVES = _log_gamma(np.arange(_SMALL) + 0.5)
_WHOLES = _log_gamma(np.arange(_SMALL) + 1.0)


def _estimate(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of whole counts; small ones by table."""
    both = zero + one
    small = both < _SMALL
    out = np.empty(len(zero))
    z, o = zero[small].astype(np.int64), one[small].astype(np.int64)
    out[small] = _HALVES[z] + _HALVES[o] - _WHOLES[z + o] - np.log(np.pi)
    z, o = zero[~small], one[~small]
    out[~small] = _log_gamma(z + 0.5) + _log_gamma(o + 0.5) - _log_gamma(z + o + 1.0) - np.log(np.pi)
    return out


class Part:
    """Nodes of depths ``low`` to ``high`` of a weighted context tree, from runs of ``high`` + 1 bytes.

    ``keys`` and ``counts``: all runs of the subtrees, also those that count 0 and are only
    asked for. A node holds decisions only where some run passes; elsewhere its probability
    is 1 and adds nothing. ``below``: for each run, the count in kept contexts of depth
    high + 1, and for each bit the sum of their logarithms (on any one run of a decision).
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, low: int, high: int, least: float, below: tuple[np.ndarray, np.ndarray] | None = None):
        self.low, self.high = low, high
        self.keys, self.up, self.n, self.in_kept = {}, {}, {}, {}
        self.kept, self.inner = {}, {}
        at, self.where = np.unique(keys, return_inverse=True)
        n = np.bincount(self.where, counts, len(at))
        self.in_kept[high] = np.zeros(len(at)) if below is None else np.bincount(self.where, below[0], len(at))
        for d in range(high, low - 1, -1):
            self.keys[d], self.n[d] = at, n
            node = np.cumsum(np.concatenate(([False], at[1:] >> np.uint64(8) != at[:-1] >> np.uint64(8))))
            self.kept[d] = (np.bincount(node, n)[node] >= least) | (d == 0)
            self.inner[d] = np.bincount(node, self.in_kept[d])[node] > 0
            if d > low:
                at, self.up[d] = np.unique(at & np.uint64((1 << (8 * d)) - 1), return_inverse=True)
                self.in_kept[d - 1] = np.bincount(self.up[d], n * self.kept[d], len(at))
                n = np.bincount(self.up[d], n, len(at))
        self.bits = [self._weighted(k, None if below is None else np.bincount(self.where, below[1][:, k], len(self.keys[high]))) for k in range(8)]

    def _weighted(self, k: int, sums: np.ndarray | None) -> dict:
        """By depth: (cell of each run, its first run, log of the weighted probability, probabilities of a 1 next and in the remainder, share of the own estimate)."""
        out = {}
        for d in range(self.high, self.low - 1, -1):
            keys = self.keys[d]
            cells = keys >> np.uint64(8 - k)
            new = np.concatenate(([True], cells[1:] != cells[:-1]))
            cell, first = np.cumsum(new) - 1, np.flatnonzero(new)
            bit = ((keys >> np.uint64(7 - k)) & np.uint64(1)).astype(np.float64)
            rest = self.n[d] - self.in_kept[d]
            one, rest_one = np.bincount(cell, self.n[d] * bit), np.bincount(cell, rest * bit)
            zero, rest_zero = np.bincount(cell, self.n[d] * (1 - bit)), np.bincount(cell, rest * (1 - bit))
            log = _estimate(zero, one)
            children = _estimate(rest_zero, rest_one)
            if d < self.high:
                _, lower, weighted, *_ = out[d + 1]
                children += np.bincount(cell[self.up[d + 1][lower]], weighted * self.kept[d + 1][lower], len(first))
            elif sums is not None:
                children += np.bincount(cell, sums)
            mixture = np.where(self.inner[d][first], np.logaddexp(log, children) - np.log(2), log)
            share = np.where(self.inner[d][first], np.exp(log - np.log(2) - mixture), 1.0)
            out[d] = cell, first, mixture, (one + 0.5) / (zero + one + 1), (rest_one + 0.5) / (rest_zero + rest_one + 1), share
        return out

    def upward(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of depth ``low``: runs, counts, counts in kept nodes, logarithms by bit (on the first run of a decision)."""
        low, logs = self.low, np.zeros((len(self.keys[self.low]), 8))
        for k in range(8):
            _, first, mixture, *_ = self.bits[k][low]
            logs[first, k] = mixture * self.kept[low][first]
        return self.keys[low], self.n[low], self.n[low] * self.kept[low], logs

    def downward(self, k: int, state: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """At bit ``k``, for the runs of depth ``high``: probability of a 1 if no longer context is kept; sum and weight that go into kept ones. ``state``: the same from the depth above, for the runs of depth ``low``."""
        for d in range(self.low, self.high + 1):
            end, total, weight = state if d == self.low else (x[self.up[d]] for x in state)
            cell, _, _, ones, rest, share = self.bits[k][d]
            ones, rest, share = ones[cell], rest[cell], share[cell]
            total = total + weight * share * ones
            weight = weight * (1 - share)
            state = np.where(self.kept[d], np.where(self.inner[d], total + weight * rest, total), end), total, weight
        return state


def _upward(batches: Iterator[pa.RecordBatch], depth: int, cut: int, least: float) -> Iterator[pa.RecordBatch]:
    """What subtrees of depth ``cut`` add to the runs above."""
    from cadenza.llm import ctw as own

    for block in own._blocks(batches, "g", own.BLOCK):
        keys, n, kept, logs = own.Part(block.column("key").to_numpy().view(np.uint64), block.column("n").to_numpy(), cut, depth, least).upward()
        above = (keys & np.uint64((1 << (8 * cut)) - 1)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(above), pa.array(n.astype(np.int64)), pa.array(kept.astype(np.int64)), *(pa.array(logs[:, k].copy()) for k in range(8))], names=["key", "n", "kept", *(f"w{k}" for k in range(8))])


def _downward(batches: Iterator[pa.RecordBatch], top, depth: int, cut: int, least: float) -> Iterator[pa.RecordBatch]:
    """log10 probability of each run, for each chunk that asks."""
    from cadenza.llm import ctw as own

    above, states = top.value
    for block in own._blocks(batches, "g", own.BLOCK):
        part = own.Part(block.column("key").to_numpy().view(np.uint64), block.column("n").to_numpy(), cut, depth, least)
        at = np.searchsorted(above, part.keys[cut] & np.uint64((1 << (8 * cut)) - 1))
        logs = np.zeros(len(part.keys[depth]))
        for k in range(8):
            p, _, _ = part.downward(k, tuple(x[at, k] for x in states))
            logs += np.log10(np.where((part.keys[depth] >> np.uint64(7 - k)) & np.uint64(1), p, 1 - p))
        lists = block.column("chunks").combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        keys, chunks = np.repeat(block.column("key").to_numpy(), sizes), lists.flatten()
        # Rounded to 32 bits: that is precise enough, and packs better on its way.
        values = np.repeat(logs[part.where].astype(np.float32).astype(np.float64), sizes)
        for lo in range(0, len(keys), 200_000):
            yield pa.RecordBatch.from_arrays([chunks.slice(lo, 200_000), pa.array(keys[lo : lo + 200_000]), pa.array(values[lo : lo + 200_000])], names=["chunk", "key", "value"])


class Tree:
    """A weighted context tree in one process, for small tables: the tests hold the blocks against it. ``step``[inner node, byte]: the inner node below, or -1 - t for terminal t; ``logs``[t, byte]: log10 probability."""

    def __init__(self, depth: int, rows: dict[int, tuple[np.ndarray, np.ndarray]]):
        """rows[d]: (contexts of depth d in ascending order, their counts of next bytes, 256 each)."""
        self.depth = depth
        if not len(rows[0][0]):  # nothing learned: one empty root
            rows = {0: (np.zeros(1, np.uint64), np.zeros((1, 256)))} | {d: (np.zeros(0, np.uint64), np.zeros((0, 256))) for d in range(1, depth + 1)}
        parents, inner = {}, {}
        for d in range(depth):
            below = rows[d + 1][0]
            parents[d + 1] = np.searchsorted(rows[d][0], below & np.uint64((1 << (8 * d)) - 1))
            inner[d] = np.zeros(len(rows[d][0]), bool)
            inner[d][parents[d + 1]] = True
        inner[depth] = np.zeros(len(rows[depth][0]), bool)
        # Bottom up: weighted probabilities. Logarithms need 64 bits, probabilities are kept in 32.
        below = None
        own, remainders, kept = {}, {}, {}
        for d in range(depth, -1, -1):
            total, kept[d] = _kt(rows[d][1])
            if d < depth and inner[d].any():
                at = np.flatnonzero(inner[d])
                rest = rows[d][1].copy()
                np.subtract.at(rest, parents[d + 1], rows[d + 1][1])
                children, remainders[d] = _kt(rest[at])
                np.add.at(children, np.searchsorted(at, parents[d + 1]), below)
                mixture = np.logaddexp(total[at], children) - np.log(2)
                own[d] = np.exp(total[at] - np.log(2) - mixture).astype(np.float32)
                total[at] = mixture
            below = total
        del below, total
        # Top down: the mixture along each path.
        offset = np.cumsum([0] + [int(inner[d].sum()) for d in range(depth + 1)])
        self.step = np.zeros((max(int(offset[-1]), 1), 256), np.int32)
        terminal: list[np.ndarray] = []
        count = 0
        sums, weight = np.zeros((len(rows[0][0]), 255), np.float32), np.ones((len(rows[0][0]), 255), np.float32)
        place = {d: np.where(inner[d], offset[d] + np.cumsum(inner[d]) - 1, 0) for d in range(depth + 1)}
        for d in range(depth + 1):
            ones, leaf, at = kept.pop(d), ~inner[d], np.flatnonzero(inner[d])
            terminal.append(sums[leaf] + weight[leaf] * ones[leaf])
            codes = np.zeros(len(leaf), np.int64)
            codes[leaf] = -1 - (count + np.arange(int(leaf.sum())))
            codes[at] = place[d][at]
            count += int(leaf.sum())
            if d:
                self.step[place[d - 1][parents[d]], (rows[d][0] >> np.uint64(8 * (d - 1))).astype(np.int64)] = codes
            if d == depth:
                break
            if len(at):
                share = own.pop(d)
                below_sum, below_weight = sums[at] + weight[at] * share * ones[at], weight[at] * (1 - share)
                terminal.append(below_sum + below_weight * remainders.pop(d))
                self.step[place[d][at]] = (-1 - (count + np.arange(len(at))))[:, None]  # until the contexts below take their places
                count += len(at)
                up = np.searchsorted(at, parents[d + 1])
                sums, weight = below_sum[up], below_weight[up]
            else:
                sums, weight = np.zeros((0, 255), np.float32), np.zeros((0, 255), np.float32)
        self.root_is_leaf = not inner[0].any()
        logs = np.zeros((count, 256), np.float32)
        slices = [(p, lo) for p in terminal for lo in range(0, len(p), 4096)]
        at = 0
        for whole, lo in slices:
            part = whole[lo : lo + 4096].astype(np.float64)
            total = np.zeros((len(part), 256))
            for bit in range(8):
                nodes = (1 << bit) - 1 + (np.arange(256) >> (8 - bit))
                p = part[:, nodes]
                total += np.log10(np.where((np.arange(256) >> (7 - bit)) & 1, p, 1 - p))
            logs[at : at + len(part)] = total
            at += len(part)
        self.logs = logs

    def scored(self, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """log10 probability of each coded byte of a stream."""
        at = np.flatnonzero(mask)
        state = np.zeros(len(at), np.int32)
        if self.root_is_leaf:
            state[:] = -1
        for k in range(1, self.depth + 1):
            live = state >= 0
            if live.all():
                state = self.step[state, data[at - k]]
            else:
                live = np.flatnonzero(live)
                state[live] = self.step[state[live], data[at[live] - k]]
        return self.logs[-1 - state, data[at]]


def _score(texts: pa.Table, values: pa.Table, depth: int) -> pa.Table:
    """Scores of the texts of a chunk; ``values`` has each of its keys."""
    from cadenza.llm import ctw as own

    keys, value = values.column("key").combine_chunks(), values.column("value").to_numpy()
    end = value[pc.index_in(pa.scalar(int(np.uint64(own.END_HASH & ((1 << 64) - 1)) | own.TOKEN) - (1 << 64), pa.int64()), value_set=keys).as_py()] if len(keys) else 0.0
    out = []
    for batch in own.pieces(texts.to_batches(), 2 << 20):
        words = own.Words(batch.column("text"))
        tokens, found, sizes = own._keys(words, depth)
        at = lambda x: pc.index_in(pa.array(x.view(np.int64)), value_set=keys).to_numpy()
        score = np.add.reduceat(value[at(found)], np.cumsum(sizes) - sizes)
        counts = np.diff(words.first)
        doc = np.repeat(np.arange(len(counts)), counts)
        seen = value[at(tokens)] if len(tokens) else np.zeros(0)
        base = np.bincount(doc, weights=seen, minlength=len(counts)) + end
        known = np.bincount(doc[seen > 0], minlength=len(counts)) + int(end > 0)
        out.append(pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(counts + 1, pa.int64()), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score), pa.array(sizes, pa.int64())],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes"],
        ))
    return pa.Table.from_batches(out, OUT)


OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])


def grown(grams: DataFrame, total: int, depth: int, contexts: int) -> Tree:
    """The tree of counted runs (key, n) in one process, with at most ``contexts`` nodes a depth."""
    spans = F.array(*[F.struct(F.lit(d).alias("d"), F.col("key").bitwiseAND(F.lit((1 << (8 * d + 8)) - 1)).alias("k")) for d in range(depth + 1)])
    by = cut(grams.select("n", F.explode(spans).alias("s")).groupBy("s.d", "s.k").agg(F.sum("n").alias("n")))
    context = F.shiftright("k", 8).alias("c")
    # At least one in `contexts` of all bytes: at most `contexts` rows a depth.
    kept = by.groupBy("d", context).agg(F.sum("n").alias("m")).where(F.col("m") * contexts >= total).select("d", "c")
    rows = by.select("d", context, F.col("k").bitwiseAND(255).alias("b"), "n").join(F.broadcast(kept), ["d", "c"]).select("d", "c", "b", "n").toArrow()
    depths, contexts_of, following, counted = (rows[c].to_numpy() for c in ("d", "c", "b", "n"))
    out = {}
    for d in range(depth + 1):
        own = depths == d
        found, at = np.unique(contexts_of[own], return_inverse=True)
        counts = np.zeros((len(found), 256))
        counts[at, following[own]] = counted[own]
        out[d] = (found.astype(np.uint64), counts)
    return Tree(depth, out)


def logarithms(keys: DataFrame, least: float, depth: int) -> DataFrame:
    """``chunk``, ``key``, ``value``: the log10 probabilities of the runs in ``keys`` (key, n, chunks)."""
    spark, cut_at = keys.sparkSession, min(CUT, depth)
    dealt = keys.withColumn("g", F.shiftright("key", 8).bitwiseAND((1 << (8 * cut_at)) - 1))
    sums = ", ".join(f"w{k} double" for k in range(8))
    rows = dealt.select("g", "key", "n").repartition("g").sortWithinPartitions("g").mapInArrow(partial(_upward, depth=depth, cut=cut_at, least=least), f"key long, n long, kept long, {sums}")
    rows = rows.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", "kept", *(f"w{k}" for k in range(8)))]).toArrow()
    below = rows.column("kept").to_numpy(), np.stack([rows.column(f"w{k}").to_numpy() for k in range(8)], axis=1)
    states = [np.zeros((0, 8))] * 3
    above = rows.column("key").to_numpy().view(np.uint64)
    if len(above):
        top = Part(above, rows.column("n").to_numpy(), 0, cut_at - 1, least, below)
        above, size = top.keys[cut_at - 1], len(top.keys[0])
        found = [top.downward(k, (np.full(size, 0.5), np.zeros(size), np.ones(size))) for k in range(8)]
        states = [np.stack([f[i] for f in found], axis=1) for i in range(3)]
    model = spark.sparkContext.broadcast((above, states))
    return dealt.repartition("g").sortWithinPartitions("g").mapInArrow(partial(_downward, top=model, depth=depth, cut=cut_at, least=least), "chunk int, key long, value double")


def scored(docs: DataFrame, learn: str = "not held_out", depth: int = DEPTH, contexts: int | None = None, heavy: int | None = None) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text, held_out), learning from those where ``learn`` holds.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes and
    bits_per_byte. A null or empty text is the end token alone. Where nothing is learned,
    N and V are 0, base_score is 0 and bytes have probability 1/256. Repeated rows are scored
    alike, each one; all repeats teach. ``contexts`` bounds the contexts of a depth (default: all
    that occur LEAST times are kept); ``heavy`` has no effect any more.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), "held_out", F.coalesce(F.expr(learn), F.lit(False)).alias("taught"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = -(-size // CHUNK) + 1
    docs = docs.withColumn("chunk", F.pmod(F.monotonically_increasing_id(), F.lit(chunks)).cast("int"))
    docs = written(docs.repartition("chunk").sortWithinPartitions("chunk"), "texts", compression="zstd")
    asked = docs.select("chunk", "taught", "text").mapInArrow(partial(_count, depth=depth), "key long, n long, chunk int")
    keys = written(asked.repartition("key").sortWithinPartitions("key").mapInArrow(_summed, "key long, n long, chunks array<int>"), "keys", compression="zstd")
    taught = F.col("n") > 0
    n, v, total = (int(x or 0) for x in keys.agg(F.sum(F.when(F.col("key") < 0, F.col("n"))), F.count(F.when((F.col("key") < 0) & taught, 1)), F.sum(F.when(F.col("key") >= 0, F.col("n")))).first())
    values = logarithms(keys.where("key >= 0"), LEAST if contexts is None else max(total, 1) / contexts, depth)
    tokens = keys.where("key < 0").select(F.explode("chunks").alias("chunk"), "key", F.log10(F.col("n") + 1).alias("value"))
    out = docs.groupBy("chunk").cogroup(values.unionByName(tokens).groupBy("chunk"))
    out = out.applyInArrow(partial(_score, depth=depth), "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long")
    spread = F.log10(F.lit(float(n + v + 1)))
    return out.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * spread).alias("base_score"), "score", "n_bytes", (F.col("score") / F.log10(F.lit(2.0)) / -F.col("n_bytes")).alias("bits_per_byte"),
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scored(docs.withColumn("held_out", remainder(7) == 2))
