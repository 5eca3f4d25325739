"""Signal measures: as column expressions over sample arrays, and with numpy over decoded audio.

The column forms stay inside Spark; the numpy forms serve where one decode
feeds everything else that is derived from a recording.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rate, levels, run lengths and frames.
RATE = 16000
FLOOR_DBFS = -120.0
CLIP_LEVEL, CLIP_RUN = 0.99, 3
FRAME = 320
GUARD = 3200
FLAGS = ("clipping", "low_volume", "duration_out_of_range")


# Columns ---------------------------------------------------------------------------------


def peak(samples: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double")))), F.lit(0.0))


def rms(samples: Column) -> Column:
    """Root mean square; 0 of no samples."""
    total = F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return F.when(F.size(samples) > 0, F.sqrt(total / F.size(samples))).otherwise(F.lit(0.0))


def dbfs(amplitude: Column) -> Column:
    return F.when(amplitude <= 0, F.lit(FLOOR_DBFS)).otherwise(F.greatest(F.lit(FLOOR_DBFS), F.lit(20.0) * F.log10(amplitude)))


def clip_count(samples: Column, level: float = CLIP_LEVEL, run: int = CLIP_RUN) -> Column:
    """Samples in runs of at least ``run`` neighbours of at least ``level``."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("total"))

    def step(acc: Column, x: Column) -> Column:
        loud = F.abs(x.cast("double")) >= level
        ended = F.when(acc["now"] >= run, acc["now"]).otherwise(0)
        return F.struct(F.when(loud, acc["now"] + 1).otherwise(0).alias("now"), F.when(loud, acc["total"]).otherwise(acc["total"] + ended).alias("total"))

    return F.aggregate(samples, zero, step, lambda acc: acc["total"] + F.when(acc["now"] >= run, acc["now"]).otherwise(0)).cast("long")


def frames(samples: Column, length: int = FRAME) -> Column:
    """Frames of ``length`` samples; the last one takes the remainder, and a short array is one frame."""
    count = F.greatest(F.lit(1), F.floor(F.size(samples) / length)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(samples, i * length + 1, F.when(i == count - 1, F.size(samples) - i * length).otherwise(F.lit(length))))


def silent_mask(samples: Column, threshold: float, length: int = FRAME) -> Column:
    return F.transform(frames(samples, length), lambda f: dbfs(rms(f)) < threshold)


def active_frames(mask: Column) -> Column:
    """(first, last) 0-based sounding frames; nulls where all are silent."""
    sounding = F.filter(F.transform(mask, lambda m, i: F.when(~m, i)), lambda i: i.isNotNull())
    return F.struct(F.array_min(sounding).alias("first"), F.array_max(sounding).alias("last"))


def quality_flags(clip_ratio: Column, active_rms_dbfs: Column, duration_s: Column, low: float, shortest: float, longest: float) -> Column:
    tripped = ((FLAGS[0], clip_ratio > 0), (FLAGS[1], active_rms_dbfs < low), (FLAGS[2], (duration_s < shortest) | (duration_s > longest)))
    return F.filter(F.array(*[F.when(test, F.lit(name)) for name, test in tripped]), lambda f: f.isNotNull())


# numpy -----------------------------------------------------------------------------------


def level(amplitude: float) -> float:
    return FLOOR_DBFS if amplitude <= 0 else max(FLOOR_DBFS, float(20 * np.log10(amplitude)))


def root_mean_square(samples: np.ndarray) -> float:
    return float(np.sqrt(np.mean(np.square(samples)))) if len(samples) else 0.0


def clipped(channel: np.ndarray) -> int:
    loud = np.concatenate(([False], np.abs(channel) >= CLIP_LEVEL, [False]))
    edges = np.flatnonzero(loud[1:] != loud[:-1])
    lengths = edges[1::2] - edges[::2]
    return int(lengths[lengths >= CLIP_RUN].sum())


def measure(original: np.ndarray, samples: np.ndarray, quality: dict) -> dict:
    """The seven metrics and the flags of one recording; ``original`` is (frames, channels), ``samples`` mono at RATE."""
    original = original.reshape(len(original), -1)
    clip_ratio = sum(clipped(original[:, c]) for c in range(original.shape[1])) / original.size
    n = len(samples)
    count = max(1, n // FRAME)
    bounds = [(k * FRAME, n if k == count - 1 else (k + 1) * FRAME) for k in range(count)]
    silent = np.array([level(root_mean_square(samples[a:b])) < quality["silence_threshold_dbfs"] for a, b in bounds])
    guarded = lambda run: run / RATE if run >= GUARD else 0.0
    sounding = np.flatnonzero(~silent)
    if len(sounding):
        begin, end = bounds[sounding[0]][0], bounds[sounding[-1]][1]
        leading, trailing = guarded(begin), guarded(n - end)
    else:
        begin = end = 0
        leading = trailing = guarded(n)
    out = {
        "duration_s": n / RATE,
        "peak_dbfs": level(float(np.abs(original).max())),
        "clip_ratio": clip_ratio,
        "active_rms_dbfs": level(root_mean_square(samples[begin:end])),
        "leading_silence_s": leading,
        "trailing_silence_s": trailing,
        "silence_ratio": float(silent.mean()),
    }
    tests = (clip_ratio > 0, out["active_rms_dbfs"] < quality["low_volume_rms_dbfs"], not quality["duration_min_s"] <= out["duration_s"] <= quality["duration_max_s"])
    return out | {"flags": [f for f, t in zip(FLAGS, tests, strict=True) if t]}


#: Decimal places at serialization (fixed values).
PLACES = {"duration_s": 3, "peak_dbfs": 2, "clip_ratio": 4, "active_rms_dbfs": 2, "leading_silence_s": 3, "trailing_silence_s": 3, "silence_ratio": 4}


def rounded(metrics: dict) -> dict:
    return {k: round(metrics[k], p) for k, p in PLACES.items()}


#: Spectrogram framing and scale (fixed values).
N_FFT, HOP, DB_RANGE = 400, 160, (-80.0, 0.0)


def spectrogram(samples: np.ndarray, rate: int = RATE) -> tuple[np.ndarray, tuple[float, float]]:
    """(201 bins x frames in dBFS, clipped to DB_RANGE; the plotted region's edges in seconds).

    Only frames that lie inside the signal are kept, where there are at least two
    of them; else the signal is padded with zeros and all overlapping frames are kept.
    """
    x = np.asarray(samples, float)
    if len(x) < N_FFT // 2:
        x = np.pad(x, (0, N_FFT // 2 - len(x)))
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(N_FFT) / N_FFT)
    half = N_FFT // 2
    first, last = -(-half // HOP), (len(x) - half) // HOP + 1
    if len(x) < N_FFT or last - first < 2:
        first, last = -((half - 1) // HOP), (len(x) + half - 1) // HOP + 1
    padded = np.pad(x, (half + HOP, N_FFT + HOP))
    starts = np.arange(first, last) * HOP - half + half + HOP
    parts = padded[starts[:, None] + np.arange(N_FFT)] * window
    magnitude = np.abs(np.fft.rfft(parts, axis=1)).T * (2 / window.sum())
    decibels = np.clip(20 * np.log10(np.maximum(magnitude, 1e-12)), *DB_RANGE)
    return decibels, ((first - 0.5) * HOP / rate, (last - 0.5) * HOP / rate)
