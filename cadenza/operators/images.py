"""Waveform and spectrogram pictures with absolute scales, as PNG bytes.

The drawing is our own: no plotting library is needed, and equal input gives equal bytes.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from cadenza.functions.signal import DB_RANGE, RATE, spectrogram

WAVEFORM_SIZE, SPECTROGRAM_SIZE = (1000, 300), (1000, 400)
#: Colours from dark to bright at equal steps (a perceptually ordered dark-to-bright map).
STOPS = ((0, 0, 4), (81, 18, 124), (183, 55, 121), (252, 137, 97), (252, 253, 191))
INK, LINE, PAPER = (31, 119, 180), (90, 90, 90), (255, 255, 255)
_MARGIN = (80, 30, 920, 50)  # left, top, right, bottom from below
#: 3 x 5 glyphs, a row of three bits each (fixed values).
GLYPHS = {"0": "75557", "1": "26227", "2": "71747", "3": "71717", "4": "55711", "5": "74717", "6": "74757", "7": "71111", "8": "75757", "9": "75717", "-": "00700", ".": "00002", "|": "22222", " ": "00000", "_": "00007", "(": "12221", ")": "42224", ":": "02020", "a": "07157", "b": "44757", "c": "00747", "d": "11757", "e": "07747", "f": "32722", "g": "75717", "h": "44755", "i": "20222", "j": "10117", "k": "45655", "l": "22222", "m": "00775", "n": "00755", "o": "00757", "p": "07574", "q": "07571", "r": "00744", "s": "03717", "t": "27223", "u": "00557", "v": "00552", "w": "00577", "x": "00525", "y": "05717", "z": "07247", "?": "71202"}


def title(facts: dict, metrics: dict) -> str:
    return f"{facts['recording_id']} | {facts['speaker_id']} | {facts['session_id']} | {metrics['duration_s']:.3f} s | peak (orig) {metrics['peak_dbfs']:.2f} dBFS | RMS (active) {metrics['active_rms_dbfs']:.2f} dBFS"


def png(pixels: np.ndarray) -> bytes:
    """8-bit RGB without metadata."""
    height, width, _ = pixels.shape
    lines = np.concatenate((np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)), axis=1)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def _canvas(size: tuple[int, int], heading: str) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    pixels = np.full((size[1], size[0], 3), 255, np.uint8)
    left, top, right, bottom = _MARGIN[0], _MARGIN[1], _MARGIN[2], size[1] - _MARGIN[3]
    pixels[top - 1, left - 1 : right + 1] = pixels[bottom, left - 1 : right + 1] = LINE
    pixels[top - 1 : bottom + 1, left - 1] = pixels[top - 1 : bottom + 1, right] = LINE
    x = left
    for char in heading.lower():
        rows = GLYPHS.get(char, GLYPHS["?"])
        for dy, bits in enumerate(rows):
            for dx in range(3):
                if int(bits) >> (2 - dx) & 1 and x + 2 * dx + 2 <= size[0]:
                    pixels[8 + 2 * dy : 10 + 2 * dy, x + 2 * dx : x + 2 * dx + 2] = LINE
        x += 8
    return pixels, (left, top, right, bottom)


def waveform_png(samples: np.ndarray, heading: str) -> bytes:
    """Amplitude from -1 to 1 over the whole duration; each column spans its samples' extremes."""
    pixels, (left, top, right, bottom) = _canvas(WAVEFORM_SIZE, heading)
    width, height = right - left, bottom - top
    edges = np.linspace(0, len(samples), width + 1).astype(int)
    for k in range(width):
        part = samples[edges[k] : max(edges[k + 1], edges[k] + 1)]
        part = np.clip(part if len(part) else samples[-1:], -1, 1)
        high, low = ((1 - v) / 2 * (height - 1) for v in (part.max(), part.min()))
        pixels[top + int(high) : top + int(low) + 1, left + k] = INK
    return png(pixels)


def spectrogram_png(samples: np.ndarray, heading: str, rate: int = RATE) -> bytes:
    """0 to half the rate over the whole duration, DB_RANGE in colour; columns without a supported frame stay blank."""
    pixels, (left, top, right, bottom) = _canvas(SPECTROGRAM_SIZE, heading)
    decibels, (begin, end) = spectrogram(samples, rate)
    width, height = right - left, bottom - top
    times = (np.arange(width) + 0.5) / width * (len(samples) / rate)
    frame = np.floor((times - begin) / (end - begin) * decibels.shape[1]).astype(int)
    inside = (frame >= 0) & (frame < decibels.shape[1])
    bins = ((height - 1 - np.arange(height)) / height * decibels.shape[0]).astype(int)
    shade = (decibels[bins[:, None], np.clip(frame, 0, decibels.shape[1] - 1)[None, :]] - DB_RANGE[0]) / (DB_RANGE[1] - DB_RANGE[0])
    stops = np.array(STOPS, float)
    colour = np.stack([np.interp(shade, np.linspace(0, 1, len(stops)), stops[:, c]) for c in range(3)], axis=2).astype(np.uint8)
    pixels[top:bottom, left:right][:, inside] = colour[:, inside]
    return png(pixels)
