"""PCM WAV bytes to and from samples, mono mixing and resampling."""

from __future__ import annotations

import struct

import numpy as np

from cadenza.errors import HardError
from cadenza.functions.signal import RATE

PCM, EXTENSIBLE = 1, 0xFFFE
#: Names of other encodings, for messages (fixed values).
ENCODINGS = {2: "MS_ADPCM", 3: "FLOAT", 6: "ALAW", 7: "ULAW", 17: "IMA_ADPCM"}


def decode(content: bytes, name: str) -> tuple[np.ndarray, int]:
    """((frames, channels) doubles in [-1, 1), sample rate) or a HardError that names the Original."""
    if len(content) < 12:
        raise HardError(f"cannot decode Original as WAV: {name} (too short)")
    if content[:4] == b"fLaC":
        raise HardError(f"Original is not a WAV (found FLAC): {name}")
    if content[:4] not in (b"RIFF", b"RF64") or content[8:12] != b"WAVE":
        raise HardError(f"cannot decode Original as WAV: {name} (no RIFF/WAVE header)")
    at, form, data, wide = 12, None, None, None
    while at + 8 <= len(content):
        kind, size = content[at : at + 4], struct.unpack_from("<I", content, at + 4)[0]
        if kind == b"ds64" and size >= 16:
            wide = struct.unpack_from("<Q", content, at + 16)[0]
        if kind == b"fmt ":
            form = content[at + 8 : at + 8 + size]
        if kind == b"data":
            size = wide if size == 0xFFFFFFFF and wide is not None else size
            data = content[at + 8 : at + 8 + size]
            break
        at += 8 + size + size % 2
    if form is None or len(form) < 16 or data is None:
        raise HardError(f"cannot decode Original as WAV: {name} (no format or data chunk)")
    tag, channels, rate, _, frame, bits = struct.unpack_from("<HHIIHH", form)
    if tag == EXTENSIBLE and len(form) >= 26:
        tag = struct.unpack_from("<H", form, 24)[0]
    if tag != PCM:
        raise HardError(f"Original is not a PCM WAV (found {ENCODINGS.get(tag, tag)}): {name}")
    if not channels or bits not in (8, 16, 24, 32) or not rate:
        raise HardError(f"cannot decode Original as WAV: {name} ({channels} channels of {bits} bits)")
    width = bits // 8
    count = len(data) // (width * channels)
    if not count:
        raise HardError(f"Original decodes to zero frames: {name}")
    raw = np.frombuffer(data, np.uint8, count * channels * width)
    if bits == 8:
        whole = (raw.astype(np.int32) - 128) << 24
    else:
        padded = np.zeros((count * channels, 4), np.uint8)
        padded[:, 4 - width :] = raw.reshape(-1, width)
        whole = padded.view("<i4")[:, 0]
    return whole.reshape(count, channels) / 2.0**31, rate


def encode(samples: np.ndarray, rate: int = RATE, bits: int = 16) -> bytes:
    """A plain 44-byte-header WAV. Samples are scaled to 32 bits, rounded, clipped and shifted down."""
    x = np.asarray(samples, float)
    x = x.reshape(len(x), -1)
    whole = np.clip(np.rint(x * 2.0**31), -(2**31), 2**31 - 1).astype(np.int64) >> (32 - bits)
    if bits == 8:
        data = (whole + 128).astype(np.uint8).tobytes()
    else:
        data = np.ascontiguousarray(whole.astype("<i4").reshape(-1, 1).view(np.uint8)[:, : bits // 8]).tobytes()
    channels, width = x.shape[1], bits // 8
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(data), b"WAVE", b"fmt ", 16, PCM, channels, rate, rate * channels * width, channels * width, bits, b"data", len(data))
    return head + data


def mono(samples: np.ndarray) -> np.ndarray:
    return samples[:, 0] if samples.shape[1] == 1 else samples.mean(axis=1)


def resampled(samples: np.ndarray, rate: int, target: int = RATE, zeros: int = 64) -> np.ndarray:
    """Polyphase windowed-sinc resampling; samples at the target rate pass unchanged."""
    if rate == target:
        return samples
    common = np.gcd(rate, target)
    up, down = target // common, rate // common
    cutoff = 0.95 / max(up, down)
    half = zeros * max(up, down)
    taps = np.sinc(np.arange(-half, half + 1) * cutoff) * cutoff * up * np.kaiser(2 * half + 1, 10.0)
    count = -(-len(samples) * up // down)
    out = np.empty(count)
    # Output k sits at k * down of the raised rate; only taps at multiples of `up` meet input samples.
    reach = half // up + 1
    padded = np.pad(samples, (reach, reach + 1))
    for phase in range(min(up, count)):
        k = np.arange(phase, count, up)
        centre = k * down
        base = centre // up
        shift = int(centre[0] % up)
        index = np.arange(-reach, reach + 1)
        place = half + index * up - shift
        good = (place >= 0) & (place < len(taps))
        weights = taps[place[good]]
        windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1)[np.minimum(base, len(samples))]
        out[k] = windows[:, good] @ weights
    return out


def normalized(content: bytes, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(the Original's samples, mono samples at RATE)."""
    original, rate = decode(content, name)
    return original, resampled(mono(original), rate)
