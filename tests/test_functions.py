"""Text, alignment, signal and serialization against the published vectors and brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import alignment, serialization, signal, text


@pytest.mark.parametrize(
    "given, want",
    [
        ("Bright vixens jump; dozy fowl quack.", "bright vixens jump dozy fowl quack"), ("It's Dr. Smith's well-known co-worker.", "its dr smiths well known co worker"),
        ("Mother-in-law's O'Brien recipe.", "mother in laws obrien recipe"), ("café naïve résumé", "cafe naive resume"), ("hello\tworld\xa0again\nnow", "hello world again now"),
        ("Um.", "um"), ("ﬁle", "file"), ("ＦＵＬＬ", "full"), ("STRAßE", "strasse"), ("don't", "dont"), ("don’t", "dont"), ("donʼt", "dont"), ("don′t", "dont"), ("don`t", "dont"), ("don´t", "don t"), ("50%+20%", "50 20"), ("...5...", "5"), ("", ""),
    ],
)
def test_tier_a(given, want):
    assert text.tier_a(given) == want
    assert text.tier_a(want) == want


def test_final_sigma_folds():
    assert text.tier_a("οδος") == text.tier_a("οδοσ")


@pytest.mark.parametrize("given, want", [("Um.", ""), ("Uh.", ""), ("Um hello.", "hello"), ("O'Brien", "0 brien"), ("The dog's bone", "the dog is bone"), ("the rep", "the representative"), ("hello\tworld\xa0again\nnow", "hello world again now"), ("twenty one pilots", "21 pilots")])
def test_tier_b(given, want):
    assert text.tier_b(given) == want


def test_prompt_form_keeps_case_and_punctuation():
    assert text.prompt_form("  Héllo, World\x1c! ") == "Héllo, World !"


def test_token_columns(spark):
    rows = spark.createDataFrame([("",), ("a b",), ("é😀",)], "t string").select(F.size(text.word_tokens(F.col("t"))), F.size(text.char_tokens(F.col("t")))).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (2, 3), (1, 2)]


@pytest.mark.parametrize(
    "ref, hyp, want",
    [
        ("a b c", "a x c", (1, 0, 0, 3)), ("a b c", "a c", (0, 1, 0, 3)), ("a c", "a b c", (0, 0, 1, 2)), ("a b", "b a", (2, 0, 0, 2)), ("a b a", "b c a b", (0, 1, 2, 3)),
        ("", "a b c", (0, 0, 3, 0)), ("", "", (0, 0, 0, 0)), ("a b c", "", (0, 3, 0, 3)), ("a", "x y z w", (1, 0, 3, 1)),
    ],
)
def test_alignment_vectors(ref, hyp, want):
    got = alignment.align(ref.split(), hyp.split())
    assert tuple(got) == want
    assert got.rate == (sum(want[:3]) / want[3] if want[3] else None)


def test_alignment_of_characters():
    assert tuple(alignment.align("kitten", "sitting")) == (2, 0, 1, 6)
    assert tuple(alignment.align("a b", "ab")) == (0, 1, 0, 3)


def slow(ref, hyp):
    n, m = len(ref), len(hyp)
    d = [[i + j if not i or not j else 0 for j in range(m + 1)] for i in range(n + 1)]
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            d[i][j] = min(d[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]), d[i - 1][j] + 1, d[i][j - 1] + 1)
    i, j, out = n, m, []
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (ref[i - 1] != hyp[j - 1]):
            i, j = i - 1, j - 1
            out.append("equal" if ref[i] == hyp[j] else "sub")
        elif i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
            out.append("del")
        else:
            j -= 1
            out.append("ins")
    return out[::-1]


def test_alignment_equals_the_full_matrix(monkeypatch):
    rng = random.Random(0)
    monkeypatch.setattr(alignment, "ROWS", 5)
    for _ in range(200):
        ref, hyp = ("".join(rng.choice("abc") for _ in range(rng.randrange(18))) for _ in range(2))
        assert [s for s, _, _ in alignment.operations(ref, hyp)] == slow(ref, hyp)


def test_json_format():
    assert serialization.json_lines([]) == ""
    assert serialization.json_lines([{"b": None, "a": "é "}, {"x": [0.00001, 1e7, True]}]) == '{"b":null,"a":"é "}\n{"x":[1e-05,10000000.0,true]}\n'


QUALITY = {"silence_threshold_dbfs": -40.0, "low_volume_rms_dbfs": -30.0, "duration_min_s": 0.5, "duration_max_s": 20.0}


def tone(db, seconds, rate=16000, f=400.0):
    t = np.arange(round(seconds * rate)) / rate
    return np.sqrt(2) * 10 ** (db / 20) * np.sin(2 * np.pi * f * t)


def measured(samples, original=None):
    return signal.measure(samples if original is None else original, samples, QUALITY)


def test_clip_runs():
    x = np.full(16000, 0.5)
    for count, want in ((2, 0), (3, 3), (4, 4)):
        y = x.copy()
        y[100 : 100 + count] = 1.0
        y[9000] = 1.0
        assert measured(y)["clip_ratio"] == want / 16000
    stereo = np.stack([x, x], axis=1)
    stereo[5:9, 0] = -1.0
    got = measured(stereo.mean(axis=1), stereo)
    assert got["clip_ratio"] == 4 / 32000 and "clipping" in got["flags"]


def test_silence_and_levels():
    assert signal.rounded(measured(tone(-18, 2.0))) == {"duration_s": 2.0, "peak_dbfs": -14.99, "clip_ratio": 0.0, "active_rms_dbfs": -18.0, "leading_silence_s": 0.0, "trailing_silence_s": 0.0, "silence_ratio": 0.0}
    gap = np.concatenate([np.zeros(16000), tone(-18, 1.0), np.zeros(16000)])
    got = measured(gap)
    assert got["flags"] == [] and abs(got["leading_silence_s"] - 1) < 0.021 and got["silence_ratio"] > 0.6
    assert measured(np.concatenate([np.zeros(1600), tone(-18, 1.0)]))["leading_silence_s"] == 0.0
    quiet = measured(np.zeros(16000))
    assert (quiet["silence_ratio"], quiet["leading_silence_s"], quiet["active_rms_dbfs"], quiet["peak_dbfs"], quiet["flags"]) == (1.0, 1.0, -120.0, -120.0, ["low_volume"])
    assert measured(np.zeros(1600))["leading_silence_s"] == 0.0
    assert abs(measured(tone(-35, 1.0))["active_rms_dbfs"] + 35) < 0.01
    assert measured(tone(-45, 1.0))["active_rms_dbfs"] == -120.0
    assert measured(np.clip(2 * tone(-3, 25.0), -1, 1))["flags"] == ["clipping", "duration_out_of_range"]


def test_columns_equal_numpy(spark):
    rng = np.random.default_rng(0)
    rows = [(k, (rng.standard_normal(n) * s).clip(-1, 1).tolist()) for k, (n, s) in enumerate([(1000, 0.5), (640, 2.0), (320, 0.001), (10, 1.0), (999, 0.01), (0, 1.0)])]
    x = F.col("x")
    df = spark.createDataFrame(rows, "k int, x array<double>").select("k", signal.peak(x), signal.rms(x), signal.clip_count(x), signal.silent_mask(x, -40.0), signal.active_frames(signal.silent_mask(x, -40.0)))
    for (k, peak, rms, clipped, mask, active), (_, values) in zip(sorted(map(tuple, df.collect())), rows, strict=True):
        values = np.array(values)
        assert peak == (np.abs(values).max() if len(values) else 0), k
        assert abs(rms - signal.root_mean_square(values)) < 1e-12
        assert clipped == signal.clipped(values)
        if len(values):
            count = max(1, len(values) // 320)
            want = [signal.level(signal.root_mean_square(values[i * 320 : len(values) if i == count - 1 else (i + 1) * 320])) < -40 for i in range(count)]
            assert mask == want
            loud = [i for i, m in enumerate(want) if not m]
            assert tuple(active) == ((loud[0], loud[-1]) if loud else (None, None))


def test_spectrogram():
    decibels, (begin, end) = signal.spectrogram(tone(-18, 1.0, f=1000.0))
    assert decibels.shape[0] == 201 and decibels.shape[1] == round((end - begin) * 100)
    assert decibels.mean(axis=1).argmax() == 25
    assert abs(decibels.max() - (-18 + 3.01)) < 0.1
    assert signal.spectrogram(np.zeros(10))[0].shape[0] == 201
    assert (signal.spectrogram(np.zeros(5000))[0] == -80).all()
