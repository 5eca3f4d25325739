"""Whole commands on synthetic recordings, and the errors that end them."""

import csv
import hashlib
import json
import sys

import numpy as np
import pytest
from pyspark import cloudpickle

from cadenza.__main__ import main
from cadenza.config import load_config
from cadenza.errors import HardError
from cadenza.operators import manifest, split
from cadenza.plans import commands
from cadenza.sources import recordings, records, wav

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HEADER = "path,speaker_id,session_id,prompt_text,device,environment"


def tone(seconds=1.0, rate=16000, db=-18.0, f=400.0, channels=1):
    t = np.arange(round(seconds * rate)) / rate
    x = np.sqrt(2) * 10 ** (db / 20) * np.sin(2 * np.pi * f * t)
    return np.stack([x] * channels, axis=1)


def source(tmp_path, rows, files):
    root = tmp_path / "in"
    root.mkdir()
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    with (root / "recordings.csv").open("w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(HEADER.split(","))
        writer.writerows(rows)
    return root


@pytest.fixture
def four(tmp_path):
    files = {"a.wav": wav.encode(tone(f=300.0)), "sub/b.wav": wav.encode(tone(2.0, 48000, channels=2), 48000), "c.wav": wav.encode(tone(0.3), 16000, 24), "d.wav": wav.encode(tone(1.0, db=-36.0, f=330.0))}
    rows = [("a.wav", "p", "s1", "Hello, there.", "mic", "room"), ("sub/b.wav", "p", "s2", "A \"b\",\nc", "mic", "room"), ("c.wav", "q", "s3", "Hello, there.", "mic", ""), ("d.wav", "q", "s4", "x", "mic", "room")]
    return source(tmp_path, rows, files)


def test_fixed_ids():
    for (seconds, rate, channels, bits), want in {(2.0, 16000, 1, 16): "7e5e05c993e79c5d", (2.0, 48000, 1, 16): "e5b48b17d23a9ffb", (2.0, 16000, 2, 16): "887b9e31fbf0dfe4", (2.0, 16000, 1, 24): "fbcf342aa30f0c76"}.items():
        assert hashlib.sha256(wav.encode(tone(seconds, rate, channels=channels), rate, bits)).hexdigest()[:16] == want


def test_build_and_rebuild(spark, four, tmp_path):
    out = tmp_path / "out"
    version = commands.build(spark, four, out)
    tree = {p.relative_to(out).as_posix(): p.read_bytes() for p in out.rglob("*") if p.is_file()}
    document = json.loads(tree["dataset.json"])
    assert document["dataset_version"] == version
    assert document["split"]["counts"]["total"] == 4 and document["split"]["counts"]["val"] == 1
    files = {n: tree[n].decode() for n in ("train.jsonl", "val.jsonl", "test.jsonl")}
    assert manifest.dataset_version(load_config().canonical(), files) == version
    lines = [json.loads(x) for n in files for x in files[n].splitlines()]
    assert all(list(x) == list(manifest.FIELDS) and x["audio_filepath"] in tree for x in lines)
    assert sorted(x["text"] for x in lines) == ['A "b",\nc', "Hello, there.", "Hello, there.", "x"]
    quality = {json.loads(x)["id"]: json.loads(x)["flags"] for x in tree["reports/quality.jsonl"].decode().splitlines()}
    assert sorted(map(tuple, quality.values())) == [(), (), ("duration_out_of_range",), ("low_volume",)]
    assert sum(n.endswith(".png") for n in tree) == 8
    assert all(tree[n][:8] == b"\x89PNG\r\n\x1a\n" for n in tree if n.endswith(".png"))
    assert commands.build(spark, four, out) == version
    assert tree == {p.relative_to(out).as_posix(): p.read_bytes() for p in out.rglob("*") if p.is_file()}
    assert not list(tmp_path.glob("out.*"))


def test_validate_digest(spark, four, capsys):
    assert main(["validate", "--data-in", str(four)], spark) == 0
    text = capsys.readouterr().out
    assert text.startswith("Quality: 4 recordings — 2 clean, 2 flagged\n  clipping              0\n")
    assert "active_rms=-36.00dBFS" in text and "duration=0.300s" in text


GOOD = wav.encode(tone())


@pytest.mark.parametrize(
    "rows, files, message",
    [
        ([("", "p", "s", "t", "m", "e")], {}, "empty path"),
        ([("a\\b.wav", "p", "s", "t", "m", "e")], {}, "backslash"),
        ([("/a.wav", "p", "s", "t", "m", "e")], {}, "must be relative"),
        ([("x/../a.wav", "p", "s", "t", "m", "e")], {}, "'..'"),
        ([("gone.wav", "p", "s", "t", "m", "e")], {}, "does not exist: gone.wav"),
        ([("a.wav", "p", "s")], {"a.wav": GOOD}, "line 2: fewer fields"),
        ([("a.wav", "p", "s", "t", "m", "e", "x")], {"a.wav": GOOD}, "line 2: more fields"),
        ([], {}, "no rows"),
        ([("a.wav", "p", "s", "t", "m", "e"), ("b.wav", "p", "s2", "t", "m", "e")], {"a.wav": GOOD, "b.wav": GOOD}, "disagree on 'session_id' ('s' vs 's2')"),
        ([("a.wav", "p", "s", "t", "m", "e")], {"a.wav": b"plain text, long enough"}, "cannot decode"),
        ([("a.wav", "p", "s", "t", "m", "e")], {"a.wav": GOOD[:20]}, "cannot decode"),
        ([("a.wav", "p", "s", "t", "m", "e")], {"a.wav": GOOD[:44]}, "zero frames"),
        ([("a.wav", "p", "s", "t", "m", "e")], {"a.wav": b"fLaC" + bytes(20)}, "not a WAV"),
        ([("a.wav", "p", "s", "t", "m", "e")], {"a.wav": GOOD[:20] + b"\x03\x00" + GOOD[22:]}, "not a PCM WAV"),
    ],
)
def test_input_errors(spark, tmp_path, rows, files, message):
    root = source(tmp_path, rows, files)
    with pytest.raises(HardError, match=None) as error:
        commands.build(spark, root, tmp_path / "out")
    assert message in str(error.value)
    assert not (tmp_path / "out").exists() and not (tmp_path / "out.tmp").exists()


@pytest.mark.parametrize("named", [0, 2, 3, 5_000])
def test_missing_file_at_any_size(spark, tmp_path, monkeypatch, named):
    """A listed file that does not exist ends the build, however many files are listed before it."""
    monkeypatch.setattr(recordings, "NAMED", named)
    files = {f"{c}.wav": wav.encode(tone(f=300.0 + k)) for k, c in enumerate("abd")}
    rows = [(f"{c}.wav", "p", f"s{c}", "t", "m", "e") for c in "abcde"]
    root = source(tmp_path, rows, files)
    with pytest.raises(HardError, match="does not exist: c.wav"):
        commands.build(spark, root, tmp_path / "out")
    for c in "ce":
        (root / f"{c}.wav").write_bytes(wav.encode(tone(f=500.0 + ord(c))))
    assert recordings.read_recordings(spark, root).count() == 5


def test_index_header(spark, tmp_path):
    root = source(tmp_path, [], {})
    for text, message in ((HEADER.replace("device,", "") + "\n", "missing column(s): device"), (HEADER + ",z,b\n", "unexpected column(s): b, z"), ("", "is empty")):
        (root / "recordings.csv").write_text(text)
        with pytest.raises(HardError) as error:
            commands.validate(spark, root)
        assert message in str(error.value)
    with pytest.raises(HardError, match="not a directory"):
        commands.validate(spark, tmp_path / "none")


def test_copies_collapse(spark, tmp_path):
    row = ("p", "s", "t", "m", "e")
    root = source(tmp_path, [("a.wav", *row), ("b.wav", *row)], {"a.wav": GOOD, "b.wav": GOOD, "stray.wav": b"junk"})
    assert commands.validate(spark, root).startswith("Quality: 1 recordings")


@pytest.mark.parametrize(
    "text, message",
    [
        ("[other]\nx = 1", "unknown config section [other]"), ("x = 1", "does not belong"), ("split = 1", "must be a table"), ("[split]\nz = 1", "unknown key(s)"), ("[split", "not valid TOML"), ("[manifest]\nlang = 'EN'", "ISO 639-1"),
        ("[split]\ntrain = true", "must be a number"), ("[split]\nseed = 1.5", "must be an integer"), ("[split]\ntrain = 0.0\nval = 0.5\ntest = 0.5", "must be > 0"), ("[split]\ntrain = 0.5", "sum to 1.0"),
    ],
)
def test_config_errors(tmp_path, text, message):
    (tmp_path / "c.toml").write_text(text)
    with pytest.raises(HardError) as error:
        load_config(tmp_path / "c.toml")
    assert message in str(error.value)


SPLIT = {"seed": 0, "train": 0.8, "val": 0.1, "test": 0.1}


def outcome(spark, sizes, ratios=SPLIT):
    rows = [(s, f"sp{i % 2}") for i, (s, n) in enumerate(sizes.items()) for _ in range(n)]
    return split.split_sessions(spark.createDataFrame(rows, "session_id string, speaker_id string"), ratios)


def test_split_expectations(spark):
    four = outcome(spark, {f"sess_0{i}": 3 for i in range(1, 5)})
    assert four.samples() == {"train": 6, "val": 3, "test": 3}
    assert four.moves == ((four.order[0][0], "train", "test"),)
    ten = outcome(spark, {f"sess_{i}": 1 for i in range(10)})
    assert ten.samples() == {"train": 8, "val": 1, "test": 1} and ten.moves == ()
    three = outcome(spark, {f"sess_{i}": 1 for i in range(3)})
    assert three.samples() == {"train": 1, "val": 1, "test": 1} and [m[2] for m in three.moves] == ["val", "test"]
    two = outcome(spark, {"a": 3, "b": 3})
    assert two.moves == () and two.too_few and "WARNING: 2 Session(s)" in "\n".join(manifest.split_report(two))
    assert outcome(spark, {"a": 4}).samples() == {"train": 4, "val": 0, "test": 0}
    none = outcome(spark, {})
    assert none.order == () and none.samples() == {"train": 0, "val": 0, "test": 0}


class Echo:
    provenance = {"model": {"repo_id": "m", "revision": "r", "license": "l"}, "decode": {"k": None}, "runtime": {}}

    def transcribe(self, waveform, language):
        if len(waveform) < 8000:
            raise RuntimeError("too short")
        return "hello there" if len(waveform) == 16000 else ""


@pytest.mark.parametrize("distributed", [False, True])
def test_transcribe_and_score(spark, four, tmp_path, capsys, distributed):
    commands.build(spark, four, tmp_path / "out")
    run = commands.transcribe(spark, tmp_path / "out", tmp_path / "runs", Echo, distributed)
    lines = [json.loads(x) for x in (run / records.RECORD).read_text().splitlines()]
    assert [x["id"] for x in lines] == sorted(x["id"] for x in lines)
    assert sum(x["error"] == "decode_failed" for x in lines) == 1 and sum(x["hypothesis"] == "" for x in lines) == 1
    assert json.loads((run / records.RUN).read_text())["record_line_count"] == 4
    assert main(["score", "--run", str(run), "--format", "json"], spark) == 0
    report = json.loads(capsys.readouterr().out)
    assert report["samples"] == {"in_scope": 4, "scored": 3, "failed": 1, "long_form": 0}
    whole = next(g for g in report["groups"] if g["axis"] == "all" and g["tier"] == "tier-a/1")
    # Hello there / hello there; a b c / empty; x / hello there
    assert (whole["word_s"], whole["word_d"], whole["word_i"], whole["word_n"]) == (1, 3, 1, 6)
    assert len(report["worklist"]) == 2
    text = commands.score(spark, run)
    assert "3 of 4 scored — 1 Transcription failure(s), 0 long_form" in text


def test_broken_runs(spark, tmp_path):
    line = {"id": "a", "reference": "x", "hypothesis": None, "error": None, "split": "test", "session_id": "s", "speaker_id": "p", "prompt_id": "q", "device": "d", "environment": "e", "duration": 1, "long_form": False}
    (tmp_path / records.RECORD).write_text(json.dumps(line) + "\n")
    with pytest.raises(HardError, match="incomplete Run"):
        records.read_run(spark, tmp_path)
    (tmp_path / records.RUN).write_text('{"record_line_count": 2}')
    with pytest.raises(HardError, match="truncated"):
        records.read_run(spark, tmp_path)
    (tmp_path / records.RUN).write_text('{"record_line_count": true}')
    with pytest.raises(HardError, match="not an integer"):
        records.read_run(spark, tmp_path)
    for change, message in (({"long_form": 1}, "long_form is missing or not a boolean"), ({"duration": True}, "not a number"), ({"hypothesis": 5}, "a string or null"), ({"id": None}, "id is missing")):
        (tmp_path / records.RECORD).write_text(json.dumps(line | change) + "\n")
        with pytest.raises(HardError, match=message):
            records.read_run(spark, tmp_path)


def test_line_numbers_over_many_splits(spark, tmp_path):
    line = {"id": "a", "reference": "x", "hypothesis": None, "error": None, "split": "test", "session_id": "s", "speaker_id": "p", "prompt_id": "q", "device": "d", "environment": "e", "duration": 1, "long_form": False}
    (tmp_path / records.RUN).write_text('{"record_line_count": 900}')
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        for at in (3, 450, 899):
            lines = [json.dumps(line | {"id": f"r{k}"}) for k in range(900)]
            lines[at - 1], lines[-1] = "  ", "{"  # a line of blanks is no empty line
            (tmp_path / records.RECORD).write_text("\n".join(lines) + "\n")
            with pytest.raises(HardError, match=f" line {at}:"):
                records.read_run(spark, tmp_path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_preflight_lists_every_problem(spark, four, tmp_path):
    commands.build(spark, four, tmp_path / "out")
    (tmp_path / "out" / "dataset.json").write_text("[]")
    next((tmp_path / "out" / "audio" / "val").glob("*.wav")).unlink()
    with pytest.raises(HardError, match="found 2 problems") as error:
        commands.transcribe(spark, tmp_path / "out", tmp_path / "runs", Echo)
    assert "not a JSON object" in str(error.value) and "cannot read Normalized audio" in str(error.value)
    assert main(["transcribe", "--dataset", str(tmp_path / "out"), "--eval-out", str(tmp_path / "runs")], spark) == 1


def test_resampling_keeps_a_tone():
    x = wav.resampled(tone(1.0, 48000)[:, 0], 48000)
    want = tone(1.0)[:, 0]
    assert len(x) == 16000 and np.abs(x - want)[500:-500].max() < 1e-3
    same = tone(0.1)[:, 0]
    assert wav.resampled(same, 16000) is same
