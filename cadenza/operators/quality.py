"""Quality of recordings: measuring, tallying, digesting."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.errors import HardError
from cadenza.functions import signal
from cadenza.functions.signal import FLAGS

METRICS = ", ".join(f"{k} double" for k in signal.PLACES) + ", flags array<string>"


def measured(rows: DataFrame, quality: dict, staging: str | None = None, place=None) -> DataFrame:
    """recording_id, row_no, path, metrics, flags and problem; each recording is decoded once.

    ``place(recording, original, samples, metrics, staging)`` may write artifacts while the audio is at hand.
    """
    columns = [c for c in rows.columns if c != "content"]
    schema = ", ".join(f"`{n}` {t}" for n, t in rows.drop("content").dtypes) + f", {METRICS}, problem string"

    def each(frames):
        from cadenza.sources import wav

        for frame in frames:
            if frame.empty:
                continue
            out = []
            for row in frame.to_dict("records"):
                facts = {c: row[c] for c in columns}
                try:
                    original, samples = wav.normalized(bytes(row["content"]), row["path"])
                except HardError as error:
                    out.append(facts | {"problem": str(error), "flags": []})
                    continue
                metrics = signal.measure(original, samples, quality)
                if place:
                    place(facts, original, samples, metrics, staging)
                out.append(facts | metrics | {"problem": None})
            yield pd.DataFrame(out, columns=[*columns, *signal.PLACES, "flags", "problem"])

    return rows.mapInPandas(each, schema)


def check_measured(rows: DataFrame) -> None:
    """The first recording, by row, that does not decode is a HardError."""
    bad = rows.where("problem is not null").orderBy("row_no").select("problem").first()
    if bad:
        raise HardError(bad[0])


def flag_tally(rows: DataFrame) -> DataFrame:
    """One row: recordings, clean, flagged and a count for each flag."""
    return rows.agg(F.count("*").alias("recordings"), F.count_if(F.size("flags") == 0).alias("clean"), F.count_if(F.size("flags") > 0).alias("flagged"), *[F.count_if(F.array_contains("flags", f)).alias(f) for f in FLAGS])


def evidence(flag: str, row) -> str:
    if flag == "clipping":
        return f"peak={row['peak_dbfs']:.2f}dBFS clip_ratio={row['clip_ratio']:.4f}"
    if flag == "low_volume":
        return f"active_rms={row['active_rms_dbfs']:.2f}dBFS"
    return f"duration={row['duration_s']:.3f}s"


def digest(rows: DataFrame) -> str:
    """The human quality digest; flagged recordings in the order of the index."""
    tally = flag_tally(rows).first()
    width = max(map(len, FLAGS))
    lines = [f"Quality: {tally['recordings']} recordings — {tally['clean']} clean, {tally['flagged']} flagged"]
    lines += [f"  {f:<{width}} {tally[f]}" for f in FLAGS]
    if tally["flagged"]:
        lines += ["", "Flagged:"]
        for row in rows.where(F.size("flags") > 0).orderBy("row_no").toLocalIterator():
            lines += [f"  {row['recording_id']} {f:<{width}} {evidence(f, row)}" for f in row["flags"]]
    return "\n".join(lines) + "\n"


def quality_lines(rows: DataFrame):
    """Documents of the quality report, by id."""
    for row in rows.orderBy("recording_id").toLocalIterator():
        yield {"id": row["recording_id"], **signal.rounded(row.asDict()), "flags": list(row["flags"])}
