"""The input index ``recordings.csv`` joined with the files that it names."""

from __future__ import annotations

import csv
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.errors import HardError
from cadenza.functions.text import content_hash, prompt_id, recording_id

INDEX = "recordings.csv"
#: The columns of the index, and those on which byte-identical files must agree, in this order.
COLUMNS = ("path", "speaker_id", "session_id", "prompt_text", "device", "environment")
AGREED = ("speaker_id", "session_id", "prompt_text", "device", "environment")
#: Listed files up to this number are named to the scan; more are found by scanning the folder. The result is the same.
NAMED = 5_000


def check_header(names: list[str] | None) -> None:
    if not names:
        raise HardError(f"{INDEX} is empty; a header row is required")
    if lacking := [c for c in COLUMNS if c not in names]:
        raise HardError(f"{INDEX} is missing column(s): {', '.join(lacking)}")
    if extra := sorted(set(names) - set(COLUMNS)):
        raise HardError(f"{INDEX} has unexpected column(s): {', '.join(extra)}")


def path_problem(path: Column) -> Column:
    """What is wrong with a listed path, or null: it must be a relative POSIX path that stays inside."""
    return (
        F.when(path == "", F.lit("empty path"))
        .when(F.contains(path, F.lit("\\")), F.concat(F.lit("path is not POSIX (contains a backslash): "), path))
        .when(F.startswith(path, F.lit("/")), F.concat(F.lit("path must be relative, not absolute: "), path))
        .when(F.array_contains(F.split(path, "/"), ".."), F.concat(F.lit("path escapes --data-in with '..': "), path))
    )


def index(spark: SparkSession, data_in: str | Path) -> DataFrame:
    """The rows of the index with ``row_no`` in file order; every structural problem is a HardError, the first one by line."""
    file = Path(data_in) / INDEX
    if not file.is_file():
        raise HardError(f"no {INDEX} at the --data-in root: {file}")
    with file.open(newline="", encoding="utf-8") as handle:
        header = next(csv.reader(handle), None)
    check_header(header)
    schema = ", ".join(f"`{c}` string" for c in header) + ", _corrupt_record string"
    read = spark.read.option("columnPruning", "false").csv(str(file), schema=schema, header=True, multiLine=True, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record", enforceSchema=True)
    # Whole rows are parsed whatever is selected: a ragged row shows only then.
    # One multi-line file is one partition, so ids rise in file order.
    rows = read.withColumn("row_no", F.monotonically_increasing_id())
    if rows.first() is None:
        raise HardError(f"{INDEX} has a header but no rows; at least one is required")
    bad = rows.where("_corrupt_record is not null").orderBy("row_no").first()
    if bad:
        fields = len(next(csv.reader([bad["_corrupt_record"]]), []))
        raise HardError(f"{INDEX} line {bad['row_no'] + 2}: {'more' if fields > len(header) else 'fewer'} fields than the header declares")
    rows = rows.select("row_no", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in COLUMNS])
    wrong = rows.withColumn("problem", path_problem(F.col("path"))).where("problem is not null").orderBy("row_no").select("problem").first()
    if wrong:
        raise HardError(f"{INDEX}: {wrong[0]}")
    return rows


def originals(spark: SparkSession, data_in: str | Path, rows: DataFrame) -> DataFrame:
    """``rows`` with ``content``; a listed file that does not exist is a HardError. Files that are not listed are not read."""
    root = Path(data_in).resolve()
    listed = rows.select("path").distinct()
    names = [r[0] for r in listed.limit(NAMED + 1).collect()]
    gone = next((r[0] for r in rows.orderBy("row_no").select("path").limit(NAMED).collect() if not (root / r[0]).is_file()), None)
    if gone is not None:
        raise HardError(f"{INDEX}: listed Original does not exist: {gone}")
    reader = spark.read.format("binaryFile")
    if len(names) <= NAMED:
        files = reader.load([(root / n).as_uri() for n in names])
    else:
        files = reader.option("recursiveFileLookup", "true").load(root.as_uri())
    where = F.regexp_replace("path", "^file:/+", "/")
    files = files.select(where.alias("_file"), "content")
    full = F.regexp_replace(F.concat(F.lit(f"{root}/"), F.col("path")), r"/(\./)+", "/")
    rows = rows.withColumn("_file", F.regexp_replace(full, "/+", "/"))
    # Only names are read here; every listed file must have met one, however many are listed.
    lost = rows.join(files.select("_file"), "_file", "left_anti").orderBy("row_no").select("path").first()
    if lost:
        raise HardError(f"{INDEX}: listed Original does not exist: {lost[0]}")
    return rows.join(files, "_file").drop("_file")


def recordings(read: DataFrame) -> DataFrame:
    """Rows with content -> ids and hash; the content stays, for decoding."""
    return read.select("row_no", recording_id(F.col("content")).alias("recording_id"), content_hash(F.col("content")).alias("content_hash"), prompt_id(F.col("prompt_text")).alias("prompt_id"), *COLUMNS, "content")


def conflicts(rows: DataFrame) -> DataFrame:
    """Of byte-identical files with different metadata: the first row and the first later row that disagrees, and the first such field."""
    facts = F.struct("row_no", "path", "recording_id", *AGREED)
    first = rows.groupBy("content_hash").agg(F.min_by(facts, "row_no").alias("a"))
    pairs = rows.select("content_hash", facts.alias("b")).join(first, "content_hash")
    field = None
    for name in AGREED:
        differs = F.col(f"a.{name}") != F.col(f"b.{name}")
        field = F.when(differs, F.lit(name)) if field is None else field.when(differs, F.lit(name))
    return pairs.withColumn("field", field).where("field is not null")


def collapsed(rows: DataFrame) -> DataFrame:
    """One row per content, the first in file order."""
    keep = [c for c in rows.columns if c != "content_hash"]
    best = rows.groupBy("content_hash").agg(F.min("row_no").alias("row_no"))
    return rows.join(best, ["content_hash", "row_no"], "left_semi").select("content_hash", *keep)


def read_recordings(spark: SparkSession, data_in: str | Path) -> DataFrame:
    """Resolved, hashed and collapsed recordings; conflicting copies are a HardError."""
    rows = recordings(originals(spark, data_in, index(spark, data_in)))
    clash = conflicts(rows.drop("content")).orderBy("b.row_no").first()
    if clash:
        a, b, name = clash["a"], clash["b"], clash["field"]
        raise HardError(f"{INDEX}: {a['path']!r} and {b['path']!r} are byte-identical Originals ({a['recording_id']}) but disagree on {name!r} ({a[name]!r} vs {b[name]!r})")
    return collapsed(rows)
