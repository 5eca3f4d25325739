"""Media columns from archive directories.

``media_archive`` is a Spark data source over a directory of ZIP archives with
stored members. Reading plans byte-range partitions from file sizes alone: a
member belongs to the range in which its header begins. A task finds its members in the
archive's central directory, reads each by its offset, checks its CRC and
retries it by itself, on a newly opened file, without repeating its neighbours; batches go to Spark
as Arrow. Writing makes archives under unused names; only those that the commit
lists in the manifest exist for readers, so lost or repeated tasks leave no trace.

The media kind used here is an 8-bit grey PNG of 64 columns; its text chunk
holds the unpadded length.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import warnings
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from cadenza.llm.frames import new_path, table
from cadenza.llm.ngram_join import pieces

MANIFEST = "_manifest.json"
WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def store(path: str):
    """(file system, path inside it) of a URI or a local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "hdfs:")) else (fs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    archive: str
    low: int
    high: int


@dataclass
class Archives(WriterCommitMessage):
    names: list


class MediaArchive(DataSource):
    """Options: ``path``; ``rangeBytes`` (8 MB) of a reading task; ``attempts`` (3) for a member; ``archiveBytes`` (256 MB) of a written archive."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return "archive string, offset long, member string, media binary, attempts int"

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return ArchiveWriter(self.options, overwrite)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.step, self.most = options["path"], int(options.get("rangeBytes", 8 << 20)), int(options.get("attempts", 3))

    def partitions(self) -> list[Range]:
        where, path = store(self.path)
        with where.open_input_stream(f"{path}/{MANIFEST}") as f:
            names = json.loads(f.read())
        sizes = {n: where.get_file_info(f"{path}/{n}").size for n in names}
        return [Range(n, low, low + self.step) for n in names for low in range(0, sizes[n], self.step)] or [Range("", 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if not part.archive:
            return
        where, path = store(self.path)
        with where.open_input_file(f"{path}/{part.archive}") as f, zipfile.ZipFile(f) as z:
            members = sorted((i for i in z.infolist() if part.low <= i.header_offset < part.high), key=lambda i: i.header_offset)
        rows, size, opened = [], 0, [None]
        try:
            for m in members:
                data, tries = self.member(where, f"{path}/{part.archive}", m, opened)
                rows.append((part.archive, m.header_offset, m.filename, data, tries))
                size += len(data)
                if size >= 4 << 20:
                    yield self.batch(rows)
                    rows, size = [], 0
        finally:
            if opened[0] is not None:
                opened[0].close()
        if rows:
            yield self.batch(rows)

    def member(self, where, path: str, m, opened: list) -> tuple[bytes, int]:
        for tries in range(1, self.most + 1):
            try:
                if opened[0] is None:
                    opened[0] = where.open_input_file(path)
                f = opened[0]
                f.seek(m.header_offset)
                head = f.read(30)
                f.seek(m.header_offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
                data = f.read(m.file_size)
                if head[:4] != b"PK\x03\x04" or len(data) != m.file_size or zlib.crc32(data) != m.CRC:
                    raise OSError(f"member {m.filename} at {m.header_offset} of {path} is damaged")
                return data, tries
            except OSError:
                if opened[0] is not None:
                    opened[0].close()
                    opened[0] = None
                if tries == self.most:
                    raise
        raise AssertionError

    @staticmethod
    def batch(rows: list) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["archive", "offset", "member", "media", "attempts"])


class ArchiveWriter(DataSourceArrowWriter):
    """Writes rows (member, media)."""

    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.most = options["path"], int(options.get("archiveBytes", 256 << 20))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Archives:
        warnings.filterwarnings("ignore", message="Duplicate name")
        where, path = store(self.path)
        where.create_dir(path, recursive=True)
        names: list[str] = []
        out = archive = None
        size = 0
        for batch in iterator:
            for member, media in zip(batch.column("member").to_pylist(), batch.column("media").to_pylist(), strict=True):
                if archive is None:
                    names.append(f"part-{uuid.uuid4().hex}.zip")
                    out = where.open_output_stream(f"{path}/{names[-1]}")
                    archive, size = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED), 0
                # A fixed time, so that equal members make equal archives.
                archive.writestr(zipfile.ZipInfo(member or "", (1980, 1, 1, 0, 0, 0)), media or b"")
                size += len(media or b"")
                if size >= self.most:
                    archive.close()
                    out.close()
                    archive = None
        if archive is not None:
            archive.close()
            out.close()
        return Archives(names)

    def commit(self, messages: list) -> None:
        """Lists the new archives behind those that are there already; an overwrite lists only the new ones."""
        where, path = store(self.path)
        where.create_dir(path, recursive=True)
        names = [n for m in messages if m for n in m.names]
        if not self.overwrite:
            try:
                with where.open_input_stream(f"{path}/{MANIFEST}") as f:
                    names = json.loads(f.read()) + names
            except FileNotFoundError:
                pass
        with where.open_output_stream(f"{path}/{MANIFEST}") as f:
            f.write(json.dumps(names).encode())

    def abort(self, messages: list) -> None:
        where, path = store(self.path)
        for m in messages:
            for n in m.names if m else []:
                where.delete_file(f"{path}/{n}")


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def padded(data: bytes) -> bytes:
    """Zero bytes up to a positive multiple of WIDTH."""
    return data + bytes(-len(data) % WIDTH if data else WIDTH)


def png(data: bytes) -> bytes:
    """``data``, padded, as 8-bit grey samples."""
    samples = np.frombuffer(padded(data), np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(samples), WIDTH + 1), np.uint8)  # each line starts with its filter, 0: none
    lines[:, 1:] = samples
    head = struct.pack(">IIBBBBB", WIDTH, len(samples), 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"tEXt", b"bytes\x00" + str(len(data)).encode()) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def unpng(media: bytes) -> tuple[bytes, int]:
    """(payload, unpadded length) of a PNG that ``png`` made; chunk checksums are verified."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, found = 8, {}
    while at < len(media):
        (n,) = struct.unpack_from(">I", media, at)
        kind, data = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", media, at + 8 + n)[0] != zlib.crc32(media[at + 4 : at + 8 + n]):
            raise ValueError(f"damaged chunk {kind!r}")
        found[kind] = found.get(kind, b"") + data
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(found[b"IDAT"]), np.uint8).reshape(-1, WIDTH + 1)
    if lines[:, 0].any():
        raise ValueError("filtered lines")
    return lines[:, 1:].tobytes(), int(found[b"tEXt"].partition(b"\x00")[2])


def feature(payload: bytes) -> str:
    """Whole-number statistics of the samples: lines, sum, sum of squares, distinct values, the most frequent value and steps between neighbours."""
    x = np.frombuffer(payload, np.uint8)
    counts = np.bincount(x, minlength=256)
    values = np.arange(256)
    steps = int(np.abs(np.diff(x.astype(np.int16))).sum(dtype=np.int64))
    return f"lines={len(x) // WIDTH};sum={int(counts @ values)};squares={int(counts @ (values * values))};distinct={int(np.count_nonzero(counts))};mode={int(counts.argmax())};steps={steps}"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from cadenza.llm import media as own

    for batch in own.pieces(batches):
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        names = [f"{d}.png" for d in batch.column("doc_id").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([own.png(t or b"") for t in texts], pa.binary())], names=["member", "media"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from cadenza.llm import media as own

    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        rows = []
        for member, data in zip(batch.column("member").to_pylist(), batch.column("media").to_pylist(), strict=True):
            payload, n = own.unpng(data)
            doc = member.removesuffix(".png")
            rows.append((None if doc == "None" else int(doc), n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-own.WIDTH :]), len(data), hashlib.sha256(data).hexdigest(), own.feature(payload)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def stored(docs: DataFrame, path: str | None = None) -> str:
    """Writes each row's text (null: empty) as a member ``<doc_id>.png``; returns the directory. Repeated ids make repeated members."""
    spark = docs.sparkSession
    spark.dataSource.register(MediaArchive)
    path = path or new_path(spark, "media")
    encoded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_encode, "member string, media binary")
    encoded.write.format("media_archive").mode("append").option("path", path).save()
    return path


def members(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").options(path=path, **options).load()


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return members(spark, path).select("member", "media").mapInArrow(_features, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
