import hashlib
import struct
import zipfile
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from cadenza.llm import media


@given(st.binary(max_size=500))
def test_png_round_trip(data):
    picture = media.png(data)
    assert media.unpng(picture) == (media.padded(data), len(data))
    width, height, depth, colour = struct.unpack_from(">IIBB", picture, 16)
    assert (width, depth, colour) == (64, 8, 0) and width * height == len(media.padded(data)) > 0


def test_damaged_pictures_are_refused():
    picture = bytearray(media.png(b"abc" * 50))
    picture[60] ^= 1
    with pytest.raises(ValueError):
        media.unpng(bytes(picture))
    with pytest.raises(ValueError):
        media.unpng(b"GIF89a")


def test_query(spark, sf_dir):
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = media.op7_media(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        data = docs[r.doc_id]
        payload = data + bytes(-len(data) % 64 if data else 64)
        picture = media.png(data)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(picture), hashlib.sha256(picture).hexdigest(), media.feature(payload))


def test_ranges_give_every_member_once(spark, tmp_path):
    df = spark.createDataFrame([(k, f"text {k} " * (k % 40)) for k in range(300)], "doc_id long, text string").repartition(3)
    path = media.stored(df, f"file://{tmp_path}/a")
    for step in (500, 7919, 1 << 30):
        rows = media.members(spark, path, rangeBytes=step).collect()
        assert sorted(int(r.member[:-4]) for r in rows) == list(range(300))
        assert {r.attempts for r in rows} == {1}
    (name, *_) = sorted(p.name for p in (tmp_path / "a").glob("*.zip"))
    with zipfile.ZipFile(tmp_path / "a" / name) as z:
        assert z.testzip() is None


def test_uncommitted_archives_do_not_exist(spark, tmp_path):
    path = media.stored(spark.createDataFrame([(1, "a")], "doc_id long, text string"), f"file://{tmp_path}/a")
    (tmp_path / "a" / "part-lost.zip").write_bytes(b"half an archive")
    assert media.members(spark, path).count() == 1


def test_members_are_retried_alone(tmp_path, spark):
    path = media.stored(spark.createDataFrame([(k, f"t{k}") for k in range(5)], "doc_id long, text string").coalesce(1), str(tmp_path / "a"))
    reader = media.ArchiveReader({"path": path})
    calls = []

    class Flaky:
        def __init__(self, where):
            self.where = where

        def open_input_file(self, name):
            calls.append(name)
            if len(calls) == 1:
                raise OSError("gone")
            return self.where.open_input_file(name)

    where, root = media.store(path)
    (part,) = reader.partitions()
    with zipfile.ZipFile(f"{root}/{part.archive}") as z:
        infos = z.infolist()
    opened = [None]
    got = [reader.member(Flaky(where), f"{root}/{part.archive}", m, opened) for m in infos]
    assert [tries for _, tries in got] == [2, 1, 1, 1, 1]
    broken = infos[0]
    broken.CRC ^= 1
    with pytest.raises(OSError, match="damaged"):
        reader.member(where, f"{root}/{part.archive}", broken, [None])


def test_edges(spark, edge, empty, edge_rows):
    rows = media.members(spark, media.stored(edge)).collect()
    assert len(rows) == len(edge_rows)
    assert {r.member for r in rows} == {f"{d}.png" for d, *_ in edge_rows}
    assert media.members(spark, media.stored(empty)).count() == 0


def test_appending_keeps_what_was_there(tmp_path, spark):
    def add(rows, mode):
        df = spark.createDataFrame(rows, "member string, media binary")
        df.write.format("media_archive").option("path", str(tmp_path / "a")).mode(mode).save()

    spark.dataSource.register(media.MediaArchive)
    add([("1.png", b"one")], "append")
    add([("2.png", b"two")], "append")
    assert sorted(r.member for r in media.members(spark, str(tmp_path / "a")).collect()) == ["1.png", "2.png"]
    add([("3.png", b"three")], "overwrite")
    assert [r.member for r in media.members(spark, str(tmp_path / "a")).collect()] == ["3.png"]
