import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import rans


@given(st.lists(st.integers(0, 300), min_size=1, max_size=400), st.integers(0, 5))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(ids, rare):
    counts = {i: 1 + (i * 7919) % 1000 ** (i % 3) for i in set(ids) | {1000 + rare}}
    coder = rans.Coder(*rans.frequencies(counts))
    block = coder.encode(np.array(ids))
    assert coder.decode(block, len(ids)).tolist() == ids


def test_frequencies_fill_the_scale():
    symbols, freqs = rans.frequencies({5: 1, 7: 10**12, 9: 3})
    assert symbols.tolist() == [5, 7, 9] and freqs.sum() == 1 << rans.SCALE and freqs.min() >= 1
    assert rans.frequencies({})[0].tolist() == []


def test_near_entropy():
    rng = np.random.default_rng(0)
    ids = np.minimum(rng.geometric(0.05, 1 << 16), 200)
    values, seen = np.unique(ids, return_counts=True)
    block = rans.Coder(*rans.frequencies(dict(zip(values.tolist(), seen.tolist(), strict=True)))).encode(ids)
    p = seen / seen.sum()
    assert len(block) - 8 * rans.LANES < -(p * np.log2(p)).sum() * len(ids) / 8 * 1.01 + 4 * rans.LANES


def test_encoder_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, (encode, kind) = Tokenizer.from_file(path), rans.word_encoder(path)
    rng = np.random.default_rng(1)
    parts = ["a", "B", " ", " ", "  ", "\n", "\t", "1", ".", "'s", "é", "_", "漢", "😀", "don't", "　", "<|endoftext|>", "²", ","]
    for text in ["", " ", "   ", *("".join(rng.choice(parts, 12)) for _ in range(3000))]:
        assert np.frombuffer(encode(text), kind).tolist() == whole.encode(text, add_special_tokens=False).ids


def expected(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for d, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    assert sorted(map(tuple, rans.op6_token_files(spark, sf_dir).collect())) == expected(docs)


def test_many_chunks_and_damage(spark, tmp_path, monkeypatch):
    rows = [(k, f"text {k} " * (k % 50)) for k in range(200)]
    files = rans.write(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}/files")
    again = rans.opened(spark, files.path)
    assert sorted(map(tuple, rans.summaries(again, spark).collect())) == expected(rows)
    row = files.chunks(spark).first().asDict()
    coder = rans.Coder(*files.shared.value[:2])
    rans.decoded(row, coder)
    row["payload"] = bytearray(row["payload"])
    row["payload"][-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decoded(row, coder)


def test_edges(spark, edge, empty, edge_rows):
    got = rans.summaries(rans.write(edge), spark).collect()
    assert len(got) == len(edge_rows)
    known = sorted((r for r in edge_rows if r[0] is not None), key=lambda r: (r[0],))
    unknown = [r for r in got if r.doc_id is None]
    skipped = sum(r.n_tokens for r in unknown)
    assert sorted(r.start for r in unknown)[0] == 0
    want = [(d, s + skipped, n, c) for d, s, n, c in expected([(r[0], r[1]) for r in known])]
    assert sorted(map(tuple, (r for r in got if r.doc_id is not None))) == want
    assert rans.summaries(rans.write(empty), spark).count() == 0
