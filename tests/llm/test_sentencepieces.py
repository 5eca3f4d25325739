import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import sentencepieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return sp.Vocabulary(PATH)


def ids_of(texts, vocabulary, keys=None, seed=1):
    ids, first = sp.sampled(texts, np.arange(len(texts)) if keys is None else np.array(keys), sp.Store(vocabulary), seed)
    return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


@given(st.lists(st.text(max_size=30), max_size=8))
@settings(max_examples=80, deadline=None)
def test_decoding_is_lossless(texts):
    vocabulary = test_decoding_is_lossless.__dict__.setdefault("v", sp.Vocabulary(PATH))
    for text, ids in zip(texts, ids_of(texts, vocabulary), strict=True):
        assert sp.decode(ids, vocabulary) == text.encode("utf-8")


def test_the_library_decodes_the_same(vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = ["hello world", " two  spaces ", "new\nline and 漢字 😀", "naïve café"]
    for text, ids in zip(texts, ids_of(texts, vocabulary), strict=True):
        assert library.decode(ids) == text


def segmentations(text, weights):
    if not text:
        yield ()
    for k in range(1, len(text) + 1):
        if text[:k] in weights:
            for rest in segmentations(text[k:], weights):
                yield (text[:k], *rest)


@pytest.mark.parametrize("word", ["oning", "a", "token", "the the"])
def test_samples_follow_the_exact_posterior(word, vocabulary):
    weights = {vocabulary.surface[i]: w for i, w in zip(vocabulary.ids.tolist(), vocabulary.weights.tolist(), strict=True)}
    text = (" " + word).encode()
    exact = {s: math.exp(sum(weights[p] for p in s)) for s in segmentations(text, weights) if not any(b" " in p[1:] and p.strip() for p in s)}
    total = sum(exact.values())
    reps = 20_000
    seen = Counter(tuple(vocabulary.surface[i] for i in ids) for ids in ids_of([word] * reps, vocabulary))
    assert set(seen) <= set(exact)
    for s, p in exact.items():
        p /= total
        assert abs(seen[s] / reps - p) < 5 * math.sqrt(p * (1 - p) / reps) + 1e-3


def test_results_do_not_depend_on_slices(vocabulary):
    texts = ["some words that repeat and repeat", None, "", "other words", "x" * 3000, "some words that repeat"] * 3
    keys = np.arange(len(texts)) * 77
    together = ids_of(texts, vocabulary, keys)
    store = sp.Store(vocabulary)
    alone = [sp.sampled([t], keys[k : k + 1], store, 1)[0].tolist() for k, t in enumerate(texts)]
    assert together == alone
    assert together != ids_of(texts, vocabulary, keys, seed=2)


def test_query(spark, sf_dir):
    rows = {r.doc_id: r for r in sp.op10_sentencepiece(spark, sf_dir).collect()}
    assert all(r.lossless for r in rows.values())
    again = {r.doc_id: r for r in sp.encoded(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5), with_ids=False).collect()}
    assert rows == again


def test_edges(spark, edge, empty, edge_rows):
    rows = sp.encoded(edge, keep=("lang", "score")).collect()
    assert len(rows) == len(edge_rows)
    assert all(r.lossless and len(r.ids) == r.n_pieces for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (3, 4)} == {0}
    assert sp.encoded(empty).count() == 0


def test_long_words_alike_decode_to_themselves(vocabulary):
    """Pairs of words that a polynomial modulo 2**64 cannot tell apart."""
    words = ["".join("ab"[k.bit_count() & 1] for k in range(n)) for n in (1024, 2048, 4096)]
    texts = [t for w in words for t in (w, w.translate(str.maketrans("ab", "ba")))]
    for text, ids in zip(texts, ids_of(texts, vocabulary), strict=True):
        assert sp.decode(ids, vocabulary) == text.encode()
