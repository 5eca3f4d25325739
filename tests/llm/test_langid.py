import numpy as np
from pyspark.sql import functions as F

from cadenza.llm import langid


def test_vectors_bind_rotated_letters():
    grams = langid.Grams(["ab"], langid._is_letter(), 3)
    (letters,) = (grams.alphabet,)
    base = dict(zip(letters.tolist(), langid.letter_vectors(letters, 128), strict=True))
    want = [np.roll(base[x], 2) * np.roll(base[y], 1) * base[z] for x, y, z in ((0, ord("a"), ord("b")), (ord("a"), ord("b"), 0))]
    assert (grams.vectors(grams.codes, 128) == np.array(want)).all()
    assert abs(langid.letter_vectors(np.arange(400), 1024).astype(int).mean()) < 0.01


def test_scores_equal_brute_force():
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abcdeé  ñ1😀漢"), 50)) for _ in range(300)] + ["", None, "12", "Ä"]
    prototypes = langid.Prototypes(["x", "y"], rng.standard_normal((2, 256)), 3)
    best, score = langid.scores(texts, prototypes, langid._is_letter(), block=64)
    for k, text in enumerate(texts):
        grams = langid.Grams([text], langid._is_letter(), 3)
        if not any(c.isalpha() for c in text or ""):
            assert best[k] == -1 and score[k] == 0
            continue
        bundle = grams.vectors(grams.codes, 256).astype(float).sum(axis=0)
        cosines = prototypes.vectors @ bundle / np.linalg.norm(bundle)
        assert best[k] == cosines.argmax()
        assert abs(score[k] - max(0, cosines.max())) < 1e-4


def test_training_is_exact_in_any_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a, b = langid.learned(docs), langid.learned(docs.repartition(7))
    assert a.langs == b.langs and (a.vectors == b.vectors).all()


def test_held_out_accuracy(spark):
    rows = langid.op3_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, count = rows.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert count > 200 and right > 0.98
    assert rows.where("score < 0 or score > 1").count() == 0


def test_edges(spark, edge, empty, edge_rows):
    found = langid.predicted(edge, langid.learned(edge))
    assert set(found.columns) == set(edge.columns) | {"lang_pred", "score"}
    got = {r.doc_id: (r.lang_pred, r.score) for r in found.collect()}
    assert found.count() == len(edge_rows)
    for doc in (3, 4, 5, 7):
        assert got[doc] == ("und", 0.0)
    assert got[6][0] == "de" and got[2][0] == "en"
    untaught = langid.predicted(edge, langid.learned(empty))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}
    assert langid.predicted(empty, langid.learned(edge)).count() == 0


def test_stage_keeps_documents_with_a_language(spark, edge, empty):
    kept = langid.language_stage(spark, edge, "")
    assert kept.columns == edge.columns
    assert {1, 2, 6, 9} <= {r.doc_id for r in kept.collect()}
    assert {r.score for r in kept.collect()} == {0.5}
    assert not {3, 4, 5, 7} & {r.doc_id for r in kept.collect()}
    assert langid.language_stage(spark, empty, "").count() == 0


def test_texts_in_unlearned_scripts_are_rejected(spark, sf_dir):
    """600 made-up languages of 30 letters each, in scripts that no training text has."""
    rng = np.random.default_rng(4)
    prototypes = langid.learned(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    texts = []
    for k in range(600):
        letters = [chr(0x4E00 + 30 * k + i) for i in range(30)]
        texts.append(" ".join("".join(rng.choice(letters, 5)) for _ in range(60)))
    _, score = langid.scores(texts, prototypes, langid._is_letter())
    passing = (score >= langid.least_score(prototypes)).mean()
    assert len(prototypes.langs) > 1 and passing <= 0.03 < (score >= 0.05).mean()
