"""Every driver query against its SQL; scoring and streams against fixed vectors."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from cadenza.errors import HardError
from cadenza.operators import scoring
from cadenza.plans.driver_queries import ORACLES, QUERIES
from cadenza.streaming.pooled import finished, pooled_stream, record_stream


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def comparable(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple("null" if v is None or v != v else str(v) for v in row) for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, database):
    got = QUERIES[name](spark, sf_dir).toPandas()
    assert len(got)
    if name in ORACLES:
        assert comparable(got) == comparable(database.execute(ORACLES[name]).df())


def table(spark, rows):
    fields = "id reference hypothesis split session_id prompt_id device environment".split()
    return spark.createDataFrame([(f"r{k}", *r, "p", "d", "e") for k, r in enumerate(rows)], ", ".join(f"{f} string" for f in fields))


def test_pooled_and_macro(spark):
    rows = table(spark, [("a b c d", "a b c x", "train", "s1"), ("e", "x", "train", "s1"), ("f", "f", "val", "s2"), ("g", None, "test", "s3")])
    groups = scoring.breakdowns(scoring.scored(rows)).where("tier = 'tier-a/1'")
    whole = groups.where("axis = 'all'").first()
    assert (whole.samples, whole.word_s, whole.word_n) == (3, 2, 6) and abs(whole.wer - 2 / 6) < 1e-12
    macro = scoring.macro(groups).where("axis = 'session' and rate = 'wer'").first()
    assert abs(macro["mean"] - 0.2) < 1e-12 and abs(macro["stddev"] - 0.2) < 1e-12 and macro["excluded_groups"] == 0
    ordered = [r.value for r in scoring.in_order(groups.where("axis = 'split'")).collect()]
    assert ordered == ["train", "val"]


def test_undefined_rates(spark):
    scores = scoring.scored(table(spark, [("Um.", "Um hello.", "train", "s1"), ("Um.", "Uh.", "train", "s2")]))
    b = {r.id: r for r in scores.where("tier = 'english-standard/1'").collect()}
    assert (b["r0"].word_i, b["r0"].word_n, b["r0"].char_i, b["r0"].sentence_error) == (1, 0, 5, True)
    assert (b["r1"].word_i, b["r1"].sentence_error) == (0, False)
    macro = scoring.macro(scoring.breakdowns(scores)).where("tier = 'english-standard/1' and axis = 'session' and rate = 'wer'").first()
    assert macro["mean"] is None and macro["excluded_groups"] == 2
    with pytest.raises(HardError, match="zero total Reference tokens"):
        scoring.check_scope(scoring.breakdowns(scoring.scored(table(spark, [(".", "hello", "train", "s")]))))


def test_comparisons(spark):
    rows = table(spark, [("a b", "a c", "train", "s"), ("d", "d", "val", "s")])
    a, b = scoring.scored(rows), scoring.scored(rows.withColumn("hypothesis", F.col("reference")))
    delta = {r.id: r.wer_delta for r in scoring.paired_delta(a, b).where("tier = 'tier-a/1'").collect()}
    assert delta == {"r0": -0.5, "r1": 0.0}
    tiers = scoring.tier_delta(scoring.breakdowns(a), "tier-a/1", "english-standard/1").where("axis = 'all'").first()
    assert tiers.wer_delta == 0.0
    assert scoring.worklist(a).collect()[0].id == "r0"
    record = rows.withColumn("error", F.lit(None).cast("string"))
    assert scoring.masked_difference(record, record.withColumn("hypothesis", F.lit("z"))).count() == 0
    manifest = rows.select("id", F.col("reference").alias("text"))
    assert scoring.reference_mismatches(rows, manifest).count() == 0
    assert scoring.reference_mismatches(rows, manifest.where("id = 'r0'")).count() == 1


def test_stream_of_records(spark, tmp_path):
    line = '{"id":"%s","reference":"a b","hypothesis":%s,"error":null,"split":"test","session_id":"s","speaker_id":"p","prompt_id":"q","device":"d","environment":"e","duration":1.0,"long_form":false}\n'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(line % ("x", '"a b"') + line % ("y", "null"))
    (tmp_path / "in" / "2.json").write_text(line % ("z", '"a"'))
    done = finished(pooled_stream(record_stream(spark, str(tmp_path / "in"))), str(tmp_path / "state"))
    row = done.where("tier = 'tier-a/1'").first()
    assert (row.samples, row.word_d, row.word_n, row.sentence_errors) == (2, 1, 4, 1)
