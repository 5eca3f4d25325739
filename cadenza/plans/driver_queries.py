"""Queries over the driver's tables, with SQL of the same meaning.

The tables hold no audio, so documents stand for recordings, their sources for
sessions, their languages for speakers, embeddings for samples, and a user's
turn with the assistant's next turn for a reference and its hypothesis.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.config import DEFAULTS, SPLITS
from cadenza.functions import signal, text
from cadenza.functions.serialization import json_line
from cadenza.operators import manifest, quality, scoring, split
from cadenza.sources import recordings
from cadenza.streaming.pooled import windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "breakdowns"


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Identity and ingest ---------------------------------------------------------------------


@query("select doc_id, 'rec_' || sha256(coalesce(text, ''))[1:16] as recording_id, 'sha256:' || sha256(coalesce(text, '')) as content_hash from documents")
def content_identity(spark, sf_dir):
    content = F.coalesce("text", F.lit(""))
    return read(spark, sf_dir, "documents").select("doc_id", text.recording_id(content).alias("recording_id"), text.content_hash(content).alias("content_hash"))


@query(r"select doc_id, 'prm_' || sha256(trim(regexp_replace(nfc_normalize(coalesce(text, '')), '\s+', ' ', 'g')))[1:16] as prompt_id from documents")
def prompt_identity(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.prompt_id(F.coalesce("text", F.lit(""))).alias("prompt_id"))


@query("select sha256(text) as content_hash, min(doc_id) as doc_id, count(*) as copies, arg_min(source, doc_id) as source from documents where text is not null group by 1")
def collapse_duplicates(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").where("text is not null").select(F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"), F.col("doc_id").alias("row_no"), "source")
    copies = rows.groupBy("content_hash").agg(F.count("*").alias("copies"))
    return recordings.collapsed(rows).join(copies, "content_hash").select("content_hash", F.col("row_no").alias("doc_id"), "copies", "source")


@query("select sha256(text) as content_hash, count(distinct lang) as langs, count(distinct source) as sources from documents where text is not null group by 1 having count(distinct lang) > 1 or count(distinct source) > 1")
def conflict_report(spark, sf_dir):
    groups = read(spark, sf_dir, "documents").where("text is not null").groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("content_hash"))
    return groups.agg(F.count_distinct("lang").alias("langs"), F.count_distinct("source").alias("sources")).where("langs > 1 or sources > 1")


@query("""
with d as (select doc_id, sha256(text) as h, coalesce(lang, '') as lang, coalesce(source, '') as source from documents where text is not null),
f as (select h, arg_min(lang, doc_id) as lang, arg_min(source, doc_id) as source, min(doc_id) as doc_id from d group by h)
select f.doc_id as first_doc, d.doc_id as other_doc, case when d.lang <> f.lang then 'speaker_id' else 'session_id' end as field from d join f on f.h = d.h where d.lang <> f.lang or d.source <> f.source""")
def conflicting_copies(spark, sf_dir):
    """Documents as index rows: copies whose speaker (language) or session (source) disagrees with the first one's."""
    rows = read(spark, sf_dir, "documents").where("text is not null").withColumns({"content_hash": F.sha2(F.col("text").cast("binary"), 256), "row_no": F.col("doc_id"), "path": F.lit(""), "recording_id": F.lit(""), "speaker_id": F.coalesce("lang", F.lit("")), "session_id": F.coalesce("source", F.lit("")), "prompt_text": F.lit(""), "device": F.lit(""), "environment": F.lit("")})
    return recordings.conflicts(rows).select(F.col("a.row_no").alias("first_doc"), F.col("b.row_no").alias("other_doc"), "field")


@query(r"""
select page_id, case when url = '' then 'empty path'
  when contains(url, '\') then 'path is not POSIX (contains a backslash): ' || url
  when starts_with(url, '/') then 'path must be relative, not absolute: ' || url
  when list_contains(string_split(url, '/'), '..') then 'path escapes --data-in with ''..'': ' || url end as problem from pages""")
def path_contract(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", recordings.path_problem(F.col("url")).alias("problem"))


@query("select d.doc_id, d.source from documents d left join labels l on l.doc_id = d.doc_id where l.doc_id is null")
def anti_join_unlisted(spark, sf_dir):
    return read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "source")


@query("select coalesce(d.doc_id, l.doc_id) as doc_id, case when l.doc_id is null then 'only_documents' when d.doc_id is null then 'only_labels' else 'both' end as side from documents d full join labels l on l.doc_id = d.doc_id")
def id_set_equality(spark, sf_dir):
    a, b = read(spark, sf_dir, "documents").select("doc_id", F.lit(1).alias("a")), read(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("b"))
    return a.join(b, "doc_id", "full_outer").select("doc_id", F.when(F.col("b").isNull(), "only_documents").when(F.col("a").isNull(), "only_labels").otherwise("both").alias("side"))


@query("select d.doc_id, l.quality, l.toxic from documents d join labels l using (doc_id)")
def quality_join(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id").join(read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "quality", "toxic")


@query("select doc_id, coalesce(lang, 'en') as lang, case when lang is null then 'defaulted' else 'declared' end as origin from (select doc_id, nullif(lang, 'en') as lang from documents)")
def language_resolution(spark, sf_dir):
    declared = F.nullif(F.col("lang"), F.lit("en"))
    return read(spark, sf_dir, "documents").select("doc_id", F.coalesce(declared, F.lit("en")).alias("lang"), F.when(declared.isNull(), "defaulted").otherwise("declared").alias("origin"))


# Splitting -------------------------------------------------------------------------------


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.session_sizes(read(spark, sf_dir, "documents").where("source is not null"), "source")


_FILL = """
with recursive sizes as (select source as session_id, count(*) as n from documents where source is not null group by 1),
ranked as (select session_id, n, row_number() over (order by sha256('0:' || session_id)) as hash_rank, sum(n) over () as total from sizes),
fill as (
  select 0::bigint as k, 0::bigint as a, 0::bigint as b, 0::bigint as c, null::varchar as session_id, 0::bigint as n, null::varchar as split
  union all
  select k + 1, a + case when s = 'train' then m else 0 end, b + case when s = 'val' then m else 0 end, c + case when s = 'test' then m else 0 end, sid, m, s
  from (select f.k, f.a, f.b, f.c, r.n as m, r.session_id as sid,
    case when 0.8::double * r.total - f.a >= 0.1::double * r.total - f.b and 0.8::double * r.total - f.a >= 0.1::double * r.total - f.c then 'train'
      when 0.1::double * r.total - f.b >= 0.1::double * r.total - f.c then 'val' else 'test' end as s
    from fill f join ranked r on r.hash_rank = f.k + 1)
), placed as (select session_id, n, k as hash_rank, split from fill where session_id is not null)
"""


@query("select source as session_id, count(*) as n from documents where source is not null group by 1")
def session_sizes(spark, sf_dir):
    return sessions(spark, sf_dir)


@query("select session_id, n, row_number() over (order by sha256('0:' || session_id)) as hash_rank from (select source as session_id, count(*) as n from documents where source is not null group by 1)")
def hash_order(spark, sf_dir):
    return split.water_filled(sessions(spark, sf_dir), DEFAULTS["split"]).select("session_id", "n", "hash_rank")


@query(_FILL + "select * from placed")
def water_fill(spark, sf_dir):
    return split.water_filled(sessions(spark, sf_dir), DEFAULTS["split"])


#: Languages as sessions: so few that val or test may be left empty.
_REPAIR = _FILL.replace("source", "lang") + """,
facts as (select *, count(*) over () as sessions, sum(n) over () as total from placed),
v as (select sum(case when split = 'val' then 1 else 0 end) as held, max(sessions) as sessions, max(total) as total from facts),
d1 as (select split from (select split, count(*) as c, sum(n) as m, max(total) as t from facts group by split) where c >= 2
  order by case split when 'train' then 0.8::double else 0.1::double end * t - m, case split when 'train' then 1 when 'val' then 2 else 3 end limit 1),
m1 as (select session_id from facts where split = (select split from d1) and (select held = 0 and sessions >= 3 from v) order by n, hash_rank limit 1),
p1 as (select session_id, n, hash_rank, sessions, total, case when session_id in (select session_id from m1) then 'val' else split end as split from facts),
t as (select sum(case when split = 'test' then 1 else 0 end) as held from p1),
d2 as (select split from (select split, count(*) as c, sum(n) as m, max(total) as t from p1 group by split) where c >= 2
  order by case split when 'train' then 0.8::double else 0.1::double end * t - m, case split when 'train' then 1 when 'val' then 2 else 3 end limit 1),
m2 as (select session_id from p1 where split = (select split from d2) and (select held = 0 from t) and sessions >= 3 order by n, hash_rank limit 1)
select session_id, n, case when session_id in (select session_id from m2) then 'test' else split end as split from p1
"""


@query(_REPAIR)
def split_repair(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").where("lang is not null").select(F.col("lang").alias("session_id"), F.col("source").alias("speaker_id"))
    done = split.split_sessions(rows, DEFAULTS["split"])
    return spark.createDataFrame([(s, n, done.assigned[s]) for s, n in done.order], "session_id string, n long, split string")


@query(_FILL + "select s.split, count(p.session_id) as sessions, cast(coalesce(sum(p.n), 0) as bigint) as samples from (values ('train'), ('val'), ('test')) s(split) left join placed p on p.split = s.split group by 1")
def split_counts(spark, sf_dir):
    return split.split_counts(split.water_filled(sessions(spark, sf_dir), DEFAULTS["split"]))


@query(_FILL + "select session_id, split, n as num_samples from placed")
def session_inventory(spark, sf_dir):
    return split.water_filled(sessions(spark, sf_dir), DEFAULTS["split"]).select("session_id", "split", F.col("n").alias("num_samples"))


def placed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = split.water_filled(sessions(spark, sf_dir), DEFAULTS["split"]).select(F.col("session_id").alias("source"), "split")
    return read(spark, sf_dir, "documents").join(assigned, "source")


@query(_FILL + "select lang as speaker_id, array_to_string(list_filter(['train', 'val', 'test'], lambda s: list_contains(list(distinct p.split), s)), ',') as splits from documents d join placed p on p.session_id = d.source group by 1 having count(distinct p.split) > 1")
def speaker_overlap(spark, sf_dir):
    found = split.speaker_overlaps(placed_documents(spark, sf_dir).withColumnRenamed("lang", "speaker_id"))
    return found.select("speaker_id", F.array_join("splits", ",").alias("splits"))


def manifest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    content = F.coalesce("text", F.lit(""))
    rows = placed_documents(spark, sf_dir).select(
        "doc_id", text.recording_id(F.concat_ws(":", F.col("doc_id").cast("string"), content)).alias("recording_id"), text.content_hash(content).alias("content_hash"), F.lit("prm").alias("prompt_id"), content.alias("prompt_text"),
        F.col("lang").alias("speaker_id"), F.col("source").alias("session_id"), F.lit("mic").alias("device"), F.lit("room").alias("environment"), "split", (F.col("n_chars") / F.lit(16.0)).alias("duration_s"),
    )
    return manifest.samples(rows, "en")


_MANIFEST = _FILL + """, m as (
  select 'rec_' || sha256(d.doc_id || ':' || coalesce(d.text, ''))[1:16] as id, p.split, d.n_chars / 16.0::double as duration, coalesce(d.text, '') as text, d.lang as speaker_id, d.source as session_id, 'sha256:' || sha256(coalesce(d.text, '')) as content_hash
  from documents d join placed p on p.session_id = d.source)
"""


@query(_MANIFEST + "select id, 'audio/' || split || '/' || id || '.wav' as audio_filepath, duration, text, speaker_id, session_id, 16000 as sample_rate, 1 as num_channels, content_hash, 'en' as lang, split from m")
def manifest_projection(spark, sf_dir):
    return manifest_rows(spark, sf_dir).select("id", "audio_filepath", "duration", "text", "speaker_id", "session_id", "sample_rate", "num_channels", "content_hash", "lang", "split")


@query(_MANIFEST + "select id, id || '.wav' as file_name, duration, text, speaker_id, session_id, content_hash from m")
def hf_view(spark, sf_dir):
    return manifest.folder_view(manifest_rows(spark, sf_dir)).select("id", "file_name", "duration", "text", "speaker_id", "session_id", "content_hash")


@query(_MANIFEST + "select split, count(*) as samples from (select split from m where split = 'train' union all select split from m where split = 'val' union all select split from m where split = 'test') group by 1")
def manifest_union(spark, sf_dir):
    rows = manifest_rows(spark, sf_dir).select("split")
    parts = [rows.where(F.col("split") == s) for s in SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("split").agg(F.count("*").alias("samples"))


# Signal ----------------------------------------------------------------------------------

#: Embeddings are far quieter and shorter than audio; levels and lengths are scaled to them.
CLIP, FRAME, QUIET = 0.1, 8, -18.0
_SAMPLES = "(select vec_id, list_transform(embedding, lambda x: x::double) as s from embeddings)"
_RMS = "sqrt(list_reduce(list_transform({x}, lambda y: y * y), lambda a, b: a + b, 0.0::double) / len({x}))"


@query(f"select vec_id, list_max(list_transform(s, lambda x: abs(x))) as peak from {_SAMPLES}")
def peak_dbfs(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", signal.peak(F.col("embedding")).alias("peak"))


@query(f"select vec_id, {_RMS.format(x='s')} as rms, cast(floor(greatest(-120.0, 20 * log10({_RMS.format(x='s')})) * 10000) as bigint) as dbfs_e4 from {_SAMPLES}")
def rms_dbfs(spark, sf_dir):
    level = signal.rms(F.col("embedding"))
    return read(spark, sf_dir, "embeddings").select("vec_id", level.alias("rms"), F.floor(signal.dbfs(level) * 10000).cast("long").alias("dbfs_e4"))


@query(f"""
with x as (select vec_id, unnest(range(1, len(s) + 1)) as i, unnest(s) as v from {_SAMPLES}),
r as (select vec_id, i - row_number() over (partition by vec_id order by i) as island from x where abs(v) >= {CLIP}),
n as (select vec_id, count(*) as c from r group by vec_id, island having count(*) >= 3)
select e.vec_id, cast(coalesce(sum(c), 0) as bigint) as clipped from embeddings e left join n on n.vec_id = e.vec_id group by 1""")
def clip_runs(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", signal.clip_count(F.col("embedding"), CLIP, 3).alias("clipped"))


_MASK = f"""
with f as (select vec_id, s, greatest(1, len(s) // {FRAME}) as k from {_SAMPLES}),
g as (select vec_id, len(s) as n, list_transform(range(0, k), lambda i: s[i * {FRAME} + 1 : case when i = k - 1 then len(s) else (i + 1) * {FRAME} end]) as fs from f),
m as (select vec_id, n, list_transform(fs, lambda x: greatest(-120.0, 20 * log10({_RMS.format(x="x")})) < {QUIET}) as mask from g)
"""


@query(_MASK + "select vec_id, cast(len(mask) as bigint) as frames, cast(len(list_filter(mask, lambda x: x)) as bigint) as silent from m")
def silence_frames(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").withColumn("mask", signal.silent_mask(F.col("embedding"), QUIET, FRAME))
    return rows.select("vec_id", F.size("mask").cast("long").alias("frames"), F.size(F.filter("mask", lambda m: m)).cast("long").alias("silent"))


@query(_MASK + "select vec_id, cast(list_position(mask, false) - 1 as bigint) as first_frame, cast(len(mask) - list_position(list_reverse(mask), false) as bigint) as last_frame from m")
def active_region(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select("vec_id", signal.active_frames(signal.silent_mask(F.col("embedding"), QUIET, FRAME)).alias("a"))
    return rows.select("vec_id", F.col("a.first").cast("long").alias("first_frame"), F.col("a.last").cast("long").alias("last_frame"))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with flags: many line feeds for clipping, short words for low volume, length for duration."""
    rows = read(spark, sf_dir, "documents").withColumn("size", F.coalesce(F.length("text"), F.lit(0)).cast("double"))
    lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))).cast("double")
    blanks = (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).cast("double")
    return rows.select("doc_id", signal.quality_flags(F.greatest(F.lit(0.0), lines - 40), -blanks, F.col("size") / 100, -400.0, 0.5, 20.0).alias("flags"))


_FLAGS = r"""
with d as (select doc_id, coalesce(length(text), 0) / 100.0::double as dur, greatest(0, length(text) - length(replace(text, chr(10), '')) - 40) as clip, -(length(text) - length(replace(text, ' ', ''))) as vol from documents),
f as (select doc_id, list_filter([case when clip > 0 then 'clipping' end, case when vol < -400 then 'low_volume' end, case when dur < 0.5 or dur > 20 then 'duration_out_of_range' end], lambda x: x is not null) as flags from d)
"""


@query(_FLAGS + "select doc_id, array_to_string(flags, ',') as flags from f")
def quality_flags(spark, sf_dir):
    return flagged(spark, sf_dir).select("doc_id", F.array_join("flags", ",").alias("flags"))


@query(_FLAGS + "select count(*) as recordings, count(*) filter (where len(flags) = 0) as clean, count(*) filter (where len(flags) > 0) as flagged, count(*) filter (where list_contains(flags, 'clipping')) as clipping, count(*) filter (where list_contains(flags, 'low_volume')) as low_volume, count(*) filter (where list_contains(flags, 'duration_out_of_range')) as duration_out_of_range from f")
def flag_tally(spark, sf_dir):
    return quality.flag_tally(flagged(spark, sf_dir))


# Text ------------------------------------------------------------------------------------

_TIER_A = r"trim(regexp_replace(regexp_replace(regexp_replace(strip_accents(replace(lower(text), 'ß', 'ss')), '[''’ʼ′`]', '', 'g'), '[\p{M}\p{S}\p{P}]', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"select doc_id, {_TIER_A} as normalized from documents where text is not null")
def tier_a(spark, sf_dir):
    return read(spark, sf_dir, "documents").where("text is not null").select("doc_id", text.tier_a_column(F.col("text")).alias("normalized"))


@query()
def tier_b(spark, sf_dir):
    return read(spark, sf_dir, "benchmark").select("item_id", text.tier_b_column(F.coalesce("text", F.lit(""))).alias("normalized"))


@query(f"select item_id, cast(len(list_filter(string_split(n, ' '), lambda x: x <> '')) as bigint) as words, sha256(array_to_string(list_filter(string_split(n, ' '), lambda x: x <> ''), '|')) as tokens from (select item_id, {_TIER_A} as n from benchmark)")
def word_tokens(spark, sf_dir):
    tokens = text.word_tokens(F.col("n"))
    return read(spark, sf_dir, "benchmark").select("item_id", text.tier_a_column(F.coalesce("text", F.lit(""))).alias("n")).select("item_id", F.size(tokens).cast("long").alias("words"), F.sha2(F.array_join(tokens, "|").cast("binary"), 256).alias("tokens"))


@query("select item_id, cast(length(text) as bigint) as chars, sha256(array_to_string(string_split(text, ''), '|')) as tokens from benchmark")
def char_tokens(spark, sf_dir):
    tokens = text.char_tokens(F.col("text"))
    return read(spark, sf_dir, "benchmark").select("item_id", F.size(tokens).cast("long").alias("chars"), F.sha2(F.array_join(tokens, "|").cast("binary"), 256).alias("tokens"))


# Scoring ---------------------------------------------------------------------------------


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn and the assistant's next one, folded to ASCII; without an answer the hypothesis is null."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.regexp_replace(F.coalesce("text", F.lit("")), "[^ -~]", "?").alias("t"))
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("t").alias("reference"))
    told = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("t").alias("hypothesis"))
    return asked.join(told, ["conv_id", "turn"], "left").withColumns({"id": F.concat_ws("-", "conv_id", "turn"), "session": (F.col("conv_id") % 10).cast("string"), "device": F.when(F.col("turn") < 2, "first").otherwise("later"), "long_form": F.length("reference") > 480})


_PAIRS = """
with t as (select conv_id, turn, role, regexp_replace(coalesce(text, ''), '[^ -~]', '?', 'g') as t from conversations),
p as (select a.conv_id, a.turn, a.conv_id || '-' || a.turn as id, cast(a.conv_id % 10 as varchar) as session, case when a.turn < 2 then 'first' else 'later' end as device, length(a.t) > 480 as long_form, a.t as reference, b.t as hypothesis
  from t a left join t b on b.role = 'assistant' and b.conv_id = a.conv_id and b.turn = a.turn + 1 where a.role = 'user'),
e as (select *, cast(levenshtein(reference, hypothesis) as bigint) as errors, cast(length(reference) as bigint) as n, cast(reference <> hypothesis as bigint) as sentence_error from p where hypothesis is not null)
"""
_GROUPS = _PAIRS + """, g as (select case when grouping(session) = 0 then 'session' when grouping(device) = 0 then 'device' else 'all' end as axis,
  case when grouping(session) = 0 then session when grouping(device) = 0 then device end as value, count(*) as samples, cast(sum(errors) as bigint) as errors, cast(sum(n) as bigint) as n, cast(sum(sentence_error) as bigint) as sentence_errors
  from e group by grouping sets ((), (session), (device)))
"""


@query(_PAIRS + "select id, errors, n, sentence_error from e")
def alignment_total(spark, sf_dir):
    return scoring.character_errors(pairs(spark, sf_dir)).select("id", "errors", "n", "sentence_error")


@query(_PAIRS + "select id, errors, n from e")
def alignment_sdi_total(spark, sf_dir):
    """The aligner's substitutions, deletions and insertions, whose sum is the edit distance."""
    found = scoring.scored(pairs(spark, sf_dir).select("id", "reference", "hypothesis"), {"as is": str})
    return found.select("id", (F.col("char_s") + F.col("char_d") + F.col("char_i")).alias("errors"), F.col("char_n").alias("n"))


@query()
def alignment_sdi(spark, sf_dir):
    found = scoring.scored(pairs(spark, sf_dir).select("id", "reference", "hypothesis"))
    return found.select("id", "tier", *scoring.COUNTS, "sentence_error")


def character_groups(spark: SparkSession, sf_dir: str, axes: list[str]) -> DataFrame:
    """Breakdowns of the pairs by characters: all errors of a pair count as substitutions, for rates need their sum alone."""
    rows = scoring.character_errors(pairs(spark, sf_dir)).withColumns({"tier": F.lit("as is"), **{c: F.lit(0).cast("long") for c in scoring.COUNTS}, "char_s": F.col("errors"), "char_n": F.col("n")})
    return scoring.breakdowns(rows, {a: a for a in axes}).select("tier", "axis", "value", "samples", F.col("char_s").alias("errors"), F.col("char_n").alias("n"), "sentence_errors", "wer", "cer", "ser")


@query(_GROUPS + "select samples, errors, n, sentence_errors, errors / nullif(n, 0)::double as rate from g where axis = 'all'")
def pooled_rates(spark, sf_dir):
    return character_groups(spark, sf_dir, []).select("samples", "errors", "n", "sentence_errors", F.col("cer").alias("rate"))


@query(_GROUPS + "select axis, value, samples, errors, n, sentence_errors, errors / nullif(n, 0)::double as rate from g")
def breakdowns(spark, sf_dir):
    return character_groups(spark, sf_dir, ["session", "device"]).select("axis", "value", "samples", "errors", "n", "sentence_errors", F.col("cer").alias("rate"))


@query(_GROUPS + ", r as (select axis, errors / nullif(n, 0)::double as x from g where axis <> 'all') select axis, cast(floor(avg(x) * 1000000) as bigint) as mean_e6, cast(floor(stddev_pop(x) * 1000000) as bigint) as stddev_e6, cast(floor(median(x) * 1000000) as bigint) as median_e6, count(*) filter (where x is null) as excluded_groups from r group by axis")
def macro_stats(spark, sf_dir):
    millionths = lambda c: F.floor(F.col(c) * 1000000).cast("long").alias(f"{c}_e6")
    found = scoring.macro(character_groups(spark, sf_dir, ["session", "device"])).where("rate = 'cer'")
    return found.select("axis", millionths("mean"), millionths("stddev"), millionths("median"), "excluded_groups")


@query(_PAIRS + "select count(*) as in_scope, count(hypothesis) as scored, count(*) filter (where hypothesis is null) as failed, count(*) filter (where long_form) as long_form from p")
def n_of_m(spark, sf_dir):
    return scoring.counts(pairs(spark, sf_dir))


@query(_PAIRS + "select session, count(*) as in_scope, count(hypothesis) as scored from p where device = 'first' group by 1")
def scope_filter(spark, sf_dir):
    rows = scoring.in_scope(pairs(spark, sf_dir).withColumnRenamed("device", "split"), "first")
    return rows.groupBy("session").agg(F.count("*").alias("in_scope"), F.count("hypothesis").alias("scored"))


@query(_PAIRS + "select id, errors, n, row_number() over (order by errors / nullif(n, 0)::double desc nulls first, id) as place from e where errors > 0")
def worklist(spark, sf_dir):
    from pyspark.sql import Window

    rows = scoring.character_errors(pairs(spark, sf_dir)).where("errors > 0").select("id", "errors", "n", F.try_divide("errors", "n").alias("rate"))
    return rows.withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_first("rate"), "id")).cast("long")).select("id", "errors", "n", "place")


@query(_PAIRS + "select id, errors as errors_a, cast(levenshtein(reference, upper(hypothesis)) as bigint) as errors_b, cast(levenshtein(reference, upper(hypothesis)) as bigint) - errors as delta from e")
def paired_delta(spark, sf_dir):
    rows = pairs(spark, sf_dir).select("id", "reference", "hypothesis")
    a = scoring.character_errors(rows).select("id", F.col("errors").alias("errors_a"))
    b = scoring.character_errors(rows.withColumn("hypothesis", F.upper("hypothesis"))).select("id", F.col("errors").alias("errors_b"))
    return a.join(b, "id").withColumn("delta", F.col("errors_b") - F.col("errors_a"))


@query(_PAIRS + """, r as (select id, errors / nullif(n, 0)::double as cer_a, cast(levenshtein(reference, upper(hypothesis)) as bigint) / nullif(n, 0)::double as cer_b from e)
select id, cer_a, cer_b, cer_b - cer_a as cer_delta from r""")
def paired_rates(spark, sf_dir):
    rows = pairs(spark, sf_dir).select("id", "reference", "hypothesis")
    a, b = (scoring.scored(x, {"as is": str}) for x in (rows, rows.withColumn("hypothesis", F.upper("hypothesis"))))
    return scoring.paired_delta(a, b).select("id", "cer_a", "cer_b", "cer_delta")


@query(_PAIRS + "select id, case when turn < 6 then reference end as recorded, case when turn > 0 then case when turn % 4 = 0 then upper(reference) else reference end end as manifest from p where turn >= 6 or turn = 0 or (turn % 4 = 0 and upper(reference) <> reference)")
def reference_mismatch(spark, sf_dir):
    """A record without later turns against a manifest without first turns and with some references in capitals."""
    rows = pairs(spark, sf_dir)
    record = rows.where("turn < 6").select("id", "reference")
    manifest_of = rows.where("turn > 0").select("id", F.when(F.col("turn") % 4 == 0, F.upper("reference")).otherwise(F.col("reference")).alias("text"))
    return scoring.reference_mismatches(record, manifest_of).select("id", "recorded", "manifest")


@query(_PAIRS + "select 'a' as side, id, reference from p where turn >= 4 union all select 'b' as side, id, reference || '.' as reference from p where turn >= 4")
def masked_equality(spark, sf_dir):
    a = pairs(spark, sf_dir).select("id", "reference", "hypothesis", F.lit(None).cast("string").alias("error"), "turn")
    b = a.withColumn("reference", F.when(F.col("turn") >= 4, F.concat("reference", F.lit("."))).otherwise(F.col("reference"))).withColumn("hypothesis", F.lower("hypothesis"))
    return scoring.masked_difference(a, b).select("side", "id", "reference")


# Sinks and streams -----------------------------------------------------------------------


@query()
def canonical_jsonl(spark, sf_dir):
    """Each benchmark item as a line of canonical JSON."""

    def each(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array([json_line(row) for row in batch.to_pylist()], pa.string())], names=["item_id", "line"])

    return read(spark, sf_dir, "benchmark").select("item_id", "text").mapInArrow(each, "item_id long, line string")


@query("select date_trunc('hour', ts) as window_start, event_type, count(*) as events, cast(floor(sum(value) * 100 + 0.5) as bigint) as total_e2 from events group by 1, 2")
def stream_windowed(spark, sf_dir):
    """Tumbling hourly counts of the events as a stream that stops when all input is read."""
    from cadenza.streaming.pooled import finished

    stream = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events*.parquet")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    done = finished(windowed_counts(stream, "1 hour", "3650 days"), tempfile.mkdtemp(prefix="cadenza-stream-"))
    return done.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", F.floor(F.col("total") * 100 + 0.5).cast("long").alias("total_e2"))
