"""Secret scans in DataFrame functions only.

Known forms (assignments to secret names, access key ids, long hex runs) are
found by pattern. Besides, every long candidate string is scanned with a
sliding window: the window's Shannon entropy is kept by incremental counts (one
character leaves, one enters, and only their two terms of the sum change), and a
string is reported where some window exceeds its character class's threshold
and no allow-list pattern fits the string.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.frames import table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i)password|passwd|secret|token|api_?key"
ASSIGN_LEAST = 12
#: Runs are maximal, so a least length inside the pattern drops the same runs as a filter behind it.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}"

WINDOW = 20
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
#: Bits a character in some window of WINDOW characters, by class: (pattern of the whole string, more than).
#: Of random strings of WINDOW characters about 1 to 5 % stay below; a test holds this.
CLASSES = (
    (r"^[0-9a-fA-F]+$", 2.9),
    (r"^([a-z]+|[A-Z]+)$", 3.35),
    (r"^([a-z0-9]+|[A-Z0-9]+)$", 3.35),
    (r"^[A-Za-z]+$", 3.55),
    (r"^[A-Za-z0-9]+$", 3.6),
    (r"^([a-z0-9+/_-]+|[A-Z0-9+/_-]+)$", 3.87),
    (r"^[A-Za-z0-9+/_-]+$", 3.7),
)
#: The form of words (also in camel case) and numbers with separators. Random letters may have it too, but words have many letters of COMMON and few of SELDOM: the difference is this share of the length at least.
_WORD = r"([A-Z]+|[A-Z]?[a-z]+([A-Z][a-z]+)*|[0-9]+)?"
WORDS = rf"^{_WORD}([-_/+]{_WORD})*$"
COMMON, SELDOM, WORD_SHARE = "aeinorstAEINORST", "jkqvwxyzJKQVWXYZ", 0.3
#: Never reported: numbers with separators, UUIDs, documented examples.
ALLOWED = (r"^[0-9]*([-_/+][0-9]*)*$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^(AKIA[A-Z0-9]{9,12}EXAMPLE|[A-Za-z0-9+/]{30}EXAMPLEKEY)$")
#: What OP9_SQL knows: two classes and a wider allow-list. It agrees wherever no string of the finer classes occurs.
SQL_CLASSES = ((r"^[0-9a-fA-F]+$", 2.9), (r"^[A-Za-z0-9+/_-]+$", 3.87))
SQL_ALLOWED = (r"^[A-Za-z]*([-_/+]+[A-Za-z]*)*$", r"^[0-9]*([-_/+]+[0-9]*)*$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"EXAMPLE|example")

KINDS = ("assign", "access", "hex", "entropy")
_CHUNK = 256


def starts(gaps: Column, lengths: Column) -> Column:
    """Where each match starts: gaps[i] characters precede match i after the one before. Two levels of running sums, so the cost grows in proportion to the matches."""
    steps = F.transform(F.sequence(F.lit(0), F.size(lengths) - 1), lambda i: F.get(gaps, i).cast("long") + F.coalesce(F.get(lengths, i - 1), F.lit(0)).cast("long"))
    steps = F.when(F.size(lengths) > 0, steps).otherwise(F.expr("cast(array() as array<bigint>)"))
    zero = F.lit(0).cast("long")
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(steps) - 1) / _CHUNK).cast("int"))), lambda k: F.slice(steps, k * _CHUNK + 1, F.lit(_CHUNK)))
    empty = F.expr("cast(array() as array<bigint>)")

    def run(base: Column, part: Column) -> Column:
        return F.aggregate(part, F.struct(base.alias("s"), empty.alias("out")), lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["out"], F.array(acc["s"] + x)).alias("out")), lambda acc: acc["out"])

    return F.flatten(F.transform(parts, lambda part, k: run(total(F.transform(F.slice(parts, F.lit(1), k), total)), part)))


def _found(df: DataFrame, kind: str, pattern: str, hint: Column, group: int | None = None) -> DataFrame:
    """Adds ``at_<kind>``: array of (start, text, group) of all matches."""
    nothing = F.expr("cast(array() as array<string>)")
    has = f"has_{kind}"
    df = df.withColumn(has, hint)
    df = df.withColumn(f"m_{kind}", F.when(F.col(has), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(nothing))
    if group:
        df = df.withColumn(f"g_{kind}", F.when(F.col(has), F.regexp_extract_all("text", F.lit(pattern), F.lit(group))).otherwise(nothing))
    df = df.withColumn(f"p_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split("text", pattern, -1)).otherwise(nothing))
    df = df.withColumn(f"s_{kind}", starts(F.transform(f"p_{kind}", F.length), F.transform(f"m_{kind}", F.length)))
    grouped = F.col(f"g_{kind}") if group else F.col(f"m_{kind}")
    return df.withColumn(f"at_{kind}", F.zip_with(F.arrays_zip(F.col(f"s_{kind}").alias("start"), F.col(f"m_{kind}").alias("found")), grouped, lambda a, g: F.struct(a["start"].alias("start"), a["found"].alias("found"), g.alias("part"))))


#: c * log2(c) for the counts of a window, in units of 2**-40, so that running sums are exact.
_UNIT = 1 << 40
_TERMS = [0] + [round(c * math.log2(c) * _UNIT) for c in range(1, WINDOW + 1)]
#: Counts are packed: _BITS bits each, _PACKED to a 64-bit word, by code from _LOW ('+') to 'z'.
_BITS, _PACKED, _LOW = 5, 12, 43
_CELLS = -(-(123 - _LOW) // _PACKED)
#: Codes of the window's places before its first character: the window is not whole, or just became so.
_EARLY, _NONE = -2, -1


def window_entropy(s: Column) -> Column:
    """The largest Shannon entropy (bits a character) of any WINDOW characters in a row of ``s`` (at least WINDOW characters of CANDIDATE long).

    One fold over the characters: each step adds one to a count and takes one from
    another, and changes only their two terms of the sum. Time and memory grow in proportion to ``s``.
    """
    terms, none = F.lit(_TERMS), F.lit(0).cast("long")
    names = [f"c{k}" for k in range(_CELLS)]

    def count(acc: Column, code: Column) -> Column:
        word = F.get(F.array(*[acc[n] for n in names]), F.floor(code / _PACKED).cast("int"))
        return F.call_function("shiftright", word, (code % _PACKED) * _BITS).bitwiseAND((1 << _BITS) - 1).cast("int")

    def moved(acc: Column, code: Column, by: int) -> list[Column]:
        step = F.call_function("shiftleft", F.lit(1).cast("long"), (code % _PACKED) * _BITS) * by
        return [(acc[n] + F.when(F.floor(code / _PACKED) == k, step).otherwise(none)).alias(n) for k, n in enumerate(names)]

    def slide(acc: Column, x: Column) -> Column:
        n, gone, code = count(acc, x["old"]), x["old"] >= 0, x["new"]
        less = F.when(gone, acc["sum"] - F.get(terms, n) + F.get(terms, n - 1)).otherwise(acc["sum"])
        b = count(acc, code) - (gone & (x["old"] == code)).cast("int")
        total = less + F.get(terms, b + 1) - F.get(terms, b)
        down = [F.when(gone, c).otherwise(acc[k]).alias(k) for c, k in zip(moved(acc, x["old"], -1), names, strict=True)]
        half = F.struct(*down)
        best = F.when(x["old"] == _EARLY, acc["least"]).otherwise(F.least(acc["least"], total))
        return F.struct(total.alias("sum"), best.alias("least"), *moved(half, code, 1))

    codes = F.transform(F.split(s, "", -1), lambda c: F.ascii(c) - _LOW)
    codes = F.filter(codes, lambda c: c >= 0)
    before = F.lit([_EARLY] * (WINDOW - 1) + [_NONE])

    def whole(codes: Column) -> Column:
        steps = F.zip_with(codes, F.slice(F.concat(before, codes), F.lit(1), F.size(codes)), lambda new, old: F.struct(new.alias("new"), old.alias("old")))
        start = F.struct(none.alias("sum"), F.lit(1 << 62).alias("least"), *[none.alias(n) for n in names])
        return F.aggregate(steps, start, slide, lambda acc: acc["least"])

    # The codes are bound once, as the element of an array.
    least = F.get(F.transform(F.array(codes), whole), F.lit(0))
    return F.lit(math.log2(WINDOW)) - least / float(WINDOW * _UNIT)


def is_random(s: Column) -> Column:
    """Whether a candidate string exceeds its class's threshold and is not allowed."""
    excess = F.length(F.translate(s, SELDOM, "")) - F.length(F.translate(s, COMMON, ""))
    allowed = s.rlike(WORDS) & (excess >= WORD_SHARE * F.length(s))
    for pattern in ALLOWED:
        allowed = allowed | s.rlike(pattern)
    over = None
    for pattern, least in CLASSES:
        over = F.when(s.rlike(pattern), F.lit(least)) if over is None else over.when(s.rlike(pattern), F.lit(least))
    return F.when(allowed, F.lit(False)).otherwise(window_entropy(s) > over.otherwise(F.lit(99.0)))


def secret_spans(docs: DataFrame) -> DataFrame:
    """Adds ``spans`` to the rows of ``docs``: array of (start, rank, kind, end) in code points, end exclusive, by start and then kind.

    Null texts count as empty and have no spans; repeated rows stay; all other
    columns are kept under their names (``spans`` is replaced).
    """
    names = [c for c in docs.columns if c != "spans"]
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    df = _found(df, "assign", ASSIGN, F.col("text").rlike(ASSIGN_HINT), 2)
    df = _found(df, "access", ACCESS, F.contains("text", F.lit("AKIA")))
    df = _found(df, "hex", HEX, F.col("text").rlike(HEX))
    df = _found(df, "entropy", CANDIDATE, F.col("text").rlike(CANDIDATE))
    keep = {"assign": lambda x: F.length(x["part"]) >= ASSIGN_LEAST, "entropy": lambda x: is_random(x["found"])}

    def spans_of(rank: int, kind: str) -> Column:
        at = F.filter(f"at_{kind}", keep[kind]) if kind in keep else F.col(f"at_{kind}")
        return F.transform(at, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["found"])).alias("end")))

    spans = [spans_of(rank, kind) for rank, kind in enumerate(KINDS)]
    return df.select("row", F.array_sort(F.concat(*spans)).alias("spans")).select("row.*", "spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark`` (overlapping spans by one) and ``n_chars`` set anew."""
    found = secret_spans(docs)
    n = F.length("text").cast("long")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substr(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        more = F.when(fresh, F.concat(acc["out"], F.array(gap, F.lit(mark)))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), more.alias("out"))

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    clean = F.aggregate("spans", zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(F.col("text"), (acc["at"] + 1).cast("int"), F.greatest(F.lit(0), n - acc["at"]).cast("int"))))
    found = found.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _kind_sql(kind: str, rank: int, pattern: str, keep: str) -> str:
    return f"""
select doc_id, unnest(list_filter(list_transform(range(1, len(ms) + 1), lambda i: {{'start': cast(list_sum(list_transform(gs[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda m: length(m))), 0) as bigint), 'found': ms[i], 'part': ps[i]}}), lambda x: {keep})) as x, {rank} as rank, '{kind}' as kind
from (select doc_id, regexp_extract_all(text, '{pattern}') as ms, regexp_extract_all(text, '{pattern}', {2 if kind == "assign" else 0}) as ps, string_split_regex(text, '{pattern}') as gs from d)"""




def _op9_sql() -> str:
    q = lambda p: p.replace("'", "''").replace("(?<![0-9a-f])", "").replace("(?<![A-Za-z0-9+/_-])", "")  # noqa: E731  runs are maximal in RE2 as well
    allowed = " or ".join(f"regexp_matches(x.found, '{q(p)}')" for p in SQL_ALLOWED)
    counts = "list_transform(list_distinct(string_split(x.found[k:k + 19], '')), lambda c: 20 - length(replace(x.found[k:k + 19], c, '')))"
    least = f"list_min(list_transform(range(1, length(x.found) - 18), lambda k: list_sum(list_transform({counts}, lambda c: c * log2(c)))))"
    over = f"log2(20) - {least} / 20 > case when regexp_matches(x.found, '{SQL_CLASSES[0][0]}') then {SQL_CLASSES[0][1]} else {SQL_CLASSES[1][1]} end"
    parts = [_kind_sql("assign", 0, q(ASSIGN), "length(x.part) >= 12"), _kind_sql("access", 1, q(ACCESS), "true"), _kind_sql("hex", 2, q(HEX), "true"), _kind_sql("entropy", 3, q(CANDIDATE), f"not ({allowed}) and {over}")]
    return f"""with d as (select doc_id, coalesce(text, '') as text from documents), s as ({" union all ".join(parts)}
), r as (select doc_id, rank, x.start as start, kind || ':' || x.start || ':' || (x.start + length(x.found)) as span from s)
select d.doc_id, cast(count(*) filter (where rank = 0) as bigint) as n_assign, cast(count(*) filter (where rank = 1) as bigint) as n_access, cast(count(*) filter (where rank = 2) as bigint) as n_hex,
  sha256(coalesce(string_agg(span, ',' order by start, rank) filter (where rank < 3), '')) as base_sha256, coalesce(string_agg(span, ',' order by start, rank), '') as spans
from d left join r on r.doc_id = d.doc_id group by d.doc_id"""


OP9_SQL = _op9_sql()
