"""Secret scans with multipart credential linking, in DataFrame operations.

Base spans: assignments of secrets, access keys and long hexadecimal runs.
Weak candidates -- user names and client ids, passwords under other names and
bearer values, endpoints -- say little alone. They are reported only where
complementary parts come together: an interval join pairs parts whose spans
are within ``SCOPE`` code points of each other. A secret needs an identifier
or an endpoint near it; an identifier or an endpoint needs a secret. Base
spans count as parts (access keys identify; assignments and hexadecimal runs
are secrets) and are reported anyway.

The join meets on (row, cell of ``SCOPE`` code points): what one key holds is
bounded by the scope's length, however many spans a text has, and only spans
are shuffled, never texts.

Positions are code points, end exclusive. Matches are found by marking them in
the text with a separator and summing the parts' lengths; a separator already
in a text is first replaced by another character that no pattern matches.

Defined results: null text is empty; null ids and repeated rows are scanned
like any other row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

SCOPE = 200
#: Kinds in their order, with their patterns (Java and RE2 read
#: them alike) and their roles. The first three are the base kinds.
ASSIGN = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
          "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
PATTERNS = {
    "assign": ASSIGN,
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "ident": ("\\b(?:[Uu][Ss][Ee][Rr](?:[Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]"
              "|[Aa][Cc][Cc][Oo][Uu][Nn][Tt])[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9_.@+-]{3,}"),
    "pass": ("\\b(?:[Pp][Ww][Dd]|[Pp][Aa][Ss][Ss](?:[Pp][Hh][Rr][Aa][Ss][Ee])?|[Pp][Rr][Ii][Vv][Aa][Tt][Ee]_?[Kk][Ee][Yy]"
             "|[Cc][Rr][Ee][Dd][Ee][Nn][Tt][Ii][Aa][Ll])[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9+/_.=!@#$%^&*-]{6,}"
             "|\\bBearer\\x20+[A-Za-z0-9._-]{16,}"),
    "endpoint": ("\\b(?:https?|ftp|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{4,}"
                 "|\\b(?:[Hh][Oo][Ss][Tt]|[Ee][Nn][Dd][Pp][Oo][Ii][Nn][Tt])[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9._:/-]{4,}"),
}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret", "ident": "identifier", "pass": "secret",
         "endpoint": "endpoint"}
#: An assignment's value has at least so many characters.
LEAST_VALUE = 6
MARK, OTHER = "\ue000", "\ue001"
_SPANS = "array<struct<start:long,end:long>>"


def spans_of(text: Column, pattern: str, keep=None) -> Column:
    """Spans of the leftmost non-overlapping matches of ``pattern`` in
    ``text`` (without ``MARK``); ``keep`` filters the matched strings."""
    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{MARK}$0{MARK}"))
    parts = F.split(marked, MARK, -1)
    numbered = F.transform(parts, lambda x, i: F.struct(x.alias("s"), (i % 2 == 1).alias("hit")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(acc, part):
        end = acc["at"] + F.char_length(part["s"])
        hit = part["hit"] & keep(part["s"]) if keep else part["hit"]
        span = F.struct(acc["at"].alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(hit, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(numbered, start, step, lambda acc: acc["out"])
    return F.when(F.contains(marked, F.lit(MARK)), found).otherwise(F.array().cast(_SPANS))


def extract(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one array of spans per kind: all base spans and all weak
    candidates. Identifiers and endpoints are looked for only beside a secret."""
    clean = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(OTHER))
    value = lambda s: F.char_length(F.regexp_extract(s, ASSIGN, 2)) >= LEAST_VALUE
    first = [spans_of(clean, PATTERNS[k], value if k == "assign" else None).alias(k)
             for k in ("assign", "access", "hex", "pass")]
    out = docs.select("*", *first)
    any_secret = F.size("assign") + F.size("hex") + F.size("pass") > 0
    none = F.array().cast(_SPANS)
    return out.select("*", *(F.when(any_secret, spans_of(clean, PATTERNS[k])).otherwise(none).alias(k)
                             for k in ("ident", "endpoint")))


def _parts(found: DataFrame, kinds, *keys: str) -> DataFrame:
    one = lambda k: F.transform(F.col(k), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(KINDS.index(k)).alias("kind")))
    return found.select(*keys, F.explode(F.concat(*map(one, kinds))).alias("p")).select(*keys, "p.*")


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*(F.lit(ROLES[k]) for k in KINDS)), kind + 1)


def linked(found: DataFrame, key: str) -> DataFrame:
    """Weak spans (``key, start, end, kind``) of ``found`` that have a
    complementary part within ``SCOPE``."""
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / SCOPE), F.floor(b / SCOPE)))
    weak = _parts(found, KINDS[3:], key)
    weak = weak.select("*", cells(F.greatest(F.col("start") - SCOPE, F.lit(0)), F.col("end") + SCOPE).alias("cell"))
    other = _parts(found, KINDS, key).select(
        F.col(key).alias("k"), F.col("start").alias("s"), F.col("end").alias("e"), _role(F.col("kind")).alias("other"),
        cells(F.col("start"), F.col("end")).alias("c"))
    role = _role(F.col("kind"))
    near = (F.col("s") <= F.col("end") + SCOPE) & (F.col("e") >= F.col("start") - SCOPE)
    complement = (role != F.col("other")) & ((role == "secret") | (F.col("other") == "secret"))
    return (weak.join(other, (weak[key] == other["k"]) & (weak["cell"] == other["c"]) & near & complement, "left_semi")
            .drop("cell").distinct())


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    name = F.array(*map(F.lit, KINDS))
    by = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"),
                                                             x["end"].alias("end"))))
    return F.array_join(F.transform(by, lambda x: F.concat_ws(
        ":", F.element_at(name, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """For every row of ``docs``: the columns ``keep``, the base counts,
    ``base`` and ``all``: arrays of spans (start, end, kind number)."""
    found = extract(docs.select(*keep, F.col(text_col).alias("__text")), "__text").drop("__text")
    found = materialize(found.withColumn("__row", F.monotonically_increasing_id()), "op9-spans")
    more = linked(found, "__row").groupBy("__row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("weak"))
    typed = lambda k: F.transform(F.col(k), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(KINDS.index(k)).alias("kind")))
    base = F.concat(*map(typed, BASE))
    none = F.array().cast("array<struct<start:long,end:long,kind:int>>")
    return (found.join(more, "__row", "left")
            .select(*keep, *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE), base.alias("base"),
                    F.concat(base, F.coalesce(F.col("weak"), none)).alias("all")))


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts, ``base_sha256`` and ``spans`` of every row."""
    return scan(docs, "doc_id").select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("all")).alias("spans"))


def mask(text: Column, spans: Column, with_: str = "[SECRET]") -> Column:
    """``text`` with each run of overlapping spans replaced."""
    by = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    step = lambda acc, x: F.struct(
        F.greatest(acc["at"], x["end"]).alias("at"),
        F.when((x["start"] < acc["at"]) & (acc["at"] > 0), acc["out"])
        .otherwise(F.concat(acc["out"], piece(acc["at"], x["start"]), F.lit(with_))).alias("out"))
    end = lambda acc: F.concat(acc["out"], piece(acc["at"], F.char_length(text).cast("long")))
    return F.aggregate(by, start, step, end)


def masked(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every reported span of the text masked; a length column
    follows the new text. Only rows with weak candidates meet the join."""
    found = extract(docs.withColumn("__text", F.col(text_col)), "__text").drop("__text")
    found = materialize(found.withColumn("__row", F.monotonically_increasing_id()), "op9-texts")
    typed = lambda k: F.transform(F.col(k), lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.lit(KINDS.index(k)).alias("kind")))
    base = F.concat(*map(typed, BASE))
    weak = F.size("ident") + F.size("pass") + F.size("endpoint") > 0
    more = linked(found.where(weak), "__row").groupBy("__row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("weak"))
    some = found.where(weak).join(more, "__row", "left")
    none = F.array().cast("array<struct<start:long,end:long,kind:int>>")
    both = (found.where(~weak).select(*docs.columns, base.alias("__all"))
            .unionByName(some.select(*docs.columns, F.concat(base, F.coalesce(F.col("weak"), none)).alias("__all"))))
    hit = F.size("__all") > 0
    text = F.when(hit, mask(F.col(text_col), F.col("__all"))).otherwise(F.col(text_col))
    out = both.withColumn(text_col, text)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(hit, F.char_length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(*docs.columns)


def oracle_sql() -> str:
    """The query as DuckDB SQL: the same marking, join and digests."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    def kind(i, k):
        keep = (f" AND length(regexp_extract(parts[i], {quote(ASSIGN)}, 2)) >= {LEAST_VALUE}" if k == "assign" else "")
        return (f"SELECT doc_id, {i} AS kind, coalesce(list_sum(list_transform(parts[1:i - 1], lambda s: length(s))), 0)::BIGINT AS s,"
                f" length(parts[i]) AS n FROM (SELECT doc_id, parts, unnest(range(2, len(parts) + 1, 2)) AS i FROM"
                f" (SELECT doc_id, string_split(regexp_replace(x, {quote(PATTERNS[k])}, '{MARK}\\0{MARK}', 'g'), '{MARK}')"
                f" AS parts FROM t)) WHERE TRUE{keep}")
    roles = " ".join(f"WHEN {i} THEN '{ROLES[k]}'" for i, k in enumerate(KINDS))
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))
    listed = "string_agg(concat(CASE kind {n} END, ':', s, ':', e), ',' ORDER BY s, kind, e)".format(n=names)
    return f"""
WITH t AS (SELECT doc_id, replace(coalesce(text, ''), '{MARK}', '{OTHER}') AS x FROM documents),
raw AS ({" UNION ALL ".join(kind(i, k) for i, k in enumerate(KINDS))}),
part AS (SELECT doc_id, kind, s, s + n AS e, CASE kind {roles} END AS role FROM raw),
shown AS (SELECT * FROM part a WHERE kind < 3 OR EXISTS (
  SELECT 1 FROM part b WHERE b.doc_id = a.doc_id AND b.s <= a.e + {SCOPE} AND b.e >= a.s - {SCOPE}
  AND a.role <> b.role AND (a.role = 'secret' OR b.role = 'secret'))),
base AS (SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
  count(*) FILTER (WHERE kind = 2) AS n_hex, {listed} AS spans FROM part WHERE kind < 3 GROUP BY doc_id),
every AS (SELECT doc_id, {listed} AS spans FROM shown GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base.spans, '')) AS base_sha256, coalesce(every.spans, '') AS spans
FROM documents LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)"""
