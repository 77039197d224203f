"""Personal data by information-theoretic sanitisation, in DataFrame operations.

Base spans: e-mail addresses, IP addresses, card numbers (Luhn) and phone
numbers. Each value found is a protected entity. Words near an entity may give
it away although they are no personal data by form: the corpus says how
strongly. With n(t), n(e) and n(t, e) the documents (of N) that hold the word
t, the entity e, or t within ``SCOPE`` code points of e,

    PMI(t; e) / IC(e) = 1 - log(n(t) / n(t, e)) / log(N / n(e))

is the share of e's information that t discloses: 1 if t is met only beside e.
A word that discloses over ``GENERALISED`` = 3/4 of an entity is a span of kind
``term`` beside each mention of it: generalised, or removed if it discloses all. One
text says nothing of a word, nor do its copies: two different texts must show
the word beside the entity. Documents without an entity have no spans.

Words are tokens between white space that hold letters, no digit and no ``@``;
punctuation around the letters is not part of them, and so no word overlaps a
base span. A-Z count as lower case. What is beside an entity reaches to the
next mention of its kind at most, and to words that lie in scope whole.

Every mention brings a bounded number of words, so pairs grow with the
mentions. Counts are partial aggregates; a second pass over the texts counts
all documents' words and writes none of them. Words meet their counts salted by
entity, so that a word beside a third of all entities is dealt to many tasks.

Positions are code points, end exclusive, found by marking matches in the text
and adding up the lengths between the marks, per row and kind; a separator
already in a text is first replaced by another character that no pattern
matches. Patterns are possessive and begin where a run begins, so that their
time is linear in any text.

Defined results: null text is empty; null ids and repeated rows are scanned
like any other row; extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .secret_scan import MARK, OTHER

SCOPE = 80
#: Kinds in their order and their patterns.
PATTERNS = {
    "email": "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+",
    "ip": "[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+",
    "card": "[0-9](?:[\\x20-]?[0-9])+",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: The same matches, without trying again inside a run that has failed.
LINEAR = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?+[0-9])++",
    "phone": PATTERNS["phone"],
}
#: What a text with a match of the kind holds at least.
HOLDS = {"email": "@", "phone": "\\+[0-9]", "ip": "[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]",
         "card": "[0-9](?:[\\x20-]?[0-9]){13}"}
BASE = list(PATTERNS)
KINDS = [*BASE, "term"]
TERM = BASE.index("phone") + 1
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)"
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
_GAP = "\\x20\\x09-\\x0D"
_AROUND = f"[^\\p{{L}}\\p{{N}}@{_GAP}]*+"
WORD = f"(?<=[{_GAP}])({_AROUND})(\\p{{L}}++)({_AROUND})(?=[{_GAP}])"
#: The share 1 - 1 / ROOT of an entity's information that a word may disclose.
ROOT = 4
GENERALISED = 1 - 1 / ROOT
SALTS = 16
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "array<struct<kind:int,pos:int,n:bigint,value:string,head:string,tail:string>>"


def lower(text) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _padded(text_col: str) -> Column:
    clean = F.replace(F.coalesce(F.col(text_col), F.lit("")), F.lit(MARK), F.lit(OTHER))
    return F.concat(F.lit(" "), clean, F.lit(" "))


def _parts(text: Column, kind: str) -> Column:
    """The text cut at the matches of a kind: matches at odd places, between
    them what lies there, of which only both ends are kept."""
    marked = F.split(F.regexp_replace(text, F.lit(LINEAR[kind]), F.lit(f"{MARK}$0{MARK}")), MARK, -1)

    def part(x, i):
        hit = i % 2 == 1
        return F.struct(F.lit(BASE.index(kind)).alias("kind"), i.cast("int").alias("pos"),
                        F.char_length(x).cast("long").alias("n"), F.when(hit, x).alias("value"),
                        F.when(~hit, F.left(x, F.lit(SCOPE))).alias("head"),
                        F.when(~hit, F.right(x, F.lit(SCOPE))).alias("tail"))

    return F.when(F.rlike(text, F.lit(HOLDS[kind])), F.transform(marked, part)).otherwise(F.array().cast(_PARTS))


def _luhn(digits: Column) -> Column:
    from_right = F.filter(F.split(F.reverse(digits), ""), lambda x: x != "")

    def value(x, i):
        d = x.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(from_right, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    n = F.length(digits)
    octets = value.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
    return (F.when(kind == BASE.index("ip"), octets)
            .when(kind == BASE.index("card"), F.when(n.between(*CARD_DIGITS), _luhn(digits)).otherwise(False))
            .when(kind == BASE.index("phone"), n.between(*PHONE_DIGITS)).otherwise(True))


def _entity(kind: Column, value: Column) -> Column:
    """One name for the ways in which a value is written."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return (F.when(kind == BASE.index("email"), lower(value)).when(kind == BASE.index("ip"), value)
            .otherwise(digits))


def read(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """One pass over the texts, written: the columns ``keep``, a row number,
    the text's digest and its cuts at the matches."""
    src = docs.select(*keep, _padded(text_col).alias("__text"))
    text = F.col("__text")
    return materialize(src.select(*keep, F.monotonically_increasing_id().alias("__row"), F.sha2(text, 256).alias("__digest"),
                                  F.concat(*(_parts(text, k) for k in BASE)).alias("__parts")), "op12-read")


def document_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``term, n_term``: documents that hold each word."""
    words = F.array_distinct(F.regexp_extract_all(lower(_padded(text_col)), F.lit(WORD), F.lit(2)))
    return docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))


def mentions(found: DataFrame) -> DataFrame:
    """Valid base matches: row, digest, kind number, start, end, entity and
    what lies in scope on the left and the right."""
    parts = found.select("__row", "__digest", F.explode("__parts").alias("p")).select("__row", "__digest", "p.*")
    order = Window.partitionBy("__row", "kind").orderBy("pos")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = parts.select("__row", "__digest", "kind", "pos", "value", (before - 1).alias("start"), (before - 1 + F.col("n")).alias("end"),
                       F.lag("tail").over(order).alias("left"), F.lead("head").over(order).alias("right"))
    kind, value = F.col("kind"), F.col("value")
    return materialize(cut.where((F.col("pos") % 2 == 1) & _valid(kind, value))
                       .select("__row", "__digest", "kind", "start", "end", _entity(kind, value).alias("entity"), "left", "right"),
                       "op12-mentions")


def _words_at(snippet: Column, at: Column) -> Column:
    """Words of a snippet (of at most ``SCOPE`` code points) whose text begins
    at ``at``, with their spans."""
    parts = F.split(F.regexp_replace(snippet, F.lit(WORD), F.lit(f"$1{MARK}$2{MARK}$3")), MARK, -1)
    cut = F.transform(parts, lambda x, i: F.struct(x.alias("s"), (i % 2 == 1).alias("hit")))
    kind = "array<struct<term:string,start:bigint,end:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("out"))

    def step(acc, part):
        end = acc["at"] + F.char_length(part["s"])
        one = F.struct(lower(part["s"]).alias("term"), acc["at"].alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(part["hit"], F.array_append(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    words = F.aggregate(cut, start, step, lambda acc: acc["out"])
    return F.transform(words, lambda w: F.struct(w["term"].alias("term"), (w["start"] + at).alias("start"),
                                                 (w["end"] + at).alias("end")))


def contexts(found: DataFrame) -> DataFrame:
    """The words in scope of each mention, with their spans."""
    both = F.concat(_words_at(F.col("left"), F.col("start") - F.char_length("left")), _words_at(F.col("right"), F.col("end")))
    return found.select("__row", "__digest", "kind", "entity", F.explode(both).alias("w")).select(
        "__row", "__digest", "kind", "entity", "w.*")


def disclosures(n_term: DataFrame, read_: DataFrame, found: DataFrame, near: DataFrame) -> DataFrame:
    """Words that disclose too much: ``kind, entity, term``, the counts, the
    share disclosed and whether the word is to be removed or generalised.
    ``n_term``: :func:`document_counts`."""
    total = read_.agg(F.count(F.lit(1)).alias("total"))  # one row
    of_entity = found.groupBy("kind", "entity").agg(F.count_distinct("__row").alias("n_entity"))
    once = near.select("kind", "entity", "term", "__row", "__digest").distinct()
    pairs = (once.groupBy("kind", "entity", "term").agg(F.count(F.lit(1)).alias("n_both"), F.min("__digest").alias("one"),
                                                        F.max("__digest").alias("other"))
             .where("one < other").drop("one", "other"))
    pairs = materialize(pairs.join(of_entity, ["kind", "entity"]), "op12-pairs")
    # A word's count goes to every salt; its pairs, dealt by entity, meet one.
    # (Not a semi-join: Spark moves those below the aggregate, and then every
    # word of every text is shuffled instead of the words' partial counts.)
    counts = (n_term.join(pairs.select("term").distinct(), "term")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("kind", "entity"), F.lit(SALTS)).cast("int"))
    met = salted.join(counts, ["term", "salt"]).join(F.broadcast(total))
    t, e, te, n = (F.col(c).cast("double") for c in ("n_term", "n_entity", "n_both", "total"))
    power = lambda x: x * x * x * x  # noqa: E731  (ROOT factors)
    share = F.when(F.col("n_term") == F.col("n_both"), 1.0).otherwise(1 - F.log(t / te) / F.log(n / e))
    return met.where(power(t) * e <= n * power(te)).select(
        "kind", "entity", "term", "n_term", "n_entity", "n_both", share.alias("disclosed"),
        F.when(F.col("n_term") == F.col("n_both"), "remove").otherwise("generalise").alias("action"))


def _term_spans(near: DataFrame, shown: DataFrame) -> DataFrame:
    """Words in scope that disclose: row, span and the stronger action."""
    return (near.join(shown.select("kind", "entity", "term", "action"), ["kind", "entity", "term"])
            .groupBy("__row", "start", "end").agg(F.max("action").alias("action")))


def scan(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """For every row of ``docs``: the columns ``keep``, ``base`` and ``all``:
    sorted arrays of spans (start, kind number, end, action)."""
    read_ = read(docs, *keep, text_col=text_col)
    found = mentions(read_)
    near = contexts(found)
    shown = materialize(disclosures(document_counts(docs, text_col), read_, found, near), "op12-terms")
    every = (found.select("__row", "start", "end", "kind", F.lit(None).cast("string").alias("action"))
             .unionByName(_term_spans(near, shown).withColumn("kind", F.lit(TERM))))
    spans = every.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "action"))).alias("all"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,action:string>>")
    out = read_.select(*keep, "__row").join(spans, "__row", "left").select(*keep, F.coalesce("all", none).alias("all"))
    return out.withColumn("base", F.filter("all", lambda x: x["kind"] < TERM))


def _joined(spans: str) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(name, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, base counts, ``base_sha256`` and ``spans`` of every row."""
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == BASE.index(k))).cast("long").alias(f"n_{k}")
    return scan(docs, "doc_id").select("doc_id", *map(count, BASE), F.sha2(_joined("base"), 256).alias("base_sha256"),
                                       _joined("all").alias("spans"))


def sanitised(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every base span replaced by its kind, words that disclose
    all removed and those that disclose too much generalised to their form: a
    name (capital first) or a word. Overlapping base spans are one, of the
    first's kind. Cutting takes time in spans times length of a text."""
    spans = scan(docs.withColumn("__all", F.struct(*docs.columns)), "__all", text_col=text_col)
    text = F.coalesce(F.col(f"__all.{text_col}"), F.lit(""))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    piece = lambda a, b: F.substring(text, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))
    label = F.array(*(F.lit(LABELS[k]) for k in BASE), F.lit(""))

    def step(acc, x):
        first = piece(x["start"], x["start"] + 1)
        form = F.when(x["action"] == "remove", "").when(F.upper(first) == first, "[NAME]").otherwise("[WORD]")
        made = F.when(x["kind"] == TERM, form).otherwise(F.element_at(label, x["kind"] + 1))
        inside = x["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(
            F.concat(acc["out"], F.array(piece(acc["at"], x["start"]), made))).alias("out"))

    done = F.aggregate("all", start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text))))
    clean = F.when(F.size("all") > 0, done).otherwise(F.col(f"__all.{text_col}"))
    return spans.select(*(clean.alias(c) if c == text_col else F.col(f"__all.`{c}`").alias(c) for c in docs.columns))


def oracle_sql() -> str:
    """The query as DuckDB SQL: tokens by splitting, all spans by plain patterns."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    gap, around = "[\\x20\\x09-\\x0D]", "[^\\p{L}\\p{N}@]*"
    digits = "regexp_replace(v, '[^0-9]', '', 'g')"
    luhn = ("list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 0 THEN CAST(d[i] AS INT)"
            " WHEN CAST(d[i] AS INT) > 4 THEN 2 * CAST(d[i] AS INT) - 9 ELSE 2 * CAST(d[i] AS INT) END)) % 10 = 0")

    def kind(i, k):
        return (f"SELECT r, x, {i} AS kind, i, parts, parts[i] AS v, coalesce(list_sum(list_transform(parts[1:i - 1], lambda s: length(s))), 0)"
                f"::BIGINT - 1 AS s FROM (SELECT r, x, parts, unnest(range(2, len(parts) + 1, 2)) AS i FROM (SELECT r, x,"
                f" string_split(regexp_replace(x, {quote(PATTERNS[k])}, '{MARK}\\0{MARK}', 'g'), '{MARK}') AS parts FROM t))")

    words = lambda snippet, at: (
        f"SELECT r, x, kind, e, regexp_extract(w, '^({around})(\\p{{L}}+){around}$', 2) AS term, p"
        f" + length(regexp_extract(w, '^({around})(\\p{{L}}+){around}$', 1)) AS s FROM (SELECT r, x, kind, e, tokens[j] AS w, {at}"
        f" + (j - 1 + list_sum(list_transform(tokens[1:j - 1], lambda y: length(y))))::BIGINT AS p FROM (SELECT *, unnest(range(2,"
        f" len(tokens))) AS j FROM (SELECT *, regexp_split_to_array({snippet}, '{gap}') AS tokens FROM ent)))"
        f" WHERE regexp_full_match(w, '{around}\\p{{L}}+{around}')")
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS))
    listed = f"string_agg(concat(CASE kind {names} END, ':', s, ':', en), ',' ORDER BY s, kind, en)"
    az = f"'{_UPPER}', '{_LOWER}'"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, concat(' ', replace(coalesce(text, ''), '{MARK}', '{OTHER}'), ' ') AS x
  FROM documents),
raw AS ({" UNION ALL ".join(kind(i, k) for i, k in enumerate(BASE))}),
numbers AS (SELECT *, {digits} AS d FROM raw),
ent AS (SELECT r, x, kind, s, s + length(v) AS en, CASE kind WHEN 0 THEN translate(v, {az}) WHEN 1 THEN v ELSE d END AS e,
    right(parts[i - 1], {SCOPE}) AS lft, left(parts[i + 1], {SCOPE}) AS rgt FROM numbers WHERE CASE kind WHEN 0 THEN TRUE
  WHEN 1 THEN regexp_full_match(v, '{OCTET}(?:\\.{OCTET}){{3}}')
  WHEN 2 THEN length(d) BETWEEN {CARD_DIGITS[0]} AND {CARD_DIGITS[1]} AND {luhn}
  ELSE length(d) BETWEEN {PHONE_DIGITS[0]} AND {PHONE_DIGITS[1]} END),
near AS (SELECT r, x, kind, e, translate(term, {az}) AS term, s, s + length(term) AS en FROM (
  {words("lft", "s - length(lft)")} UNION ALL {words("rgt", "en")})),
toks AS (SELECT r, unnest(list_distinct(list_transform(list_filter(regexp_split_to_array(x, '{gap}'), lambda w: regexp_full_match(w,
    '{around}\\p{{L}}+{around}')), lambda w: translate(regexp_extract(w, '\\p{{L}}+'), {az})))) AS term FROM t),
nt AS (SELECT term, count(*) AS nt FROM toks GROUP BY term),
ne AS (SELECT kind, e, count(DISTINCT r) AS ne FROM ent GROUP BY kind, e),
nte AS (SELECT kind, e, term, count(DISTINCT r) AS nte FROM near GROUP BY ALL HAVING count(DISTINCT x) > 1),
num AS (SELECT kind, e, term, nt::DOUBLE AS a, ne::DOUBLE AS b, nte::DOUBLE AS c, (SELECT count(*) FROM t)::DOUBLE AS n
  FROM nte JOIN nt USING (term) JOIN ne USING (kind, e)),
shown AS (SELECT kind, e, term FROM num WHERE a * a * a * a * b <= n * (c * c * c * c)),
spans AS (SELECT r, kind, s, en FROM ent UNION ALL
  SELECT DISTINCT r, {TERM}, s, en FROM near JOIN shown USING (kind, e, term)),
every AS (SELECT r, {", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{k}" for i, k in enumerate(BASE))},
  sha256(coalesce({listed.replace(", ',' ORDER", ", ',' ORDER")} FILTER (WHERE kind < {TERM}), '')) AS base_sha256,
  {listed} AS spans FROM spans GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, coalesce(base_sha256, sha256('')) AS base_sha256,
  coalesce(spans, '') AS spans FROM t LEFT JOIN every USING (r)"""
