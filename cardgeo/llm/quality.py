"""Quality rules: fixed text rules and n-gram perplexity bands per language.

The language model is a modified Kneser-Ney model over runs of ``ORDER``
characters (UTF-16 units, white space runs as one space), so a gram is exactly
one 64-bit key and a model's size is bounded by its alphabet, not its words.

1. One pass counts the grams of every distinct text, per language, in the
   tasks; Spark adds the partial counts. Copies count once: however many there
   are, they neither teach the model nor move the bands. Continuation counts, counts of counts, discounts
   and back-off weights are Spark groupings on the distinct grams.
2. Entries seen once, above the lowest order, are left to the back-off weight:
   they would only make a text likely by its own characters. All others are in
   the model. The commonest of a language and order, at most ``ENTRIES``, are
   collected into sorted key arrays and broadcast; if there are more (an
   alphabet's 4-grams stay far below it), the rest stay in a table.
   Texts with over ``TAUGHT_SYMBOLS`` percent of symbols do not teach the model.
3. A second pass computes the rules' figures and each text's log perplexity. Its
   grams that the arrays may not know wholly leave the pass with the text, of
   copies only one's; the distinct ones get their probabilities from the table by
   joins, order by order, and their logs are added to the text's. Where an entry
   is looked up does not change its value.
4. Each language's bands come from the quartiles of its distinct texts: a text is
   rejected above ``q3 + HIGH * (q3 - q1)`` or below ``q1 - LOW * (q3 - q1)``.

Defined results: null text is empty: no words, ``base_failed``, not kept. A
null language is a language of its own. Null ids and repeated rows are scored
like any other row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HashedWords, materialize, text_batches, text_chunks, window_hashes

ORDER = 4
ENTRIES = 1 << 20
#: Languages whose bands are broadcast.
LANGUAGES = 10_000
#: Widths of the bands, in interquartile ranges.
HIGH, LOW = 4.0, 4.0
MIN_WORDS, REPEAT_WORDS, REPEAT_PERCENT = 20, 8, 30
#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
#: Share of symbols, in percent, up to which a text teaches the model.
TAUGHT_SYMBOLS = 1
_BEFORE, _AFTER = 2, 3  # UTF-16 units that stand for a text's two ends
_UNIT = 16
_FLUSH = 1 << 21


def gram_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDER``-grams of each text (one per character and one for its
    end) as 64-bit keys, oldest unit in the high bits; and the bounds of each
    text's grams."""
    units = [np.frombuffer(" ".join(t.decode("utf-8", "replace").split()).encode("utf-16-le"), "<u2") for t in texts]
    pad, end = np.full(ORDER - 1, _BEFORE, "<u2"), np.array([_AFTER], "<u2")
    flat = np.concatenate([x for u in units for x in (pad, u, end)]).astype(np.uint64)
    key = np.zeros(len(flat) - ORDER + 1, np.uint64)
    for j in range(ORDER):
        key = (key << np.uint64(_UNIT)) | flat[j:j + len(key)]
    sizes = np.array([len(u) + 1 for u in units])
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    starts = np.cumsum(sizes + ORDER - 1) - sizes - (ORDER - 1)
    take = np.arange(bounds[-1]) + np.repeat(starts - bounds[:-1], sizes)
    return key[take], bounds


def _by_language(pdf: pd.DataFrame):
    """Runs of texts of one language: ``(language, row positions, texts)``."""
    lang = pdf["lang"].fillna("").astype(str).to_numpy()
    text = pdf["text"].to_numpy()
    for name in pd.unique(lang):
        rows = np.flatnonzero(lang == name)
        for first, run in text_chunks([text[i] for i in rows]):
            yield name, rows[first:first + len(run)], run


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial counts of the grams, added up within the task."""
    held: dict[str, list[pd.Series]] = {}

    def flush(name):
        total = pd.concat(held.pop(name))
        total = total.groupby(level=0, sort=False).sum()
        return pd.DataFrame({"lang": name, "gram": total.index.to_numpy(np.uint64).view(np.int64),
                             "n": total.to_numpy(np.int64)})

    for pdf in batches:
        for name, _, run in _by_language(pdf):
            keys, _ = gram_keys(run)
            held.setdefault(name, []).append(pd.Series(keys).value_counts(sort=False))
            if sum(map(len, held[name])) > _FLUSH:
                done = flush(name)
                if len(done) > _FLUSH // 2:
                    yield done
                else:
                    held[name] = [pd.Series(done["n"].to_numpy(), done["gram"].to_numpy().view(np.uint64))]
    for name in list(held):
        yield flush(name)


def all_orders(counts: DataFrame) -> DataFrame:
    """``lang, k, gram, n`` of every order from ``lang, gram, n`` of the top one."""
    levels, now = [], counts
    for k in range(ORDER, 0, -1):
        levels.append(now.select("lang", F.lit(k).alias("k"), "gram", "n"))
        if k > 1:  # continuation counts: distinct left neighbours of the suffix
            suffix = F.col("gram").bitwiseAND(F.lit((1 << (_UNIT * (k - 1))) - 1))
            now = now.groupBy("lang", suffix.alias("gram")).agg(F.count(F.lit(1)).alias("n"))
    grams = levels[0]
    for x in levels[1:]:
        grams = grams.unionByName(x)
    return materialize(grams, "op5-grams")


def common_cuts(grams: DataFrame) -> DataFrame:
    """``lang, k, cut, more``: the least count that leaves a language and order
    at most ``ENTRIES`` entries, and whether it has others."""
    alike = grams.groupBy("lang", "k", "n").agg(F.count(F.lit(1)).alias("entries"))
    above = F.sum("entries").over(Window.partitionBy("lang", "k").orderBy(F.desc("n")))
    each = alike.where((F.col("n") > 1) | (F.col("k") == 1)).select("lang", "k", "n", (above <= ENTRIES).alias("fits"))
    cuts = each.groupBy("lang", "k").agg(F.min(F.when(F.col("fits"), F.col("n"))).alias("cut"), F.max(~F.col("fits")).alias("more"))
    return materialize(cuts, "op5-cuts")


def kneser_ney(grams: DataFrame, cuts: DataFrame) -> DataFrame:
    """``lang, k, gram, p, ctx, back``: of each entry of each order k its
    discounted probability, its context and the context's back-off weight; and
    ``common``, whether it is one of those broadcast."""
    times = lambda i: F.sum(F.when(F.col("n") == i, 1).otherwise(0)).cast("double")
    of = grams.groupBy("lang", "k").agg(*(times(i).alias(f"n{i}") for i in (1, 2, 3, 4)))
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    cut = lambda i: F.when(
        F.col(f"n{i}") > 0, F.greatest(F.least(i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"), F.lit(float(i) - 0.05)), F.lit(0.05))).otherwise(F.lit(0.5))
    discounts = of.select("lang", "k", *(cut(i).alias(f"d{i}") for i in (1, 2, 3)))
    ctx = F.shiftrightunsigned("gram", _UNIT)
    rows = (grams.withColumn("ctx", ctx).join(discounts, ["lang", "k"]).join(cuts, ["lang", "k"], "left")
            .withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
            .withColumn("kept", (F.col("n") > 1) | (F.col("k") == 1))
            .withColumn("common", F.coalesce(F.col("n") >= F.col("cut"), F.lit(False))))
    totals = rows.groupBy("lang", "k", "ctx").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("kept"), F.col("n") - F.col("d")).otherwise(0.0)).alias("held"))
    return (rows.where("kept").join(totals, ["lang", "k", "ctx"])
            .select("lang", "k", "gram", ((F.col("n") - F.col("d")) / F.col("total")).cast("float").alias("p"), "ctx",
                    (1 - F.col("held") / F.col("total")).cast("float").alias("back"), "common"))


PACKED = "lang string, k int, grams binary, p binary, contexts binary, back binary"


def _pack(part: pd.DataFrame) -> pd.DataFrame:
    """The entries of a language and order as sorted arrays."""
    gram = part["gram"].to_numpy(np.int64).view(np.uint64)
    by = np.argsort(gram)
    ctx, first = np.unique(part["ctx"].to_numpy(np.int64).view(np.uint64), return_index=True)
    arrays = (gram[by], part["p"].to_numpy()[by].astype(np.float32), ctx, part["back"].to_numpy()[first].astype(np.float32))
    return pd.DataFrame([(part["lang"].iloc[0], int(part["k"].iloc[0]), *(x.tobytes() for x in arrays))],
                        columns=[c.split()[0] for c in PACKED.split(", ")])


class GramModel:
    """Sorted key arrays per language and order; unseen characters share the
    lowest order's left-over mass evenly over all units. The arrays are made in
    tasks, of at most ``ENTRIES`` entries each; the driver holds their bytes.
    ``entries``: the table of all entries, if the arrays of the languages and
    orders ``more`` do not hold them all."""

    def __init__(self, rows, more=(), entries: DataFrame | None = None):
        self.more, self.entries = frozenset(more), entries
        self.of = {(r["lang"], r["k"]): (np.frombuffer(r["grams"], np.uint64), np.frombuffer(r["p"], np.float32),
                                         np.frombuffer(r["contexts"], np.uint64), np.frombuffer(r["back"], np.float32))
                   for r in rows}

    @staticmethod
    def _look(keys, values, wanted, default):
        if not len(keys):
            return np.full(len(wanted), default)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], default)

    def __getstate__(self):  # tasks have the arrays only
        return self.__dict__ | {"entries": None}

    def known(self, lang: str, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log of P(last unit | the units before it), interpolated, and
        whether the arrays are enough for it: a gram that they have at an order
        has its context there too; one that they lack may be in the table."""
        p, sure = np.full(len(grams), 1.0 / (1 << _UNIT)), np.ones(len(grams), bool)
        for k in range(1, ORDER + 1):
            part = grams if k == ORDER else grams & np.uint64((1 << (_UNIT * k)) - 1)
            if (lang, k) in self.of:
                key, prob, ctx, back = self.of[lang, k]
                p = self._look(key, prob, part, 0.0) + self._look(ctx, back, part >> np.uint64(_UNIT), 1.0) * p
            if (lang, k) in self.more:
                sure &= np.isin(part, self.of[lang, k][0]) if (lang, k) in self.of else False
        return np.log(p), sure

    def log_probability(self, lang: str, grams: np.ndarray) -> np.ndarray:
        """``known``'s logs, those that the arrays do not give from the table
        (on the driver, for a few grams; ``score`` joins them)."""
        logs, sure = self.known(lang, grams)
        if not sure.all():
            asked = pd.DataFrame({"lang": lang, "gram": pd.unique(grams[~sure]).view(np.int64)})
            asked = self.entries.sparkSession.createDataFrame(asked, "lang string, gram long")
            found = {r["gram"]: r["log"] for r in table_logs(asked, self.entries).collect()}
            logs[~sure] = [found[g] for g in grams[~sure].view(np.int64).tolist()]
        return logs


def table_logs(asked: DataFrame, entries: DataFrame) -> DataFrame:
    """``lang, gram, log`` of the distinct grams ``asked`` (``lang, gram``) by
    the table of all entries. Each order's distinct grams meet its entries,
    their contexts and the order below, so that no join's key has more rows
    than there are units."""
    need = {ORDER: asked}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (_UNIT * k)) - 1))
        need[k] = need[k + 1].select("lang", suffix.alias("gram")).distinct()
    lower = None
    for k in range(1, ORDER + 1):
        of = entries.where(F.col("k") == k)
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (_UNIT * (k - 1))) - 1))
        now = (need[k].select("lang", "gram", F.shiftrightunsigned("gram", _UNIT).alias("ctx"), suffix.alias("suffix"))
               .join(of.select("lang", "gram", "p"), ["lang", "gram"], "left")
               .join(of.groupBy("lang", "ctx").agg(F.first("back").alias("back")), ["lang", "ctx"], "left"))
        below = F.lit(1.0 / (1 << _UNIT))
        if lower is not None:
            now, below = now.join(lower.select("lang", F.col("gram").alias("suffix"), F.col("all").alias("below")), ["lang", "suffix"]), F.col("below")
        p = F.coalesce(F.col("p").cast("double"), F.lit(0.0)) + F.coalesce(F.col("back").cast("double"), F.lit(1.0)) * below
        lower = now.select("lang", "gram", p.alias("all"))
    return lower.select("lang", "gram", F.log("all").alias("log"))


def digest(text: Column) -> Column:
    """The name of a text: copies share it. Null is the empty text."""
    return F.md5(F.coalesce(text.cast("binary"), F.lit(b"")))


def fit(docs: DataFrame) -> GramModel:
    """The model of the distinct texts of ``docs`` (``text`` as binary,
    ``lang``) with at most ``TAUGHT_SYMBOLS`` percent of symbols: what a model
    learns from junk, it does not reject. Copies meet by their digest, each
    task's own ones first."""
    symbols = F.char_length(F.regexp_replace(F.col("text").cast("string"), f"[^{SYMBOLS.decode()}]", ""))
    taught = F.coalesce(100 * symbols <= TAUGHT_SYMBOLS * F.octet_length("text"), F.lit(True))
    docs = (docs.where(taught).select("text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"))
            .groupBy("lang", digest(F.col("text"))).agg(F.first("text").alias("text")).select("text", "lang"))
    partial = docs.mapInPandas(_count, "lang string, gram long, n long")
    counts = materialize(partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "op5-counts")
    cuts = common_cuts(grams := all_orders(counts))
    entries, more = kneser_ney(grams, cuts), [(r["lang"], r["k"]) for r in cuts.where("more").collect()]
    entries = materialize(entries, "op5-entries") if more else entries
    packed = entries.where("common").groupBy("lang", "k").applyInPandas(_pack, PACKED)
    return GramModel(packed.toLocalIterator(), more, entries if more else None)


def text_rules(texts: list[bytes]) -> pd.DataFrame:
    """The fixed rules' figures of each text."""
    words = HashedWords(texts, lower=False)
    raw = np.frombuffer(words.data, np.uint8)
    first = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)))
    per_text = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[first])
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    repeated, lines = [], []
    for i, t in enumerate(texts):
        h = words.hash[words.bounds[i]:words.bounds[i + 1]]
        w = window_hashes(h, REPEAT_WORDS)
        n = 0
        if len(w) > 1 and len(pd.unique(w)) < len(w):
            _, inverse, times = np.unique(w, return_inverse=True, return_counts=True)
            edge = np.zeros(len(h) + 1, np.int64)
            at = np.flatnonzero(times[inverse] > 1)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + REPEAT_WORDS, -1)
            n = int((np.cumsum(edge) > 0).sum())
        repeated.append(n)
        with_word = [x for x in t.split(b"\n") if x.strip()]
        lines.append(len(with_word) - len(set(with_word)))
    return pd.DataFrame({"n_words": np.diff(words.bounds), "word_chars": per_text(~space[raw] & ((raw & 0xC0) != 0x80)),
                         "n_symbols": per_text(is_symbol[raw]), "n_dup_lines": lines, "n_repeat_words": repeated})


FIGURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "log_ppl double")
#: Of a text, the grams for the table and how often each occurs.
OPEN = "open array<long>, times array<long>"


def score(docs: DataFrame, model: GramModel, figures_col: str = "figures") -> DataFrame:
    """``docs`` with a struct of the rules' figures and ``log_ppl``, the mean
    negative log probability of a text's characters: of those that the arrays
    give, if the model has ``more``, and then also the others (``OPEN``) and the
    number of all (``size``), see ``whole``."""
    shared, parted = docs.sparkSession.sparkContext.broadcast(model), bool(model.more)
    columns = f"{FIGURES}, {OPEN}, size long" if parted else FIGURES

    @F.pandas_udf(columns)
    def figures(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, lang in batches:
            parts = []
            for name, rows, texts in _by_language(pd.DataFrame({"text": text, "lang": lang})):
                keys, bounds = gram_keys(texts)
                codes, grams = pd.factorize(keys)
                found, sure = shared.value.known(name, grams)
                found[~sure] = 0.0
                logs = np.concatenate(([0.0], np.cumsum(found[codes])))
                out = text_rules(texts)
                out["log_ppl"] = -(logs[bounds[1:]] - logs[bounds[:-1]]) / np.diff(bounds)
                if parted:
                    each = [np.unique(grams[c[~sure[c]]].view(np.int64), return_counts=True) for c in np.split(codes, bounds[1:-1])]
                    out["open"], out["times"], out["size"] = [x for x, _ in each], [x for _, x in each], np.diff(bounds)
                parts.append(out.set_axis(rows))
            yield pd.concat(parts).sort_index() if parts else pd.DataFrame(columns=[f.split()[0] for f in columns.split(", ")])

    return docs.withColumn(figures_col, figures(F.col("text").cast("binary"), F.col("lang")))


def whole(scored: DataFrame, entries: DataFrame) -> DataFrame:
    """``scored`` (``__name``, the text's digest ``__d``, ``__f``) with the logs
    of the texts' open grams added: one of each text's copies is looked up."""
    texts = (scored.where(F.size("__f.open") > 0).groupBy("__name", "__d")
             .agg(F.first(F.struct("__f.open", "__f.times")).alias("__o")))
    pairs = texts.select(F.col("__name").alias("lang"), "__d", F.explode(F.arrays_zip("__o.open", "__o.times")).alias("__g"))
    pairs = materialize(pairs.select("lang", "__d", F.col("__g.open").alias("gram"), F.col("__g.times").alias("times")), "op5-open")
    logs = table_logs(pairs.select("lang", "gram").distinct(), entries)
    added = (pairs.join(logs, ["lang", "gram"]).groupBy(F.col("lang").alias("__name"), "__d")
             .agg(F.sum(F.col("times") * F.col("log")).alias("__more")))
    ppl = F.col("__f.log_ppl") - F.coalesce("__more", F.lit(0.0)) / F.col("__f.size")
    out = scored.join(added, ["__name", "__d"], "left").withColumn("__f", F.col("__f").withField("log_ppl", ppl))
    out = out.withColumn("__f", F.col("__f").dropFields("open", "times", "size")).select(*scored.columns)
    return materialize(out, "op5-whole")


def judge(docs: DataFrame, high: float = HIGH, low: float = LOW, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` (with ``text`` and
    ``lang``) and a struct ``__q``: figures, ``base_failed``, the language's
    bands and ``kept``. The rows are written once with their figures, so the
    bands cost no second scoring."""
    keep = docs.columns if keep is None else keep
    docs = text_batches(docs)
    texts = docs.select(F.col("text").cast("binary").alias("text"), "lang")
    name = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    model = fit(texts)
    scored = score(docs, model, "__f").select(*keep, name.alias("__name"), digest(F.col("text")).alias("__d"), "__f")
    scored = materialize(scored, "op5-scored")
    if model.more:
        scored = whole(scored, model.entries)
    fig = lambda c: F.col(f"__f.{c}")
    failed = ((fig("n_words") < MIN_WORDS)
              | (100 * fig("n_repeat_words") > REPEAT_PERCENT * fig("n_words")))
    q = lambda p: F.percentile_approx(fig("log_ppl"), p, 10000)
    each = scored.where(~failed).groupBy(F.col("__name").alias("__lang"), "__d").agg(F.first("__f").alias("__f"))
    bands = each.groupBy("__lang").agg(q(0.25).alias("q1"), q(0.75).alias("q3"))
    wide = F.greatest(F.col("q3") - F.col("q1"), F.lit(0.02))
    bands = bands.select("__lang", F.struct((F.col("q1") - low * wide).alias("low"),
                                            (F.col("q3") + high * wide).alias("high")).alias("__b"))
    # One row per language: a short list goes to every task, so that the rows
    # are not dealt by language; Spark's own choice beyond ``LANGUAGES``.
    bands = materialize(bands, "op5-bands")
    if bands.limit(LANGUAGES + 1).count() <= LANGUAGES:
        bands = F.broadcast(bands)
    joined = scored.join(bands, F.col("__name") == F.col("__lang"), "left")
    inside = F.coalesce(fig("log_ppl").between(F.col("__b.low"), F.col("__b.high")), F.lit(False))
    return joined.select(*keep, F.struct(
        F.col("__f.*"), failed.alias("base_failed"), "__b.low", "__b.high", (~failed & inside).alias("kept")).alias("__q"))


def quality(docs: DataFrame, high: float = HIGH, low: float = LOW) -> DataFrame:
    """``doc_id``, the figures, ``base_failed``, ``kept``, ``log_ppl`` and the
    language's bands for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    q = lambda c: F.col(f"__q.{c}")
    return judge(docs, high, low, ["doc_id"]).select("doc_id", *(q(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ppl", "low", "high")))
