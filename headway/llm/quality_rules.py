"""Quality rules with thresholds that adapt to language and source.

Each text is measured (words, word length, symbols, repeated lines, repeated
word windows, capitals, exclamations).  For each metric and each (language,
source) the values are kept in a mergeable quantile sketch: counts per bin of
fixed bounds, so sketches of any parts add up exactly, in any order; those of
a language's sources add up to the language's, those of all to the corpus's.

A group's fence is its high quantile, plus REACH times that quantile's
distance from the median, plus a margin: ordinary texts often all measure 0,
and no spread must not reject the first text above it.  Quantiles of a group
of n texts are drawn towards its language's as if SHRINK more texts had been
seen there, and the language's towards the corpus's in the same way, so a
fence moves smoothly from the language's to the group's own as the group
grows.  A text is rejected where a metric lies beyond its group's fence.
Texts are joined with their group's fences and filtered.

Metrics are rates per 1000 words (word length: characters of 100 words), in
whole numbers, so bins are exact: one bin per unit up to 1024, then 64 bins
per power of two (error under 1.6 %).  A sketch is therefore at most a few
thousand rows whatever its group's size.

Defined results: a null or empty text has no words and fails the base rule.
Texts of any length are measured whole.  A value on the fence stays.  Null
languages and sources are groups of their own.  Repeated rows count and are
judged one by one.  An empty table gives an empty result.  Extra columns,
whatever their names, pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.tables import free_name, ship, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SHRINK = 50
REACH = 4
#: Metric -> (percent of the texts below the high quantile, margin).  Junk
#: made of symbols or exclamations may be a fifth of a source; the others
#: vary among good texts, so more of them tell how far.
METRICS = {"symbol_rate": (75, 100), "repeat_rate": (90, 250), "caps_rate": (90, 100),
           "bang_rate": (75, 100), "line_rate": (90, 50), "word_length": (90, 50)}
MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, n_caps long, n_bangs long")
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\x0c"
_CAPS = bytes(range(65, 91))


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """How many words lie in a window of ``size`` words found twice or more."""
    if len(words) <= size:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    n = len(words) - size + 1
    key = code[:n]
    for i in range(1, size):
        # Renumbered after each word, so the product can't overflow.
        key = np.unique(key * len(ids) + code[i:i + n], return_inverse=True)[1].astype(np.int64)
    again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words), bool)
    for i in range(size):
        covered[i:i + n] |= again
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The counts of ``MEASURES`` for one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0, 0, len(raw) - len(raw.translate(None, _SYMBOLS)), 0, 0, 0, 0)
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACES)]
    return (len(words), len(text) - (len(raw) - len(raw.translate(None, _SPACES))),
            len(raw) - len(raw.translate(None, _SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), sum(w.isupper() and len(w) > 1 for w in words),
            sum(w.endswith(b"!!") for w in words))


def measures(text: Column) -> Column:
    """A struct of MEASURES for each text, in Arrow batches."""
    names = [m.split()[0] for m in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure_text(t) for t in texts], columns=names).astype("int64")

    # Not to be evaluated a second time for a filter on its result: Spark
    # doesn't push filters through what it takes to be nondeterministic.
    return measure.asNondeterministic()(text)


def _rates(m: str) -> dict[str, Column]:
    """Rates as whole numbers; 0 for a text without words."""
    def rate(field: str, per: int = 1000) -> Column:
        return F.coalesce(F.expr(f"{m}.{field} * {per} DIV nullif({m}.n_words, 0)"),
                          F.lit(0)).cast("long")
    return {"symbol_rate": rate("n_symbols"), "repeat_rate": rate("n_repeat_words"),
            "caps_rate": rate("n_caps"), "bang_rate": rate("n_bangs"),
            "line_rate": rate("n_dup_lines"), "word_length": rate("word_chars", 100)}


def sketch_bin(value: str) -> str:
    """The bin's lower bound: the value up to 1024, beyond that the value
    with all but its 7 leading bits cleared."""
    shift = f"CAST(greatest(length(bin({value})) - 7, 0) AS INT)"
    return f"IF({value} < 1024, {value}, shiftleft(shiftright({value}, {shift}), {shift}))"


def base_failed(m: str) -> Column:
    return F.expr(f"{m}.n_words < {MIN_WORDS} OR "
                  f"100 * {m}.n_repeat_words > {MAX_REPEAT_PERCENT} * {m}.n_words")


def sketches(rates: DataFrame) -> DataFrame:
    """(lang, source, metric, bin, n): the sketch of every group.  ``rates``
    has lang, source and the metrics."""
    long = rates.select("lang", "source", F.explode(F.create_map(*[
        x for name in METRICS for x in (F.lit(name), F.col(name))])).alias("metric", "value"))
    return (long.groupBy("lang", "source", "metric", F.expr(sketch_bin("value")).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def _quantiles(sketch: DataFrame, group: list[str]) -> DataFrame:
    """group, metric, total, mid, high: the bins in which the median and the
    metric's high quantile lie."""
    bins = sketch.groupBy(*group, "metric", "bin").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*group, "metric")
    run = bins.select("*", F.sum("n").over(by.orderBy("bin")).alias("upto"),
                      F.sum("n").over(by).alias("total"))
    level = _by_metric({k: v for k, (v, _) in METRICS.items()})
    return run.groupBy(*group, "metric").agg(
        F.max("total").alias("total"),
        F.min(F.when(F.col("upto") * 100 >= F.col("total") * 50, F.col("bin"))).alias("mid"),
        F.min(F.when(F.col("upto") * 100 >= F.col("total") * level, F.col("bin"))).alias("high"))


def _by_metric(values: dict[str, int]) -> Column:
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), F.lit(v))])[
        F.col("metric")].cast("long")


def fences(rates: DataFrame) -> DataFrame:
    """(lang, source, <metric>_fence ...): one row per (lang, source)."""
    sketch = stored(sketches(rates), "sketches")
    own = _quantiles(sketch, ["lang", "source"])
    lang = _quantiles(sketch, ["lang"]).select(
        F.col("lang").alias("l"), F.col("metric").alias("lm"), F.col("total").alias("lt"),
        F.col("mid").alias("l_mid"), F.col("high").alias("l_high"))
    every = _quantiles(sketch, []).select(
        F.col("metric").alias("am"), F.col("mid").alias("a_mid"), F.col("high").alias("a_high"))
    joined = (own.join(lang, own["lang"].eqNullSafe(lang["l"]) & (own["metric"] == lang["lm"]))
              .join(every, F.col("metric") == F.col("am")))

    def drawn(name: str) -> Column:
        of_lang = f"(lt * l_{name} + {SHRINK} * a_{name}) DIV (lt + {SHRINK})"
        return F.expr(f"(total * {name} + {SHRINK} * ({of_lang})) DIV (total + {SHRINK})")

    margin = _by_metric({k: v for k, (_, v) in METRICS.items()})
    fence = (drawn("high") + REACH * (drawn("high") - drawn("mid")) + margin)
    return joined.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("metric") == k, fence)).alias(f"{k}_fence") for k in METRICS])


def _within(m: str) -> Column:
    ok = F.lit(True)
    for name, rate in _rates(m).items():
        ok = ok & (rate <= F.col(f"{name}_fence"))
    return ok


def _group_rates(docs: DataFrame, lang_col: str, source_col: str, m: str) -> DataFrame:
    return docs.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       *[r.alias(k) for k, r in _rates(m).items()])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per document: the id, the measures, base_failed and kept."""
    ship(docs.sparkSession)
    measured = stored(docs.select(
        F.col(id_col).alias("__id"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"), measures(F.col(text_col)).alias("m")), "measures")
    limits = stored(fences(_group_rates(measured, "lang", "source", "m")), "fences")
    on = (measured["lang"].eqNullSafe(limits["lang"])
          & measured["source"].eqNullSafe(limits["source"]))
    fields = [f.split()[0] for f in MEASURES.split(", ")]
    return measured.join(limits, on, "left").select(
        F.col("__id").alias(id_col), *[F.col(f"m.{f}").alias(f) for f in fields],
        base_failed("m").alias("base_failed"),
        (~base_failed("m") & F.coalesce(_within("m"), F.lit(True))).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns.  Texts are
    measured once for the sketches and once more for the filter, instead of
    being stored a second time with their measures."""
    ship(docs.sparkSession)
    names = {"m": free_name(docs, "__m"), "l": free_name(docs, "__lang"),
             "s": free_name(docs, "__source")}
    measured = docs.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                           measures(F.col(text_col)).alias("m"))
    limits = stored(fences(_group_rates(measured, "lang", "source", "m")), "fences")
    limits = limits.select(F.col("lang").alias(names["l"]), F.col("source").alias(names["s"]),
                           *[f"{k}_fence" for k in METRICS])
    clash = {f"{k}_fence": free_name(docs, f"{k}_fence") for k in METRICS}
    limits = limits.withColumnsRenamed(clash)
    again = docs.select("*", measures(F.col(text_col)).alias(names["m"]))
    joined = again.join(limits, again[lang_col].eqNullSafe(limits[names["l"]])
                        & again[source_col].eqNullSafe(limits[names["s"]]), "left")
    ok = ~base_failed(names["m"])
    for k, rate in _rates(names["m"]).items():
        ok = ok & F.coalesce(rate <= F.col(clash[f"{k}_fence"]), F.lit(True))
    return joined.where(ok).select(*[again[c] for c in docs.columns])
