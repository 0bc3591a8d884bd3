"""Language identification by Bayesian evidence fusion.

Evidence about each item (a page or a document):

* its text: character trigrams, hashed to ``BUCKETS`` buckets, under a model
  per language.  Trigrams overlap and depend on each other, so the log
  likelihood is tempered to that of at most ``EFFECTIVE`` trigrams; an item
  without text has none;
* the language its markup declares, and the last label of its address (the
  suffix), through how often each goes with each language;
* a prior from its host, smoothed towards the host's domain, which is
  smoothed towards the corpus, with ``STRENGTH`` pseudo-items each.

The tables behind the last two are counted by grouped aggregation over all
items, as expected counts: each item adds its text posterior, not a hard
label.  A host may hold any share of the items: sums are taken per task
first, and tables are joined as Spark sees fit for their size.

The text model is the one part fitted on a bounded sample of labelled texts:
``SAMPLE`` texts per language, taken by hash of id, whole.  Its size is
languages x BUCKETS numbers whatever the corpus.

Defined results: a null text counts as empty.  Missing evidence (null or
empty) says nothing.  An item without any evidence gets the corpus's most
frequent language.  Of languages with equal posteriors the first by name is
chosen.  Texts of any length are read whole.  Without labelled texts there is no language to choose
from and every result is null.  Rows are judged one by one, so repeated rows
give repeated results; an empty table gives an empty result.  Columns other
than those named are left out.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.tables import ship, stored

BUCKETS = 1 << 14
SAMPLE = 400
EFFECTIVE = 60
STRENGTH = 5.0
_TURNS = 1 << 20
_RAW = re.compile(r"(?i)<(script|style)\b")
_RAW_END = {n: re.compile(rf"(?i)</{n}\s*>") for n in ("script", "style")}
_WHITE = re.compile(r"[\W\d_]+")


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of a text's character trigrams, letters only, words padded."""
    letters = _WHITE.sub(" ", f" {text or ''} ".lower())
    if letters.isspace():
        return np.empty(0, np.int64)
    code = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    key = (code[:-2] << np.uint64(42)) ^ (code[1:-1] << np.uint64(21)) ^ code[2:]
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (key >> np.uint64(50)).astype(np.int64) % BUCKETS


def without_markup(html: str) -> str:
    """``html`` with a space for each tag, comment, script and style.  What
    was once looked for in vain isn't looked for again, so time is linear."""
    out, at, missing = [], 0, set()

    def end_of(what: str, found: int) -> int | None:
        if found < 0:
            missing.add(what)
            return None
        return found

    while (i := html.find("<", at)) >= 0:
        out.append(html[at:i])
        end = None
        raw = _RAW.match(html, i)
        if raw and raw[1].lower() not in missing:
            close = _RAW_END[raw[1].lower()].search(html, raw.end())
            end = end_of(raw[1].lower(), close.end() if close else -1)
        elif html.startswith("<!--", i) and "comment" not in missing:
            close = html.find("-->", i + 4)
            end = end_of("comment", close + 3 if close >= 0 else -1)
        if end is None:
            close = html.find(">", i)
            if close < 0:
                at = i
                break
            end = close + 1
        out.append(" ")
        at = end
    return "".join([*out, html[at:]])


def sample(labelled: DataFrame) -> DataFrame:
    """At most SAMPLE texts of each language of (id, text, lang): those with
    the least hashes.

    Hashes are even, so a language of n texts has SAMPLE of them below about
    SAMPLE / n of the range; only texts below three times that are ranked,
    however many there are."""
    turn = F.pmod(F.xxhash64("id", F.xxhash64("text")), F.lit(_TURNS))
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", turn.alias("turn"))
    # Stored, so that Spark knows how small it is and moves no text for it.
    sizes = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    few = rows.join(sizes, "lang").where(
        F.col("turn") * F.col("n") <= F.lit(3 * SAMPLE) * F.lit(_TURNS))
    by = Window.partitionBy("lang").orderBy("turn", "text")
    return (few.withColumn("k", F.row_number().over(by)).where(F.col("k") <= SAMPLE)
            .select("lang", "text"))


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihoods per language and bucket)."""
    def count(batches):
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                bucket, n = np.unique(trigrams(text), return_counts=True)
                yield pd.DataFrame({"lang": lang, "bucket": bucket, "n": n})

    ship(labelled.sparkSession)
    rows = (sample(labelled).mapInPandas(count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(rows["lang"].unique())
    seen = np.zeros((len(languages), BUCKETS))
    for i, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        seen[i, own["bucket"].to_numpy(int)] = own["n"]
    smooth = seen + 0.5
    return languages, np.log(smooth / smooth.sum(axis=1, keepdims=True))


def text_scores(text: Column, model: np.ndarray, markup: Column) -> Column:
    """Tempered log likelihoods of each language; ``markup`` says whether
    the text is HTML."""
    @F.pandas_udf("array<double>")
    def scored(texts: pd.Series, html: pd.Series) -> pd.Series:
        out = []
        for t, h in zip(texts, html):
            found = trigrams(without_markup(t or "") if h else t)
            total = np.zeros(len(model))
            for i in range(0, len(found), 1 << 16):
                total += model[:, found[i:i + (1 << 16)]].sum(axis=1)
            n = len(found)
            out.append((total * min(1.0, EFFECTIVE / n) if n else total).round(6))
        return pd.Series(out, dtype=object)

    return scored(text, markup)


def _posterior(scores: Column) -> Column:
    """exp and normalise an array of log scores."""
    odds = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return F.transform(odds, lambda x: x / total)


def _sums(items: DataFrame, key: str, k: int) -> DataFrame:
    """(key, mass): expected items of each language, per value of ``key``."""
    mass = F.array(*[F.round(F.sum(F.col("p")[i]), 6) for i in range(k)])
    return items.where(F.col(key).isNotNull()).groupBy(key).agg(mass.alias("mass"))


def _log_rate(mass: Column, known: Column) -> Column:
    """log P(value | language): expected items of the value over those of the
    language that have any value, smoothed; nothing where it is missing."""
    seen = F.zip_with(mass, known, lambda a, b: F.log((a + 0.5) / (b + 1.0)))
    return F.coalesce(seen, F.transform(known, lambda _: F.lit(0.0)))


def fuse(items: DataFrame, languages: list[str], ids: list[str]) -> DataFrame:
    """``ids`` plus lang, prob and text_lang.  ``items`` has ids, host,
    domain, suffix, declared and score (log likelihoods of the text)."""
    k = len(languages)
    rows = stored(items.withColumn("p", _posterior(F.col("score"))), "scores")

    def all_of(where: Column) -> list[Column]:
        return [F.round(F.coalesce(F.sum(F.when(where, F.col("p")[i])), F.lit(0.0)), 6)
                for i in range(k)]

    # 3 * k sums: over all items, and over those with each kind of evidence.
    total = rows.agg(*all_of(F.lit(True)), *all_of(F.col("declared").isNotNull()),
                     *all_of(F.col("suffix").isNotNull())).first()
    corpus, with_declared, with_suffix = (F.array(*[F.lit(c) for c in total[i:i + k]])
                                          for i in (0, k, 2 * k))
    everywhere = F.transform(corpus, lambda c: (c + 1.0) / F.lit(sum(total[:k]) + k))

    def towards(mass: Column, prior: Column) -> Column:
        n = F.aggregate(mass, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(mass, prior, lambda a, b: (a + STRENGTH * b) / (n + STRENGTH))

    domain = _sums(rows, "domain", k).select("domain", F.col("mass").alias("of_domain"))
    host = _sums(rows, "host", k).select("host", F.col("mass").alias("of_host"))
    said = _sums(rows, "declared", k).select("declared", F.col("mass").alias("of_declared"))
    suffix = _sums(rows, "suffix", k).select("suffix", F.col("mass").alias("of_suffix"))
    joined = rows
    for side, name in ((host, "host"), (domain, "domain"), (said, "declared"), (suffix, "suffix")):
        joined = joined.join(stored(side, name), name, "left")
    # An item's own text is no evidence about its host, domain, suffix or
    # markup language: it already speaks for itself.
    own = F.col("p")

    def others(mass: Column) -> Column:
        return F.zip_with(mass, own, lambda a, b: F.greatest(a - b, F.lit(0.0)))

    prior = F.coalesce(towards(others(F.col("of_domain")), everywhere), everywhere)
    prior = F.coalesce(towards(others(F.col("of_host")), prior), prior)
    parts = [F.transform(prior, lambda x: F.log(x)),
             _log_rate(others(F.col("of_declared")), others(with_declared)),
             _log_rate(others(F.col("of_suffix")), others(with_suffix))]
    score = F.col("score")
    for part in parts:
        score = F.zip_with(score, part, lambda a, b: a + b)
    names = F.array(*[F.lit(x) for x in languages])

    def best(of: Column) -> Column:
        return F.element_at(names, F.array_position(of, F.array_max(of)).cast("int"))

    fused = joined.select(*ids, "p", score.alias("score"))
    return fused.select(*ids, "p", _posterior(F.col("score")).alias("q")).select(
        *ids, best(F.col("q")).alias("lang"), F.round(F.array_max("q"), 6).alias("prob"),
        best(F.col("p")).alias("text_lang"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """id, text, markup, declared, host, domain and suffix of (page_id, url, html)."""
    def group(col: str, pattern: str) -> Column:
        found = F.lower(F.regexp_extract(F.col(col), pattern, 1))
        return F.when(found != "", found)
    host = group("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
    return pages.select(
        F.col("page_id").alias("id"), F.col("html").alias("text"), F.lit(True).alias("markup"),
        F.substring_index(group("html", r"""(?i)<html[^>]*?\slang\s*=\s*["']?([a-z]+)"""), "-", 1)
        .alias("declared"), host.alias("host"),
        # Two labels, or three where the last two are a public suffix.
        F.when(F.regexp_like(host, F.lit(r"\.(ac|co|com|edu|gov|ne|net|or|org)\.[a-z]{2}$")),
               F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
        .alias("domain"),
        F.when(F.contains(host, F.lit(".")), F.substring_index(host, ".", -1)).alias("suffix"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """Documents have no markup and no address; their source is the host."""
    none = F.lit(None).cast("string")
    return docs.select(F.col("doc_id").alias("id"), "text", F.lit(False).alias("markup"),
                       none.alias("declared"), F.concat(F.lit("source:"), "source").alias("host"),
                       none.alias("domain"), none.alias("suffix"))


def identify(items: DataFrame, labelled: DataFrame, ids: list[str]) -> DataFrame:
    """``ids`` plus lang, prob (of lang) and text_lang (by text alone) for
    every item of (ids, text, markup, declared, host, domain, suffix);
    ``labelled`` has id, text and lang."""
    languages, model = fit(labelled)
    if not languages:
        none = F.lit(None)
        return items.select(*ids, none.cast("string").alias("lang"),
                            none.cast("double").alias("prob"),
                            none.cast("string").alias("text_lang"))
    scored = items.select(*ids, "declared", "host", "domain", "suffix",
                          text_scores(F.col("text"), model, F.col("markup")).alias("score"))
    return fuse(scored, languages, ids)
