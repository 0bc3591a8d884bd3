"""Personal data by boosted trees over candidate spans.

High-recall generators propose spans that may overlap: the four base kinds
(email, ip, card, phone) by their form alone, and wider ones (numbers of
seven digits and more, addresses written out with "at", account numbers).
Gradient-boosted trees score each span by features of its format and
context.  They learn from the corpus itself: base spans that pass their
kind's check are positive; spans that fail it, or that are glued to letters
or digits (parts of identifiers), are negative.  Of the wide spans, account
numbers are labelled by their check digits and dates are negative; others
have no label and are only scored.  An account whose check digits are right
is as sure as a base span.

Scores are calibrated on rows that the trees have not seen: the threshold
is the least score at and above which the share of positives is at least
``PRECISION``.  Wide spans above it are added by score, each that overlaps no
better one and no base span.  A run of numbers is proposed whole and by its
sub-spans of 7 to 19 digits between separators, none of which cuts a date.
Base spans that pass their check are always reported.

The trees are fitted on every labelled span (spans with the same label and
features are one row with their number as its weight); every span of every
text is scored.  Where spans of one label are missing there is nothing to learn and nothing is added.

DataFrame and Spark ML functions only.  Defined results: a null text counts
as empty; a document without spans has empty spans; texts of any length are
scanned whole; of overlapping spans of one score ``TIES`` decide, then the
longer, then the one whose start has the smaller hash; repeated rows are
handled one by one; an empty table gives an empty result; columns other than id and text are left out.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.spans import CONTEXT, Kind, matches, per_document, scanned
from headway.llm.tables import stored

TREES, DEPTH = 12, 3
PRECISION = 0.98
SET_ROWS = 256          # spans of a chain of overlaps that are chosen from in one go
LEAST, MOST = 7, 19      # digits of a number within a run of numbers
HELD_OUT = 30            # percent of the labelled spans that calibrate

#: Base kinds in their listed order.  Possessive quantifiers and \G keep
#: the leftmost matches the same and the search linear.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
                  r"(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"text RLIKE '[0-9][.][0-9]'"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9]){12,}+", "text RLIKE '[0-9]'"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')"),
)
WIDE = (
    Kind("number", r"(?<![0-9A-Za-z])\(?[0-9](?:[().\x20/-]{0,2}[0-9]){6,}+(?![0-9])",
         "text RLIKE '[0-9]'"),
    Kind("address", r"(?i)(?<![a-z0-9._%+-])[a-z0-9][a-z0-9._%+-]{0,63}+\x20?[\[(]at[\])]\x20?"
                    r"[a-z0-9-]{1,63}+(?:\x20?(?:\.|[\[(]dot[\])])\x20?[a-z0-9-]{1,63}+)++",
         "lower(text) RLIKE '[\\\\[(]at[\\\\])]'"),
    Kind("account", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
                    r"(?![A-Za-z0-9])", "text RLIKE '[A-Z][A-Z][0-9][0-9]'"),
)
KINDS = BASE + WIDE

#: A date, by its digits alone.
DATE = (r"(?<![0-9])(?:[0-9]{4}([-/.])[0-9]{2}\1[0-9]{2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})"
        r"(?![-/.]?[0-9])")

_DIGITS = "regexp_replace(match, '[^0-9]', '')"
#: Doubled every second digit from the right; two-digit results count less 9.
_LUHN = ("aggregate(transform(split(reverse(digits), ''), (c, i) -> IF(i % 2 = 0, CAST(c AS INT), "
         "CAST(c AS INT) * 2 - IF(c >= '5', 9, 0))), 0, (a, x) -> a + x) % 10 = 0")
#: Kind -> SQL check over match, digits and n_digits.
CHECKS = {
    "email": "true",
    "ip": "forall(split(match, '[.]'), p -> length(ltrim('0', p)) <= 3 "
          "AND coalesce(try_cast(right(p, 3) AS INT), 0) <= 255)",
    "card": f"n_digits BETWEEN 13 AND 19 AND {_LUHN}",
    "phone": "n_digits BETWEEN 9 AND 15",
}
#: Account numbers carry check digits: with the first four characters put last
#: and letters read as 10 to 35, the number leaves 1 when divided by 97.
_ACCOUNT = ("kind = 'account' AND aggregate(split(concat(substring(letters, 5), left(letters, 4)), "
            "''), 0, (a, c) -> IF(c BETWEEN '0' AND '9', a * 10 + coalesce(try_cast(c AS INT), 0), "
            "a * 100 + ascii(c) - 55) % 97) = 1")
_CUE = (r"(?i)(e-?mail|phone|tel|call|fax|mobile|cell|whatsapp|card|visa|account|iban|ssn|contact|"
        r"ip|address|host)[^A-Za-z0-9]{0,6}$")
#: Between spans of one score: digits as of a phone number first, clean ends,
#: then fewer kinds of separators, each 0 or more and less being better.
TIES = {
    "t_size": "IF(n_digits BETWEEN 9 AND 15, 0, 1)",
    "t_ends": "IF(before = '' OR before RLIKE '\\\\s$', 0, 1) + "
              "IF(after = '' OR after RLIKE '^[\\\\s,.;:)]', 0, 1)",
    "t_signs": "size(array_distinct(regexp_extract_all(match, "
               "'(?<=[0-9A-Za-z])([^0-9A-Za-z]+)(?=[0-9A-Za-z])', 1)))",
}
#: Feature -> SQL over match, before, after, digits and n_digits.
FEATURES = {
    "f_length": "length(match)",
    "f_digits": "n_digits",
    "f_letters": "length(regexp_replace(match, '[^A-Za-z]', ''))",
    "f_parts": "size(split(match, '[^0-9A-Za-z]+'))",
    "f_run": "array_max(transform(split(match, '[^0-9]+'), x -> length(x)))",
    "f_distinct": "size(array_distinct(split(match, '')))",
    "f_at": "CAST(match RLIKE '(?i)@|[(\\\\[]at[)\\\\]]' AS INT)",
    "f_dots": "length(match) - length(replace(match, '.', ''))",
    "f_spaces": "length(match) - length(replace(match, ' ', ''))",
    "f_dashes": "length(match) - length(replace(match, '-', ''))",
    "f_brackets": "length(regexp_replace(match, '[^()]', ''))",
    "f_plus": "CAST(startswith(match, '+') AS INT)",
    "f_luhn": f"CAST(n_digits BETWEEN 13 AND 19 AND {_LUHN} AS INT)",
    "f_glued": "CAST(glued AS INT)",
    "f_quoted": "CAST(before RLIKE '[\"=:/]$' AS INT)",
    "f_cue": f"CAST(before RLIKE '{_CUE}' AS INT)",
    "f_starts": "CAST(before = '' OR before RLIKE '\\\\s$' AS INT)",
    "f_ends": "CAST(after = '' OR after RLIKE '^[\\\\s,.;:)]' AS INT)",
}


def proposed(scan: DataFrame) -> DataFrame:
    """Every match, and the sub-spans of runs of numbers; none of them begins
    or ends within a date, or holds one beside other numbers."""
    found = stored(matches(scan, KINDS), "matches")
    every = found.unionByName(parts(found.where("kind = 'number'")))
    around = F.concat("before", "match", "after")
    apart = F.concat("before", F.lit("\0"), "match", F.lit("\0"), "after")

    def dates(text: Column) -> Column:
        return F.size(F.regexp_extract_all(text, F.lit(DATE), F.lit(0)))

    whole = F.regexp_like("match", F.lit(f"^(?:{DATE})$"))
    mixed = F.regexp_like("match", F.lit(DATE)) & ~whole
    cut = F.when(F.regexp_like(around, F.lit("[0-9]{4}")), dates(around) > dates(apart))
    return every.where((F.col("kind") != "number") | ~(mixed | F.coalesce(cut, F.lit(False))))


def parts(runs: DataFrame) -> DataFrame:
    """Spans of ``LEAST`` to ``MOST`` digits that begin and end at separators
    of a run, apart from the whole run.  A group of digits is put together
    with those next to it by a window, so a long run takes no longer per group."""
    # One piece per group of digits: what separates it from the one before,
    # and itself; a last piece without digits holds what follows the run.
    pieces = runs.where("match RLIKE '[0-9][^0-9]'").selectExpr(
        "row", "`order`", "start AS run", "match AS whole", "before AS pre",
        "zip_with(split(match, '[0-9]+'), regexp_extract_all(match, '([0-9]+)', 1), "
        "(g, d) -> IF(d IS NULL, struct(after AS lead, '' AS digits), "
        "struct(g AS lead, d AS digits))) AS p",
    ).select("row", "order", "run", "pre", F.size("p").alias("n"), F.posexplode("p").alias("j", "x"))
    pieces = pieces.select("row", "order", "run", "pre", "n", "j", "x.lead", "x.digits")
    by = Window.partitionBy("row", "run").orderBy("j")
    text = F.concat("lead", "digits")
    around = pieces.withColumn("upto", F.sum(F.length(text)).over(
        by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    around = around.withColumn("past", F.concat(
        F.when(F.col("j") <= CONTEXT, F.col("pre")).otherwise(""),
        F.array_join(F.collect_list(text).over(by.rowsBetween(-CONTEXT, -1)), ""), "lead"))
    around = around.withColumn("next", F.collect_list(F.struct("lead", "digits")).over(
        by.rowsBetween(0, MOST + CONTEXT))).where("digits <> ''")
    join = "array_join(transform({}, x -> concat(x.lead, x.digits)), '')"
    # e groups; the last piece of all is what follows the run.
    each = around.withColumn("e", F.explode(F.expr(f"sequence(1, least({MOST}, n - 1 - j))")))
    each = each.where("NOT (j = 0 AND e = n - 1)")
    each = each.withColumn("body", F.concat(
        F.expr("next[0].digits"), F.expr(join.format("slice(next, 2, e - 1)"))))
    each = each.where(F.length(F.regexp_replace("body", "[^0-9]", "")).between(LEAST, MOST))
    each = each.withColumn("open", F.expr("IF(endswith(lead, '(') AND contains(body, ')'), 1, 0)"))
    start = F.col("run") + F.col("upto") - F.length("digits") - F.col("open")
    return each.select(
        "row", F.lit("number").alias("kind"), "order", start.alias("start"),
        (start + F.col("open") + F.length("body")).alias("end"),
        F.concat(F.expr("repeat('(', open)"), "body").alias("match"),
        F.expr(f"right(left(past, length(past) - open), {CONTEXT})").alias("before"),
        F.expr(f"left({join.format('slice(next, e + 1, size(next))')}, {CONTEXT})").alias("after"))


def described(spans: DataFrame) -> DataFrame:
    """``spans`` with their check (base kinds only), label and features."""
    base = F.col("order") < len(BASE)
    check = F.lit(False)
    for kind, sql in CHECKS.items():
        check = F.when(F.col("kind") == kind, F.expr(sql)).otherwise(check)
    rows = spans.withColumn("digits", F.expr(_DIGITS))
    rows = rows.withColumn("n_digits", F.length("digits")).withColumn("glued", F.expr(
        "before RLIKE '[A-Za-z0-9_]$' OR after RLIKE '^[A-Za-z0-9_]'"))
    rows = rows.withColumn("base", base & check)
    rows = rows.withColumn("letters", F.regexp_replace("match", " ", ""))
    rows = rows.withColumn("sure", F.expr(_ACCOUNT))
    date = (F.col("kind") == "number") & F.regexp_like("match", F.lit(f"^(?:{DATE})$"))
    label = F.when(F.col("base") | F.col("sure"), 1.0).when(
        base | F.col("glued") | date | (F.col("kind") == "account"), 0.0)
    return rows.select(
        "row", "kind", "order", "start", "end", "base", "sure", label.alias("label"),
        F.xxhash64("match", "before", "after", "kind").alias("turn"),
        *[F.expr(sql).cast("double").alias(name) for name, sql in (FEATURES | TIES).items()])


def fit(spans: DataFrame) -> tuple[GBTClassificationModel, float] | None:
    """(trees, threshold) from all spans with a label."""
    own = F.pmod("turn", F.lit(100)) >= HELD_OUT
    alike = ["own", "label", *FEATURES]
    rows = stored(spans.where("label IS NOT NULL").withColumn("own", own).groupBy(*alike).agg(
        F.count(F.lit(1)).cast("double").alias("weight")).orderBy(*alike), "fit")
    own = F.col("own")
    if rows.where(own).agg(F.count_distinct("label")).first()[0] < 2:
        return None
    trees = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                          maxIter=TREES, maxDepth=DEPTH, seed=7).fit(_vectors(rows.where(own)))
    # At most 101 scores: the share of positives at and above each.
    held = (scored(rows.where(~own), trees).groupBy(F.floor(F.col("score") * 100).alias("s"))
            .agg(F.sum(F.col("label") * F.col("weight")).alias("good"),
                 F.sum("weight").alias("n")))
    good = n = 0
    threshold = None
    for r in sorted(held.collect(), key=lambda r: -r.s):
        good, n = good + r.good, n + r.n
        if good >= PRECISION * n:
            threshold = r.s / 100
    return None if threshold is None else (trees, threshold)


def _vectors(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features",
                           handleInvalid="keep").transform(rows)


def scored(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    out = trees.transform(_vectors(rows)).withColumn(
        "score", F.get(vector_to_array("probability"), F.lit(1)))
    return out.drop("features", "rawPrediction", "probability", "prediction")


def added(spans: DataFrame, fitted: tuple[GBTClassificationModel, float] | None) -> DataFrame:
    """The spans to report: base ones, and wide ones that the trees select."""
    keep = ["row", "kind", "order", "start", "end", "base"]
    base = spans.where("base").select(*keep)
    if fitted is None:
        return base
    trees, threshold = fitted
    wide = scored(spans.where(F.col("order") >= len(BASE)), trees).withColumn(
        "score", F.when(F.col("sure"), 1.5).otherwise(F.col("score")))
    wide = wide.where(F.col("score") >= threshold)
    wide = wide.select(*keep, "score", *TIES)
    # Wide spans that overlap a base one go.  Spans that overlap, directly or
    # in a chain, form a set: a new one begins where a span starts at or
    # after all ends before it.
    both = base.withColumn("score", F.lit(2.0))
    for c in TIES:
        both = both.withColumn(c, F.lit(0.0))
    both = both.unionByName(wide)
    by = Window.partitionBy("row").orderBy("start", "end", "order")
    # What follows is taken in falling order: a frame that only grows is
    # summed up row by row, one that shrinks would be read again for each.
    before, after = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (
        by, Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end"), F.desc("order"))))
    own = [F.when(F.col("base"), F.col(c)) for c in ("start", "end")]
    free = both.withColumn("hit", F.coalesce(
        F.max(own[1]).over(before) > F.col("start"), F.lit(False)) | F.coalesce(
        F.min(own[0]).over(after) < F.col("end"), F.lit(False))).where("NOT base AND NOT hit")
    opened = free.withColumn("opens", F.coalesce(
        F.col("start") >= F.max("end").over(before), F.lit(True)).cast("int"))
    sets = opened.withColumn("set", F.sum("opens").over(
        by.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return base.unionByName(best_apart(sets).withColumn("base", F.lit(False)))


def best_apart(sets: DataFrame) -> DataFrame:
    """In each set of spans (``row``, ``set``) the best is taken, then the best
    that overlaps none taken, and so on: (row, kind, order, start, end).

    Sets of at most ``SET_ROWS`` spans are gone through in that order.  In
    larger ones, all at once and in rounds, every span that is better than
    all it overlaps is taken, and what overlaps it goes; that takes the same
    spans.  As equals are ordered by a hash, the number of rounds grows with
    the logarithm of the set, and the work with the set.
    """
    place = Window.partitionBy("row", "set")
    value = [(-F.col("score")).alias("s"), *[F.col(c) for c in TIES],
             (F.col("start") - F.col("end")).alias("l"), F.xxhash64("start").alias("h"),
             F.col("start"), F.col("order"), F.col("end"), F.col("kind")]
    each = stored(sets.select("row", "set", F.struct(*value).alias("x"),
                              F.count(F.lit(1)).over(place).alias("n")), "sets")
    listed = each.where(F.col("n") <= SET_ROWS).groupBy("row", "set").agg(
        F.array_sort(F.collect_list("x")).alias("a"))
    taken = listed.withColumn("t", F.expr(
        "aggregate(a, slice(a, 1, 0), (t, x) -> IF(exists(t, y -> y.start < x.end AND "
        "x.start < y.end), t, concat(t, array(x))))"))
    out = taken.select("row", F.explode("t").alias("x"))
    large = each.where(F.col("n") > SET_ROWS)
    if not large.isEmpty():
        out = out.unionByName(_in_rounds(large.select("row", "set", "x")))
    return out.select("row", "x.kind", "x.order", "x.start", "x.end")


def _in_rounds(spans: DataFrame) -> DataFrame:
    """The spans (row, x) that ``best_apart`` takes of large sets."""
    place = Window.partitionBy("row", "set")
    ranked = spans.select("row", "set", "x", F.row_number().over(place.orderBy("x")).alias("rank"),
                          F.dense_rank().over(place.orderBy("x.start")).alias("first"))
    # A span's cells are the numbers of the starts within it: two spans
    # overlap if they share a cell.  Ends come before starts at one place.
    new = F.row_number().over(Window.partitionBy("row", "set", "first").orderBy("rank")) == 1
    starts = ranked.withColumn("new", new.cast("int"))
    events = starts.withColumn("e", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "at", F.when(F.col("e") == 0, F.col("x.end")).otherwise(F.col("x.start")))
    upto = F.sum(F.col("new") * F.col("e")).over(place.orderBy("at", "e").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    rest = stored(events.withColumn("last", upto).where("e = 0").select(
        "row", "set", "x", "rank", "first", "last"), "cells")
    spans, won = rest, []
    rest = rest.drop("x")
    while not rest.isEmpty():
        cells = rest.select("row", "set", "rank", F.explode(F.sequence("first", "last"))
                            .alias("cell"))
        best = stored(cells.withColumn("best", F.min("rank").over(
            Window.partitionBy("row", "set", "cell"))).drop("cell"), "best")
        wins = stored(best.groupBy("row", "set", "rank").agg(F.min("best").alias("best"))
                      .where("best = rank").select("row", "set", "rank"), "wins")
        won.append(wins)
        gone = best.join(wins.withColumnRenamed("rank", "best"), ["row", "set", "best"],
                         "left_semi")
        rest = stored(rest.join(gone, ["row", "set", "rank"], "left_anti"), "rest")
    taken = won[0]
    for wins in won[1:]:
        taken = taken.unionByName(wins)
    return spans.join(taken, ["row", "set", "rank"], "left_semi").select("row", "x")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
         ) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): stored matches per document, and reported spans."""
    rows = scanned(docs, KINDS, F.col(text_col), id=F.col(id_col))
    spans = stored(described(proposed(rows)), "spans")
    return rows, added(spans, fit(spans))


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, counts of the base kinds, and digests
    and lists of spans by kind and start."""
    rows, spans = find(docs, id_col, text_col)
    out = per_document(rows, spans, [k.name for k in BASE], "s.order AS a, s.start AS b",
                       F.expr("size(filter(every, s -> NOT s.base))").cast("long")
                       .alias("n_added"))
    return out.withColumnRenamed("id", id_col)
