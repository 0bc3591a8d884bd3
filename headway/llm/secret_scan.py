"""Secret scans with corpus-wide ownership frequency.

Three base kinds are found by their form (assignments to names like
``password``, access keys, long hexadecimal runs) and always reported.
Wider generators propose other key-like tokens: after ``=``, ``.`` or any
other separator, whole runs and their parts beside each other, so their spans
may overlap; what lies in a base span or a known form isn't proposed again,
and a run that holds a copied example isn't added.  The hash of every candidate
is counted over the whole corpus by distinct repositories and owners: a
value that many owners hold is a copied example (a key from documentation,
the digest of a common file); one that few owners hold, and that looks
random, is live.  Live tokens of the wider generators are added to the spans.

A repository's owner is what its name has before the first ``/``, or the
whole name.  A value may be in any share of all rows: it is counted per task,
then per (hash, owner, repository), then per hash.

DataFrame functions only.  Defined results: a null text counts as empty; a
document without spans has empty spans.  A null repository is one of its
own.  Repeated rows are scanned one by one and don't change a value's
owners.  Texts of any length are scanned whole, and spans that overlap are
all reported.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.spans import Kind, matches, per_document, scanned
from headway.llm.tables import stored

LIVE_OWNERS = 2          # at most so many owners hold a live value
MAX_SIGNS = 15           # percent of a random token that separators may be
MAX_PIECE = 4            # mean length of a random token's pieces of one case or of digits
MIN_RARE = 15            # percent of its letters that words seldom have, or above
_NAME = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

#: Base kinds in the order in which spans at one place are listed.
BASE = (
    Kind("assign", _NAME, "lower(text) RLIKE 'password|passwd|secret|token|api_?key'"),
    Kind("access", r"AKIA[A-Z0-9]{14,}", "contains(text, 'AKIA')"),
    Kind("hex", r"[0-9a-f]{16,}"),
)
_VENDORS = (r"(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|[rs]k_(?:live|test)_|sk-|npm_|AIza|ya29\.|"
            r"SG\.|A[GS]IA|hf_|pypi-|dop_v1_)")
_PAD = r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?+"
#: Key-like tokens, by four generators whose spans may overlap: known forms
#: (vendors' beginnings, signed web tokens, private key headers) after any
#: separator; whole runs of the characters that keys are made of; and the
#: parts of a run between slashes and pluses, and between any separators.
WIDE = (
    Kind("known", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
                  r"|(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+"
                  rf"|(?<![A-Za-z0-9]){_VENDORS}[A-Za-z0-9_-]{{12,}}+(?:\.[A-Za-z0-9_-]{{16,}}+)?+{_PAD}",
         rf"text RLIKE '-----BEGIN|eyJ|{_VENDORS}'".replace("\\", "\\\\")),
    Kind("run", rf"(?<![A-Za-z0-9+/_-])(?!AKIA)[A-Za-z0-9+/_-]{{20,}}+{_PAD}"),
    Kind("part", rf"(?:(?<=[+/])|(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{{20,}}+[+/]))(?!AKIA)[A-Za-z0-9_-]{{20,}}+{_PAD}",
         "contains(text, '/') OR contains(text, '+')"),
    Kind("word", rf"(?:(?<=[_-])|(?<![A-Za-z0-9])(?=[A-Za-z0-9]{{20,}}+[_-]))(?!AKIA)[A-Za-z0-9]{{20,}}+{_PAD}",
         "contains(text, '-') OR contains(text, '_')"),
)
KINDS = BASE + WIDE
_BEGINNINGS = f"^(?:-----|eyJ|{_VENDORS})"


def candidates(scan: DataFrame) -> DataFrame:
    """Every match with its secret value, and whether it looks random."""
    spans = matches(scan, KINDS, "repository")
    value = F.when(F.col("kind") == "assign",
                   F.regexp_extract("match", _NAME, 2)).otherwise(F.col("match"))
    valued = spans.withColumn("value", value).withColumn("base", F.col("order") < len(BASE))
    plain = F.col("value")
    random = (plain.rlike("[0-9]") & plain.rlike("[A-Za-z]")
              & (F.size(F.array_distinct(F.split(plain, ""))) >= 8)) | plain.startswith("-----")
    # Paths, slugs and names are long runs of the same characters.  Random
    # tokens change between cases and digits every few characters or are rich
    # in letters that words seldom have, and hold few separators: shares of
    # the token's length, so that neither length nor a single case matters.
    def count(others: str) -> Column:
        return F.length(F.regexp_replace(plain, others, ""))

    def every(one: str) -> Column:
        return F.size(F.regexp_extract_all("value", F.lit(one), F.lit(0)))

    solid, letters = count("[^A-Za-z0-9]"), count("[^A-Za-z]")
    signs = F.length("value") - solid
    pieces = every("[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
    rare = count("[^jkqvwxyzJKQVWXYZ]")
    few_signs = signs * 100 <= F.length("value") * MAX_SIGNS
    dense = (solid <= pieces * MAX_PIECE) | (rare * 100 >= letters * MIN_RARE)
    # Without digits only cases change: those of a name do so at its words.
    worded = plain.rlike("[0-9]") | (solid * 2 <= pieces * 5)
    varied = F.size(F.array_distinct(F.split(plain, ""))) >= 8
    random = F.when(F.col("order") < len(BASE), random).otherwise(
        plain.startswith("-----") | varied & (plain.rlike(_BEGINNINGS)
                                              | few_signs & dense & worded))
    chosen = valued.where("kind <> 'assign' OR length(value) >= 12").where(F.col("base") | random)
    # What lies in a base span or a known form isn't proposed again, nor is
    # what two generators propose alike.
    def within(of: Column) -> Column:
        upto = (Window.partitionBy("row").orderBy("start")
                .rangeBetween(Window.unboundedPreceding, Window.currentRow))
        return F.coalesce(F.max(F.when(of, F.col("end"))).over(upto) >= F.col("end"), F.lit(False))

    known = F.col("kind") == "known"
    covered = within(F.col("base")) | (within(known) & ~known)
    alike = F.row_number().over(
        Window.partitionBy("row", "base", "start", "end").orderBy("order"))
    return (chosen.withColumn("covered", covered).where("base OR NOT covered")
            .withColumn("alike", alike).where("base OR alike = 1").select(
        "row", "repository", F.when(F.col("base"), F.col("kind")).otherwise("key").alias("kind"),
        F.least("order", F.lit(len(BASE))).alias("order"), "start", "end", "base",
        random.alias("random"), F.sha2("value", 256).alias("hash")))


def owners(found: DataFrame) -> DataFrame:
    """(hash, n_repositories, n_owners) of every candidate value."""
    held = found.select("hash", "repository", F.substring_index(
        F.coalesce("repository", F.lit("")), "/", 1).alias("owner"))
    return (held.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
            .groupBy("hash", "owner").agg(F.count("one").alias("repositories"))
            .groupBy("hash").agg(F.sum("repositories").alias("n_repositories"),
                                 F.count(F.lit(1)).alias("n_owners")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         repository_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, spans): stored matches per document, and every reported
    span with n_repositories, n_owners and live."""
    rows = scanned(docs, KINDS, F.col(text_col), id=F.col(id_col),
                   repository=F.col(repository_col))
    found = stored(candidates(rows), "candidates")
    counted = stored(owners(found), "owners")
    judged = found.join(counted, "hash").withColumn(
        "live", F.col("random") & (F.col("n_owners") <= LIVE_OWNERS))
    # A run that holds a copied example is that example and what surrounds it.
    example = F.min(F.when(~F.col("base") & ~F.col("live"), F.col("end"))).over(
        Window.partitionBy("row").orderBy("start")
        .rangeBetween(Window.currentRow, Window.unboundedFollowing))
    held = judged.withColumn("holds", F.coalesce(example <= F.col("end"), F.lit(False)))
    return rows, held.where("base OR live AND NOT holds").drop("holds")


def scan_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                repository_col: str = "source") -> DataFrame:
    """One row per document: the id, counts of the base kinds, digests and
    lists of spans by start, and how many spans are live or examples."""
    rows, spans = scan(docs, id_col, text_col, repository_col)
    out = per_document(
        rows, spans.select("row", "kind", "order", "start", "end", "base", "live"),
        [k.name for k in BASE], "s.start AS a, s.order AS b",
        F.expr("size(filter(every, s -> s.live))").cast("long").alias("n_live"),
        F.expr("size(filter(every, s -> NOT s.live))").cast("long").alias("n_example"))
    return out.withColumnRenamed("id", id_col)
