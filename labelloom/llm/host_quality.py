"""Quality rules judged by host.

Every document is measured and held against soft rules. A soft rule alone does
not reject: failures are counted per host, the host's failure rate is shrunk
towards the rates of all hosts by an empirical beta prior, and only hosts whose
shrunk rate is high make the rule count against their documents. So one odd
page of a sound host stays, and a host with two pages isn't condemned by one.
A document that breaks no rule stays, whatever its host. The base rules (too
few words, mostly repeats) reject wherever they are broken.

Defined results for odd input: a null text has no words and fails the base
rules, as an empty one does; a null host counts as the host ''; rows that repeat
an id are judged and counted one by one; an empty table gives an empty result.
Columns other than id, text and host are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from labelloom.llm.shared import ROW, SPACE, attach, let, numbered, without, words
from labelloom.operators.pin import settle, settle_alone

#: Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Soft rules over the measures; each says what breaks it.
SOFT_RULES = {
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 3 * n_words or word_chars > 10 * n_words",
    "repeats": "5 * n_repeat_words > n_words",
}

#: A host breaks a rule when its shrunk failure rate is above this.
MAX_HOST_RATE = 0.3

#: The prior counts as many documents of a host at most, and one at least.
MAX_STRENGTH = 1000.0

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def repeated_words(found: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more in the array of words ``found``.

    Windows are compared by a 64-bit hash. Sorting (hash, position) brings equal
    windows together, so the cost is n log n for texts of any length.
    """

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        window = lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p"))
        return let(F.sort_array(F.transform(starts, window)), covered)

    def covered(s: Column) -> Column:
        like = lambda x, i: F.coalesce(x["h"] == F.get(s, i)["h"], F.lit(False))
        again = F.filter(s, lambda x, i: like(x, i - 1) | like(x, i + 1))
        return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)))))

    return let(found, lambda w: F.when(F.size(w) < 4, 0).otherwise(of(w)))


def measure(text: Column) -> Column:
    """A struct of MEASURES."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    by_line = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return F.struct(
        counted["n_words"].alias("n_words"),
        F.length(F.regexp_replace(whole, SPACE + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(whole, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        by_line["n_lines"].cast("long").alias("n_lines"),
        by_line["n_dup_lines"].cast("long").alias("n_dup_lines"),
        counted["n_repeat_words"].alias("n_repeat_words"),
    )


def host_counts(measured: DataFrame) -> DataFrame:
    """Per host: documents, and how many break each rule."""
    broken = [F.sum(F.col(rule).cast("long")).alias(rule) for rule in SOFT_RULES]
    return measured.groupBy("host").agg(F.count(F.lit(1)).alias("n_host"), *broken)


def beta_priors(hosts: DataFrame) -> dict[str, tuple[float, float]]:
    """Rule -> (alpha, beta), by the moments of the hosts' failure rates.

    With rates r of hosts of n documents around the common rate m, the sum of
    n * (r - m)^2 is m * (1 - m) for each host by chance alone, and more by the
    correlation c of documents of a host: m * (1 - m) * (1 + (n - 1) * c). The
    prior counts as 1 / c - 1 documents. No correlation gives the strongest one.
    """
    sums = []
    for rule in SOFT_RULES:
        failures = F.col(rule).cast("double")
        sums += [F.sum(rule).alias(rule), F.sum(failures * failures / F.col("n_host")).alias(f"{rule}_squares")]
    row: Row = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n_host").alias("documents"), *sums).first()
    priors = {}
    for rule in SOFT_RULES:
        mean = (row[rule] or 0) / (row["documents"] or 1)
        chance = mean * (1 - mean)
        extra = (row[f"{rule}_squares"] or 0.0) - mean * (row[rule] or 0) - chance * row["hosts"]
        room = chance * ((row["documents"] or 0) - row["hosts"])
        strength = room / extra - 1 if extra > 0 else MAX_STRENGTH
        strength = min(max(strength, 1.0), MAX_STRENGTH)
        priors[rule] = (mean * strength, (1 - mean) * strength)
    return priors


def host_verdicts(hosts: DataFrame) -> DataFrame:
    """``host, n_host`` and, per rule, the shrunk rate ``<rule>_rate`` and whether it is too high ``<rule>_host``."""
    columns = []
    for rule, (alpha, beta) in beta_priors(hosts).items():
        rate = (F.col(rule) + alpha) / (F.col("n_host") + alpha + beta)
        columns += [rate.alias(f"{rule}_rate"), (rate > MAX_HOST_RATE).alias(f"{rule}_host")]
    return hosts.select("host", "n_host", *columns)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, measures, ``base_failed``, broken soft rules, ``kept``.

    Texts are read once, in place; what is shuffled afterwards are a dozen
    numbers per document. Hosts are counted in each task before the shuffle and
    their verdicts come back without gathering a large host in one task.
    """
    measured = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(host_col), F.lit("")).alias("host"), measure(F.col(text_col)).alias("m")
    ).select("id", "host", *[F.col("m")[x].alias(x) for x in MEASURES])
    measured = settle(measured.select("*", *[F.expr(broken).alias(rule) for rule, broken in SOFT_RULES.items()]))
    verdicts = settle(host_verdicts(settle(host_counts(measured))))
    judged = attach(measured, verdicts, "host", "n_host", measured.count())
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    against = F.lit(False)
    for rule in SOFT_RULES:
        against = against | (F.col(rule) & F.col(f"{rule}_host"))
    return judged.select(
        F.col("id").alias(id_col), *MEASURES, base_failed.alias("base_failed"), (~base_failed & ~against).alias("kept"), *SOFT_RULES
    )


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, with all their columns. A verdict is for its row alone, whatever rows share the id."""
    rows = numbered(docs)
    rejected = settle_alone(lambda: judge(rows, ROW, text_col, host_col).where("not kept").select(ROW))
    return without(rows, rejected).select(*docs.columns)
