"""Quality rules of documents and of their hosts, in column expressions only.

``document_measures`` measures whole texts; ``rules`` says which rules a document
fails. ``host_verdicts`` sums failures by host, shrinks each host's rates towards
those of all hosts with a beta prior fitted to the hosts (method of moments), and
rejects hosts whose shrunken rate of some rule exceeds a limit; a host with few
documents stays close to the others' rate. ``judge`` joins the verdicts back.

Null texts have no words and fail the base rule. Documents without a host share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.llm.common import join_unique
from sparkq.plans.staging import stage

# White space of words, and the symbols counted.
BLANKS = " \t\n\x0b\x0c\r"
BLANK = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
# Shares in percent beyond which a document fails a rule.
REPEATED_WORDS, SYMBOL_CHARS, REPEATED_LINES = 50, 10, 50
RULES = ("short", "repetitive", "symbols", "lines")
# A host is rejected if a shrunken failure rate is above this.
HOST_LIMIT = 0.5


def _trim(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def document_measures(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of each row,
    behind the columns ``keep`` as __keep0, __keep1 and so on.

    Windows of three words are compared by 64-bit hashes. Only texts in which a
    window comes twice sort their windows.
    """
    keep_names = [f"__keep{i}" for i in range(len(keep))]
    kept = [c.alias(n) for c, n in zip(keep, keep_names)]
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: _trim(line) != "")
    rows = docs.select(
        *kept,
        F.when(_trim(whole) == "", F.array().cast("array<string>"))
        .otherwise(F.split(_trim(whole), BLANK))
        .alias("words"),
        F.length(F.translate(whole, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    rest = [*keep_names, "word_chars", "n_symbols"]

    def word(i: Column, ahead: int) -> Column:
        return F.get(F.col("words"), i + ahead)

    windows = F.when(
        F.size("words") >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("words") - 3),
            lambda i: F.xxhash64(word(i, 0), word(i, 1), word(i, 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        *rest,
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    rest += ["n_words", "n_lines", "n_dup_lines"]
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.array_sort(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    )
    rows = rows.select(
        *rest,
        F.when(repeats, placed)
        .otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
        .alias("placed"),
    )

    def hash_at(i: Column) -> Column:
        return F.get(F.col("placed"), i)["h"]

    # Out of bounds is null, and a comparison with null chooses nothing.
    twice = F.transform(
        "placed",
        lambda w, i: F.when((w["h"] == hash_at(i - 1)) | (w["h"] == hash_at(i + 1)), w["p"]),
    )
    rows = rows.select(*rest, F.array_sort(F.array_compact(twice)).alias("starts"))
    # A repeated window covers three words, or as many as there are up to the next one.
    covered = F.aggregate(
        F.transform(
            "starts", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("starts"), i + 1) - p, F.lit(3)))
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return rows.select(
        *[F.col(n) for n in keep_names],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        covered.alias("n_repeat_words"),
    )


def failed(rule: str) -> Column:
    """Whether the measures of a document fail a rule."""
    words, chars = F.col("n_words"), F.col("word_chars")
    return {
        "short": words < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > REPEATED_WORDS * words,
        "symbols": 100 * F.col("n_symbols") > SYMBOL_CHARS * chars,
        "lines": 100 * F.col("n_dup_lines") > REPEATED_LINES * F.col("n_lines"),
    }[rule]


def base_failed() -> Column:
    return failed("short") | failed("repetitive")


def host_verdicts(measures: DataFrame, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: n documents, shrunken rates per rule, and ``rejected``."""
    hosts = stage(
        measures.groupBy(host).agg(
            F.count(F.lit(1)).alias("n"), *[F.count(F.when(failed(r), 1)).alias(r) for r in RULES]
        ),
        "hosts",
    )
    # Five numbers per rule come back: the moments of the hosts' rates.
    total = F.sum("n")
    means = hosts.agg(total.alias("n"), F.count(F.lit(1)).alias("hosts"), *[F.sum(r).alias(r) for r in RULES]).first()
    if not means["n"]:
        return hosts.withColumn("rejected", F.lit(False))
    n = means["n"]
    mean = {r: means[r] / n for r in RULES}
    spread = hosts.agg(
        *[(F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - mean[r], 2)) / n).alias(r) for r in RULES]
    ).first()
    rates = {}
    for r in RULES:
        # Variance between hosts: what is left of the spread beyond sampling.
        noise = mean[r] * (1 - mean[r])
        between = max(spread[r] - noise * means["hosts"] / n, 1e-6)
        strength = max(noise / between - 1, 1.0)
        rates[r] = (F.col(r) + mean[r] * strength) / (F.col("n") + strength)
    worst = F.greatest(*rates.values())
    return hosts.select(
        host, "n", *[v.alias(f"{r}_rate") for r, v in rates.items()], (worst > limit).alias("rejected")
    )


def judge(docs: DataFrame, doc_id: str, text: str, host: str, limit: float = HOST_LIMIT) -> DataFrame:
    """Measures of every document, ``base_failed``, and ``kept``: it passes the base
    rules and its host is not rejected."""
    # A null host is a host of its own.
    key = F.when(F.col(host).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(host)))
    measures = stage(
        document_measures(docs, text, F.col(doc_id), key)
        .withColumnsRenamed({"__keep0": "doc_id", "__keep1": "host"})
        .withColumn("base_failed", base_failed()),
        "measures",
    )
    verdicts = stage(host_verdicts(measures, "host", limit).select("host", "n", "rejected"), "verdicts")
    return join_unique(measures, verdicts, "host", "n").withColumn(
        "kept", ~F.col("base_failed") & ~F.col("rejected")
    )
