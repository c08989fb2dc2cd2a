"""Quality rules: base rules on each text, and verdicts on hosts.

Measures come from the whole text in one pass. The rules of a document are
summed up by host (the column ``source``, or any other the caller names): how
many of its documents fail any rule. Hosts of few documents say little, so the
rates are shrunk towards the mean of all documents by a beta prior, fitted to the
rates of the hosts by moments, less the spread that chance gives small hosts. A host whose shrunken rate passes
``HOST_RATE`` is bad; the verdict goes back to its documents. A document of a
bad host is dropped if it fails a rule itself; a clean document stays wherever
it is from.

Null texts have no words. A null host is a host of its own. Without documents
there is no host. All measures of a repeated row repeat.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.llm.common import map_rows
from broadsheet.plans.skew import salted_join
from broadsheet.plans.storage import stored

MIN_WORDS = 50
REPEATED_PERCENT = 50
SYMBOL_PERCENT = 10  # symbols, of the characters in words
DUP_LINE_PERCENT = 30
MEAN_WORD = (2, 15)  # characters
HOST_RATE = 0.5
LEAST_PRIOR = 2.0  # documents that the prior counts for at least

# The symbols counted.
SYMBOLS = "#*$%&|<>"


def repeated_words(words: list[str]) -> int:
    """Words in windows of three words that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) < 2_000_000:
        windows = pairs[:-1] * len(number) + ids[2:]
    else:  # the product would pass 64 bits
        windows = np.unique(pairs, return_inverse=True)[1][:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words of a text."""
    text = text or ""
    words = split_words(text)
    lines = Counter(text.split("\n"))
    filled = {line: n for line, n in lines.items() if has_word(line)}
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in SYMBOLS),
        sum(filled.values()) - len(filled),
        sum(filled.values()),
        repeated_words(words),
    )


def split_words(text: str) -> list[str]:
    """Runs of anything but the six ASCII white-space characters."""
    if text.isascii() and not _separators(text):
        return text.split()
    return [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]


def _separators(text: str) -> bool:
    """Whether str.split() would also cut at one of the ASCII separators 1C to 1F."""
    return any(c in text for c in "\x1c\x1d\x1e\x1f")


def has_word(line: str) -> bool:
    return bool(line.strip(" \t\n\r\x0b\x0c"))


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the measures of every row."""

    def row(doc_id, name, text) -> Iterator[tuple]:
        yield doc_id, name, *measures(text)

    return map_rows(
        docs.select("doc_id", F.col(host).cast("string"), "text"),
        "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
        " n_lines long, n_repeat_words long",
        row,
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(REPEATED_PERCENT) * F.col("n_words")
    )


def rule_failed() -> Column:
    """A base rule or one of the further rules."""
    return (
        base_failed()
        | (F.lit(100) * F.col("n_symbols") > F.lit(SYMBOL_PERCENT) * F.col("word_chars"))
        | (F.lit(100) * F.col("n_dup_lines") > F.lit(DUP_LINE_PERCENT) * F.col("n_lines"))
        | (F.col("word_chars") < F.lit(MEAN_WORD[0]) * F.col("n_words"))
        | (F.col("word_chars") > F.lit(MEAN_WORD[1]) * F.col("n_words"))
    )


def host_rates(rows: DataFrame) -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk by the prior of all hosts."""
    hosts = rows.groupBy("host").agg(
        F.count(F.lit(1)).alias("documents"), F.count(F.when(F.col("failed"), 1)).alias("failures")
    )
    hosts = stored(hosts, "hosts")
    f, n = F.col("failures"), F.col("documents")
    total, count, failed, squares, sizes = hosts.agg(
        F.sum(n), F.count(F.lit(1)), F.sum(f), F.sum(f.cast("double") * f / n), F.sum(n.cast("double") * n)
    ).first()
    mean, weight = prior(total or 0, count, failed or 0, squares or 0.0, sizes or 0)
    return hosts.withColumn("rate", (f + F.lit(mean * weight)) / (n + F.lit(weight)))


def prior(total: int, hosts: int, failed: int, squares: float, sizes: float) -> tuple[float, float]:
    """Mean and weight (alpha + beta) of the beta prior, by moments of rates weighed by documents.

    What rates of so many documents would differ by chance alone is taken off
    their spread. Where nothing is left of it the hosts are alike, and the prior
    weighs as much as all documents.
    """
    mean = failed / total if total else 0.0
    noise = mean * (1 - mean)
    scale = total - sizes / total if total else 0.0
    spread = (squares - failed * mean - noise * (hosts - 1)) / scale if scale > 0 else 0.0
    if spread <= 0:
        return mean, float(max(total, LEAST_PRIOR))
    return mean, max(LEAST_PRIOR, noise / spread - 1)


def judged(docs: DataFrame, host: str = "source", most: float = HOST_RATE) -> DataFrame:
    """Every row with its measures, its own rules, its host's rate, and ``kept``."""
    rows = stored(measured(docs, host).withColumn("failed", rule_failed()), "measures")
    rates = host_rates(rows)
    named = lambda frame: frame.withColumn("_none", F.col("host").isNull()).withColumn(
        "_name", F.coalesce("host", F.lit(""))
    )
    joined = salted_join(
        named(rows), named(rates).select("_none", "_name", F.col("rate").alias("host_rate")),
        ["_none", "_name"], named(rates), "documents", ["doc_id"],
    )
    return joined.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), "failed", "host_rate",
        (~base_failed() & ~(F.col("failed") & (F.col("host_rate") > F.lit(most)))).alias("kept"),
    )
