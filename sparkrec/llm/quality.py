"""Host-level quality rules (operator 7, DataFrame functions only).

Each document gets its own counts and a base verdict. The failures are
aggregated by host, each host's failure rate is shrunk towards an empirical
beta prior (method of moments over all hosts), and hosts whose shrunk rate is
above ``max_host_rate`` are rejected; the verdict is joined back to the
documents. The counts are written once, without the texts, so the texts are
read a single time and only counts are shuffled: one partial row per host and
task, so a hot host is no hot task. Two scalars (the prior) reach the driver.

Edge cases: a null or empty text has no words and fails the base rule; a null
host is a host of its own; repeated rows are separate documents; a table with
one host, or whose hosts all have the same rate, has the prior strength 1; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import BLANK, documents, let, pick, scratch
from sparkrec.plans.joins import bounded_side

WINDOW = 8
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a window of ``window`` words that occurs twice or more."""

    def covered(hashes):
        def of_sorted(s):
            twice = F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]))
            return let(F.array_sort(F.transform(twice, lambda e: e["i"])), of_positions)

        def of_positions(p):
            reach = F.transform(p, lambda x, j: F.least(F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window))))
            return F.aggregate(reach, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

        located = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(let(located, of_sorted))

    def of_words(h):
        starts = F.sequence(F.lit(1), F.size(h) - F.lit(window - 1))
        return F.when(F.size(h) <= window, F.lit(0).cast("bigint")).otherwise(
            let(F.transform(starts, lambda i: F.xxhash64(F.slice(h, i, F.lit(window)))), covered)
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def measures(text: Column) -> dict[str, Column]:
    """Counts of one text; null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    n_and_repeats = let(words_of(t), lambda w: F.struct(F.size(w).cast("bigint").alias("n"), repeated_words(w).alias("r")))
    return {
        "words": n_and_repeats,
        "word_chars": F.length(F.translate(t, BLANKS, "")).cast("bigint"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": dup.cast("bigint"),
    }


def document_rules(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """Counts and base verdict of each document, without its text."""
    m = measures(F.col("text"))
    counted = pick(docs, doc_id=doc_id, text=text, source=host).select("doc_id", "source", *[c.alias(k) for k, c in m.items()])
    counted = counted.select(
        "doc_id", F.col("source").alias("host"), F.col("words.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("words.r").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return counted.withColumn("base_failed", failed)


def host_verdicts(rules: DataFrame, max_host_rate: float) -> DataFrame:
    """``host, n, failures, host_rate, host_kept``: rates shrunk by a beta prior fitted to all hosts."""
    hosts = rules.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("bigint")).alias("failures"))
    rate = F.col("failures") / F.col("n")
    fit = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v")).first()
    m, v = fit["m"] or 0.0, fit["v"] or 0.0
    strength = m * (1 - m) / v - 1 if 0 < v < m * (1 - m) else 1.0
    shrunk = (F.col("failures") + F.lit(m * strength)) / (F.col("n") + F.lit(strength))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_kept", shrunk <= max_host_rate)


def host_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", max_host_rate: float = 0.5) -> DataFrame:
    """Per document: its counts, ``base_failed``, the host's shrunk rate and ``kept``."""
    ws = scratch(docs.sparkSession, "quality")
    rules = ws.materialize(document_rules(docs, doc_id, text, host), "rules")
    verdicts = ws.materialize(host_verdicts(rules, max_host_rate), "hosts")
    size = verdicts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.octet_length("host")), F.lit(0)).alias("w")).first()
    side = bounded_side(verdicts.select(F.col("host").alias("of_host"), "host_rate", "host_kept"), size["n"], 64 + size["w"])
    joined = rules.join(side, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))


def op7_host_quality(spark, sf_dir: str) -> DataFrame:
    return host_quality(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


OP7_SQL = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, unnest(generate_series(1, len(ws) - 7)) AS i, ws FROM w WHERE len(ws) >= 8),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 7]) AS c FROM g),
p AS (SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS reach FROM k WHERE c >= 2),
r AS (SELECT doc_id, sum(reach)::BIGINT AS n FROM p GROUP BY 1),
m AS (
  SELECT w.doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(base_failed::INT) AS f FROM b GROUP BY 1),
e AS (SELECT avg(f / n) AS m, var_pop(f / n) AS v FROM h),
s AS (SELECT m, CASE WHEN v > 0 AND v < m * (1 - m) THEN m * (1 - m) / v - 1 ELSE 1 END AS strength FROM e),
q AS (SELECT source, (f + m * strength) / (n + strength) <= 0.5 AS ok FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept
FROM b JOIN q ON b.source IS NOT DISTINCT FROM q.source
"""
