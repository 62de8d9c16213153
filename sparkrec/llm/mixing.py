"""Mixing sources to target weights (operator 5).

Every document gets a hash-random key. Within a source the documents are
ordered by that key: the key's range is cut into equal buckets, bucket sums
give each bucket's offset and a window inside the bucket gives the running
sum, so a source with a third of all rows is spread over as many buckets as
any other and no task holds a source whole. The mix takes whole epochs of a
source while its budget allows, and the last epoch is cut at the exact word
(a document there may be taken in part).

Budgets: sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ...
and share the total size; a source's target stops at ``max_epochs`` times its
size and the excess is shared again by weight among the others.

Edge cases: a null text has size 0 and is taken 0 times; a null ``source`` is
a source of its own, the last; a null ``doc_id`` hashes as the empty string;
repeated rows are separate documents with the same key, taken one after the
other (which of two equal rows is first can't be told from the result); an
empty table gives an empty result; a corpus of size 0 takes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import documents, hash_buckets, pick, scratch, word_count
from sparkrec.plans.joins import bounded_side

WEIGHTS = (5, 2, 1)
KEY_RANGE = 1 << 48


def budgets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, max_epochs: int = 3) -> list[tuple[str | None, int, float, int]]:
    """``(source, size, target, budget)`` per source; budget is the target's whole words.

    Water filling: the sources whose cap per weight is below the common level
    are held at their cap, the others share the rest by weight. All sums are
    integers, so the level is exact.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    share = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    rest, open_weight = sum(n for _, n in sizes), sum(share.values())
    held = {}
    for s, n in sorted(order, key=lambda x: x[1] / share[x[0]]):
        if max_epochs * n * open_weight >= share[s] * rest:
            break
        held[s] = max_epochs * n
        rest -= held[s]
        open_weight -= share[s]
    return [
        (s, n, float(held[s]), held[s]) if s in held else (s, n, share[s] * rest / open_weight, share[s] * rest // open_weight)
        for s, n in order
    ]


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken, text_key``.

    The driver sees one ``(source, size)`` row per source, no document.
    """
    spark = docs.sparkSession
    key = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10)
    sized = pick(docs, doc_id=doc_id, text=text, source=source).select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), key.cast("bigint").alias("key"), F.xxhash64("text").alias("text_key")
    )
    sized = scratch(spark, "mix").materialize(sized, "sized")
    totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    plan = budgets([(r["source"], r["size"]) for r in totals], weights, max_epochs)
    buckets = hash_buckets(sum(r["n"] for r in totals))
    table = spark.createDataFrame(plan, "source string, source_size bigint, target double, budget bigint").withColumnRenamed("source", "of_source")
    bucketed = sized.withColumn("bucket", F.floor(F.col("key") / F.lit(float(KEY_RANGE)) * F.lit(buckets)).cast("int"))
    before = (
        bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("sum"))
        .withColumn("offset", F.sum("sum").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
        .select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"), F.coalesce("offset", F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(before, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("bucket") == F.col("b_bucket")))
    width = 64 + max((len((s or "").encode()) for s, *_ in plan), default=0)
    placed = placed.join(bounded_side(table, len(plan), width), F.col("source").eqNullSafe(F.col("of_source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    rest = F.col("budget") - epochs * F.col("source_size") - F.col("offset") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.cast("bigint").alias("taken"), "text_key")


def copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as rows: every row of ``docs``, with all its columns, as often as the mix takes it.

    The one document a source's budget cuts is taken whole or not, whichever
    is nearer; documents that are taken 0 times, or have no words, go.
    """
    ws = scratch(docs.sparkSession, "mix-copies")
    taken = mix(docs, doc_id, text, source, **options).where("size > 0")
    times = taken.groupBy(F.col("doc_id").alias("mix_id"), F.col("text_key").alias("mix_key")).agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("mix_times")
    )
    times = ws.materialize(times.where("mix_times > 0"), "times")
    key = F.xxhash64(docs[f"`{text}`"].cast("string"))
    whole = docs.select(F.struct("*").alias("row"), docs[f"`{doc_id}`"].cast("bigint").alias("row_id"), key.alias("row_key"))
    joined = whole.join(times, F.col("row_id").eqNullSafe(F.col("mix_id")) & (F.col("row_key") == F.col("mix_key")))
    return joined.select("row", F.explode(F.sequence(F.lit(1), F.col("mix_times")))).select("row.*")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT AS key
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS s,
         [5, 2, 1][((row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST)) - 1) % 3 + 1]::BIGINT AS w
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY s / w, source NULLS LAST) AS r, sum(s) OVER () AS total,
         coalesce(sum(3 * s) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(w) OVER (ORDER BY s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM src),
first_open AS (SELECT min(r) AS r0 FROM ranked WHERE 3 * s * open_w >= w * (total - held)),
level AS (SELECT r0, total - held AS rest, open_w AS all_w FROM ranked, first_open WHERE r = r0),
plan AS (
  SELECT source, s AS source_size, CASE WHEN r < r0 THEN (3 * s)::DOUBLE ELSE (w * rest)::DOUBLE / all_w::DOUBLE END AS target,
         CASE WHEN r < r0 THEN 3 * s ELSE (w * rest) // all_w END AS budget
  FROM ranked, level),
placed AS (
  SELECT z.doc_id, z.size, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN p.budget // p.source_size ELSE 0 END AS epochs, p.budget,
         coalesce(sum(z.size) OVER (PARTITION BY z.source ORDER BY z.key, z.doc_id, z.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized z JOIN plan p ON z.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM placed
"""
