"""Importance resampling towards a target text (operator 11).

A text's features are its words and pairs of neighbouring words, hashed into
buckets. A bucket's gain is the scaled log ratio of its smoothed shares in the
target and in the corpus; a text's weight is the floored mean gain of its
features. Weight plus a Gumbel number from the id's hash is the score, so that
the highest scores are a draw without replacement in proportion to the
exponential of the weights.

Weights come from arrays: a task works on the bytes of many texts at once (word
bounds from a byte table, checksums of all words in step, the gains looked up
by bucket). Bucket counts are added up in each task and summed by Spark; the
driver sees one number a bucket.

The cut is found by weighted median of medians: every partition gives the
median of the keys it has left, the median of these medians, weighted by how
many keys each stands for, is the next pivot, and everything on the wrong side
of it (at least a quarter) is discarded. One pass counts a pivot and finds the
medians on both of its sides. The keys that are left are written anew once
they are under an eighth of the table read; at most ``FINISH`` keys are ordered
directly. The winners are then range-sorted, and ranks are prefix sums over the
ranges (a window over one row per ``RANGE_ROWS`` winners).

Edge cases: a null text has no features; a text without features has weight 0;
a null ``doc_id`` hashes as the empty string and comes last among ties; equal
scores go by ``doc_id``, then the text's hash; repeated rows are separate
documents with neighbouring ranks (or only some of them are drawn, at the
cut); an empty table gives an empty result and an empty target gains that only
the smoothing tells apart; a very long text is worked on whole, at about 20
bytes of memory a byte. Other columns, whatever they are called, have no
effect and are not returned.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import documents, hash_buckets, scratch
from sparkrec.plans.joins import bounded_side

BUCKETS = 10_000
SCALE = 1000
MIN_WORDS = 20
PERCENT = 25
SEED = "7"
FINISH = 10_000
RANGE_ROWS = 20_000
CHUNK_BYTES = 1 << 22
LONG_WORD = 64
LAST = (1 << 63) - 1

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


_CRC = _crc_table()


class _Words:
    """Words of several texts in one byte array: where they start, how long they are, whose they are."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = _LOWER[data]
        inside = _IN_WORD[self.data]
        first = np.zeros(len(data) + 1, bool)
        first[:-1] = inside
        first[1:-1] &= ~inside[:-1]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges] = inside[edges]  # no word crosses from text to text
        last = inside.copy()
        last[:-1] &= ~inside[1:] | first[1:-1]
        self.starts = np.flatnonzero(first)
        self.lengths = np.flatnonzero(last) + 1 - self.starts
        self.text = np.searchsorted(offsets, self.starts, side="right") - 1
        # longest first, so that the words still running are always a prefix
        clipped = np.minimum(self.lengths, LONG_WORD + 1).astype(np.int16)
        self.order = np.argsort(-clipped, kind="stable")
        self.longer = np.searchsorted(-clipped[self.order], -np.arange(LONG_WORD + 1), side="left")

    def checksums(self, before: np.ndarray) -> np.ndarray:
        """CRC-32 of every word, each going on from the checksum ``before`` it."""
        order, n_long = self.order, self.longer[LONG_WORD]
        starts, state = self.starts[order], ~before[order]
        for at, end in enumerate(self.longer[:LONG_WORD]):
            if end <= n_long:
                break
            part = state[n_long:end]
            state[n_long:end] = _CRC[(part ^ self.data[starts[n_long:end] + at]) & 255] ^ (part >> 8)
        out = np.empty_like(state)
        out[order] = ~state
        for w in order[:n_long]:
            out[w] = zlib.crc32(self.data[self.starts[w] : self.starts[w] + self.lengths[w]].tobytes(), int(before[w]))
        return out

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Checksums of all words and of all pairs of neighbours, and the texts they are of."""
        single = self.checksums(np.zeros(len(self.starts), np.uint32))
        follows = np.flatnonzero(self.text[1:] == self.text[:-1]) + 1
        before = np.zeros(len(single), np.uint32)
        state = ~single[follows - 1]
        before[follows] = ~(_CRC[(state ^ 32) & 255] ^ (state >> 8))
        pairs = self.checksums(before)[follows]
        return np.concatenate([single, pairs]), np.concatenate([self.text, self.text[follows]])


def _parts(column: pa.Array):
    """``(first row, rows, _Words)`` for about ``CHUNK_BYTES`` of text at a time."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + CHUNK_BYTES, side="right")) - 1)
        yield start, end - start, _Words(data[bounds[start] : bounds[end]], bounds[start:end] - bounds[start])
        start = end


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts (the first column) by bucket; the driver gets one row a bucket."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, words in _parts(batch.column(0)):
                counts += np.bincount(words.features()[0] % buckets, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Floored, scaled log ratio of the smoothed shares, by bucket."""
    buckets, all_s, all_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log((float(t + 1) * float(all_s + buckets)) / (float(s + 1) * float(all_t + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed: str = SEED, scale: int = SCALE) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: str = SEED, scale: int = SCALE) -> DataFrame:
    """``doc_id, tie, n_words, n_features, weight, score`` of ``docs(doc_id, tie, text)``."""
    names = ["doc_id", "tie", "n_words", "n_features", "weight", "score"]

    def run(batches):
        for batch in batches:
            for start, n, words in _parts(batch.column(2)):
                marks, text = words.features()
                sums = np.zeros(n, np.int64)
                np.add.at(sums, text, gain[marks % len(gain)])
                features = np.bincount(text, minlength=n)
                weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
                ids, tie = batch.column(0).slice(start, n), batch.column(1).slice(start, n)
                score = weight + np.array([noise(i, seed, scale) for i in ids.to_pylist()], np.int64)
                own = [np.bincount(words.text, minlength=n), features, weight, score]
                yield pa.RecordBatch.from_arrays([ids, tie, *map(pa.array, own)], names=names)

    return docs.mapInArrow(run, "doc_id bigint, tie bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


# A key is (-score, doc_id), smallest first; a null id counts as the largest.
def _id() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(LAST))


def _below(key: tuple[int, int], inclusive: bool = False) -> Column:
    """Rows whose key is before ``key`` (or is it)."""
    score, i = -key[0], key[1]
    last = (_id() <= i) if inclusive else (_id() < i)
    return (F.col("score") > score) | ((F.col("score") == score) & last)


def _medians(low, pivot, high):
    """A partition's keys between ``low`` and ``high``: how many are before, at and
    after the pivot, and the median keys of the first and the last of these."""

    def run(batches):
        keys = [np.zeros((0, 2), np.int64)]
        for batch in batches:
            keys.append(np.stack([-batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1))
        keys = np.concatenate(keys)
        keys = keys[np.lexsort((keys[:, 1], keys[:, 0]))]

        def until(key, side):
            lo, hi = (np.searchsorted(keys[:, 0], key[0], side=s) for s in ("left", "right"))
            return lo + np.searchsorted(keys[lo:hi, 1], key[1], side=side)

        start = 0 if low is None else until(low, "right")
        end = len(keys) if high is None else until(high, "left")
        a, b = (end, end) if pivot is None else (until(pivot, "left"), until(pivot, "right"))
        left, right = keys[start:a], keys[b:end]
        half = lambda part: part[(len(part) - 1) // 2].tolist() if len(part) else None
        row = [[len(left)], [b - a], [len(right)], [half(left)], [half(right)]]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=["before", "at", "after", "left", "right"])

    return run


def _weighted_median(pairs: list[tuple[tuple[int, int], int]]) -> tuple[int, int]:
    pairs = sorted(pairs)
    half, total = sum(n for _, n in pairs) / 2, 0
    for key, n in pairs:
        total += n
        if total >= half:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, k: int, rows: int, ws, finish: int = FINISH) -> tuple[int, int]:
    """The ``k``-th smallest key of ``keys(score, doc_id)``, a written table of ``rows`` rows, 1 <= k <= rows.

    The driver holds one row per partition of the table.
    """
    low = pivot = high = None
    table, size, left = keys, rows, rows

    def remaining():
        part = table
        if low is not None:
            part = part.where(~_below(low, inclusive=True))
        return part.where(_below(high)) if high is not None else part

    while left > finish or pivot is None:
        counts = remaining().select("score", _id().alias("doc_id")).mapInArrow(
            _medians(low, pivot, high), "before bigint, at bigint, after bigint, left array<bigint>, right array<bigint>").collect()
        before, at, after = (sum(r[c] for r in counts) for c in ("before", "at", "after"))
        if k <= before:
            high, side, left = pivot, [(tuple(r["left"]), r["before"]) for r in counts if r["before"]], before
        elif k <= before + at:
            return pivot
        else:
            low, side, left, k = pivot, [(tuple(r["right"]), r["after"]) for r in counts if r["after"]], after, k - before - at
        pivot = _weighted_median(side)
        if left * 8 < size:
            table, size = ws.materialize(remaining(), "left"), left
    last = remaining().select("score", _id().alias("doc_id")).orderBy(F.col("score").desc(), "doc_id").limit(k).collect()[-1]
    return -last["score"], last["doc_id"]


def ranked(rows: DataFrame, ws, range_rows: int = RANGE_ROWS) -> DataFrame:
    """A written table's rows with ``place``, their rank by score, id and text hash."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("tie").asc_nulls_last(), F.col("file"), F.col("line")]
    placed = rows.select("*", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line"))
    ranges = hash_buckets(rows.count(), range_rows)
    placed = ws.materialize(placed.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ws.materialize(sizes.select(F.col("range").alias("of_range"), F.coalesce(before, F.lit(0)).alias("offset")), "offsets")
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    joined = placed.withColumn("inside", inside).join(bounded_side(offsets, ranges, 64), F.col("range") == F.col("of_range"))
    return joined.select(*rows.columns, (F.col("offset") + F.col("inside")).cast("bigint").alias("place"))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", target_text: str = "text", percent: int = PERCENT,
             min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: str = SEED, finish: int = FINISH, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn.

    Drawn are the ``percent`` of the documents with at least ``min_words`` words that score highest.
    """
    ws = scratch(docs.sparkSession, "resample")
    body = docs[f"`{text}`"].cast("string")
    gain = gains(bucket_counts(docs.select(body), buckets), bucket_counts(target.select(target[f"`{target_text}`"].cast("string")), buckets))
    rows = ws.materialize(scored(docs.select(docs[f"`{doc_id}`"].cast("bigint").alias("doc_id"), F.xxhash64(body).alias("tie"), body.alias("text")), gain, seed), "scored")
    eligible = F.col("n_words") >= min_words
    n = rows.where(eligible).count()
    k = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("bigint").alias("rank")
    if not k:
        return rows.select(*columns, none)
    edge = cutoff(rows.where(eligible).select("score", "doc_id"), k, n, ws, finish)
    won = eligible & _below(edge, inclusive=True)
    winners = ranked(ws.materialize(rows.where(won), "winners"), ws, range_rows)
    drawn = winners.select(*columns, F.when(F.col("place") <= k, F.col("place")).alias("rank"))
    return drawn.unionByName(rows.where(~won).select(*columns, none))


def op11_importance(spark, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = rf"""
WITH tab AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (
  SELECT 'd' AS side, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark),
words AS (
  SELECT side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
feats AS MATERIALIZED (
  SELECT side, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
marks AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1 : 2 * i])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS b
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM feats)), tab),
counts AS (
  SELECT m.b, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM feats f JOIN marks m ON f.f = m.f GROUP BY m.b),
sums AS (SELECT sum(s) AS ss, sum(t) AS tt FROM counts),
gain AS (
  SELECT b, floor({SCALE} * ln(((t + 1)::DOUBLE * (ss + {BUCKETS})::DOUBLE) / ((s + 1)::DOUBLE * (tt + {BUCKETS})::DOUBLE)))::BIGINT AS g FROM counts, sums),
means AS (
  SELECT f.doc_id, count(*) AS n, floor(sum(g.g) / count(*))::BIGINT AS weight
  FROM feats f JOIN marks m ON f.f = m.f JOIN gain g ON m.b = g.b WHERE f.side = 'd' GROUP BY f.doc_id),
scores AS (
  SELECT w.doc_id, coalesce(m.n, 0) AS n_features, coalesce(m.weight, 0) AS weight, len(w.w) AS n_words,
    coalesce(m.weight, 0) + floor(-{SCALE} * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(w.doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words w LEFT JOIN means m ON w.doc_id = m.doc_id WHERE w.side = 'd'),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scores WHERE n_words >= {MIN_WORDS})
SELECT s.doc_id, s.n_features::BIGINT AS n_features, s.weight, s.score, r.r::BIGINT AS rank
FROM scores s LEFT JOIN ranks r ON s.doc_id = r.doc_id AND r.r <= {PERCENT} * r.n // 100
"""
