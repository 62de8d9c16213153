"""Compression of vectors to short codes by exact integer products (operator 12).

Every component x becomes the integer floor(scale * x), and a vector is cut
into ``parts`` equal consecutive parts. Each part position has a codebook that
starts as that part of the vectors with the smallest ids; a round assigns every
part to its nearest entry and moves each entry to the floored mean of its
parts. All of it is integer arithmetic, so the result depends on no order,
partitioning or rounding.

Squared distances come from a limb-split matrix product: the integers are
broken into limbs so short that a dot product of two limb rows stays below
2^53, float64 BLAS multiplies the limb matrices without error, and the partial
products are put together in int64. The first smallest distance wins.

A round is one pass over the table: tasks add up their parts by codebook entry
in numpy, Spark sums these tables, and the driver gets one number for each
entry and position (``entries`` x width numbers, whatever the rows).

Edge cases: rows whose vector is null or has a null, infinite or NaN component
are dropped; a vector shorter than the longest (an empty one, too) is filled up
with zeros, as is a width that ``parts`` does not divide; a null id sorts last
and stays null; vectors of one id are ordered by their components; with fewer
vectors than ``entries`` the codebooks are shorter; entries without a part stay;
repeated rows are coded alike; null labels are one label; an empty table gives
an empty result. Other columns, whatever they are called, have no effect and are
not returned. A component whose squared distances would not fit in a long
(about 2^29 after scaling, at 8 components a part) raises an error.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import scratch
from sparkrec.plans.joins import bounded_side

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK_VALUES = 1 << 20


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """``x`` as a sum of float64 matrices times 2^(bits * i); all but the last are non-negative."""
    out = []
    while x.size and (x.max() >= 1 << bits or x.min() < -(1 << bits)):
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact ``a @ b.T`` of int64 matrices whose result fits in int64."""
    width = max(1, a.shape[1])
    bits = (53 - (width - 1).bit_length()) // 2
    out = np.zeros((len(a), len(b)), np.int64)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(limbs(b, bits)):
            out += (x @ y.T).astype(np.int64) << (bits * (i + j))
    return out


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry (the first of equal ones) and the squared distance."""
    cross = products(rows, entries)
    distance = (rows * rows).sum(1)[:, None] - 2 * cross + (entries * entries).sum(1)[None, :]
    index = distance.argmin(1)
    return index, distance[np.arange(len(rows)), index]


def _integers(column: pa.Array, scale: int, width: int | None, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are kept, and their integers, filled up with zeros to ``width``."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(column)), lengths)
    kept = column.is_valid().to_numpy(zero_copy_only=False)
    kept[row[~np.isfinite(values)]] = False
    width = width if width is not None else padded(int(lengths[kept].max(initial=0)), parts)
    scaled = np.zeros((len(column), width))
    use = kept[row]
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    scaled[row[use], place[use]] = np.floor(values[use] * scale)
    limit = math.isqrt((1 << 62) // max(1, width // parts)) // 2
    if scaled.size and np.abs(scaled).max() > limit:
        raise ValueError(f"a component is beyond {limit} after scaling by {scale}: squared distances would not fit in a long")
    return kept, scaled[kept].astype(np.int64)


def padded(width: int, parts: int) -> int:
    return -(-width // parts) * parts


def _blocks(batches, width: int):
    """Slices of the batches of about ``BLOCK_VALUES`` vector components."""
    step = max(1, BLOCK_VALUES // max(1, width))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


class Codebooks:
    """Integer entries by part: an array of shape (parts, entries, part width)."""

    def __init__(self, entries: np.ndarray, scale: int):
        self.entries, self.scale = entries, scale
        self.parts, self.width = entries.shape[0], entries.shape[0] * entries.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def assign(self, column: pa.Array):
        """Kept rows, their integers by part, and the index and error of every part."""
        kept, ints = _integers(column, self.scale, self.width, self.parts)
        cut = ints.reshape(len(ints), self.parts, self.entries.shape[2])
        found = [nearest(cut[:, p], self.entries[p]) for p in range(self.parts)] if len(ints) else []
        index = np.stack([i for i, _ in found], 1) if found else np.zeros((0, self.parts), np.int64)
        error = np.stack([e for _, e in found], 1) if found else np.zeros((0, self.parts), np.int64)
        return kept, cut, index, error


def _first_vectors(scale: int, parts: int, entries: int):
    """A task's longest kept width and its kept vectors with the smallest ids."""

    def run(batches):
        best, width = [], 0
        for batch in batches:
            for block in _blocks([batch], 1024):
                kept, ints = _integers(block.column(1), scale, None, parts)
                width = max(width, ints.shape[1] if len(ints) else 0)
                ids = block.column(0).filter(pa.array(kept)).to_pylist()
                order = sorted(range(len(ids)), key=lambda r: (ids[r] is None, ids[r] or 0))[: entries]
                edge = (ids[order[-1]] is None, ids[order[-1]] or 0) if order else None
                near = [(i is None, i or 0, ints[r].tolist()) for r, i in enumerate(ids) if (i is None, i or 0) <= edge]
                best = sorted([*best, *near])[:entries]
        yield pa.RecordBatch.from_arrays(
            [pa.array([width] * max(1, len(best)), pa.int32()), pa.array([None if b[0] else b[1] for b in best] or [None], pa.int64()),
             pa.array([b[2] for b in best] or [None], pa.list_(pa.int64()))], names=["width", "vec_id", "ints"])

    return run


def initial(vectors: DataFrame, scale: int, parts: int, entries: int) -> Codebooks:
    """The parts of the kept vectors with the smallest ids."""
    firsts = vectors.mapInArrow(_first_vectors(scale, parts, entries), "width int, vec_id bigint, ints array<bigint>")
    firsts = scratch(vectors.sparkSession, "codes").materialize(firsts, "first")
    width = firsts.agg(F.max("width")).first()[0] or 0
    filled = F.concat("ints", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("ints")))
    chosen = firsts.where("ints is not null").select("vec_id", filled.alias("ints"))
    rows = [r["ints"] for r in chosen.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()]
    book = np.array(rows, np.int64).reshape(len(rows), parts, width // parts)
    return Codebooks(book.transpose(1, 0, 2).copy(), scale)


def improved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry moved to the floored mean of the parts assigned to it."""
    parts, entries, width = books.entries.shape

    def run(batches):
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for block in _blocks(batches, books.width):
            _, cut, index, _ = books.assign(block.column(1))
            for p in range(parts):
                order = np.argsort(index[:, p], kind="stable")
                used, starts, counts = np.unique(index[order, p], return_index=True, return_counts=True)
                if len(used):
                    sums[p, used, :width] += np.add.reduceat(cut[order, p], starts, axis=0)
                    sums[p, used, width] += counts
        flat = sums.ravel()
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(flat[slots])], names=["slot", "total"])

    totals = np.zeros(parts * entries * (width + 1), np.int64)
    for r in vectors.mapInArrow(run, "slot bigint, total bigint").groupBy("slot").agg(F.sum("total").alias("total")).collect():
        totals[r["slot"]] = r["total"]
    totals = totals.reshape(parts, entries, width + 1)
    counts = totals[:, :, width:]
    return Codebooks(np.where(counts > 0, totals[:, :, :width] // np.maximum(counts, 1), books.entries), books.scale)


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept vector, and the codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    rows = vectors.select(vectors[f"`{vec_id}`"].cast("bigint").alias("vec_id"), vectors[f"`{vector}`"].alias("vector"), vectors[f"`{label}`"].alias("label"))
    pairs = rows.select("vec_id", "vector")
    books = initial(pairs, scale, parts, entries)
    for _ in range(rounds if books.entries.shape[1] else 0):
        books = improved(pairs, books)

    def run(batches):
        for block in _blocks(batches, books.width):
            kept, _, index, error = books.assign(block.column(1))
            digits = index.astype(np.uint8).tobytes().hex()
            codes = [digits[2 * parts * r : 2 * parts * (r + 1)] for r in range(len(index))]
            mask = pa.array(kept)
            yield pa.RecordBatch.from_arrays([block.column(0).filter(mask), block.column(2).filter(mask), pa.array(codes, pa.string()), pa.array(error.sum(1), pa.int64())],
                                             names=["vec_id", "label", "code", "error"])

    of_label = rows.schema["label"].dataType.simpleString()
    ws = scratch(vectors.sparkSession, "codes")
    coded = ws.materialize(rows.mapInArrow(run, f"vec_id bigint, label {of_label}, code string, error bigint"), "coded")
    totals = ws.materialize(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "labels")
    widest = totals.agg(F.max(F.length(F.col("of_label").cast("string")))).first()[0] or 0
    joined = coded.join(bounded_side(totals, totals.count(), 64 + 4 * widest), F.col("label").eqNullSafe(F.col("of_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")), books


def op12_vector_codes(spark, sf_dir: str) -> DataFrame:
    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))[0]


def _sql() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(
            f"d{r} AS MATERIALIZED (SELECT v.vec_id, v.part, b.entry, sum((v.v - b.v) * (v.v - b.v))::BIGINT AS dist "
            f"FROM vals v JOIN book{r} b ON v.part = b.part AND v.pos = b.pos GROUP BY v.vec_id, v.part, b.entry),\n"
            f"a{r} AS MATERIALIZED (SELECT vec_id, part, entry, dist FROM d{r} "
            f"QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY dist, entry) = 1)"
        )
        if r < ROUNDS:
            steps.append(
                f"m{r} AS (SELECT v.part, a.entry, v.pos, CAST(floor(sum(v.v) / count(*)) AS BIGINT) AS v "
                f"FROM vals v JOIN a{r} a ON v.vec_id = a.vec_id AND v.part = a.part GROUP BY v.part, a.entry, v.pos),\n"
                f"book{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.v, b.v) AS v FROM book{r} b "
                f"LEFT JOIN m{r} m ON b.part = m.part AND b.entry = m.entry AND b.pos = m.pos)"
            )
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, len(embedding) // {PARTS} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
vals AS MATERIALIZED (
  SELECT vec_id, i // w AS part, i % w AS pos, v
  FROM (SELECT vec_id, w, generate_subscripts(embedding, 1) - 1 AS i, CAST(floor({SCALE} * unnest(embedding)::DOUBLE) AS BIGINT) AS v FROM kept)),
firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {ENTRIES}),
book0 AS MATERIALIZED (SELECT v.part, f.entry, v.pos, v.v FROM vals v JOIN firsts f ON v.vec_id = f.vec_id),
""" + ",\n".join(steps) + f""",
codes AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a{ROUNDS} GROUP BY vec_id),
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS h FROM book{ROUNDS})
SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, b.h AS codebooks_sha256
FROM kept k JOIN codes c ON k.vec_id = c.vec_id CROSS JOIN books b
"""


OP12_SQL = _sql()
