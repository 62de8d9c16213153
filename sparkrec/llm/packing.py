"""Packing documents into fixed windows by non-negative least squares (operator 3).

A document is cut into whole windows and one rest, which depends on its own
length only, so ids and checksums are computed while the text is encoded and
no ids are stored. The pieces are then packed by their length histogram (at
most ``window`` numbers, the only thing the driver sees):

1. lengths fall into classes of ``width``; every combination of at most
   ``depth`` classes that fills a window exactly is a strategy (a column), and
   non-negative least squares finds how often to repeat each one so that the
   class histogram is met;
2. the repeat counts are rounded and each strategy is filled with the longest
   pieces its classes still have, then topped up with shorter ones;
3. what is left is packed greedily, longest first.

Every step works on counts: a run "these lengths, n times" is one plan entry.
A piece finds its place from its rank among the pieces of its length; ranks
come from salted windows plus the offsets of the salts, so a length shared by
a third of all pieces is not one task.

Edge cases: a null or empty text is the end id alone; repeated rows are
packed as separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm import token_ids
from sparkrec.llm.common import documents, hash_buckets, pick, scratch

WINDOW = 4096
CLASS_WIDTH = 64
DEPTH = 4
PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Active-set non-negative least squares: ``argmin |a x - b|`` with ``x >= 0``."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    gradient = a.T @ (b - a @ x)
    tolerance = 1e-9 * max(1.0, np.abs(b).max(initial=0.0)) * a.shape[0]
    for _ in range(rounds):
        free = np.where(active, -np.inf, gradient)
        if free.max(initial=-np.inf) <= tolerance:
            break
        active[int(free.argmax())] = True
        while True:
            z = np.zeros_like(x)
            z[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            negative = active & (z <= 0)
            if not negative.any():
                x = z
                break
            with np.errstate(divide="ignore", invalid="ignore"):
                steps = np.where(negative, x / (x - z), np.inf)
            x = x + min(1.0, np.nanmin(steps)) * (z - x)
            active &= x > 1e-12
            x[~active] = 0.0
            if not active.any():
                break
        gradient = a.T @ (b - a @ x)
    return x


def strategies(classes: int, depth: int) -> list[tuple[int, ...]]:
    """Multisets of at most ``depth`` classes (1-based) whose sum is ``classes``, longest part first."""
    found = []
    for d in range(1, min(depth, classes) + 1):
        for head in combinations_with_replacement(range(1, classes + 1), d - 1):
            last = classes - sum(head)
            if last >= (head[-1] if head else 1):
                found.append((*head, last)[::-1])
    return found


class Plan:
    """Places for the pieces of each length, from the counts of lengths alone."""

    def __init__(self, histogram: dict[int, int], window: int = WINDOW, width: int = CLASS_WIDTH, depth: int = DEPTH):
        self.window = window
        self.left = dict(histogram)
        self.used = dict.fromkeys(histogram, 0)
        self.present = sorted(k for k, n in histogram.items() if n)
        self.sequences = 0
        self.entries: list[tuple[int, int, int, int, int]] = []  # length, first rank, first sequence, offset, pieces a sequence
        classes = -(-window // width)
        if self.left.get(window):
            self._emit([(window, 1)], self.left[window])
        options = strategies(classes, depth)
        matrix = np.zeros((classes, len(options)))
        for j, option in enumerate(options):
            for c in option:
                matrix[c - 1, j] += 1
        target = np.zeros(classes)
        for length, n in self.left.items():
            target[-(-length // width) - 1] += n
        repeats = np.rint(nnls(matrix, target)).astype(int)
        for j in np.argsort(-repeats, kind="stable"):
            copies = int(repeats[j])
            while copies > 0:
                pattern = self._fill(options[j], width)
                if pattern is None:
                    break
                copies -= self._emit(pattern, copies)
        while self.present:
            self._emit(self._top_up({}, self.window), None)

    def _largest(self, most: int, least: int, taken: dict[int, int]) -> int | None:
        i = bisect.bisect_right(self.present, most) - 1
        while i >= 0 and self.present[i] >= least:
            if self.left[self.present[i]] > taken.get(self.present[i], 0):
                return self.present[i]
            i -= 1
        return None

    def _fill(self, option: tuple[int, ...], width: int) -> list[tuple[int, int]] | None:
        taken: dict[int, int] = {}
        for c in option:
            length = self._largest(min(c * width, self.window), (c - 1) * width + 1, taken)
            if length is None:
                return None
            taken[length] = taken.get(length, 0) + 1
        return self._top_up(taken, self.window - sum(k * n for k, n in taken.items()))

    def _top_up(self, taken: dict[int, int], slack: int) -> list[tuple[int, int]]:
        while slack > 0 and (length := self._largest(slack, 1, taken)) is not None:
            n = min(slack // length, self.left[length] - taken.get(length, 0))
            taken[length] = taken.get(length, 0) + n
            slack -= n * length
        return sorted(taken.items(), reverse=True)

    def _emit(self, pattern: list[tuple[int, int]], most: int | None) -> int:
        copies = min(self.left[length] // n for length, n in pattern)
        copies = copies if most is None else min(copies, most)
        offset = 0
        for length, n in pattern:
            self.entries.append((length, self.used[length], self.sequences, offset, n))
            self.used[length] += copies * n
            self.left[length] -= copies * n
            if not self.left[length]:
                self.present.remove(length)
            offset += length * n
        self.sequences += copies
        return copies

    def arrays(self) -> np.ndarray:
        """Entries sorted by length and first rank."""
        return np.array(sorted(self.entries), dtype=np.int64).reshape(-1, 5)


def _places(plan: np.ndarray):
    span = np.int64(1) << 44
    keys = plan[:, 0] * span + plan[:, 1] if len(plan) else plan[:, 0]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            e = plan[np.searchsorted(keys, length * span + rank, side="right") - 1]
            nth = rank - e[:, 1]
            places = [pa.array(e[:, 2] + nth // e[:, 4]), pa.array(e[:, 3] + nth % e[:, 4] * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *places], names=[*PIECE, "sequence_id", "offset"])

    return place


def _pieces(vocabulary: str, window: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches):
        encode = token_ids.encoder(vocabulary).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                for at in range(0, len(ids), 4 * window):
                    part = ids[at : at + 4 * window]
                    rows.append((doc_id, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4))
            columns = zip(*rows) if rows else [[]] * len(PIECE)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=PIECE)

    return pieces


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         window: int = WINDOW, end_id: int = token_ids.END_ID, width: int = CLASS_WIDTH, depth: int = DEPTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    ws = scratch(docs.sparkSession, "packing")
    schema = ", ".join(f"{c} bigint" for c in PIECE)
    cut = pick(docs, doc_id=doc_id, text=text).mapInArrow(_pieces(vocabulary or token_ids.vocabulary_path(), window, end_id), schema)
    pieces = ws.materialize(cut, "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Plan(histogram, window, width, depth).arrays()
    salts = hash_buckets(sum(histogram.values()), 2_000)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int"))
    by_salt = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(by_salt), F.lit(0)).alias("first")
    )
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")) - 1
    ranked = salted.withColumn("nth", nth).join(first, ["length", "salt"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("first") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(_places(plan), schema + ", sequence_id bigint, offset bigint")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))
