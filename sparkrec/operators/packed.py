"""Ratings and factors packed into arrays, a cell of keys a row: the half-steps of a fit.

The keys of each side are dealt into blocks by their hash and numbered within (cold keys by
their order in the block). ``width`` consecutive keys of a block are a *cell*; a factor table
has one row per cell, ``(cell, f)``, with the factors of all trials as one array. The ratings
lie in :class:`PackedLayout` once per fit and side, dealt by the key to solve: one row per
block and cell of the other side (a large one in several), with three arrays: the places of
the solve keys in their block, those of the fixed keys in their cell, the ratings.

A half-step joins ratings and factors by cell, a few thousand rows, and adds up
``sum y y^T`` and ``sum r y`` with ``numpy``, one block's sums in one task; the same task
solves them and writes the block's new cells. Nothing that grows with the ratings is shuffled.
Factors whose exact bytes fit the broadcast budget are broadcast; otherwise each block's task
reads all cells of the other side, joined in the order of cells, a batch at a time. A task holds
the sums of its block only: there are as many blocks as keep them below ``SUM_BYTES``.

A solve key with more than ``cap`` ratings is *hot*: its ratings are dealt by the other key and
summed where they lie, and one task adds up one row per block and solves the hot keys, which are
the cells of a block of their own.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkrec.plans.joins import bounded_side, broadcast_budget
from sparkrec.plans.session import Workspace

# Bytes of a cell's factors, ratings in one row, and bytes of one block's sums.
CELL_BYTES = 1 << 17
ROW_RATINGS = 1 << 14
SUM_BYTES = 1 << 28
# Factor values gathered before they are added to the sums.
GATHERED = 1 << 22
# Rows hold about a hundred kilobytes: bytes of a Parquet row group, and of an Arrow batch.
ROW_GROUP = 16 << 20
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = 32 << 20
# A block is read by one task also where no join asks for its buckets.
AUTO_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
SEAT = "als_seat"
RATED = f"{SEAT} int, block int, cell bigint, solve_at binary, fixed_at binary, rated binary"
FACTORS = "cell bigint, f binary"


def pairs(rank: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(rank) for b in range(a, rank)]


def cell_width(rank: int, trials: int) -> int:
    """Keys of a cell: a power of two, so that its factors take ``CELL_BYTES`` or less."""
    return 1 << max(6, min(16, (CELL_BYTES // (8 * rank * trials)).bit_length() - 1))


def enough_blocks(blocks: int, keys: int, rank: int, trials: int) -> int:
    """``blocks``, or more where a block's sums would outgrow ``SUM_BYTES``."""
    return max(blocks, -(-keys * trials * 8 * (len(pairs(rank)) + rank + 1) // SUM_BYTES))


def seats(spark: SparkSession, blocks: int) -> list[int]:
    """For each block a number that Spark's hash deals to it: one task, bucket or folder a block."""
    found: dict[int, int] = {}
    start, step = 0, 32 * blocks + 32
    while len(found) < blocks:
        rows = spark.range(start, start + step).select(F.col("id").cast("int").alias("id"))
        for r in rows.groupBy(F.pmod(F.hash("id"), F.lit(blocks)).alias("b")).agg(F.min("id").alias("id")).collect():
            found.setdefault(r["b"], r["id"])
        start += step
    return [found[b] for b in range(blocks)]


class Side:
    """The keys of one side: which are hot, and where each lies."""

    def __init__(self, key: str, counts: DataFrame, name: str, numbers: list[int], width: int, cap: int | None, ws: Workspace):
        self.key, self.blocks, self.numbers, self.width, self.ws = key, len(numbers), numbers, width, ws
        self.counts, self.name, self.type = counts, name, counts.schema[key].dataType.simpleString()
        cap = cap or max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // self.blocks))
        # hot keys are the last block, numbered by one task; there are fewer than blocks unless a cap is given
        hot, mine = F.col("n") > F.lit(cap), F.pmod(F.hash(key), F.lit(self.blocks))
        block = F.when(hot, F.lit(self.blocks)).otherwise(mine)
        order = Window.partitionBy("block").orderBy(key)
        places = counts.select(key, block.alias("block")).withColumn("at", F.row_number().over(order) - 1)
        self.places = ws.materialize(places, f"places_{name}")
        found = self.places.agg(F.count_if(F.col("block") == self.blocks).alias("hot"), F.count(F.lit(1)).alias("n")).first()
        self.n_hot, self.n = found["hot"], found["n"]

    def placed(self, rows: DataFrame, to: str) -> DataFrame:
        """``rows`` with ``{to}_block`` and ``{to}_at``, the key's block and its place there."""
        places = bounded_side(self.places.select(self.key, F.col("block").alias(f"{to}_block"), F.col("at").alias(f"{to}_at")), self.n, 48)
        return rows.join(places, self.key)

    def dealt(self, rows: DataFrame, block: str, other) -> DataFrame:
        """``rows`` one task a block; those of hot keys by the hash of ``other``."""
        at = F.when(F.col(block) < F.lit(self.blocks), F.col(block)).otherwise(F.pmod(F.hash(*other), F.lit(self.blocks)))
        return rows.withColumn(SEAT, F.element_at(F.array(*map(F.lit, self.numbers)), at + 1)).repartition(self.blocks, SEAT)

    def cell(self, to: str):
        return F.shiftleft(F.col(f"{to}_block").cast("bigint"), 32) + F.floor(F.col(f"{to}_at") / F.lit(self.width)).cast("bigint")

    def _packed(self, rows: DataFrame, columns: list, pack, name: str) -> DataFrame:
        """``rows`` of keys, a cell a row: ``(cell, name)``."""
        at = self.dealt(self.placed(rows, "k"), "k_block", [F.lit(0)])
        return at.select(self.cell("k").alias("cell"), "k_at", *columns).sortWithinPartitions("cell", "k_at").mapInArrow(_by_cell(pack, name), f"cell bigint, {name} binary")

    def keys(self) -> DataFrame:
        """``(cell, keys)``: the keys in the order of the factors."""
        keys = self._packed(self.counts.select(self.key), [F.col(self.key).cast("bigint")], lambda c: c[0].tobytes(), "keys")
        self.names = self.ws.materialize(keys, f"als_{self.name}_keys")
        return self.names

    def factors(self, rows: DataFrame, rank: int, trials: int) -> DataFrame:
        """``(cell, f)`` of ``(key, f0..)``, the same for all trials."""
        return self._packed(rows, [f"f{j}" for j in range(rank)], lambda c: np.tile(np.stack(c), (trials, 1)).tobytes(), "f")

    def table(self, factors: DataFrame, rank: int, trials: int) -> DataFrame:
        """``(key, trial, f0..f{rank-1})`` of ``(cell, f)``."""
        def unpack(batches):
            for batch in batches:
                for keys, f in zip(batch.column(1), batch.column(2)):
                    keys = np.frombuffer(keys.as_buffer(), "i8")
                    f = np.frombuffer(f.as_buffer()).reshape(trials, rank, len(keys))
                    yield pa.record_batch([
                        pa.array(np.tile(keys, trials)), pa.array(np.repeat(np.arange(trials, dtype="i4"), len(keys))),
                        *[pa.array(f[:, j].ravel()) for j in range(rank)]], names=["key", "trial", *[f"f{j}" for j in range(rank)]])

        names = [f"f{j}" for j in range(rank)]
        schema = "key bigint, trial int, " + ", ".join(f"{n} double" for n in names)
        return self.names.join(factors, "cell").mapInArrow(unpack, schema).select(
            F.col("key").cast(self.type).alias(self.key), "trial", *names)


def _by_cell(pack, name: str):
    """Rows ``(cell, place, columns)`` in this order to rows ``(cell, name)``: ``pack`` of the cell's columns."""
    def run(batches):
        held: list = []
        last = None

        def row():
            return pa.record_batch([pa.array([last], pa.int64()), pa.array([pack([np.concatenate(c) for c in zip(*held)])], pa.binary())], names=["cell", name])

        for batch in batches:
            cells, columns = batch.column(0).to_numpy(), [c.to_numpy() for c in batch.columns[2:]]
            ends = np.append(np.flatnonzero(np.diff(cells)) + 1, len(cells))
            for start, end in zip(np.append(0, ends[:-1]), ends):
                if start == end:
                    continue
                if held and cells[start] != last:
                    yield row()
                    held = []
                last = int(cells[start])
                held.append([c[start:end] for c in columns])
        if held:
            yield row()

    return run


class PackedLayout:
    """The ratings dealt into blocks of the side to *solve*, met by the *fixed* side's factors.

    ``rows``: ``(als_seat, s_block, s_at, cell, at, r)``, one task a block, ``cell`` and ``at`` those of
    the fixed key.
    """

    def __init__(self, rows: DataFrame, solve: Side, fixed: Side, n_fixed: int, rank: int, trials: int, ws: Workspace):
        self.solve, self.rank, self.trials, self.ws, self.blocks = solve, rank, trials, ws, solve.blocks
        self.broadcast = 0 < 8 * rank * trials * n_fixed <= broadcast_budget(rows.sparkSession)
        double = rows.schema["r"].dataType.simpleString() != "float"
        rows = rows.withColumn("r", F.col("r").cast("double")) if double else rows
        self.rated_type = "f8" if double else "f4"
        # one sort key (hot keys' cells last): its first bytes decide every comparison
        order = F.col("cell") + F.when(F.col("s_block") < F.lit(self.blocks), F.lit(0)).otherwise(F.lit(1 << 62))
        packed = rows.sortWithinPartitions(order).mapInArrow(_pack(self.rated_type), RATED)
        name = f"rated_{solve.name}"
        if self.broadcast:
            self.rated, self.path = ws.bucketed_stage(packed, name, [SEAT], self.blocks, row_group=ROW_GROUP)
        else:
            self.rated, self.path = ws.bucketed_stage(packed, name, ["cell"], 1, partition_by=[SEAT], row_group=ROW_GROUP)

    def rows(self) -> DataFrame:
        """``(seat, block, cell, solve_at, fixed_at, rated)`` as they lie."""
        return self.rated.select(SEAT, "block", "cell", "solve_at", "fixed_at", "rated")

    def _met(self, factors: DataFrame, hot: bool) -> DataFrame:
        """Ratings of cold or of hot keys, a task a block, each row with the factors of its cell."""
        def joined(rows: DataFrame, side: DataFrame) -> DataFrame:
            at_home = F.col("block") == F.lit(self.blocks) if hot else F.col("block") < F.lit(self.blocks)
            return rows.where(at_home).select("block", "cell", "solve_at", "fixed_at", "rated").join(side, "cell").select(
                "block", "solve_at", "fixed_at", "rated", "f")

        if self.broadcast:
            return joined(self.rated, F.broadcast(factors))
        side = factors.coalesce(1).hint("merge")
        return reduce(DataFrame.unionAll, [joined(self.rated.where(F.col(SEAT) == F.lit(s)), side) for s in self.solve.numbers])

    def solved(self, factors: DataFrame, regs: list[float]) -> DataFrame:
        """``(cell, f)`` of the solve keys, given those of the fixed keys."""
        k, trials, width, typ, home = self.rank, self.trials, self.solve.width, self.rated_type, self.blocks

        def cold(batches):
            for block, sums in _added(batches, k, trials, typ).items():
                yield from _cells(block, sums, regs, k, width)

        out = self._met(factors, False).mapInArrow(cold, FACTORS)
        if not self.solve.n_hot:
            return out
        n_hot = self.solve.n_hot

        def part(batches):
            for sums in _added(batches, k, trials, typ, n_hot).values():
                yield pa.record_batch([pa.array([home]), pa.array([sums.tobytes()], pa.binary())], names=["cell", "f"])

        def whole(batches):
            total = np.zeros((trials, len(pairs(k)) + k + 1, n_hot))
            for batch in batches:
                for sums in batch.column(1):
                    total += np.frombuffer(sums.as_buffer()).reshape(total.shape)
            if total[0, -1].any():
                yield from _cells(home, total, regs, k, width)

        return out.unionAll(self._met(factors, True).mapInArrow(part, FACTORS).repartition(1).mapInArrow(whole, FACTORS))


def _pack(typ: str):
    """Rows ``(seat, block, cell, solve_at, at, r)`` by block and cell to rows of arrays."""
    def run(batches):
        held: list = []
        key, n = None, 0

        def row():
            at, fixed, r = (np.concatenate(c) for c in zip(*held))
            arrays = [pa.array([v], t) for v, t in zip(key, (pa.int32(), pa.int32(), pa.int64()))]
            arrays += [pa.array([x.tobytes()], pa.binary()) for x in (at.astype("i4"), fixed.astype("u2"), r.astype(typ))]
            return pa.record_batch(arrays, names=[SEAT, "block", "cell", "solve_at", "fixed_at", "rated"])

        for batch in batches:
            seat, block, cell, at, fixed, r = (c.to_numpy() for c in batch.columns)
            ends = np.append(np.flatnonzero(np.diff(cell) | np.diff(block)) + 1, len(cell))
            for start, end in zip(np.append(0, ends[:-1]), ends):
                while start < end:
                    here = int(seat[start]), int(block[start]), int(cell[start])
                    if held and (here != key or n >= ROW_RATINGS):
                        yield row()
                        held, n = [], 0
                    key, stop = here, min(end, start + ROW_RATINGS - n)
                    held.append((at[start:stop], fixed[start:stop], r[start:stop]))
                    n, start = n + stop - start, stop
        if held:
            yield row()

    return run


def _unpack(typ: str):
    """The rows that :func:`_pack` has packed, without the seat."""
    def run(batches):
        for batch in batches:
            for _, block, cell, at, fixed, r in zip(*batch.columns):
                at, fixed, r = (np.frombuffer(x.as_buffer(), t) for x, t in ((at, "i4"), (fixed, "u2"), (r, typ)))
                yield pa.record_batch([
                    pa.array(np.full(len(at), block.as_py(), "i4")), pa.array(np.full(len(at), cell.as_py(), "i8")),
                    pa.array(at), pa.array(fixed.astype("i4")), pa.array(r)], names=["f_block", "cell", "f_at", "at", "r"])

    return run


def _added(batches, rank: int, trials: int, typ: str, size: int = 0) -> dict[int, np.ndarray]:
    """Sums by block: ``(trial, entries of y y^T, of r y and the count, key)``; ``size`` keys at least."""
    tri = pairs(rank)
    n_sums = len(tri) + rank + 1
    sums: dict[int, np.ndarray] = {}

    def add(block: int, rows: list) -> None:
        at = np.concatenate([row[0] for row in rows]).astype(np.intp)
        rated = np.concatenate([row[2] for row in rows]).astype(float)
        y = np.empty((trials * rank, len(at)))
        start = 0
        for _, fixed, _, f in rows:
            f.take(fixed, axis=1, out=y[:, start:start + len(fixed)], mode="clip")
            start += len(fixed)
        n = max(size, int(at.max()) + 1)
        mine = sums.get(block)
        if mine is None or mine.shape[2] < n:
            grown = np.zeros((trials, n_sums, n))
            if mine is not None:
                grown[:, :, :mine.shape[2]] = mine
            sums[block] = mine = grown
        product = np.empty(len(at))
        count = np.bincount(at, minlength=n)
        for t in range(trials):
            mine[t, -1, :n] += count
            own = y[t * rank:(t + 1) * rank]
            for s, (p, q) in enumerate(tri):
                np.multiply(own[p], own[q], out=product)
                mine[t, s, :n] += np.bincount(at, product, n)
            for p in range(rank):
                np.multiply(own[p], rated, out=product)
                mine[t, len(tri) + p, :n] += np.bincount(at, product, n)

    held: dict[int, list] = {}
    waiting = 0
    for batch in batches:
        for block, at, fixed, r, f in zip(*batch.columns):
            at, fixed, r, f = (np.frombuffer(x.as_buffer(), t) for x, t in ((at, "i4"), (fixed, "u2"), (r, typ), (f, "f8")))
            held.setdefault(block.as_py(), []).append((at, fixed, r, f.reshape(trials * rank, -1)))
            waiting += trials * rank * len(at) + len(f)
            if waiting >= GATHERED:
                for b, rows in held.items():
                    add(b, rows)
                held, waiting = {}, 0
    for b, rows in held.items():
        add(b, rows)
    return sums


def solve_sums(sums: np.ndarray, reg: float, rank: int) -> np.ndarray:
    """``(rank, keys)``: ``(A + reg * n * I) f = b`` of every key by elimination, all keys at once
    (the matrices are positive definite: no pivoting). Works in ``sums``."""
    at = {p: s for s, p in enumerate(pairs(rank))}
    a = lambda p, q: sums[at[min(p, q), max(p, q)]]
    b = sums[len(at):-1]
    for p in range(rank):
        a(p, p)[:] += reg * sums[-1]
    for j in range(rank):
        if not a(j, j).all():
            raise ZeroDivisionError("a key's normal equations are singular: reg must be above 0")
        for p in range(j + 1, rank):
            ratio = a(j, p) / a(j, j)
            for q in range(p, rank):
                a(p, q)[:] -= ratio * a(j, q)
            b[p] -= ratio * b[j]
    out = np.empty((rank, sums.shape[1]))
    for j in reversed(range(rank)):
        out[j] = b[j]
        for q in range(j + 1, rank):
            out[j] -= a(j, q) * out[q]
        out[j] /= a(j, j)
    return out


def _cells(block: int, sums: np.ndarray, regs: list[float], rank: int, width: int):
    """The block's solved keys, as rows ``(cell, f)``, some at a time."""
    f = np.concatenate([solve_sums(sums[t], reg, rank) for t, reg in enumerate(regs)])
    cells = range(-(-f.shape[1] // width))
    for some in (cells[c:c + 32] for c in range(0, len(cells), 32)):
        arrays = [np.ascontiguousarray(f[:, c * width:(c + 1) * width]).tobytes() for c in some]
        yield pa.record_batch([pa.array([(block << 32) + c for c in some], pa.int64()), pa.array(arrays, pa.binary())], names=["cell", "f"])


def layouts(data: DataFrame, solve_first: Side, solve_then: Side, n_first: int, n_then: int, rank: int, trials: int, ws: Workspace):
    """The two layouts of ``(key of first, key of then, r)``. The second is dealt from the first's rows."""
    first, then = solve_first, solve_then
    rows = first.placed(then.placed(data, "f"), "s")
    rows = first.dealt(rows, "s_block", ["f_block", "f_at"]).withColumn("cell", then.cell("f")).withColumn("at", F.col("f_at") % F.lit(then.width))
    one = PackedLayout(rows.select(SEAT, "s_block", "cell", "s_at", "at", "r"), first, then, n_then, rank, trials, ws)
    typ = "float" if one.rated_type == "f4" else "double"
    back = one.rows().mapInArrow(_unpack(one.rated_type), f"f_block int, cell bigint, f_at int, at int, r {typ}")
    part = F.col("cell").bitwiseAND(F.lit((1 << 32) - 1))
    back = back.withColumn("s_block", F.shiftright("cell", 32).cast("int")).withColumn("s_at", (part * F.lit(then.width) + F.col("at")).cast("int"))
    back = then.dealt(back, "s_block", ["f_block", "f_at"]).withColumn("cell", first.cell("f")).withColumn("at", F.col("f_at") % F.lit(first.width))
    return one, PackedLayout(back.select(SEAT, "s_block", "cell", "s_at", "at", "r"), then, first, n_first, rank, trials, ws)
