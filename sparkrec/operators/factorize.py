"""Explicit-feedback ALS as DataFrame jobs (normal equations per key).

Each half-step fixes one side's factors ``y`` and solves, for every key
``x`` of the other side, ``(sum y y^T + reg * n_x * I) x = sum r y`` (the
ALS-WR objective of Spark's ALS). Trials that differ only in ``reg`` run
together: the trial number is part of the factor key, so they share each scan
of the ratings, each shuffle and each write.

1. the ratings lie in blocks by the key to solve (:class:`BlockLayout`, written
   once per fit and side) and meet the fixed factors there: broadcast when
   their exact row count fits the budget; otherwise ratings and factors are
   bucketed alike by the fixed key. Nothing is shuffled either way;
2. ``groupBy(key, trial)`` with plain ``SUM`` aggregates of the packed upper
   triangle of ``y y^T`` and of ``r y``, in the block's own task. The ratings
   of a hot key are spread over tasks and summed there first, so a key holding a
   third of all ratings sends one row per task and trial;
3. the small ``k x k`` systems: up to ``EXPRESSION_RANK`` by elimination and back
   substitution in column expressions (the matrices are positive definite, so no
   pivoting is needed; no row passes through Python), above it, where those
   expressions outgrow compiled code, by a batched ``numpy`` solve in
   ``mapInPandas``. Both give the same factors up to rounding;
4. the new factors are written (lineage cut), and those of the sweep before are
   deleted: every half-step where the next one reads them by bucket; where it
   broadcasts them, the user factors every ``cfg.write_every`` sweeps, and the
   sweeps between stay in one plan. Factors of sweeps that are asked for are
   always written.

Runs of many sums per rating (``PACKED_SUMS``: high ranks, several trials, many
sweeps) take the half-steps of :mod:`sparkrec.operators.packed` instead: the same
equations, added up over arrays.

No step gathers a hot key's ratings into one task, unlike MLlib's blocked ALS
whose in-block for a hot item holds all of that item's ratings. A single
half-step of ratings that are not dealt into blocks is :func:`half_step` with
:class:`RatingsLayout`.

Initial factors come from the md5 of ``(id, seed, j)`` (uniform in (0, 1), as
ratings are positive, then unit length), so they do not depend on
partitioning or engine, and are the same for every trial.
"""

from __future__ import annotations

from contextlib import ExitStack
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.functions.hashing import unit_number
from sparkrec.operators import packed
from sparkrec.plans.joins import bounded_side, fits_broadcast
from sparkrec.plans.session import Stage, at_least, held

# The sums of rank 13 and above are more columns than whole-stage code
# generation takes by default.
CODEGEN_FIELDS = "spark.sql.codegen.maxFields"
# Sums per rating of a whole run (half-steps of a side, trials, sums of a rank) from which dealing the
# ratings into arrays pays: a grid's ranks of 30 sweeps and three trials, not one run of rank 4.
PACKED_SUMS = 1000
# Up to this rank the small systems are solved in column expressions.
EXPRESSION_RANK = 5
# Each block reads all factors of the other side, in as many buckets as there are blocks: opening
# files grows with their square.
MOST_BLOCKS = 48
BLOCK = "als_block"
# Spark 4.1 runs a union of one-task parts as one task; each block is a task of its own.
UNION_AS_ONE = "spark.sql.unionOutputPartitioning"
# Buckets of a single sorted file are joined without sorting them again.
SORTED_BUCKETS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def initial_factors(ids: DataFrame, key: str, rank: int, seed: int, trials: int = 1) -> DataFrame:
    """``(key, trial, f0..f{rank-1})``: unit-length vectors from id hashes, one copy per trial."""
    raw = ids.select(F.col(key), *[unit_number(key, seed, j).alias(f"g{j}") for j in range(rank)])
    norm = F.sqrt(sum((F.col(f"g{j}") * F.col(f"g{j}") for j in range(1, rank)), F.col("g0") * F.col("g0")))
    trial = F.explode(F.array(*[F.lit(t) for t in range(trials)])).alias("trial")
    return raw.select(F.col(key), *[(F.col(f"g{j}") / norm).alias(f"f{j}") for j in range(rank)]).select(
        key, trial, *[f"f{j}" for j in range(rank)])


def _pairs(rank: int) -> list[tuple[int, int]]:
    return [(a, b) for a in range(rank) for b in range(a, rank)]


def normal_equations(joined: DataFrame, key: str, rating: str, rank: int) -> DataFrame:
    """Per key and trial: packed ``sum y y^T``, ``sum r y`` and the rating count ``n``."""
    sums = [f"sum(f{a} * f{b}) AS a{a}_{b}" for a, b in _pairs(rank)]
    sums += [f"sum(double(`{rating}`) * f{a}) AS b{a}" for a in range(rank)]
    return joined.groupBy(key, "trial").agg(*map(F.expr, [*sums, "count(1) AS n"]))


def solved(equations: DataFrame, key: str, rank: int, regs: list[float], expression_rank: int = EXPRESSION_RANK) -> DataFrame:
    """``(key, trial, f0..f{rank-1})`` of ``(A + reg * n * I) f = b`` per row, ``reg`` by trial."""
    if rank <= expression_rank:
        reg = "CASE trial " + " ".join(f"WHEN {t} THEN double('{float(x)!r}')" for t, x in enumerate(regs)) + " END"
        return _eliminated(equations, key, rank, f"({reg}) * n")
    schema = f"`{key}` int, trial int, " + ", ".join(f"f{j} double" for j in range(rank))
    return equations.mapInPandas(_batched(key, rank, regs), schema)


def _batched(key: str, rank: int, regs: list[float]):
    tri = _pairs(rank)
    up = np.array([p for p, _ in tri]), np.array([q for _, q in tri])

    def solve(batches):
        for rows in batches:
            a = np.zeros((len(rows), rank, rank))
            entries = rows[[f"a{p}_{q}" for p, q in tri]].to_numpy(float)
            a[:, up[0], up[1]] = a[:, up[1], up[0]] = entries
            a[:, range(rank), range(rank)] += (np.array(regs)[rows["trial"].to_numpy()] * rows["n"].to_numpy(float))[:, None]
            x = np.linalg.solve(a, rows[[f"b{j}" for j in range(rank)]].to_numpy(float)[:, :, None])[:, :, 0]
            out = pd.DataFrame(x, columns=[f"f{j}" for j in range(rank)])
            out.insert(0, key, rows[key].to_numpy())
            out.insert(1, "trial", rows["trial"].to_numpy())
            yield out

    return solve


def _eliminated(equations: DataFrame, key: str, rank: int, penalty: str) -> DataFrame:
    """``a{p}_{q}``, q >= p, hold the upper triangle. Every step of the elimination is
    one projection, so each entry is computed once."""
    keep = [f"`{key}`", "trial"]
    rows = equations.selectExpr(
        *keep, *[f"a{p}_{q} + {penalty} AS a{p}_{q}" if p == q else f"a{p}_{q}" for p, q in _pairs(rank)], *[f"b{p}" for p in range(rank)])
    for j in range(rank - 1):
        done = [f"a{p}_{q}" for p, q in _pairs(rank) if p <= j] + [f"b{p}" for p in range(j + 1)]
        rows = rows.selectExpr(
            *keep, *done, *[f"a{p}_{q} - a{j}_{p} / a{j}_{j} * a{j}_{q} AS a{p}_{q}" for p, q in _pairs(rank) if p > j],
            *[f"b{p} - a{j}_{p} / a{j}_{j} * b{j} AS b{p}" for p in range(j + 1, rank)])
    for j in reversed(range(rank)):
        later = range(j + 1, rank)
        left = [f"a{p}_{q}" for p, q in _pairs(rank) if p < j] + [f"b{p}" for p in range(j)]
        rest = "".join(f" - a{j}_{q} * f{q}" for q in later)
        rows = rows.selectExpr(*keep, *left, f"(b{j}{rest}) / a{j}_{j} AS f{j}", *[f"f{q}" for q in later])
    return rows


class RatingsLayout:
    """How the ratings meet the factors of one side (the *fixed* key).

    * Factor table within the broadcast budget (exact row count): the
      ratings stay as they are and the factors are broadcast.
    * Otherwise a key with more than ``cap`` ratings is spread over
      ``ceil(count / cap)`` salts (a hash of the other key), so no
      (key, salt) group exceeds ``cap`` rows but for hash imbalance. The
      salted ratings are written once, bucketed by (key, salt); each
      half-step shuffles only the factor table, with one copy per salt of a
      hot key, into the same buckets and joins without moving the ratings.
      ``cap`` defaults to total ratings / partitions; the table of hot keys
      then has at most ``partitions`` rows, a proven bound.
    """

    def __init__(self, data: DataFrame, key: str, other: str, counts: DataFrame, n_keys: int, rank: int,
                 partitions: int, cap: int | None, ws):
        self.key, self.rank = key, rank
        self.broadcast = fits_broadcast(data.sparkSession, n_keys, 8 * rank + 48)
        self.partitions = partitions
        self.ratings = data
        if self.broadcast:
            return
        total = counts.agg(F.sum("n")).first()[0] or 0
        cap = cap or max(1, -(-total // partitions))
        hot = ws.materialize(
            counts.filter(F.col("n") > F.lit(cap)).select(key, F.ceil(F.col("n") / F.lit(cap)).cast("int").alias("salts")),
            f"hot_{key}",
        )
        self.hot = bounded_side(hot, hot.count(), 16)
        salt = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(F.col(other)), F.col("salts")))
        salted = data.join(self.hot, key, "left").withColumn("salt", salt.cast("int")).drop("salts")
        self.ratings = ws.bucketed(salted, f"salted_{key}", [key, "salt"], partitions)

    def join(self, factors: DataFrame) -> DataFrame:
        if self.broadcast:
            return self.ratings.join(F.broadcast(factors), self.key)
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - F.lit(1)))
        fixed = factors.join(self.hot, self.key, "left").withColumn("salt", copies).drop("salts")
        fixed = fixed.repartition(self.partitions, self.key, "salt").hint("shuffle_hash")
        return self.ratings.join(fixed, [self.key, "salt"]).drop("salt")


def half_step(layout: RatingsLayout, fixed: DataFrame, solve_key: str, rating: str, rank: int, regs: list[float]) -> DataFrame:
    """New factors of ``solve_key`` given the factors of the layout's key, for the trials' ``regs``."""
    equations = normal_equations(layout.join(fixed), solve_key, rating, rank)
    return solved(equations, solve_key, rank, regs)


def block_count(spark: SparkSession, partitions: int | None = None) -> int:
    """Blocks of a :class:`BlockLayout`: ``partitions`` if given, else one a core, ``MOST_BLOCKS`` at most."""
    if partitions:
        return partitions
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism, MOST_BLOCKS))


class BlockLayout:
    """The ratings dealt once into blocks by the hash of the key to *solve*, so that no
    half-step shuffles anything that grows with the ratings.

    * Fixed factors within the broadcast budget (exact row count): the ratings
      are bucketed by the solve key; the factors are broadcast and each
      bucket's task sums its own keys.
    * Otherwise the ratings are split into folders by the solve key's block, and
      bucketed by the fixed key within. The factors come bucketed by their key
      into as many buckets (:meth:`stage`), so each block joins them bucket by
      bucket, in one task, without a shuffle; the task sums its own keys.
      It merges sorted files and holds one row of sums per key of the block,
      which spill.

    A solve key with more than ``cap`` ratings (default: ratings / blocks, so
    there are fewer such keys than blocks) is *hot*: its ratings lie in a table of
    their own, are summed where they lie, and one row per task and trial is sent.
    """

    def __init__(self, data: DataFrame, solve: str, fixed: str, counts: DataFrame, n_fixed: int, rank: int,
                 blocks: int, cap: int | None, ws):
        self.solve, self.fixed, self.rank, self.blocks, self.ws = solve, fixed, rank, blocks, ws
        self.broadcast = fits_broadcast(data.sparkSession, n_fixed, 8 * rank + 48)
        cap = cap or max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // blocks))
        hot = ws.materialize(counts.filter(F.col("n") > F.lit(cap)).select(solve), f"hot_{solve}")
        n_hot = hot.count()
        self.hot = None
        if n_hot:
            side = bounded_side(hot, n_hot, 16)
            mine, data = data.join(side, solve, "left_semi"), data.join(side, solve, "left_anti")
            self.hot = ws.materialize(mine, f"hot_rated_{solve}") if self.broadcast else ws.bucketed_stage(
                mine, f"hot_rated_{solve}", [fixed], blocks).table
        # the hash that deals rows to tasks, buckets and blocks is the same
        data = data.repartition(blocks, solve)
        if self.broadcast:
            self.cold = ws.bucketed_stage(data, f"rated_{solve}", [solve], blocks).table
        else:
            data = data.withColumn(BLOCK, F.pmod(F.hash(solve), F.lit(blocks)))
            self.cold = ws.bucketed_stage(data, f"rated_{solve}", [fixed], blocks, partition_by=[BLOCK]).table

    def stage(self, factors: DataFrame, name: str) -> Stage:
        """Factors of the fixed key, written as :meth:`equations` reads them."""
        if self.broadcast:
            return self.ws.stage(factors, name)
        return self.ws.bucketed_stage(factors, name, [self.fixed], self.blocks)

    def equations(self, factors: DataFrame, rating: str) -> DataFrame:
        """Normal equations of every solve key, given the fixed key's factors."""
        def sums(ratings: DataFrame, tasks: int | None = None) -> DataFrame:
            joined = ratings.join(side, self.fixed)
            return normal_equations(joined.coalesce(tasks) if tasks else joined, self.solve, rating, self.rank)

        side = F.broadcast(factors) if self.broadcast else factors.hint("merge")
        if self.broadcast:
            parts = [sums(self.cold)]
        else:
            parts = [sums(self.cold.where(F.col(BLOCK) == b).drop(BLOCK), 1) for b in range(self.blocks)]
        if self.hot is not None:
            parts.append(sums(self.hot))
        return reduce(DataFrame.unionAll, parts)


def as_feature_table(factors: DataFrame, key: str, rank: int, trial: int = 0) -> DataFrame:
    """``(id int, features array<double>)`` of one trial."""
    mine = factors.where(F.col("trial") == trial)
    return mine.select(F.col(key).alias("id"), F.array(*[F.col(f"f{j}") for j in range(rank)]).alias("features"))


def trial_scores(pairs: DataFrame, x: DataFrame, y: DataFrame, cfg, n_x: int, n_y: int) -> DataFrame:
    """``pairs`` scored by every trial: one row per pair and trial, unknown users or items dropped.

    ``x``, ``y`` are the two factor tables of one sweep, of ``n_x`` and ``n_y`` rows.
    """
    k, width = cfg.rank, 8 * cfg.rank + 48
    mine = y.select(cfg.item, "trial", *[F.col(f"f{j}").alias(f"g{j}") for j in range(k)])
    scored = pairs.join(bounded_side(x, n_x, width), cfg.user).join(bounded_side(mine, n_y, width), [cfg.item, "trial"])
    dot = F.expr(" + ".join(f"f{j} * g{j}" for j in range(k)))
    return scored.select(*pairs.columns, "trial", dot.alias(cfg.prediction))


def fit_normal_equations_path(
    ratings: DataFrame, cfg, ws, sweeps: list[int], regs: list[float] | None = None
) -> tuple[dict[int, tuple[DataFrame, DataFrame]], int, int]:
    """One run of ``max(sweeps)`` ALS sweeps for all ``regs`` (default: ``cfg.reg``).

    Keeps the user and item factors after each count in ``sweeps`` (the run to
    30 passes through 15 from the same start); ``trial`` is the place in
    ``regs``. So a grid needs one run per rank. Each sweep solves items from
    users, then users from items (as Spark ML does). ``ratings`` should read a
    written table: every sweep reads it twice. Sweep counts start at 1.
    """
    u, i, r, k = cfg.user, cfg.item, cfg.rating, cfg.rank
    wanted, regs = sorted(set(sweeps)), regs or [cfg.reg]
    if not wanted or wanted[0] < 1 or cfg.write_every < 1:
        raise ValueError(f"sweep counts start at 1: {sweeps!r}")
    if wanted[-1] * len(regs) * (len(_pairs(k)) + k) >= PACKED_SUMS:
        return _fit_packed(ratings, cfg, ws, wanted, regs)
    spark = ratings.sparkSession
    blocks = block_count(spark, cfg.partitions)
    data = ratings.select(u, i, r)
    user_counts = ws.materialize(data.groupBy(u).agg(F.count(F.lit(1)).alias("n")), "als_user_counts")
    item_counts = ws.materialize(data.groupBy(i).agg(F.count(F.lit(1)).alias("n")), "als_item_counts")
    n_users, n_items = user_counts.count(), item_counts.count()
    to_items = BlockLayout(data, i, u, item_counts, n_users * len(regs), k, blocks, cfg.salt_cap, ws)
    to_users = BlockLayout(data, u, i, user_counts, n_items * len(regs), k, blocks, cfg.salt_cap, ws)
    path: dict[int, tuple[DataFrame, DataFrame]] = {}
    fields = k * (k + 1) // 2 + 3 * k + 16
    with at_least(spark, CODEGEN_FIELDS, fields), held(spark, UNION_AS_ONE, "false"), held(spark, SORTED_BUCKETS, "true"):
        x, path_x = to_items.stage(initial_factors(user_counts.select(u), u, k, cfg.seed, len(regs)), "als_x0")
        stale = [path_x]
        for sweep in range(1, wanted[-1] + 1):
            keep = sweep in wanted
            y = solved(to_items.equations(x, r), i, k, regs)
            if keep or not to_users.broadcast:
                y, path_y = to_users.stage(y, f"als_y{sweep}")
                if not keep:
                    stale.append(path_y)
            x = solved(to_users.equations(y, r), u, k, regs)
            if not keep and sweep % cfg.write_every and to_items.broadcast:
                continue
            x, path_x = to_items.stage(x, f"als_x{sweep}")
            for path_old in stale:  # the tables written before are no longer read
                ws.remove(path_old)
            stale = [] if keep else [path_x]
            if keep:
                path[sweep] = (x, y)
    return path, n_users, n_items


def _fit_packed(ratings: DataFrame, cfg, ws, wanted: list[int], regs: list[float]) -> tuple[dict[int, tuple[DataFrame, DataFrame]], int, int]:
    """:func:`fit_normal_equations_path` with the half-steps of :mod:`sparkrec.operators.packed`."""
    u, i, r, k = cfg.user, cfg.item, cfg.rating, cfg.rank
    spark, trials = ratings.sparkSession, len(regs)
    data = ratings.select(u, i, F.col(r).alias("r"))
    user_counts = ws.materialize(data.groupBy(u).agg(F.count(F.lit(1)).alias("n")), "als_user_counts")
    item_counts = ws.materialize(data.groupBy(i).agg(F.count(F.lit(1)).alias("n")), "als_item_counts")
    n_users, n_items = user_counts.count(), item_counts.count()
    blocks = packed.enough_blocks(block_count(spark, cfg.partitions), max(n_users, n_items), k, trials)
    numbers, width = packed.seats(spark, blocks), packed.cell_width(k, trials)
    users = packed.Side(u, user_counts, "users", numbers, width, cfg.salt_cap, ws)
    items = packed.Side(i, item_counts, "items", numbers, width, cfg.salt_cap, ws)
    path: dict[int, tuple[DataFrame, DataFrame]] = {}
    settings = {UNION_AS_ONE: "false", SORTED_BUCKETS: "true", packed.AUTO_BUCKETS: "false", packed.BATCH_BYTES: str(packed.BATCH)}
    with ExitStack() as stack:
        for setting, value in settings.items():
            stack.enter_context(held(spark, setting, value))
        users.keys(), items.keys()
        to_items, to_users = packed.layouts(data, items, users, n_items, n_users, k, trials, ws)
        first = users.factors(initial_factors(user_counts.select(u), u, k, cfg.seed), k, trials)

        def written(factors: DataFrame, name: str) -> Stage:
            return ws.stage(factors, name, row_group=packed.ROW_GROUP)

        x, path_x = written(first, "als_x0")
        stale = [path_x]
        for sweep in range(1, wanted[-1] + 1):
            keep = sweep in wanted
            y = to_items.solved(x, regs)
            if keep or not to_users.broadcast:
                y, path_y = written(y, f"als_packed_y{sweep}" if keep else f"als_y{sweep}")
                stale.append(path_y)
            x = to_users.solved(y, regs)
            if not keep and sweep % cfg.write_every and to_items.broadcast:
                continue
            x, path_x = written(x, f"als_packed_x{sweep}" if keep else f"als_x{sweep}")
            if keep:
                path[sweep] = (ws.materialize(users.table(x, k, trials), f"als_x{sweep}"),
                               ws.materialize(items.table(y, k, trials), f"als_y{sweep}"))
            for path_old in stale:  # the tables written before are no longer read
                ws.remove(path_old)
            stale = [path_x]
        ws.remove(path_x)
        for layout in (to_items, to_users):
            ws.remove(layout.path)
    return path, n_users, n_items
