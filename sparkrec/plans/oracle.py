"""DuckDB SQL equivalents of the registered queries (independent oracle).

Written against the raw tables; shares only the rule text, the split hash
and the grid constants with the Spark side. Aggregates over non-integer
values are rounded to 6 digits on both sides; ``ROW_NUMBER`` is cast to INT.
"""

from __future__ import annotations

from sparkrec.functions.hashing import pair_bucket_sql, split_label_sql, unit_number_sql
from sparkrec.functions.rating import rating_sql
from sparkrec.operators.properties import PROPERTY_NAMES
from sparkrec.operators.split import SPLIT_NAMES, SPLIT_WEIGHTS
from sparkrec.plans.jobs import TUNE_ITERATIONS, TUNE_RANKS, TUNE_REGS
from sparkrec.plans.queries import DIGITS, EDGE_EVERY, FULL_DIGITS, GRID_REGS, ONE_USER, REFERENCE_ALS, REJECT_EVERY, SMALL_ALS, SMALL_GRID_ITERATIONS, SMALL_GRID_REGS, TOP_K

INTER = (
    "inter AS (SELECT CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS item_id, "
    "CAST(l_quantity AS FLOAT) AS hours, l_returnflag <> 'R' AS is_recommended "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)
AVGH = "avgh AS (SELECT item_id, avg(hours) AS avg_hours FROM inter GROUP BY item_id)"
JOINED = (
    "joined AS (SELECT i.user_id, i.item_id, i.hours, i.is_recommended, a.avg_hours "
    "FROM inter i JOIN avgh a ON i.item_id = a.item_id)"
)
RULED = f"ruled AS (SELECT *, {rating_sql()} AS rule FROM joined)"
RATED = (
    "rated AS (SELECT user_id, item_id, CAST(rule AS FLOAT) AS rating FROM ruled "
    "WHERE rule IS NOT NULL AND user_id IS NOT NULL)"
)
SPLIT = (
    f"sp AS (SELECT user_id, item_id, rating, "
    f"{split_label_sql(pair_bucket_sql(), SPLIT_NAMES, SPLIT_WEIGHTS)} AS split FROM rated)"
)
BASE = [INTER, AVGH, JOINED, RULED, RATED]


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _item_mean(source: str, name: str = "im") -> list[str]:
    """Item sums / counts and the global mean of a training set."""
    return [
        f"{name} AS (SELECT item_id, sum(CAST(rating AS DOUBLE)) AS s, count(*) AS n FROM {source} GROUP BY item_id)",
        f"{name}_mu AS (SELECT sum(s) / CAST(sum(n) AS DOUBLE) AS m FROM {name})",
    ]


SCORED_PAIRS = BASE + _item_mean("rated") + [
    "pairs AS (SELECT DISTINCT user_id, item_id FROM rated)",
    "scored AS (SELECT p.user_id, p.item_id, im.s / CAST(im.n AS DOUBLE) AS prediction "
    "FROM pairs p JOIN im ON p.item_id = im.item_id)",
    "ranked AS (SELECT user_id, item_id, prediction, CAST(ROW_NUMBER() OVER "
    "(PARTITION BY user_id ORDER BY prediction DESC, item_id ASC) AS INT) AS rank FROM scored)",
]

_grid_values = ", ".join(f"({n}, CAST({r!r} AS DOUBLE))" for n, r in enumerate(GRID_REGS))
GRID = BASE + [SPLIT] + _item_mean("(SELECT * FROM sp WHERE split = 'train')") + [
    f"g(trial_no, reg) AS (VALUES {_grid_values})",
    "ev AS (SELECT g.trial_no, g.reg, sp.split, "
    "sqrt(avg(power(sp.rating - (im.s + g.reg * im_mu.m) / (im.n + g.reg), 2))) AS e "
    "FROM g CROSS JOIN im_mu CROSS JOIN sp JOIN im ON sp.item_id = im.item_id "
    "WHERE sp.split <> 'train' GROUP BY g.trial_no, g.reg, sp.split)",
    "v AS (SELECT trial_no, reg, e AS validation_rmse FROM ev WHERE split = 'validation')",
    "t AS (SELECT trial_no, e AS test_rmse FROM ev WHERE split = 'test')",
    "b AS (SELECT trial_no FROM v ORDER BY validation_rmse, trial_no LIMIT 1)",
    f"trials AS (SELECT v.trial_no, CAST(NULL AS INT) AS rank, v.reg, CAST(NULL AS INT) AS iterations, "
    f"round(v.validation_rmse, {DIGITS}) AS validation_rmse, "
    f"CASE WHEN v.trial_no = b.trial_no THEN round(t.test_rmse, {DIGITS}) END AS test_rmse "
    f"FROM v JOIN t ON v.trial_no = t.trial_no CROSS JOIN b)",
]

R = f"round(prediction, {DIGITS}) AS prediction"


# Two ALS sweeps at rank 2: sums per key, then Cramer's rule. ``source`` is the training set.
def _als2(source: str, reg: float, sweeps: int, tag: str = "") -> list[str]:
    x = f"x0{tag}"
    g = [unit_number_sql("user_id", SMALL_ALS.seed, j) for j in range(2)]
    ctes = [
        f"g{tag} AS (SELECT user_id AS k, {g[0]} AS a, {g[1]} AS b FROM (SELECT DISTINCT user_id FROM {source}))",
        f"{x} AS (SELECT k, a / sqrt(a * a + b * b) AS f0, b / sqrt(a * a + b * b) AS f1 FROM g{tag})",
    ]
    for sweep in range(1, sweeps + 1):
        for name, own, other in ((f"y{sweep}{tag}", "item_id", "user_id"), (f"x{sweep}{tag}", "user_id", "item_id")):
            ctes.append(
                f"{name}_s AS (SELECT r.{own} AS k, sum(f0 * f0) + {reg!r} * count(*) AS a, sum(f0 * f1) AS b, "
                f"sum(f1 * f1) + {reg!r} * count(*) AS c, sum(CAST(rating AS DOUBLE) * f0) AS p, sum(CAST(rating AS DOUBLE) * f1) AS q "
                f"FROM {source} r JOIN {x} f ON r.{other} = f.k GROUP BY r.{own})"
            )
            ctes.append(f"{name} AS (SELECT k, (p * c - q * b) / (a * c - b * b) AS f0, (a * q - b * p) / (a * c - b * b) AS f1 FROM {name}_s)")
            x = name
    return ctes


def _als2_scored(pairs: str, sweeps: int, tag: str = "") -> str:
    return (
        f"SELECT r.*, x.f0 * y.f0 + x.f1 * y.f1 AS prediction FROM {pairs} r "
        f"JOIN x{sweeps}{tag} x ON r.user_id = x.k JOIN y{sweeps}{tag} y ON r.item_id = y.k"
    )


# A full run of any rank: one recursive step per half-step. ``e`` holds every rating
# twice, by the side whose factors are fixed; the small systems are solved by
# elimination, one nested SELECT per column. ``source`` is the training set.
def _als_full(source: str, rank: int, regs, sweeps: int, tag: str = "") -> list[str]:
    tri = [(p, q) for p in range(rank) for q in range(p, rank)]
    keys = "step, side, trial, reg, k"
    norm = "sqrt(" + " + ".join(f"g{j} * g{j}" for j in range(rank)) + ")"
    start = ", ".join(f"{unit_number_sql('user_id', REFERENCE_ALS.seed, j)} AS g{j}" for j in range(rank))
    trials = ", ".join(f"({t}, CAST({reg!r} AS DOUBLE))" for t, reg in enumerate(regs))
    sums = [f"sum(f{p} * f{q})" + (" + f.reg * count(*)" if p == q else "") + f" AS a{p}_{q}" for p, q in tri]
    sums += [f"sum(CAST(e.rating AS DOUBLE) * f{p}) AS b{p}" for p in range(rank)]
    body = (
        f"SELECT f.step + 1 AS step, CASE f.side WHEN 'user' THEN 'item' ELSE 'user' END AS side, f.trial, f.reg, e.own AS k, {', '.join(sums)} "
        f"FROM fac{tag} f JOIN e{tag} e ON f.side = e.side AND f.k = e.fixed WHERE f.step < {2 * sweeps} GROUP BY f.step, f.side, f.trial, f.reg, e.own"
    )
    for j in range(rank - 1):
        cols = [f"a{p}_{q} - a{j}_{p} / a{j}_{j} * a{j}_{q} AS a{p}_{q}" if p > j else f"a{p}_{q}" for p, q in tri]
        cols += [f"b{p} - a{j}_{p} / a{j}_{j} * b{j} AS b{p}" if p > j else f"b{p}" for p in range(rank)]
        body = f"SELECT {keys}, {', '.join(cols)} FROM ({body})"
    for j in reversed(range(rank)):
        left = [f"a{p}_{q}" for p, q in tri if p < j] + [f"b{p}" for p in range(j)]
        found = "".join(f" - a{j}_{q} * f{q}" for q in range(j + 1, rank))
        body = f"SELECT {', '.join([keys, *left, f'(b{j}{found}) / a{j}_{j} AS f{j}', *[f'f{q}' for q in range(j + 1, rank)]])} FROM ({body})"
    factors = ", ".join(f"f{j}" for j in range(rank))
    return [
        f"e{tag} AS MATERIALIZED (SELECT 'user' AS side, user_id AS fixed, item_id AS own, rating FROM {source} "
        f"UNION ALL SELECT 'item', item_id, user_id, rating FROM {source})",
        f"fac{tag} AS (SELECT 0 AS step, 'user' AS side, trial, reg, k, {', '.join(f'g{j} / {norm} AS f{j}' for j in range(rank))} "
        f"FROM (SELECT user_id AS k, {start} FROM (SELECT DISTINCT user_id FROM {source})), (VALUES {trials}) AS t(trial, reg) "
        f"UNION ALL SELECT step, side, trial, reg, k, {factors} FROM ({body}))",
        f"last{tag} AS MATERIALIZED (SELECT * FROM fac{tag} WHERE step > 0)",
    ]


def _full_scored(pairs: str, rank: int, sweeps: int, tag: str = "") -> str:
    dot = " + ".join(f"x.f{j} * y.f{j}" for j in range(rank))
    return (
        f"SELECT r.*, x.trial, x.reg, {dot} AS prediction FROM {pairs} r "
        f"JOIN last{tag} x ON x.side = 'user' AND x.step = {2 * sweeps} AND r.user_id = x.k "
        f"JOIN last{tag} y ON y.side = 'item' AND y.step = {2 * sweeps - 1} AND r.item_id = y.k AND x.trial = y.trial"
    )


def _recursive(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _full_lists(score: str, where: str = "") -> str:
    return (
        f"SELECT r.user_id, CAST(r.rank AS INT) AS rank, r.item_id, p.p_name AS title, round(CAST(r.score AS DOUBLE), {FULL_DIGITS}) AS prediction "
        f"FROM (SELECT *, {score} AS score, row_number() OVER (PARTITION BY user_id ORDER BY {score} DESC, item_id) AS rank "
        f"FROM ({_full_scored('pairs', REFERENCE_ALS.rank, REFERENCE_ALS.iterations)})) r JOIN part p ON r.item_id = p.p_partkey "
        f"WHERE r.rank <= {TOP_K}{where}"
    )


N_SWEEPS = SMALL_ALS.iterations
ALS2 = BASE + _als2("rated", SMALL_ALS.reg, N_SWEEPS)
TRAIN = [SPLIT, "train AS (SELECT * FROM sp WHERE split = 'train')"]
_small_trials = [(n, reg, it) for n, (reg, it) in enumerate((r, i) for r in SMALL_GRID_REGS for i in SMALL_GRID_ITERATIONS)]
ALS2_GRID = BASE + TRAIN + [c for n, reg, it in _small_trials for c in _als2("train", reg, it, f"_t{n}")] + [
    "ev AS (" + " UNION ALL ".join(
        f"SELECT {n} AS trial_no, CAST({reg!r} AS DOUBLE) AS reg, {it} AS iterations, split, sqrt(avg(power(rating - prediction, 2))) AS e "
        f"FROM ({_als2_scored('sp', it, f'_t{n}')}) WHERE split <> 'train' GROUP BY split" for n, reg, it in _small_trials) + ")",
    "v AS (SELECT trial_no, reg, iterations, e AS validation_rmse FROM ev WHERE split = 'validation')",
    "b AS (SELECT trial_no FROM v ORDER BY validation_rmse, trial_no LIMIT 1)",
]
_FULL = (REFERENCE_ALS.rank, (REFERENCE_ALS.reg,), REFERENCE_ALS.iterations)
FULL_ALL = BASE + _als_full("rated", *_FULL)
FULL_TRAIN = BASE + TRAIN + _als_full("train", *_FULL)
PAIRS = "pairs AS (SELECT DISTINCT user_id, item_id FROM rated)"
FULL_GRID = BASE + TRAIN + [c for k in TUNE_RANKS for c in _als_full("train", k, TUNE_REGS, max(TUNE_ITERATIONS), f"_{k}")] + [
    "held AS (SELECT * FROM sp WHERE split <> 'train')",
    "ev AS (" + " UNION ALL ".join(
        f"SELECT {n} * {len(TUNE_REGS) * len(TUNE_ITERATIONS)} + trial * {len(TUNE_ITERATIONS)} + {m} AS trial_no, {k} AS rank, reg, {it} AS iterations, "
        f"split, sqrt(avg(power(rating - prediction, 2))) AS e FROM ({_full_scored('held', k, it, f'_{k}')}) GROUP BY trial, reg, split"
        for n, k in enumerate(TUNE_RANKS) for m, it in enumerate(TUNE_ITERATIONS)) + ")",
    "v AS (SELECT trial_no, rank, reg, iterations, e AS validation_rmse FROM ev WHERE split = 'validation')",
    "b AS (SELECT trial_no FROM v ORDER BY validation_rmse, trial_no LIMIT 1)",
]
# What SQL can tell of a full run: a held-out pair is scored if its user and item are in the training set.
KNOWN = BASE + TRAIN + [
    "known AS (SELECT * FROM sp WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train))"
]
LISTED = BASE + ["pairs AS (SELECT user_id, count(DISTINCT item_id) AS c FROM rated GROUP BY user_id)"]
FLAG_EVERY, NAN_EVERY, NULL_EVERY = EDGE_EVERY
EDGES = [
    "inter AS (SELECT l_orderkey AS order_id, CAST(o_custkey AS INT) AS user_id, CAST(l_partkey AS INT) AS item_id, "
    f"CASE WHEN l_partkey % {NAN_EVERY} = 1 THEN CAST('NaN' AS FLOAT) WHEN (l_orderkey + l_partkey) % {NULL_EVERY} = 2 THEN NULL "
    f"ELSE CAST(l_quantity AS FLOAT) END AS hours, CASE WHEN l_orderkey % {FLAG_EVERY} = 0 THEN NULL ELSE l_returnflag <> 'R' END AS is_recommended "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
    AVGH,
    "joined AS (SELECT i.*, a.avg_hours FROM inter i JOIN avgh a ON i.item_id = a.item_id)",
    RULED,
]

_FLAG, _HOURS, _USER, _ITEM = REJECT_EVERY
FAULTY = (
    "lines AS (SELECT CAST(l_partkey AS INT) AS app, CAST(o_custkey AS INT) AS usr, CAST(l_shipdate AS DATE) AS date, "
    "l_returnflag <> 'R' AS flag, CAST(l_quantity AS FLOAT) AS h, "
    f"l_partkey % {_FLAG} = 1 AS bad_flag, l_partkey % {_HOURS} = 2 AS bad_hours, coalesce(o_custkey % {_USER} = 3, false) AS bad_user, l_partkey % {_ITEM} = 4 AS bad_item "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)

ORACLE: dict[str, str] = {
    "interactions_rejects": _with(FAULTY)
    + "SELECT CASE WHEN bad_flag OR bad_hours THEN 'malformed' WHEN bad_user THEN 'user_id' ELSE 'app_id' END AS reason, "
    "bad_flag OR bad_hours AS has_record, CASE WHEN bad_item THEN 'i' ELSE '' END || app AS app_id, date, "
    "CASE WHEN NOT bad_flag THEN flag END AS is_recommended, CASE WHEN NOT bad_hours THEN h END AS hours, "
    "CASE WHEN bad_user THEN 'u' ELSE '' END || usr AS user_id FROM lines WHERE bad_flag OR bad_hours OR bad_user OR bad_item",
    "predictions_bucketed": _with(*SCORED_PAIRS)
    + f"SELECT r.user_id, r.rank, r.item_id, p.p_name AS title, round(r.prediction, {FULL_DIGITS}) AS prediction "
    "FROM (SELECT user_id, item_id, score AS prediction, CAST(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS INT) AS rank "
    "FROM (SELECT *, CAST(CAST(prediction AS FLOAT) AS DOUBLE) AS score FROM scored)) r "
    f"JOIN part p ON r.item_id = p.p_partkey WHERE r.rank <= {TOP_K} AND r.user_id = {ONE_USER}",
    "interactions": _with(INTER) + "SELECT * FROM inter",
    "interactions_csv": _with(INTER) + "SELECT * FROM inter",
    "titles_csv_inferred": "SELECT CAST(p_partkey AS INT) AS item_id, p_name AS title FROM part",
    "titles_csv": "SELECT CAST(p_partkey AS INT) AS item_id, p_name AS title FROM part",
    "item_avg_hours": _with(INTER, AVGH) + "SELECT item_id, avg_hours FROM avgh",
    "with_item_avg": _with(INTER, AVGH, JOINED) + "SELECT item_id, user_id, hours, is_recommended, avg_hours FROM joined",
    "rating_rule": _with(INTER, AVGH, JOINED, RULED)
    + "SELECT user_id, item_id, hours, is_recommended, avg_hours, CAST(rule AS INT) AS rating FROM ruled",
    "ratings": _with(*BASE) + "SELECT user_id, item_id, rating FROM rated",
    "holdout_split": _with(*BASE, SPLIT) + "SELECT user_id, item_id, rating, split FROM sp",
    "rating_pairs": _with(*BASE) + "SELECT user_id, item_id FROM rated",
    "eval_pairs": _with(*BASE, SPLIT, *_item_mean("(SELECT * FROM sp WHERE split = 'train')"))
    + f"SELECT sp.user_id, sp.item_id, sp.rating, sp.split, round(im.s / CAST(im.n AS DOUBLE), {DIGITS}) AS prediction "
    "FROM sp JOIN im ON sp.item_id = im.item_id WHERE sp.split <> 'train'",
    "rmse": _with(*BASE, *_item_mean("rated"))
    + f"SELECT round(sqrt(avg(power(r.rating - im.s / CAST(im.n AS DOUBLE), 2))), {DIGITS}) AS rmse, count(*) AS n "
    "FROM rated r JOIN im ON r.item_id = im.item_id",
    "rmse_by_split": _with(*BASE, SPLIT, *_item_mean("(SELECT * FROM sp WHERE split = 'train')"))
    + f"SELECT sp.split, round(sqrt(avg(power(sp.rating - im.s / CAST(im.n AS DOUBLE), 2))), {DIGITS}) AS rmse, "
    "count(*) AS n FROM sp JOIN im ON sp.item_id = im.item_id GROUP BY sp.split",
    "grid_trials": _with(*GRID) + "SELECT * FROM trials",
    "grid_best": _with(*GRID) + "SELECT * FROM trials ORDER BY validation_rmse, trial_no LIMIT 1",
    "top_k_user": _with(*SCORED_PAIRS)
    + f"SELECT user_id, rank, item_id, {R} FROM ranked WHERE user_id = {ONE_USER} AND rank <= {TOP_K}",
    "top_k_all": _with(*SCORED_PAIRS) + f"SELECT user_id, rank, item_id, {R} FROM ranked WHERE rank <= {TOP_K}",
    "top_k_titles": _with(*SCORED_PAIRS)
    + f"SELECT r.user_id, r.rank, r.item_id, p.p_name AS title, round(r.prediction, {DIGITS}) AS prediction "
    f"FROM ranked r JOIN part p ON r.item_id = CAST(p.p_partkey AS INT) WHERE r.rank <= {TOP_K}",
    "top_k_titles_user": _with(*SCORED_PAIRS)
    + f"SELECT r.user_id, r.rank, r.item_id, p.p_name AS title, round(r.prediction, {DIGITS}) AS prediction "
    f"FROM ranked r JOIN part p ON r.item_id = CAST(p.p_partkey AS INT) WHERE r.rank <= {TOP_K} AND r.user_id = {ONE_USER}",
    "predictions_csv": _with(*BASE, *_item_mean("rated"))
    + "SELECT r.user_id, r.item_id AS app_id, CAST(im.s / CAST(im.n AS DOUBLE) AS FLOAT) AS rating_points "
    "FROM rated r JOIN im ON r.item_id = im.item_id",
    "eval_predictions": _with(*BASE, *_item_mean("rated"))
    + "SELECT r.user_id, r.item_id, r.rating, CAST(im.s / CAST(im.n AS DOUBLE) AS FLOAT) AS prediction "
    "FROM rated r JOIN im ON r.item_id = im.item_id",
    "rating_rule_edges": _with(*EDGES) + "SELECT order_id, user_id, item_id, is_recommended, CAST(rule AS INT) AS rating FROM ruled",
    "als2_factors": _with(*ALS2)
    + " UNION ALL ".join(
        f"SELECT '{side}' AS side, k AS id, round(f0, {DIGITS}) AS f0, round(f1, {DIGITS}) AS f1 FROM {name}{N_SWEEPS}"
        for side, name in (("user", "x"), ("item", "y"))),
    "als2_scores": _with(*ALS2) + f"SELECT user_id, item_id, rating, {R} FROM ({_als2_scored('rated', N_SWEEPS)})",
    "als2_eval": _with(*BASE, *TRAIN, *_als2("train", SMALL_ALS.reg, N_SWEEPS))
    + f"SELECT split, round(sqrt(avg(power(rating - prediction, 2))), {DIGITS}) AS rmse, count(*) AS n "
    f"FROM ({_als2_scored('sp', N_SWEEPS)}) GROUP BY split",
    "als2_lists": _with(*ALS2, "pairs AS (SELECT DISTINCT user_id, item_id FROM rated)")
    + f"SELECT r.user_id, CAST(r.rank AS INT) AS rank, r.item_id, p.p_name AS title, round(r.prediction, {DIGITS}) AS prediction "
    "FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY prediction DESC, item_id) AS rank "
    f"FROM ({_als2_scored('pairs', N_SWEEPS)})) r JOIN part p ON r.item_id = p.p_partkey WHERE r.rank <= {TOP_K}",
    "als2_grid": _with(*ALS2_GRID)
    + f"SELECT v.trial_no, {SMALL_ALS.rank} AS rank, v.reg, v.iterations, round(v.validation_rmse, {DIGITS}) AS validation_rmse, "
    f"CASE WHEN v.trial_no = b.trial_no THEN round(t.e, {DIGITS}) END AS test_rmse "
    "FROM v JOIN ev t ON v.trial_no = t.trial_no AND t.split = 'test' CROSS JOIN b",
    "als_scores": _recursive(*FULL_ALL)
    + f"SELECT user_id, item_id, rating, round(prediction, {FULL_DIGITS}) AS prediction FROM ({_full_scored('rated', _FULL[0], _FULL[2])})",
    "als_eval": _recursive(*FULL_TRAIN)
    + f"SELECT split, round(sqrt(avg(power(rating - prediction, 2))), {DIGITS}) AS rmse, count(*) AS n "
    f"FROM ({_full_scored('sp', _FULL[0], _FULL[2])}) GROUP BY split",
    "als_recommend": _recursive(*FULL_ALL, PAIRS) + _full_lists("prediction"),
    "als_recommend_user": _recursive(*FULL_ALL, PAIRS) + _full_lists("CAST(prediction AS FLOAT)", f" AND r.user_id = {ONE_USER}"),
    "als_grid": _recursive(*FULL_GRID)
    + f"SELECT v.trial_no, v.rank, v.reg, v.iterations, round(v.validation_rmse, {DIGITS}) AS validation_rmse, "
    f"CASE WHEN v.trial_no = b.trial_no THEN round(t.e, {DIGITS}) END AS test_rmse "
    "FROM v JOIN ev t ON v.trial_no = t.trial_no AND t.split = 'test' CROSS JOIN b",
    "als_scored_pairs": _with(*BASE) + "SELECT user_id, item_id, count(*) AS n FROM rated GROUP BY user_id, item_id",
    "als_eval_rows": _with(*KNOWN) + "SELECT split, count(*) AS n FROM known GROUP BY split",
    "als_list_lengths": _with(*LISTED)
    + f"SELECT user_id, least(c, {TOP_K}) AS n, CAST(least(c, {TOP_K}) AS INT) AS last_rank FROM pairs",
    "als_properties": "SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', true)" for n in PROPERTY_NAMES)
    + ") AS t(property, holds)",
}
