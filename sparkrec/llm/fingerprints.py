"""Document fingerprints as invertible Bloom lookup sketches (operator 4, DataFrame functions only).

A text's paragraphs (its sentences and lines) are hashed to 64-bit digests.
A sketch adds every digest to one cell in each of three tables; a cell keeps a
count, the exclusive or of its digests and of their checks. Two texts' sketches
subtract cell by cell, so shared paragraphs vanish, and peeling the cells that
hold a single digest recovers the paragraphs on either side. The fingerprint
is a small sketch of fixed size; when the difference of two is too large to be
peeled, larger ones are made: the digest range is cut into so many shards that
each holds few digests; a shard that does not peel is cut in two, then in four,
until all its parts do. Should ``RETRIES`` sizes fail, the digests are compared
directly. Work per text is in proportion to its length.

Likeness of two texts: shared paragraphs over all paragraphs, from the counts
and the peeled differences (1 when neither has any).

Edge cases: a null text is empty; an empty text has no paragraphs; of rows
with equal ids the next document is the one with the next text; a null id
comes first; a single document is its own next one; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrec.llm.common import FIRST_ID, documents, first_not_below, hash_buckets, let, pick, range_bucket

PARAGRAPH_END = r"[\n.!?]+"
TABLES = 3
BASE_CELLS = 8  # a table, in the fingerprint
SHARD_CELLS = 8  # a table, in a shard of a larger sketch
SHARD_BITS = 2  # about 2 ** SHARD_BITS digests a shard
ROUNDS = 24
RETRIES = 6
ROWS_PER_BUCKET = 1_000


def digests(text: Column) -> Column:
    """Sorted distinct paragraph digests."""
    parts = F.filter(F.transform(F.split(text, PARAGRAPH_END), lambda p: F.trim(p)), lambda p: p != "")
    return F.array_sort(F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p))))


def _placed(keys: Column, seed: Column, cells: int, sign: Column | None = None) -> Column:
    """Digest, check and the digest's cell in each table."""
    bits = cells.bit_length() - 1

    def place(k, s):
        return let(
            F.xxhash64(k, seed),
            lambda h: F.struct(
                s.alias("s"), k.alias("k"), F.shiftrightunsigned(h, 32).alias("h"),
                *[(F.shiftrightunsigned(h, bits * t).bitwiseAND(F.lit(cells - 1)) + cells * t).cast("int").alias(f"p{t}") for t in range(TABLES)],
            ),
        )

    if sign is not None:
        return F.transform(keys, lambda x: place(x["k"], x["s"]))
    return F.transform(keys, lambda k: place(k, F.lit(1)))


def _cell(c, k, h) -> Column:
    return F.struct(c.cast("int").alias("c"), k.alias("k"), h.alias("h"))


def _plus(cell: Column, p: Column, times: int) -> Column:
    return _cell(cell["c"] + p["s"] * times, cell["k"].bitwiseXOR(p["k"]), cell["h"].bitwiseXOR(p["h"]))


def _changed(placed: Column, t: int, at: Column, cell: Column, times: int) -> Column:
    """The cell at ``at`` of table ``t`` with the digests placed there; most cells get none."""
    there = F.filter(placed, lambda p: p[f"p{t}"] == at)
    return F.when(F.array_contains(placed[f"p{t}"], at), F.aggregate(there, cell, lambda acc, p: _plus(acc, p, times))).otherwise(cell)


def sketch(keys: Column, seed: Column, cells: int) -> Column:
    """The cells of a set of digests, table after table."""
    empty = _cell(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))

    def table(placed, t):
        return F.transform(
            F.sequence(F.lit(t * cells), F.lit((t + 1) * cells - 1)),
            lambda i: _changed(placed, t, i, empty, 1),
        )

    def filled(placed):
        return F.concat(*[table(placed, t) for t in range(TABLES)])

    return let(_placed(keys, seed, cells), filled)


def peel(a: Column, b: Column, seed: Column, cells: int) -> Column:
    """``(left, right)``: how many digests only one side has; null when peeling stops early."""
    diff = F.zip_with(a, b, lambda x, y: _cell(x["c"] - y["c"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"])))

    def step(state, _):
        single = F.filter(state["cells"], lambda x: (F.abs(x["c"]) == 1) & (F.shiftrightunsigned(F.xxhash64(x["k"], seed), 32) == x["h"]))
        pure = F.array_distinct(F.transform(single, lambda x: F.struct(x["c"].alias("s"), x["k"].alias("k"))))

        def table(found, t):
            return F.transform(
                F.slice(state["cells"], t * cells + 1, cells),
                lambda x, i: _changed(found, t, i + t * cells, x, -1),
            )

        def without(found):
            return F.struct(
                F.concat(*[table(found, t) for t in range(TABLES)]).alias("cells"),
                (state["left"] + F.size(F.filter(found, lambda p: p["s"] > 0))).alias("left"),
                (state["right"] + F.size(F.filter(found, lambda p: p["s"] < 0))).alias("right"),
                F.lit(True).alias("open"),
            )

        ended = F.struct(*[state[x].alias(x) for x in ("cells", "left", "right")], F.lit(False).alias("open"))
        more = let(pure, lambda p: F.when(F.size(p) == 0, ended).otherwise(let(_placed(p, seed, cells, p), without)))
        return F.when(state["open"], more).otherwise(state)

    def counts(end):
        clean = F.forall(end["cells"], lambda x: (x["c"] == 0) & (x["k"] == 0) & (x["h"] == 0))
        return F.when(clean, F.struct(end["left"].alias("left"), end["right"].alias("right")))

    start = F.struct(diff.alias("cells"), F.lit(0).alias("left"), F.lit(0).alias("right"), F.lit(True).alias("open"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, counts)


def cuts(keys: Column, level: Column, first: Column, last: Column) -> Column:
    """Index of the first digest of each of the ``first``-th to ``last``-th of ``2 ** level`` equal ranges (past the last range: their number)."""
    edge = lambda i: F.call_function("shiftleft", i.cast("bigint"), F.lit(64) - level).bitwiseXOR(F.lit(FIRST_ID))
    ranges = F.call_function("shiftleft", F.lit(1), level)
    return F.transform(
        F.sequence(first, last),
        lambda i: F.when(i == 0, F.lit(0)).when(i == ranges, F.size(keys)).otherwise(first_not_below(keys, edge(i))),
    )


def shard(keys: Column, at: Column, i: Column) -> Column:
    """The digests between the ``i``-th and the next of the cuts."""
    return F.slice(keys, F.get(at, i) + 1, F.get(at, i + 1) - F.get(at, i))


def _sharded(a: Column, b: Column, level: Column) -> Column:
    """The difference by ``2 ** level`` shards, those that fail cut smaller; null if one never peels."""

    def one(left, right, seed):
        pair = F.struct(left.alias("a"), right.alias("b"))
        difference = lambda s: peel(sketch(s["a"], seed, SHARD_CELLS), sketch(s["b"], seed, SHARD_CELLS), seed, SHARD_CELLS)
        # nothing to subtract: the whole other side is the difference
        alone = lambda s: F.struct(F.size(s["a"]).alias("left"), F.size(s["b"]).alias("right"))
        return let(pair, lambda s: F.when((F.size(s["a"]) == 0) | (F.size(s["b"]) == 0), alone(s)).otherwise(difference(s)))

    def total(found):
        add = lambda acc, x: F.struct((acc["left"] + x["left"]).alias("left"), (acc["right"] + x["right"]).alias("right"))
        zero = F.struct(F.lit(0).alias("left"), F.lit(0).alias("right"))
        return F.when(F.forall(found, lambda x: x.isNotNull()), F.aggregate(found, zero, add))

    def by_shard(depth, first, count):
        """The differences of ``count`` shards of ``2 ** depth``, the ``first``-th and following."""
        at = F.struct(cuts(a, depth, first, first + count).alias("a"), cuts(b, depth, first, first + count).alias("b"))
        each = lambda c: F.transform(F.sequence(F.lit(0), count - 1), lambda i: one(shard(a, c["a"], i), shard(b, c["b"], i), depth + 1))
        return let(at, each)

    def parts(g, r):
        shift = lambda x: F.call_function("shiftleft", x, r)
        return let(by_shard(level + r, shift(g), shift(F.lit(1))), total)

    def tried(found, g):
        step = lambda acc, r: F.when(acc.isNotNull(), acc).otherwise(parts(g, r))
        return F.when(found.isNotNull(), found).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(RETRIES - 1)), F.lit(None).cast("struct<left:int,right:int>"), step))

    return let(F.transform(by_shard(level, F.lit(0), F.call_function("shiftleft", F.lit(1), level)), tried), total)


def likeness(a: Column, b: Column, base_a: Column, base_b: Column) -> Column:
    """Shared over all paragraphs of two digest arrays, by peeling sketches of growing size."""
    seed = F.lit(0)
    first = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.size(a), F.size(b), F.lit(1)))).cast("int") - SHARD_BITS)
    small = F.when(F.abs(F.size(a) - F.size(b)) <= TABLES * BASE_CELLS, peel(base_a, base_b, seed, BASE_CELLS))
    direct = F.struct(F.size(F.array_except(a, b)).alias("left"), F.size(F.array_except(b, a)).alias("right"))
    diff = F.coalesce(small, let(first, lambda level: _sharded(a, b, level)), direct)

    def ratio(d):
        every = F.size(a) + d["right"]
        return F.when(every == 0, F.lit(1.0)).otherwise((F.size(a) - d["left"]) / every)

    return let(diff, ratio)


def written(cells: Column, n: Column) -> Column:
    """A sketch as text: the number of paragraphs, then every cell in hexadecimal."""
    one = lambda x: F.concat(F.lpad(F.hex(x["k"]), 16, "0"), F.lpad(F.hex(x["h"]), 8, "0"), F.hex(x["c"].cast("bigint")))
    return F.concat_ws(":", n.cast("string"), F.array_join(F.transform(cells, one), "."))


def with_next_text(docs: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``doc_id, text, next_text`` (of the next id; after the last one, the first).

    Ids are cut into equal ranges at their quantiles. A window inside a range
    gives the next text; the first document of a range is also sent to the
    range before it, as its end. Only ids reach the quantile job, and only
    one id per range the driver.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(FIRST_ID)).alias("key"))
    n = rows.count()
    buckets = hash_buckets(n, rows_per_bucket)
    located = rows.withColumn("bucket", range_bucket(rows, "key", buckets))
    firsts = {r["bucket"]: r["key"] for r in located.groupBy("bucket").agg(F.min("key").alias("key")).collect()}
    if not firsts:
        return rows.select("doc_id", "text", F.col("text").alias("next_text"))
    order = sorted(firsts)
    size = order[-1] + 1
    first = F.lit([firsts.get(i, 0) for i in range(size)]).cast("array<bigint>")
    before = F.lit([order[order.index(i) - 1] if i in firsts else 0 for i in range(size)]).cast("array<int>")
    own = F.struct(F.col("bucket").cast("int").alias("bucket"), F.lit(0).alias("end"))
    as_end = F.struct(F.get(before, F.col("bucket")).alias("bucket"), F.lit(1).alias("end"))
    sent = F.when(F.get(first, F.col("bucket")) == F.col("key"), F.array(own, as_end)).otherwise(F.array(own))
    dealt = located.select("doc_id", "text", "key", F.explode(sent).alias("to")).select("doc_id", "text", "key", "to.bucket", "to.end")
    following = F.lead("text").over(Window.partitionBy("bucket").orderBy("end", "key", "text"))
    return dealt.withColumn("next_text", following).where("end = 0").select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    rows = with_next_text(pick(docs, doc_id=doc_id, text=text))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))

    def of_texts(edit):
        sets = F.struct(digests(F.col("text")).alias("a"), digests(edit).alias("e"), digests(F.col("next_text")).alias("n"))

        def of_sets(s):
            bases = F.struct(*[sketch(s[x], F.lit(0), BASE_CELLS).alias(x) for x in "aen"])
            return let(bases, lambda b: F.struct(
                F.sha2(edit, 256).alias("edited_sha256"),
                written(b["a"], F.size(s["a"])).alias("fingerprint"),
                written(b["e"], F.size(s["e"])).alias("edited_fingerprint"),
                likeness(s["a"], s["e"], b["a"], b["e"]).alias("near_edited"),
                likeness(s["a"], s["n"], b["a"], b["n"]).alias("near_next"),
            ))

        return let(sets, of_sets)

    return rows.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), let(edited, of_texts).alias("r")).select("doc_id", "n_chars", "r.*")


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
