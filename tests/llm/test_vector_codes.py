"""Vector codes: exact products, and the whole operator against plain Python integers."""

import hashlib
import math

import numpy as np
import pytest

from sparkrec.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error bigint, of_label int, slot int"


@pytest.mark.parametrize("size", [1, 1 << 12, 1 << 26, 1 << 28])
def test_products_are_exact(size):
    rng = np.random.default_rng(5)
    a, b = rng.integers(-size, size + 1, (40, 8)), rng.integers(-size, size + 1, (16, 8))
    assert vc.products(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]


def test_the_first_of_equal_entries_wins():
    index, error = vc.nearest(np.array([[0, 0], [5, 5]]), np.array([[1, 0], [0, 1], [5, 5], [5, 5]]))
    assert index.tolist() == [0, 2] and error.tolist() == [1, 0]


def brute(rows, entries, rounds, parts=8):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts) * parts
    w = width // parts
    cut = [(i, [(v + [0] * (width - len(v)))[p * w : p * w + w] for p in range(parts)], lab) for i, v, lab in kept]
    first = sorted(cut, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p] for r in first] for p in range(parts)]

    def place(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = {}
            for _, x, _ in cut:
                groups.setdefault(place(p, x[p])[0], []).append(x[p])
            new.append([[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])])
        books = new
    sha = hashlib.sha256(",".join(str(n) for b in books for e in b for n in e).encode()).hexdigest()
    out = []
    for i, x, lab in cut:
        at = [place(p, x[p]) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for k, _ in at), sum(e for _, e in at), lab))
    return [(i, c, e, sum(f for _, _, f, m in out if m == lab), sha) for i, c, e, lab in out]


def _rows():
    rng = np.random.default_rng(11)
    vec = lambda n: [float(np.float32(x)) for x in rng.normal(0, 0.2, n)]
    rows = [(i, vec(20), [1, 1, 1, None, 2][i % 5]) for i in range(120)]
    rows += [(3, vec(20), 1), rows[5], rows[5], (None, vec(20), 3), (None, vec(20), None), (200, vec(7), 2), (201, [], 2), (-4, vec(20), None)]
    bad = [(300, None, 1), (301, vec(19) + [float("nan")], 1), (302, [float("inf")] + vec(19), 1), (303, [None] + vec(30), 1), (None, None, None)]
    return rows + bad


@pytest.mark.parametrize("entries,rounds", [(16, 6), (5, 1), (256, 2)])
def test_equals_plain_integers(spark, entries, rounds):
    rows = _rows()
    df = spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], SCHEMA).repartition(4)
    got, books = vc.compress(df, entries=entries, rounds=rounds)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(rows, entries, rounds), key=repr)
    assert books.entries.shape[1] == min(entries, len([1 for r in rows if r[0] is None or r[0] < 300]) - 1)


def test_fewer_vectors_than_entries_and_none(spark):
    rows = [(2, [0.5] * 8, None), (1, [0.25] * 8, None)]
    df = spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], SCHEMA)
    assert sorted(map(tuple, vc.compress(df)[0].collect())) == sorted(brute(rows, 16, 6))
    for none in (df.limit(0), spark.createDataFrame([(1, None, 2, "c", 1, 2, 3)], SCHEMA)):
        assert vc.compress(none)[0].count() == 0


def test_components_too_large_for_a_long_are_named(spark):
    df = spark.createDataFrame([(1, [3e30] * 8, 1, "c", 1, 2, 3)], SCHEMA)
    with pytest.raises(Exception, match="would not fit in a long"):
        vc.compress(df)[0].collect()


def test_only_empty_vectors(spark):
    df = spark.createDataFrame([(i, [], 1, "c", 1, 2, 3) for i in range(3)], SCHEMA)
    assert {(r["code"], r["error"]) for r in vc.compress(df)[0].collect()} == {("00" * 8, 0)}
