"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkrec.llm import fingerprints, jaccard, langid, mixing, packing, pii, quality, secrets, substrings, token_files
from sparkrec.llm.common import scratch

LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(30_000))
SCHEMA = "doc_id bigint, text string, lang string, source string, size bigint, target double, bucket string, node string, key string, row string, kept_id bigint, kept_key bigint"
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away from here", "en", "a"),
    (1, "the quick brown fox jumps over the lazy dog and runs far away from here", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, "   \n\t ", None, "b"),
    (5, LONG, "en", None),
    (None, "une phrase avec des mots et encore des mots pour le test", "fr", "a"),
    (7, "x", "fr", "c"),
    (9, "12345 !!! ---", None, "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, 5, 0.5, "b", "n", "k", "r", 1, 2) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _model(docs):
    return langid.fit(docs.select("doc_id", "text", "lang"), docs_per_lang=50)


OPERATORS = {
    "language": lambda d: langid.predict(d, _model(d)),
    "accepted": lambda d: langid.accepted(d, _model(d)),
    "substrings": substrings.remove_repeats,
    "packing": packing.pack,
    "fingerprints": fingerprints.fingerprints,
    "mixing": mixing.mix,
    "copies": mixing.copies,
    "quality": quality.host_quality,
    "jaccard": jaccard.jaccard_components,
    "one_of_each": jaccard.one_of_each_group,
    "pii": lambda d: pii.pseudonymise(d, "k"),
    "secrets": lambda d: secrets.scan(d, secrets.fit(d)),
    "redaction": lambda d: secrets.without_secrets(d, secrets.fit(d)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_an_empty_result(empty, name):
    assert OPERATORS[name](empty).count() == 0


ONE_ROW_EACH = ["language", "substrings", "fingerprints", "mixing", "quality", "jaccard", "pii", "secrets", "redaction"]


@pytest.mark.parametrize("name", ONE_ROW_EACH)
def test_one_row_per_document(docs, name):
    got = [r["doc_id"] for r in OPERATORS[name](docs).select("doc_id").collect()]
    assert sorted(got, key=str) == sorted([r[0] for r in ROWS], key=str)


@pytest.mark.parametrize("name", ["accepted", "copies", "one_of_each", "redaction"])
def test_stages_keep_all_columns(docs, name):
    assert OPERATORS[name](docs).columns == docs.columns


def test_texts_without_a_letter_are_undetermined(docs):
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in OPERATORS["language"](docs).collect()}
    assert [got[i] for i in (2, 3, 4, 9)] == [("und", 0.0)] * 4
    assert got[1][0] == "en" and got[None][0] == "fr" and 0 < got[5][1] <= 1


def test_no_labels_teach_nothing(docs):
    model = langid.fit(docs.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r["lang_pred"] for r in langid.predict(docs, model).collect()} == {"und"}


def test_short_and_null_texts_are_kept_whole(docs):
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs).where("doc_id in (1, 2, 3, 7)").collect()}
    assert got[2]["n_bytes"] == 0 and got[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[1]["n_removed"] == 0  # rows with equal ids do not remove each other's bytes
    assert got[7]["n_bytes"] == 1


def test_every_piece_has_one_place(docs):
    rows = packing.pack(docs).collect()
    assert sum(r["length"] for r in rows) == sum({(str(r["doc_id"]), r["doc_tokens"]): r["doc_tokens"] * (2 if r["doc_id"] == 1 else 1) for r in rows}.values())
    seen = {}
    for r in rows:
        seen.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in seen.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW


def test_token_files_round_trip(spark, docs, empty):
    folder = scratch(spark, "t-files").location("ids")
    manifest = token_files.write_token_files(docs, folder, file_bytes=2_000)
    rows = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == [None, 1, 1, 2, 3, 4, 5, 7, 9]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += len(r["ids"]) // 4
    some = token_files.read_token_files(manifest, folder, [5, 2]).collect()
    assert {r["doc_id"]: r["ids"] for r in some} == {r["doc_id"]: r["ids"] for r in rows if r["doc_id"] in (2, 5)}
    folder = scratch(spark, "t-files").location("none")
    assert token_files.read_token_files(token_files.write_token_files(empty, folder), folder).count() == 0


def test_damaged_frame_is_found(spark, docs):
    folder = scratch(spark, "t-files").location("ids")
    name = token_files.write_token_files(docs.where("doc_id = 5"), folder).first()["file"]
    filesystem, path = token_files.open_folder(folder)
    with open(f"{path}/{name}", "r+b") as f:
        f.seek(40)
        f.write(b"\xff\xff\xff\xff")
    with pytest.raises(Exception):
        list(token_files.read_frames(filesystem, f"{path}/{name}"))


def test_next_of_the_last_is_the_first(spark):
    rows = [(i, f"a{i}. b{i}. c{i}. d{i}") for i in (3, 1, 2, 10, 20, 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    texts = dict(rows)
    order = sorted(texts)
    for per_bucket in (1, 2, 100):
        got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next_text(docs, per_bucket).collect()}
        assert got == {a: texts[b] for a, b in zip(order, order[1:] + order[:1])}


def test_mix_meets_its_budget(spark):
    rows = [(i, "w " * (1 + i % 7), "abc"[min(i % 10, 2)]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max(F.col("taken") / F.col("size")).alias("m"))
    for r in got.collect():
        assert abs(r["t"] - r["g"]) < 1 and r["m"] <= 3
    again = mixing.mix(docs.repartition(7))
    assert sorted(map(tuple, again.drop("text_key").collect())) == sorted(map(tuple, mixing.mix(docs).drop("text_key").collect()))


def test_components_of_repeated_and_null_rows(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect()}
    assert got[1] == (11, 1) and got[2] == (0, 2) and got[3] == (0, 3) and got[7] == (1, 7)
    kept = [r["doc_id"] for r in jaccard.one_of_each_group(docs).collect()]
    assert kept.count(1) == 1 and len(kept) == len(ROWS) - 1


def test_one_of_each_group_with_null_and_repeated_ids(spark):
    """Against brute force: components of null ids only, of mixed ids, of one id with several texts, repeated rows."""
    rng = np.random.default_rng(13)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 4))
    rows = []
    for ids in ([None] * 4, [None, 10, 11], [20, 20, 20], [31, 30, 30, None], [None, None], [40]):
        base = [word() for _ in range(60)]
        for k, i in enumerate(ids):
            rows.append((i, " ".join(base[: 60 - k] + [word() for _ in range(k)])))
    rows += [rows[0], rows[7], (None, None), (50, ""), (None, "   ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.xxhash64("text"))
    keyed = [(r["doc_id"], r["text"], r["key"]) for r in docs.collect()]
    sets = [jaccard.shingles(t) for _, t, _ in keyed]
    label = list(range(len(keyed)))
    for _ in keyed:
        for a, s in enumerate(sets):
            for b, t in enumerate(sets):
                both = len(np.intersect1d(s, t))
                if both and 100 * both >= 80 * (len(s) + len(t) - both):
                    label[a] = label[b] = min(label[a], label[b])
    groups = {}
    for (i, t, key), c, s in zip(keyed, label, sets):
        if len(s):
            groups.setdefault(c, []).append((i is None, i or 0, key, i, t))
    want = [min(g)[3:] for g in groups.values()] + [(i, t) for (i, t, _), s in zip(keyed, sets) if not len(s)]
    got = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each_group(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(groups) == 6
