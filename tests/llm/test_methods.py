"""The operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_TINY
from sparkrec.llm import common, fingerprints, jaccard, langid, mixing, packing, pii, secrets, substrings, token_ids
from sparkrec.llm.queries import QUERIES


@pytest.fixture(scope="module")
def rows():
    table = pq.read_table(f"{SF_TINY}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    return sorted(table, key=lambda r: r["doc_id"])


def _result(spark, name):
    return {r["doc_id"]: r for r in QUERIES[name](spark, SF_TINY).collect()}


# ------------------------------------------------------------------ language


def test_forward_pass_sums_all_segmentations():
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(langid.VOCABULARY)
    own = langid.pieces(path)
    p = np.random.default_rng(0).random((own.size, 2))
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    known = {sp.id_to_piece(i): i for i in range(own.size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}

    def brute(s):
        if not s:
            return np.ones(2)
        total = np.zeros(2)
        for k in range(1, len(s) + 1):
            if s[:k] in known:
                total = total + p[known[s[:k]]] * brute(s[k:])
            elif k == 1:
                total = total + p[own.byte_ids[list(s[0].encode())]].prod(axis=0) * brute(s[1:])
        return total

    for word in ["the", "nations", "éoirée", "日本語x", "ß"]:
        spans, extra = own.lattice([word])
        got = langid.forward(spans, own.rows(p, extra))[-1][0]
        assert np.allclose(got, brute(langid.WORD_START + word))


def test_held_out_accuracy(spark, rows):
    got, lang = _result(spark, "op1_language_id"), {r["doc_id"]: r["lang"] for r in rows}
    held = [d for d, r in got.items() if r["held_out"]]
    assert sum(got[d]["lang_pred"] == lang[d] for d in held) >= 0.98 * len(held)


def test_long_runs_outside_the_vocabulary_stay_in_range():
    """Runs of 64 Lao, Khmer and Burmese letters against sums of logarithms."""
    own = langid.pieces(public_tokenizers_path())
    rng = np.random.default_rng(8)
    p = np.full((own.size, 2), 1.0 / own.size)
    p[own.byte_ids, 1] *= rng.uniform(0.1, 4.0, 256)
    for first in (0x0E81, 0x1780, 0x1000):
        run = "".join(chr(first + int(i)) for i in rng.integers(0, 30, 64))
        spans, extra = own.lattice([run, "e" * 64])
        rows = own.rows(p, extra)
        at = np.full((66, 2), -np.inf)
        at[0] = 0.0
        with np.errstate(divide="ignore"):
            for e in range(1, 66):
                for k in range(min(len(spans), e)):
                    at[e] = np.logaddexp(at[e], at[e - k - 1] + np.log(rows[spans[k][0, e - k - 1]]))
        got = langid.log_probability(spans, rows)
        assert at[65].max() < -600 and np.allclose(got[0], at[65], rtol=1e-9)
        assert np.allclose(got[1], np.log(langid.forward(spans, rows)[-1][1]), rtol=1e-9)
        counts = langid.expected_counts(spans, rows, np.ones((2, 2)))
        lacking, uses = np.unique(spans[0][0][spans[0][0] >= own.size], return_counts=True)
        assert np.isfinite(counts).all() and np.allclose(counts[lacking], uses[:, None])


def public_tokenizers_path():
    import public_tokenizers

    return public_tokenizers.path(langid.VOCABULARY)


@pytest.mark.parametrize("ids", [10, 700])
def test_last_draws_equal_a_full_sort(spark, ids):
    rng = np.random.default_rng(9)
    rows = [("a" if i % 3 else "b", int(x)) for i, x in enumerate(rng.integers(0, ids, 3_000))] + [("c", 1), ("c", 2)]
    drawn = spark.createDataFrame(rows, "kind string, id bigint").select("kind", F.xxhash64("id").alias("draw"))
    by = defaultdict(list)
    for r in drawn.collect():
        by[r["kind"]].append(r["draw"])
    assert common.last_draws(drawn, 40) == {x: sorted(v)[min(40, len(v)) - 1] for x, v in by.items()}


# ---------------------------------------------------------------- substrings


def _kept(rows):
    first, out = {}, {}
    for doc_id, data in sorted(rows):
        mask = np.zeros(len(data) + 2, bool)
        for p in range(len(data) - 49):
            if first.setdefault(data[p : p + 50], doc_id) < doc_id:
                mask[p + 1 : p + 51] = True
        out[doc_id] = (int(mask.sum()), int((mask[1:] & ~mask[:-1]).sum()), hashlib.sha256(bytes(b for b, m in zip(data, mask[1:]) if not m)).hexdigest())
    return out


def test_removed_bytes_equal_brute_force(spark, rows):
    want = _kept([(r["doc_id"], (r["text"] or "").encode()) for r in rows])
    got = _result(spark, "op2_suffix_dedup")
    assert {d: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for d, r in got.items()} == want


def test_shared_passages_of_a_hot_group(spark, monkeypatch):
    """Every document has the same passage in other surroundings; groups are salted."""
    monkeypatch.setattr(substrings, "HOT_ROWS", 4)
    rng = np.random.default_rng(1)
    noise = lambda n: "".join(rng.choice(list("abcdefgh é"), n))
    passage = noise(70)
    texts = [(i, noise(60) + passage[: 50 + i % 21] + noise(40) + (passage if i % 5 == 0 else "")) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in substrings.remove_repeats(docs).collect()}
    assert got == _kept([(i, t.encode()) for i, t in texts])


def test_equal_hashes_of_other_bytes_remove_nothing(spark):
    """With no bit of the span's hash compared, all spans of one anchor collide: the bytes decide."""
    rng = np.random.default_rng(5)
    noise = lambda n: "".join(rng.choice(list("abcdefghijkl é"), n))
    passage, long = noise(20), noise(400)
    texts = [(i, noise(30) + passage + noise(30)) for i in range(40)]
    texts += [(100, long), (101, long), (102, noise(90) + long[100:300]), (103, long[:200] + noise(60))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    want = _kept([(i, t.encode()) for i, t in texts])
    assert sum(n for d, (n, *_) in want.items() if d < 100) == 0 and want[101][0] > 0
    for bits, parts in ((0, 1), (0, 30), (64, 30)):
        got = substrings.remove_repeats(docs.repartition(parts), hash_bits=bits).collect()
        assert {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_sorts_are_cut_between_groups(monkeypatch):
    monkeypatch.setattr(substrings, "SORT_STRINGS", 25)
    rng = np.random.default_rng(6)
    ask = np.sort(rng.integers(0, 12, 60))
    data = [bytes(rng.integers(97, 99, 50 + int(n)).astype(np.uint8)) for n in rng.integers(0, 5, 60)]
    table = pa.table({"ask": ask, "salt": pa.array(np.full(60, -1), pa.int32()), "doc_id": np.arange(60), "tkey": np.arange(60),
                      "start": pa.array(np.zeros(60), pa.int32()), "bytes": data})
    sizes, met = [], []
    monkeypatch.setattr(substrings, "sorted_strings", lambda t: (sizes.append(substrings.strings_in(t)), met.append(t.column("ask").to_pylist()), [])[2])
    assert not list(substrings._sort_strings(table.to_batches(max_chunksize=7)))
    assert sum(met, []) == ask.tolist() and not any(a[-1] == b[0] for a, b in zip(met, met[1:]))
    assert len(sizes) > 2 and max(sizes) <= 25 + 2 * 5 * max(np.bincount(ask))


def test_suffix_sort_orders_and_verifies():
    rng = np.random.default_rng(2)
    data = rng.choice(np.frombuffer(b"ab", np.uint8), 3_000)
    data[1000:1200] = data[100:300]
    at = np.arange(0, 2900)
    suffixes = substrings.Suffixes(data, at)
    order, run = suffixes.equal_runs()
    strings = [bytes(data[a : a + 50]) for a in at[order]]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(strings, strings[1:])] == list(run[1:] == run[:-1])


# ------------------------------------------------------------------- packing


def test_least_squares_on_a_known_system():
    a = np.array([[1.0, 0, 2], [0, 1, 1], [0, 0, 1]])
    assert np.allclose(packing.nnls(a, a @ np.array([3.0, 0, 2])), [3, 0, 2])
    assert (packing.nnls(a, np.array([-1.0, 2, -3])) >= 0).all()


def test_plan_places_every_piece():
    rng = np.random.default_rng(3)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(rng.integers(1, 4097, 5_000), return_counts=True))}
    plan = packing.Plan(histogram)
    assert plan.used == histogram and not plan.present
    fill = sum(k * n for k, n in histogram.items()) / (4096 * plan.sequences)
    assert fill > 0.98


@pytest.fixture(scope="module")
def ids_of(rows):
    """Every document's ids by the tokenizer itself, with the end id, as little-endian bytes."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_ids.vocabulary_path())
    encoded = tokenizer.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False)
    return {r["doc_id"]: np.array([*e.ids, token_ids.END_ID], "<u4") for r, e in zip(rows, encoded)}


def test_pieces_hold_the_tokenizers_ids(spark, ids_of):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op3_packing"](spark, SF_TINY).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids_of)
    for doc, found in pieces.items():
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            ids = ids_of[doc][at : at + r["length"]]
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids_of[doc]), zlib.crc32(ids.tobytes()))
            at += r["length"]
        assert at == len(ids_of[doc])
    for placed in sequences.values():
        ends = np.cumsum([n for _, n in sorted(placed)])
        assert [o for o, _ in sorted(placed)] == [0, *ends[:-1]] and ends[-1] <= 4096


def test_files_hold_the_tokenizers_ids(spark, ids_of):
    got, start = _result(spark, "op6_token_files"), 0
    assert set(got) == set(ids_of)
    for doc, ids in sorted(ids_of.items()):
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_units_give_the_tokenizers_ids():
    e = token_ids.encoder(token_ids.vocabulary_path())
    texts = ["A b's, don't!'s  x", "É ÀÉ, naïve—café", "<|endoftext|>x <|startoftext|>", "日本 語,x 12,3", "a\x85b\x1cc", "é İx ΑΣ.", ""]
    for t in texts:
        assert e.encode(t) == np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_cache_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(token_ids, "CACHE_UNITS", 5)
    e = token_ids.Encoder(token_ids.vocabulary_path())
    for i in range(40):
        t = f"w{i} the cat w{i % 7} sat"
        assert e.encode(t) == np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_a_worker_keeps_the_cache_of_its_last_operator_only():
    from sparkrec.llm import langid as lid

    model = lid.Model("none", ["en"], np.zeros((1, 1)), np.ones(1))
    made = []
    common.kept(("scanner", "a"), lambda: made.append("a") or "first")
    assert common.kept(("scanner", "a"), lambda: made.append("again")) == "first" and made == ["a"]
    e = token_ids.encoder(token_ids.vocabulary_path())
    assert token_ids.encoder(token_ids.vocabulary_path()) is e
    assert list(common._KEPT.values()) == [e]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(lid, "Scorer", lambda path, p: "scorer")
        lid.Predictor(model)([])
    assert list(common._KEPT.values()) == ["scorer"]


def test_units_of_letters_are_encoded_as_one_text(monkeypatch):
    e = token_ids.Encoder(token_ids.vocabulary_path())
    asked, real = [], e.tokenizer

    class Spy:
        def encode_batch_fast(self, texts, **more):
            asked.append(len(texts))
            return real.encode_batch_fast(texts, **more)

    e.tokenizer = Spy()
    odd = ["plain zqxv words Straße ªº µΩ", "İstanbul ǅ dz e\u0301te\u0301 中文 字", "don't o'clock x1y2 ... ' é́", "a<|endoftext|>b wört"]
    for text in [*odd, " ".join(odd)]:
        assert e.encode(text) == np.array(real.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    asked.clear()
    e.encode("seven words that were never asked before")
    assert asked[0] == 1 and sum(asked) == 1


def test_reading_frames_drops_the_encoder(tmp_path):
    import zstandard
    from pyarrow import fs
    from sparkrec.llm import token_files

    token_ids.encoder(token_ids.vocabulary_path())
    data = np.array([5, 2], "<u4").tobytes()
    import xxhash

    w = token_files.FrameWriter(fs.LocalFileSystem(), f"{tmp_path}/f")
    w.add(3, zstandard.ZstdCompressor().compress(data), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF)
    w.close()
    assert list(token_files.read_frames(fs.LocalFileSystem(), f"{tmp_path}/f")) == [(3, 0, data)]
    assert ("encoder", token_ids.vocabulary_path()) not in common._KEPT


# -------------------------------------------------------------- fingerprints


def test_cuts_deal_every_digest_to_its_range(spark):
    rng = np.random.default_rng(3)
    sets = [sorted(rng.integers(-(1 << 63), (1 << 63) - 1, n).tolist()) for n in (0, 1, 5, 60)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "i int, keys array<bigint>")
    for level in (0, 1, 4):
        at = fingerprints.cuts(F.col("keys"), F.lit(level), F.lit(0), F.lit(1 << level))
        found = {r["i"]: r["at"] for r in df.select("i", at.alias("at")).collect()}
        for i, s in enumerate(sets):
            shard_of = [(k + (1 << 63)) >> (64 - level) for k in s]
            assert found[i] == [sum(x < g for x in shard_of) for g in range((1 << level) + 1)]


def test_unlike_texts_are_compared_exactly_by_shards(spark):
    rng = np.random.default_rng(4)
    line = lambda n: [f"line {x}" for x in rng.integers(0, 300, n)]
    texts = ["\n".join(line(n)) for n in (0, 1, 40, 90, 200, 7)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = [set(t.split("\n")) - {""} for t in texts]
    for r in fingerprints.fingerprints(docs).collect():
        a, b = sets[r["doc_id"]], sets[(r["doc_id"] + 1) % len(sets)]
        assert r["near_next"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)



def test_likeness_equals_the_sets(spark, rows):
    got = _result(spark, "op4_fingerprints")
    keys = lambda t: {x for p in re.split(r"[\n.!?]+", t) if (x := p.strip(" "))}
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    texts = [r["text"] or "" for r in rows]
    for i, r in enumerate(rows):
        t, following, x = texts[i], texts[(i + 1) % len(rows)], got[r["doc_id"]]
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        assert (x["n_chars"], x["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(x["near_edited"] - like(keys(t), keys(edited))) < 1e-9
        assert abs(x["near_next"] - like(keys(t), keys(following))) < 1e-9


def test_equal_texts_have_equal_fingerprints(spark):
    docs = spark.createDataFrame([(1, "a. b. c"), (2, "x"), (3, "a. b. c")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    assert got[1] == got[3] != got[2]


# ------------------------------------------------------------------- Jaccard


def _components(rows):
    sets = {}
    for doc_id, text in rows:
        w = text.encode().lower().split()
        sets[doc_id] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    index, shared, parent = defaultdict(list), defaultdict(int), {d: d for d in sets}
    for d, s in sets.items():
        for t in s:
            for e in index[t]:
                shared[e, d] += 1
            index[t].append(d)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_components_equal_brute_force(spark, rows):
    got = {d: (r["n_shingles"], r["component_id"]) for d, r in _result(spark, "op8_jaccard_join").items()}
    assert got == _components([(r["doc_id"], r["text"]) for r in rows])


def test_families_at_the_threshold(spark):
    """Chains of edits whose ends are not linked, shared passages, tiny texts: no link is lost."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 4))
    rows, passage = [], [word() for _ in range(60)]
    for family in range(6):
        words = [word() for _ in range(40 + 30 * family)]
        for _ in range(12):
            for _ in range(1 + family // 3):
                words = list(words)
                words[rng.integers(len(words))] = word()
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, " ".join([word() for _ in range(30)] + passage[i : i + 30])) for i in range(20)]
    rows += [(len(rows) + i, " ".join(passage[: 3 + i % 7])) for i in range(25)]
    rows = [(int(i), t) for i, (_, t) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect()}
    assert got == _components(rows)


def test_every_link_is_returned(spark, monkeypatch):
    """Clusters of near-copies: all links among them, not only those that connect; sparse and dense comparisons, many blocks."""
    monkeypatch.setattr(jaccard, "LINK_BLOCK", 8)
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 4))
    rows = []
    for family in range(8):
        base = [word() for _ in range(30 + 15 * family)]
        for _ in range(3 if family < 4 else 40):
            words = list(base)
            for _ in range(rng.integers(1, 3)):
                words[rng.integers(len(words))] = word()
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), rows[0][1]), (None, rows[1][1].upper()), (len(rows) + 1, "two " * 40), (len(rows) + 2, None)]
    sets = {jaccard.set_key(jaccard.shingles(t)): jaccard.shingles(t) for _, t in rows if t}
    want = set()
    for a, s in sets.items():
        for b, t in sets.items():
            both = len(np.intersect1d(s, t)) if a < b else 0
            if both and 100 * both >= 80 * (len(s) + len(t) - both):
                want.add((a, b))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    pairs, members = jaccard.jaccard_links(docs)
    got = [(r["a"], r["b"]) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert members.count() == len(rows) - 1
    degree = defaultdict(int)
    for pair in want:
        for node in pair:
            degree[node] += 1
    for r in jaccard.jaccard_components(docs).collect():
        assert r["n_links"] == degree[r["node"]]


def test_dense_overlaps_equal_the_sets(monkeypatch):
    monkeypatch.setattr(jaccard, "COLUMNS", 16)
    rng = np.random.default_rng(12)
    x, y = ([np.unique(rng.integers(0, 300, rng.integers(1, 200)).astype(np.uint64)) for _ in range(n)] for n in (30, 40))
    p, q = (a.reshape(-1) for a in np.meshgrid(np.arange(30), np.arange(40), indexing="ij"))
    assert len(p) >= jaccard.DENSE_PAIRS
    assert jaccard.overlaps(x, y, p, q).tolist() == [len(np.intersect1d(x[i], y[j])) for i, j in zip(p, q)]


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for n in list(range(1, 60)) + [200, 777]:
        s = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for _ in range(4):
            gone = rng.integers(0, len(s) // 5 + 1)
            t = np.unique(rng.permutation(s)[: len(s) - gone])
            new = rng.integers(0, max(0, int(len(t) * 100 / 80 - len(s))) + 1)
            t = np.unique(np.concatenate([t, rng.integers(0, 1 << 63, new).astype(np.uint64)]))
            both = len(np.intersect1d(s, t))
            if len(t) and 100 * both >= 80 * (len(s) + len(t) - both):
                assert np.intersect1d(jaccard.signatures(s), jaccard.signatures(t)).size


def test_tree_drops_no_pair():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 1 << 63, 100).astype(np.uint64))
    sets = [np.unique(np.concatenate([rng.permutation(base)[: 100 - k], rng.integers(0, 1 << 63, k // 2).astype(np.uint64)])) for k in range(0, 60, 2)]
    sets.sort(key=len)
    bits = np.array([np.frombuffer(jaccard.bitmap(s), np.uint8) for s in sets])
    tree, label = jaccard.Forest(np.array([len(s) for s in sets]), bits, np.array([len(sets)])), np.arange(len(sets))
    found = list(zip(*(x.tolist() for x in jaccard.dual_traversal(tree, tree, np.array([True]), label, label))))
    assert len(found) == len(set(found))
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                assert (i, j) in found


def test_blocks_of_many_trees_drop_no_pair():
    rng = np.random.default_rng(8)
    for _ in range(3):
        x, y = [], []
        for _ in range(4):
            base = np.unique(rng.integers(0, 1 << 63, rng.integers(5, 150)).astype(np.uint64))
            near = [np.unique(base[rng.random(len(base)) < 0.93]) for _ in range(rng.integers(2, 60))]
            near = sorted((s for s in near if len(s)), key=len)
            x.append(near)
            y.append(near[: len(near) // 2 + 1])
        trees = []
        for blocks in (x, y):
            bits = np.array([np.frombuffer(jaccard.bitmap(s), np.uint8) for b in blocks for s in b])
            trees.append(jaccard.Forest(np.array([len(s) for b in blocks for s in b]), bits, np.array([len(b) for b in blocks])))
        names = [np.arange(sum(map(len, x))), 10_000 + np.arange(sum(map(len, y)))]
        got = jaccard.dual_traversal(*trees, np.zeros(4, bool), *names)
        found = set(zip(got[0].tolist(), got[1].tolist()))
        at_x, at_y = 0, 0
        for bx, by in zip(x, y):
            for i, s in enumerate(bx):
                for j, t in enumerate(by):
                    both = len(np.intersect1d(s, t))
                    assert 100 * both < 80 * (len(s) + len(t) - both) or (at_x + i, at_y + j) in found
            at_x, at_y = at_x + len(bx), at_y + len(by)


def test_open_pairs_are_handed_out_once(spark):
    """Near copies that meet in many groups: no pair comes twice, and a forest of them is linear in the copies."""
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(40):  # each differs from the base in one to three words: some pairs are linked, others are not
        words = list(base)
        for at in rng.choice(200, rng.integers(1, 4), replace=False):
            words[at] = f"x{rng.integers(1 << 40)}"
        texts.append(" ".join(words))
    sets = [jaccard.shingles(t) for t in texts]
    names = [jaccard.set_key(s) for s in sets]
    linked = set()
    for i in range(40):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                linked.add((min(names[i], names[j]), max(names[i], names[j])))
    groups = [(g, names[i]) for g, k in enumerate(range(2, 40)) for i in rng.permutation(40)[:k]] + [(-1, n) for n in names]
    ws = common.scratch(spark, "test-open-pairs")
    members = spark.createDataFrame(groups, "gid bigint, node bigint")
    rows = spark.createDataFrame([(n, len(s), jaccard.bitmap(s)) for n, s in zip(names, sets)], "node bigint, n bigint, bitmap binary")
    alone = spark.createDataFrame([], "node bigint, component bigint")
    clusters = jaccard.clusters_of(members)
    found = [(r["a"], r["b"]) for r in jaccard.open_pairs(clusters, alone, rows, ws).collect()]
    assert len(found) == len(set(found)) and linked and linked <= set(found)
    forest = [(r["a"], r["b"]) for r in jaccard.open_pairs(clusters, alone, rows, ws, forest=True).collect()]
    assert set(forest) <= set(found) and len(forest) <= 39 * clusters.select("centre").distinct().count() < len(found)
    pairs = spark.createDataFrame([(a, b) for i, a in enumerate(names) for b in names[:i]], "a bigint, b bigint")
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    assert linked <= {(r["a"], r["b"]) for r in jaccard.bounded(ordered, rows).collect()}
    ws.drop()


def test_forest_connects_what_its_pairs_connect():
    row = np.array([0, 0, 0, 1, 1])
    kept = jaccard.spanning(row, np.array([1, 2, 1, 1, 3]), np.array([2, 3, 3, 3, 1]))
    assert kept.tolist() == [0, 1, 3]


def test_word_hashes_follow_the_words():
    text = " The tHe\tÉcole école\x0b\nx\x85y  the\r"
    words = text.encode().lower().split()
    got = jaccard.word_hashes(text.encode()).tolist()
    assert len(got) == len(words) and len(set(got)) == len(set(words))
    assert [got.index(h) for h in got] == [words.index(w) for w in words]
    assert len(jaccard.word_hashes(b"")) == len(jaccard.word_hashes(b" \n")) == 0


# ----------------------------------------------------------------------- PII


CASES = [
    ("card 4111 1111 1111 1111 here", "card"), ("n 4929348385146306.", "card"), ("ip 192.168.0.1,", "ip"), ("on 2021-03-04 it", "date"),
    ("born 31.12.1999!", "date"), ("ssn 219-09-9999", "ssn"), ("call +1 (017) 555-7713 now", "phone"), ("to jo.doe34@mail7.example.com x", "email"),
]


def test_validated_values_keep_their_format(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id int, text string")
    got = {r["doc_id"]: r for r in pii.pseudonymise(docs, "k").collect()}
    for i, (text, kind) in enumerate(CASES):
        assert got[i]["text"] != text and got[i][f"n_{kind}"] == 1, text
        if kind != "email":
            assert re.sub(r"\d+", "0", got[i]["text"]) == re.sub(r"\d+", "0", text)
    again = {r["doc_id"]: r for r in pii.pseudonymise(docs.withColumn("text", F.col("text")), "k").collect()}
    assert {i: r["text"] for i, r in again.items()} == {i: r["text"] for i, r in got.items()}
    once_more = pii.pseudonymise(spark.createDataFrame([(0, got[0]["text"]), (5, got[5]["text"])], "doc_id int, text string"), "k")
    assert all(sum(r[f"n_{k}"] for k in pii.KINDS) == 1 for r in once_more.collect())  # pseudonyms are valid values


def test_invalid_values_stay(spark):
    texts = ["n 4929348385146307", "ip 300.1.1.1", "on 2021-02-30", "ssn 000-12-3456", "1234", "version 1.2.3", "a@b", "2021-13-01"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert [r["text"] for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect()] == texts


def test_permutation_is_inverted_by_its_key(spark):
    d = spark.range(0, 1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = d.select("d", pii.mask_digits(F.col("d"), F.lit("t"), "k").alias("m"))
    back = out.select("d", "m", pii.unmask_digits(F.col("m"), F.lit("t"), "k").alias("b")).collect()
    assert all(r["d"] == r["b"] for r in back) and len({r["m"] for r in back}) == 1000


# ------------------------------------------------------------------- secrets


def test_base_spans_equal_the_patterns(spark, rows):
    got = _result(spark, "op10_secrets")
    for r in rows:
        base = []
        for kind, pattern, least in (("assign", secrets.ASSIGN, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 20), ("hex", re.compile("[0-9a-f]+"), 24)):
            base += [(kind, m.start(), m.end()) for m in pattern.finditer(r["text"]) if len(m.group(2) if kind == "assign" else m.group()) >= least]
        x = got[r["doc_id"]]
        assert x["base_sha256"] == hashlib.sha256(secrets.listed(base).encode()).hexdigest()
        assert set(x["spans"].split(",")) >= set(filter(None, secrets.listed(base).split(",")))


def _toy_field():
    rng = np.random.default_rng(7)
    key = lambda: "".join(rng.choice(list("0123456789abcdefABCDEF"), 22))
    windows = []
    for i in range(60):
        tokens = ["some", "words", "then", "token", "=", '"', key(), '"', "and", "more"]
        windows.append((tokens, [0] * 6 + [1, 0, 0, 0], [1.0, 0.0, 1.0]))
        windows.append((["some", "number", "4929348385146306", "and", "129.38.82.176", "end"], [0] * 6, [0.0, 0.0, 1.0]))
    return secrets.train_field(windows)


def test_field_finds_what_patterns_miss():
    scanner = secrets.Scanner(_toy_field())
    text = 'see credential : "7fA0c1D2e3F4a5B6c7D8e9" and 4929348385146306'
    assert ("crf", text.index("7fA0"), text.index('" and')) in scanner.spans(text)
    assert scanner.spans("some number 4929348385146306 and 129.38.82.176 end") == []


def _scanned(spark, rows, field=None):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = secrets.scan(docs, field or secrets.fit(docs)).collect()
    return {r["doc_id"]: r["spans"] for r in found}


def test_a_fitted_field_finds_secrets_of_another_form(spark):
    """The corpus teaches assignments; the planted credentials match no fixed pattern."""
    rng = np.random.default_rng(10)
    value = lambda n: "".join(rng.choice(list("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"), n))
    prose = lambda n: " ".join(rng.choice("the house of a river and small trees were seen by many people".split(), n))
    rows = [(i, f"{prose(20)} password = {value(24)} {prose(12)}") for i in range(60)]
    rows += [(100 + i, f"{prose(20)} on 2021-03-{10 + i % 18} with {i}.{i + 1} {prose(12)}") for i in range(80)]
    planted = {300 + i: value(28) for i in range(10)}
    rows += [(d, f"{prose(15)} the credential : {v} {prose(10)}") for d, v in planted.items()]
    got, text = _scanned(spark, rows), dict(rows)
    for d, v in planted.items():
        a = text[d].index(v)
        assert f"crf:{a}:{a + len(v)}" in got[d].split(",")
    assert not any(got[i] for i in range(100, 180)) and all(got[i] for i in range(60))


def test_there_is_a_field_without_any_base_span(spark):
    """Nothing to learn from but the fixed windows."""
    rows = [(i, f"plain words number {i} of the page and its end") for i in range(30)]
    rows.append((50, 'then the credential: "k7Xw2pQv9LmZ4tRb8NcY6sDf" was sent'))
    got = _scanned(spark, rows)
    at = rows[-1][1].index("k7Xw")
    assert got[50] == f"crf:{at}:{at + 24}" and not any(got[i] for i in range(30))
    assert _scanned(spark, rows[:0]) == {}


def test_viterbi_is_the_best_path():
    from itertools import product

    rng = np.random.default_rng(8)
    move = rng.normal(size=(3, 3))
    move[secrets.OUTSIDE, secrets.INSIDE] = secrets.FORBIDDEN
    for _ in range(20):
        e = rng.normal(size=(6, 3))
        score = lambda p: sum(e[t, x] for t, x in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))
        best = max((p for p in product(range(3), repeat=6) if p[0] != secrets.INSIDE), key=score)
        assert tuple(secrets.viterbi(e, move)) == best
        gain = e[:, 1:].max(axis=1) - e[:, 0]
        if gain.max() + secrets.gain_bound(move) < 0:
            assert not any(best)


# -------------------------------------------------------------------- mixing


def test_budgets_fill_up():
    assert mixing.budgets([("a", 1), ("b", 100), (None, 100)])[0][2:] == (3.0, 3)
    sizes = [(f"s{i:02d}", 10 * i + 1) for i in range(20)] + [(None, 50)]
    got = mixing.budgets(sizes)
    assert abs(sum(t for *_, t, _ in got) - sum(n for _, n in sizes)) < 1e-6
    assert all(t <= 3 * n for _, n, t, _ in got) and got[-1][0] is None


def test_cards_beside_numbers_and_day_first_dates(spark):
    """No validated value stays in clear when another number stands beside it, or when the day comes first."""
    cards = ["12 4111 1111 1111 1111", "4111 1111 1111 1111 999", "4111111111111111 12", "order 7 4111-1111-1111-1111.", "4111 1111 1111 1111 4111 1111 1111 1111"]
    dates = ["25/12/2020", "on 31/01/1999, then", "12/25/2020"]
    plain = ["32/13/2020", "1234 5678 9012 3456", "1111 1111 1111 1111", "99/99/2020"]
    texts = cards + dates + plain
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = [r for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect()]
    for r, text in zip(got, texts):
        shape = re.sub(r"\d", "9", r["text"])
        assert shape == re.sub(r"\d", "9", text)
        if text in plain:
            assert r["text"] == text
        elif text in dates:
            assert r["n_date"] == 1 and r["text"] != text
        else:
            assert r["n_card"] >= 1 and "4111" not in r["text"]
    # the number beside a card stays, and the card has the pseudonym it has alone
    assert got[0]["text"].startswith("12 ") and got[1]["text"].endswith(" 999") and got[2]["text"].endswith(" 12")
    assert len({re.sub(r"\D", "", t)[:16] for t in (got[1]["text"], got[2]["text"])}) == 1
    assert got[0]["text"][3:] == got[1]["text"][:19] and got[4]["text"] == got[1]["text"][:19] + " " + got[1]["text"][:19]
    day, month = got[5]["text"][:2], got[5]["text"][3:5]
    assert 1 <= int(day) <= 31 and 1 <= int(month) <= 12


def test_spans_with_the_same_low_hash_bits_are_told_apart(monkeypatch):
    """Spans of one anchor whose hashes agree in 32 bits only: nothing is removed by them."""
    import numpy as np
    import pyarrow as pa

    real = substrings.spans_of

    def colliding(data):
        gram, first, count, offset, whole, left, right = real(data)
        return gram, first, count, offset, whole << np.uint64(32), left, right

    monkeypatch.setattr(substrings, "spans_of", colliding)
    rng = np.random.default_rng(1)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    text = lambda: rng.choice(letters, 30).tobytes().decode() + "the shared passage!!" + rng.choice(letters, 30).tobytes().decode()
    texts = [text() for _ in range(40)]
    removed = {}
    for name, rows in (("unlike", texts), ("copies", [texts[0]] * 2)):
        sent = []
        for i, t in enumerate(rows):  # one batch a document: equal spans meet in the match
            batch = pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([i], pa.int64()), pa.array([t])], names=["doc_id", "tkey", "text"])
            sent += list(substrings._send_spans(1)([batch]))
        table = pa.Table.from_batches(sent)
        found = substrings._match_spans(table)
        removed[name] = [r for r in found.to_pylist() if r["ask"] is None]
    assert removed["unlike"] == [] and {r["doc_id"] for r in removed["copies"]} == {1}
