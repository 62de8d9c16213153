"""Language identification by segmentation-marginalised unigrams (operator 1).

The pieces of a fixed public vocabulary get one probability per language. The
probability of a word is the sum over all its segmentations into pieces (a
forward pass over its letters); a text's is the product over its words; the
posterior over languages is the score. Probabilities are learned by
expectation maximisation over all segmentations (forward-backward), mixed with
the same share of the uniform distribution in every language, so a piece that
no language has used speaks for none of them, however much text each taught.

A word whose plain probability could leave the range of a double (long runs of
characters that the vocabulary lacks) is summed with a factor for each
character, which its logarithm takes off again.

Training uses at most ``docs_per_lang`` labelled documents of each language,
those with the smallest hashes of their ids (a documented bound; their words
are counted and the expected counts summed by Spark, and the driver gets one
row per language and piece). Prediction reads every whole text: each worker
scores a distinct word once and keeps up to ``CACHE_WORDS`` results.

Words are runs of letters (with their marks), in lower case; a run of over
``LONGEST`` characters counts as several words. A character outside the
vocabulary is its UTF-8 bytes, which the vocabulary has as pieces.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
documents without a label, and labels without a letter in any sampled
document, teach nothing; without any label every text is ``und``; of equally
likely languages the first by name wins; repeated rows are scored alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import documents, kept, last_draws, pick, scratch

VOCABULARY = "piece_bpe_32k.model"
WORD_START = "▁"
UNDETERMINED = "und"
DOCS_PER_LANG = 1500
EM_ROUNDS = 3
UNIFORM = 0.02
LONGEST = 64
CACHE_WORDS = 500_000
CHUNK_CHARS = 2_000_000
TINY, RARE, LEAST_LOG = 1e-300, 1e-8, -500.0
_BASE = np.uint64(0x9E3779B97F4A7C15)

_LATIN_WORD = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+")
_ANY_WORD = None


def words(text: str | None) -> list[str]:
    """Lower-case letter runs, long ones in parts."""
    global _ANY_WORD
    if not text:
        return []
    text = text.lower()
    try:
        text.encode("latin-1")
        found = _LATIN_WORD.findall(text)
    except UnicodeEncodeError:
        if _ANY_WORD is None:
            import regex

            _ANY_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
        found = _ANY_WORD.findall(text)
    if found and len(max(found, key=len)) > LONGEST:
        found = [w[i : i + LONGEST] for w in found for i in range(0, len(w), LONGEST)]
    return found


class Pieces:
    """The vocabulary's pieces with a hash index over code points."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.size = len(names)
        self.byte_ids = np.array([names.index(f"<0x{b:02X}>") for b in range(256)])
        own = [i for i, x in enumerate(names) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        own = [i for i in own if WORD_START not in names[i][1:]]
        self.longest = max(len(names[i]) for i in own)
        hashes = np.array([self._hash(names[i]) for i in own], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], np.array(own)[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes * _BASE) >> np.uint64(44)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c)) & 0xFFFFFFFFFFFFFFFF
        return h

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes, -1 where there is none."""
        out = np.full(h.shape, -1, np.int64)
        at = np.nonzero(self.maybe[(h * _BASE) >> np.uint64(44)])
        near = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        out[at] = np.where(self.hashes[near] == h[at], self.ids[near], -1)
        return out

    def lattice(self, same_length: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """``spans[k][:, i]``: index of the piece of ``k + 1`` characters at ``i``.

        Indexes beyond the vocabulary are the characters it lacks, in the returned order.
        """
        n = len(same_length[0]) + 1
        codes = np.frombuffer("".join(WORD_START + w for w in same_length).encode("utf-32-le"), "<u4").reshape(-1, n).astype(np.uint64)
        spans, h, extra = [], np.zeros((len(codes), n), np.uint64), []
        for k in range(min(self.longest, n)):
            h = (h[:, : n - k] * _BASE) + codes[:, k:]
            spans.append(self.find(h))
        missing = spans[0] < 0
        if missing.any():
            chars, inverse = np.unique(codes[missing], return_inverse=True)
            spans[0][missing] = self.size + inverse
            extra = [chr(int(c)) for c in chars]
        return spans, extra

    def rows(self, p: np.ndarray, extra: list[str]) -> np.ndarray:
        """Probabilities by index: pieces, missing characters (their bytes' product), and a last row of zeros for -1."""
        more = [p[self.byte_ids[list(c.encode("utf-8", "surrogatepass"))]].prod(axis=0) for c in extra]
        return np.vstack([p, *more, np.zeros((1, p.shape[1]))])


def tilts(spans: list[np.ndarray], rows: np.ndarray) -> np.ndarray | None:
    """Logarithms of factors ``[position, word, language]`` that keep a word's sums within range; None if no word needs any.

    A character gets one over its probability if it is under ``RARE`` (bytes of
    one that the vocabulary lacks, so no longer piece has it), or over its root:
    sums stay between the root of the characters' product and its inverse.
    """
    single = spans[0].T
    least = np.log(np.maximum(rows[:-1].min(axis=1), TINY))
    needed = least[single].sum(axis=0) < LEAST_LOG
    if not needed.any():
        return None
    p = np.maximum(rows[single], TINY)
    return np.where(p < RARE, -1.0, -0.5) * np.log(p) * needed[None, :, None]


def factors(tilt: np.ndarray | None):
    """``(s, e)`` to the factor of a piece from ``s`` to ``e``."""
    if tilt is None:
        return lambda s, e: 1.0
    sums = np.concatenate([np.zeros((1, *tilt.shape[1:])), np.cumsum(tilt, axis=0)])
    return lambda s, e: np.exp(np.minimum(sums[e] - sums[s], 700.0))


def forward(spans: list[np.ndarray], rows: np.ndarray, tilt: np.ndarray | None = None) -> np.ndarray:
    """``alpha[e][word, language]``: probability of the first ``e`` characters over all segmentations, times their factors."""
    count, n = spans[0].shape
    by = factors(tilt)
    alpha = np.zeros((n + 1, count, rows.shape[1]))
    alpha[0] = 1.0
    for e in range(1, n + 1):
        for k in range(min(len(spans), e)):
            s = e - k - 1
            alpha[e] += alpha[s] * rows[spans[k][:, s]] * by(s, e)
    return alpha


def log_probability(spans: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """``[word, language]`` logarithm of the sum over all segmentations."""
    tilt = tilts(spans, rows)
    total = np.log(np.maximum(forward(spans, rows, tilt)[-1], TINY))
    return total if tilt is None else total - tilt.sum(axis=0)


def expected_counts(spans: list[np.ndarray], rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each row over all segmentations; ``weight[word, language]`` are word counts."""
    tilt = tilts(spans, rows)
    by, alpha = factors(tilt), forward(spans, rows, tilt)
    n = len(alpha) - 1
    beta = np.zeros_like(alpha)
    beta[n] = 1.0
    for s in range(n - 1, -1, -1):
        for k in range(min(len(spans), n - s)):
            beta[s] += beta[s + k + 1] * rows[spans[k][:, s]] * by(s, s + k + 1)
    scale = weight / np.maximum(alpha[n], TINY)
    out = np.zeros_like(rows)
    for s in range(n):
        for k in range(min(len(spans), n - s)):
            at = spans[k][:, s]
            uses = alpha[s] * rows[at] * by(s, s + k + 1) * beta[s + k + 1] * scale
            for lang in range(rows.shape[1]):
                out[:, lang] += np.bincount(at % len(rows), uses[:, lang], len(rows))
    return out


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def by_length(distinct: list[str], most: int = 20_000):
    """Groups of words of one length, of bounded total size."""
    order = sorted(distinct, key=len)
    start = 0
    while start < len(order):
        n = len(order[start])
        end = start
        while end < len(order) and len(order[end]) == n and end - start < max(1, most * 8 // (n + 1)):
            end += 1
        yield order[start:end]
        start = end


class Scorer:
    """Log probabilities of words under every language, kept per worker."""

    def __init__(self, path: str, p: np.ndarray):
        self.pieces, self.p = pieces(path), p
        self.at: dict[str, int] = {}
        self.scores = np.zeros((1024, p.shape[1]))

    def learn(self, wanted: set[str]) -> None:
        new = [w for w in wanted if w not in self.at]
        if len(self.at) + len(new) > CACHE_WORDS:
            self.at, new = {}, list(wanted)
        need = len(self.at) + len(new)
        if need > len(self.scores):
            self.scores = np.vstack([self.scores[: len(self.at)], np.zeros((2 * need - len(self.at), self.p.shape[1]))])
        for group in by_length(new):
            spans, extra = self.pieces.lattice(group)
            first = len(self.at)
            self.scores[first : first + len(group)] = log_probability(spans, self.pieces.rows(self.p, extra))
            self.at.update(zip(group, range(first, first + len(group))))

    def texts(self, texts: list[list[str]]) -> list[np.ndarray | None]:
        """Sum of the words' log probabilities of each text; None without words."""
        self.learn(set().union(*texts))
        get = self.at.__getitem__
        return [self.scores[list(map(get, ws))].sum(axis=0) if ws else None for ws in texts]


class Model:
    """``langs`` (by name), ``p[piece, language]`` and the languages' (equal) priors."""

    def __init__(self, path: str, langs: list[str], p: np.ndarray, prior: np.ndarray):
        self.path, self.langs, self.p, self.prior = path, langs, p, prior

    def posterior(self, total: np.ndarray) -> np.ndarray:
        z = total + np.log(self.prior)
        e = np.exp(z - z.max())
        return e / e.sum()


def _count_words(batches):
    for batch in batches:
        seen: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            seen.update((lang, w) for w in words(text.as_py()))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen]), pa.array([k[1] for k in seen]), pa.array(list(seen.values()), pa.int64())], names=["lang", "word", "n"]
            )


def _expectation(path: str, langs: list[str], p: np.ndarray):
    def run(batches):
        own, total = pieces(path), np.zeros_like(p)
        number = {x: i for i, x in enumerate(langs)}
        for batch in batches:
            lang, word, n = (batch.column(i).to_pylist() for i in range(3))
            weight: dict[str, np.ndarray] = {}
            for x, w, c in zip(lang, word, n):
                weight.setdefault(w, np.zeros(len(langs)))[number[x]] += c
            for group in by_length(list(weight)):
                spans, extra = own.lattice(group)
                got = expected_counts(spans, own.rows(p, extra), np.array([weight[w] for w in group]))
                total += got[: own.size]
                for c, row in zip(extra, got[own.size :]):
                    np.add.at(total, own.byte_ids[list(c.encode("utf-8", "surrogatepass"))], row)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(total[piece, lang])], names=["piece", "lang", "n"])

    return run


def fit(labelled: DataFrame, path: str | None = None, docs_per_lang: int = DOCS_PER_LANG, rounds: int = EM_ROUNDS) -> Model:
    """Learn from ``doc_id, text, lang`` rows (a null ``lang`` teaches nothing)."""
    import public_tokenizers

    path = path or public_tokenizers.path(VOCABULARY)
    ws = scratch(labelled.sparkSession, "langid")
    labelled = labelled.where("lang is not null and text is not null").withColumn("draw", F.xxhash64("doc_id"))
    limits = last_draws(labelled.select("draw", F.col("lang").alias("kind")), docs_per_lang)
    limit = F.create_map(*[F.lit(x) for kv in limits.items() for x in kv]) if limits else None
    sample = labelled.where(F.col("draw") <= limit[F.col("lang")]) if limits else labelled.limit(0)
    counted = sample.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n bigint")
    table = ws.materialize(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    sums = {r["lang"]: r["n"] for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(sums)
    own = pieces(path)
    p = np.full((own.size, len(langs)), 1.0 / own.size)
    for _ in range(rounds if langs else 0):
        counts = table.mapInArrow(_expectation(path, langs, p), "piece bigint, lang bigint, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        got = np.zeros_like(p)
        rows = counts.toArrow()
        got[rows.column("piece").to_numpy(), rows.column("lang").to_numpy()] = np.round(rows.column("n").to_numpy(), 6)
        p = (1 - UNIFORM) * got / np.maximum(got.sum(axis=0), 1e-300) + UNIFORM / own.size
    return Model(path, langs, p, np.full(len(langs), 1.0 / max(1, len(langs))))


class Predictor:
    """Predictions of a batch of texts, with this worker's scorer of the model."""

    def __init__(self, model: Model):
        self.model, self.key = model, uuid.uuid4().hex

    def __call__(self, texts) -> tuple[list[str], list[float]]:
        model = self.model
        scorer = kept(("scorer", self.key), lambda: Scorer(model.path, model.p)) if model.langs else None
        preds, scores = [], []
        for part in _chunks(texts):
            for total in scorer.texts(part) if scorer else [None] * len(part):
                if total is None:
                    preds.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    post = model.posterior(total)
                    best = int(post.argmax())
                    preds.append(model.langs[best])
                    scores.append(float(post[best]))
        return preds, scores


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id, lang_pred, score``, from its text alone."""
    predictor = Predictor(model)

    def run(batches):
        for batch in batches:
            preds, scores = predictor(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return pick(docs, doc_id=doc_id, text=text).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, text: str = "text", min_score: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text has a language with at least ``min_score``."""
    predictor, at = Predictor(model), docs.columns.index(text)

    def run(batches):
        for batch in batches:
            preds, scores = predictor(batch.column(at))
            yield batch.filter(pa.array([p != UNDETERMINED and s >= min_score for p, s in zip(preds, scores)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _chunks(column):
    """Word lists of the texts, about ``CHUNK_CHARS`` characters at a time."""
    part, size = [], 0
    for text in column:
        text = text.as_py()
        part.append(words(text))
        size += len(text or "")
        if size >= CHUNK_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def op1_language_id(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(pick(docs.where(~held_out()), doc_id="doc_id", text="text", lang="lang"))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
