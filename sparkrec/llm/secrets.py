"""Secret scanning with a linear-chain conditional random field (operator 10).

Three fixed patterns give the base spans. A conditional random field tags the
tokens of a text as secret begin, inside or outside from the token's own
shape, the three tokens before it and the one after it (their shapes, and plain
words by a hash into ``WORD_CELLS`` cells), and features of the whole text; Viterbi decodes the most likely tags, and runs of tagged tokens
that touch no base span are added. Base spans always stay.

The field is trained on windows of tokens around base spans, drawn from all
documents that hold one by the hashes of ids and texts, and on windows without
any from all other documents: at most ``windows`` of either kind, up to
``PER_DOC`` a document (documented bounds); a window with a long token behind a
keyword outside a base span is not used. Fixed windows made by rule
(``example_windows``) are always added, so that there is a field on any table,
also one without a base span. Scanning
reads every whole text: a token's features depend on the token alone, so each
worker maps a distinct token to its signature once. A text in which no token
can gain from being tagged, whatever its neighbours' tags, needs no Viterbi
pass (its best path is all outside); every other text is decoded whole.

Edge cases: a null text is empty and has no span; ties between tags go to
outside, then begin; repeated rows are scanned alike and drawn together; on an
empty table the field knows the fixed windows only, and the result is empty.
"""

from __future__ import annotations

import hashlib
import math
import re
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import documents, kept, last_draws, pick, scratch

# Fixed patterns of the base kinds, with the least length of a secret.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")

WINDOWS = 800
WINDOW_TOKENS = 24
PER_DOC = 3
WORD_CELLS = 64
ROUNDS = 80
CACHE_TOKENS = 500_000

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
OFFSETS = (-3, -2, -1, 0, 1)
FORBIDDEN = -1e9
_TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s+/.\-]")
_WORD = re.compile(r"[^\W\d_]+[.,]?")
_KEYWORD = re.compile(r"pass(?:word|wd)|secret|token|api_?key|private|credential|auth|bearer", re.I | re.A)
_ASSIGN_WORD = re.compile(r"password|passwd|secret|token|api_?key", re.I | re.A)
EDGE = "\n"  # stands before the first token of a text and after the last
FILE_FEATURES = ("keyword", "marks", "long_token")
# The base patterns as one for Spark's filter: which documents may hold a base span.
MAY_HOLD = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6}"""
            r"|AKIA[A-Z0-9]{16}|[0-9a-f]{24}")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the base patterns; leftmost, non-overlapping per kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def is_word(token: str) -> bool:
    """Letters in the usual cases; four changes from lower to upper case or more are no word's."""
    return bool(_WORD.fullmatch(token)) and sum(a.islower() and b.isupper() for a, b in zip(token, token[1:])) < 4


def token_features(token: str) -> tuple[str, ...]:
    """Features of a token by itself."""
    if token == EDGE:
        return ("edge",)
    if len(token) == 1 and not token.isalnum():
        return ("mark=" + token if token in "=:\"'|,;()[]{}<>@#$%&*!?" else "mark",)
    n = "len=" + str(min(6, int(math.log2(len(token)))))
    key = ("keyword",) if _KEYWORD.search(token) else ()
    if is_word(token):
        cell = "cell=" + str(zlib.crc32(token.lower().rstrip(".,").encode("utf-8", "surrogatepass")) % WORD_CELLS)
        return ("word", n, cell, *key, *(("upper",) if token.isupper() and len(token) > 1 else ()))
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    counts = Counter(token)
    bits = -sum(c / len(token) * math.log2(c / len(token)) for c in counts.values())
    out = [n, "digits=" + str(4 * digits // len(token)), "letters=" + str(4 * letters // len(token)), "bits=" + str(int(bits))]
    out += ["mixed"] * (digits > 0 and letters > 0) + ["number"] * (letters == 0) + ["hex"] * bool(re.fullmatch(r"[0-9a-fA-F]{8,}", token))
    out += ["cased"] * (token != token.lower() and token != token.upper()) + ["dots"] * ("." in token) + ["akia"] * ("AKIA" in token)
    return (*out, *key)


class Tokens:
    """Signature number of every token met, and signatures' features."""

    def __init__(self):
        self.of_token: dict[str, int] = {}
        self.number: dict[tuple, int] = {}
        self.features: list[tuple[str, ...]] = []
        self._flags: list[tuple] = []
        self.flags = np.zeros((0, 1 + len(FILE_FEATURES)), bool)

    def ids(self, tokens: list[str]) -> np.ndarray:
        if len(self.of_token) > CACHE_TOKENS:
            self.of_token = {}
        get = self.of_token.get
        try:
            return np.fromiter(map(self.of_token.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            for t in set(tokens):
                if get(t) is None:
                    suspect = bool(_ASSIGN_WORD.search(t) or "AKIA" in t or HEX.search(t))
                    key = (token_features(t), suspect)
                    if key not in self.number:
                        self.number[key] = len(self.features)
                        self.features.append(key[0])
                        # a base pattern may match at such a token; what it adds to the file features
                        mark, large = key[0][0].startswith("mark"), key[0][0] in ("len=5", "len=6")
                        self._flags.append((suspect, "keyword" in key[0], mark, large))
                    self.of_token[t] = self.number[key]
            if len(self.flags) < len(self._flags):
                self.flags = np.array(self._flags)
            return np.fromiter(map(self.of_token.__getitem__, tokens), np.int64, len(tokens))


def seen_flags(known: Tokens, ids: np.ndarray) -> tuple[bool, np.ndarray]:
    """Whether a base pattern may match, and the features of the whole text (0 or 1)."""
    counts = known.flags[np.bincount(ids, minlength=len(known.flags)) > 0].sum(axis=0)
    return bool(counts[0]), np.array([counts[1] > 0, counts[2] >= 6, counts[3] > 0], float)


class Field:
    """Weights: ``emit[offset][feature, tag]``, ``file[feature, tag]``, ``move[from, to]``."""

    def __init__(self, features: list[str]):
        self.number = {x: i for i, x in enumerate(features)}
        self.emit = np.zeros((len(OFFSETS), len(features) + 1, 3))
        self.file = np.zeros((len(FILE_FEATURES), 3))
        self.move = np.zeros((3, 3))
        self.move[OUTSIDE, INSIDE] = FORBIDDEN

    def table(self, features: list[tuple[str, ...]]) -> np.ndarray:
        """``[offset, signature, tag]`` scores."""
        unknown = len(self.number)
        return np.stack([[self.emit[o][[self.number.get(f, unknown) for f in fs]].sum(axis=0) for fs in features] for o in range(len(OFFSETS))])


def scores(table: np.ndarray, ids: np.ndarray, own: np.ndarray) -> np.ndarray:
    """``[token, tag]`` emission scores."""
    out = np.tile(own, (len(ids), 1))
    for o, d in enumerate(OFFSETS):
        if len(ids) > abs(d):
            out[max(0, -d) : len(ids) - max(0, d)] += table[o][ids[max(0, d) : len(ids) + min(0, d)]]
    return out


def gain_bound(move: np.ndarray) -> float:
    """The most that tags' transitions can add to a tagged token against all outside."""
    stay = move[OUTSIDE, OUTSIDE]
    # the first token has no transition into it
    return max(0.0, *(move[a, b] - stay for a in range(3) for b in (BEGIN, INSIDE))) + max(0.0, max(move[a, OUTSIDE] - stay for a in (BEGIN, INSIDE)))


def viterbi(emission: np.ndarray, move: np.ndarray) -> list[int]:
    back, best = [], emission[0].tolist()
    best[INSIDE] = FORBIDDEN
    m = move.tolist()
    for e in emission[1:].tolist():
        new, via = [], []
        for b in range(3):
            options = [best[a] + m[a][b] for a in range(3)]
            a = max(range(3), key=options.__getitem__)
            via.append(a)
            new.append(options[a] + e[b])
        back.append(via)
        best = new
    tag = max(range(3), key=best.__getitem__)
    tags = [tag]
    for via in reversed(back):
        tag = via[tag]
        tags.append(tag)
    return tags[::-1]


def tokens_of(text: str) -> list[str]:
    """The text's tokens between two edges; none of a text without a token."""
    tokens = _TOKEN.findall(text)
    return [EDGE, *tokens, EDGE] if tokens else []


def tag_tokens(text: str, spans: list[tuple[int, int]]) -> list[int]:
    """The tags of ``tokens_of`` the text: a token that overlaps a span is part of the secret."""
    tags, k, last = [OUTSIDE], 0, -1
    spans = sorted(spans)
    for m in _TOKEN.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        inside = k < len(spans) and m.end() > spans[k][0]
        tags.append(OUTSIDE if not inside else INSIDE if last == k else BEGIN)
        last = k if inside else -1
    return [*tags, OUTSIDE]


def _training_windows(batches):
    known = Tokens()
    for batch in batches:
        rows = []
        for draw, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            tokens = tokens_of(text)
            if not tokens:
                continue
            ids = known.ids(tokens)
            suspect, own = seen_flags(known, ids)
            tags = [OUTSIDE] * len(tokens)
            if suspect:
                # the value of an assignment is the secret, not its name
                spans = [(m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
                spans += [(s, e) for kind, s, e in base_spans(text) if kind != "assign" and not any(s < y and x < e for x, y in spans)]
                tags = tag_tokens(text, spans)
            marked = [i for i, t in enumerate(tags) if t == BEGIN]
            odd = [i for i, t in enumerate(tokens) if len(t) > 7 and not is_word(t) and tags[i] == OUTSIDE]
            spots = [(i, True) for i in marked[:PER_DOC]] or [(i, False) for i in (*odd[: PER_DOC - 2], 0, len(tokens) // 2)]
            # a long token after a keyword may be a secret of another form: it teaches neither
            unclear = [i for i in odd if len(tokens[i]) >= 12 and any(_KEYWORD.search(t) for t in tokens[max(0, i - 3) : i])]
            for i, positive in spots:
                a = max(0, i - WINDOW_TOKENS)
                while a and tags[a] != OUTSIDE:  # no window begins within a secret, without what is before it
                    a -= 1
                b = i + WINDOW_TOKENS
                if not positive and any(a <= j < b for j in unclear):
                    continue
                rows.append((draw, positive, tokens[a:b], tags[a:b], own.tolist()))
        if rows:
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["draw", "positive", "tokens", "tags", "own"])


def train_field(windows: list[tuple[list[str], list[int], list[float]]], rounds: int = ROUNDS, rate: float = 0.5, decay: float = 1e-3) -> Field:
    """Maximum conditional likelihood by adaptive gradient steps over all windows at once."""
    known = Tokens()
    width = max(len(t) for t, *_ in windows)
    ids = np.full((len(windows), width), -1)
    for r, (tokens, *_) in enumerate(windows):
        ids[r, : len(tokens)] = known.ids(tokens)
    names = sorted(set().union(*known.features))
    field = Field(names)
    uses = np.zeros((len(known.features) + 1, len(names) + 1))
    for s, fs in enumerate(known.features):
        for f in fs:
            uses[s, field.number[f]] = 1
    live = ids >= 0
    tags = np.zeros((len(windows), width), int)
    for r, (_, t, _) in enumerate(windows):
        tags[r, : len(t)] = t
    # a window may begin within a secret
    tags[:, 0] = np.where(tags[:, 0] == INSIDE, BEGIN, tags[:, 0])
    own = np.array([o for *_, o in windows])
    truth = np.eye(3)[tags] * live[..., None]
    shifted = [np.full_like(ids, -1) for _ in OFFSETS]
    for s, d in zip(shifted, OFFSETS):
        s[:, max(0, -d) : width - max(0, d)] = ids[:, max(0, d) : width + min(0, d)]
    pairs = live[:, 1:]
    true_moves = np.einsum("nta,ntb->ab", truth[:, :-1] * pairs[..., None], truth[:, 1:])
    history = [np.full(x.shape, 1e-6) for x in (field.emit, field.file, field.move)]
    for _ in range(rounds):
        emission = np.repeat((own @ field.file)[:, None, :], width, axis=1)
        for o, s in enumerate(shifted):
            emission += (uses @ field.emit[o])[s]
        emission[:, 0, INSIDE] = FORBIDDEN
        alpha, beta = np.zeros_like(emission), np.zeros_like(emission)
        alpha[:, 0] = emission[:, 0]
        for t in range(1, width):
            step = np.logaddexp.reduce(alpha[:, t - 1, :, None] + field.move, axis=1) + emission[:, t]
            alpha[:, t] = np.where(live[:, t, None], step, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            step = np.logaddexp.reduce(field.move + (emission[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(live[:, t + 1, None], step, beta[:, t + 1])
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        marginal = np.exp(alpha + beta - total[:, None, None]) * live[..., None]
        joint = alpha[:, :-1, :, None] + field.move + (emission[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        moves = (np.exp(joint) * pairs[..., None, None]).sum(axis=(0, 1))
        diff = truth - marginal
        by_signature = [np.stack([np.bincount(s[live] % len(uses), diff[..., k][live], len(uses)) for k in range(3)], axis=1) for s in shifted]
        emit_step = np.stack([uses.T @ x for x in by_signature])
        steps = [emit_step, own.T @ diff.sum(axis=1), true_moves - moves]
        for w, g, h in zip((field.emit, field.file, field.move), steps, history):
            g = g / len(windows) - decay * np.where(w > FORBIDDEN / 2, w, 0)
            h += g * g
            w += rate * g / np.sqrt(h)
        field.move[OUTSIDE, INSIDE] = FORBIDDEN
    return field


def example_windows() -> list[tuple[list[str], list[int], list[float]]]:
    """Fixed windows by rule: keyed values of several alphabets in settings and prose, and look-alikes without a secret."""
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    alphabets = (lower + digits, lower + upper + digits, upper + digits, digits + "abcdef")
    keys = ("password", "secret", "token", "api_key", "private_key", "credential", "auth", "bearer")
    forms = ("set {k} = {v} before the start", "{k}: {v}", 'the {k} is "{v}" and must not be shared', "use {k} {v} to log in")
    plain = ("the {k} was changed on {d} by the owner", "release {d} of the page {w}", "see section {d} about the {k} of a user",
             "{w} and {w} were there in {d}", "the meaning of a {k} is {w}", "call {d} or write to {w}", "{w}.{d}@mail.{w}.com", "{w}.{d}@{w}.org wrote about it", "{w} - {w}.{w} | {d} | {w}")
    out = []
    for n, (key, form) in enumerate((k, f) for k in keys for f in forms):
        draw = hashlib.sha512(f"{n}".encode()).digest()
        letters = alphabets[n % len(alphabets)]
        value = "".join(letters[x % len(letters)] for x in draw[: 16 + 8 * (n % 4)])
        numbers = (f"{draw[0]}.{draw[1] % 20}.{draw[2] % 9}", f"{1900 + draw[0] % 150}-{1 + draw[1] % 12:02d}-{1 + draw[2] % 28:02d}", str(draw[0] * draw[1]))
        word = "".join(lower[x % 26] for x in draw[: 4 + draw[3] % 12])
        secret = form.format(k=key, v=value)
        at = secret.index(value)
        for text, spans in ((secret, [(at, at + len(value))]), (plain[n % len(plain)].format(k=key, d=numbers[n % 3], w=word), [])):
            tokens, known = tokens_of(text), Tokens()
            out.append((tokens, tag_tokens(text, spans), seen_flags(known, known.ids(tokens))[1].tolist()))
    return out


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", windows: int = WINDOWS) -> Field:
    """Train on at most ``windows`` positive and as many negative windows, drawn from all documents, and the fixed ones."""
    ws = scratch(docs.sparkSession, "secrets")
    own = pick(docs, doc_id=doc_id, text=text).where("text is not null")
    own = own.withColumn("draw", F.xxhash64("doc_id", "text")).withColumn("holds", F.col("text").rlike(MAY_HOLD))
    draws = ws.materialize(own.select("draw", "holds"), "draws")
    limits = last_draws(draws.select("draw", F.col("holds").alias("kind")), windows)
    if not limits:
        return train_field(example_windows())
    drawn = F.lit(False)
    for holds, last in limits.items():
        drawn = drawn | ((F.col("holds") == holds) & (F.col("draw") <= last))
    schema = "draw bigint, positive boolean, tokens array<string>, tags array<int>, own array<double>"
    # repeated rows teach once
    found = own.where(F.col("draw") <= max(limits.values())).select("draw", "text", "holds").where(drawn).dropDuplicates(["draw"]).select("draw", "text").mapInArrow(_training_windows, schema)
    found = ws.materialize(found, "windows")
    kept = [found.where(F.col("positive") == p).orderBy("draw", "tokens").limit(windows).collect() for p in (True, False)]
    return train_field([(r["tokens"], r["tags"], r["own"]) for part in kept for r in part] + example_windows())


class Scanner:
    def __init__(self, field: Field):
        self.field, self.known = field, Tokens()
        self.table = np.zeros((len(OFFSETS), 0, 3))

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """All spans of a text: the base ones and those the field adds."""
        tokens = tokens_of(text)
        if not tokens:
            return []
        ids = self.known.ids(tokens)
        suspect, own = seen_flags(self.known, ids)
        found = base_spans(text) if suspect else []
        if self.table.shape[1] < len(self.known.features):
            self.table = np.concatenate([self.table, self.field.table(self.known.features[self.table.shape[1] :])], axis=1)
        emission = scores(self.table, ids, own @ self.field.file)
        gain = emission[:, 1:].max(axis=1) - emission[:, OUTSIDE]
        if gain.max() + gain_bound(self.field.move) < 0:
            return found
        tags = viterbi(emission, self.field.move)[1:-1]
        if any(tags):
            found = found + self._tagged(text, tags, found)
        return found

    @staticmethod
    def _tagged(text: str, tags: list[int], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        runs: list[list[int]] = []
        for tag, m in zip(tags, _TOKEN.finditer(text)):
            if tag == BEGIN:
                runs.append([m.start(), m.end()])
            elif tag == INSIDE:
                runs[-1][1] = m.end()
        ends = sorted((s, e) for _, s, e in base)
        out, k = [], 0
        for a, b in runs:
            while k < len(ends) and ends[k][1] <= a:
                k += 1
            if not any(s < b and a < e for s, e in ends[max(0, k - 3) : k + 3]):
                out.append(("crf", a, b))
        return out


def listed(spans: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """The text with every (joined) span replaced by ``mark``."""
    out, at = [], 0
    for _, s, e in sorted(spans, key=lambda x: (x[1], x[2])):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, field: Field, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, base counts, ``base_sha256``, ``spans`` and the ``redacted`` text."""
    key = uuid.uuid4().hex
    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, redacted string"

    def run(batches):
        find = kept(("scanner", key), lambda: Scanner(field)).spans
        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                value = value.as_py()
                spans = find(value or "")
                base = [x for x in spans if x[0] != "crf"]
                n = Counter(k for k, *_ in base)
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((doc, n["assign"], n["access"], n["hex"], digest, listed(spans), redacted(value, spans) if spans else value))
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[c.split()[0] for c in schema.split(", ")])

    return pick(docs, doc_id=doc_id, text=text).mapInArrow(run, schema)


def without_secrets(docs: DataFrame, field: Field, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns, with every span of ``text`` replaced by a mark (and ``n_chars``, if there, counted anew)."""
    key, names = uuid.uuid4().hex, docs.columns
    at = names.index(text)

    def run(batches):
        find = kept(("scanner", key), lambda: Scanner(field)).spans
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at)]
            clean = [redacted(t, spans) if t and (spans := find(t)) else t for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(clean, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars in names else out


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return scan(docs, fit(docs)).drop("redacted")
