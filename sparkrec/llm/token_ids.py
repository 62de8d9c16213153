"""Token ids of whole texts, with a bounded cache of units.

The tokenizer drops white space and never merges across it, nor across the
end of a run of letters, so a text's ids are the concatenated ids of its
units. Each worker process keeps the ids of units it has met (two generations
of at most ``CACHE_UNITS`` entries each; the older one is dropped when the
newer is full) and sends only new units to the ``tokenizers`` library: those of
letters only as one text, if the vocabulary marks the last id of a word.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from sparkrec.llm.common import kept

WORD_BPE = "word_bpe_49k.json"
END_ID = 2
CACHE_UNITS = 400_000

# Latin-1 letters: for texts within Latin-1 a run of them ends a unit. There
# are no combining marks in that range, so normalisation can't cross the cut.
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_BLANKS = "\t-\r \x85\xa0"
_LATIN_UNITS = re.compile(f"[{_LETTERS}]+|[^{_LETTERS}{_BLANKS}][^{_BLANKS}]*")
_ASCII_BLANK_UNITS = re.compile(r"[^ \t\n\r]+")


def vocabulary_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def units(text: str) -> list[str]:
    """Pieces of ``text`` whose ids, one after the other, are the text's ids."""
    if "<|" in text:  # special tokens in the text are recognised within a unit
        return _ASCII_BLANK_UNITS.findall(text)
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _ASCII_BLANK_UNITS.findall(text)
    return _LATIN_UNITS.findall(text)


def word_ends(tokenizer) -> np.ndarray | None:
    """Which ids end a word; None if the vocabulary does not mark them."""
    suffix = json.loads(tokenizer.to_str())["model"].get("end_of_word_suffix")
    if not suffix:
        return None
    known = tokenizer.get_vocab()
    out = np.zeros(max(known.values()) + 1, bool)
    out[[i for token, i in known.items() if token.endswith(suffix)]] = True
    return out


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.word_end = word_ends(self.tokenizer)
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, wanted: set[str], distinct: set[str]) -> None:
        if len(self.new) + len(wanted) > CACHE_UNITS:
            self.old, self.new, wanted = self.new, {}, distinct
        missing = []
        for u in wanted:
            ids = self.old.get(u)
            if ids is None:
                missing.append(u)
            else:
                self.new[u] = ids
        for i in range(0, len(missing), 10_000):
            self._ask(missing[i : i + 10_000])

    def _ask(self, missing: list[str]) -> None:
        """Has the tokenizer encode new units."""
        if self.word_end is not None:
            words = [u for u in missing if u.isalpha()]
            if words and self._ask_words(words):
                missing = [u for u in missing if not u.isalpha()]
        for u, e in zip(missing, self.tokenizer.encode_batch_fast(missing, add_special_tokens=False)):
            self.new[u] = np.array(e.ids, "<u4").tobytes()

    def _ask_words(self, words: list[str]) -> bool:
        """Encodes units of letters as one text. Each is one word at least, so as many words as units are those units."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return False
        data, first = ids.tobytes(), 0
        for u, end in zip(words, (4 * ends).tolist()):
            self.new[u] = data[first:end]
            first = end
        return True

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        parts = units(text)
        distinct = set(parts)
        wanted = distinct.difference(self.new)
        if wanted:
            self._learn(wanted, distinct)
        return b"".join(map(self.new.__getitem__, parts))


def encoder(path: str) -> Encoder:
    """This worker process's encoder for a vocabulary file."""
    return kept(("encoder", path), lambda: Encoder(path))
