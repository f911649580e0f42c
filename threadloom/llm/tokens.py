"""Token ids of whole texts by a public tokenizer file, with a cache of words.

The tokenizer (``word_bpe_49k``) never joins characters across white space, so a
text's ids are those of its white-space separated words, one after the other.
Words recur, so most are looked up.
"""

from __future__ import annotations

import itertools
import os
import re
from collections.abc import Iterator

import numpy as np

# Letters and signs that the tokenizer takes one by one; other words are encoded alone.
PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# Signs that may follow a word; together they are tokens of their own.
SIGNS = ".,;:!?*#$%&|"

# str.split() also splits at these four, which the tokenizer takes as signs.
ODD = re.compile("[\x1c-\x1f]")
SPACE = re.compile(r"\s")
WINDOW = 1 << 20
LONG_WORD = 64


class WordTokenizer:
    """``keep``: about as many words are remembered, the first ones met."""

    def __init__(self, path: str, keep: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        self.known: dict[str, bytes] = {}

    def _raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _windows(self, text: str) -> Iterator[str]:
        """The text in pieces of bounded length that end before white space."""
        at = 0
        while len(text) - at > WINDOW and (m := SPACE.search(text, at + WINDOW)):
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def ids(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(self._window_ids(w) for w in self._windows(text))

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of plain words, encoded in one text and told apart by their offsets."""
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.asarray(found.ids, dtype="<u4")
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        cuts = np.searchsorted(np.fromiter((a for a, _ in found.offsets), np.int64, len(ids)), starts)
        data = ids.tobytes()
        return [data[4 * a:4 * b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of new words; a word with signs behind it from its parts."""
        known, split = self.known, {}
        for w in words:
            head = w.rstrip(SIGNS)
            if head and len(head) < len(w) and PLAIN.fullmatch(head) and head[-1].isalpha():
                split[w] = (head, w[len(head):])
        parts = (words - split.keys()).union(*split.values()) if split else words
        parts = [w for w in parts if w not in known]
        plain = [w for w in parts if PLAIN.fullmatch(w) and "<|" not in w]
        for i in range(0, len(plain), 1000):
            known.update(zip(plain[i:i + 1000], self._together(plain[i:i + 1000])))
        odd = [w for w in parts if w not in known]
        known.update(zip(odd, self._raw(odd)))
        known.update((w, known[a] + known[b]) for w, (a, b) in split.items())

    def _window_ids(self, text: str) -> bytes:
        if ODD.search(text):
            return self._raw([text])[0]
        if "\u0130" not in text and "\u03a3" not in text:  # the only letters that str.lower() treats otherwise
            text = text.lower()
        words, known = text.split(), self.known
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            pass
        new = {w for w in words if w not in known}
        before = len(known)
        self._learn(new)
        out = b"".join(map(known.__getitem__, words))
        if before > self.keep:  # frequent words came early and stay
            for w in list(itertools.islice(reversed(known), len(known) - before)):
                del known[w]
        else:
            for w in new:
                if len(w) > LONG_WORD:
                    del known[w]
        return out


_loaded: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per file and Python worker."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]
