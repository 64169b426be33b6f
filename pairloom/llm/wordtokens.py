"""Token ids of whole texts by a cache of the pieces between white space.

For a vocabulary whose pre-tokenizer drops white space (so that no token and no rule
crosses it), the ids of a text are those of its pieces in order. Natural text repeats
its pieces, so most come from a dictionary; new ones go to the tokenizer together.
Ids are kept as little-endian unsigned 32-bit bytes.
"""

import os
import re

import numpy as np
from tokenizers import Tokenizer

from .common import held

#: Pieces kept by one worker, about 200 bytes each; beyond it the cache starts anew.
CACHE_PIECES = 400_000
#: Characters encoded between two looks at the cache's size, for each piece that it may keep.
CHARS_PER_PIECE = 10
#: White space to ``str.split`` but not to the tokenizer's pattern.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WORD = re.compile("[a-z]+")
_TAIL = ".,;:!?"
WORDS_AT_ONCE = 2_000


class WordEncoder:
    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces
        ids = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(ids.values()) + 1, bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or "</w>"
        self.ends[[i for token, i in ids.items() if token.endswith(suffix)]] = True

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of plain lower-case words: encoded as one text, cut at the ends of words."""
        out: list[bytes] = []
        for k in range(0, len(words), WORDS_AT_ONCE):
            part = words[k : k + WORDS_AT_ONCE]
            raw = self._plain([" ".join(part)])[0]
            ends = np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")])
            if len(ends) != len(part):
                out += self._plain(part)
                continue
            stops = (4 * (ends + 1)).tolist()
            out += [raw[a:b] for a, b in zip([0, *stops], stops)]
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Fill the cache with new pieces."""
        cache = self.cache
        whole, parts, words = [], {}, set()
        for p in pieces:
            if not p.isascii() or "<|" in p:
                whole.append(p)
                continue
            low = p.lower()
            base = low.rstrip(_TAIL)
            if base and _WORD.fullmatch(base):
                # Letters and the marks behind them are tokens of their own.
                parts[p] = (base, low[len(base) :])
                words.add(base)
            else:
                whole.append(p)
        words = [w for w in words if w not in cache]
        tails = [t for t in {t for _, t in parts.values()} if t and t not in cache]
        cache.update(zip(words, self._words(words)))
        cache.update(zip(tails, self._plain(tails)))
        cache.update(zip(whole, self._plain(whole)))
        for p, (base, tail) in parts.items():
            cache[p] = cache[base] + (cache[tail] if tail else b"")

    def _some(self, texts: list[str]) -> list[bytes]:
        if len(self.cache) > self.cache_pieces:
            self.cache.clear()
        cut = [None if _SEPARATORS.search(t) else t.split() for t in texts]
        new = set().union(*(c for c in cut if c)) - self.cache.keys()
        if new:
            self._learn(new)
        get = self.cache.__getitem__
        return [self._plain([t])[0] if c is None else b"".join(map(get, c)) for t, c in zip(texts, cut)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        group: list[str] = []
        chars = 0
        for t in texts:
            group.append(t)
            chars += len(t)
            if chars >= CHARS_PER_PIECE * self.cache_pieces:
                out += self._some(group)
                group, chars = [], 0
        return out + self._some(group) if group else out


def encoder(path: str, cache_pieces: int = CACHE_PIECES) -> WordEncoder:
    """The worker's encoder for this vocabulary; it stays while the worker needs no other."""
    return held("encoders", (path, cache_pieces), lambda: WordEncoder(path, cache_pieces))
