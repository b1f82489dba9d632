"""Byte-level BPE over whole batches, by distinct pre-token.

Byte-level BPE encodes each pre-token by itself, so a batch is cut into
pre-tokens with array operations, each distinct one is encoded once by the
tokenizers library, and the ids are gathered.  Pre-tokens are recognised by a
64-bit hash.  The classes of characters come from the library's own
pre-tokenizer.  A text for which the array rules could differ (an apostrophe
or an added token's text) is encoded whole by the library.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np

from riskgraph.llm.common import ship
from riskgraph.llm.textbytes import mix64

ship(__name__)

LETTER, NUMBER, OTHER, SPACE = range(4)
KNOWN_MOST = 1_500_000  # pre-tokens a worker remembers (about 60 MB)
# Arrays of the prefix-sum hash are made for at most this many characters.
CHARS = 1 << 19


class Coder:
    """Encoder of one tokenizer file; kept for the life of a worker process."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer
        self.coder = Tokenizer.from_file(path)
        self.size = self.coder.get_vocab_size()
        self.added = [t.content for t in self.coder.get_added_tokens_decoder().values()]
        self.kinds = np.full(0x110000, 255, np.uint8)
        base = np.uint64(0x9E3779B97F4A7C15)
        self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(CHARS, base, np.uint64))])
        back = np.uint64(pow(int(base), -1, 1 << 64))
        self.inverse = np.concatenate([[np.uint64(1)], np.cumprod(np.full(CHARS, back, np.uint64))])
        self.forget()

    @staticmethod
    def of(path: str) -> Coder:
        """The worker process's coder for ``path``."""
        home = sys.modules.setdefault("_pretoken_coders", types.ModuleType("_pretoken_coders"))
        if not hasattr(home, "by_path"):
            home.by_path = {}
        if path not in home.by_path:
            home.by_path[path] = Coder(path)
        return home.by_path[path]

    def forget(self):
        self.known = np.empty(0, np.uint64)   # hashes, sorted
        self.first = np.empty(0, np.int64)    # place of the pre-token's ids
        self.count = np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _classify(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if (kinds == 255).any():
            split = self.coder.pre_tokenizer.pre_tokenize_str
            for p in np.unique(points[kinds == 255]).tolist():
                c = chr(p)
                self.kinds[p] = (LETTER if len(split("a" + c)) == 1 else NUMBER if len(split("1" + c)) == 1
                                 else OTHER if len(split("!" + c)) == 1 else SPACE)
            kinds = self.kinds[points]
        return kinds

    def _cut(self, points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pre-tokens of joined texts (``ends``: each text's end)."""
        n = len(points)
        kinds = self._classify(points)
        first = np.ones(n, bool)
        np.not_equal(kinds[1:], kinds[:-1], out=first[1:])
        first[ends[ends < n]] = True
        # A white-space run before more text gives up its last character: a
        # plain space leads the next run, any other stands alone.
        lasts = np.flatnonzero(kinds[:-1] == SPACE)
        lasts = lasts[first[lasts + 1]]
        at_end = np.zeros(n + 1, bool)
        at_end[ends] = True
        lasts = lasts[~at_end[lasts + 1]]
        first[lasts] = True
        first[lasts[points[lasts] == 32] + 1] = False
        starts = np.flatnonzero(first)
        return starts, np.append(starts[1:], n)

    def _learn(self, hashes: np.ndarray, words: list[str]):
        got = self.coder.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(got.ids, np.uint32)
        count = np.bincount(np.array(got.word_ids, np.int64), minlength=len(words))
        first = len(self.flat) + np.cumsum(count) - count
        self.flat = np.concatenate([self.flat, ids])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]

    def _joined(self, texts: list[str]) -> list[np.ndarray]:
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum([len(t) for t in texts])
        if not len(points):
            return [np.empty(0, np.uint32)] * len(texts)
        starts, stops = self._cut(points, ends)
        n = len(points)
        if n > CHARS:  # one long text: hashed in pieces that end where a pre-token does
            h = np.empty(len(starts), np.uint64)
            a = 0
            while a < len(starts):
                z = max(a + 1, int(np.searchsorted(stops, starts[a] + CHARS, "right")))
                if stops[z - 1] - starts[a] > CHARS:
                    return [np.array(self.coder.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts]
                h[a:z] = self._hash(points[starts[a]:stops[z - 1]], starts[a:z] - starts[a], stops[a:z] - starts[a])
                a = z
        else:
            h = self._hash(points, starts, stops)
        distinct, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) > KNOWN_MOST:
            self.forget()
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        if new.any():
            self._learn(distinct[new], [whole[starts[i]:stops[i]] for i in at[new]])
            place = np.searchsorted(self.known, distinct)
        slot = place[back]
        count = self.count[slot]
        total = np.cumsum(count)
        ids = self.flat[np.repeat(self.first[slot] - (total - count), count) + np.arange(total[-1])]
        # Pre-tokens never cross texts: a text's ids end with its last one.
        upto = np.concatenate([[0], total])[np.searchsorted(starts, ends)]
        return np.split(ids, upto[:-1])

    def _hash(self, points, starts, stops):
        prefix = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.powers[:len(points)], out=prefix[1:])
        return mix64((prefix[stops] - prefix[starts]) * self.inverse[starts])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the library gives them without special tokens."""
        plain = [not ("'" in t or any(a in t for a in self.added)) for t in texts]
        found = iter(self._joined([t for t, p in zip(texts, plain, strict=True) if p]))
        return [next(found) if p else np.array(self.coder.encode(t, add_special_tokens=False).ids, np.uint32)
                for t, p in zip(texts, plain, strict=True)]
