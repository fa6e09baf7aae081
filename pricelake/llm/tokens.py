"""Token ids of texts by a public tokenizer file, word by word: equal words are encoded once per worker.

The tokenizer splits at blanks, and between a letter and the punctuation after it, before it merges anything; so the ids of a text are
those of its parts in order. Parts of letters only are words to the tokenizer, and the last token of a word says that it is the last; so
many of them are encoded as one text and cut at these tokens. ``encode`` is tested against the tokenizer on whole texts.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from pricelake.llm.arrays import BLANK, LOWER, ranges_hash

#: Parts a worker remembers; then it starts anew.
REMEMBERED = 1 << 20
#: Words encoded as one text.
TOGETHER = 512
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SECOND = np.zeros(256, bool)  # second bytes of U+00C0 to U+00FF, letters but for two signs
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_POINT = np.zeros(256, bool)
_POINT[list(b".,!?;:")] = True


class Encoder:
    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        if suffix:
            self.last[[i for x, i in self.tokenizer.get_vocab().items() if x.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted
        self.number = np.zeros(0, np.int64)  # of the parts, in the order in which they were learnt
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1, np.int64)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of words of letters."""
        texts = [b" ".join(words[i : i + TOGETHER]).decode() for i in range(0, len(words), TOGETHER)]
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False))])
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # a tokenizer without word ends
            return self._parts(words)
        return ids, np.diff(ends, prepend=0)

    def _parts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in parts], add_special_tokens=False)]
        return np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)

    def _learn(self, keys: np.ndarray, parts: list[bytes], plain: np.ndarray) -> None:
        """Add parts by their sorted keys; ``plain`` says which have letters only."""
        order = np.argsort(~plain, kind="stable")
        many = int(plain.sum())
        parts = [parts[i] for i in order.tolist()]
        learnt = [f(some) for f, some in ((self._words, parts[:many]), (self._parts, parts[many:])) if some]
        used, n = int(self.at[-1]), len(self.at) - 1
        ids = np.concatenate([x for x, _ in learnt])
        self.at = np.concatenate((self.at, used + np.cumsum(np.concatenate([x for _, x in learnt]))))
        if used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros(max(len(self.ids), len(ids)), np.uint32)))
        self.ids[used : used + len(ids)] = ids
        number = np.empty(len(keys), np.int64)
        number[order] = n + np.arange(len(keys))
        where = np.searchsorted(self.known, keys)
        self.known, self.number = np.insert(self.known, where, keys), np.insert(self.number, where, number)

    def _new(self, keys: np.ndarray) -> np.ndarray:
        where = np.searchsorted(self.known, keys)
        new = where == len(self.known)
        new[~new] = self.known[where[~new]] != keys[~new]
        return new

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text)."""
        special = (data[:-1] == 60) & (data[1:] == 124) if len(data) else np.zeros(0, bool)
        low = LOWER[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~BLANK[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        cut = np.zeros(len(data), bool)
        letter = _LETTER[data]
        letter[1:] |= (data[:-1] == 0xC3) & _SECOND[data[1:]]
        cut[1:] = _POINT[data[1:]] & letter[:-1]
        start = inside[1:-1] & (first[:-1] | ~inside[:-2] | cut)
        end = inside[1:-1] & (first[1:] | ~inside[2:] | np.append(cut[1:], False))
        start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
        bounds = np.searchsorted(start, offsets)
        if special.any():  # what may be a control string keeps its letters
            low = np.where(np.isin(np.cumsum(inside[1:-1] & ~inside[:-2]), np.cumsum(inside[1:-1] & ~inside[:-2])[:-1][special]), data, low)
        key = ranges_hash(low, start, end)
        unique, at, back = np.unique(key, return_index=True, return_inverse=True)
        new = self._new(unique)
        if len(self.known) + int(new.sum()) > REMEMBERED:
            self.forget()
            new[:] = True
        if new.any():
            # letters of one byte, and those of two (both bytes)
            plain = _LETTER[data]
            two = (data[:-1] == 0xC3) & _SECOND[data[1:]]
            plain[1:] |= two
            plain[:-1] |= two
            other = np.concatenate(([0], np.cumsum(~plain)))
            raw, place = low.tobytes(), at[new]
            self._learn(
                unique[new], [raw[a:b] for a, b in zip(start[place].tolist(), end[place].tolist(), strict=True)],
                other[end[place]] == other[start[place]],
            )
        number = self.number[np.searchsorted(self.known, unique)][back]
        begin, length = self.at[number], self.at[number + 1] - self.at[number]
        to = np.concatenate(([0], np.cumsum(length)))
        where = np.arange(to[-1]) - np.repeat(to[:-1] - begin, length)
        return self.ids[where], to[bounds]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
