"""The lattice of all segmentations of a word into pieces of a fixed vocabulary.

White space ends every piece of the vocabulary but its first character, so a text's
segmentations are those of its words, each written with the vocabulary's word mark in front, and
a text's probability is the product of its words'. A word's probability is summed over all its
segmentations by the forward recursion. A character that no piece covers is spelt by the
vocabulary's byte pieces.
"""

from __future__ import annotations

import numpy as np

MARK = "▁"
# Characters of equally long words that are taken together.
TOGETHER = 1 << 16
# After so many characters the running sums are divided by the newest one, whose logarithm is kept
# apart: sums over texts of any length and script stay in range.
RESCALED = 4
STEP, MIX1, MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


class Vocabulary:
    """Pieces of a sentencepiece model file, and counts of them in words."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        plain = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i)
                                             or self.model.is_byte(i) or self.model.is_unused(i))]
        self.size = n
        self.ids = {self.model.id_to_piece(i): i for i in plain}
        self.bytes = np.zeros(256, np.int64)
        for i in range(n):
            if self.model.is_byte(i):
                self.bytes[int(self.model.id_to_piece(i)[3:5], 16)] = i

    def count(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """How often each piece occurs in the vocabulary's own segmentation of the words."""
        found = self.model.encode(words, num_threads=1)
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for x in found for i in x), np.int64, int(lengths.sum()))
        return np.bincount(flat, np.repeat(times, lengths), self.size)


def probabilities(counts: np.ndarray) -> np.ndarray:
    """Piece probabilities, one column per model, from counts with one more of every piece."""
    more = counts + 1.0
    return more / more.sum(axis=0)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX1)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX2)
    return h ^ (h >> np.uint64(31))


class Lattice:
    """Natural logarithms of word probabilities under one or more columns of probabilities."""

    def __init__(self, vocabulary: Vocabulary, probs: np.ndarray):
        self.ids, self.bytes, self.probs = vocabulary.ids, vocabulary.bytes, probs
        self.longest = max(map(len, self.ids))
        spelt = {}
        for piece, i in self.ids.items():
            codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            spelt[int(self._hash(codes[None, :])[0])] = (i, len(piece))
        keys = np.array(sorted(spelt), np.uint64)
        self.keys, self.pieces = keys, np.array([spelt[int(x)][0] for x in keys])
        self.weights = probs[self.pieces]

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for j in range(codes.shape[1]):
            h = (h + codes[:, j] + np.uint64(1)) * np.uint64(STEP)
        return _mixed(h)

    def spelling(self, character: int) -> np.ndarray:
        return np.prod(self.probs[self.bytes[list(chr(character).encode("utf-8", "surrogatepass"))]], axis=0)

    def forward(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.probs.shape[1]))
        marked = [MARK + w for w in words]
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(marked):
            by_length.setdefault(len(w), []).append(i)
        for n, at in by_length.items():
            step = max(1, TOGETHER // n)
            for lo in range(0, len(at), step):
                part = at[lo:lo + step]
                out[part] = self._sums("".join(marked[i] for i in part), len(part), n)
        return out

    def _arcs(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, row, weights) of all pieces in the words, by start and length."""
        m, n = codes.shape
        found = []
        h = np.zeros((m, n), np.uint64)
        for length in range(1, min(self.longest, n) + 1):
            h = (h[:, :n - length + 1] + codes[:, length - 1:] + np.uint64(1)) * np.uint64(STEP)
            key = _mixed(h)
            slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[slot] == key
            row, start = np.nonzero(hit)
            found.append((start, np.full(len(start), length), row, self.weights[slot[row, start]]))
            if length == 1:  # a character without a piece is spelt in bytes
                row, start = np.nonzero(~hit)
                if len(row):
                    kinds, which = np.unique(codes[row, start], return_inverse=True)
                    spelt = np.array([self.spelling(int(c)) for c in kinds])
                    found.append((start, np.full(len(start), 1), row, spelt[which]))
        start, length, row, weights = (np.concatenate(part) for part in zip(*found, strict=True))
        order = np.lexsort((length, start))
        return start[order], length[order], row[order], weights[order]

    def _sums(self, joined: str, m: int, n: int) -> np.ndarray:
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        start, length, row, weights = self._arcs(codes.reshape(m, n).astype(np.uint64))
        # Runs of arcs of one start and length; no word has two of them.
        cut = np.flatnonzero(np.diff(start * (self.longest + 1) + length)) + 1
        lows, highs = np.concatenate([[0], cut]), np.concatenate([cut, [len(start)]])
        ahead = self.longest + 1
        sums = np.zeros((ahead, m, self.probs.shape[1]))
        sums[0], scale, at = 1.0, np.zeros((m, self.probs.shape[1])), 0
        for lo, hi, s, e in zip(lows.tolist(), highs.tolist(), start[lows].tolist(), length[lows].tolist(), strict=True):
            if s > at:
                sums[at % ahead] = 0.0
                at = s
                if at % RESCALED == 0:
                    here = sums[at % ahead].copy()
                    sums /= here
                    scale += np.log(here)
            rows = row[lo:hi]
            sums[(s + e) % ahead, rows] += sums[s % ahead, rows] * weights[lo:hi]
        return np.log(sums[n % ahead]) + scale


class WordScores:
    """Word -> row of log probabilities, remembering recent words within a bound."""

    WORDS, CHARACTERS = 250_000, 4_000_000

    def __init__(self, lattice: Lattice):
        self.lattice, self.characters = lattice, 0
        self.at: dict[str, int] = {}
        self.rows = np.zeros((0, lattice.probs.shape[1]))

    def learn(self, words: set[str]) -> None:
        if len(self.at) > self.WORDS or self.characters > self.CHARACTERS:
            self.at, self.rows, self.characters = {}, self.rows[:0], 0
        new = [w for w in words if w not in self.at]
        if new:
            self.rows = np.concatenate([self.rows[:len(self.at)], self.lattice.forward(new)])
            self.characters += sum(map(len, new))
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))

    def total(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        return self.rows[at].sum(axis=0)
