"""Probability of a word over all its segmentations into pieces of a vocabulary.

Nodes are the places between a word's characters, arcs the pieces that lead from one to another. A character that
is no piece has the arc of its UTF-8 bytes, so every word has a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np

SPACE = "▁"  # stands before every word, as in the vocabulary
PREFIX = math.inf  # of an entry that is only the beginning of pieces
TOGETHER = 8_192  # words of one length that are worked on at once,
LONGEST = 40  # up to this length; longer ones go one by one


class Vocabulary:
    """Pieces of a vocabulary file with their scores; one id for each, and one more for the end of a text."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        scores = [0.0] * size
        for i in range(size):
            if model.is_byte(i):
                self.byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[model.id_to_piece(i)] = i
                scores[i] = model.get_score(i)
        self.end, self.size = size, size + 1
        self.has_bytes = all(self.byte_ids)
        if not self.has_bytes:
            raise ValueError("the vocabulary needs pieces for the 256 bytes")
        self.prior = self._prior(scores)

    def _prior(self, scores: list[float]) -> list[float]:
        """Probabilities from the file's scores, pieces of equal score alike.

        A unigram file's scores are log-probabilities and are taken as they are. A merge file's are ranks below zero,
        far apart from any log-probability; they become Zipf's law. Bytes and the end start with little.
        """
        used = sorted({scores[i] for i in self.ids.values()}, reverse=True)
        ranked = used[-1] < -100
        rank = {s: n for n, s in enumerate(used)}
        raw = [0.0] * self.size
        for i in self.ids.values():
            raw[i] = 1 / (rank[scores[i]] + 10.0) if ranked else math.exp(scores[i])
        least = min(raw[i] for i in self.ids.values())
        for i in [*self.byte_ids, self.end]:
            raw[i] = least
        total = math.fsum(raw)
        return [p / total for p in raw]


class Lattice:
    """Forward and backward recursions in log space, for given piece probabilities."""

    def __init__(self, vocabulary: Vocabulary, probability: list[float]):
        self.vocabulary = vocabulary
        log = [math.log(p) if p > 0 else -math.inf for p in probability]
        self.log_end = log[vocabulary.end]
        self.bytes = [log[i] for i in vocabulary.byte_ids]
        self.arcs: dict[str, float] = {}
        for piece, i in vocabulary.ids.items():
            for cut in range(1, len(piece)):
                self.arcs.setdefault(piece[:cut], PREFIX)
        for piece, i in vocabulary.ids.items():
            self.arcs[piece] = log[i]

    def _by_bytes(self, char: str) -> float:
        return sum(self.bytes[b] for b in char.encode("utf-8", "surrogatepass"))

    def forward(self, word: str) -> tuple[list[float], list[list[tuple[int, float]]]]:
        """Log-probability of each node, and the arcs (end, log-probability) that leave each."""
        text, find = SPACE + word, self.arcs.get
        n = len(text)
        coming: list[list[float]] = [[] for _ in range(n + 1)]
        coming[0].append(0.0)
        node, leaving = [0.0] * (n + 1), []
        for i in range(n + 1):
            came = coming[i]
            if len(came) == 1:
                here = came[0]
            else:
                top = max(came)
                here = top + math.log(sum([math.exp(c - top) for c in came])) if top > -math.inf else top
            node[i] = here
            if i == n:
                break
            out = []
            value = find(text[i])
            if value is None or value == PREFIX or value == -math.inf:
                own = self._by_bytes(text[i])
                out.append((i + 1, own))
                coming[i + 1].append(here + own)
            elif value is not None:
                out.append((i + 1, value))
                coming[i + 1].append(here + value)
            j = i + 1
            while value is not None and j < n:
                j += 1
                value = find(text[i:j])
                if value is not None and value != PREFIX:
                    out.append((j, value))
                    coming[j].append(here + value)
            leaving.append(out)
        return node, leaving

    def log_probability(self, word: str) -> float:
        """Natural logarithm of the sum over all segmentations."""
        return self.forward(word)[0][-1]

    def expect(self, words: Iterable[tuple[str, int]]) -> list[float]:
        """Expected uses of each piece in the words, each word as often as it is counted."""
        ids, byte_ids = self.vocabulary.ids, self.vocabulary.byte_ids
        uses = [0.0] * self.vocabulary.size
        for word, times in words:
            node, leaving = self.forward(word)
            text, n, whole = SPACE + word, len(word) + 1, node[-1]
            back = [-math.inf] * (n + 1)
            back[n] = 0.0
            for i in range(n - 1, -1, -1):
                ways = [value + back[j] for j, value in leaving[i]]
                top = max(ways)
                back[i] = ways[0] if len(ways) == 1 else top + math.log(sum([math.exp(w - top) for w in ways]))
                base = node[i] - whole
                for (j, _), way in zip(leaving[i], ways):
                    share = base + way
                    if share > -30:
                        share = times * math.exp(share)
                        piece = ids.get(text[i:j])
                        if piece is None:
                            for b in text[i].encode("utf-8", "surrogatepass"):
                                uses[byte_ids[b]] += share
                        else:
                            uses[piece] += share
        return uses

    def _tree(self) -> None:
        """The pieces as a tree of characters, its edges in a hash table of (node, character)."""
        nodes, edges = {"": 0}, []
        for text in sorted(self.arcs, key=len):
            nodes[text] = len(nodes)
            edges.append((nodes[text[:-1]] << 21 | ord(text[-1]), nodes[text]))
        self.node_log, self.node_piece = np.full(len(nodes), -np.inf), np.full(len(nodes), -1)
        for piece, i in self.vocabulary.ids.items():
            self.node_log[nodes[piece]] = self.arcs[piece]
            self.node_piece[nodes[piece]] = i
        bits = max(10, (4 * len(edges)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.edge_key, self.edge_to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        keys = np.array([k for k, _ in edges], np.int64)
        for (key, to), at in zip(edges, self._slot(keys).tolist()):
            while self.edge_key[at] >= 0:
                at = (at + 1) & ((1 << bits) - 1)
            self.edge_key[at], self.edge_to[at] = key, to

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _follow(self, node: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The node behind each (node, character); -1 where there is none."""
        keys = node << 21 | chars
        at, out = self._slot(keys), np.full(len(keys), -1)
        open_ = np.arange(len(keys))
        while len(open_):
            found = self.edge_key[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.edge_to[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
            at[open_] = (at[open_] + 1) & (len(self.edge_key) - 1)
        return out

    def _together(self, words: Sequence[str]) -> tuple[np.ndarray, list[tuple]]:
        """``forward`` for words of one length: node log-probabilities, a row each, and arcs as
        (start, end, rows, log-probabilities, pieces or None for bytes)."""
        if not hasattr(self, "edge_key"):
            self._tree()
        n = len(words[0]) + 1
        codes = np.frombuffer("".join([SPACE + w for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n).astype(np.int64)
        node, arcs = np.full((len(words), n + 1), -np.inf), []
        node[:, 0] = 0.0
        for i in range(n):
            rows, place = np.arange(len(words)), np.zeros(len(words), np.int64)
            for j in range(i + 1, n + 1):
                place = self._follow(place, codes[rows, j - 1])
                log = np.where(place >= 0, self.node_log[place], -np.inf)
                some = log > -np.inf
                if j == i + 1 and not some.all():
                    bare = rows[~some]
                    chars, back = np.unique(codes[bare, i], return_inverse=True)
                    arcs.append((i, j, bare, np.array([self._by_bytes(chr(c)) for c in chars.tolist()])[back], None))
                if some.any():
                    arcs.append((i, j, rows[some], log[some], self.node_piece[place[some]]))
                inside = place >= 0
                rows, place = rows[inside], place[inside]
                if not len(rows):
                    break
            for _, j, own, log, _ in (a for a in arcs[::-1] if a[0] == i):
                node[own, j] = np.logaddexp(node[own, j], node[own, i] + log)
        return node, arcs

    def _by_length(self, words: Sequence[str]):
        """Places of the words of one length, some at a time; first those that go one by one."""
        lengths = np.array([len(w) for w in words], np.int64)
        yield np.flatnonzero(lengths > LONGEST), False
        for n in np.unique(lengths[lengths <= LONGEST]):
            own = np.flatnonzero(lengths == n)
            for at in range(0, len(own), TOGETHER):
                yield own[at:at + TOGETHER], True

    def log_probabilities(self, words: Sequence[str]) -> np.ndarray:
        """``log_probability`` of many words."""
        out = np.zeros(len(words))
        for own, together in self._by_length(words):
            if together:
                out[own] = self._together([words[i] for i in own])[0][:, -1]
            else:
                out[own] = [self.log_probability(words[i]) for i in own]
        return out

    def expect_many(self, words: Sequence[str], times: Sequence[int]) -> np.ndarray:
        """``expect`` of many words."""
        times, uses = np.asarray(times, np.float64), np.zeros(self.vocabulary.size)
        for own, together in self._by_length(words):
            if not together:
                uses += self.expect((words[i], int(times[i])) for i in own)
                continue
            some = [words[i] for i in own]
            node, arcs = self._together(some)
            back = np.full_like(node, -np.inf)
            back[:, -1] = 0.0
            for i, j, rows, log, pieces in sorted(arcs, key=lambda a: -a[0]):
                way = log + back[rows, j]
                back[rows, i] = np.logaddexp(back[rows, i], way)
                share = np.exp(node[rows, i] + way - node[rows, -1]) * times[own[rows]]
                if pieces is not None:
                    uses += np.bincount(pieces, weights=share, minlength=len(uses))
                    continue
                for row, value in zip(rows.tolist(), share.tolist()):
                    for b in (SPACE + some[row])[i].encode("utf-8", "surrogatepass"):
                        uses[self.vocabulary.byte_ids[b]] += value
        return uses
