"""Byte-pair merging with a rank queue: buckets of positions under a hierarchical bitmap.

The bytes of a pre-token form a linked list. Every adjacent pair that has a rank leaves its
position in that rank's bucket, and a bit in a bitmap of non-empty buckets; a second bitmap marks
the non-empty words of the first. The next merge is found by find-first-set in one word of
either. A merge leaves entries of pairs that are gone behind; they are known by their rank, which
the list no longer has at that position, and skipped. Each merge costs a constant number of steps
(and a push into the heap that keeps a bucket's positions in order), so the time for a pre-token of
any length is close to proportional.
"""

from __future__ import annotations

from heapq import heappop, heappush

WORD = 8  # a bitmap word has 2 ** WORD bits
BITS = [1 << i for i in range(1 << WORD)]


class RankTable:
    """Token bytes by id, and ids by bytes; the id of a token is its merge rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ids = ranks
        self.size = max(ranks.values()) + 1
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        # rank of a pair of ids, by left << 32 | right
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left = ranks.get(token[:cut])
                if left is not None and (right := ranks.get(token[cut:])) is not None:
                    self.pairs[left << 32 | right] = rank
        # The queue; empty between calls.
        self._buckets: list[list[int] | None] = [None] * self.size
        self._words = [0] * ((self.size >> WORD) + 1)

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token; a pre-token that is itself a token is that token."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        return self._merge(piece)

    def _merge(self, piece: bytes) -> list[int]:
        find, buckets, words, n = self.pairs.get, self._buckets, self._words, len(piece)
        token = [self.single[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # n ends the list
        pair = [find(a << 32 | b) for a, b in zip(token, token[1:])]  # rank of the pair that starts here
        pair.append(None)
        top = 0
        for i, rank in enumerate(pair):
            if rank is not None:
                bucket = buckets[rank]
                if bucket:
                    bucket.append(i)  # ascending, so a heap already
                else:
                    buckets[rank] = [i]
                    word = rank >> WORD
                    words[word] |= BITS[rank & 255]
                    top |= BITS[word] if word < 256 else 1 << word
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            low = bits & -bits
            rank = (word << WORD) + low.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) == 1:
                i = bucket[0]
                buckets[rank] = None
                words[word] = bits ^ low
                if bits == low:
                    top &= top - 1
            else:
                i = heappop(bucket)
            if pair[i] != rank:
                continue  # stale: that pair has been merged away or has grown
            j = after[i]
            token[i] = rank  # the merged pair's id
            pair[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair[i] = new = find(rank << 32 | token[k])
                if new is not None:
                    bucket = buckets[new]
                    if bucket:
                        heappush(bucket, i)
                    else:
                        buckets[new] = [i]
                        word = new >> WORD
                        words[word] |= BITS[new & 255]
                        top |= 1 << word
            else:
                pair[i] = None
            at = before[i]
            if at >= 0:
                pair[at] = new = find(token[at] << 32 | rank)
                if new is not None:
                    bucket = buckets[new]
                    if bucket:
                        heappush(bucket, at)
                    else:
                        buckets[new] = [at]
                        word = new >> WORD
                        words[word] |= BITS[new & 255]
                        top |= 1 << word
        out, i = [], 0
        while i < n:
            out.append(token[i])
            i = after[i]
        return out
