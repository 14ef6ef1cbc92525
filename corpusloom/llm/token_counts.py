"""Token counts of texts of any length, as a public tokenizer file gives them.

A huge document is encoded in overlapping chunks. Two chunks are spliced at a place in their
overlap where both have a token boundary that is proven to be one of the whole document; where
there is none the overlap is widened, in the end to the whole document.

Why a place is proven: the pre-token pattern of byte-level vocabularies takes no white space behind a
character that is none, so a match always ends between such a character and a space. What comes before
does not depend on what follows, and matching begins anew behind. The same fact lets words be
encoded once per task.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_rows import slices
from corpusloom.llm.columns import quoted

REMEMBERED = 300_000  # words of a generation of the memo; bounds memory, decides nothing
LONGEST_WORD = 64
#: Characters that some table of white space has; one of them before a space leaves the place unproven.
GAP = r"[\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]"


class Counter:
    """One task's tokenizer and memo of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            raw = file.read()
        spec = json.loads(raw)
        kind = spec.get("pre_tokenizer") or {}
        if kind.get("type") != "ByteLevel" or not kind.get("use_regex", True) or kind.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("boundaries are proven for byte-level vocabularies without normalizer or prefix space only")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in spec.get("added_tokens", [])):
            raise ValueError("added tokens that reach over spaces are not supported")
        self.library = Tokenizer.from_str(raw)
        self.library.no_truncation()
        self.library.no_padding()
        self.gap = regex.compile(GAP + " ").search
        self.gap_before = regex.compile(GAP).match
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library_ends(self, text: str) -> list[int]:
        return [end for _, end in self.library.encode(text, add_special_tokens=False).offsets]

    def learn(self, words: set[str]) -> None:
        """Encode the words, each with a space before it, that the memo lacks: the end of every token."""
        fresh = []
        for w in words:
            if w not in self.words:
                known = self.older.get(w)
                if known is not None:
                    self.words[w] = known
                elif len(w) <= LONGEST_WORD:
                    fresh.append(w)
        for w, e in zip(fresh, self.library.encode_batch([" " + w for w in fresh], add_special_tokens=False)):
            self.words[w] = bytes(end for _, end in e.offsets)

    def forget(self) -> None:
        if len(self.words) >= REMEMBERED:
            self.older, self.words = self.words, {}

    def _word(self, word: str) -> bytes | list[int]:
        known = self.words.get(word)
        if known is None:
            if len(word) > LONGEST_WORD:
                return self._library_ends(" " + word)
            self.learn({word})
            known = self.words[word]
        return known

    def count(self, text: str) -> int:
        """Tokens of a text in one go."""
        if self.gap(text) or text.startswith(" "):
            return len(self.library.encode(text, add_special_tokens=False))
        first, *rest = text.split(" ")
        n = len(self.library.encode(first, add_special_tokens=False)) if first else 0
        return n + sum(len(self._word(w)) for w in rest)

    def ends(self, text: str) -> np.ndarray:
        """Where each token of ``text`` ends."""
        if self.gap(text) or text.startswith(" "):
            return np.array(self._library_ends(text), np.int64)
        first, *rest = text.split(" ")
        parts = [self._word(w) for w in rest]
        if any(not isinstance(p, bytes) for p in parts):  # a word too long for the memo
            return np.array(self._library_ends(text), np.int64)
        starts = len(first) + np.cumsum(np.r_[0, [len(w) + 1 for w in rest]])[:-1]
        behind = np.frombuffer(b"".join(parts), np.uint8) + np.repeat(starts, [len(p) for p in parts])
        return np.concatenate([np.array(self._library_ends(first) if first else [], np.int64), behind.astype(np.int64)])

    def proven(self, text: str, at: int) -> bool:
        return 0 < at < len(text) and text[at] == " " and not self.gap_before(text[at - 1])

    def count_long(self, text: str, chunk: int, overlap: int) -> int:
        """Tokens of a text, by chunks of about ``chunk`` characters that share ``overlap`` or more."""
        total, start, size = 0, 0, chunk  # tokens before ``start``, a proven boundary, are counted
        left = self.ends(text[:size])
        while start + size < len(text):
            stop, shared = start + size, min(overlap, size)
            while True:
                behind = stop - shared
                right = self.ends(text[behind:behind + chunk]) + behind
                common = np.intersect1d(left[(left > max(behind, start)) & (left < stop)], right[right < stop])
                at = next((int(p) for p in common if self.proven(text, int(p))), None)
                if at is not None or shared == size:
                    break
                shared = min(2 * shared, size)
            if at is None:  # no boundary in the whole chunk: take a longer one
                size *= 2
                left = self.ends(text[start:start + size]) + start
                continue
            total += int(np.count_nonzero(left <= at))
            reach = min(behind + chunk, len(text))
            start, size, left = at, max(reach - at, 1), right[right > at]
        return total + len(left)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One per Python worker, so that its memo outlives a task."""
    return Counter(path)


def count_tokens(df: DataFrame, path: str, *, text_col: str = "text", carry: Sequence[str] = (),
                 chunk_chars: int = 16_384, overlap_chars: int = 256) -> DataFrame:
    """The columns ``carry`` and ``n_tokens`` for every row of ``df``.

    ``path`` names a ``tokenizers`` file of a byte-level vocabulary on every machine. Counts are those of
    the library on the whole text, without tokens that a template adds; strings of special tokens count
    as the library takes them. Null counts as the empty text, which has none. Equal rows have equal
    counts; an empty table gives no rows. Texts beyond ``chunk_chars`` go by chunks, so that the library's
    memory for one text is bounded unless the text has no proven boundary.
    Map-only; a task holds one slice of rows and a bounded memo.
    """
    if not 0 < overlap_chars <= chunk_chars:
        raise ValueError("0 < overlap_chars <= chunk_chars")
    rows = df.select(*[F.col(quoted(c)) for c in carry], F.col(quoted(text_col)).cast("string").alias("__text"))
    fields = rows.schema.fields[:-1] + [T.StructField("n_tokens", T.LongType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            own.learn({w for t in texts for w in t.split(" ")[1:]})
            counts = [own.count(t) if len(t) <= chunk_chars else own.count_long(t, chunk_chars, overlap_chars) for t in texts]
            own.forget()
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(counts, pa.int64())], names=names)

    return rows.mapInArrow(run, T.StructType(fields))
