"""Texts to byte-level BPE ids and back, by the ranks of a public vocabulary file."""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_rows import slices
from corpusloom.llm.columns import quoted
from corpusloom.llm.rank_queue import RankTable

REMEMBERED = 400_000  # entries of a generation of a memo, some 200 bytes each; bounds memory, decides nothing
LONGEST_KEY = 64


class Memo(dict):
    """Results of ``solve`` by text, kept for two generations of ``remembered`` entries."""

    def __init__(self, solve, remembered: int):
        super().__init__()
        self.solve, self.remembered, self.old = solve, remembered, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.solve(key)
            if len(key) > LONGEST_KEY:  # rare, and large
                return found
        if len(self) >= self.remembered:
            self.old = dict(self)
            self.clear()
        self[key] = found
        return found


class Codec:
    """Encoder and decoder of one task: a rank table, a pre-token pattern and the task's memos."""

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        import regex

        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            self.table = RankTable({base64.b64decode(p[0]): int(p[1]) for p in pairs if p})
        self.find = regex.compile(pattern).findall
        self.gap = regex.compile(r"\s ").search
        self.piece = Memo(lambda piece: array("i", self.table.encode(piece.encode())).tobytes(), remembered)
        self.chunk = Memo(lambda chunk: self._pieces(" " + chunk), remembered)

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self.piece.__getitem__, self.find(text)))

    def encode(self, text: str) -> bytes:
        """Ids of every match of the pattern in turn, as the bytes of 32-bit integers.

        A space after something that is no white space always starts a match, and nothing before it depends on what
        follows; so a text where every space is of this kind falls into independent chunks there, and
        a chunk met before needs no matching.
        """
        if self.gap(text) or text.startswith(" "):
            return self._pieces(text)
        first, *rest = text.split(" ")
        return self._pieces(first) + b"".join(map(self.chunk.__getitem__, rest))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.table.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str, remembered: int = REMEMBERED) -> Codec:
    """One per Python worker, so that its memos outlive a task."""
    return Codec(path, pattern, remembered)


def encode_decode(df: DataFrame, path: str, pattern: str, *, text_col: str = "text", carry: Sequence[str] = (),
                  decoded: bool = True, remembered: int = REMEMBERED) -> DataFrame:
    """The columns ``carry``, ``ids`` (array of int) and, if asked for, ``decoded`` (the bytes those ids stand for).

    ``path`` names a rank file on every machine (as the tokenizer package installs it), ``pattern``
    the expression whose matches are encoded one by one. Special tokens are not known: their strings
    are ordinary text. Null counts as the empty text, which has no ids. Equal rows have equal results; an
    empty table gives no rows.
    Map-only: every row stands for itself, and a task holds one slice of rows and memos of four times ``remembered`` words.
    """
    rows = df.select(*[F.col(quoted(c)) for c in carry], F.col(quoted(text_col)).cast("string").alias("__text"))
    fields = rows.schema.fields[:-1] + [T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    fields += [T.StructField("decoded", T.BinaryType())] if decoded else []
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern, remembered)
        for batch in slices(batches):
            ids, ends, raw = [], [0], []
            for text in batch.column(batch.num_columns - 1):
                ids.append(own.encode(text.as_py() or ""))
                ends.append(ends[-1] + len(ids[-1]) // 4)
                if decoded:
                    raw.append(own.decode(array("i", ids[-1])))
            flat = pa.Array.from_buffers(pa.int32(), ends[-1], [None, pa.py_buffer(b"".join(ids))])
            kind = pa.list_(pa.field("element", pa.int32(), nullable=False))
            out = batch.columns[:-1] + [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, type=kind)]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(raw, pa.binary())] if decoded else []), names=names)

    return rows.mapInArrow(run, T.StructType(fields))


def decode(df: DataFrame, path: str, pattern: str, *, ids_col: str = "ids", carry: Sequence[str] = ()) -> DataFrame:
    """The columns ``carry`` and ``decoded``, the bytes of an array of ids; null for a null array.

    An id outside the vocabulary ends the job with an ``IndexError``: such a row has no decoding.
    """
    rows = df.select(*[F.col(quoted(c)) for c in carry], F.col(quoted(ids_col)).cast("array<int>").alias("__ids"))
    fields = rows.schema.fields[:-1] + [T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in slices(batches):
            raw = [None if x is None else own.decode(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(raw, pa.binary())], names=[f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))
