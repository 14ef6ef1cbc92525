"""Near-duplicate classes by SimHash fingerprints of word shingles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_rows import slices
from corpusloom.llm.columns import quoted
from corpusloom.llm.components import components
from corpusloom.llm.gray_index import gray_rank, linked
from corpusloom.scratch import settle

SEED = 42
SHINGLES_AT_ONCE = 1 << 15
ROWS_AT_ONCE = 1 << 16


def simhash(text: str | None, words_each: int = 4, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text; 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and the six ASCII spaces
    if not words:
        return 0
    if len(words) <= words_each:
        return xxh64_intdigest(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1][: len(words) - words_each + 1].tolist()
    ends = ends[words_each - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        some = slice(at, at + SHINGLES_AT_ONCE)
        hashes = np.array([xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts[some], ends[some])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_each: int = 4,
                 carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fingerprint`` (the 64 bits as a signed long) and the columns ``carry``, for every row."""
    kept = [F.col(quoted(c)) for c in carry]
    rows = df.select(F.col(quoted(id_col)).alias("doc_id"), *kept, F.col(quoted(text_col)).cast("string").alias("__text"))
    out = T.StructType([f for f in rows.schema if f.name != "__text"] + [T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            codes = np.array([simhash(t.as_py(), words_each) for t in batch.column(batch.num_columns - 1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(codes.view(np.int64))], names=batch.schema.names[:-1] + ["fingerprint"])

    return rows.mapInArrow(run, out)


def _blocks(limit: int) -> list[tuple[int, int]]:
    """(shift, width) of ``limit + 2`` blocks that make up the 64 bits; codes within the limit agree on two."""
    edges = np.linspace(0, 64, limit + 3).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges, edges[1:])]


def _links(limit: int):
    """Rows (group ids..., fingerprint) sorted by group -> (a, b) edges to each linked set's representative."""
    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        cols = [np.concatenate([p.column(i).to_numpy(zero_copy_only=False) for p in parts]) for i in range(4)]
        codes = cols[3].view(np.uint64)
        group = np.cumsum(np.r_[0, np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)]) if len(codes) > 1 else np.zeros(len(codes), int)
        order = np.lexsort((gray_rank(codes), group))
        codes = codes[order]
        label = linked(group[order], codes, limit)
        out = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays(
            [pa.array(codes[out].view(np.int64)), pa.array(codes[label[out]].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= ROWS_AT_ONCE:  # hand over the groups that ended, keep the last, which may go on
                tail = [held[-1].column(i)[held[-1].num_rows - 1].as_py() for i in range(3)]
                same = np.logical_and.reduce([batch.column(i).to_numpy(zero_copy_only=False) == tail[i] for i in range(3)])
                more = int(same.sum())  # sorted: they lead the batch
                if more < batch.num_rows:
                    yield solve(held + [batch.slice(0, more)])
                    held, rows, batch = [], 0, batch.slice(more)
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield solve(held)

    return run


def fingerprint_components(codes: DataFrame, *, limit: int = 4) -> DataFrame:
    """``node, root`` of the fingerprints (column ``fingerprint``) that link to another at ``limit`` or
    fewer differing bits; those that link to none are left out. Exact.

    Codes within the limit agree on two of ``limit + 2`` blocks of bits, so each code is filed under
    every pair of blocks and each file is searched by the Gray hierarchy. A file of n codes is dealt
    into k parts with k = sqrt(n / 32), and every two parts meet in a task of their own: a group holds
    about 11 sqrt(n) codes, however crowded a file is. Tasks return one edge per code to its set's
    representative, never pairs.
    """
    distinct = settle(codes.select("fingerprint").distinct())
    blocks = _blocks(limit)
    files = []
    for n, two in enumerate(combinations(range(len(blocks)), 2)):
        key = F.lit(n).cast("long")
        for shift, width in (blocks[i] for i in two):
            part = F.shiftrightunsigned("fingerprint", shift).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(part)
        files.append(key)
    filed = distinct.select(F.explode(F.array(*files)).alias("file"), "fingerprint")
    crowded = settle(filed.groupBy("file").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "file", F.ceil(F.sqrt(F.col("n") / 32)).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("fingerprint", "file"), F.col("parts")).cast("int")
    met = filed.join(crowded, "file").withColumn("own", own).select(
        "file", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"), "own", "fingerprint").select(
        "file", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fingerprint")
    group = ["file", "low", "high"]
    edges = met.repartition(*group).sortWithinPartitions(*group).mapInArrow(_links(limit), "a long, b long")
    return components(edges)


def near_duplicates(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words_each: int = 4,
                    limit: int = 4, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fingerprint`` (16 lowercase hex digits), ``component_id``, ``component_code`` (a fingerprint that stands for the
    component) and the columns ``carry`` (under other names), for every row.

    Texts have A-Z lower-cased and are split at ASCII white space; shingles of ``words_each`` words, repeats
    included, are hashed by XXH64 and vote on each of 64 bits. A shorter text is one shingle; null and
    texts without words have fingerprint zero, which links like any other. ``component_id`` is the
    smallest id that links reach, the row's own included (null only where all ids are). Repeated rows and
    ties share a fingerprint, hence a component. An empty table gives no rows.

    Each text is read once and reduced to its fingerprint; equal fingerprints are one from there on.
    """
    coded = settle(fingerprints(df, id_col=id_col, text_col=text_col, words_each=words_each, carry=carry))
    roots = settle(fingerprint_components(coded, limit=limit)).withColumnRenamed("node", "fingerprint")
    smallest = settle(coded.groupBy("fingerprint").agg(F.min("doc_id").alias("low")))
    rooted = smallest.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = settle(rooted.select("fingerprint", "root", "low"))
    names = settle(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    by_code = settle(rooted.join(names, "root").select("fingerprint", "component_id", "root"))

    def digits(code: str) -> Column:
        return F.lpad(F.lower(F.hex(code)), 16, "0")

    return coded.join(by_code, "fingerprint").select(
        "doc_id", digits("fingerprint").alias("fingerprint"), "component_id", digits("root").alias("component_code"),
        *[quoted(c) for c in carry])
