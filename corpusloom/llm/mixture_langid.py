"""The languages of a text as a mixture, by letter trigrams and expectation-maximisation.

Every trigram of a text is taken to come from one of the learned languages; their proportions are
those of greatest likelihood. Languages are added to a text's set one at a time, as long as the
likelihood gained exceeds a penalty that grows with the logarithm of the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_rows import slices
from corpusloom.llm.columns import quoted

BUCKETS = 1 << 15
MAX_LANGUAGES = 512  # bounds the model to 128 MB; more distinct labels are an error, not a cut
PENALTY = 3.0  # log-likelihood a language must add, times the logarithm of the number of trigrams
OVERLAP = 3.0  # neighbouring trigrams share letters, so each counts for a third of one
ALPHA = 0.1
ROUNDS = 50
LETTERS_AT_ONCE = 1 << 20


class Trigrams:
    """Counts of a text's letter trigrams in ``BUCKETS`` hash buckets."""

    def __init__(self):
        self.letter = np.zeros(0x110000, bool)
        self.letter[[i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]] = True

    def counts(self, text: str) -> np.ndarray:
        """A text's counts; what is no letter becomes one space, at both ends too. All zero without letters."""
        total = np.zeros(BUCKETS, np.int64)
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = self.letter[codes]
        if not is_letter.any():
            return total
        codes = np.where(is_letter, codes, 32)
        codes = np.r_[np.uint32(32), codes, np.uint32(32)]
        codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]].astype(np.uint64)
        for at in range(0, len(codes) - 2, LETTERS_AT_ONCE):
            some = codes[at:at + LETTERS_AT_ONCE + 2]
            mixed = (some[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (some[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (some[2:] * np.uint64(0x165667B19E3779F9))
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            total += np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
        return total


def learn(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and log-probabilities of the buckets for each.

    Every row with a label and a letter counts, whole. Tasks sum their rows before anything moves, so
    a language holding most rows costs no more than another; the driver gets at most ``BUCKETS`` numbers for
    each language.
    """
    rows = df.where(F.col(quoted(lang_col)).isNotNull() & F.col(quoted(text_col)).isNotNull()).select(
        F.col(quoted(lang_col)).cast("string").alias("lang"), F.col(quoted(text_col)).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sums = Trigrams(), {}

        def flush():
            for lang, counts in sums.items():
                some = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["lang", "bucket", "n"])
            sums.clear()

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = own.counts(text.as_py())
                if lang in sums:
                    sums[lang] += counts
                else:
                    sums[lang] = counts
            if len(sums) > 64:
                yield from flush()
        yield from flush()

    table = rows.mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = table.limit(MAX_LANGUAGES * BUCKETS + 1).toPandas()
    langs = sorted(found["lang"].unique())
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = np.zeros((len(langs), BUCKETS))
    counts[np.searchsorted(np.array(langs, object), found["lang"].to_numpy()), found["bucket"].to_numpy()] = found["n"]
    smooth = counts + ALPHA
    return langs, np.log(smooth / smooth.sum(axis=1, keepdims=True))


def proportions(counts: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Each language's share of a text with these (non-zero) bucket counts; shares sum to 1.

    ``model`` has the log-probabilities of the same buckets. The likelihood is concave in the shares, so for any
    shares a language can add at most its slope there: sets that no language can improve by the penalty
    need no iteration.
    """
    counts = counts / OVERLAP
    total = counts.sum()
    single = model @ counts
    best = int(single.argmax())
    shares = np.zeros(len(model))
    shares[best] = 1.0
    if len(model) == 1:
        return shares
    needed = PENALTY * np.log(1.0 + total)
    likely = np.exp(model - model.max(axis=0))
    mixed = likely[best]
    while True:
        slope = (likely / mixed) @ counts - total
        slope[shares > 0] = 0
        new = int(slope.argmax())
        if slope[new] <= needed:
            return shares
        held = np.append(np.flatnonzero(shares), new)
        sub, part = likely[held], np.append(shares[shares > 0] * 0.5, 0.5)
        before = counts @ np.log(mixed)
        value = -np.inf
        for _ in range(ROUNDS):
            joint = part[:, None] * sub
            both = joint.sum(axis=0)
            now = counts @ np.log(both)
            part = (joint / both) @ counts / total
            if now - value < 0.01:
                break
            value = now
        if now - before <= needed:
            return shares
        shares[:] = 0
        shares[held] = part
        shares /= shares.sum()
        mixed = np.maximum(shares @ likely, 1e-300)
        if (shares > 0).all():
            return shares


def predict(df: DataFrame, langs: list[str], model: np.ndarray, *, text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """The columns ``carry``, ``lang_pred``, ``score`` and ``lang_shares`` (a map of every language found to its
    share) for every row.

    ``lang_pred`` is the language of the largest share (the first by name among equals) and ``score`` that share.
    A null text and one without a letter are ``und`` with score 0 and no shares, as are all texts when
    nothing was learned. Only the text is looked at, whole; equal texts have equal results, and an
    empty table gives no rows.
    Map-only; the model is at most ``MAX_LANGUAGES`` x ``BUCKETS`` numbers.
    """
    sent = df.sparkSession.sparkContext.broadcast((langs, model))
    rows = df.select(*[F.col(quoted(c)) for c in carry], F.col(quoted(text_col)).cast("string").alias("__text"))
    fields = rows.schema.fields[:-1] + [
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
        T.StructField("lang_shares", T.MapType(T.StringType(), T.DoubleType()))]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (langs, model) = Trigrams(), sent.value
        for batch in slices(batches):
            pred, score, shares = [], [], []
            for text in batch.column(batch.num_columns - 1):
                counts = own.counts(text.as_py() or "")
                some = np.flatnonzero(counts)
                if not len(some) or not langs:
                    pred.append("und")
                    score.append(0.0)
                    shares.append([])
                    continue
                part = proportions(counts[some], model[:, some])
                top = int(part.argmax())
                pred.append(langs[top])
                score.append(float(part[top]))
                shares.append([(langs[i], float(part[i])) for i in np.flatnonzero(part)])
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                names=names)

    return rows.mapInArrow(run, T.StructType(fields))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit("")).cast("binary")) % folds
