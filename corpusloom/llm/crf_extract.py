"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

Each leaf block of a page is article or surroundings. Its enclosing elements, their class words and the
looks of its text are features; neighbouring labels depend on each other; the best sequence of labels is
found by Viterbi. The model is trained on labelled pages, by the gradient of their likelihood.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_rows import slices
from corpusloom.llm.columns import quoted
from corpusloom.llm.labelled_pages import labelled_pages
from corpusloom.llm.leaf_blocks import CLOSED_BY, INLINE, RAW, UNSEEN, VOID, Block, Scope, leaf_blocks

PAGES, SEED, EPOCHS = 500, 7, 6  # the labelled pages and the passes over them
RATE, DECAY = 0.3, 1e-4

# Parts of class, id and role words that tell what an element holds.
KINDS = {
    "menu": "nav menu breadcrumb toolbar tabs pagination pager sitemap",
    "header": "header masthead banner topbar top-bar logo branding",
    "footer": "footer copyright colophon legal bottom imprint contentinfo",
    "aside": "sidebar side-bar widget related recommend complementary aside rail right-column more-from also read-more trending popular",
    "share": "share social follow tags tag-list byline meta author-box",
    "notice": "cookie consent gdpr notice alert popup modal overlay newsletter subscribe signup dialog paywall message toast",
    "advert": "advert sponsor promo banner-ad adsense taboola outbrain dfp",
    "form": "form search login register",
    "comment": "comment reply replies respons disqus discuss thread feedback",
    "article": "article content post entry story main body text prose blog",
}
_KIND = [(kind, re.compile("|".join(map(re.escape, words.split())))) for kind, words in KINDS.items()]
_AD = re.compile(r"(?:^|[-_])ads?(?:$|[-_\d])|adslot|adunit|adbox")
KNOWN = INLINE | VOID | RAW | UNSEEN | frozenset(CLOSED_BY).union(*CLOSED_BY.values()) | frozenset("html caption colgroup thead legend search slot picture".split())
_STRUCTURE = frozenset("html body div span tbody thead center font".split())


@lru_cache(maxsize=20_000)
def _word_kinds(word: str) -> tuple[str, ...]:
    found = [kind for kind, pattern in _KIND if pattern.search(word)]
    if _AD.search(word):
        found.append("advert")
    return tuple(found)


def _size(n: int) -> str:
    return "0" if n == 0 else str(min(9, n.bit_length()))


_EMPHASIS = frozenset("b strong a i em span font small u".split())


def _facts(scope: Scope | None) -> tuple[str, frozenset[str], frozenset[str]]:
    """(innermost element but emphasis, elements around, kinds of their class words), once for each element.

    Elements that the HTML standard does not know are in no feature, so the sets are bounded however deep a page is.
    """
    chain = []
    while scope is not None and scope.facts is None:
        chain.append(scope)
        scope = scope.parent
    leaf, inside, kinds = ("none", frozenset(), frozenset()) if scope is None else scope.facts
    for one in reversed(chain):
        leaf = leaf if one.tag in _EMPHASIS else one.tag
        if one.tag in KNOWN and one.tag not in _STRUCTURE and one.tag not in inside:
            inside = inside | {one.tag}
        found = {k for w in one.names for k in _word_kinds(w)}
        kinds = kinds if found <= kinds else kinds | found
        one.facts = leaf, inside, kinds
    return leaf, inside, kinds


def features(block: Block) -> set[str]:
    text = block.text
    leaf, inside, kinds = _facts(block.scope)
    out = {"always", "leaf " + leaf}
    out.update("in " + t for t in inside)
    out.update("kind " + k for k in kinds)
    if len(kinds - {"article"}):
        out.add("kind other")
    if "article" in kinds and len(kinds) == 1:
        out.add("kind article only")
    n_words = text.count(" ") + 1
    linked = block.linked / max(len(text), 1)
    out.add("words " + _size(n_words))
    out.add("linked " + ("none" if block.linked == 0 else "some" if linked < 0.4 else "most" if linked < 0.85 else "all"))
    out.add("end " + ("stop" if text[-1] in ".!?…\"'”»。" else "colon" if text[-1] in ":;," else "none"))
    out.add("leaf " + leaf + " words " + ("few" if n_words < 8 else "some" if n_words < 30 else "many"))
    if "©" in text:
        out.add("has copyright")
    if text[:1].isdigit():
        out.add("starts with digit")
    if text.isupper():
        out.add("upper")
    return out


def _emit(weights: dict[str, float], rows: Sequence[set[str]]) -> list[float]:
    """Score of being article, less that of not being, for each block."""
    get = weights.get
    return [sum([get(f, 0.0) for f in row]) for row in rows]


def _sum(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def _marginals(score: list[float], t: list[float]) -> tuple[list[float], list[float]]:
    """P(article) of each block, and the expected counts of the four transitions (2 * before + after)."""
    n = len(score)
    ahead = [(0.0, score[0])]
    for s in score[1:]:
        a0, a1 = ahead[-1]
        ahead.append((_sum(a0 + t[0], a1 + t[2]), s + _sum(a0 + t[1], a1 + t[3])))
    back = [(0.0, 0.0)] * n
    for i in range(n - 2, -1, -1):
        b0, b1, s = *back[i + 1], score[i + 1]
        back[i] = (_sum(t[0] + b0, t[1] + s + b1), _sum(t[2] + b0, t[3] + s + b1))
    whole = _sum(*ahead[-1])
    inner = [math.exp(a[1] + b[1] - whole) for a, b in zip(ahead, back)]
    moves = [0.0] * 4
    for i in range(1, n):
        for y in (0, 1):
            for z in (0, 1):
                moves[2 * y + z] += math.exp(ahead[i - 1][y] + t[2 * y + z] + z * score[i] + back[i][z] - whole)
    return inner, moves


@lru_cache(maxsize=4)
def train(pages: int = PAGES, seed: int = SEED, epochs: int = EPOCHS) -> tuple[dict[str, float], list[float]]:
    """Weights of the features, and of the four transitions, by stochastic gradient with shrinking steps."""
    data = []
    for page, labels in labelled_pages(pages, seed):
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise ValueError("a labelled page whose blocks are not its texts")
        data.append(([features(b) for b in blocks], labels))
    weights: dict[str, float] = {}
    t, squares, t_squares = [0.0] * 4, {}, [1.0] * 4
    draw = random.Random(seed)
    for _ in range(epochs):
        draw.shuffle(data)
        for rows, labels in data:
            inner, moves = _marginals(_emit(weights, rows), t)
            slope: dict[str, float] = {}
            for row, p, y in zip(rows, inner, labels):
                for f in row:
                    slope[f] = slope.get(f, 0.0) + y - p
            for f, g in slope.items():
                g -= DECAY * weights.get(f, 0.0)
                squares[f] = squares.get(f, 1.0) + g * g
                weights[f] = weights.get(f, 0.0) + RATE * g / math.sqrt(squares[f])
            for y, z in zip(labels, labels[1:]):
                moves[2 * y + z] -= 1
            for k in range(4):
                t_squares[k] += moves[k] ** 2
                t[k] -= RATE * moves[k] / math.sqrt(t_squares[k])
    return weights, t


def decode(score: list[float], t: list[float]) -> list[int]:
    """The most likely labels; among equals, surroundings."""
    if not score:
        return []
    off, on, came = 0.0, score[0], []
    for s in score[1:]:
        to_off, to_on = (off + t[0], on + t[2]), (off + t[1], on + t[3])
        came.append((int(to_off[1] > to_off[0]), int(to_on[1] > to_on[0])))
        off, on = max(to_off), s + max(to_on)
    label = [int(on > off)]
    for step in reversed(came):
        label.append(step[label[-1]])
    return label[::-1]


def main_text(page: str | None, model: tuple[dict[str, float], list[float]]) -> str:
    blocks = leaf_blocks(page)
    labels = decode(_emit(model[0], [features(b) for b in blocks]), model[1])
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


def extract_text(df: DataFrame, *, html_col: str = "html", carry: Sequence[str] = (), pages: int = PAGES, seed: int = SEED) -> DataFrame:
    """The columns ``carry`` and ``text``, the main text, for every row of ``df``.

    Blocks are joined in page order by one line feed; in a block character references are decoded and white space
    becomes one space. Null counts as the empty page, whose text is empty, as it is where no block
    is part of an article. Every block of a page is read, however long, and pages take time in proportion to their length, however
    deeply elements are nested. Equal pages have equal texts; an
    empty table gives no rows.
    The model is trained on ``pages`` labelled pages drawn with ``seed``, none of them from ``df``, and has some
    hundred weights. Map-only; a task holds one slice of pages.
    """
    model = train(pages, seed)
    rows = df.select(*[F.col(quoted(c)) for c in carry], F.col(quoted(html_col)).cast("string").alias("__html"))
    fields = rows.schema.fields[:-1] + [T.StructField("text", T.StringType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page.as_py(), model) for page in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(run, T.StructType(fields))
