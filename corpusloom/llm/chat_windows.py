"""Conversations as budgeted windows of formatted turns, with the spans that a loss may see.

The tokens of the turns before it place every turn on a line that is ruled into cells. Turns that lie in one cell are a span;
a turn that crosses a rule is a span of its own. So each turn finds its span by itself, from prefix sums, and
none exceeds a cell but by a single turn. A window is the conversation's system turn, the history that fits whole before
the span, and the span; repeated turns are masked.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.columns import quoted
from corpusloom.llm.ordering import laid_out, summed
from corpusloom.scratch import settle

WORD = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"  # what counts as a token of a text
MARK_TOKENS = 4  # of the marks and the role of a turn


@dataclass(frozen=True)
class Template:
    """A turn is ``opens role said text closes``. Strings of ``control`` have no way into roles and texts: a backslash goes after their
    first character, and backslashes are doubled."""

    opens: str = "<s>"
    said: str = "[INST]"
    closes: str = "[/INST]</s>"
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")

    def __post_init__(self):
        firsts = {c[:1] for c in self.control}
        if any(len(c) < 2 or "\\" in c or firsts & set(c[1:]) for c in self.control):
            raise ValueError("a control string needs two characters, no backslash, and no first character again inside one")
        marks = (self.opens, self.said, self.closes)
        if not all(marks) or any(re.sub("|".join(map(re.escape, self.control)), "", m) for m in marks):
            raise ValueError("marks must be made of control strings")

    def escaped(self, text: Column) -> Column:
        between = "|".join(rf"(?<=\Q{c[0]}\E)(?=\Q{c[1:]}\E)" for c in self.control)
        return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), between, r"\\")

    @staticmethod
    def plain(text: Column) -> Column:
        return F.regexp_replace(text, r"\\(\\?)", "$1")

    def turns(self, formatted: Column) -> Column:
        """The (role, text) of a formatted window's turns, read from the window alone."""
        pieces = F.split(formatted, rf"\Q{self.closes}\E")

        def turn(piece: Column) -> Column:
            head = F.substring_index(piece, self.said, 1)
            role, text = F.substr(head, F.lit(len(self.opens) + 1)), F.substr(piece, F.length(head) + len(self.said) + 1)
            return F.struct(self.plain(role).alias("role"), self.plain(text).alias("text"))

        return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)

    def loss_texts(self, formatted: Column, loss: Column) -> Column:
        """The texts under the spans ``loss`` of a formatted window."""
        return F.transform(loss, lambda s: self.plain(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def chat_windows(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 budget: int = 1024, history: int = 256, system: str = "system", learned: str = "assistant",
                 template: Template = Template()) -> DataFrame:
    """``conv_id, span, n_tokens, n_repeated, n_fresh, formatted, loss`` of every window of the conversations of ``df``.

    A conversation's turns are taken by turn (null first), then role and text by their hash; rows alike in all are turns of their own, told
    apart by their place in the input. Null roles and texts count as empty, null conversations are one. ``n_tokens``, the words
    and signs of the texts and ``MARK_TOKENS`` a turn, is at most ``budget`` unless a single turn, or the system turn, is
    longer than its share; no turn is cut or left out. The first turn, if its role is ``system``, opens every window. Then
    come the turns before the span that fit whole into ``history`` tokens, then the span. The first ``n_repeated`` turns were in
    earlier windows; each turn is fresh once, windows in the order of ``span`` (not gapless).

    ``loss`` has the places ``[start, end)``, in characters of ``formatted``, of the texts of fresh turns whose role is ``learned``.
    An empty table gives no rows. Native throughout. A window's turns are all that ever meets in one group; a
    conversation of any length is many of them, and its prefix sums go over range partitions.
    """
    if not 0 < history < budget:
        raise ValueError("history must lie between 0 and budget")
    conv = F.col(quoted(conv_col))
    as_text = lambda name: F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))
    turns = settle(df.select(
        conv.isNull().alias("no_conv"), F.coalesce(conv.cast("long"), F.lit(0)).alias("conv"), F.col(quoted(turn_col)).cast("long").alias("turn"),
        as_text(role_col).alias("role"), as_text(text_col).alias("text"), F.monotonically_increasing_id().alias("row")))
    group = ["no_conv", "conv"]
    narrow = turns.select(
        *group, "turn", F.xxhash64("role", "text").alias("same"), "row", (F.col("role") == system).alias("is_system"),
        (F.regexp_count("text", F.lit(WORD)) + MARK_TOKENS).cast("long").alias("tokens"), F.lit(1).cast("long").alias("one"))
    line = settle(summed(laid_out(narrow, [*group, "turn", "same", "row"]), group, ["tokens", "one"]))

    heads = settle(line.where("is_system and before_one = 0").select(*group, F.col("row").alias("head"), F.col("tokens").alias("head_tokens")))
    room = F.lit(budget - history) - F.coalesce("head_tokens", F.lit(0))
    placed = line.join(heads.hint("merge"), group, "left").withColumn("cell_size", F.greatest(room, F.lit(1)))
    is_head = F.coalesce(F.col("row") == F.col("head"), F.lit(False))
    start = F.when(is_head, 0).otherwise(F.col("before_tokens") - F.coalesce("head_tokens", F.lit(0)))
    placed = placed.withColumn("start", start).withColumn("cell", F.expr("start div cell_size"))
    crosses = ~is_head & (F.col("start") % F.col("cell_size") > 0) & (F.expr("(start + tokens - 1) div cell_size") > F.col("cell"))
    placed = settle(placed.withColumn("span", 2 * F.col("cell") + crosses.cast("long")).select(
        *group, "row", "head", "start", "tokens", "cell", "cell_size", "span", is_head.alias("is_head"), F.col("before_one").alias("at")))

    spans = settle(placed.groupBy(*group, "span", "cell").agg(F.min("start").alias("opens"), F.first("head").alias("head")))
    back = F.least(F.lit(history), F.col("cell_size"))
    reach = placed.where("not is_head").select(
        *group, "row", "at", "start", "tokens", back.alias("back"), F.explode(F.sequence("cell", F.expr(f"(start + least({int(history)}, cell_size)) div cell_size"))).alias("cell"))
    repeated = reach.join(spans.hint("merge"), [*group, "cell"]).where("opens > start and opens - start <= back").select(*group, "span", "row", "at")
    opened = spans.where("span > 0 and head is not null").select(*group, "span", F.col("head").alias("row"), F.lit(0).cast("long").alias("at"))
    members = placed.select(*group, "span", "row", "at").withColumn("fresh", F.lit(True)).unionByName(
        repeated.unionByName(opened).withColumn("fresh", F.lit(False)))
    said = settle(members).join(turns.select("row", "role", "text").hint("merge"), "row")

    turn = F.struct("at", "fresh", "role", "text")
    windows = said.groupBy(*group, "span").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    head = lambda t: F.concat(F.lit(template.opens), template.escaped(t["role"]), F.lit(template.said))
    pieces = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), template.escaped(t["text"]).alias("body"), (t["fresh"] & (t["role"] == learned)).alias("learned")))
    tokens = F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + F.regexp_count(t["text"], F.lit(WORD)) + MARK_TOKENS)
    sized = windows.select(
        *group, "span", tokens.alias("n_tokens"), F.size(F.filter("turns", lambda t: ~t["fresh"])).alias("n_repeated"),
        F.size(F.filter("turns", lambda t: t["fresh"])).alias("n_fresh"), F.explode(F.array(pieces)).alias("pieces"))  # escaped once
    spot = "struct<start:long,end:long>"

    def forward(held: Column, piece: Column) -> Column:
        body = held["at"] + F.length(piece["head"])
        after = body + F.length(piece["body"])
        mine = F.when(piece["learned"], F.array(F.struct(body.alias("start"), after.alias("end")))).otherwise(F.array().cast(f"array<{spot}>"))
        return F.struct((after + len(template.closes)).alias("at"), F.concat(held["loss"], mine).alias("loss"))

    loss = F.aggregate("pieces", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{spot}>").alias("loss")), forward)["loss"]
    formatted = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(template.closes))), "")
    return sized.select(
        F.when(F.col("no_conv"), None).otherwise(F.col("conv")).alias("conv_id"), "span", "n_tokens", "n_repeated", "n_fresh",
        formatted.alias("formatted"), loss.alias("loss"))
