"""Conversations put right by the cheapest edits, on Spark.

Turns are laid out by range, so that blocks of consecutive turns are cut without a task that sees a whole conversation.
Blocks become matrices, a conversation's matrices a vector behind each block (backward) and a state before each (forward);
only these few numbers a block meet in one place. A block's edits follow from both. The report streams a conversation's turns
with their edits in order, one at a time, as its digest asks for.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import turn_edits as te
from corpusloom.llm.columns import quoted
from corpusloom.llm.ordering import laid_out
from corpusloom.scratch import settle

BLOCK_BITS = 12  # of the turns of a block
SHOWN = r"[^\x20\x09-\x0D]"


def _classified(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """A written table: ``c, t, role, text``, ``same`` (hash of role and text), ``row``, ``code`` with duplicates still unmarked, ``key``."""
    as_text = lambda name: F.coalesce(F.col(quoted(name)).cast("string"), F.lit(" "))
    rows = df.select(
        F.col(quoted(conv_col)).cast("long").alias("c"), F.col(quoted(turn_col)).cast("long").alias("t"), as_text(role_col).alias("role"), as_text(text_col).alias("text"))
    shown = F.col("text").rlike(SHOWN)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return settle(rows.select(
        "*", F.xxhash64("role", "text").alias("same"), F.monotonically_increasing_id().alias("row"),
        F.when(~shown, te.BLANK).when(cut, te.TRUNCATED).otherwise(te.NO_FAULT).alias("fault"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256).alias("key")))


def _faulty(turns: DataFrame) -> DataFrame:
    """``c, t, same, row, code`` of all turns. Only the first of equal turns is looked up, by its row, so no common turn is a hot key."""
    firsts = turns.where(F.col("fault") != te.BLANK).groupBy("c", "key").agg(F.min(F.struct("t", "row")).alias("first"))
    firsts = settle(firsts.select(F.col("first.row").alias("row"), F.lit(True).alias("is_first")))
    marked = settle(turns.select("c", "t", "same", "row", "fault", F.substring("role", 1, 1).alias("initial"))).join(firsts.hint("merge"), "row", "left")
    fault = F.when((F.col("fault") != te.BLANK) & F.col("is_first").isNull(), te.DUPLICATE).otherwise(F.col("fault"))
    kind = F.when(F.length("initial") == 0, 3).otherwise(F.coalesce(F.nullif(F.instr(F.lit(te.CLASSES), F.col("initial")), F.lit(0)) - 1, F.lit(3)))
    return marked.select("c", "t", "same", "row", F.char(65 + 4 * fault + kind).alias("code"))


def _mapped(blocks: DataFrame, schema: str, row) -> DataFrame:
    """``blocks`` with the columns of ``schema`` that ``row`` (a function of a block as a dict) gives beside those it had."""
    out = blocks.schema.fields
    whole = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out) + ", " + schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            given = [row(**r) for r in batch.to_pylist()]
            types = types or pa.schema([(name, _ARROW[kind]) for name, kind in (part.split() for part in schema.split(", "))])
            made = pa.Table.from_pylist(given, types).combine_chunks()
            columns = [made.column(i).chunk(0) if made.num_rows else pa.array([], types.field(i).type) for i in range(made.num_columns)]
            yield pa.RecordBatch.from_arrays(batch.columns + columns, names=batch.schema.names + types.names)

    return blocks.mapInArrow(run, whole)


_ARROW = {"array<long>": pa.list_(pa.int64()), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64()}


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (c, head, matrix) by conversation, last block first -> (head, after, last): the vector behind each block."""
    conv, vector = object(), te.ending()
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            last = r["c"] != conv
            if last:
                conv, vector = r["c"], te.ending()
            out.append((r["head"], list(vector), last))
            vector = te.applied(r["matrix"], vector)
        heads, vectors, lasts = zip(*out) if out else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.int64()), pa.array(vectors, pa.list_(pa.int64())), pa.array(lasts, pa.bool_())], names=["head", "after", "last"])


def _entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (c, head, exits) by conversation, first block first -> (head, state): the state before each block."""
    conv, state = object(), te.START
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["c"] != conv:
                conv, state = r["c"], te.START
            out.append((r["head"], state))
            state = r["exits"][state]
        heads, states = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(heads, pa.int64()), pa.array(states, pa.int32())], names=["head", "state"])


def _exits(codes, after, last, **_):
    return {"exits": [s for _, s in te.walked(codes, tuple(after), list(range(te.STATES)), last)]}


def _block_edits(codes, after, last, state, **_):
    return {"edits": te.walked(codes, tuple(after), [state], last)[0][0]}


def edited_blocks(turns: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """A written table of the blocks: ``c``, the first turn's ``t, same, row``, ``head`` (ascending), ``codes``, ``edits``, ``after``, ``state``.

    ``turns`` has ``c, t, same, row, code``. Blocks are at most ``2^block_bits`` consecutive turns of a conversation.
    """
    placed = laid_out(turns, ["c", "t", "same", "row"])
    one = F.struct("place", "code", "t", "same", "row")
    blocks = placed.groupBy("c", F.shiftright("place", block_bits).alias("b")).agg(F.sort_array(F.collect_list(one)).alias("own"))
    blocks = blocks.select(
        "c", F.col("own")[0]["place"].alias("head"), F.col("own")[0]["t"].alias("t"), F.col("own")[0]["same"].alias("same"), F.col("own")[0]["row"].alias("row"),
        F.array_join("own.code", "").alias("codes"))
    blocks = settle(_mapped(blocks, "matrix array<long>", lambda codes, **_: {"matrix": te.transfer(codes)}))
    backward = blocks.select("c", "head", "matrix").repartition("c").sortWithinPartitions("c", F.desc("head"))
    behind = settle(backward.mapInArrow(_behind, "head long, after array<long>, last boolean"))
    known = settle(_mapped(blocks.drop("matrix").join(behind.hint("merge"), "head"), "exits array<long>", _exits))
    forward = known.select("c", "head", "exits").repartition("c").sortWithinPartitions("c", "head")
    entered = settle(forward.mapInArrow(_entered, "head long, state int"))
    return settle(_mapped(known.drop("exits").join(entered.hint("merge"), "head"), "edits string", _block_edits))


_KINDS = {te.BLANK: "blank", te.DUPLICATE: "duplicate", te.TRUNCATED: "truncated"}


def _streamed(batches: Iterator[pa.RecordBatch], new, turn, edit, end) -> Iterator[list]:
    """Walk sorted rows (c, kind, t, codes, edits, state, role, text): kind 0 opens a conversation, 1 a block, 2 is a turn.

    Calls ``new(c)``, ``turn(t, role, text, fault)`` for every turn and ``edit(letter, role, text)`` for every edit; yields what ``end()`` gives.
    """
    codes = edits = ""
    at = n = state = 0
    is_open = False

    def put_all():
        nonlocal at, state
        while at < len(edits) and edits[at] == te.INSERT:
            edit(te.INSERT, te.PUT[state], "")
            state = te.NEXT[state]
            at += 1

    for batch in batches:
        done = []
        for c, kind, t, b_codes, b_edits, b_state, role, text in zip(*[column.to_pylist() for column in batch.columns]):
            if kind == 0:
                if is_open:
                    put_all()
                    done.append(end())
                new(c)
                codes = edits = ""
                at, is_open = 0, True
            elif kind == 1:
                put_all()
                codes, edits, at, n, state = b_codes, b_edits, 0, 0, b_state
            else:
                put_all()
                fault, cls = divmod(ord(codes[n]) - 65, 4)
                turn(t, role, text, fault)
                letter = edits[at]
                if letter == te.REROLE:
                    role = te.PUT[state]
                edit(letter, role, text)
                if letter == te.KEEP:
                    state = te.KEPT[state][cls]
                elif letter == te.REROLE:
                    state = te.NEXT[state]
                at, n = at + 1, n + 1
        yield done
    if is_open:
        put_all()
        yield [end()]


class _Report:
    """One conversation's figures, gathered turn by turn; nothing of a turn is kept but its role's initial."""

    def new(self, c):
        self.c, self.faults, self.illegal, self.cost, self.audit = c, [0] * 4, 0, 0, []
        self.low = self.high = self.initial = None
        self.distinct, self.digest, self.any = 0, sha256(), False

    def turn(self, t, role, text, fault):
        if t is not None:  # turns ascend
            self.distinct += t != self.high
            self.low, self.high = t if self.low is None else self.low, t
        self.faults[fault] += 1
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial, self.fault = initial, fault

    def edit(self, letter, role, text):
        self.audit.append(letter)
        if letter == te.DELETE:
            self.cost += te.COST_DELETE
            return
        if letter == te.INSERT:
            self.cost += te.COST_INSERT
        else:
            self.cost += te.COST_REROLE * (letter == te.REROLE) + te.COST_TRUNCATED * (self.fault == te.TRUNCATED)
        self.digest.update((("\n" if self.any else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.any = True

    def end(self):
        gaps = self.high - self.low + 1 - self.distinct if self.distinct else 0
        return (self.c, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


REPORT = [("conv_id", "long"), ("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("cost", "long"),
          ("audit", "string"), ("repaired_sha256", "string")]


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = _Report()
    for done in _streamed(batches, held.new, held.turn, held.edit, held.end):
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], _ARROW[kind]) for i, (_, kind) in enumerate(REPORT)], names=[n for n, _ in REPORT])


OUTPUT = [("conv_id", "long"), ("step", "long"), ("edit", "string"), ("fault", "string"), ("turn", "long"), ("role", "string"), ("text", "string")]


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, step, fault, number, out = None, 0, None, None, []

    def new(c):
        nonlocal conv, step
        conv, step = c, 0

    def turn(t, role, text, found):
        nonlocal fault, number
        fault, number = _KINDS.get(found), t

    def edit(letter, role, text):
        nonlocal step
        put = letter == te.INSERT
        out.append((conv, step, letter, None if put else fault, None if put else number, role, text))
        step += 1

    for _ in _streamed(batches, new, turn, edit, lambda: None):
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], _ARROW[kind]) for i, (_, kind) in enumerate(OUTPUT)], names=[n for n, _ in OUTPUT])
        out.clear()


def _in_order(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, block_bits: int, conversations: DataFrame | None) -> DataFrame:
    """Turns behind the blocks that hold their edits, behind their conversation's first row."""
    turns = _classified(df, conv_col, turn_col, role_col, text_col)
    blocks = edited_blocks(_faulty(turns), block_bits)
    null = lambda kind: F.lit(None).cast(kind)
    ids = turns.select("c")
    if conversations is not None:
        ids = ids.unionByName(conversations.select(F.col(quoted(conv_col)).cast("long").alias("c")))
    opened = ids.distinct().select(
        "c", F.lit(0).alias("kind"), null("long").alias("t"), null("long").alias("same"), null("long").alias("row"),
        null("string").alias("codes"), null("string").alias("edits"), null("int").alias("state"), null("string").alias("role"), null("string").alias("text"))
    headed = blocks.select("c", F.lit(1).alias("kind"), "t", "same", "row", "codes", "edits", "state", null("string").alias("role"), null("string").alias("text"))
    said = turns.select("c", F.lit(2).alias("kind"), "t", "same", "row", null("string").alias("codes"), null("string").alias("edits"), null("int").alias("state"), "role", "text")
    all_rows = opened.unionByName(headed).unionByName(said).repartition("c").sortWithinPartitions("c", F.col("kind") > 0, "t", "same", "row", "kind")
    return all_rows.select("c", "kind", "t", "codes", "edits", "state", "role", "text")


def repaired_turns(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                   block_bits: int = BLOCK_BITS) -> DataFrame:
    """``conv_id, step, edit, fault, turn, role, text``: the cheapest edits of every conversation of ``df``, one a row, ``step`` from 0.

    A conversation's turns are taken by turn (null first), then by a hash of role and text, then by their place in the input. A turn's fault is the
    first of blank (no character but ASCII white space), duplicate (role and text of an earlier turn), truncated (the last shown
    character is none of ``.!?``). ``K`` keeps a turn as it is, ``R`` gives it the role user or assistant (cost 1), ``D`` deletes it (2), which blank
    and duplicate ones need, ``I`` puts in an empty user or assistant turn (5); a truncated turn not deleted costs 5. The edited
    roles' initials are an optional s, then pairs of u and a, or none; of the cheapest edits these have the ASCII-least letters.
    Rows ``D`` have the turn as it was; ``K``, ``R`` and ``I`` are the repaired conversation.

    Null roles and texts are one space, null conversations are one, an empty table gives no rows. A conversation of any length is dealt with
    in blocks of ``2^block_bits`` turns; one task then passes its turns on in order, holding one Arrow batch.
    """
    ordered = _in_order(df, conv_col, turn_col, role_col, text_col, block_bits, None)
    return ordered.mapInArrow(_edits, ", ".join(f"{n} {t}" for n, t in OUTPUT))


def repair_report(df: DataFrame, conversations: DataFrame | None = None, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", block_bits: int = BLOCK_BITS) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``: what ``repaired_turns`` finds and does, one row a conversation.

    ``gaps`` are the numbers missing between the least and greatest turn, ``illegal`` the neighbours whose initials are not su, ua or au;
    both and the three faults are counted before the edits. ``audit`` has the edits' letters, ``repaired_sha256`` the digest of the repaired
    ``role:text`` lines. With ``conversations``, there is a row for each of its ids as well, with zeros, no edits and the digest of
    nothing for those without turns.
    """
    ordered = _in_order(df, conv_col, turn_col, role_col, text_col, block_bits, conversations)
    return ordered.mapInArrow(_reports, ", ".join(f"{n} {t}" for n, t in REPORT))
