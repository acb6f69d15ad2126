"""Conversation structure repair by a checkpointed dynamic program.

A conversation's rows in order are edited at least cost until the first
letters of the roles read ``(s?(ua)+)?``.  The costs to the end, one for each
state of that pattern, follow backwards from row to row.  They are stored only
at checkpoints; walking forward, each block's costs are computed anew from the
checkpoint at its end, and of the edits on a cheapest path the one with the
least letter is taken.  As the edits so far and the state decide what an edit
does, this gives the least audit of all cheapest ones.

A conversation may hold any share of all rows: rows are numbered in one total
order and cut into blocks of ``BLOCK``.  A block's part of a conversation that
goes on in other blocks becomes a matrix of least costs from state to state.
Products of these, by doubling, give the costs at the block borders (the outer
checkpoints), products of the state maps the states there; then every block is
edited for itself.  Inside a block checkpoints lie a square root apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credscope.operators.ranks import ranked

from .common import Workspace, table

BLOCK = 8192
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# States: nothing yet, after s, after u, after a.  Every state admits one of
# user and assistant; an s is taken at the beginning only.
_NEXT = (2, 2, 3, 2)
_ROLE = ("user", "user", "assistant", "user")
_TAKE = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_FAR = 1 << 40
#: Costs behind the last row: complete in the first and the last state.
_END = (0, 2 * INSERT, INSERT, 0)
_LEGAL = ("su", "ua", "au")

_SPACE = r"\x20\x09-\x0D"


def rows_in_order(ws: Workspace, rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, faults and place in the order.

    conv, conv_id, turn, role, sha (of the text), copies, blank, duplicate,
    truncated, live (the first copy may stay), g (position over all
    conversations: by conversation, turn with nulls first, role, text hash).
    """
    said = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _or_space("role").alias("role"),
        F.sha2(_or_space("text"), 256).alias("sha"),
        (~F.rlike(_or_space("text"), F.lit(f"[^{_SPACE}]"))).alias("empty"),
        (~F.rlike(_or_space("text"), F.lit(rf"[.!?][{_SPACE}]*\z"))).alias("cut"),
    )
    units = ws.store(said.groupBy("conv", "turn", "role", "sha").agg(F.first("conv_id").alias("conv_id"), F.first("empty").alias("empty"), F.first("cut").alias("cut"), F.count("*").alias("copies")), "rows")
    key = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0).cast("long")))
    # of the same words said at several turns, those of the first turn are no repeats
    said_at = units.where("NOT empty").groupBy("conv", "role", "sha").agg(F.min(key).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    units = units.join(said_at, ["conv", "role", "sha"], "left").withColumn("live", ~F.col("empty") & (F.col("first").isNull() | (F.col("first") == key)))
    units = units.select(
        "conv", "conv_id", "turn", "role", "sha", "copies", "live",
        F.when(F.col("empty"), F.col("copies")).otherwise(0).alias("blank"),
        F.when(F.col("empty"), 0).otherwise(F.col("copies") - F.col("live").cast("long")).alias("duplicate"),
        (F.col("live") & F.col("cut")).cast("long").alias("truncated"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("sha")]
    return ranked(units, order, "g", lambda df: ws.store(df, "order"), first=0)


def _or_space(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


# ------------------------------------------------------------- one block

def _before(unit: tuple, after: tuple) -> tuple:
    """Costs before a row from those behind it, one for each state."""
    live, first, truncated, dropped = unit
    costs = [c + DELETE * dropped for c in after]
    if live:
        worse = TRUNCATED * truncated
        stay = [costs[t[first]] + worse if first in t else _FAR for t in _TAKE]
        costs = [min(DELETE + c, s, REROLE + worse + costs[n]) for c, s, n in zip(costs, stay, _NEXT)]
    return _with_inserts(costs)


def _with_inserts(costs: list) -> tuple:
    user, assistant = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + user), min(costs[1], INSERT + user), user, assistant


def _costs(units: list[tuple], end: tuple) -> tuple:
    for u in reversed(units):
        end = _before(u, end)
    return end


def _inserts(state: int, costs: tuple) -> tuple[list[str], int]:
    """Rows to insert where no row is left to edit (``costs``: behind it)."""
    new = []
    while costs[state] and costs[state] == INSERT + costs[_NEXT[state]]:
        new.append(_ROLE[state])
        state = _NEXT[state]
    return new, state


def _walk(units: list[tuple], state: int, end: tuple) -> Iterator[tuple[list[str], str, str | None, int]]:
    """For each row: roles inserted before it, edit, role, state behind it."""
    gap = isqrt(len(units)) + 1
    marks, costs = {}, end
    for i in range(len(units) - 1, -1, -1):
        if (i + 1) % gap == 0 or i == len(units) - 1:
            marks[i // gap] = costs
        costs = _before(units[i], costs)
    for block in range(0, (len(units) + gap - 1) // gap):
        part = units[block * gap : (block + 1) * gap]
        after = [marks[block]]
        for u in reversed(part):
            after.append(_before(u, after[-1]))
        after.reverse()
        for i, (live, first, truncated, dropped) in enumerate(part):
            now, behind = after[i], [c + DELETE * dropped for c in after[i + 1]]
            inserted, edit, role, worse = [], "", None, TRUNCATED * truncated
            while live:
                left = now[state]
                if left == DELETE + behind[state]:
                    edit = "D"
                    break
                if left == INSERT + now[_NEXT[state]]:
                    inserted.append(_ROLE[state])
                    state = _NEXT[state]
                    continue
                if first in _TAKE[state] and left == worse + behind[_TAKE[state][first]]:
                    edit, state = "K", _TAKE[state][first]
                else:
                    edit, role, state = "R", _ROLE[state], _NEXT[state]
                break
            yield inserted, edit, role, state


def _runs(rows: pa.Table) -> Iterator[tuple[str, list[dict], list[tuple]]]:
    """Conversation, rows and what the program needs of them, by conversation."""
    held = rows.sort_by("g").to_pylist()
    at = 0
    while at < len(held):
        to = at
        while to < len(held) and held[to]["conv"] == held[at]["conv"]:
            to += 1
        part = held[at:to]
        yield part[0]["conv"], part, [(r["live"], r["role"][:1], r["truncated"], r["copies"] - r["live"]) for r in part]
        at = to


_BORDER = "blk long, conv string, opens boolean, closes boolean, cost array<long>, first_role string, last_role string, last_turn long"


def _borders(rows: pa.Table) -> pa.Table:
    """The conversations at a block's two borders, with their cost matrices."""
    runs = list(_runs(rows))
    blk, out = rows.column("blk")[0].as_py(), []
    for i, (conv, part, units) in enumerate(runs):
        if i in (0, len(runs) - 1):
            columns = [_costs(units, tuple(0 if t == state else _FAR for t in range(4))) for state in range(4)]
            cost = [min(columns[t][s], _FAR) for s in range(4) for t in range(4)]
            out.append((blk, conv, i == 0, i == len(runs) - 1, cost, part[0]["role"][:1], part[-1]["role"][:1], part[-1]["turn"]))
    return _table(out, _BORDER)


def _maps(rows: pa.Table, ends: pa.Table) -> pa.Table:
    """State behind a conversation's part in this block, from each state before it."""
    known, out = {e["conv"]: e for e in ends.to_pylist()}, []
    if len(rows):
        for conv, _, units in _runs(rows):
            if conv in known:
                to = [list(_walk(units, state, tuple(known[conv]["after"])))[-1][3] for state in range(4)]
                out.append((known[conv]["blk"], conv, to))
    return _table(out, "blk long, conv string, to array<long>")


_EDITS = "g long, conv string, before array<string>, edit string, role_to string, behind array<string>, illegal long, fresh long, cost long"


def _edits(rows: pa.Table, ends: pa.Table) -> pa.Table:
    """Every row's edit, and what its place among the others adds to the counts."""
    known, out = {e["conv"]: e for e in ends.to_pylist()}, []
    for conv, part, units in _runs(rows) if len(rows) else ():
        here = known.get(conv) or {"after": _END, "state": 0, "last": True, "prev_role": None, "prev_turn": None}
        end, role, turn = tuple(here["after"]), here["prev_role"], here["prev_turn"]
        for i, (r, (inserted, edit, role_to, state)) in enumerate(zip(part, _walk(units, here["state"], end))):
            behind = _inserts(state, end)[0] if here["last"] and i == len(part) - 1 else []
            pair = role is not None and role + r["role"][:1] not in _LEGAL
            fresh = r["turn"] is not None and r["turn"] != turn
            dropped = r["copies"] - r["live"]
            cost = INSERT * (len(inserted) + len(behind)) + DELETE * (dropped + (edit == "D")) + REROLE * (edit == "R") + TRUNCATED * r["truncated"] * (edit in ("K", "R"))
            out.append((r["g"], conv, inserted, edit, role_to, behind, r["copies"] - 1 + pair, int(fresh), cost))
            role, turn = r["role"][:1], r["turn"]
    return _table(out, _EDITS)


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], _ARROW[kind]) for i, (name, kind) in enumerate(fields)})


# ------------------------------------------------------------- over blocks

def _product(a: Column, b: Column) -> Column:
    """Least costs over two parts in a row; matrices as arrays by rows."""
    cell = lambda s, t: F.least(F.lit(_FAR), *[a[4 * s + m] + b[4 * m + t] for m in range(4)])
    return F.array(*[cell(s, t) for s in range(4) for t in range(4)])


def _doubled(ws: Workspace, parts: DataFrame, col: str, chain: int, step: int, join) -> DataFrame:
    """blk, conv, ``col`` combined with all parts of the conversation behind
    (``step`` 1) or before it (-1), ``chain`` parts at most."""
    width = 1
    while width < chain:
        other = parts.select((F.col("blk") - step * width).alias("blk"), "conv", F.col(col).alias("other"))
        parts = parts.join(other, ["blk", "conv"], "left").select("blk", "conv", F.when(F.col("other").isNull(), F.col(col)).otherwise(join(F.col(col), F.col("other"))).alias(col))
        parts, width = ws.store(parts, "doubled"), width * 2
    return parts


def edits(ws: Workspace, units: DataFrame) -> DataFrame:
    """``_EDITS`` columns, one row for each row of ``rows_in_order``."""
    narrow = units.select(F.expr(f"g div {BLOCK}").alias("blk"), "g", "conv", "turn", "role", "copies", "live", "truncated")
    border = ws.store(narrow.groupBy("blk").applyInArrow(_borders, _BORDER), "borders")
    follows = border.where("closes").select("blk", "conv").join(border.where("opens").select((F.col("blk") - 1).alias("blk"), "conv"), ["blk", "conv"])
    goes_on = follows.withColumn("goes_on", F.lit(True))
    began = follows.select((F.col("blk") + 1).alias("blk"), "conv", F.lit(True).alias("began"))
    parts = border.join(goes_on, ["blk", "conv"], "left").join(began, ["blk", "conv"], "left").where("goes_on OR began")
    parts = ws.store(parts, "parts")
    chain = parts.groupBy("conv").count().agg(F.max("count")).first()[0] or 0

    costs = _doubled(ws, parts.select("blk", "conv", "cost"), "cost", chain, 1, _product)
    start = F.array(*[F.least(*[F.col("cost")[4 * s + t] + F.lit(_END[t]) for t in range(4)]) for s in range(4)])
    after = costs.select((F.col("blk") - 1).alias("blk"), "conv", start.alias("found"))
    end = F.lit(list(_END)).cast("array<long>")
    ends = ws.store(parts.join(after, ["blk", "conv"], "left").select("blk", "conv", F.coalesce("found", end).alias("after"), F.col("found").isNull().alias("last")), "ends")

    of_block = lambda frame, run, schema: narrow.groupBy("blk").cogroup(frame.groupBy("blk")).applyInArrow(run, schema)
    across = narrow.join(ends.select("blk", "conv"), ["blk", "conv"]).select(*narrow.columns)
    maps = ws.store(across.groupBy("blk").cogroup(ends.groupBy("blk")).applyInArrow(_maps, "blk long, conv string, to array<long>"), "maps")
    # the map of the parts before is applied first
    maps = _doubled(ws, maps, "to", chain, -1, lambda here, other: F.transform(other, lambda s: F.get(here, s.cast("int"))))
    state = maps.select((F.col("blk") + 1).alias("blk"), "conv", F.get("to", F.lit(0)).alias("state"))
    before = border.where("closes").select((F.col("blk") + 1).alias("blk"), "conv", F.col("last_role").alias("prev_role"), F.col("last_turn").alias("prev_turn"))
    ends = ends.join(state, ["blk", "conv"], "left").join(before, ["blk", "conv"], "left")
    return ws.store(of_block(ends.withColumn("state", F.coalesce("state", F.lit(0).cast("long"))), _edits, _EDITS), "edits")


class Repair:
    """Repair of a table of conversations (conv_id, turn, role, text).

    Rows of a conversation are taken by turn (nulls first), then role and the
    SHA-256 of the text; rows equal in all of these are neighbours.  Null roles
    and texts are one space, so a null text is blank.  Null is a conversation
    of its own.  Other columns are ignored; an empty table gives no rows.  A
    task holds ``BLOCK`` distinct rows at most, whatever a conversation's
    length, and no texts.
    """

    def __init__(self, rows: DataFrame):
        self.ws = Workspace(rows.sparkSession, "conversations")
        self.rows = rows
        self.units = rows_in_order(self.ws, rows)
        self.edits = edits(self.ws, self.units)

    def repaired(self) -> DataFrame:
        """conv, g, slot, role, text: the rows of the repaired conversations,
        in the order of g and slot."""
        new = lambda col, at: F.transform(F.col(col), lambda role, i: F.struct((i + at).cast("long").alias("slot"), role.alias("role"), F.lit("").alias("text")))
        inserted = self.edits.where("size(before) + size(behind) > 0").select("conv", "g", F.inline(F.concat(new("before", 0), new("behind", 200))))
        stay = self.edits.where("edit IN ('K', 'R')").select("g", "role_to")
        stay = self.units.join(stay, "g").select("conv", F.col("turn").alias("at"), F.col("role").alias("of"), "sha", "g", "role_to")
        said = self.rows.select(
            F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
            F.col("turn").cast("long").alias("turn"), _or_space("role").alias("role"), _or_space("text").alias("text"), F.sha2(_or_space("text"), 256).alias("sha"))
        same = ["conv", "sha"]
        kept = said.join(stay, same).where("turn <=> at AND role = of").dropDuplicates(["g"])
        return kept.select("conv", "g", F.lit(100).cast("long").alias("slot"), F.coalesce("role_to", "role").alias("role"), "text").unionByName(inserted)

    def conversations(self) -> DataFrame:
        """conv, gaps, blank, duplicate, truncated, illegal, cost, audit: one
        row for each conversation that has rows."""
        letters = F.concat(F.repeat(F.lit("I"), F.size("before")), "edit", F.repeat(F.lit("D"), (F.col("copies") - F.col("live").cast("long")).cast("int")), F.repeat(F.lit("I"), F.size("behind")))
        both = self.units.join(self.edits.drop("conv"), "g").withColumn("letters", letters)
        gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.sum("fresh"), F.lit(0).cast("long"))
        audit = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("g", "letters"))), lambda x: x["letters"]), "")
        return both.groupBy("conv").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], audit.alias("audit"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv, role, text by conversation and order -> conv, SHA-256 of ``role:text`` lines."""
    at, held = None, None
    for batch in batches:
        done = []
        for conv, role, text in zip(batch.column("conv"), batch.column("role"), batch.column("text")):
            conv = conv.as_py()
            if conv != at:
                if held is not None:
                    done.append((at, held.hexdigest()))
                at, held = conv, hashlib.sha256()
            else:
                held.update(b"\n")
            held.update(role.as_py().encode() + b":" + text.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.string())], names=["conv", "sha"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([held.hexdigest()])], names=["conv", "sha"])


def digests(repaired: DataFrame) -> DataFrame:
    """conv, sha: SHA-256 of the conversation's ``role:text``, joined by line
    feeds.  A digest is sequential by nature: the rows of a conversation pass
    through one task, one at a time."""
    dealt = repaired.repartition("conv").sortWithinPartitions("conv", "g", "slot").select("conv", "role", "text")
    return dealt.mapInArrow(_digests, "conv string, sha string")


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` (nulls: a space)."""
    fate = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate(_or_space("text"), ".!?", "")).otherwise(_or_space("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(_or_space("role"))
    hit = rows.select("conv_id", "turn", "role", "text", fate.alias("fate")).where("fate != 0")
    return hit.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1).cast("int")))).drop("col")


def query(spark, sf_dir):
    """One row for each conv_id of ``conversations``, null included."""
    rows = table(spark, sf_dir, "conversations")
    repair = Repair(damaged(rows))
    found = repair.conversations().join(digests(repair.repaired()), "conv", "left")
    every = rows.select("conv_id").distinct().withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(found, "conv", "left").select("conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
