"""Conversation structure repair (operator 13): survivor-coalescence Viterbi.

The rows of a conversation are read in turn order through an automaton of the
wanted role pattern `(s?(ua)+)?` (states: nothing yet, after system, after user,
after assistant). Each row is kept, given the role that the state asks for, or
deleted; empty turns may be inserted. One survivor per state stays: the cheapest
edits so far, ties by the ASCII-least string of edits (none where another state is
so much cheaper that the difference can't be made good). Survivors are leaves of a
tree of backpointers with reference counts: a survivor that loses frees its branch
up to the last shared node, and as soon as all survivors share an ancestor the
edits down to it are emitted and forgotten. Ties compare the complete unresolved
suffixes of both survivors, from their last common ancestor on.

Conversations of any length run in parallel: rows get dense positions by (conversation,
turn, role, text hash), and blocks of `BLOCK` positions are solved for each
state that the block may be entered in: cost and place in the order of edits for
each pair of entry and exit. Pieces of one conversation are then the steps of the
same Viterbi, `FAN` at a time, level by level (few rows); the way back names each
block's entry and exit, and the blocks emit edits and repaired lines. Only the
digest of a whole conversation is made in one task, streaming block by block, since
SHA-256 is a chain.

Every row ends its label with its own edit (inserts stand before it), so of two
different strings over the same rows none is a prefix of the other, and the order
of two survivors is settled at their first different label, in a block or beyond.
Inserts before a deletion are never the least string and are left out.

Defined cases: a null conversation id is a conversation of its own; null turns
come first; null roles and texts count as one space; rows of equal turn are
ordered by role and a hash of the text; rows that are alike in all four columns
are duplicates after the first; texts are compared by two 64-bit hashes and their
length; a text of any length is read whole; gaps beyond a long are given as the
largest long; an empty table gives an empty result; only the four named columns
are read, so any other column may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrant.llm.common import python_ready, shuffle_partitions, written
from quadrant.operators.positions import dense_position

#: Rows of a block, and pieces of a conversation that one group combines (powers of two).
BLOCK, FAN = 512, 4096
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
BLANK = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: State after the inserts that end a conversation in each state, and how many.
TAIL = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: DETOUR[a][b]: what going on from state b instead of a costs more at most. A survivor
#: that costs more than another and its detour can't be part of the best edits.
DETOUR = {
    NOTHING: {SYSTEM: 12, USER: 7, ASSISTANT: 2},
    SYSTEM: {NOTHING: 0, USER: 5, ASSISTANT: 0},
    USER: {NOTHING: 5, SYSTEM: 5, ASSISTANT: 5},
    ASSISTANT: {NOTHING: 0, SYSTEM: 10, USER: 5},
}
TOP = (1 << 63) - 1


class Node:
    """A label of a survivor's path; `uses` counts its children and survivors."""

    __slots__ = ("parent", "label", "uses")

    def __init__(self, parent: Node | None, label):
        self.parent, self.label, self.uses = parent, label, 0
        if parent is not None:
            parent.uses += 1


class Survivors:
    """Cheapest paths to each state, as leaves of one tree of backpointers."""

    def __init__(self, entry: int):
        self.root = Node(None, None)
        self.best: dict[int, tuple[int, Node]] = {entry: (0, self.root)}
        self.root.uses = 1
        self.emitted: list = []

    @staticmethod
    def before(a: Node, x, b: Node, y) -> bool:
        """Whether path a + [x] comes before path b + [y]: the complete unresolved
        suffixes are walked up to the last common ancestor."""
        while a is not b:
            x, y, a, b = a.label, b.label, a.parent, b.parent
        return x < y

    def step(self, moves: dict[int, list[tuple[int, int, object]]]) -> None:
        """moves: of each state, (next state, cost, label); labels of the moves from
        one state sort as their edits do."""
        found: dict[int, tuple[int, Node, object]] = {}
        for state, (cost, node) in self.best.items():
            for to, more, label in moves[state]:
                now = found.get(to)
                if now is None or cost + more < now[0] or (cost + more == now[0] and self.before(node, label, now[1], now[2])):
                    found[to] = (cost + more, node, label)
        old = [node for _, node in self.best.values()]
        self.best = {}
        for to, (cost, node, label) in found.items():
            if any(other != to and cost > least + DETOUR[to][other] for other, (least, _, _) in found.items()):
                continue
            leaf = Node(node, label)
            leaf.uses = 1
            self.best[to] = (cost, leaf)
        for node in old:
            self.release(node)
        self.settle()

    @staticmethod
    def release(node: Node | None) -> None:
        while node is not None:
            node.uses -= 1
            if node.uses or node.parent is None:
                return
            node = node.parent

    def settle(self) -> None:
        """Emit the labels above the last ancestor of all survivors."""
        if len(self.best) == 1:
            (_, node), = self.best.values()
            path = []
            while node is not self.root:
                path.append(node)
                node = node.parent
            for node in reversed(path):
                self.emitted.append(node.label)
            if path:
                self.root = path[0]
                self.root.parent = None
            return
        # a chain below the root that all survivors share: walk up from one leaf and
        # cut below the highest node from which on nobody else hangs
        tip = next(iter(self.best.values()))[1]
        path = []
        while tip is not self.root:
            path.append(tip)
            tip = tip.parent
        while path and self.root.uses == 1:
            child = path.pop()
            self.emitted.append(child.label)
            child.parent = None
            self.root = child

    def suffix(self, node: Node) -> list:
        out = []
        while node is not self.root:
            out.append(node.label)
            node = node.parent
        return out[::-1]

    def order(self) -> dict[int, int]:
        """Place of each state's path among those of the others."""
        ranked = sorted(self.best, key=lambda s: self.suffix(self.best[s][1]))
        return {s: i for i, s in enumerate(ranked)}

    def path(self, state: int) -> list:
        return self.emitted + self.suffix(self.best[state][1])


def _place(state: int, initial: str) -> int | None:
    """The state after a turn of this initial, None if the pattern has no such turn here."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


def _moves(code: str) -> dict[int, list[tuple[int, int, str]]]:
    """Of each state, the ways to go on with a row: code x (must go), or the initial
    of its role (o: another), in upper case if its text is cut off."""
    out = {}
    for state in STATES:
        ways = [(state, DELETE, "D")]
        if code != "x":
            more = CUT if code.isupper() else 0
            for inserts in (0, 1):
                at = state if not inserts else ASSISTANT if state == USER else USER
                lead, paid = "I" * inserts, INSERT * inserts + more
                if (to := _place(at, code.lower())) is not None:
                    ways.append((to, paid + KEEP, lead + "K"))
                ways.append((ASSISTANT if at == USER else USER, paid + REROLE, lead + "R"))
        out[state] = ways
    return out


MOVES = {code: _moves(code) for code in "xsuaoSUAO"}


def solve(codes: str, entry: int) -> Survivors:
    found = Survivors(entry)
    for code in codes:
        found.step(MOVES[code])
    return found


def summary_of(survivors: list[Survivors]) -> tuple[list[int], list[int]]:
    """Cost (-1: no way, or none that can be the best) and order of each (entry, exit)."""
    cost, order = [-1] * 16, [0] * 16
    for entry, found in zip(STATES, survivors, strict=True):
        ranks = found.order()
        for exit_, (c, _) in found.best.items():
            cost[4 * entry + exit_], order[4 * entry + exit_] = c, ranks[exit_]
    return cost, order


@lru_cache(maxsize=20_000)
def summary(codes: str) -> tuple[list[int], list[int]]:
    return summary_of([solve(codes, entry) for entry in STATES])


@lru_cache(maxsize=20_000)
def edits(codes: str, entry: int, exit_: int) -> tuple[str, ...]:
    """Label of each row on the best way from entry to exit."""
    return tuple(solve(codes, entry).path(exit_))


def piece_moves(cost: list[int], order: list[int]) -> dict[int, list[tuple[int, int, tuple[int, int]]]]:
    """A solved piece as one step; its labels sort by the order of its edits."""
    return {s: [(t, cost[4 * s + t], (order[4 * s + t], t)) for t in STATES if cost[4 * s + t] >= 0] for s in STATES}


def combined(pieces: list[tuple[list[int], list[int]]], entry: int) -> Survivors:
    found = Survivors(entry)
    for cost, order in pieces:
        found.step(piece_moves(cost, order))
    return found


def ending(cost: list[int], order: list[int]) -> tuple[int, int]:
    """(cost, state) in which a whole conversation ends before its last inserts."""
    total, _, state = min((cost[s] + INSERT * TAIL[s], order[s], s) for s in STATES if cost[s] >= 0)
    return total, state


def lines_of(labels: tuple[str, ...] | list[str], entry: int, roles: list[str], texts: list[str]) -> Iterator[str]:
    """Repaired `role:text` lines of rows with these labels."""
    state = entry
    for label, role, text in zip(labels, roles, texts, strict=True):
        for edit in label:
            if edit == "D":
                continue
            wanted = "assistant" if state == USER else "user"
            if edit == "I":
                yield f"{wanted}:"
            elif edit == "R":
                yield f"{wanted}:{text}"
            else:
                yield f"{role}:{text}"
            state = SYSTEM if edit == "K" and role[0] == "s" else ASSISTANT if state == USER else USER


def tail_lines(state: int) -> list[str]:
    return {SYSTEM: ["user:", "assistant:"], USER: ["assistant:"]}.get(state, [])


# ------------------------------------------------------------------ Spark jobs

PIECE = ("ck string, blk long, codes string, cost array<long>, ranks array<int>, n long, blank long, duplicate long, truncated long, "
         "illegal long, first string, last string, low long, high long, turns long")
LEGAL = {"su", "ua", "au"}


def prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """ck (non-null key of the conversation), turn, role, text, and what one row
    tells by itself: initial, hash of the text, blank, cut."""
    ck = F.coalesce(F.concat(F.lit("="), F.col(f"`{conv}`").cast("string")), F.lit(""))
    out = rows.select(ck.alias("ck"), F.col(f"`{turn}`").cast("long").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
                      F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"))
    bare = F.btrim(F.col("text"), F.lit(BLANK))
    return out.select("*", F.substring("role", 1, 1).alias("initial"), F.xxhash64("text").alias("h"), F.xxhash64(F.lit(1), "text").alias("h2"),
                      F.length("text").alias("size"), (F.length(bare) == 0).alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))


def _codes(initial: Column, blank: Column, duplicate: Column, cut: Column) -> Column:
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(blank | duplicate, "x").when(cut, F.upper(known)).otherwise(known)


def _level_0(table: pa.Table) -> pa.Table:
    """Pieces of a block: its rows (pos, ck, turn, initial, code, blank, duplicate), by conversation."""
    table = table.sort_by("pos")
    cols = {c: table.column(c).to_pylist() for c in ("blk", "ck", "turn", "initial", "code", "blank", "duplicate")}
    cks, out, a = cols["ck"], [], 0
    for b in range(1, len(cks) + 1):
        if b < len(cks) and cks[b] == cks[a]:
            continue
        codes, initials = "".join(cols["code"][a:b]), cols["initial"][a:b]
        turns = [t for t in cols["turn"][a:b] if t is not None]
        cost, ranks = summary(codes)
        blank, duplicate = sum(cols["blank"][a:b]), sum(cols["duplicate"][a:b])
        out.append((cks[a], cols["blk"][a], codes, cost, ranks, b - a, blank, duplicate, sum(c.isupper() for c in codes),
                    sum(x + y not in LEGAL for x, y in zip(initials, initials[1:], strict=False)), initials[0], initials[-1],
                    min(turns, default=None), max(turns, default=None), len(set(turns))))
        a = b
    return _table(out)


def _table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3]
    names = [x.split()[0] for x in PIECE.split(", ")]
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def _combine(table: pa.Table) -> pa.Table:
    """One piece of the pieces (of one conversation) that share a group of blocks."""
    rows = table.sort_by("blk").to_pylist()
    cost, ranks = summary_of([combined([(r["cost"], r["ranks"]) for r in rows], e) for e in STATES])
    illegal = sum(r["illegal"] for r in rows) + sum(x["last"] + y["first"] not in LEGAL for x, y in zip(rows, rows[1:], strict=False))
    dated = [r for r in rows if r["low"] is not None]
    turns = sum(r["turns"] for r in rows) - sum(x["high"] == y["low"] for x, y in zip(dated, dated[1:], strict=False))
    total = [sum(r[c] for r in rows) for c in ("n", "blank", "duplicate", "truncated")]
    return _table([(rows[0]["ck"], rows[0]["up"], "", cost, ranks, *total, illegal, rows[0]["first"], rows[-1]["last"],
                    min((r["low"] for r in dated), default=None), max((r["high"] for r in dated), default=None), turns)])


def _way_back(table: pa.Table) -> pa.Table:
    """Entry and exit of each piece of a group whose own entry and exit are chosen."""
    rows = table.sort_by("blk").to_pylist()
    found = combined([(r["cost"], r["ranks"]) for r in rows], rows[0]["entry"])
    at, out = rows[0]["entry"], []
    for r, (_, to) in zip(rows, found.path(rows[0]["exit"]), strict=True):
        out.append((r["ck"], r["blk"], at, to))
        at = to
    return pa.table({"ck": pa.array([r[0] for r in out], pa.string()), "blk": pa.array([r[1] for r in out], pa.int64()),
                     "entry": pa.array([r[2] for r in out], pa.int32()), "exit": pa.array([r[3] for r in out], pa.int32())})


def _chosen(pieces: DataFrame) -> DataFrame:
    """Whole conversations (one piece each), with entry, exit and total cost."""
    options = F.array_min(F.array(*[F.when(F.col("cost")[s] >= 0, F.struct(
        (F.col("cost")[s] + INSERT * TAIL[s]).alias("total"), F.col("ranks")[s].alias("rank"), F.lit(s).alias("state"))) for s in STATES]))
    return pieces.withColumn("way", options).select("*", F.lit(NOTHING).alias("entry"), F.col("way.state").alias("exit"),
                                                    F.col("way.total").alias("total")).drop("way")


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations, blocks). conversations: ck, n, gaps, blank, duplicate, truncated,
    illegal, cost and `exit`, the state before the last inserts. blocks: ck, blk,
    labels (edits of its rows, in order) and lines (their repaired `role:text` lines,
    newline-joined; null if none is left); `digests` strings them together."""
    spark = rows.sparkSession
    python_ready(spark)
    ready = prepared(rows, conv, turn, role, text)
    keys = [F.col("ck"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h"), F.col("_mid")]
    # rows that are alike in all columns are told apart by any number, so that they can lie in several range partitions
    ordered = written(dense_position(ready.withColumn("_mid", F.monotonically_increasing_id()), keys, name="pos").drop("_mid")
                      .withColumn("blk", F.expr(f"pos div {BLOCK}")), "conversation-rows")
    slim = ordered.drop("text")
    firsts = slim.groupBy("ck", "role", "h", "h2", "size").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("is_first"))
    flagged = slim.join(firsts, "pos", "left").withColumn("duplicate", F.col("is_first").isNull() & ~F.col("blank"))
    flagged = flagged.select("pos", "blk", "ck", "turn", "initial", F.col("blank").cast("int").alias("blank"), F.col("duplicate").cast("int").alias("duplicate"),
                             _codes(F.col("initial"), F.col("blank"), F.col("duplicate"), F.col("cut")).alias("code"))
    levels = [written(flagged.groupBy("blk").applyInArrow(_level_0, PIECE), "conversation-pieces")]
    done = []
    while True:
        pieces = levels[-1]
        parts = written(pieces.groupBy("ck").count().filter("count > 1").select("ck"), "conversation-parts")
        done.append(_chosen(pieces.join(parts, "ck", "left_anti")))
        if parts.isEmpty():
            break
        levels[-1] = pieces.join(parts, "ck", "left_semi").withColumn("up", F.expr(f"blk div {FAN}"))
        levels.append(written(levels[-1].groupBy("ck", "up").applyInArrow(_combine, PIECE), "conversation-pieces"))
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    whole = written(whole, "conversation-wholes")
    ways = None  # of the pieces of the level at hand
    for level in range(len(levels) - 1, -1, -1):
        down = done[level].select("ck", "blk", "entry", "exit")
        if ways is not None:
            groups = ways.select("ck", F.col("blk").alias("up"), "entry", "exit")
            inner = levels[level].join(groups, ["ck", "up"])
            down = down.unionByName(inner.groupBy("ck", "up").applyInArrow(_way_back, "ck string, blk long, entry int, exit int"))
        ways = written(down, "conversation-ways")
    coded = done[0].select("ck", "blk", "codes")
    if len(levels) > 1:
        coded = coded.unionByName(levels[0].select("ck", "blk", "codes"))
    plan = coded.join(ways, ["ck", "blk"])
    blocks = (ordered.select("blk", "pos", "ck", "role", "text").groupBy("blk").cogroup(plan.groupBy("blk"))
                     .applyInArrow(_emit, "ck string, blk long, labels string, lines string"))
    top = F.col("high").cast("decimal(38,0)") - F.col("low") + 1 - F.col("turns")
    out = whole.select("ck", "n", F.when(top.isNull(), F.lit(0)).otherwise(F.least(top, F.lit(TOP)).cast("long")).alias("gaps"), "blank", "duplicate", "truncated",
                       "illegal", F.col("total").alias("cost"), "exit")
    return out, blocks


def _emit(rows: pa.Table, plan: pa.Table) -> pa.Table:
    """Edits and repaired lines of each piece of a block."""
    rows = rows.sort_by("pos")
    ways = {r["ck"]: r for r in plan.to_pylist()}
    cks, roles, texts = (rows.column(c).to_pylist() for c in ("ck", "role", "text"))
    blk, out, a = rows.column("blk")[0].as_py(), [], 0
    for b in range(1, len(cks) + 1):
        if b < len(cks) and cks[b] == cks[a]:
            continue
        way = ways[cks[a]]
        labels = edits(way["codes"], way["entry"], way["exit"])
        lines = list(lines_of(labels, way["entry"], roles[a:b], texts[a:b]))
        out.append((cks[a], blk, "".join(labels), "\n".join(lines) if lines else None))
        a = b
    return pa.table({"ck": pa.array([r[0] for r in out], pa.string()), "blk": pa.array([r[1] for r in out], pa.int64()),
                     "labels": pa.array([r[2] for r in out], pa.string()), "lines": pa.array([r[3] for r in out], pa.string())})


def digests(blocks: DataFrame, conversations: DataFrame) -> DataFrame:
    """conversations with audit (all edits) and repaired_sha256: blocks are read in
    order, one at a time."""
    ends = conversations.select("ck", F.lit(TOP).alias("blk"), F.lit(None).cast("string").alias("labels"), F.lit(None).cast("string").alias("lines"), "exit")
    rows = blocks.withColumn("exit", F.lit(None).cast("int")).unionByName(ends)
    rows = rows.repartition(shuffle_partitions(blocks.sparkSession), "ck").sortWithinPartitions("ck", "blk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, audit, some = hashlib.sha256(), [], False

        def add(lines: str) -> None:
            nonlocal some
            digest.update((("\n" if some else "") + lines).encode("utf-8", "surrogatepass"))
            some = True
        for batch in batches:
            cks, audits, sums = [], [], []
            for ck, labels, lines, exit_ in zip(*(batch.column(c).to_pylist() for c in ("ck", "labels", "lines", "exit")), strict=True):
                if exit_ is None:  # a block
                    audit.append(labels)
                    if lines is not None:
                        add(lines)
                    continue
                for line in tail_lines(exit_):
                    add(line)
                cks.append(ck)
                audits.append("".join(audit) + "I" * TAIL[exit_])
                sums.append(digest.hexdigest())
                digest, audit, some = hashlib.sha256(), [], False
            yield pa.RecordBatch.from_arrays([pa.array(cks, pa.string()), pa.array(audits, pa.string()), pa.array(sums, pa.string())], ["ck", "audit", "repaired_sha256"])
    found = rows.select("ck", "labels", "lines", "exit").mapInArrow(run, "ck string, audit string, repaired_sha256 string")
    return conversations.join(found, "ck")


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The four columns after a fixed damage by crc32 of `conv:turn` modulo 20: 0 drops
    the row, 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 makes it the user's. Nulls count as one space there."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(f"`{conv}`").cast("string"), space), F.lit(":"), F.coalesce(F.col(f"`{turn}`").cast("string"), space))
    kind = F.crc32(key) % 20
    words, who = F.coalesce(F.col(f"`{text}`"), space), F.coalesce(F.col(f"`{role}`"), space)
    out = rows.select(F.col(f"`{conv}`").alias(conv), F.col(f"`{turn}`").alias(turn), F.when(kind == 4, "user").otherwise(who).alias(role),
                      F.when(kind == 1, "").when(kind == 2, F.translate(words, ".!?", "")).otherwise(words).alias(text), kind.alias("_kind"))
    return out.filter("_kind <> 0").withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_kind", "_copy")
