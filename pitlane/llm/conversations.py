"""Conversation structure repair: square-root checkpointed dynamic programming.

A conversation is well formed if the initials of its roles spell ``(s?(ua)+)?``. Edits make it so:
Keep a row (0), Rerole it to user or assistant (1), Delete it (2), Insert an empty row of either
role (5); a blank row or a duplicate must be deleted, a truncated row that stays costs 5. Of the
cheapest sequences of edits the one whose initials are least in ASCII order is taken.

Before any row, what matters is one of four states (nothing yet, after the system's row, after a
user's, after an assistant's) and the four costs of finishing from there, which follow from the
costs behind the row. The costs are computed backward and kept only at about sqrt(n) checkpoints;
walking forward, each block's costs are computed again from its checkpoint, and at each row the
least letter is taken that the costs allow. A state and a letter determine the next state, so
that choice gives the least sequence.

Rows are dealt out in ranges of (conversation, turn), so a conversation of any length is spread
over partitions and none gathers in a task. Two light passes connect the parts of a conversation
that runs over partitions: first each part's least costs from state to state (4 x 4 numbers),
which give the costs at every partition's end; then, for these costs, the state in which a part is
left for each in which it is entered. Both pass two rows a partition through the driver. Equal
rows are counted before anything is sorted, so copies do not gather either: all but the first are
duplicates, and a run of deletions is one edit with its number of ``times``.

Defined results: a null role or text is one space, null turns come first, rows of the same turn
are ordered by role, the first 64 characters and the digest of the text; equal rows are
duplicates of each other; rows with a null conversation are one conversation. An empty table gives
no rows; other columns are not read. Only the hash of a repaired conversation is sequential
by definition: a conversation over several partitions is hashed by one task, in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.config import shared_dir
from pitlane.llm.common import bounded_batches, materialize, table

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
RE_COST, DEL_COST, INS_COST, CUT_COST = 1, 2, 5, 5
#: ASCII white space of the contract: \x20 and \x09 to \x0D.
WHITE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

Costs = tuple[int, int, int, int]
# States: nothing yet, after s, after u, after a. What a new row must be, from each state.
_NEXT = (2, 2, 3, 2)
_ROLE = {2: "user", 3: "assistant"}
#: Where keeping a row with this initial leads, by state; none is no way.
_KEEPS = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "": (None,) * 4}
_FAR = 1 << 60
#: Costs after the last row: nothing, or after an assistant's, is well formed; else rows are inserted.
END: Costs = (0, 2 * INS_COST, INS_COST, 0)

#: A row for the costs: (initial, or None if it must go; whether truncated; deletions that follow it).
Row = tuple[str | None, bool, int]


def before(row: Row, after: Costs) -> Costs:
    """Costs of finishing from each state before a row, out of those behind it."""
    initial, cut, extra = row
    w = list(after)
    if initial is not None:
        stay = CUT_COST if cut else 0
        keeps = _KEEPS[initial]
        for s in range(4):
            best = min(DEL_COST + after[s], RE_COST + stay + after[_NEXT[s]])
            t = keeps[s]
            w[s] = best if t is None else min(best, stay + after[t])
    extra *= DEL_COST
    u, a = min(w[2], INS_COST + w[3]), min(w[3], INS_COST + w[2])
    return min(w[0], INS_COST + u) + extra, min(w[1], INS_COST + u) + extra, u + extra, a + extra


def checkpoints(rows: list[Row], after: Costs) -> tuple[int, list[Costs]]:
    """The block length, about sqrt(n), and the costs before each block and behind the last."""
    block = max(1, isqrt(len(rows)))
    kept = [after]
    for at in range(len(rows) - 1, -1, -1):
        after = before(rows[at], after)
        if at % block == 0:
            kept.append(after)
    return block, kept[::-1]


def walk(rows: list[Row], after: Costs, state: int, last: bool = True) -> Iterator[tuple[str, int, int]]:
    """(letter, row, state behind it) of the least cheapest edits from a state; with ``last`` also
    the rows inserted at the end. An inserted row has the number of the row it stands before."""
    block, kept = checkpoints(rows, after)
    for k in range(len(kept) - 1):
        part = rows[k * block : (k + 1) * block]
        costs = [kept[k + 1]]
        for row in reversed(part):
            costs.append(before(row, costs[-1]))
        costs.reverse()
        for at, (initial, cut, extra) in enumerate(part):
            behind = costs[at + 1]
            rest = costs[at][state] - extra * DEL_COST  # what this row and all behind it may cost
            if initial is None:
                continue
            while True:
                stay = CUT_COST if cut else 0
                if rest == DEL_COST + behind[state]:
                    letter, to = DELETE, state
                elif rest == INS_COST + costs[at][_NEXT[state]] - extra * DEL_COST:
                    letter, to = INSERT, _NEXT[state]
                    rest -= INS_COST
                elif (to := _KEEPS[initial][state]) is not None and rest == stay + behind[to]:
                    letter = KEEP
                else:
                    letter, to = REROLE, _NEXT[state]
                state = to
                yield letter, k * block + at, state
                if letter != INSERT:
                    break
    if last:
        while state in (1, 2):
            state = _NEXT[state]
            yield INSERT, len(rows), state


def leaves(rows: list[Row], after: Costs, state: int) -> int:
    """The state in which the walk leaves the rows."""
    for *_, state in walk(rows, after, state, last=False):
        pass
    return state


def crossing(rows: list[Row]) -> list[Costs]:
    """Least costs through the rows: for each state behind them those from each state before."""
    out = []
    for t in range(4):
        costs: Costs = tuple(0 if s == t else _FAR for s in range(4))
        for row in reversed(rows):
            costs = before(row, costs)
        out.append(costs)
    return out


def through(cross: list[Costs], after: Costs) -> Costs:
    """Costs before rows with this crossing, out of those behind them."""
    return tuple(min(cross[t][s] + after[t] for t in range(4)) for s in range(4))


# Spark: rows in order


def last_character(text: Column) -> Column:
    """The last character that is not white space; empty if there is none."""
    return F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1))


def ordered_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """All rows in order, checkpointed so that their partitions stay: (part, conv, turn, role,
    text, initial, fault, times), where a row that is no duplicate stands for ``times`` - 1
    duplicates behind it, and a blank row or a duplicate for ``times`` of its kind."""
    role_text = [F.coalesce(turns[c].cast("string"), F.lit(" ")) for c in (role, text)]
    rows = turns.select(turns[conv].alias("conv"), turns[turn].alias("turn"), role_text[0].alias("role"), role_text[1].alias("text"))
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    # Role and text that occur at several turns, with the first: light, and combined before the shuffle.
    seen = rows.where(last_character(F.col("text")) != "").select("conv", digest.alias("digest"), F.struct("turn").alias("at"))
    seen = seen.groupBy("conv", "digest").agg(F.min("at").alias("first"), F.max("at").alias("latest"))
    seen = seen.where(~F.col("first").eqNullSafe(F.col("latest"))).select(F.col("conv").alias("seen_conv"), F.col("digest").alias("seen"), "first")

    counted = rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("times")).withColumn("digest", digest)
    joined = counted.join(seen, F.col("conv").eqNullSafe(F.col("seen_conv")) & (F.col("digest") == F.col("seen")), "left")
    last = last_character(F.col("text"))
    fault = (
        F.when(last == "", "blank")
        .when(F.col("seen").isNotNull() & ~F.struct("turn").eqNullSafe(F.col("first")), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    keys = ["conv", "turn", "role", F.substring("text", 1, 64), "digest"]
    keys = [(F.col(k) if isinstance(k, str) else k).asc_nulls_first() for k in keys]
    sorted_rows = joined.withColumn("fault", fault).repartitionByRange(*keys).sortWithinPartitions(*keys)
    shared_dir(turns.sparkSession)  # the checkpoint folder is set
    return sorted_rows.select(
        F.spark_partition_id().alias("part"), "conv", "turn", "role", "text", F.substring("role", 1, 1).alias("initial"), "fault", "times"
    ).checkpoint()


# Python: parts of conversations in a partition


def _parts(batches: Iterator[pa.RecordBatch], columns: list[str], rows: int = 512) -> Iterator[list[tuple]]:
    """The rows of each conversation of a partition, in order; memory follows the partition's
    longest one."""
    held: list[tuple] = []
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            part = b.slice(lo, rows)
            for row in zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns)):
                if held and row[0] != held[0][0]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def _row(initial: str, fault: str | None, times: int) -> Row:
    if fault in ("blank", "duplicate"):
        return None, False, times
    return initial if initial in _KEEPS else "", fault == "truncated", times - 1


_LIGHT = ["conv", "initial", "fault", "times", "part"]


def _edge_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, object, list[Row]]]:
    """(partition, number in it, conversation, rows) of a partition's first and last conversation."""
    latest = None
    for n, group in enumerate(_parts(batches, _LIGHT)):
        latest = n, group
        if n == 0:
            yield _edge(n, group)
    if latest and latest[0]:
        yield _edge(*latest)


def _edge(n: int, group: list[tuple]) -> tuple[int, int, object, list[Row]]:
    return group[0][4], n, group[0][0], [_row(*r[1:4]) for r in group]


def _connected(rows: DataFrame, conv_kind: str) -> dict[tuple[int, int], tuple[int, Costs, bool]]:
    """(state before, costs behind, whether its last part) for each part, by (partition, number in
    it), of the conversations that run over partitions. Two rows a partition pass through the driver."""
    light = rows.select(*_LIGHT)

    def crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n, conv, edge in _edge_parts(batches):
            cross = [cost for costs in crossing(edge) for cost in costs]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, n)] + [pa.array([conv], kind), pa.array([cross])], ["part", "n", "conv", "cross"])

    kind = rows.select("conv").limit(0).toArrow().schema.field("conv").type
    found = light.mapInArrow(crossings, f"part long, n long, conv {conv_kind}, cross array<long>").collect()
    chains = [list(g) for _, g in groupby(sorted(found, key=lambda r: (r["part"], r["n"])), key=lambda r: r["conv"])]
    chains = [c for c in chains if len(c) > 1]
    behind: dict[tuple[int, int], Costs] = {}
    for chain in chains:
        costs = END
        for r in reversed(chain):
            behind[r["part"], r["n"]] = costs
            costs = through([tuple(r["cross"][4 * t : 4 * t + 4]) for t in range(4)], costs)
    if not behind:
        return {}

    sent = rows.sparkSession.sparkContext.broadcast(behind)

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, n, _, edge in _edge_parts(batches):
            if (part, n) in sent.value:
                to = [leaves(edge, sent.value[part, n], s) for s in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, n, to)], ["part", "n", "to"])

    to = {(r["part"], r["n"]): r["to"] for r in light.mapInArrow(exits, "part long, n long, to array<long>").collect()}
    out = {}
    for chain in chains:
        state = 0
        for n, r in enumerate(chain):
            key = r["part"], r["n"]
            out[key] = state, behind[key], n == len(chain) - 1
            state = to[key][state]
    return out


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits of every conversation, in order of (part, at): edit (K, R, D or I), times, the
    repaired row's role and text (null if deleted), the original row's turn, source_role and
    fault (null if inserted), and whether the conversation lies whole in one part."""
    bounded_batches(turns.sparkSession)
    rows = ordered_rows(turns, conv, turn, role, text)
    kinds = dict(rows.dtypes)
    sent = turns.sparkSession.sparkContext.broadcast(_connected(rows, kinds["conv"]))
    schema = rows.select("conv", "turn").limit(0).toArrow().schema
    fields = [
        ("conv", schema.field("conv").type), ("part", pa.int32()), ("at", pa.int64()), ("edit", pa.string()), ("times", pa.int64()), ("role", pa.string()),
        ("text", pa.string()), ("turn", schema.field("turn").type), ("source_role", pa.string()), ("fault", pa.string()), ("whole", pa.bool_()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        at, size = 0, 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*out), fields)], [name for name, _ in fields])

        for n, group in enumerate(_parts(batches, ["conv", "initial", "fault", "times", "part", "turn", "role", "text"])):
            name, part = group[0][0], group[0][4]
            start = sent.value.get((part, n))
            state, behind, last = start or (0, END, True)
            moves = walk([_row(*r[1:4]) for r in group], behind, state, last)
            move = next(moves, None)
            for k, (_, _, fault, times, _, turn_, role_, text_) in enumerate(group):
                while move and move[1] == k:
                    letter, _, to = move
                    if letter == INSERT:
                        row = (_ROLE[to], "", None, None, None)
                    elif letter == DELETE:
                        row = (None, None, turn_, role_, fault)
                    else:
                        row = (role_ if letter == KEEP else _ROLE[to], text_, turn_, role_, fault)
                    out.append((name, part, at, letter, 1, *row, not start))
                    at, size = at + 1, size + len(row[1] or "") + 64
                    move = next(moves, None)
                again = times if fault in ("blank", "duplicate") else times - 1
                if again:
                    out.append((name, part, at, DELETE, again, None, None, turn_, role_, "blank" if fault == "blank" else "duplicate", not start))
                    at, size = at + 1, size + 64
                if size > 4_000_000:
                    yield batch()
                    out, size = [], 0
            while move:
                out.append((name, part, at, INSERT, 1, _ROLE[move[2]], "", None, None, None, not start))
                at, move = at + 1, next(moves, None)
        if out:
            yield batch()

    ddl = f"conv {kinds['conv']}, part int, at long, edit string, times long, role string, text string, turn {kinds['turn']}, source_role string, fault string, whole boolean"
    return rows.mapInArrow(run, ddl)


def repaired(edits: DataFrame) -> DataFrame:
    """The repaired conversations: what is left and what is inserted, in order of (part, at)."""
    return edits.where(F.col("edit") != DELETE).select("conv", "part", "at", "role", "text")


# Digests of the edits


class _Digest:
    """What the contract asks of one conversation, gathered in order from its edits or from
    digests of its parts."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")

    def __init__(self) -> None:
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.first = self.last = None  # initials
        self.least = self.most = None  # turns
        self.distinct = 0
        self.audit: list[str] = []

    def add(self, edit: str, times: int, turn, source: str | None, fault: str | None) -> None:
        self.audit.append(edit * times)
        cost = {KEEP: 0, REROLE: RE_COST, DELETE: DEL_COST, INSERT: INS_COST}[edit] * times
        self.counts["cost"] += cost + (CUT_COST if fault == "truncated" and edit != DELETE else 0)
        if edit == INSERT:
            return
        if fault:
            self.counts[fault] += times
        initial = source[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.counts["illegal"] += 1
        self.last = initial
        if initial + initial not in LEGAL:
            self.counts["illegal"] += times - 1
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.distinct += 1

    def join(self, after: dict) -> None:
        """Take in the digest of the part that follows."""
        for k in self.COUNTS:
            self.counts[k] += after[k]
        if after["first"] is not None:
            if self.first is None:
                self.first = after["first"]
            elif self.last + after["first"] not in LEGAL:
                self.counts["illegal"] += 1
            self.last = after["last"]
        if after["least"] is not None:
            self.distinct += after["distinct"] - (self.most == after["least"])
            self.least = after["least"] if self.least is None else self.least
            self.most = after["most"]
        self.audit.append(after["audit"])

    def values(self) -> dict:
        return self.counts | {
            "first": self.first, "last": self.last, "least": self.least, "most": self.most, "distinct": self.distinct, "audit": "".join(self.audit),
        }


_DIGEST = [(c, pa.int64()) for c in (*_Digest.COUNTS, "least", "most", "distinct")] + [(c, pa.string()) for c in ("first", "last", "audit", "sha256")]
#: Characters of repaired text that a piece of a conversation over several partitions holds.
PIECE_CHARS = 1_000_000


def _edit_digests(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType, piece_chars: int) -> Iterator[pa.RecordBatch]:
    """One row for a conversation that lies whole in the partition; else pieces in order, each with its
    repaired text in place of the hash."""
    columns = ["conv", "part", "at", "edit", "times", "role", "text", "turn", "source_role", "fault", "whole"]
    conv = digest = sha = None
    out, lines, chars, at, size, whole = [], [], 0, 0, 0, True

    def close(part: int) -> None:
        nonlocal size
        text = None if whole else "\n".join(lines)
        out.append(digest.values() | {"conv": conv, "part": part, "at": at, "whole": whole, "lines": len(lines), "text": text, "sha256": sha.hexdigest() if whole else None})
        size += len(text or "") + 512

    fields = [("conv", conv_type), ("part", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()), ("lines", pa.int64()), ("text", pa.string()), *_DIGEST]
    part = 0
    for b in batches:
        for lo in range(0, b.num_rows, 512):
            some = b.slice(lo, 512)
            for row in zip(*(some.column(some.schema.get_field_index(c)).to_pylist() for c in columns)):
                if digest is None or row[0] != conv or (not whole and chars > piece_chars):
                    if digest is not None:
                        close(part)
                    conv, part, at, whole = row[0], row[1], row[2], row[10]
                    digest, sha, lines, chars = _Digest(), hashlib.sha256(), [], 0
                _, _, _, edit, times, role, text, turn, source, fault, _ = row
                digest.add(edit, times, turn, source, fault)
                if edit != DELETE:
                    line = f"{role}:{text}"
                    if whole:
                        sha.update(("\n" + line if lines else line).encode())
                        lines = [""]  # only whether there is one
                    else:
                        lines.append(line)
                        chars += len(line)
            if size > 4_000_000:
                yield _batch(out, fields)
                out, size = [], 0
    if digest is not None:
        close(part)
    if out:
        yield _batch(out, fields)


def _batch(rows: list[dict], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in fields], [c for c, _ in fields])


def _joined_digests(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and place become one row each; a piece's text is hashed and let go."""
    fields = [("conv", conv_type), *_DIGEST]
    conv = digest = sha = None
    some = False

    def done() -> pa.RecordBatch:
        return _batch([digest.values() | {"conv": conv, "sha256": sha.hexdigest()}], fields)

    for b in batches:
        for k in range(b.num_rows):
            piece = b.slice(k, 1).to_pylist()[0]
            if digest is None or piece["conv"] != conv:
                if digest is not None:
                    yield done()
                conv, digest, sha, some = piece["conv"], _Digest(), hashlib.sha256(), False
            digest.join(piece)
            if piece["lines"]:
                sha.update((("\n" if some else "") + piece["text"]).encode())
                some = True
    if digest is not None:
        yield done()


def digests(edits: DataFrame, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row for each conversation that has an edit: counts of faults, costs, turns, audit and
    the hash of the repaired rows."""
    kind = dict(edits.dtypes)["conv"]
    conv_type = edits.select("conv").limit(0).toArrow().schema.field("conv").type
    ddl = ", ".join(f"`{c}` {'long' if t == pa.int64() else 'string'}" for c, t in _DIGEST)
    pieces = edits.mapInArrow(lambda batches: _edit_digests(batches, conv_type, piece_chars), f"conv {kind}, part long, at long, whole boolean, lines long, text string, {ddl}")
    pieces = materialize(pieces, "conversation-pieces")
    columns = ["conv", *(c for c, _ in _DIGEST)]
    over = pieces.where(~F.col("whole")).repartition("conv").sortWithinPartitions("conv", "part", "at")
    over = over.mapInArrow(lambda batches: _joined_digests(batches, conv_type), f"conv {kind}, {ddl}")
    return pieces.where("whole").select(columns).unionByName(over.select(columns))


# The query


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the contract's faults, by crc32 of ``conv_id:turn``; nulls are one space."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).where("kind != 0")
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    conversations = table(spark, sf_dir, "conversations")
    found = digests(repair(damaged(conversations))).withColumnRenamed("conv", "found_conv")
    every = conversations.select("conv_id").distinct()
    nothing = hashlib.sha256(b"").hexdigest()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("found_conv")), "left").select(
        "conv_id",
        zero(F.col("most") - F.col("least") + 1 - F.col("distinct")).alias("gaps"),
        *(zero(F.col(c)).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
