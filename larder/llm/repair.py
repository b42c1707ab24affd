"""Structure repair of conversations: the cheapest edits that make the turns of each one legal.

Rows are taken by turn (nulls first; equal turns by role, then text). A legal conversation is
empty, or pairs of a user and an assistant row after at most one system row, told by the initials of
the roles. A row may be kept (``K``, 0), given the role that is due (``R``, 1) or deleted (``D``, 2);
an empty row of the role that is due may be inserted (``I``, 5). Blank and duplicate rows must be
deleted; a truncated row that stays costs 5 more. Of the cheapest edits those that read least win.

What is still to be paid, by the state a prefix has reached, is a vector of four costs. Less its
least cost it is one of a few vectors, so the change that any block of ``BLOCK`` symbols makes to
any vector is computed once (``Tables``). A conversation is processed block by block from its end by
lookup, which leaves the vector at every block border; each block is then expanded backward from
its right border, and the edits are read off forward, least letter first.

Conversations of over ``chunk`` rows are cut into pieces. A piece becomes the least cost from each
state before it to each state after it, the pieces of one conversation are chained (one short row
for each piece), and the pieces are traced apart. So no conversation is ever gathered into one task;
only its digest has to read its lines in order, as a stream.

Defined cases: null roles and texts are one space (so blank); a conversation id or turn may be null
and is a value of its own; rows of equal turn are ordered by role and text; repeated rows are
duplicates; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.windows import MAX_GROUP_ROWS, number_rows
from .common import written

# States: nothing yet, after the system row, after a user row, after an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# The state after a row of the role that is due, and that role.
DUE = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
KEPT = {
    "s": {NOTHING: SYSTEM},
    "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
    "": {},
}
REROLE, DELETE, TRUNCATED, INSERT = 1, 2, 5, 5
NEVER = 1 << 40
# A symbol is three times the role (s, u, a, other) plus the fault; the last one is no row at all.
GOOD, CUT, GONE = range(3)
PAD = 3 * (len(INITIALS) + 1)
SYMBOLS = PAD + 1
BLOCK = 3
# Rows of a conversation that one piece holds: some bytes each.
CHUNK = 65_536
WHITE = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


def with_inserts(vector: list[int]) -> list[int]:
    """Costs if rows may be inserted first; three in a row lead nowhere new."""
    for _ in range(3):
        vector = [min(vector[q], INSERT + vector[DUE[q]], NEVER) for q in range(4)]
    return vector


def options(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edit, cost and next state of every way to use up a row, least letter first."""
    role, fault = divmod(symbol, 3)
    found = [("D", DELETE, state)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        kept = KEPT[(INITIALS + " ")[role].strip()]
        if state in kept:
            found.append(("K", more, kept[state]))
        found.append(("R", REROLE + more, DUE[state]))
    return found


def before(symbol: int, vector: Vector) -> list[int]:
    """Costs before a row, given those after it."""
    if symbol == PAD:
        return list(vector)
    return with_inserts([min(cost + vector[q] for _, cost, q in options(symbol, state)) for state in range(4)])


class Tables:
    """All normalised cost vectors, and what each symbol and each block of symbols does to them."""

    def __init__(self):
        units = [tuple(0 if q == end else NEVER for q in range(4)) for end in range(4)]
        self.vectors: list[Vector] = []
        self.number: dict[Vector, int] = {}
        self.end = self.add(tuple(with_inserts([0, NEVER, NEVER, 0])))
        self.units = [self.add(unit) for unit in units]
        steps = []
        for vector in self.vectors:  # grows while it is read
            steps.append([self.normal(before(symbol, vector)) for symbol in range(SYMBOLS)])
        self.after = np.array([[number for number, _ in row] for row in steps])
        self.paid = np.array([[cost for _, cost in row] for row in steps])
        self.moves = [
            [[self.move(symbol, right, state) for state in range(4)] for symbol in range(PAD)]
            for right in range(len(self.vectors))
        ]
        codes = np.arange(SYMBOLS**BLOCK)
        state, cost = np.arange(len(self.vectors))[:, None].repeat(len(codes), 1), 0
        for place in reversed(range(BLOCK)):
            symbol = codes // SYMBOLS**place % SYMBOLS
            state, cost = self.after[state, symbol], cost + self.paid[state, symbol]
        self.block_after, self.block_paid = state, cost

    def add(self, vector: Vector) -> int:
        if vector not in self.number:
            self.number[vector] = len(self.vectors)
            self.vectors.append(vector)
        return self.number[vector]

    def normal(self, vector: list[int]) -> tuple[int, int]:
        """The number of a vector less its least cost, and that cost."""
        least = min(vector)
        return self.add(tuple(min(v - least, NEVER) if v < NEVER else NEVER for v in vector)), least

    def move(self, symbol: int, right: int, state: int) -> tuple[str, str, int]:
        """Edits that read least before and at a row, their roles, and the next state."""
        after = self.vectors[right]
        costs, edits, roles = before(symbol, after), "", ""
        while costs[state] < NEVER:
            fitting = [o for o in options(symbol, state) if o[1] + after[o[2]] == costs[state]]
            inserting = INSERT + costs[DUE[state]] == costs[state]
            if inserting and (not fitting or fitting[0][0] > "I"):
                state = DUE[state]
                edits, roles = edits + "I", roles + ROLE_OF[state][0]
                continue
            edit, _, state = fitting[0]
            return edits + edit, roles + (ROLE_OF[state][0] if edit == "R" else "."), state
        return "", "", state


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def blocks_of(symbols: bytes) -> tuple[np.ndarray, list[int]]:
    padded = np.full(-(-len(symbols) // BLOCK) * BLOCK, PAD, np.int64)
    padded[: len(symbols)] = np.frombuffer(symbols, np.uint8) - ord("A")
    grid = padded.reshape(-1, BLOCK)
    return grid, (grid * SYMBOLS ** np.arange(BLOCK)).sum(1).tolist()


def borders(codes: list[int], right: int) -> tuple[list[int], int]:
    """The vector after each block (and, first, before all of them), and the cost taken out of them."""
    t, found, cost = tables(), [right], 0
    after, paid = t.block_after, t.block_paid
    for code in reversed(codes):
        cost += int(paid[right, code])
        right = int(after[right, code])
        found.append(right)
    return found[::-1], cost


def crossing(symbols: bytes) -> list[int]:
    """Least cost from each state before the rows to each state after them, 16 numbers."""
    t, (_, codes) = tables(), blocks_of(symbols)
    columns = []
    for unit in t.units:
        found, cost = borders(codes, unit)
        columns.append([v + cost if v < NEVER else NEVER for v in t.vectors[found[0]]])
    return [columns[end][start] for start in range(4) for end in range(4)]


def traced(symbols: bytes, right: int, start: int, last: bool) -> tuple[str, str, int, int]:
    """Edits, their roles, their cost and the state reached; with the rows due at the very end if ``last``."""
    t, (grid, codes) = tables(), blocks_of(symbols)
    found, cost = borders(codes, right)
    cost += t.vectors[found[0]][start]
    edits, roles, state = [], [], start
    for k, block in enumerate(grid.tolist()):
        rights = [found[k + 1]]
        for symbol in reversed(block[1:]):
            rights.append(int(t.after[rights[-1], symbol]))
        for symbol, vector in zip(block, reversed(rights), strict=True):
            if symbol != PAD:
                edit, role, state = t.moves[vector][symbol][state]
                edits.append(edit)
                roles.append(role)
    while last and state in (SYSTEM, USER):
        state = DUE[state]
        edits.append("I")
        roles.append(ROLE_OF[state][0])
    if not last:
        cost -= t.vectors[right][state]  # what is left to be paid behind the piece
    return "".join(edits), "".join(roles), cost, state


def numbered(rows: DataFrame, limit: int | None = MAX_GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows with ``c`` (a conversation's key) and ``place`` from 1; and the ``initial`` and ``fault`` (blank,
    duplicate, truncated or null) of each place."""
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    picked = rows.select(
        conv.alias("conv_id"), turn.alias("turn"), plain("role").alias("role"), plain("text").alias("text"),
        F.coalesce(conv.cast("string"), F.lit("")).alias("c"),
    )
    placed = written(number_rows(picked, "c", ["turn", "role", "text"], "place", limit=limit), "turns")
    # Equal rows have an equal digest; the first of them has the least place.
    content = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    end = F.rtrim("text", F.lit(WHITE))
    slim = placed.select(
        "c", "place", initial().alias("initial"), content.alias("content"), (end == "").alias("blank"),
        F.substring(end, -1, 1).isin(".", "!", "?").alias("ended"),
    )
    firsts = slim.groupBy("c", "content").agg(F.min("place").alias("place")).select("c", "place", F.lit(True).alias("first"))
    # Places are unique, so this join is even however often a row is repeated.
    known = slim.join(firsts, ["c", "place"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("ended"), "truncated")
    return placed, written(known.select("c", "place", "initial", fault.alias("fault")), "faults")


def plain(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def initial() -> Column:
    return F.substring("role", 1, 1)


def pieces(faults: DataFrame, chunk: int) -> DataFrame:
    """``c, piece, start, symbols``: one letter for each row, at most ``chunk`` of them."""
    role = F.coalesce(*[F.when(F.col("initial") == i, k) for k, i in enumerate(INITIALS)], F.lit(len(INITIALS)))
    fault = F.when(F.col("fault").isNull(), GOOD).when(F.col("fault") == "truncated", CUT).otherwise(GONE)
    letter = F.char(F.lit(ord("A")) + 3 * role + fault)
    listed = faults.select("c", F.expr(f"(place - 1) div {chunk}").alias("piece"), "place", letter.alias("letter"))
    gathered = listed.groupBy("c", "piece").agg(
        F.min("place").alias("start"), F.sort_array(F.collect_list(F.struct("place", "letter"))).alias("letters")
    )
    return gathered.select("c", "piece", "start", F.array_join("letters.letter", "").alias("symbols"))


def chained(parts: DataFrame) -> DataFrame:
    """Pieces with ``right, state, final``: the vector after each piece, the state before it, and whether
    it ends its conversation.

    Only conversations of several pieces are chained: first the vectors from the last piece back,
    then the states from the first piece on. Each step reads one short row for each piece.
    """
    t = tables()
    own = {"right": F.lit(t.end), "state": F.lit(NOTHING), "final": F.lit(True)}
    if not parts.agg(F.max("piece")).first()[0]:
        return parts.withColumns(own)
    plan = parts.join(parts.groupBy("c").agg(F.count("*").alias("pieces")), "c")
    alone, many = plan.where("pieces = 1").withColumns(own), plan.where("pieces > 1")

    @F.pandas_udf("array<bigint>")
    def across(symbols: pd.Series) -> pd.Series:
        return pd.Series([crossing(s.encode()) for s in symbols])

    def vectors(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece", ascending=False)
        known, vector, found = tables(), tables().end, []
        for costs in group["costs"]:
            found.append(vector)
            after, grid = known.vectors[vector], np.asarray(costs).reshape(4, 4).tolist()
            vector, _ = known.normal([min(NEVER, *(grid[q][e] + after[e] for e in range(4))) for q in range(4)])
        return group[["c", "piece"]].assign(right=found)

    @F.pandas_udf("array<int>")
    def reached(symbols: pd.Series, right: pd.Series) -> pd.Series:
        pairs = zip(symbols, right, strict=True)
        return pd.Series([[traced(s.encode(), r, start, False)[3] for start in range(4)] for s, r in pairs])

    def states(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece")
        state, found = NOTHING, []
        for ends in group["ends"]:
            found.append(state)
            state = int(ends[state])
        return group[["c", "piece", "right"]].assign(state=found, final=group["piece"] == group["piece"].max())

    costs = many.select("c", "piece", across("symbols").alias("costs"))
    rights = written(costs.groupBy("c").applyInPandas(vectors, "c string, piece bigint, right int"), "vectors")
    ends = many.join(rights, ["c", "piece"]).select("c", "piece", "right", reached("symbols", "right").alias("ends"))
    borders_ = ends.groupBy("c").applyInPandas(states, "c string, piece bigint, right int, state int, final boolean")
    return alone.drop("pieces").unionByName(parts.join(written(borders_, "states"), ["c", "piece"]))


AUDIT = "struct<audit string, roles string, cost bigint>"


def audited(faults: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``c, piece, start, audit, roles, cost``: the edits of each piece of each conversation."""

    @F.pandas_udf(AUDIT)
    def trace(symbols: pd.Series, right: pd.Series, state: pd.Series, final: pd.Series) -> pd.DataFrame:
        rows = [traced(s.encode(), r, q, f)[:3] for s, r, q, f in zip(symbols, right, state, final, strict=True)]
        return pd.DataFrame(rows, columns=["audit", "roles", "cost"])

    parts = written(pieces(faults, chunk), "pieces")
    found = chained(parts).select("c", "piece", "start", trace("symbols", "right", "state", "final").alias("t"))
    return written(found.select("c", "piece", "start", "t.*"), "audits")


def edit_rows(audits: DataFrame) -> DataFrame:
    """``c, place, nth, edit, role``: one row for each edit; an insertion has the place of the row after it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("c", "start", "audit", "roles")]
            for c, start, audit, roles in zip(*columns, strict=True):
                letters = np.frombuffer(audit.encode(), np.uint8)
                own = letters != ord("I")
                names = [{"u": "user", "a": "assistant"}.get(r) for r in roles]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c] * len(letters), pa.string()),
                        pa.array(start + np.cumsum(own) - own, pa.int64()),
                        pa.array(np.arange(len(letters)), pa.int64()),
                        pa.array(list(audit), pa.string()),
                        pa.array(names, pa.string()),
                    ],
                    names=["c", "place", "nth", "edit", "role"],
                )

    return audits.select("c", "start", "audit", "roles").mapInArrow(
        work, "c string, place bigint, nth bigint, edit string, role string"
    )


class Repair:
    """The repair of ``rows (conv_id, turn, role, text)``: ``edits`` and ``lines`` as rows, ``report`` by conversation."""

    def __init__(self, rows: DataFrame, chunk: int = CHUNK, limit: int | None = MAX_GROUP_ROWS):
        self.turns, self.faults = numbered(rows, limit)
        self.audits = audited(self.faults, chunk)

    def edits(self) -> DataFrame:
        """``c, conv_id, place, nth, edit, role, text``: every row kept, deleted or inserted, with its new role."""
        own = self.turns.select("c", "place", F.col("role").alias("own_role"), "text")
        inserted = F.col("edit") == "I"
        return edit_rows(self.audits).join(own, ["c", "place"], "left").select(
            "c", F.when(F.col("c") != "", F.col("c")).cast("bigint").alias("conv_id"), "place", "nth", "edit",
            F.coalesce("role", "own_role").alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"),
        )

    def lines(self) -> DataFrame:
        """The rows of the repaired conversations, in order of ``place, nth``."""
        return self.edits().where("edit != 'D'")

    def digests(self) -> DataFrame:
        """``c, repaired_sha256``: lines in order, hashed as they stream by, so none are gathered."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, digest = None, None

            def closed():
                return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["c", "sha"])

            for batch in batches:
                for c, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if c != key:
                        if digest is not None:
                            yield closed()
                        key, digest = c, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(line.encode("utf-8", "surrogatepass"))
            if digest is not None:
                yield closed()

        lines = self.lines().select("c", F.concat("role", F.lit(":"), "text").alias("line"), "place", "nth")
        ordered = lines.repartition("c").sortWithinPartitions("c", "place", "nth").select("c", "line")
        return ordered.mapInArrow(work, "c string, sha string").withColumnRenamed("sha", "repaired_sha256")

    def report(self) -> DataFrame:
        """One row for each conversation that has rows: ``conv_id``, its gaps, faults, cost and audit."""
        turns = self.turns.groupBy("c").agg(
            F.first("conv_id").alias("conv_id"),
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        )
        kinds = [F.count_if(F.col("fault") == kind).alias(kind) for kind in ("blank", "duplicate", "truncated")]
        faults = self.faults.groupBy("c").agg(*kinds)
        follow = self.faults.select("c", (F.col("place") + 1).alias("place"), F.col("initial").alias("earlier"))
        pairs = self.faults.join(follow, ["c", "place"])
        illegal = pairs.groupBy("c").agg(
            F.count_if(~F.concat("earlier", "initial").isin("su", "ua", "au")).alias("illegal")
        )
        listed = F.sort_array(F.collect_list(F.struct("piece", "audit")))
        audits = self.audits.groupBy("c").agg(
            F.array_join(listed["audit"], "").alias("audit"), F.sum("cost").alias("cost")
        )
        joined = turns.join(faults, "c").join(audits, "c").join(illegal, "c", "left")
        return joined.select("c", "conv_id", "gaps", "blank", "duplicate", "truncated",
                             F.coalesce("illegal", F.lit(0)).alias("illegal"), "cost", "audit")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with faults, dealt by ``crc32("conv_id:turn") % 20``: 0 drops a row, 1 empties its text,
    2 removes ``[.!?]`` from it, 3 repeats it, 4 gives it the role user."""
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    names = [F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv, turn)]
    kind = F.crc32(F.concat(names[0], F.lit(":"), names[1]).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    role = F.when(kind == 4, "user").otherwise(plain("role"))
    picked = rows.where(kind != 0).select(
        conv.alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return picked.drop("copy")


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """One row for every conversation given: figures, audit and digest of its repair after the damage."""
    repair = Repair(damaged(conversations))
    every = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    every = every.withColumn("c", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    found = every.join(repair.report().drop("conv_id"), "c", "left").join(repair.digests(), "c", "left")
    figures = [F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in FIGURES]
    digest = F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest()))
    return found.select("conv_id", *figures, F.coalesce("audit", F.lit("")).alias("audit"), digest.alias("repaired_sha256"))
