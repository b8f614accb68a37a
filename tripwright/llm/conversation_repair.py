"""Cheapest repair of a conversation's turns, by block tables over cost vectors (Four Russians).

A repaired conversation is empty, or an optional system turn and then pairs of user and assistant: an automaton with
four states (``START``, after a system turn, after a user turn, after an assistant turn). Each row is one of nine
symbols, by its role's initial and its fault; blank and repeated rows are one symbol, as they have to go. A cost
vector holds the least cost of finishing from each state. Its entries differ by a few edits at most, so that there are
few vectors with least entry 0; for each of them and each of the ``9 ** BLOCK`` blocks of symbols a table holds the
vector before the block and the cost that is added.

A conversation is processed from its end, a look-up for each block, and the vectors between blocks are kept. Then each
block is expanded backward, symbol by symbol, from the vector behind it, and its edits are read off forward: of those
that stay on a cheapest path the ASCII-least, so that ties fall as stated. Expansions are remembered by (block,
vector, state).

On Spark, faults are found first, in DataFrame operations over narrow rows: equal (conversation, turn, role, text) are
one row with a count, and the first of equal (conversation, role, text) is an aggregate joined back on whole keys, so
that no group is held and none is hot. Then one shuffle by conversation brings the symbols, sorted before the texts; a
task reads both as a stream and holds the symbols and edits of one conversation, a byte or two a row, and one batch of
texts. The hash of a repaired conversation is of one sequence, so that its rows pass through one task.

Defined cases: null role, text, turn or id count as one space in hashes and results; a null id is a conversation, a
null turn comes first; rows of one turn are in order of role, then of the hash of the text; repeated rows are
duplicates; a role without initial is illegal; a conversation whose rows are all dropped gives zeros; an empty table
gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import bounded_batches, partitions

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
#: Symbols: 0 has to go; 1 to 4 are the initials s, u, a and any other; 5 to 8 the same, truncated.
GONE, INITIALS, SYMBOLS = 0, "sua", 9
BLOCK = 4
FAR = 1 << 20
#: Remembered expansions; the rest is expanded anew.
REMEMBERED = 1 << 18

Vector = tuple[int, ...]


def next_role(state: int) -> tuple[str, int]:
    """The only role that a reroled or inserted turn can have in a state, and the state behind it."""
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


def finished(vector: list[int]) -> Vector:
    """Costs with the inserts that may come first, one at least as good as none more."""
    out = list(vector)
    for _ in range(2):
        for state in range(4):
            out[state] = min(out[state], INSERT + out[next_role(state)[1]])
    return tuple(out)


def steps(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of the ways to take a row in a state, in ASCII order of the edits."""
    out = [("D", DELETE, state)]
    if symbol != GONE:
        initial, extra = (symbol - 1) % 4, TRUNCATED * (symbol > 4)
        to = next_role(state)[1]
        if initial == 0 and state == START:
            out.append(("K", KEEP + extra, SYSTEM))
        elif initial < 3 and INITIALS[initial] == next_role(state)[0][0]:
            out.append(("K", KEEP + extra, to))
        out.append(("R", REROLE + extra, to))
    return out


def before(symbol: int, vector: Vector) -> Vector:
    """Costs before a row, given those behind it."""
    return finished([min(cost + vector[to] for _, cost, to in steps(symbol, state)) for state in range(4)])


#: Costs behind the last row: only an empty conversation and one that ends with an assistant turn are done.
LAST = finished([0, FAR, FAR, 0])


@lru_cache(maxsize=1)
def tables() -> tuple[list[Vector], list[list[int]], list[list[int]]]:
    """(vectors, vector before, cost added), the latter two by block number and vector."""
    def normal(v: Vector) -> tuple[Vector, int]:
        least = min(v)
        return tuple(x - least for x in v), least

    vectors: list[Vector] = [normal(LAST)[0]]
    places = {vectors[0]: 0}
    into: list[list[int]] = []
    added: list[list[int]] = []
    for vector in vectors:
        into.append([])
        added.append([])
        for symbol in range(SYMBOLS):
            v, cost = normal(before(symbol, vector))
            if v not in places:
                places[v] = len(vectors)
                vectors.append(v)
            into[-1].append(places[v])
            added[-1].append(cost)
    one, cost = np.array(into).T, np.array(added).T
    # a block's number has its first symbol as the highest digit, and the last symbol is taken first
    at, total = np.arange(len(vectors))[None], np.zeros((1, len(vectors)), np.int64)
    for _ in range(BLOCK):
        at, total = one[:, at].reshape(-1, len(vectors)), (cost[:, at] + total).reshape(-1, len(vectors))
    return vectors, at.tolist(), total.tolist()


def expand(symbols: tuple[int, ...], behind: Vector, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits of some rows from a state, and the state behind them."""
    costs = [behind]
    for symbol in reversed(symbols):
        costs.append(before(symbol, costs[-1]))
    out = []
    costs.reverse()
    for k, symbol in enumerate(symbols):
        here, after = costs[k], costs[k + 1]
        taken = False
        while not taken:
            ways = [(edit, to, True) for edit, cost, to in steps(symbol, state) if cost + after[to] == here[state]]
            to = next_role(state)[1]
            if INSERT + here[to] == here[state]:
                ways.append(("I", to, False))
            edit, state, taken = min(ways)
            out.append(edit)
    while last and state not in (START, ASSISTANT):
        out.append("I")
        state = next_role(state)[1]
    return "".join(out), state


remembered: dict[tuple[int, int, int], tuple[str, int]] = {}


def audit(symbols: bytes) -> tuple[int, str]:
    """Least cost and ASCII-least edits of a conversation, given as one byte a row."""
    vectors, into, added = tables()
    head = len(symbols) % BLOCK
    digits = np.frombuffer(symbols, np.uint8)[head:].reshape(-1, BLOCK).astype(np.int64)
    blocks = (digits @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))).tolist()
    at, cost, behind = 0, min(LAST), []
    for block in reversed(blocks):
        behind.append(at)
        cost += added[block][at]
        at = into[block][at]
    first = vectors[at]
    # the rows before the first whole block
    start: Vector = first
    for symbol in reversed(symbols[:head]):
        start = before(symbol, start)
    out, state = [], START
    edits, state = expand(tuple(symbols[:head]), first, START, not blocks)
    out.append(edits)
    for k, block in enumerate(blocks):
        vector, last = behind[-1 - k], k == len(blocks) - 1
        known = None if last else remembered.get((block, vector, state))
        if known is None:
            known = expand(tuple(digits[k].tolist()), vectors[vector], state, last)
            if not last and len(remembered) < REMEMBERED:
                remembered[block, vector, state] = known
        edits, state = known
        out.append(edits)
    return cost + start[START], "".join(out)


def damaged(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, copies) with the stated damage done; a dropped row has no copy."""
    space = F.lit(" ")

    def said(column: str) -> Column:
        return F.coalesce(F.col(f"`{column}`").cast("string"), space)

    draw = F.pmod(F.crc32(F.concat(said(conv_col), F.lit(":"), said(turn_col)).cast("binary")), F.lit(20))
    plain = rows.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), said(role_col).alias("role"), said(text_col).alias("text"), draw.alias("draw")
    )
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("draw") == 0, 0).when(F.col("draw") == 3, 2).otherwise(1)
    return plain.select("conv", "turn", role.alias("role"), text.alias("text"), copies.cast("long").alias("copies"))


def as_given(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, copies) of rows that are repaired as they are."""
    return rows.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))), F.lit(1).cast("long").alias("copies"),
    )


def described(rows: DataFrame) -> DataFrame:
    """Rows beside a hash of the text and what their symbol needs."""
    bare = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    return rows.select(
        "*",
        F.unhex(F.md5(F.col("text").cast("binary"))).alias("hash"),
        (bare == "").alias("blank"),
        (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("open"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise(" ").alias("initial"),
    )


#: Faults, as one digit of a row's code.
CLEAN, BLANK, DUPLICATE, OPEN = range(4)
KEY = ["conv", "turn", "role", "hash"]
SORT = ["conv", "kind", "turn", "role", "hash"]


def coded(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, hash, initial, fault, copies): one row for equal rows; the fault is that of the first."""
    once = rows.groupBy(*KEY, "initial", "blank", "open").agg(F.sum("copies").alias("copies"))
    there = once.where((F.col("copies") > 0) & ~F.col("blank"))
    first = there.groupBy("conv", "role", "hash").agg(F.min(F.struct(F.col("turn").isNotNull(), F.col("turn"))).alias("least"))
    first = first.select(F.col("conv").alias("c"), F.col("least.turn").alias("t"), F.col("role").alias("r"), F.col("hash").alias("h"))
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("role") == F.col("r")) & (F.col("hash") == F.col("h"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("h").isNull(), DUPLICATE).when(F.col("open"), OPEN).otherwise(CLEAN)
    return once.join(first, same, "left").select(*KEY, "initial", fault.alias("fault"), "copies")


def repaired_rows(role: str, edits: Iterator[str], state: int) -> tuple[list[str], str, int]:
    """The roles of turns inserted before a row, its own role (empty: deleted) and the state behind it."""
    inserted = []
    for edit in edits:
        if edit == "D":
            return inserted, "", state
        if edit == "K":
            return inserted, role, SYSTEM if role[:1] == "s" else USER if role[:1] == "u" else ASSISTANT
        name, state = next_role(state)
        if edit == "R":
            return inserted, name, state
        inserted.append(name)
    return inserted, "", state


class Conversation:
    """One conversation as it streams by: first its symbols, then its texts in the same order."""

    def __init__(self, conv: object) -> None:
        self.conv = conv
        self.symbols = bytearray()
        self.counts = [0, 0, 0, 0]
        self.turns: list[int] | None = None
        self.different = self.illegal = 0
        self.initial = ""
        self.edits: Iterator[str] | None = None
        self.cost, self.audit, self.state = 0, "", START
        self.lines = 0
        self.digest = hashlib.sha256()

    def row(self, turn: int | None, initial: str, fault: int, copies: int) -> None:
        if not copies:
            return
        if turn is not None:
            if self.turns is None:
                self.turns = [turn, turn]
            self.different += not self.different or turn != self.turns[1]
            self.turns[1] = turn
        repeats = copies - 1
        after = BLANK if fault == BLANK else DUPLICATE
        self.counts[fault] += 1
        self.counts[after] += repeats
        self.illegal += bool(self.initial) and self.initial + initial not in ("su", "ua", "au")
        self.illegal += repeats
        self.initial = initial
        symbol = GONE if fault in (BLANK, DUPLICATE) else 1 + "sua ".index(initial) + 4 * (fault == OPEN)
        self.symbols += bytes([symbol]) + bytes(repeats)

    def decide(self) -> None:
        if self.edits is None:
            self.cost, self.audit = audit(bytes(self.symbols))
            self.edits = iter(self.audit)

    def line(self, role: str, text: str) -> None:
        self.digest.update(("\n" * bool(self.lines) + f"{role}:{text}").encode())
        self.lines += 1

    def text(self, role: str, text: str, copies: int) -> None:
        self.decide()
        for _ in range(copies):
            inserted, own, self.state = repaired_rows(role, self.edits, self.state)
            for name in inserted:
                self.line(name, "")
            if own:
                self.line(own, text)

    def result(self) -> tuple:
        self.decide()
        for _ in self.edits:
            name, self.state = next_role(self.state)
            self.line(name, "")
        gaps = self.turns[1] - self.turns[0] + 1 - self.different if self.turns else 0
        return (self.conv, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[OPEN], self.illegal, self.cost, self.audit, self.digest.hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repaired(rows: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row for each conversation of (conv, turn, role, text, copies)."""
    spark = rows.sparkSession
    bounded_batches(spark)
    known = described(rows)
    symbols = coded(known).select(F.lit(0).alias("kind"), *KEY, "initial", "fault", "copies", F.lit(None).cast("string").alias("text"))
    texts = known.where("copies > 0").select(F.lit(1).alias("kind"), *KEY, "initial", F.lit(CLEAN).alias("fault"), "copies", "text")
    ordered = symbols.unionByName(texts).repartition(partitions(spark), "conv").sortWithinPartitions(*SORT)
    kind = rows.schema["conv"].dataType.simpleString()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        done: list[tuple] = []
        conv_type = None
        names = [id_col, *(x.split()[0] for x in RESULT.split(", "))]
        types = [pa.int64()] * 6 + [pa.string()] * 2

        def batch() -> pa.RecordBatch:
            columns = zip(*done, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [conv_type, *types], strict=True)], names)

        for given in batches:
            conv_type = given.schema.field("conv").type
            columns = (given.column(given.schema.get_field_index(c)).to_pylist() for c in ("kind", "conv", "turn", "role", "initial", "fault", "copies", "text"))
            for kind_of, conv, turn, role, initial, fault, copies, text in zip(*columns, strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.result())
                    now = Conversation(conv)
                if kind_of == 0:
                    now.row(turn, initial, fault, copies)
                else:
                    now.text(role, text, copies)
            if sum(len(d[7]) + 200 for d in done) > 1 << 20:
                yield batch()
                done.clear()
        if now is not None:
            done.append(now.result())
            yield batch()

    return ordered.mapInArrow(stream, f"`{id_col}` {kind}, {RESULT}")


def summary(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) after the stated damage."""
    return repaired(damaged(rows, conv_col, turn_col, role_col, text_col), conv_col)
