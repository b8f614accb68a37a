"""Conversation repair against a plain search, row by row."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from tripwright.llm import conversation_repair as repair
from tripwright.llm import queries

BARE = re.compile(r"[\x20\x09-\x0D]")


def plain_edits(rows):
    """(cost, audit, repaired) of rows (role, text, fault): the least by cost, then by edits."""

    @lru_cache(None)
    def best(i, state, inserts):
        # states: "" nothing yet, "s", "u", "a" the last initial
        name = "assistant" if state == "u" else "user"
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 4:
            cost, edits, out = best(i, name[0], inserts + 1)
            ways.append((5 + cost, "I" + edits, ((name, ""), *out)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, edits, out = best(i + 1, state, 0)
            ways.append((2 + cost, "D" + edits, out))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] == name[0] or (role[:1] == "s" and state == ""):
                    cost, edits, out = best(i + 1, role[0], 0)
                    ways.append((extra + cost, "K" + edits, ((role, text), *out)))
                cost, edits, out = best(i + 1, name[0], 0)
                ways.append((1 + extra + cost, "R" + edits, ((name, text), *out)))
        return min(ways, default=(1 << 30, "", ()))

    # from the end, so that no search goes deep
    for i in range(len(rows), 0, -20):
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def plain_repair(table):
    """All rows of the query, from rows (conv_id, turn, role, text)."""
    said = lambda x: " " if x is None else str(x)
    convs = {r[0]: [] for r in table}
    for conv, turn, role, text in table:
        draw = zlib.crc32(f"{said(conv)}:{said(turn)}".encode()) % 20
        role, text = said(role), said(text)
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        row = (turn, "user" if draw == 4 else role, text)
        convs[conv] += [row] * (1 + (draw == 3))
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        turns = [r[0] for r in rows if r[0] is not None]
        faults, seen = [], set()
        for _, role, text in rows:
            bare = BARE.sub("", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, edits, fixed = plain_edits(tuple((r[1], r[2], f) for r, f in zip(rows, faults, strict=True)))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        text = "\n".join(f"{a}:{b}" for a, b in fixed)
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, hashlib.sha256(text.encode()).hexdigest()))
    return out


def compared(frame, want):
    got = [tuple(r) for r in repair.summary(frame).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("length", [*range(6), 9, 30])
def test_block_tables_find_the_least_audit(length):
    draw = random.Random(length)
    kinds = [("", "blank")] + [(r, f) for f in ("", "truncated") for r in ("system", "user", "assistant", "tool")]
    for _ in range(200):
        symbols = [draw.randrange(9) for _ in range(length)]
        rows = tuple((kinds[s][0], f"t{k}", kinds[s][1]) for k, s in enumerate(symbols))
        assert repair.audit(bytes(symbols)) == plain_edits(rows)[:2]


def test_conversations(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = plain_repair([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])
    got = [tuple(r) for r in queries.op13_repair(spark, sf_dir).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, conv string, kind string, hash string"
    long = "word " * 50_000
    rows = [(1, k, "user" if k % 2 else "assistant", f"Text {k}.") for k in range(40)] + [(2, None, None, None), (2, None, "user", "A?"), (None, 3, "user", "Null."), (None, None, "assistant", "id!")]
    rows += [(3, 1, "user", "Same.")] * 30 + [(3, 7, "user", "Same.")] * 5 + [(3, 7, "tool", "Same.")] + [(4, k, "", " \n") for k in range(5)] + [(5, 1, "system", long), (5, 2, "user", long + "."), (5, 9, "assistant", "ñ東\U0001f600!")]
    rows += [(6, k, "system", "S.") for k in range(30)] + [(k, 1, "user", "One.") for k in range(100, 160)]
    frame = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], schema).repartition(3)
    compared(frame, plain_repair(rows))
    compared(frame.limit(0), [])


def test_one_conversation_with_a_third_of_all_rows(spark):
    """Its symbols are a byte a row, repeated rows arrive as counts, and the audit is still the least."""
    hot = [(0, k // 3, ("user", "assistant", "system")[k % 3], f"Text {k % 50}" + "." * (k % 4 > 0)) for k in range(900)]
    rows = hot + [(1 + k // 6, k % 6, ("user", "assistant")[k % 2], f"Other {k}.") for k in range(1800)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    compared(frame, plain_repair(rows))
