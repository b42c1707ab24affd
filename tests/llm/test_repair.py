import hashlib
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

from larder.llm import queries
from larder.llm import repair as r

DUE = {"": "u", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """``(cost, audit, repaired)`` by trying every edit at every place; ``rows``: initial, must go, truncated."""

    @lru_cache(None)
    def best(i, last, inserted):
        found = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        if inserted < 3:
            cost, audit, out = best(i + 1 - 1, DUE[last], inserted + 1)
            found.append((cost + 5, "I" + audit, (("I", DUE[last]), *out)))
        if i < len(rows):
            first, gone, cut = rows[i]
            cost, audit, out = best(i + 1, last, 0)
            found.append((cost + 2, "D" + audit, out))
            if not gone:
                if (last, first) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    cost, audit, out = best(i + 1, first, 0)
                    found.append((cost + 5 * cut, "K" + audit, ((i, None), *out)))
                cost, audit, out = best(i + 1, DUE[last], 0)
                found.append((cost + 1 + 5 * cut, "R" + audit, ((i, DUE[last]), *out)))
        return min(found, default=(10**9, "", ()), key=lambda f: f[:2])

    return best(0, "", 0)


def brute(given, damage=True):
    """The contract row by row."""
    out = {}
    for conv in {g[0] for g in given}:
        rows = []
        for c, turn, role, text in given:
            if c != conv:
                continue
            role, text = " " if role is None else role, " " if text is None else text
            key = ":".join(" " if v is None else str(v) for v in (c, turn))
            kind = zlib.crc32(key.encode()) % 20 if damage else 9
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            role = "user" if kind == 4 else role
            rows += [(turn is not None, turn or 0, role, text)] * {0: 0, 3: 2}.get(kind, 1)
        rows.sort(key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
        turns = [t for there, t, _, _ in rows if there]
        names = {"u": "user", "a": "assistant"}
        seen, judged, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in rows:
            end = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            judged.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
        cost, audit, repaired = cheapest(tuple(judged))
        lines = [names[role] + ":" if i == "I" else (names[role] if role else rows[i][2]) + ":" + rows[i][3] for i, role in repaired]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, sha)
    return out


def rows_of(frame):
    return {f.conv_id: tuple(f[1:]) for f in frame.collect()}


def made(seed, conversations, most):
    draw = random.Random(seed)
    texts = ["Yes.", "No", "ok!", "", " \n", "why? ", "Well.\t"]
    return [
        (c, draw.randrange(most) if draw.random() < 0.95 else None, draw.choice(["user", "assistant", "system", "tool", ""]), draw.choice(texts))
        for c in range(conversations)
        for _ in range(draw.randrange(1, most))
    ]


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_blocks_give_the_cheapest_and_least_edits():
    draw = random.Random(4)
    for _ in range(1500):
        rows = [(draw.choice("sua?uaua"), draw.random() < 0.2, draw.random() < 0.3) for _ in range(draw.randrange(9))]
        symbols = [3 * "sua?".index(i) + (2 if gone else 1 if cut else 0) for i, gone, cut in rows]
        found = r.traced(bytes(65 + s for s in symbols), r.tables().end, r.NOTHING, True)
        assert (found[2], found[0]) == cheapest(tuple(rows))[:2]


def test_vectors_are_few_and_blocks_equal_steps():
    t = r.tables()
    assert len(t.vectors) < 100
    draw = random.Random(5)
    for _ in range(300):
        symbols = [draw.randrange(r.SYMBOLS) for _ in range(r.BLOCK)]
        state = draw.randrange(len(t.vectors))
        code = sum(s * r.SYMBOLS**k for k, s in enumerate(symbols))
        at, cost = state, 0
        for s in reversed(symbols):
            cost, at = cost + t.paid[at, s], t.after[at, s]
        assert (t.block_after[state, code], t.block_paid[state, code]) == (at, cost)


@pytest.mark.parametrize("chunk, limit", [(r.CHUNK, None), (2, 1), (3, 1)])
def test_whole_results_in_any_pieces(spark, chunk, limit):
    """Conversations in one piece, and cut everywhere with their rows numbered in slices."""
    given = made(6, 60, 9)
    repair = r.Repair(spark.createDataFrame(given, SCHEMA), chunk, limit)
    joined = repair.report().join(repair.digests(), "c", "left").na.fill(hashlib.sha256().hexdigest(), ["repaired_sha256"])
    assert rows_of(joined.drop("c")) == brute(given, damage=False)


def test_pieces_of_one_long_conversation(spark):
    """Cut into pieces, a conversation is repaired as if it were whole."""
    draw = random.Random(7)
    given = [(1, i, draw.choice(["user", "assistant"]), f"t{i}" + draw.choice([".", ""])) for i in range(500)]
    frame = spark.createDataFrame(given, SCHEMA)
    one, many = r.Repair(frame), r.Repair(frame, chunk=7)
    assert many.audits.count() == 72
    assert one.report().collect() == many.report().collect()
    assert one.digests().collect() == many.digests().collect()
    lines = [(x.role[0], x.place) for x in many.lines().orderBy("place", "nth").collect()]
    assert re.fullmatch("(s?(ua)+)?", "".join(x for x, _ in lines))


def test_odd_conversations(spark):
    given = [
        (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (3, None, None, None), (3, None, "user", "a."),
        (4, 5, "user", "x" * 300_000 + "."), (4, 6, "assistant", "y" * 300_000), (5, 1, "", ""), (6, 1, "user", "Hi."),
        (6, 1, "user", "Hi."), (6, 1, "assistant", "Hi."), (6, 9, "Ünï", "é?"), (7, -3, "system", "S."), (7, 3, "user", "?"),
    ]
    frame = spark.createDataFrame([(*g, "c", 1) for g in given], SCHEMA + ", c string, place int")
    assert rows_of(r.damaged_and_repaired(frame)) == brute(given)
    assert r.damaged_and_repaired(frame.limit(0)).collect() == []


def test_a_conversation_that_loses_all_rows(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    found = r.damaged_and_repaired(spark.createDataFrame([(conv, 1, "user", "a.")], SCHEMA)).collect()
    assert [tuple(f) for f in found] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_sql_equals_brute_force():
    """The checking SQL on rows with nulls, ties and repeats."""
    given = made(3, 80, 8) + [(None, 1, "user", "Hi."), (None, 2, None, None)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    connection.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", given)
    rows = connection.execute(queries.CHECKS["op11_conversation_repair"]).fetchall()
    assert {row[0]: row[1:] for row in rows} == brute(given) and len(rows) == 81


def test_query(spark, small_dir):
    given = [tuple(x) for x in spark.read.parquet(f"{small_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(queries.QUERIES["op11_conversation_repair"](spark, small_dir)) == brute(given)
