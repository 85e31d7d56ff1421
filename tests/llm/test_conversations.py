"""Repairs against a plain shortest path over (row, state), whole conversations against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from ordersight.llm import conversations as C
from ordersight.llm.queries import op13_conversations

from ..conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_repair(symbols: str) -> tuple[int, str]:
    """Least (cost, audit); states: 0 nothing, 1 after s, 2 after u, 3 after a."""

    @lru_cache(None)
    def go(i: int, state: int, inserted: int) -> tuple[int, str]:
        wanted, after = ("a", 3) if state == 2 else ("u", 2)
        options = [(0, "")] if i == len(symbols) and state in (0, 3) else []

        def take(letter: str, cost: int, rest: tuple[int, str]) -> None:
            options.append((cost + rest[0], letter + rest[1]))

        if inserted < 3:
            take("I", 3, go(i, after, inserted + 1))
        if i < len(symbols):
            c = symbols[i]
            take("D", 4, go(i + 1, state, 0))
            if c != "x":
                cut = 3 if c.isupper() else 0
                if c.lower() == wanted:
                    take("K", cut, go(i + 1, after, 0))
                else:
                    take("R", 3 + cut, go(i + 1, after, 0))
                if c.lower() == "s" and state == 0:
                    take("K", cut, go(i + 1, 1, 0))
        return min(options, default=(10**9, ""))

    for i in range(len(symbols), -1, -1):  # from the end, so that nothing recurses far
        for state in range(4):
            go(i, state, 0)
    return go(0, 0, 0)


def test_repairs_of_all_short_conversations():
    for n in range(5):
        for symbols in map("".join, itertools.product("xsuaoSUA", repeat=n)):
            assert C.repair(symbols) == plain_repair(symbols), symbols


@pytest.mark.parametrize("letters", ["ua", "uaUAx", "xsuaoSUAO", "sx", "uuuuaaaUA", "uauauauauauax"])
def test_repairs_in_segments(letters):
    draw = random.Random(letters)
    for n in range(1, 60):
        symbols = "".join(draw.choice(letters) for _ in range(n))
        want = plain_repair(symbols)
        assert C.repair(symbols) == want, symbols
        assert C.repair(symbols, 7) == want, symbols
        assert C.repair(symbols, 1) == want, symbols


def test_a_conversation_of_many_turns_fits_in_segments():
    draw = random.Random(3)
    symbols = "".join(c for c in "ua" * 5000 if draw.random() > 0.05)
    cost, audit = C.repair(symbols)
    assert sum(c != "I" for c in audit) == len(symbols)
    assert cost == 3 * sum(c in "IR" for c in audit) + 4 * audit.count("D")


def plain(rows: list[tuple]) -> list[tuple]:
    blank = " \t\n\x0b\x0c\r"
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = (" " if x is None else x for x in (role, text))
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (2 if draw == 3 else 1)
    out = []
    for conv, some in convs.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in some:
            last = text.rstrip(blank)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
            seen.add((role, text))
        turns = [t for t, _, _ in some if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(some, some[1:]))
        letters = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "o" for r in some]
        symbols = "".join("x" if f in ("blank", "duplicate") else c.upper() if f else c for c, f in zip(letters, faults))
        cost, audit = plain_repair(symbols)
        kept, wanted, left = [], "user", iter(some)
        for edit in audit:
            role, text = (wanted, "") if edit == "I" else next(left)[1:]
            if edit == "D":
                continue
            role = wanted if edit == "R" else role
            kept.append(f"{role}:{text}")
            wanted = "assistant" if role[:1] == "u" else "user"
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def _got(df) -> list[tuple]:
    return sorted((tuple(r) for r in C.repaired(df, "conv_id", "turn", "role", "text").collect()), key=str)


def _conversations(n: int) -> list[tuple]:
    draw = random.Random(5)
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(1, 12)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""])
            text = draw.choice(["Hello there.", "Really? ", "no end", None, "", " \t\n", "Ünd ß!", "Two.\nlines\n", f"own {conv} {turn}."])
            rows.append((conv if conv % 19 else None, turn if draw.random() > 0.1 else None, role, text))
    return rows + rows[: n // 2]


def test_equals_plain_python_with_nulls_repeats_and_clashing_columns(spark):
    rows = _conversations(150)
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit("mine") for c in ("conv", "place", "fault", "phase", "of", "kept", "audit", "cost")})
    assert _got(df) == plain(rows)


def test_conversations_that_are_dropped_whole_and_empty_tables(spark):
    dropped = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    rows = [(c, 0, "user", "Hello.") for c in dropped]
    empty = hashlib.sha256(b"").hexdigest()
    assert _got(spark.createDataFrame(rows, SCHEMA)) == sorted([(c, 0, 0, 0, 0, 0, 0, "", empty) for c in dropped], key=str)
    assert _got(spark.createDataFrame([], SCHEMA)) == []


def test_one_conversation_with_most_rows_and_very_long_texts(spark):
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(900)]
    rows += [(c, t, ("user", "assistant")[t % 2], "long " * 50_000 + ".") for c in range(2, 6) for t in range(4)]
    assert _got(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_without_damage(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (2, 0, "user", "Hi.")]
    got = {r["conv_id"]: (r["cost"], r["audit"]) for r in C.repaired(spark.createDataFrame(rows, SCHEMA), "conv_id", "turn", "role", "text", harm=False).collect()}
    assert got == {1: (0, "KK"), 2: (3, "KI")}


def test_query_over_its_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op13_conversations(spark, SF_SMALL)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)
