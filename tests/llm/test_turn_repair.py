import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from nestgate.llm import turn_repair as T

DDL = "conv_id long, turn long, role string, text string"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit) by plain recursion over whole strings; ``turns``: (role, fault)."""
    import sys
    sys.setrecursionlimit(10_000)

    @lru_cache(None)
    def best(i, ended, inserted):
        # ended: "", "s", "u" or "a", what the output ends with
        options = []
        if i == len(turns) and ended in ("", "a"):
            options.append((0, ""))
        after = {"": "u", "s": "u", "u": "a", "a": "u"}[ended]
        if inserted < 3:
            c, s = best(i, after, inserted + 1)
            options.append((c + 3, "I" + s))
        if i < len(turns):
            role, fault = turns[i]
            c, s = best(i + 1, ended, 0)
            options.append((c + 4, "D" + s))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault else 0
                if role[:1] == after or (role[:1] == "s" and ended == ""):
                    c, s = best(i + 1, role[:1], 0)
                    options.append((c + extra, "K" + s))
                c, s = best(i + 1, after, 0)
                options.append((c + 3 + extra, "R" + s))
        return min(options) if options else (1 << 40, "")
    return best(0, "", 0)


def brute(original, rows):
    out = {}
    for conv in {r[0] for r in original}:
        mine = sorted((r for r in rows if r[0] == conv),
                      key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3][:32], hashlib.sha256(r[3].encode()).hexdigest()))
        seen, turns, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            shown = VISIBLE.findall(text)
            fault = ("blank" if not shown else "duplicate" if (role, text) in seen
                     else None if shown[-1] in ".!?" else "truncated")
            seen.add((role, text))
            turns.append((role, fault))
            if fault:
                counts[fault] += 1
        numbers = [r[1] for r in mine if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit = cheapest(tuple(turns))
        said, i = [], 0
        for letter in audit:
            after = "assistant" if said and said[-1].startswith("u") else "user"
            if letter == "I":
                said.append(after + ":")
                continue
            if letter != "D":
                said.append((mine[i][2] if letter == "K" else after) + ":" + mine[i][3])
            i += 1
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said))
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def text_rows(seed, n, longest=14):
    r = random.Random(seed)
    out = []
    for conv in [None, *range(n)]:
        turn = r.randrange(3)
        for i in range(r.randrange(longest)):
            role = ["user", "assistant"][i % 2] if r.random() < 0.7 else r.choice(
                ["user", "assistant", "system", "tool", "", None, "system"])
            text = r.choice(["Yes.", "No!", "Why?", "cut off", "", " \n", None, "end. \t\n", "ß é.", "a.b", f"{r.random()}."])
            out.append((conv, None if r.random() < 0.05 else turn, role, text))
            turn += r.choice([1, 1, 1, 2, 5])
    return out


def run(spark, rows, with_damage=True, parts=5):
    df = spark.createDataFrame(rows, DDL).withColumn("pos", F.lit(1)).withColumn("conv", F.lit("x")).repartition(parts)
    out = T.repair_report(df, with_damage=with_damage).collect()
    assert len({r.conv_id for r in out}) == len(out)
    return {r.conv_id: tuple(r[c] for c in T.REPORT) for r in out}


@pytest.mark.parametrize("segment", [4096, 3])
def test_against_brute_force(spark, monkeypatch, segment):
    """Whole conversations in a segment, and conversations cut into segments of three turns."""
    monkeypatch.setattr(T, "SEGMENT", segment)
    rows = text_rows(segment, 150)
    assert run(spark, rows) == brute(rows, damage(rows))
    plain = [(c, t, " " if r is None else r, " " if s is None else s) for c, t, r, s in rows]
    assert run(spark, rows, with_damage=False) == brute(rows, plain)


def test_long_conversation_with_runs(spark, monkeypatch):
    """Runs of equal symbols over many segments."""
    monkeypatch.setattr(T, "SEGMENT", 64)
    r = random.Random(5)
    rows, turn = [], 0
    while turn < 600:
        role, end = r.choice(["user", "assistant"]), r.choice([".", ""])
        for _ in range(r.randrange(1, 40)):
            rows.append((7, turn, role, f"text {turn}{end}"))
            turn += 1
    assert run(spark, rows) == brute(rows, damage(rows))


@pytest.mark.parametrize("symbol", "bdsuaoSUAO")
def test_powers_are_products(symbol):
    costs = T.LAST
    for n in range(70):
        assert T._over_run(symbol, n, T.LAST) == costs
        costs = T._apply(T._transition(symbol), costs)


def test_repeated_rows_empty_table_and_dropped_conversations(spark):
    assert run(spark, []) == {}
    dropped = [(c, t) for c in range(400) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    rows = [(c, t, "user", "Hello.") for c, t in dropped]
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows and run(spark, rows) == {c: empty for c, _ in dropped}
    twice = text_rows(3, 20) * 2
    assert run(spark, twice, with_damage=False) == brute(twice, [
        (c, t, " " if r is None else r, " " if s is None else s) for c, t, r, s in twice])


def test_repaired_turns(spark):
    long = "x" * 2_000_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", "Again."), (1, 2, "user", "open")]
    out = T.repaired_turns(spark.createDataFrame(rows, DDL)).orderBy("place").collect()
    kept = [(r.role, r.text) for r in out if r.edit != "D"]
    assert "".join(r.edit for r in out) == brute(rows, rows)[1][6]
    assert kept == [("user", long + "."), ("assistant", "Again.")]
