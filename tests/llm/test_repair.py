"""Conversation repair: every search against an exhaustive one, and whole conversations against plain Python."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from quire.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, keep=lambda end: end in ("", "a")):
    """Least (cost, letters, lines) over all edits, from rows (role, text, gone, open), cheapest prefix for each state."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(ways):
        out = dict(ways)
        for _ in range(3):
            for state, (c, x, lines) in list(out.items()):
                way = (c + 3, x + "I", (*lines, name[after[state]] + ":"))
                out[after[state]] = min(out.get(after[state], way), way)
        return out

    ways = {"": (0, "", ())}
    for role, text, gone, open_ in rows:
        new = {}
        for state, (c, x, lines) in inserted(ways).items():
            steps = [(state, (c + 4, x + "D", lines))]
            if not gone:
                fine = 3 if open_ else 0
                if role[:1] == after[state] or role[:1] == "s" and state == "":
                    steps.append((role[:1], (c + fine, x + "K", (*lines, f"{role}:{text}"))))
                steps.append((after[state], (c + fine + 3, x + "R", (*lines, f"{name[after[state]]}:{text}"))))
            for s, way in steps:
                new[s] = min(new.get(s, way), way)
        ways = new
    return min(way for s, way in inserted(ways).items() if keep(s))


def truly_all(rows):
    """Every sequence of edits that the letters allow, without any cut-off (short conversations only)."""
    best = None
    for places in itertools.product(range(3), repeat=len(rows) + 1):
        for acts in itertools.product("DKR", repeat=len(rows)):
            state, cost, letters, ok = "", 0, "", True
            for k in range(len(rows) + 1):
                for _ in range(places[k]):
                    state, cost, letters = {"": "u", "s": "u", "u": "a", "a": "u"}[state], cost + 3, letters + "I"
                if k == len(rows):
                    break
                c, act = rows[k], acts[k]
                letters += act
                if act == "D":
                    cost += 4
                    continue
                want = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                cost += (3 if act == "R" else 0) + (3 if c.isupper() else 0)
                if c == "x" or act == "K" and c.lower() != want and (c.lower() != "s" or state):
                    ok = False
                    break
                state = "s" if act == "K" and c.lower() == "s" else want
            if ok and state in ("", "a"):
                best = (cost, letters) if best is None else min(best, (cost, letters))
    return best


def test_search_against_all_edits():
    for n in range(4):
        for rows in itertools.product("suaoxSUA", repeat=n):
            assert repair.search("".join(rows)) == truly_all("".join(rows)), rows


def test_search_of_long_rows_and_parts():
    rng = random.Random(4)
    for n in (9, 40, 300):
        rows = "".join(rng.choice("ssuuaaauxoUAS") for _ in range(n))
        table = [({"s": "system", "u": "user", "a": "assistant"}.get(c.lower(), "other"), "", c == "x", c.isupper()) for c in rows]
        whole = repair.search(rows)
        assert whole == brute(table)[:2]
        for size in (1, 4, 7):
            cuts = [rows[k:k + size] for k in range(0, n, size)]
            some = [[dict(zip(("start", "end", "cost", "letters", "order"), o)) for o in repair.options(c, k == 0, k == len(cuts) - 1)] for k, c in enumerate(cuts)]
            cost, _, way = repair.put_together(some, repair.START)[repair.END]
            letters = "".join(next(o["letters"] for o in s if (o["start"], o["end"]) == w) for s, w in zip(some, way))
            assert (cost, letters) == whole


def test_a_long_alternating_row_is_quick():
    assert repair.search("u" * 512)[0] == 3 * 256
    assert repair.search("s" * 512) is not None


def table(seed=9):
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Hello there.", "What now?", "cut off", "", "  \n", "Same again!", f"text {rng.randrange(6)}."])
            rows.append((conv, turn if rng.random() < 0.9 else turn + 3, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), text))
    rows += [(None, 0, "user", "a."), (None, None, "assistant", "b."), (900, None, None, None), (901, 1, "user", "x."), (901, 1, "user", "x."), (901, 1, "user", "x.")]
    rows += [(902, t, "user" if t % 2 == 0 else "assistant", f"long {t}" + ("." if t % 5 else "")) for t in range(200)]
    rows += [(903, 0, "user", "word " * 20000 + ".")]
    return rows


def expected(rows, gone=frozenset()):
    out = []
    for conv in {r[0] for r in rows} | set(gone):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " "))
        mine = [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in mine]
        seen, faults, flags = set(), {"blank": 0, "duplicate": 0, "truncated": 0}, []
        for _, role, text in mine:
            body = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                faults[fault] += 1
            flags.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {t for t, *_ in mine if t is not None}
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, lines = brute(flags)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults.values(), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size,fan", [(512, 1024), (4, 1024), (3, 2)])
def test_repair_against_plain_python(spark, monkeypatch, size, fan):
    monkeypatch.setattr(repair, "FAN", fan)
    rows = table()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("conv", F.lit("mine")).withColumn("pos", F.lit("mine")).repartition(4)
    got = repair.with_digest(*repair.repair(df, size=size)).collect()
    assert sorted([tuple(r) for r in got], key=str) == expected(rows)


def test_repair_of_nothing_and_of_dropped_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.with_digest(*repair.repair(none)).count() == 0
    gone = spark.createDataFrame([(5, 0, "user", "a."), (5, 1, "assistant", "b.")], SCHEMA)
    got = repair.with_digest(*repair.repair(gone, F.lit(False))).collect()
    assert [tuple(r) for r in got] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_repaired_rows_alternate(spark):
    _, rows = repair.repair(spark.createDataFrame(table(), SCHEMA))
    convs = {}
    for r in rows.orderBy("conv", "pos", "nth").collect():
        convs.setdefault(r.conv, []).append(r.role[:1])
    assert len(convs) > 20 and all(re.fullmatch("s?(ua)+", "".join(x)) for x in convs.values())


def test_damage(spark):
    import zlib
    rows = [(c, t, "assistant", "A. b! c?") for c in range(30) for t in range(5)] + [(None, None, None, None)]
    got = queries.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.live))
    for c, t, role, text in rows:
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        one = ("user" if f == 4 else role, "" if f == 1 else "A b c" if f == 2 and c is not None else text, f != 0)
        assert by[c, t] == [one] * (2 if f == 3 else 1)
