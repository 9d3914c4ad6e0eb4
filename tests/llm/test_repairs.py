"""Audits against every way of editing; rows against the contract, row by row."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from corpusloom.llm import repairs

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, kind int"
SYMBOLS = "suaoSUAOx"
LEGAL = re.compile("(s?(ua)+)?")


def every_way(signature):
    """The best of all edits with up to two turns inserted at each place."""
    gaps = [("", "")] + [("I" * n, "".join(p)) for n in (1, 2) for p in itertools.product("ua", repeat=n)]
    rows = []
    for z in signature:
        fault = 5 * z.isupper()
        rows.append([("D", 2, "")] + ([("K", fault, z.lower()), ("R", 1 + fault, "u"), ("R", 1 + fault, "a")] if z != "x" else []))
    best = None
    for ways in itertools.product(*rows):
        cost = sum(x[1] for x in ways)
        for holes in itertools.product(gaps, repeat=len(rows) + 1):
            audit = holes[0][0] + "".join(w[0] + h[0] for w, h in zip(ways, holes[1:]))
            found = (cost + 5 * audit.count("I"), audit)
            if (best is None or found < best) and LEGAL.fullmatch(holes[0][1] + "".join(w[2] + h[1] for w, h in zip(ways, holes[1:]))):
                best = found
    return best


def by_suffixes(signature):
    """Cost and audit from the last row to the first, whole audits compared."""
    to = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, ""), "s": (10, "II"), "u": (5, "I"), "a": (0, "")}
    for z in reversed(signature):
        fault, now = 5 * z.isupper(), {}
        for q in best:
            options = [(best[q][0] + 2, "D" + best[q][1])]
            if z != "x":
                options.append((best[to[q]][0] + 1 + fault, "R" + best[to[q]][1]))
                if z.lower() == to[q] or z.lower() == "s" and q == "":
                    options.append((best[z.lower()][0] + fault, "K" + best[z.lower()][1]))
            now[q] = min(options)
        best = {q: min((now[q], (now[to[q]][0] + 5, "I" + now[to[q]][1]), (now[to[to[q]]][0] + 10, "II" + now[to[to[q]]][1]))) for q in now}
    return best[""]


def contract(rows):
    """Every conversation's report."""
    space = lambda x: " " if x is None else x
    own = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        role, text = space(role), space(text)
        hit = zlib.crc32(f"{space(conv_id)}:{space(turn)}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        role = "user" if hit == 4 else role
        own[conv_id] += [(turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = []
    for conv_id, items in own.items():
        items.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()[:16]))
        seen, faults, signature = set(), [], ""
        for _, role, text in items:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            z = role[:1] if role[:1] and role[:1] in "sua" else "o"
            signature += "x" if fault in ("blank", "duplicate") else z.upper() if fault else z
        turns = [x[0] for x in items if x[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        cost, audit = by_suffixes(signature)
        lines, at, last = [], iter(items), ""
        for e in audit:
            role, text = ("", "") if e == "I" else next(at)[1:]
            if e != "D":
                role = role if e == "K" else {"u": "assistant"}.get(last, "user")
                last = role[:1]
                lines.append(f"{role}:{text}")
        out.append((conv_id, gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(13)
    texts = ["Yes.", "no", "Really?  \n", "", " \t\x0b", None, "a.b", "wow!", " \x85", "x\x1f", "."]
    out = []
    for c in range(400):
        for t in range(rng.randrange(1, 9)):
            out.append((c, t * rng.choice((1, 1, 2)), rng.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None, "Assistant")), rng.choice(texts), "x", 1))
    out += [(500, t, ("user", "assistant")[t % 2], f"turn {t}.", None, None) for t in range(700)]
    out += [(501, t, "user", "same.", None, None) for t in range(300)]
    out += [(None, 3, "user", "Nobody's.", None, None), (None, None, "assistant", "Nobody's.", None, None), (502, None, None, None, None, None), (502, None, "system", "S.", None, None), (-7, -3, "user", "Minus.", None, None)]
    return out + out[40:60]


@pytest.mark.parametrize("length", [0, 1, 2])
def test_audits_are_the_best_of_all_edits(length):
    for signature in map("".join, itertools.product(SYMBOLS, repeat=length)):
        assert repairs.solve(signature) == every_way(signature) == by_suffixes(signature), signature


def test_longer_signatures():
    rng = random.Random(2)
    for _ in range(1500):
        signature = "".join(rng.choice(SYMBOLS) for _ in range(rng.randrange(3, 40)))
        assert repairs.solve(signature) == by_suffixes(signature), signature
    long = "".join(rng.choice(SYMBOLS) for _ in range(5000))
    assert repairs.solve(long) == by_suffixes(long)


def test_reports_follow_the_contract(spark):
    table = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    done = repairs.reports(repairs.damaged(table))
    assert done.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in done.collect()), key=str) == contract(odd_rows())


def test_many_shapes_are_joined_by_shuffles(spark, monkeypatch):
    monkeypatch.setattr(repairs, "BROADCAST_BYTES", 0)
    rows = odd_rows()[:700]
    done = repairs.reports(repairs.damaged(spark.createDataFrame(rows, SCHEMA)))
    assert sorted((tuple(r) for r in done.collect()), key=str) == contract(rows)


def test_dropped_and_empty(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi.", None, None)]
    done = [tuple(r) for r in repairs.reports(repairs.damaged(spark.createDataFrame(rows, SCHEMA))).collect()]
    assert done == contract(rows) == [(dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert repairs.reports(repairs.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_repaired_rows_are_legal_and_keep_good_conversations(spark):
    done = defaultdict(list)
    for r in repairs.repaired(spark.createDataFrame(odd_rows(), SCHEMA)).orderBy("conv_id", "turn").collect():
        done[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    for rows in done.values():
        assert [x[0] for x in rows] == list(range(len(rows))) and LEGAL.fullmatch("".join(x[1][0] for x in rows))
    assert done[500] == [(t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)]
