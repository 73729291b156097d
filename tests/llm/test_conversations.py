"""Conversation repair against exhaustive search and a plain re-telling of the rules."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from fundlens.llm import conversations as cv

GOOD = re.compile(r"(s?(ua)+)?")


def all_repairs(rows, most):
    """Every (cost, audit) of at most ``most`` inserts a gap that gives a legal sequence, by plain enumeration."""
    ways = []
    for initial, fault in rows:
        w = [("D", "", cv.DELETE)]
        if fault != "gone":
            extra = 3 if fault == "truncated" else 0
            w += [("K", initial, extra), ("R", "u", 3 + extra), ("R", "a", 3 + extra)]
        ways.append(w)
    gaps = [("", "", 0)] + [("I" * n, "".join(c), 3 * n) for n in range(1, most + 1) for c in itertools.product("ua", repeat=n)]
    parts = [gaps]
    for w in ways:
        parts += [w, gaps]
    for choice in itertools.product(*parts):
        if GOOD.fullmatch("".join(c[1] for c in choice)):
            yield sum(c[2] for c in choice), "".join(c[0] for c in choice)


def test_least_repair_matches_enumeration():
    codes = [(i, f) for i in "sua?" for f in ("", "truncated", "gone")]
    for n in range(3):
        for rows in itertools.product(codes, repeat=n):
            got = cv.repair_codes(b"".join(cv.CODE[r] for r in rows))
            assert got == min(all_repairs(rows, 2))
    rng = random.Random(1)
    for rows in [[rng.choice(codes) for _ in range(3)] for _ in range(12)]:
        assert cv.repair_codes(b"".join(cv.CODE[r] for r in rows)) == min(all_repairs(rows, 2))


def plain_repair(codes):
    """(cost, audit) by one table that keeps the least string of every state."""
    best = {0: (0, "")}
    for c in codes:
        new = {}
        for p, (cost, audit) in best.items():
            for a, q, step, letters in cv.STEPS[c]:
                if a == p:
                    new[q] = min(new.get(q, (cv.INF, "")), (cost + step, audit + letters))
        best = new
    return min((cost + cv.END[q], audit + cv.TAIL[q]) for q, (cost, audit) in best.items())


def test_divide_and_conquer_matches_one_table():
    rng = random.Random(2)
    for _ in range(400):
        codes = bytes(rng.choice((0, 3, 6, rng.randrange(12))) for _ in range(rng.randrange(0, 60)))
        assert cv.repair_codes(codes) == plain_repair(codes)
        cuts = sorted(rng.randrange(0, len(codes) + 1) for _ in range(rng.randrange(0, 6)))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)]) if a < b]
        cost, ends, tail = cv.path([cv.transfer(p) for p in parts])
        assert (cost, "".join(cv.audit_between(p, *e) for p, e in zip(parts, ends)) + tail) == plain_repair(codes)


def brute(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    result = []
    for conv, turns in out.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in turns:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not marks else "duplicate" if (role, text) in seen
                          else "truncated" if marks[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in turns]
        codes = bytes(cv.code_of(r[1], f)[0] for r, f in zip(turns, faults))
        cost, audit = plain_repair(codes)
        lines, at, built = [], iter(turns), ""
        for k, letter in enumerate(audit):
            new = "u" if built in ("", "s") or built[-1] == "a" else "a"
            row = next(at) if letter != "I" else None
            if letter == "K":
                lines.append(f"{row[1]}:{row[2]}")
                built += row[1][:1]
            elif letter != "D":
                lines.append({"u": "user", "a": "assistant"}[new] + ":" + (row[2] if row else ""))
                built += new
        assert GOOD.fullmatch(built)
        known = [t for t, _, _ in turns if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        result.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
                       cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(result, key=str)


def fixture():
    rng = random.Random(3)
    texts = ["Yes.", "No!", "Why?", "so", "", " \t", "Ça va.  ", "a.b", "line\nbreak.", None, "\x85"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = [(c, t if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts))
            for c in range(120) for t in range(rng.randrange(1, 12))]
    rows += [(500, t, ["user", "assistant"][t % 2], f"Turn {t % 300}.") for t in range(700)]       # a long one
    rows += [(501, None, "user", "Same.")] * 60 + [(None, t, "user", "Who?") for t in range(5)]
    rows += [(502, 1, "user", "x" * 5000 + "."), (502, 2, "assistant", "y" * 3000)] + rows[:9]
    return rows


@pytest.mark.parametrize("rows_per_piece,chars", [(4096, 1 << 20), (50, 1 << 20), (3, 200), (1, 1)])
def test_matches_brute_force(spark, rows_per_piece, chars):
    rows = fixture()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id long, turn long, role string, text string, n int, codes string")
    got = sorted((tuple(r) for r in cv.repair(df, rows_per_piece=rows_per_piece, chars_per_piece=chars).collect()), key=str)
    assert got == brute(rows)


def test_no_rows(spark):
    assert cv.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
