"""Line chunks against a plain Python rendering."""

import hashlib
import random

from fundlens.llm import line_dedup


def split(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, now = [], []
    for i, x in enumerate(lines):
        now.append(x)
        if i + 1 < len(lines) and (h[i] + 31 * (h[i - 1] if i else 0)) % 4 == 0:
            out.append(now)
            now = []
    return out + [now]


def brute(rows):
    places = {}
    for i, t in rows:
        for no, c in enumerate(split(t)) if i is not None and t is not None else ():
            if len(c) > 1 and sum(x.strip(" ") != "" for x in c) > 1:
                places.setdefault(tuple(c), set()).add((i, no))
    out = []
    for i, t in rows:
        chunks = split(t) if t is not None else []
        gone = [i is not None and (i, no) in places.get(tuple(c), ()) and (i, no) != min(places[tuple(c)])
                for no, c in enumerate(chunks)]
        kept = "\n".join("\n".join(c) for c, g in zip(chunks, gone) if not g)
        out.append((i, None if t is None else kept, sum(map(len, chunks)), sum(len(c) for c, g in zip(chunks, gone) if g)))
    return sorted(out, key=str)


def test_matches_plain_python(spark):
    rng = random.Random(11)
    line = lambda: " ".join(rng.choice(["ab", "é", "x1", "xx", "q"]) for _ in range(rng.randrange(0, 6)))
    shared = [[line() for _ in range(n)] for n in (3, 12, 30)]
    rows = []
    for i in range(120):
        lines = [f"{line()} {i}" for _ in range(rng.randrange(0, 12))]
        for s in rng.sample(shared, rng.randrange(0, 3)):
            at = rng.randrange(0, len(lines) + 1)
            lines[at:at] = s
        rows.append((i, "\n".join(lines)))
    rows += [(300, None), (301, ""), (302, "\n\n\n"), (303, " \n \n" * 20), (304, "x\ny\n" * 2000), (305, rows[3][1]),
             (None, rows[3][1]), (305, rows[3][1]), (306, "one line")]
    df = spark.createDataFrame([(i, t, 0, "h") for i, t in rows], "doc_id long, text string, no int, hash string")
    got = sorted((tuple(r) for r in line_dedup.dedup_lines(df).collect()), key=str)
    assert got == brute(rows)
    assert sum(r[3] for r in got) > 100


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_no_rows(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0
