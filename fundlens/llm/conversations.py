"""Conversation structure repair by Hirschberg divide and conquer.

A repaired conversation reads ``(s?(ua)+)?`` in role initials.  Four states describe how far
a prefix of it has come: nothing yet, after the system turn, after a user turn, after an
assistant turn.  Cost vectors over these states are pushed forward through the first half
of the rows and backward through the second; they meet in the middle, the crossing state of
least total cost is chosen (of equal ones the audit-least), and both halves recurse between
known states.  Only two vectors of four costs are alive at a time, so the reconstruction
needs no table over the rows.

An audit writes D, I, K and R for delete, insert, keep and rerole.  Letters and start state
fix the path, and strings that end right after a row's own letter are prefix-free, so states
can be ordered by their least audit without holding the strings.

Conversations of ordinary size are repaired whole.  Longer ones are cut into pieces by row
order; each piece is reduced to the costs between its four entry and four exit states, the
same divide and conquer over pieces finds the states at their borders, and every piece is
then repaired on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.llm.common import materialise, tasks

ROWS_PER_PIECE = 4096
CHARS_PER_PIECE = 1 << 20
REMEMBERED = 20_000                 # short code strings whose repair a task keeps
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
INF = 1 << 60
SPACE = " \t\n\x0b\x0c\r"
_FREE = (0, INF, INF, INF)

# the role an insert or rerole must write in each state, and the state it leads to
_NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
_KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_CODES = [(i, f) for i in "sua?" for f in ("", "truncated", "gone")]
#: a row's code: its initial and whether it must go or is truncated, as one byte
CODE = {c: bytes([n]) for n, c in enumerate(_CODES)}


def _steps(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, letters) of every way past one row.

    The letters are inserts in front of the row and then the row's own letter.  Three or more
    inserts in a row return to a state reached before, so two are enough.
    """
    out = []
    for p in range(4):
        q, cost, letters = p, 0, ""
        for _ in range(3):
            out.append((p, q, cost + DELETE, letters + "D"))
            if fault != "gone":
                extra = TRUNCATED if fault == "truncated" else 0
                if (q, initial) in _KEEP:
                    out.append((p, _KEEP[q, initial], cost + extra, letters + "K"))
                out.append((p, _NEXT[q][1], cost + REROLE + extra, letters + "R"))
            q, cost, letters = _NEXT[q][1], cost + INSERT, letters + "I"
    # of the ways between two states only the cheapest, audit-least one can be used
    best = {}
    for p, q, cost, letters in sorted(out, key=lambda s: (s[2], s[3])):
        best.setdefault((p, q), (p, q, cost, letters))
    return sorted(best.values())


STEPS = [_steps(*c) for c in _CODES]
#: what is inserted after the last row to end well: nothing, user and assistant, assistant, nothing
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
END = tuple(INSERT * len(TAIL[q]) for q in range(4))


def forward(codes: bytes, cost: tuple, order: tuple = (0, 1, 2, 3)) -> tuple[tuple, tuple]:
    """(costs, ranks) per state after the rows; ranks order the states by their least audit."""
    for c in codes:
        new, how = [INF] * 4, [None] * 4
        for p, q, step, letters in STEPS[c]:
            if cost[p] < INF:
                n, key = cost[p] + step, (order[p], letters)
                if n < new[q] or n == new[q] and key < how[q]:
                    new[q], how[q] = n, key
        ranked = sorted((h, q) for q, h in enumerate(how) if h is not None)
        place = [4] * 4
        for r, (_, q) in enumerate(ranked):
            place[q] = r
        cost, order = tuple(new), tuple(place)
    return cost, order


def backward(codes: bytes, cost: tuple) -> tuple:
    """Costs per state before the rows, given the costs from each state after them."""
    for c in reversed(codes):
        new = [INF] * 4
        for p, q, step, _ in STEPS[c]:
            if cost[q] + step < new[p]:
                new[p] = cost[q] + step
        cost = tuple(new)
    return cost


def _only(state: int) -> tuple:
    return tuple(0 if q == state else INF for q in range(4))


def _crossing(front: tuple, order: tuple, back: tuple) -> int:
    """The state at the meeting point: least total cost, of equal ones the audit-least."""
    return min(range(4), key=lambda q: (front[q] + back[q], order[q]))


def audit_between(codes: bytes, enter: int, leave: int) -> str:
    """Least audit of the rows from state ``enter`` to state ``leave`` (right after the last row)."""
    if not codes:
        return ""
    if len(codes) == 1:
        return next(letters for p, q, _, letters in STEPS[codes[0]] if (p, q) == (enter, leave))
    half = len(codes) // 2
    front, order = forward(codes[:half], _only(enter))
    q = _crossing(front, order, backward(codes[half:], _only(leave)))
    return audit_between(codes[:half], enter, q) + audit_between(codes[half:], q, leave)


def repair_codes(codes: bytes) -> tuple[int, str]:
    """(least cost, its audit) of one conversation."""
    cost, order = forward(codes, _FREE)
    last = min(range(4), key=lambda q: (cost[q] + END[q], order[q]))
    return cost[last] + END[last], audit_between(codes, START, last) + TAIL[last]


def transfer(codes: bytes) -> list[tuple[tuple, tuple]]:
    """(costs, ranks) of a piece from each of its four entry states."""
    return [forward(codes, _only(p)) for p in range(4)]


def _through(pieces: list, cost: tuple, order: tuple) -> tuple[tuple, tuple]:
    """``forward`` over whole pieces."""
    for table in pieces:
        new, how = [INF] * 4, [None] * 4
        for p in range(4):
            for q in range(4):
                if cost[p] < INF and table[p][0][q] < INF:
                    n, key = cost[p] + table[p][0][q], (order[p], table[p][1][q])
                    if n < new[q] or n == new[q] and key < how[q]:
                        new[q], how[q] = n, key
        place = [4] * 4
        for r, (_, q) in enumerate(sorted((h, q) for q, h in enumerate(how) if h is not None)):
            place[q] = r
        cost, order = tuple(new), tuple(place)
    return cost, order


def _back_through(pieces: list, cost: tuple) -> tuple:
    for table in reversed(pieces):
        cost = tuple(min(min(INF, table[p][0][q] + cost[q]) for q in range(4)) for p in range(4))
    return cost


def borders(pieces: list, enter: int, leave: int) -> list[tuple[int, int]]:
    """(entry, exit) state of every piece on the least path from ``enter`` to ``leave``."""
    if len(pieces) <= 1:
        return [(enter, leave)] * len(pieces)
    half = len(pieces) // 2
    front, order = _through(pieces[:half], _only(enter), (0, 1, 2, 3))
    q = _crossing(front, order, _back_through(pieces[half:], _only(leave)))
    return borders(pieces[:half], enter, q) + borders(pieces[half:], q, leave)


def path(pieces: list) -> tuple[int, list[tuple[int, int]], str]:
    """(least cost, borders of every piece, inserts after the last row) of a cut conversation."""
    cost, order = _through(pieces, _FREE, (0, 1, 2, 3))
    last = min(range(4), key=lambda q: (cost[q] + END[q], order[q]))
    return cost[last] + END[last], borders(pieces, START, last), TAIL[last]


def repaired_lines(rows: list[tuple[str, str]], audit: str, state: int) -> Iterator[str]:
    """``role:text`` of every row the audit leaves or inserts, from the given entry state."""
    at = iter(rows)
    for letter in audit:
        if letter == "I":
            role, state = _NEXT[state]
            yield f"{role}:"
            continue
        role, text = next(at)
        if letter == "K":
            state = _KEEP[state, role[:1]]
            yield f"{role}:{text}"
        elif letter == "R":
            role, state = _NEXT[state]
            yield f"{role}:{text}"


def fault_of(text: str, seen: bool) -> str:
    """A row's first fault: blank, duplicate, truncated or none."""
    bare = text.rstrip(SPACE)
    if not bare:
        return "blank"
    return "duplicate" if seen else "" if bare[-1] in ".!?" else "truncated"


def code_of(role: str, fault: str) -> bytes:
    initial = role[:1]
    return CODE[initial if initial in ("s", "u", "a") else "?", "gone" if fault in ("blank", "duplicate") else fault]


# --- the job ------------------------------------------------------------------

def damage(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           kinds: int = 20) -> DataFrame:
    """(conv_id, turn, role, text, n): rows after damage, equal rows as one with their number.

    The crc32 of ``conv_id:turn`` modulo ``kinds`` chooses: 0 drops the row, 1 empties its text,
    2 takes its end marks out, 3 repeats it, 4 makes its role user.  A null id, turn, role or
    text counts as one space, but a null turn stays null for order and gaps.
    """
    def spaced(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")) % kinds
    rows = df.select(F.col(conv).alias("conv_id"), F.col(turn).cast("long").alias("turn"), kind.alias("kind"),
                     spaced(role).alias("role"), spaced(text).alias("text")).where("kind <> 0")
    return (rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
                        .otherwise(F.col("text")).alias("text"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("n"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")))


_LEGAL = {"su", "ua", "au"}


def repair(df: DataFrame, rows_per_piece: int = ROWS_PER_PIECE, chars_per_piece: int = CHARS_PER_PIECE,
           damaged: DataFrame | None = None, id_col: str = "conv_id") -> DataFrame:
    """Faults, least repair and repaired text of every conversation.

    Rows are taken by (turn, role, text), null turns first; ``damaged`` (as ``damage`` gives
    it) replaces the table's own rows, whose ids all stay.  Returns conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit and repaired_sha256.  A null id is one
    conversation of its own; equal rows count as often as they stand; a role with an initial
    other than s, u or a can only be reroled or deleted; a conversation without rows has
    zeros, an empty audit and the digest of the empty text; an empty table gives no rows;
    other columns are not read.

    A conversation beyond ``rows_per_piece`` rows or ``chars_per_piece`` characters is
    range-partitioned by row order and cut into pieces; its digest, a hash over all its
    lines in order, streams them through one task, a piece at a time.
    """
    rows = materialise(damage(df) if damaged is None else damaged, "conversations-rows")
    ids = df.select(F.col(id_col).alias("conv_id")).distinct()
    size = rows.groupBy("conv_id").agg(
        F.sum("n").alias("rows"), F.sum(F.length("text")).alias("chars"), F.min("turn").alias("lo"),
        F.max("turn").alias("hi"))
    turns = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy("conv_id").agg(F.count("turn").alias("turns"))
    size = materialise(size.join(turns, size["conv_id"].eqNullSafe(turns["conv_id"])).select(
        size["conv_id"], ((F.col("rows") > rows_per_piece) | (F.col("chars") > chars_per_piece)).alias("long"),
        F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("turns"), F.lit(0)).alias("gaps")), "conversations-sizes")
    kind = rows.schema["conv_id"].dataType.simpleString()
    long_ids = size.where("long").select("conv_id")
    short = rows.alias("r").join(long_ids.alias("l"), F.expr("r.conv_id <=> l.conv_id"), "left_anti").select("r.*")
    done = _whole(short, kind)
    if long_ids.take(1):
        cut = rows.alias("r").join(long_ids.alias("l"), F.expr("r.conv_id <=> l.conv_id"), "left_semi").select("r.*")
        done = done.unionByName(_cut(cut, kind, rows_per_piece, chars_per_piece))
    done = done.alias("d").join(size.alias("s"), F.expr("d.conv_id <=> s.conv_id")).select("d.*", "s.gaps")
    empty = hashlib.sha256(b"").hexdigest()
    counts = [F.coalesce(f"d.{c}", F.lit(0).cast("long")).alias(c)
              for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.alias("i").join(done.alias("d"), F.expr("i.conv_id <=> d.conv_id"), "left").select(
        "i.conv_id", *counts, F.coalesce("d.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


def _whole(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations that one task holds at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}          # a result depends on the codes alone

        def one(conv, turns: list[tuple[str, str, int]]):
            seen, codes, lines = set(), [], []
            count = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            for role, text, n in turns:
                for _ in range(n):
                    fault = fault_of(text, (role, text) in seen)
                    seen.add((role, text))
                    if fault:
                        count[fault] += 1
                    if lines and lines[-1][0][:1] + role[:1] not in _LEGAL:
                        count["illegal"] += 1
                    codes.append(code_of(role, fault))
                    lines.append((role, text))
            key = b"".join(codes)
            cost, audit = known.get(key) or repair_codes(key)
            if len(key) <= 32 and len(known) < REMEMBERED:
                known[key] = (cost, audit)
            text = "\n".join(repaired_lines(lines, audit, START))
            return (conv, *count.values(), cost, audit, hashlib.sha256(text.encode()).hexdigest())

        names = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        at, turns, started = None, [], False
        for b in batches:
            out = []
            for conv, role, text, n in zip(*(b[c].to_pylist() for c in ("conv_id", "role", "text", "n"))):
                if started and conv != at:
                    out.append(one(at, turns))
                    turns = []
                at, started = conv, True
                turns.append((role, text, n))
            if out:
                yield _batch(out, names, b.schema.field("conv_id").type)
            kind_ = b.schema.field("conv_id").type
        if started:
            yield _batch([one(at, turns)], names, kind_)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(run, f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, "
                                   "audit string, repaired_sha256 string")


def _batch(rows: list[tuple], names: list[str], kind: pa.DataType) -> pa.RecordBatch:
    types = [kind if c == "conv_id" else pa.string() if c in ("audit", "repaired_sha256") else pa.int64() for c in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _cut(rows: DataFrame, kind: str, rows_per_piece: int, chars_per_piece: int) -> DataFrame:
    """Conversations cut into pieces by row order."""
    # a row's text was seen before if its (role, text) has a smaller place; hash by digest, least turn first
    key = F.sha2(F.concat_ws("\x00", "role", "text"), 256)
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = (rows.groupBy("conv_id", key.alias("k")).agg(F.min(place).alias("first"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15)))))
    salted = rows.withColumn("k", key).withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(16)).cast("int"))
    marked = (salted.alias("r").join(first.alias("f"), F.expr("r.conv_id <=> f.conv_id AND r.k = f.k AND r.salt = f.salt"))
              .select("r.conv_id", "r.turn", "r.role", "r.text", "r.n",
                      (F.struct(F.col("r.turn").isNotNull().alias("known"), F.col("r.turn")) != F.col("f.first")).alias("seen")))
    marked = marked.withColumn("seen", F.coalesce("seen", F.lit(False)))
    ordered = (marked.repartitionByRange(tasks(rows), "conv_id", "turn", "role", "text")
               .sortWithinPartitions("conv_id", "turn", "role", "text")
               .withColumn("part", F.spark_partition_id().cast("long")))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "part", "piece", "codes", "blank", "duplicate", "truncated", "first", "last", "illegal",
                 "roles", "texts"]
        state = {"conv": None, "piece": 0, "rows": [], "chars": 0, "part": 0, "kind": None}

        def flush() -> pa.RecordBatch:
            codes, faults, illegal, before = [], [], 0, None
            for role, text, fault in state["rows"]:
                faults.append(fault)
                codes.append(code_of(role, fault))
                if before is not None and before + role[:1] not in _LEGAL:
                    illegal += 1
                before = role[:1]
            roles, texts = [r[0] for r in state["rows"]], [r[1] for r in state["rows"]]
            vals = [state["conv"], state["part"], state["piece"], b"".join(codes), faults.count("blank"),
                    faults.count("duplicate"), faults.count("truncated"), roles[0][:1], roles[-1][:1], illegal, roles, texts]
            types = [state["kind"], pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
                     pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
            state.update(rows=[], chars=0, piece=state["piece"] + 1)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(vals, types)], names=names)

        for b in batches:
            state["kind"] = b.schema.field("conv_id").type
            for conv, part, role, text, n, seen in zip(*(b[c].to_pylist() for c in ("conv_id", "part", "role", "text", "n", "seen"))):
                if state["rows"] and conv != state["conv"]:
                    yield flush()
                state.update(conv=conv, part=part)
                for i in range(n):
                    if state["rows"] and (len(state["rows"]) >= rows_per_piece or state["chars"] + len(text) > chars_per_piece):
                        yield flush()
                    state["rows"].append((role, text, fault_of(text, seen or i > 0)))
                    state["chars"] += len(text)
        if state["rows"]:
            yield flush()

    cut = materialise(ordered.mapInArrow(
        pieces, f"conv_id {kind}, part long, piece long, codes binary, blank long, duplicate long, truncated long, "
                "first string, last string, illegal long, roles array<string>, texts array<string>"), "conversations-pieces")

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a piece: its costs between states, 64 bytes and ranks instead of its rows."""
        for b in batches:
            tables = [[[*costs, *ranks] for costs, ranks in transfer(c)] for c in b["codes"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["conv_id"], b["part"], b["piece"], pa.array(tables, pa.list_(pa.list_(pa.int64())))],
                names=["conv_id", "part", "piece", "costs"])

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "ascending"), ("piece", "ascending")])
        tables = [[(tuple(r[:4]), tuple(r[4:])) for r in t] for t in table["costs"].to_pylist()]
        cost, ends, tail = path(tables)
        n = len(ends)
        return pa.table([table["conv_id"], table["part"], table["piece"], pa.array([e[0] for e in ends], pa.int32()),
                         pa.array([e[1] for e in ends], pa.int32()), pa.array([cost] * n, pa.int64()),
                         pa.array([""] * (n - 1) + [tail], pa.string())],
                        names=["conv_id", "part", "piece", "enter", "leave", "cost", "tail"])

    met = (cut.select("conv_id", "part", "piece", "codes")
           .mapInArrow(states, f"conv_id {kind}, part long, piece long, costs array<array<long>>")
           .groupBy("conv_id").applyInArrow(meet, f"conv_id {kind}, part long, piece long, enter int, leave int, cost long, tail string"))
    both = cut.alias("c").join(met.alias("m"), F.expr("c.conv_id <=> m.conv_id AND c.part = m.part AND c.piece = m.piece")).select(
        "c.*", "m.enter", "m.leave", "m.cost", "m.tail")

    def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b[c].to_pylist() for c in ("codes", "roles", "texts", "enter", "leave", "tail")]
            audit, lines = [], []
            for codes, roles, texts, enter, leave, tail in zip(*cols):
                audit.append(audit_between(codes, enter, leave) + tail)
                lines.append("\n".join(repaired_lines(list(zip(roles, texts)), audit[-1], enter)))
            # a piece of which nothing is left differs from one empty line
            some = [any(x != "D" for x in a) for a in audit]
            keep = [b.schema.get_field_index(c) for c in ("conv_id", "part", "piece", "blank", "duplicate", "truncated",
                                                          "first", "last", "illegal", "cost")]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in keep), pa.array(audit, pa.string()),
                 pa.array([x if s else None for x, s in zip(lines, some)], pa.string())],
                names=["conv_id", "part", "piece", "blank", "duplicate", "truncated", "first", "last", "illegal", "cost",
                       "audit", "lines"])

    repaired = materialise(both.mapInArrow(
        audits, f"conv_id {kind}, part long, piece long, blank long, duplicate long, truncated long, first string, last string, "
                "illegal long, cost long, audit string, lines string"), "conversations-repaired")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of each conversation in order, through one hash."""
        at, started, hashed, any_line, kind_ = None, False, hashlib.sha256(), False, None
        for b in batches:
            kind_ = b.schema.field("conv_id").type
            for conv, lines in zip(b["conv_id"].to_pylist(), b["lines"].to_pylist()):
                if started and conv != at:
                    yield _batch([(at, hashed.hexdigest())], ["conv_id", "repaired_sha256"], kind_)
                    hashed, any_line = hashlib.sha256(), False
                at, started = conv, True
                if lines is not None:
                    hashed.update((b"\n" if any_line else b"") + lines.encode())
                    any_line = True
        if started:
            yield _batch([(at, hashed.hexdigest())], ["conv_id", "repaired_sha256"], kind_)

    hashes = (repaired.select("conv_id", "part", "piece", "lines").repartition("conv_id")
              .sortWithinPartitions("conv_id", "part", "piece").drop("part", "piece")
              .mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string"))
    # pairs of turns across the border of two pieces
    before = F.lag("last").over(Window.partitionBy("conv_id").orderBy("part", "piece"))
    pair = F.concat(before, "first")
    joined = (repaired.drop("lines").withColumn("across", F.when(before.isNotNull() & ~pair.isin(*_LEGAL), 1).otherwise(0))
              .groupBy("conv_id").agg(
        F.sum("blank").alias("blank"), F.sum("duplicate").alias("duplicate"), F.sum("truncated").alias("truncated"),
        (F.sum("illegal") + F.sum("across")).alias("illegal"), F.min("cost").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "piece", "audit"))), lambda s: s["audit"]), "")
        .alias("audit")))
    return joined.alias("j").join(hashes.alias("h"), F.expr("j.conv_id <=> h.conv_id")).select("j.*", "h.repaired_sha256")
