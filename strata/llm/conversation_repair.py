"""Conversations repaired at least cost, by the auction algorithm for shortest paths.

A conversation's rows are put in order of turn (nulls first). A row's first fault
counts: blank, duplicate (role and text seen earlier), truncated (no closing mark at
its end). Rows are kept (0), given the role user or assistant (1) or deleted (2, which
blank and duplicate rows must be); empty rows can be inserted (5); a truncated row that
stays costs 5 more. What is left is nothing, or an optional system row and then user
and assistant in turns. Of the cheapest repairs that with the least audit is taken.

Repairs are paths through a lattice: rows done so far x last role. Each node has a
price, at first 0. A path grows from the origin along the arc of least cost plus price;
where the last node's price is below that sum, it is raised to it and the path is cut
back by a node. When the path reaches the end, the origin's price is its distance. A
price is a lower bound of the distance until the auction has been run from its node, so
the trace runs it from each end of a tight arc (price = cost + price) before it goes
there, the least letter first. Prices depend on the size of costs, so lattices are cut
into blocks of ``BLOCK`` rows, solved from the last to the first with the next block's
prices as the costs of leaving; equal blocks are solved once a task.

Rows are dealt by ranges of (conversation, turn, ...), so no conversation is one task's.
Conversations that lie whole inside a partition are repaired there. Those at a
partition's edge or of over ``HELD`` rows go on as chunks, one a partition: each chunk
gives the costs from each state at its start to each at its end (4 x 4 numbers), a
conversation's chunks are joined by their matrices (as many as partitions at most), and
each chunk is traced by itself. First rows of equal ones are found by a count with
partial sums and joined back by place, so repeated rows meet in no task. Only a
conversation's digest, if asked for, needs all its rows in order: SHA-256 is a chain, so
one task streams through them and holds one row at a time.

Defined results: null roles and texts are one space, the null id is a conversation;
equal turns are ordered by role, then by a hash of the text; repeated rows are
duplicates; roles other than system, user and assistant by their first letter can't be
kept (nor can an empty role); an empty table gives an empty result; other columns are
ignored. Conversations without rows have no edits, cost 0 and the digest of "".
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACES, table, written

#: Rows of a lattice block; rows and characters of a conversation that a task holds.
BLOCK, HELD, HELD_CHARS = 16, 4096, 8 << 20
RENAME, DELETE, INSERT, CUT = 1, 2, 5, 5
WHITE = " \t\n\v\f\r"
#: Last role so far: none, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_FAR = 1 << 60
#: Costs of ending, and the rows inserted for it, by state.
ENDS = (0, 2 * INSERT, INSERT, 0)
LAST = ("", "ua", "a", "")
#: Edits as single characters, user and assistant told apart, and their initials.
INITIAL = {"D": "D", "K": "K", "u": "I", "a": "I", "U": "R", "A": "R"}
NEW_ROLE = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}
LEGAL = {"su", "ua", "au"}
FINE, GONE, TRUNCATED = range(3)


def _steps(code: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, cost, rows, next state) from a state before a row, by initials."""
    fault, role = divmod(code, 4)
    more = CUT if fault == TRUNCATED else 0
    user_next = state != USER
    out = [("D", DELETE, 1, state), ("u", INSERT, 0, USER) if user_next else ("a", INSERT, 0, ASSISTANT)]
    if fault != GONE:
        after = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}.get((state, role))
        if after is not None:
            out.append(("K", more, 1, after))
        out.append(("U", RENAME + more, 1, USER) if user_next else ("A", RENAME + more, 1, ASSISTANT))
    return out


STEPS = [[_steps(code, state) for state in range(4)] for code in range(12)]


def code_of(fault: int, role: str) -> int:
    return 4 * fault + {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)


def _auction(origin: int, arcs: list[list[tuple[int, int, str]]], price: list[int], end: int) -> None:
    """Raises prices until the origin's is its distance to ``end``."""
    path = [origin]
    while path[-1] != end:
        node = path[-1]
        least, best = min((cost + price[to], to) for cost, to, _ in arcs[node])
        if price[node] < least:
            price[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(best)


@lru_cache(maxsize=1 << 15)
def block(codes: bytes, leaving: tuple[int, ...]):
    """For each state at the start: (cost, edits of each row, state at the end), None
    where no way out exists. ``leaving``: costs of leaving by state."""
    n = len(codes)
    end = 4 * (n + 1)
    ways_out = [cost < _FAR for cost in leaving]
    alive = [False] * (4 * n) + ways_out + [True]
    for i in range(n - 1, -1, -1):  # nodes from which the end can be reached
        for state in (USER, ASSISTANT, USER, SYSTEM, START):
            alive[4 * i + state] = alive[4 * i + state] or any(alive[4 * (i + rows) + to] for _, _, rows, to in STEPS[codes[i]][state])
    arcs = [[(cost, to, edit) for edit, cost, rows, state in STEPS[codes[at // 4]][at % 4] if alive[to := 4 * (at // 4 + rows) + state]]
            for at in range(4 * n)]
    arcs += [[(leaving[state], end, "")] if ways_out[state] else [] for state in range(4)]
    price, known = [0] * (end + 1), {end}

    def distance(node: int) -> int:
        if node not in known:
            _auction(node, arcs, price, end)
            known.add(node)
        return price[node]

    out = []
    for state in range(4):
        if not alive[state]:
            out.append(None)
            continue
        cost, node, edits, now = distance(state), state, [], ""
        while node < 4 * n:
            for step, to, edit in arcs[node]:
                if price[node] == step + price[to] and price[node] == step + distance(to):
                    break
            now += edit
            if to // 4 > node // 4:
                edits.append(now)
                now = ""
            node = to
        out.append((cost, tuple(edits), node % 4))
    return tuple(out)


def _blocks(codes: bytes) -> list[bytes]:
    return [codes[i:i + BLOCK] for i in range(0, len(codes), BLOCK)]


def distances(codes: bytes, leaving: tuple[int, ...]) -> tuple[tuple[int, ...], list[tuple[int, ...]]]:
    """Costs from each state at the start, and the costs of leaving each block (less a constant)."""
    base, costs_of = 0, []
    for part in reversed(_blocks(codes)):
        costs_of.append(leaving)
        leaving = tuple(_FAR if x is None else x[0] for x in block(part, leaving))
        least = min(leaving)
        if least < _FAR:
            base += least
            leaving = tuple(x - least if x < _FAR else _FAR for x in leaving)
    return tuple(x + base if x < _FAR else _FAR for x in leaving), costs_of[::-1]


def trace(codes: bytes, costs_of: list[tuple[int, ...]], state: int) -> tuple[list[str], int]:
    """Edits of each row (inserted rows before it included) and the state after them."""
    edits: list[str] = []
    for part, leaving in zip(_blocks(codes), costs_of):
        _, some, state = block(part, leaving)[state]
        edits += some
    return edits, state


def fault_of(role: str, text: str, seen) -> tuple[int, str]:
    """(fault in the lattice, its name); ``seen``: whether role and text came earlier."""
    bare = text.rstrip(WHITE)
    if not bare:
        return GONE, "blank"
    if seen:
        return GONE, "duplicate"
    return (FINE, "") if bare[-1] in ".!?" else (TRUNCATED, "truncated")


def turn_gaps(least, most, different) -> int:
    return 0 if least is None else most - least + 1 - different


def applied(edits: str, role: str, text: str) -> Iterator[tuple[str, str | None, str | None]]:
    """(edit's initial, role, text) of the edits at one row; deleted rows have neither."""
    for e in edits:
        if e == "D":
            yield "D", None, None
        else:
            yield INITIAL[e], NEW_ROLE.get(e, role), text if e in "KUA" else ""


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repaired(turns: list, roles: list[str], texts: list[str]) -> tuple[dict, list[tuple[str, str | None, str | None]]]:
    """Counts of a conversation (rows in order) and its edits."""
    seen, codes, names = set(), bytearray(), []
    for role, text in zip(roles, texts):
        fault, name = fault_of(role, text, (role, text) in seen)
        seen.add((role, text))
        names.append(name)
        codes.append(code_of(fault, role))
    known = [t for t in turns if t is not None]
    costs, costs_of = distances(bytes(codes), ENDS)
    edits, state = trace(bytes(codes), costs_of, START)
    rows = [x for e, role, text in zip(edits, roles, texts) for x in applied(e, role, text)] + list(applied(LAST[state], "", ""))
    return {"gaps": turn_gaps(min(known, default=None), max(known, default=None), len(set(known))),
            "blank": names.count("blank"), "duplicate": names.count("duplicate"), "truncated": names.count("truncated"),
            "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:])), "cost": costs[START]}, rows


def digest_of(rows) -> tuple[str, str]:
    """(audit, digest of the rows that stay)."""
    stay = (f"{role}:{text}" for _, role, text in rows if role is not None)
    return "".join(e for e, _, _ in rows), hashlib.sha256("\n".join(stay).encode()).hexdigest()


def _ordered(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order, by ranges; ``salt`` lets ranges cut equal rows."""
    rows = conversations.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("salt"))
    order = ["conv", "turn", "role", "hash", "salt"]
    rows = rows.withColumn("hash", F.xxhash64("text"))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text", F.spark_partition_id().alias("part"))


class _Out:
    """Rows of mixed kinds on their way out of a task."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows = schema, []

    def add(self, **values):
        self.rows.append(values)

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_pylist(rows, schema=self.schema)


def _first_pass(kind: str, whole_rows: bool, most_held: int):
    """Repairs conversations that lie inside a partition; hands on the rows of others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        held: list[tuple] = []  # the present conversation
        chars, place, now, started, passing = 0, 0, None, False, True

        def hand_on():
            nonlocal chars, place
            for turn, role, text in held:
                out.add(conv=now, part=part, place=place, turn=turn, role=role, text=text)
                place += 1
            held.clear()
            chars = 0

        def finish():
            counts, rows = repaired(*(list(x) for x in zip(*held)))
            if whole_rows:
                for i, (edit, role, text) in enumerate(rows):
                    out.add(conv=now, part=part, place=i, edit=edit, role=role, text=text)
            else:
                audit, digest = digest_of(rows)
                out.add(conv=now, audit=audit, digest=digest, **counts)
            held.clear()

        for batch in batches:
            if out is None:
                fields = [("conv", batch.schema.field("conv").type), *((c, pa.int64()) for c in COUNTS), *((c, pa.string()) for c in ("audit", "digest")),
                          ("part", pa.int32()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
                out = _Out(pa.schema(fields))
            for conv, turn, role, text, part in zip(*(batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "part"))):
                if not started or conv != now:
                    if started and passing:  # the partition's first conversation, or a long one, has ended
                        hand_on()
                    elif started:
                        finish()
                    passing, started, now, chars = not started, True, conv, 0
                held.append((turn, role, text))
                chars += len(text)
                if len(held) >= most_held or chars >= HELD_CHARS:
                    passing = True
                    hand_on()
            yield out.batch()
        if started:
            hand_on()  # the last conversation may go on in the next partition
            yield out.batch()

    return run, (f"conv {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
                 + ", audit string, digest string, part int, place long, turn long, role string, text string, edit string")


def _chunks(rows: DataFrame, kind: str) -> DataFrame:
    """One row for each (conversation, partition): codes, costs and counts."""
    blank = F.regexp_replace("text", SPACES, "") == ""
    first = rows.groupBy("conv", "role", "text").agg(F.min(F.struct("part", "place")).alias("at")).select(
        F.col("at.part").alias("part"), F.col("at.place").alias("place"), F.lit(True).alias("first"))
    last = F.substring(F.regexp_replace("text", SPACES + "$", ""), -1, 1)
    name = F.when(blank, "blank").when(F.col("first").isNull(), "duplicate").when(~last.isin(".", "!", "?"), "truncated").otherwise("")
    light = rows.join(first, ["part", "place"], "left").select("conv", "part", "place", "turn", F.substring("role", 1, 1).alias("initial"), name.alias("name"))

    def chunk(rows):
        rows = rows.sort_by("place")
        names, roles = rows["name"].to_pylist(), rows["initial"].to_pylist()
        codes = bytes(code_of({"blank": GONE, "duplicate": GONE, "truncated": TRUNCATED}.get(x, FINE), r) for x, r in zip(names, roles))
        turns = [t for t in rows["turn"].to_pylist() if t is not None]
        costs = [distances(codes, tuple(0 if s == out else _FAR for s in range(4)))[0] for out in range(4)]
        return pa.Table.from_pylist([{
            "conv": rows["conv"][0].as_py(), "part": rows["part"][0].as_py(), "start": rows["place"][0].as_py(), "codes": codes,
            "costs": [costs[out][s] for s in range(4) for out in range(4)], "low": min(turns, default=None), "high": max(turns, default=None),
            "different": len(set(turns)), "opens": roles[0], "closes": roles[-1], "blank": names.count("blank"), "duplicate": names.count("duplicate"),
            "truncated": names.count("truncated"), "illegal": sum(a + b not in LEGAL for a, b in zip(roles, roles[1:]))}], schema=pa.schema([
                ("conv", rows.schema.field("conv").type), ("part", pa.int32()), ("start", pa.int64()), ("codes", pa.binary()), ("costs", pa.list_(pa.int64())),
                ("low", pa.int64()), ("high", pa.int64()), ("different", pa.int64()), ("opens", pa.string()), ("closes", pa.string()),
                ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64())]))

    return written(light.groupBy("conv", "part").applyInArrow(
        chunk, f"conv {kind}, part int, start long, codes binary, costs array<long>, low long, high long, different long, opens string, closes string, "
        "blank long, duplicate long, truncated long, illegal long"), "conversation_chunks")


def _joined(chunks: DataFrame, kind: str) -> DataFrame:
    """Counts of each conversation of several chunks and, by chunk, the costs of leaving it."""
    def run(rows):
        rows = rows.sort_by("part")
        part, costs = rows["part"].to_pylist(), rows["costs"].to_pylist()
        leaving = [tuple(ENDS)]
        for matrix in reversed(costs):
            after = leaving[-1]
            leaving.append(tuple(min(_FAR, *(matrix[4 * s + out] + after[out] for out in range(4))) for s in range(4)))
        leaving = leaving[::-1]
        spans = [x for x in zip(rows["low"].to_pylist(), rows["high"].to_pylist(), rows["different"].to_pylist()) if x[0] is not None]
        # A turn at which two neighbouring chunks meet counts once.
        different = sum(x[2] for x in spans) - sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        seams = sum(a + b not in LEGAL for a, b in zip(rows["closes"].to_pylist(), rows["opens"].to_pylist()[1:]))
        counts = {c: sum(rows[c].to_pylist()) for c in ("blank", "duplicate", "truncated", "illegal")}
        counts |= {"gaps": turn_gaps(spans[0][0] if spans else None, spans[-1][1] if spans else None, different),
                   "illegal": counts["illegal"] + seams, "cost": leaving[0][START]}
        return pa.Table.from_pylist([{"conv": rows["conv"][0].as_py(), "part": p, "leaving": list(after), "is_first": p == part[0], **counts}
                                     for p, after in zip(part, leaving[1:])],
                                    schema=pa.schema([("conv", rows.schema.field("conv").type), ("part", pa.int32()), ("leaving", pa.list_(pa.int64())),
                                                      ("is_first", pa.bool_()), *((c, pa.int64()) for c in COUNTS)]))

    return written(chunks.drop("codes").groupBy("conv").applyInArrow(
        run, f"conv {kind}, part int, leaving array<long>, is_first boolean, " + ", ".join(f"{c} long" for c in COUNTS)), "conversation_costs")


def _traced(chunks: DataFrame, costs: DataFrame, kind: str) -> DataFrame:
    """(part, place, edits) of every row, and of one place more at a conversation's end."""
    ways = chunks.join(costs.select(F.col("conv").alias("c"), F.col("part").alias("p"), "leaving"),
                       F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select("conv", "part", "start", "codes", "leaving")

    def trace_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (codes, leaving) in enumerate(zip(batch.column("codes").to_pylist(), batch.column("leaving").to_pylist())):
                least = min(leaving)
                costs_of = distances(codes, tuple(x - least if x < _FAR else _FAR for x in leaving))[1]
                found = [trace(codes, costs_of, s) if s == START or block(_blocks(codes)[0], costs_of[0])[s] else ([], 0) for s in range(4)]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(i, 1) for c in ("conv", "part", "start")), pa.array([[f[0] for f in found]], pa.list_(pa.list_(pa.string()))),
                    pa.array([[f[1] for f in found]], pa.list_(pa.int64()))], ["conv", "part", "start", "edits", "after"])

    traced = written(ways.mapInArrow(trace_all, f"conv {kind}, part int, start long, edits array<array<string>>, after array<long>"), "chunk_traces")

    def entered(rows):
        rows, state, states = rows.sort_by("part"), START, []
        for after in rows["after"].to_pylist():
            states.append(state)
            state = after[state]
        ends = [None] * (len(states) - 1) + [LAST[state]]
        return pa.table({"part": rows["part"], "conv": rows["conv"], "state": pa.array(states, pa.int32()), "ending": pa.array(ends, pa.string())})

    entry = traced.select("conv", "part", "after").groupBy("conv").applyInArrow(entered, f"part int, conv {kind}, state int, ending string")
    entry = entry.select(F.col("conv").alias("c"), F.col("part").alias("p"), "state", "ending")
    mine = F.element_at("edits", F.col("state") + 1)
    plan = traced.join(entry, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).withColumn(
        "edits", F.when(F.coalesce("ending", F.lit("")) != "", F.concat(mine, F.array("ending"))).otherwise(mine))
    return plan.select("conv", "part", "start", F.posexplode("edits").alias("i", "edits")).select(
        "conv", "part", (F.col("start") + F.col("i")).alias("place"), "edits")


def _edited(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv, part, place, sub, edit, role, text) of spanning conversations."""
    plan = plan.select(F.col("conv").alias("c"), F.col("part").alias("p"), F.col("place").alias("at"), "edits")
    # The place after a conversation's last row is the next conversation's first, so ids are compared, too.
    met = plan.join(rows, (F.col("p") == F.col("part")) & (F.col("at") == F.col("place")) & F.col("c").eqNullSafe(F.col("conv")), "left")
    each = met.select(F.col("c").alias("conv"), F.col("p").alias("part"), F.col("at").alias("place"), "role", "text",
                      F.posexplode(F.split("edits", "")).alias("sub", "e")).filter("e <> ''")
    code = F.ascii("e")
    inserted, renamed = F.col("e").isin("u", "a"), F.col("e").isin("U", "A")
    role = F.when(code == ord("D"), None).when(F.lower("e") == "u", "user").when(F.lower("e") == "a", "assistant").otherwise(F.col("role"))
    return each.select("conv", "part", "place", "sub", F.when(inserted, "I").when(renamed, "R").otherwise(F.col("e")).alias("edit"),
                       role.alias("role"), F.when(inserted, "").when(code != ord("D"), F.col("text")).alias("text"))


def _digests(edited: DataFrame, kind: str) -> DataFrame:
    """(conv, audit, digest), each conversation's rows streamed in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, audit, sha, any_row, type_ = None, None, None, False, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([now], type_), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])], ["conv", "audit", "digest"])

        for batch in batches:
            type_ = batch.schema.field("conv").type
            for conv, edit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "edit", "role", "text"))):
                if audit is None or conv != now:
                    if audit is not None:
                        yield row()
                    now, audit, sha, any_row = conv, [], hashlib.sha256(), False
                audit.append(edit)
                if role is not None:
                    sha.update((("\n" if any_row else "") + role + ":" + text).encode())
                    any_row = True
        if audit is not None:
            yield row()

    rows = edited.repartition("conv").sortWithinPartitions("conv", "part", "place", "sub")
    return rows.mapInArrow(run, f"conv {kind}, audit string, digest string")


def _repair(conversations: DataFrame, columns: tuple[str, str, str, str], whole_rows: bool, held: int):
    """(first pass over all, counts of spanning conversations, their edits, type of ids)."""
    kind = conversations.schema[columns[0]].dataType.simpleString()
    run, schema = _first_pass(kind, whole_rows, held)
    passed = written(_ordered(conversations, *columns).mapInArrow(run, schema), "conversations")
    rows = passed.filter("part IS NOT NULL AND edit IS NULL").select("conv", "part", "place", "turn", "role", "text")
    chunks = _chunks(rows, kind)
    costs = _joined(chunks, kind)
    return passed, costs.filter("is_first"), _edited(rows, _traced(chunks, costs, kind)), kind


COLUMNS = ("conv_id", "turn", "role", "text")


def repair(conversations: DataFrame, columns: tuple[str, str, str, str] = COLUMNS, held: int = HELD) -> DataFrame:
    """(conv, part, place, sub, edit, role, text): every row with its edit, in order of
    the three numbers; deleted rows have no role and text."""
    passed, _, edited, _ = _repair(conversations, columns, True, held)
    inside = passed.filter("edit IS NOT NULL").select("conv", "part", "place", F.lit(0).alias("sub"), "edit", "role", "text")
    return inside.unionByName(edited)


def audits(conversations: DataFrame, columns: tuple[str, str, str, str] = COLUMNS, held: int = HELD) -> DataFrame:
    """(conv, counts of faults, cost, audit, digest) of every conversation with rows."""
    passed, costs, edited, kind = _repair(conversations, columns, False, held)
    digests = _digests(edited, kind).withColumnRenamed("conv", "c")
    spanning = costs.join(digests, F.col("conv").eqNullSafe(F.col("c"))).select("conv", *COUNTS, "audit", "digest")
    return passed.filter("part IS NULL").select("conv", *COUNTS, "audit", "digest").unionByName(spanning)


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the contract: rows dropped, emptied, cut, repeated or given to the user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"),
                                (F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20).alias("draw"))
    rows = rows.filter("draw <> 0").withColumns({
        "text": F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("draw") == 4, "user").otherwise(F.col("role")),
        "copies": F.when(F.col("draw") == 3, 2).otherwise(1)})
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def query(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    found = audits(damaged(conversations))
    ids = conversations.select("conv_id").distinct()
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in COUNTS}
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").withColumns(zeros).select(
        "conv_id", *COUNTS, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
