"""Conversation repair against a search over all repairs, cheapest and least audit first."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import conversation_repair as R

WHITE = " \t\n\v\f\r"
NAME = {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string, conv string, part string, place string, edit string"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, rows that stay): states in order of cost, then audit."""
    found = faults(rows)
    heap, done, ends = [(0, "", 0, "", ())], set(), []
    while heap and not (ends and heap[0][0] > min(ends)[0]):
        cost, audit, i, last, stay = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            ends.append((cost, audit, stay))
        following = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 5, audit + "I", i, following, stay + ((NAME[following], ""),)))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, stay))
            if found[i] in ("", "truncated"):
                more = 5 if found[i] else 0
                if role[:1] == following or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], stay + ((role, text),)))
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, following, stay + ((NAME[following], text),)))
    return min(ends)


def hash_of(text):
    x = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return x - (1 << 64) if x >= 1 << 63 else x


def model(rows):
    """Results by conversation, from (conv, turn, role, text) rows."""
    by, out = {}, {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in by.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hash_of(r[2])))
        cost, audit, stay = cheapest(own)
        found, turns = faults(own), [t for t, _, _ in own if t is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in stay).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    out = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.choice([1, 2, 5, 9, 40])):
            role = rnd.choice(["user", "assistant"] * 6 + ["system", "tool", "", "User", "usher", None])
            text = rnd.choice(["Yes.", "No!", "And so", " \t\n", "", None, "Why?\n ", f"line {rnd.random()}.", f"cut {rnd.random()}", "é" * 50 + "."])
            out.append((conv, rnd.choice([turn, turn, turn, turn * 3, None]), role, text))
    out += [(7, 3, "user", "the same."), (7, 3, "user", "the same."), (7, 3, "assistant", "a tie."), (7, 3, "assistant", "another tie.")] * 3
    out += [(99, k, rnd.choice(["user", "assistant", "system"]), f"very long {k % 50}." if k % 7 else "cut") for k in range(400)]
    rnd.shuffle(out)
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("held", [1, 7, R.HELD])
def test_audits_equal_the_search(spark, rows, held):
    got = {r[0]: tuple(r)[1:] for r in R.audits(frame(spark, rows), held=held).collect()}
    assert got == model(rows)


def test_conversations_over_many_partitions(spark, rows):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = {r[0]: tuple(r)[1:] for r in R.audits(frame(spark, rows), held=3).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got == model(rows)


@pytest.mark.parametrize("held", [2, R.HELD])
def test_rows_with_edits_give_the_digest(spark, rows, held):
    by = {}
    for r in R.repair(frame(spark, rows), held=held).collect():
        by.setdefault(r["conv"], []).append(((r["part"], r["place"], r["sub"]), r["edit"], r["role"], r["text"]))
    want = model(rows)
    assert set(by) == set(want)
    for conv, own in by.items():
        own.sort(key=lambda x: x[0])
        stay = [f"{role}:{text}" for _, _, role, text in own if role is not None]
        assert ("".join(e for _, e, _, _ in own), hashlib.sha256("\n".join(stay).encode()).hexdigest()) == want[conv][-2:]


def test_auction_prices_are_distances():
    """Blocks of any size give the costs and audits of the search."""
    rnd = random.Random(5)
    for _ in range(300):
        rows = [(k, rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice(["a.", "b.", "c", "", f"{k}."])) for k in range(rnd.randint(0, 40))]
        counts, edited = R.repaired([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])
        cost, audit, stay = cheapest(rows)
        assert counts["cost"] == cost
        assert R.digest_of(edited) == (audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in stay).encode()).hexdigest())


def test_query_damages_and_returns_every_conversation(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    hurt = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            hurt += [(conv, turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    want = {r[0]: none for r in rows} | model(hurt)
    got = R.query(spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert got.count() == len(want)


def test_empty_table_and_string_ids(spark):
    empty = frame(spark, [(0, 1, "user", "x.")]).limit(0)
    assert R.audits(empty).count() == 0 and R.repair(empty).count() == 0
    named = spark.createDataFrame([("a", 1, "user", "Hi."), ("a", 2, "assistant", "Hello."), ("b", 1, "user", "Hi.")], "conv_id string, turn int, role string, text string")
    assert {r["conv"]: r["audit"] for r in R.audits(named).select("conv", "audit").collect()} == {"a": "KK", "b": "D"}
    assert R.audits(named.select(F.col("conv_id").alias("text"), F.col("turn").alias("role"), F.col("role").alias("turn"), F.col("text").alias("conv_id")),
                    ("text", "role", "turn", "conv_id")).count() == 2
