"""Conversation repair against a plain search over all rows and states."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from gridseries.llm import repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: 2, 1: 2, 3: 2, 2: 3}
NAME = {2: "user", 3: "assistant"}


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role, text = ("user" if code == 4 else role), ("" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text)
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def with_insertions(best):
    for _ in range(3):
        for q, (cost, audit, turns) in list(best.items()):
            offer(best, NEXT[q], (cost + 5, audit + "I", (*turns, (NAME[NEXT[q]], ""))))
    return best


def offer(best, state, weight):
    if state not in best or weight[:2] < best[state][:2]:
        best[state] = weight


def expected(rows, text_order):
    """The contract's columns of one conversation, by dynamic programming over its rows."""
    rows = sorted(after_damage(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], text_order[r[2]]))
    seen, faults, best = set(), [], {0: (0, "", ())}
    for _, role, text in rows:
        shown = text.rstrip(SPACE)
        faults.append("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        for q, (cost, audit, turns) in with_insertions(best).items():
            offer(new, q, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if role[:1] == NAME[NEXT[q]][0]:
                offer(new, NEXT[q], (cost + more, audit + "K", (*turns, (role, text))))
            if role[:1] == "s" and q == 0:
                offer(new, 1, (cost + more, audit + "K", (*turns, (role, text))))
            offer(new, NEXT[q], (cost + 1 + more, audit + "R", (*turns, (NAME[NEXT[q]], text))))
        best = new
    best = with_insertions(best)
    cost, audit, turns = min((best[q] for q in (0, 3) if q in best), key=lambda w: w[:2])
    dated = {t for t, _, _ in rows if t is not None}
    gaps = max(dated) - min(dated) + 1 - len(dated) if dated else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)


def run(spark, df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    texts = {x for r in rows for _, _, x in after_damage([r])}
    hashed = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.xxhash64("text").alias("h"))
    order = {r.text: r.h for r in hashed.collect()}
    conversations = {}
    for r in rows:
        conversations.setdefault(r[0], []).append(r)
    got = {r[0]: tuple(r[1:]) for r in repair.repair_conversations(df, "conv_id", "turn", "role", "text").collect()}
    assert got == {c: expected(r, order) for c, r in conversations.items()}
    return got


def odd_rows(seed):
    rnd = random.Random(seed)
    pick = lambda *x: rnd.choice(x)
    for conv in range(200):
        for _ in range(rnd.randrange(14)):
            turn = None if rnd.random() < 0.1 else rnd.randrange(6)
            yield None if rnd.random() < 0.05 else conv, turn, pick("user", "assistant", "system", "tool", "", None, "sys"), pick(None, "", " ", "ok.", "hm", "yes! ", "no\x1c", "why?\n", "\t\n")


def test_given_and_odd_conversations(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").withColumn("conv_id", F.col("conv_id") + 1000)
    df = given.union(spark.createDataFrame(list(odd_rows(3)), SCHEMA)).withColumn("copies", F.lit(9)).withColumn("cost", F.lit("clash"))
    assert len(run(spark, df)) > 200


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_long_conversation_is_split_over_tasks(spark, many_tasks):
    rnd = random.Random(5)
    rows = [(1, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["ok.", "hm"]) + str(rnd.randrange(200)) * rnd.randrange(2)) for t in range(3000)]
    rows += [(2, 7, "user", "same.")] * 700 + [(3, t, "user", "x") for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    run(spark, df)
    parts = repair._parts(repair._ordered(repair.damaged(df, "conv_id", "turn", "role", "text")))
    assert parts.where("conv_id = 1").count() > 1


def test_dropped_rows_and_empty_table(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "gone.")], SCHEMA)
    assert run(spark, df)[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.repair_conversations(df.limit(0), "conv_id", "turn", "role", "text").count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_joined_stretches_equal_the_whole(size):
    rnd = random.Random(size)
    for _ in range(60):
        symbols = "".join(rnd.choice("suaoSUAOx") for _ in range(rnd.randrange(12)))
        parts = [repair.table(symbols[i : i + size]) for i in range(0, len(symbols), size)]
        assert repair.finished(repair.joined_all(parts)) == repair.solved(symbols)


def test_audits_are_the_least_of_all_edit_strings():
    """Every string over K, R, D, I of up to six letters, tried on rows of every kind."""
    strings = ["".join(s) for n in range(7) for s in itertools.product("DIKR", repeat=n)]
    for symbols in map("".join, itertools.product("suaUx", repeat=2)):
        least = None
        for audit in strings:
            if len(audit.replace("I", "")) != len(symbols):
                continue
            state, cost, at, good = 0, 0, 0, True
            for letter in audit:
                symbol = "" if letter == "I" else symbols[at]
                at += letter != "I"
                cost += {"K": 0, "R": 1, "D": 2, "I": 5}[letter] + 5 * (letter in "KR" and symbol.isupper())
                if letter == "D":
                    continue
                if letter == "I" or letter == "R" and symbol != "x":
                    state = NEXT[state]
                elif letter == "K" and symbol == "s" and state == 0:
                    state = 1
                elif letter == "K" and symbol != "x" and symbol.lower() == NAME[NEXT[state]][0]:
                    state = NEXT[state]
                else:
                    good = False
                    break
            if good and state in (0, 3):
                least = min(least or (cost, audit), (cost, audit))
        assert repair.solved(symbols) == least
