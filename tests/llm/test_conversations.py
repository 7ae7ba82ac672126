"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import conversations as C
from vigil.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       T.StructField("part", T.StringType()), T.StructField("a.b", T.LongType()),
                       T.StructField("key", T.LongType()), T.StructField("copy", T.LongType())])


def frame(spark, rows, partitions=4):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(partitions)


def brute(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of the rows
    (turn, role, text) of one conversation."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, kinds = set(), []
    for _, role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        kinds.append("blank" if not solid else "duplicate" if (role, text) in seen
                     else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    @lru_cache(maxsize=None)
    def best(i, last, inserts):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if inserts < 2:
            for x in set(follows[last]) & set("ua"):
                c, a, out = best(i, x, inserts + 1)
                found.append((2 + c, "I" + a, ((x, None), *out)))
        if i < len(rows):
            c, a, out = best(i + 1, last, 0)
            found.append((3 + c, "D" + a, out))
            if kinds[i] not in ("blank", "duplicate"):
                extra = kinds[i] == "truncated"
                first = rows[i][1][:1]
                if first and first in follows[last]:
                    c, a, out = best(i + 1, first, 0)
                    found.append((extra + c, "K" + a, ((None, i), *out)))
                for x in set(follows[last]) & set("ua"):
                    c, a, out = best(i + 1, x, 0)
                    found.append((2 + extra + c, "R" + a, ((x, i), *out)))
        return min(found, key=lambda f: f[:2], default=(10**9, "", ()))

    for i in range(len(rows), -1, -1):  # no deep recursion
        for last in follows:
            for k in (2, 1, 0):
                best(i, last, k)
    cost, audit, out = best(0, "", 0)
    lines = [(names[x] if x else rows[i][1]) + ":" + ("" if i is None else rows[i][2])
             for x, i in out]
    turns = [t for t, _, _ in rows if t is not None]
    firsts = [r[1][:1] for r in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def expected(rows):
    groups = {}
    for conv, *row in rows:
        groups.setdefault(conv, []).append(tuple(row))
    return sorted(((c, *brute(g)) for c, g in groups.items()), key=str)


def built(df, **options):
    return sorted(map(tuple, C.digests(C.repair(df, **options)).collect()), key=str)


def random_conversation(rnd, conv, n, noise):
    rows, roles = [], ["system"] + ["user", "assistant"] * n
    for turn in range(n):
        role = roles[turn]
        if rnd.random() < noise:
            role = rnd.choice(["user", "assistant", "system", "tool", "", None, "aide"])
        text = rnd.choice([f"text {rnd.randrange(n)}.", f"cut {turn}", " ", None, "same!", f"x{turn}?\n"])
        rows.append((conv, None if rnd.random() < 0.05 else turn + (turn > 5), role, text))
    return rows


@pytest.mark.parametrize("chunk_rows,noise", [(1, 0.5), (3, 0.2), (4096, 0.4)])
def test_random_conversations(spark, chunk_rows, noise):
    rnd = random.Random(chunk_rows)
    rows = [r for c in range(60) for r in random_conversation(rnd, c, rnd.randrange(1, 14), noise)]
    rows += [(None, 3, "user", "no id."), (None, None, "assistant", "none."), (99, 1, None, None),
             (98, None, "user", ""), (97, 5, "user", "x" * 100_000), (97, 5, "user", "x" * 100_000)]
    assert built(frame(spark, rows), chunk_rows=chunk_rows) == expected(rows)


def test_one_long_conversation_among_short_ones(spark):
    rnd = random.Random(5)
    rows = random_conversation(rnd, 1, 3000, 0.1) + [(c, 0, "user", "hi.") for c in range(2, 40)]
    assert built(frame(spark, rows), chunk_rows=50, chunk_bytes=2000) == expected(rows)


def test_guesses_are_mended_until_vectors_agree(spark):
    # after a lone user row every chunk of system rows keeps the first state open
    rows = [(1, t, "system", f"s{t}.") for t in range(40)] + [(1, 40, "user", "u.")]
    made = C._sorted_chunks(frame(spark, rows).select(
        F.lit("=1").alias("key"), "turn", "role", "text", F.lit(False).alias("ignored")), 4, 1 << 20)
    coded = C._coded(made.filter("not done"))
    state, passes = C.converge(coded)
    parts = sorted(state.collect(), key=lambda r: r.part)
    assert passes > 1
    for a, b in zip(parts, parts[1:]):
        assert a.end == b.start
    assert built(frame(spark, rows), chunk_rows=4) == expected(rows)


def test_ignored_rows_and_empty_tables(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "assistant", "yes."), (2, 0, "user", "gone.")]
    got = built(frame(spark, rows), ignored=F.col("conv_id") == 2)
    assert got == sorted([*expected(rows[:2]), (2, *brute([]))], key=str)
    assert built(frame(spark, [])) == []


def test_query_on_whole_conversations(spark):
    sf = "/root/testdata/sf0.001"
    rows = []
    convs = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    for r in convs:
        hit = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if hit == 1 else "".join(c for c in r.text if c not in ".!?") if hit == 2 else r.text
        rows += [(r.conv_id, r.turn, "user" if hit == 4 else r.role, text)] * {0: 0, 3: 2}.get(hit, 1)
    want = {r[0]: r for r in expected(rows)}
    got = sorted(map(tuple, QUERIES["op11_conversation_repair"](spark, sf).collect()))
    assert got == [want.get(c, (c, *brute([]))) for c in sorted({r.conv_id for r in convs})]
