"""Conversation repair against brute force, conversations within and across blocks."""

import hashlib
import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from martloom.llm import repair
from martloom.llm.queries import damaged

ROWS = "conv_id long, turn long, role string, text string, at string, fault string, digest string, ops string"
SPACE = " \t\n\x0b\x0c\r"


def brute_force(rows):
    """The contract, one conversation, rows as (turn, role, text): recursion over every edit."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    faults, seen = [], set()
    for _, role, text in rows:
        left = text.rstrip(SPACE)
        faults.append("blank" if not left.lstrip(SPACE) else "duplicate" if (role, text) in seen
                      else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))

    def legal(initials):
        body = initials[1:] if initials[:1] == "s" else initials
        return not initials or (bool(body) and body == "ua" * (len(body) // 2))

    def may_go_on(initials):
        body = initials[1:] if initials[:1] == "s" else initials
        return body == ("ua" * len(body))[: len(body)]

    @lru_cache(maxsize=None)
    def best(at, initials, inserts):
        """Least (cost, audit, lines) from row ``at`` on; only the last state of ``initials`` matters."""
        options = []
        if at == len(rows) and legal(initials):
            options.append((0, "", ()))
        if inserts < 2:
            for role in ("user", "assistant"):
                if may_go_on(initials + role[0]):
                    c, a, o = best(at, short(initials + role[0]), inserts + 1)
                    options.append((c + 2, "I" + a, (role + ":", *o)))
        if at < len(rows):
            _, role, text = rows[at]
            c, a, o = best(at + 1, initials, 0)
            options.append((c + 3, "D" + a, o))
            if faults[at] not in ("blank", "duplicate"):
                more = 1 if faults[at] == "truncated" else 0
                for letter, new, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if new and may_go_on(initials + new[0]):
                        c, a, o = best(at + 1, short(initials + new[0]), 0)
                        options.append((c + price + more, letter + a, (f"{new}:{text}", *o)))
        return min(options) if options else (10**9, "", ())

    def short(initials):
        head, body = ("s", initials[1:]) if initials[:1] == "s" else ("", initials)
        return head + (body if len(body) < 4 else body[: 2 + len(body) % 2])

    cost, audit, lines = best(0, "", 0)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [(a[1][:1], b[1][:1]) for a, b in zip(rows, rows[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum("".join(p) not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def check(spark, rows, block):
    df = spark.createDataFrame([(*r, "a", "f", "d", "o") for r in rows], ROWS)
    got = {r[0]: tuple(r)[1:] for r in repair.repair(df, df, block=block).collect()}
    want = {c: brute_force([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def random_rows(seed, conversations, most):
    rng = random.Random(seed)
    texts = ["Hi.", "Go on!", "What?", "so then", "Well. and", "", " \t", None, "Done.\n", "x"]
    return [(c, rng.choice([None, 0, 1, 2, 3, 4, 9]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]),
             rng.choice(texts) if rng.random() < 0.5 else f"Said {rng.random()}{rng.choice(['.', '!', ''])}")
            for c in [*range(conversations), None] for _ in range(rng.randint(1, most))]


@pytest.mark.parametrize("block", [1, 2, 3, 4096])
def test_equals_brute_force(spark, block):
    check(spark, random_rows(block, 25, 7), block)


def test_long_conversation_over_many_blocks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), f"Text {t}" + rng.choice([".", ""])) for t in range(120)]
    check(spark, rows + random_rows(6, 3, 4), 7)


def test_defined_cases(spark):
    said = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, None, "assistant", "b" * 100_000 + "."), (2, 5, None, None)]
    df = spark.createDataFrame([(*r, "a", "f", "d", "o") for r in said], ROWS)
    others = spark.createDataFrame([(7,), (7,), (None,)], "conv_id long")
    got = {r.conv_id: r for r in repair.repair(df, others.unionByName(df.select("conv_id"))).collect()}
    assert set(got) == {1, 2, 7, None}
    nothing = hashlib.sha256(b"").hexdigest()
    for conv in (7, None):
        assert tuple(got[conv])[1:] == (0, 0, 0, 0, 0, 0, "", nothing)
    assert (got[2].blank, got[2].audit, got[2].repaired_sha256) == (1, "D", nothing)
    assert tuple(got[1])[1:] == brute_force([r[1:] for r in said[:3]])
    assert repair.repair(df.limit(0), df.limit(0)).collect() == []


def test_damage_is_by_crc32(spark):
    import zlib

    rows = [(c, t, r, f"One. Two! {c}") for c in range(40) for t, r in ((0, "user"), (1, "assistant"), (None, None))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        fate = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if fate == 4 else r or " ", "" if fate == 1 else x.replace(".", "").replace("!", "") if fate == 2 else x)
        want += [] if fate == 0 else [row, row] if fate == 3 else [row]
    key = lambda r: tuple((v is not None, v or 0) if i < 2 else v for i, v in enumerate(r))
    assert sorted(map(tuple, damaged(df).collect()), key=key) == sorted(want, key=key)


def test_blocks_bound_what_a_task_holds(spark):
    df = spark.createDataFrame([(1, t, "user", f"{t}.") for t in range(50)], "conv_id long, turn long, role string, text string")
    blocks = repair._with_neighbours(repair.numbered_rows(repair.slim_rows(df)), 8).groupBy("block").agg(F.count("*").alias("n"))
    assert max(r.n for r in blocks.collect()) <= 10
