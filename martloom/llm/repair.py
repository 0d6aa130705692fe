"""Conversation structure repair at least cost, ties to the least audit string.

A repaired conversation has the role initials ``(s?(ua)+)?``. Each row is kept,
re-roled or deleted, and empty turns may be inserted; the states of the
grammar are nothing yet, after s, after u, after a. Three steps:

1. **Cost DP.** The least cost from every (row, state) to the end of its conversation.
2. **Ranking.** Among optimal arcs, nodes are ranked by the first 1, 2, 4, ...
   letters of their least audit, each length from the ranks and pointers of
   the one before. An arc's rank is (its letter, the rank of its target).
3. **Path.** Doubled pointers of the best arcs give all nodes of each path at once.

Rows are numbered over the whole table and cut into blocks of consecutive
rows, so a task holds a bounded number whatever a conversation's length. A
conversation that crosses blocks is linked by doubling over blocks: costs pass
from right to left as (min, +) matrices of the four states, then the states at
which blocks are entered from left to right. Texts stay out of all this; they
meet the edits once, in a stream sorted by conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import checkpointed
from martloom.operators.keys import assign_surrogate_keys

# Costs of the edits, and the grammar over states 0 nothing yet, 1 after s, 2 after u, 3 after a.
RELABEL, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
NEXT = (2, 2, 3, 2)                    # the state after the user or assistant turn that may follow
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
FINAL = (0, None, None, 0)             # states a conversation may end in
LETTERS = "DIKR"                       # in ASCII order
STATES = 4
FAR = 1 << 50                          # no way
BLOCK = 4096
WORD = "[^\\x20\\x09-\\x0D]"

FINE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
OUTCOMES = "block long, entry int, conv_id long, at long, ops string, illegal int, cost long, leaves int"
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
_AUDIT = str.maketrans("uaUA", "IIRR")  # ops: u, a inserted; U, A re-roled; K kept; D deleted
_ROLE = {"u": "user", "a": "assistant", "U": "user", "A": "assistant"}


def text_faults(text: Column) -> Column:
    """BLANK, CUT (the last character that is no white space ends no sentence) or FINE."""
    return F.when(~text.rlike(WORD), BLANK).when(~text.rlike("[.!?][\\x20\\x09-\\x0D]*\\z"), CUT).otherwise(FINE)


def slim_rows(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, fault`` without the text; NULL roles and texts are one space."""
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")).select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("digest"), text_faults(F.col("text")).alias("fault"))


def numbered_rows(slim: DataFrame) -> DataFrame:
    """Rows with ``at``, dense over the table in conversation order, and their first fault.

    Within a conversation: by turn, NULLs first, then role, then digest. A
    repeat is found against the first row of its (conversation, role, digest),
    an aggregation combined before the shuffle.
    """
    tied = slim.withColumn("tie", F.monotonically_increasing_id())  # spreads equal rows over the ranges
    rows = assign_surrogate_keys(tied, ["conv_id", "turn", "role", "digest", "tie"], "at", -1).keyed.drop("tie")
    said = ["conv_id", "role", "digest"]
    first = rows.groupBy(*said).agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    repeats = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                        & (F.col("digest") == F.col("d")), "left")
    fault = F.when((F.col("fault") != BLANK) & (F.col("at") > F.col("first")), DUPLICATE).otherwise(F.col("fault"))
    return checkpointed(repeats.select("at", "conv_id", "turn", "role", "digest", fault.alias("fault")))


def _with_neighbours(rows: DataFrame, block: int) -> DataFrame:
    """Rows by block, the row before and the row after each block included."""
    at, home = F.col("at"), F.floor(F.col("at") / block).cast("bigint")
    homes = F.array_compact(F.array(
        home, F.when(at % block == block - 1, home + 1), F.when((at % block == 0) & (at > 0), home - 1)))
    spread = rows.select("at", "conv_id", F.substring("role", 1, 1).alias("initial"), "fault", F.explode(homes).alias("block"))
    last = rows.agg(F.floor(F.max("at") / block).cast("bigint")).first()[0]
    return spread.filter(F.col("block") <= F.lit(last))  # no block of a neighbour alone


class Block:
    """Rows of one block in order, cut into its conversations."""

    def __init__(self, table: pa.Table, number: int, size: int) -> None:
        table = table.sort_by("at")
        at = table["at"].to_numpy()
        ids = table["conv_id"].combine_chunks()
        known = np.asarray(ids.is_valid())
        value = ids.fill_null(0).to_numpy()
        initial = np.array(table["initial"].to_pylist(), dtype=object)
        same = (value[1:] == value[:-1]) & (known[1:] == known[:-1])
        inside = np.flatnonzero(at // size == number)
        a, b = int(inside[0]), int(inside[-1]) + 1
        self.from_left = bool(a and same[a - 1])
        self.to_right = bool(b < len(at) and same[b - 1])
        pairs = [bool(s) and x + y not in ("su", "ua", "au") for s, x, y in zip(same, initial[:-1], initial[1:], strict=True)]
        self.illegal = np.array([0, *pairs], np.int64)[a:b]
        self.at, self.ids = at[a:b], ids[a:b]
        self.fault = table["fault"].to_numpy()[a:b]
        kinds = {k: i for i, k in enumerate(KEPT)}
        self.kind = np.array([kinds.get(x, len(kinds)) for x in initial[a:b]], np.int64)
        self.cuts = np.concatenate([[0], np.flatnonzero(~same[a : b - 1]) + 1, [b - a]]).astype(np.int64)


def row_arcs() -> tuple[np.ndarray, np.ndarray]:
    """Targets and costs of the arcs of a row: [kind, rule, state, letter]; rules 0 fine, 1 cut, 2 must go."""
    target = np.zeros((len(KEPT) + 1, 3, STATES, len(LETTERS)), np.int64)
    cost = np.full(target.shape, FAR, np.int64)
    for kind, kept in enumerate([*KEPT.values(), (None,) * STATES]):
        for state in range(STATES):
            for rule in range(3):
                target[kind, rule, state, 0], cost[kind, rule, state, 0] = state, DELETE
                if rule == 2:
                    continue
                more = TRUNCATED if rule == 1 else 0
                if kept[state] is not None:
                    target[kind, rule, state, 2], cost[kind, rule, state, 2] = kept[state], more
                target[kind, rule, state, 3], cost[kind, rule, state, 3] = NEXT[state], RELABEL + more
    return target, cost


TARGET, COST = row_arcs()
RULE = np.array([0, 2, 2, 1])  # of FINE, BLANK, DUPLICATE, CUT


def inserted(costs: np.ndarray) -> np.ndarray:
    """Costs of [..., state] where turns may be inserted first."""
    out = costs
    for _ in range(2):
        out = np.minimum(out, INSERT + out[..., list(NEXT)])
    return np.minimum(out, FAR)


ENDED = inserted(np.array([FAR if f is None else f for f in FINAL], np.int64))


def step(kind: np.ndarray, fault: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Least costs before rows, from those after them ([row, state])."""
    target, cost = TARGET[kind, RULE[fault]], COST[kind, RULE[fault]]
    rows = np.arange(len(kind))[:, None, None]
    return inserted((cost + after[rows, target]).min(axis=2))


def segment_matrix(kind: np.ndarray, fault: np.ndarray) -> np.ndarray:
    """Least cost from each state before the rows to each state after them, inserts before rows included."""
    out = np.where(np.eye(STATES, dtype=bool), 0, FAR).astype(np.int64)  # [state after, state before]
    for k, f in zip(kind[::-1], fault[::-1], strict=True):
        out = step(np.full(STATES, k), np.full(STATES, f), out)
    return out.T


def node_costs(block: Block, right: np.ndarray | None) -> np.ndarray:
    """Least cost of [row + conversation number, state]: every conversation has a node row more than rows.

    All conversations of the block step back together, the longest first.
    ``right`` is the cost at the block's end where its last conversation goes on.
    """
    begin, end = block.cuts[:-1], block.cuts[1:]
    costs = np.zeros((len(block.at) + len(begin), STATES), np.int64)
    segment = np.arange(len(begin))
    costs[end + segment] = ENDED
    if right is not None:
        costs[-1] = right
    order = np.argsort(begin - end, kind="stable")
    length = (end - begin)[order]
    for back in range(1, int(length[0]) + 1):
        active = order[: np.searchsorted(-length, -back, "right")]
        row = end[active] - back
        costs[row + active] = step(block.kind[row], block.fault[row], costs[row + active + 1])
    return costs


def best_arcs(block: Block, costs: np.ndarray, goes_on: bool) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of every node: the letter of its best arc (-1 at an end), the steps to its end, and doubled pointers."""
    n_nodes = costs.size
    begin, end = block.cuts[:-1], block.cuts[1:]
    row_of = np.full(len(costs), -1)
    node_row = np.arange(len(block.at)) + np.repeat(np.arange(len(begin)), end - begin)
    row_of[node_row] = np.arange(len(block.at))
    target = np.full((len(costs), STATES, len(LETTERS)), -1)
    weight = np.full(target.shape, 2 * FAR)
    rule = RULE[block.fault]
    target[node_row] = TARGET[block.kind, rule] + STATES * (node_row[:, None, None] + 1)
    weight[node_row] = COST[block.kind, rule]
    target[:, :, 1] = STATES * np.arange(len(costs))[:, None] + np.array(NEXT)
    weight[:, :, 1] = INSERT
    ends = row_of < 0
    target[ends, :, 0] = target[ends, :, 2] = target[ends, :, 3] = 0
    if goes_on:
        weight[-1] = 2 * FAR  # the path goes on in the next block
    flat = costs.reshape(-1)
    optimal = (weight + flat[target] == costs[:, :, None]).reshape(n_nodes, -1) & (flat < FAR)[:, None]
    target = target.reshape(n_nodes, -1)
    alive = optimal.any(axis=1)
    letter = np.where(alive, optimal.argmax(axis=1), -1)  # no two arcs of a node share a letter
    here = np.arange(n_nodes)
    pointer = np.where(alive, target[here, letter], here)
    pointers, steps, rank = [pointer], alive.astype(np.int64), letter + 1
    while (pointers[-1] != pointers[-1][pointers[-1]]).any():
        p = pointers[-1]
        steps = steps + steps[p]
        rank = np.unique(rank * (n_nodes + 8) + rank[p], return_inverse=True)[1]
        pointers.append(p[p])
    arc_rank = np.where(optimal, np.arange(len(LETTERS)) * (rank.max() + 2) + rank[target], np.iinfo(np.int64).max)
    letter = np.where(alive, arc_rank.argmin(axis=1), -1)
    return letter, steps, pointers


def paths(starts: np.ndarray, steps: np.ndarray, pointers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(which start, node) of all nodes with an arc on the paths of ``starts``, in order."""
    which = np.repeat(np.arange(len(starts)), steps[starts])
    place = np.arange(len(which)) - np.repeat(np.cumsum(steps[starts]) - steps[starts], steps[starts])
    node = starts[which]
    for k, p in enumerate(pointers):
        node = np.where((place >> k) & 1 == 1, p[node], node)
    return which, node


def block_outcomes(block: Block, number: int, right: np.ndarray | None) -> pa.Table:
    """The edits of every row, for each state a conversation may enter the block in (-1: it begins here)."""
    goes_on = right is not None
    costs = node_costs(block, right)
    letter, steps, pointers = best_arcs(block, costs, goes_on)
    begin = block.cuts[:-1]
    segments = np.arange(len(begin))
    entered = [(0, s, s) for s in range(STATES)] if block.from_left else [(0, -1, 0)]
    plan = entered + [(g, -1, 0) for g in segments[1:]]
    starts = np.array([STATES * (begin[g] + g) + s for g, _, s in plan], np.int64)
    which, node = paths(starts, steps, pointers)
    at_node, state, what = node // STATES, node % STATES, letter[node]
    segment = np.array([g for g, _, _ in plan])[which]
    row = np.minimum(at_node - segment, block.cuts[1:][segment] - 1)  # what is inserted at the end goes with the last row
    following = np.array(NEXT)[state] == 2
    ops = np.where(what == 0, "D", np.where(what == 1, np.where(following, "u", "a"),
                                            np.where(what == 2, "K", np.where(following, "U", "A"))))
    cut = (block.fault[row] == CUT) & (what >= 2)
    price = np.array([DELETE, INSERT, 0, RELABEL])[what] + TRUNCATED * cut
    edge = np.flatnonzero(np.diff(np.concatenate([[-1], which * (len(block.at) + 1) + row])))
    joined = np.split(ops, edge[1:])
    rows, entry = row[edge], np.array([e for _, e, _ in plan])[which[edge]]
    leaves = np.full(len(edge), -1)
    if goes_on:
        last = pointers[-1][starts] % STATES
        final = (rows == len(block.at) - 1)
        leaves[final] = last[which[edge[final]]]
    columns = {
        "block": pa.array(np.full(len(edge), number), pa.int64()), "entry": pa.array(entry, pa.int32()),
        "conv_id": block.ids.take(pa.array(rows)), "at": pa.array(block.at[rows], pa.int64()),
        "ops": pa.array(["".join(o) for o in joined], pa.string()), "illegal": pa.array(block.illegal[rows], pa.int32()),
        "cost": pa.array(np.add.reduceat(price, edge) if len(edge) else price, pa.int64()),
        "leaves": pa.array(leaves, pa.int32())}
    return pa.table(columns)


def follow(links: DataFrame, compose: str) -> DataFrame:
    """Every chain of ``id, link, value`` composed to its head by doubling; ``link`` is NULL at a head.

    The SQL expression ``compose`` combines ``value`` with ``other``, the value of the linked row.
    A round doubles the reach of every row; rounds follow the longest chain.
    """
    links = checkpointed(links)
    while not links.filter("link IS NOT NULL").isEmpty():
        other = links.select(F.col("id").alias("to"), F.col("link").alias("beyond"), F.col("value").alias("other"))
        links = checkpointed(links.join(other, F.col("link") == F.col("to"), "left").select(
            "id", F.when(F.col("link").isNotNull(), F.expr(compose)).otherwise(F.col("value")).alias("value"),
            F.col("beyond").alias("link")))
    return links


MIN_PLUS = f"""transform(sequence(0, 15), k -> least({FAR}L, array_min(transform(sequence(0, 3),
    j -> value[(k div 4) * 4 + j] + other[j * 4 + k % 4]))))"""
THEN = "transform(other, s -> value[s])"


def outcomes(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, at, ops, illegal, cost`` of every numbered row on the least path of its conversation."""
    blocked = checkpointed(_with_neighbours(rows, block))

    def matrix(key: tuple, table: pa.Table) -> pa.Table:
        b = Block(table, key[0].as_py(), block)
        whole = len(b.cuts) == 2 and b.to_right
        value = segment_matrix(b.kind[: b.cuts[1]], b.fault[: b.cuts[1]]) if b.from_left else None
        return pa.table({"id": [key[0].as_py()], "link": pa.array([key[0].as_py() + 1 if whole else None], pa.int64()),
                         "value": pa.array([None if value is None else value.reshape(-1).tolist()], pa.list_(pa.int64()))})

    measured = blocked.groupBy("block").applyInArrow(matrix, "id long, link long, value array<bigint>")
    suffix = follow(measured.filter("value IS NOT NULL"), MIN_PLUS)
    ended = F.array(*[F.lit(int(c)).cast("bigint") for c in ENDED])
    costs = suffix.select((F.col("id") - 1).alias("block"), F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda s: F.least(F.lit(FAR), F.array_min(F.zip_with(
            F.slice("value", s * 4 + 1, 4), ended, lambda a, b: a + b)))).alias("right"))

    def ranked(key: tuple, table: pa.Table, right: pa.Table) -> pa.Table:
        at_end = np.array(right["right"][0].as_py(), np.int64) if right.num_rows else None
        number = key[0].as_py()
        return block_outcomes(Block(table, number, block), number, at_end)

    found = checkpointed(blocked.groupBy("block").cogroup(costs.groupBy("block")).applyInArrow(ranked, OUTCOMES))
    # the state in which a block's first conversation enters it: the one its part in the block before leaves
    left = found.filter("leaves >= 0").groupBy((F.col("block") + 1).alias("id")).agg(
        F.min("entry").alias("least"), F.max("leaves").alias("one"),
        F.array_sort(F.collect_list(F.struct("entry", "leaves"))).alias("by_entry"))  # four rows at most
    left = left.select("id", F.when(F.col("least") >= 0, F.col("id") - 1).alias("link"),
                       F.when(F.col("least") >= 0, F.transform("by_entry", lambda x: x["leaves"]))
                       .otherwise(F.array_repeat("one", STATES)).alias("value"))
    entries = follow(left, THEN).select(F.col("id").alias("block"), F.col("value")[0].alias("entry"))
    columns = ["conv_id", "at", "ops", "illegal", "cost"]
    begun, crossing = found.filter("entry < 0"), found.filter("entry >= 0")
    return begun.select(*columns).unionByName(crossing.join(entries, ["block", "entry"]).select(*columns))


class Repaired:
    """Running result of one conversation, from its texts and edits in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.texts, self.key = conv_id, hashlib.sha256(), None
        self.counts = {BLANK: 0, DUPLICATE: 0, CUT: 0, FINE: 0}
        self.turns, self.low, self.high = 0, None, None
        self.illegal = self.cost = self.lines = 0
        self.audit: list[str] = []

    def line(self, role: str, text: str) -> None:
        self.texts.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def add(self, turn: int | None, role: str | None, digest: str | None, text: str | None, fault: int | None,
            ops: str | None, illegal: int, cost: int) -> None:
        if text is not None:
            self.key, self.text = (turn, role, digest), text
        if ops is None:
            return
        if (turn, role, digest) != self.key:
            raise ValueError(f"conversation {self.conv_id}: an edit without its text")
        if turn is not None and turn != self.high:
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        self.counts[fault] += 1
        self.illegal += illegal
        self.cost += cost
        self.audit.append(ops.translate(_AUDIT))
        for op in ops:
            if op == "K":
                self.line(role, self.text)
            elif op in "UA":
                self.line(_ROLE[op], self.text)
            elif op != "D":
                self.line(_ROLE[op], "")

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv_id, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[CUT], self.illegal, self.cost,
                "".join(self.audit), self.texts.hexdigest())


def _results(rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in RESULT.split(", ")]
    return pa.record_batch([pa.array(c, pa.int64() if t == "long" else pa.string())
                            for c, (_, t) in zip(zip(*rows, strict=True), fields, strict=True)], names=[n for n, _ in fields])


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = None
    names = ("turn", "role", "digest", "text", "fault", "ops", "illegal", "cost")
    for batch in batches:
        done = []
        for conv_id, *values in zip(*(batch.column(c).to_pylist() for c in ("conv_id", *names)), strict=True):
            if state is None or conv_id != state.conv_id:
                if state is not None:
                    done.append(state.row())
                state = Repaired(conv_id)
            state.add(*values)
        if done:
            yield _results(done)
    if state is not None:
        yield _results([state.row()])


def edits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The edits of every row: ``conv_id, turn, role, digest, at, fault, ops, illegal, cost``.

    ``rows`` needs ``conv_id, turn, role, text``. ``ops`` is in order: ``u`` or
    ``a`` an inserted turn, ``K`` kept, ``D`` deleted, ``U`` or ``A`` re-roled
    to user or assistant; what follows the last row goes with it.
    """
    numbered = numbered_rows(slim_rows(rows))
    found = outcomes(numbered, block).drop("conv_id")
    return numbered.join(found, "at")


def repair(rows: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations``: faults of its ``rows``,
    the cheapest repair's cost and audit (``D``elete, ``I``nsert, ``K``eep,
    ``R``erole; ties to the ASCII-least) and a digest of the repaired turns.

    Other columns are ignored. NULL roles and texts are one space; NULL turns
    come first and make no gap; rows with a NULL ``conv_id`` are one
    conversation; rows of one turn follow by role, then digest; equal rows are
    repeats. Texts are hashed whole. A conversation without rows has zeros, an
    empty audit and the digest of nothing; an empty table gives no rows.
    """
    texts = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    none = {c: F.lit(None) for c in ("turn", "role", "digest", "text", "fault", "ops")}
    empty = {"at": F.lit(-1).cast("bigint"), "illegal": F.lit(0), "cost": F.lit(0).cast("bigint")}
    parts = [
        conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().withColumns({**none, **empty}),
        texts.withColumns({"digest": F.sha2("text", 256), "fault": none["fault"], "ops": none["ops"], **empty}),
        edits(rows, block).withColumn("text", none["text"]),
    ]
    columns = "conv_id long, turn long, role string, digest string, at long, text string, fault int, ops string, illegal int, cost long"
    typed = [p.select(*[F.col(n).cast(t).alias(n) for n, t in (c.split() for c in columns.split(", "))]) for p in parts]
    together = typed[0].unionByName(typed[1]).unionByName(typed[2])
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "at")]
    return together.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_summarise, RESULT)
