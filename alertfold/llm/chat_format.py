"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in
alternation, from a user to an assistant turn.  A dynamic program over the automaton of
these states chooses, for every turn, whether it opens a turn in its own role, is
relabelled, is merged into the turn before, or needs empty turns in front, at the smallest
total cost.  The repaired turns are rendered with role marks.

A conversation may be far larger than a task.  Turns are range-partitioned by conversation
and position, so a long one is cut into pieces.  The cost of crossing a piece from each
state to each other is a small matrix, and matrices of neighbouring pieces combine (minimum
of sums).  Only conversations cut by a partition's edge need that: at most two rows per
partition come to the driver, which returns each piece's entry and exit state.  Then every
piece is repaired on its own.  Equal costs are told apart by hashes of the turns, so the
choice does not depend on where the cuts fall.

Order within a conversation: turn number (NULL last), role, text.  Repeated rows are turns
of their own.  A text that holds a mark (``<|``) gets a backslash inside it, one more if it has
some already, so that no text reads as a turn and ``unescaped`` gives it back.  Conversation
ids may have any type; turn numbers that are no whole numbers read as NULL.  Roles are read without case and outer spaces; NULL and unknown roles fit any
role at a small cost.  NULL texts are empty.  A NULL conversation id is a conversation.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertfold.llm.common import cut

ROLES = ("", "system", "user", "assistant")  # by state; state 0 is the start
RELABEL, RELABEL_UNKNOWN, MERGE, INSERT = 3, 1, 1, 2
#: Empty turns needed between two states; pairs that are missing cannot be joined.
BETWEEN = {(0, 1): (), (0, 2): (), (0, 3): (2,), (1, 2): (), (1, 3): (2,),
           (2, 3): (), (2, 2): (3,), (3, 2): (), (3, 3): (2,)}
#: Empty turns that end a conversation in each state.
CLOSING = {1: (2, 3), 2: (3,), 3: ()}
STATES = 4
MARK, ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
UNIT = 1 << 80  # one unit of cost; what is below tells equal costs apart


def _moves() -> dict[int, list[tuple[int, int, int, str]]]:
    """Per role (0: unknown) the cheapest move of each kind: (from, to, cost, action)."""
    out: dict[int, list] = {}
    for role in range(STATES):
        own = []
        for (s, t), empties in BETWEEN.items():
            change = 0 if t == role else RELABEL_UNKNOWN if role == 0 else RELABEL
            own.append((s, t, change + INSERT * len(empties), "keep" if t == role else "relabel"))
        for s in (1, 2, 3):
            change = 0 if s == role else RELABEL_UNKNOWN if role == 0 else RELABEL
            own.append((s, s, change + MERGE, "merge"))
        out[role] = own
    return out


MOVES = _moves()


def role_state(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES[1:] else 0


def _seed(turn, role, text) -> int:
    return xxhash.xxh3_64_intdigest(f"{turn}|{role}|{text}")


def _tie(seed: int, k: int) -> int:
    x = (seed + (k + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def step(costs: list, role: int, seed: int) -> tuple[list, list]:
    """Costs of all states after one more turn, and the move that led to each."""
    new, how = [None] * STATES, [None] * STATES
    for k, (s, t, cost, _) in enumerate(MOVES[role]):
        if costs[s] is not None:
            total = costs[s] + cost * UNIT + _tie(seed, k)
            if new[t] is None or total < new[t]:
                new[t], how[t] = total, k
    return new, how


def _end(costs: list) -> int:
    """The cheapest state to end in."""
    return min((costs[s] + INSERT * UNIT * len(CLOSING[s]), s) for s in CLOSING if costs[s] is not None)[1]


def repair(turns: list[tuple], entry: int = 0, leave: int | None = None) -> list[tuple[int, int, str]]:
    """(from state, to state, action) of every turn of a piece."""
    costs = [0 if s == entry else None for s in range(STATES)]
    trail = []
    for turn, role, text in turns:
        state = role_state(role)
        costs, how = step(costs, state, _seed(turn, role, text))
        trail.append((state, how))
    at = _end(costs) if leave is None else leave
    out = []
    for state, how in reversed(trail):
        s, t, _, action = MOVES[state][how[at]]
        out.append((s, t, action))
        at = s
    return out[::-1]


def rendered(turns: list[tuple], path: list[tuple[int, int, str]], offset: int, closes: bool) -> list[dict]:
    """Output rows of a piece; their texts, joined in order, are the conversation."""
    rows = []

    def add(pos, slot, turn, role, action, text):
        rows.append({"pos": pos, "slot": slot, "turn": turn, "role": role, "action": action, "rendered": text})

    def opened(state, first, text):
        return ("" if first else "<|end|>\n") + f"<|{ROLES[state]}|>\n{text}"

    for k, ((turn, _, text), (s, t, action)) in enumerate(zip(turns, path)):
        pos = offset + k
        if action == "merge":
            add(pos, 1, turn, ROLES[t], action, "\n" + escaped(text or ""))
            continue
        empties = BETWEEN[s, t]
        for state in empties:
            add(pos, 0, None, ROLES[state], "insert", opened(state, s == 0, ""))
        add(pos, 1, turn, ROLES[t], action, opened(t, s == 0 and not empties, escaped(text or "")))
    if closes and path:
        last = offset + len(path) - 1
        for slot, state in enumerate(CLOSING[path[-1][1]], 2):
            add(last, slot, None, ROLES[state], "insert", opened(state, False, ""))
        add(last, 9, None, None, "end", "<|end|>\n")
    return rows


def escaped(text: str) -> str:
    """The text without marks: a backslash more between ``<`` and ``|``."""
    return MARK.sub(r"<\\\1|", text) if "<" in text else text


def unescaped(text: str) -> str:
    return ESCAPED.sub(r"<\1|", text)


def _runs(batches):
    """(part, conversation, turns) for each stretch of one conversation in a partition."""
    part, now, held, begun = None, None, [], False
    for batch in batches:
        for p, c, *turn in zip(*(col.to_pylist() for col in batch.columns)):
            if begun and c != now:
                yield part, now, held
                held = []
            part, now, begun = p, c, True
            held.append(tuple(turn))
    if begun:
        yield part, now, held


def _edges(batches):
    """The partition's first and last stretch: number of turns and cost matrix."""
    runs, first, last = 0, None, None
    for part, conv, turns in _runs(batches):
        if runs == 0:
            first = (part, conv, turns)
        last = (part, conv, turns)
        runs += 1
    rows = []
    for k, run in enumerate([first] if runs == 1 else [first, last] if runs else []):
        part, conv, turns = run
        matrix = [[0 if s == t else None for t in range(STATES)] for s in range(STATES)]
        for turn, role, text in turns:
            seed, state = _seed(turn, role, text), role_state(role)
            matrix = [step(row, state, seed)[0] for row in matrix]
        rows.append({"part": part, "k": k, "conv": None if conv is None else str(conv), "only": runs == 1, "turns": len(turns),
                     "matrix": [[None if x is None else str(x) for x in row] for row in matrix]})
    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
        [("part", pa.int32()), ("k", pa.int32()), ("conv", pa.string()), ("only", pa.bool_()), ("turns", pa.int64()),
         ("matrix", pa.list_(pa.list_(pa.string())))]))


def join_pieces(pieces: list) -> dict:
    """(part, k) -> (entry, exit, turns before, last piece) for pieces of one conversation,
    in order; each piece is (part, k, turns, matrix)."""
    costs = [[0, None, None, None]]
    for *_, matrix in pieces:
        now = [None] * STATES
        for s in range(STATES):
            for t in range(STATES):
                if costs[-1][s] is not None and matrix[s][t] is not None:
                    total = costs[-1][s] + matrix[s][t]
                    if now[t] is None or total < now[t]:
                        now[t] = total
        costs.append(now)
    at, out, after = _end(costs[-1]), {}, sum(p[2] for p in pieces)
    for i in range(len(pieces) - 1, -1, -1):
        part, k, turns, matrix = pieces[i]
        entry = next(s for s in range(STATES) if costs[i][s] is not None and matrix[s][at] is not None
                     and costs[i][s] + matrix[s][at] == costs[i + 1][at])
        after -= turns
        out[part, k] = (entry, at, after, i == len(pieces) - 1)
        at = entry
    return out


def _repairer(shared):
    schema = pa.schema([("conv_id", pa.string()), ("pos", pa.int64()), ("slot", pa.int32()), ("turn", pa.int64()),
                        ("role", pa.string()), ("action", pa.string()), ("rendered", pa.string())])

    def run(batches):
        edges = shared.value
        k, rows, held = 0, [], None

        def finish(run, is_last):
            nonlocal k
            part, conv, turns = run
            edge = edges.get((part, 0)) if k == 0 else edges.get((part, 1)) if is_last else None
            k += 1
            entry, leave, offset, closes = edge or (0, None, 0, True)
            path = repair(turns, entry, leave)
            return [{"conv_id": None if conv is None else str(conv), **r} for r in rendered(turns, path, offset, closes)]

        for run_ in _runs(batches):
            if held is not None:
                rows += finish(held, False)
            held = run_
            if len(rows) >= 5000:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows = []
        if held is not None:
            rows += finish(held, True)
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def repair_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", pieces: int | None = None) -> DataFrame:
    """``conv_id, pos, slot, turn, role, action, rendered``: the repaired turns.  The rendered
    texts of a conversation, joined by (pos, slot), are its chat format."""
    spark = turns.sparkSession
    plain = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).try_cast("long").alias("turn"),
                         F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    order = [F.col("conv").asc_nulls_last(), F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last()]
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = cut(plain.repartitionByRange(pieces, *order, F.xxhash64("text"))
               .sortWithinPartitions(*order, F.col("text").asc_nulls_last())
               .select(F.spark_partition_id().alias("part"), F.col("conv").cast("string").alias("conv"), "turn", "role", "text"))
    edges = laid.mapInArrow(_edges, "part int, k int, conv string, only boolean, turns bigint, "
                                    "matrix array<array<string>>").collect()
    by_conv: dict = {}
    for e in sorted(edges, key=lambda e: (e["part"], e["k"])):
        matrix = [[None if x is None else int(x) for x in row] for row in e["matrix"]]
        by_conv.setdefault(e["conv"], []).append((e["part"], e["k"], e["turns"], matrix))
    known: dict = {}
    for group in by_conv.values():
        if len(group) > 1:
            known |= join_pieces(group)
    return laid.mapInArrow(_repairer(spark.sparkContext.broadcast(known)),
                           "conv_id string, pos bigint, slot int, turn bigint, role string, action string, rendered string"
                           ).withColumn("conv_id", F.col("conv_id").cast(plain.schema["conv"].dataType))
