"""Structure repair of conversations by a dynamic programme over the turns that are retained.

A conversation should read: an optional system turn, then pairs of a user's and an assistant's turn. A turn is kept,
given another role or deleted, and empty turns are inserted. The programme goes over retained turns only: the turns
between two retained ones are deleted, which prefix sums of deletions price, so the best predecessor of every state is a
running minimum; the roles of the two determine what is inserted. Among the cheapest repairs the one whose audit, the
initials of its edits in order, is least in ASCII is taken.

Turns are sorted over the cluster by conversation and turn, so a conversation may cover many partitions. What a partition
holds of a conversation is summed up by the costs between its first and last state; these few rows, two a partition at
most, are combined for each conversation, and every partition then repairs its own part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch
from .exact import WHITE

KEEP, REROLE, DELETE, INSERT = "KRDI"
COSTS = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
#: What a truncated turn costs that is not deleted.
TRUNCATED = 5
FAULTS = ("", "blank", "duplicate", "truncated")
ENDS = ".!?"
#: States: the role of the last turn retained, or none yet. NEW are the roles that turns can get.
NONE, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
NEW = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 60
#: Initials of what is inserted between a state and the next turn retained; other pairs are impossible.
BETWEEN = {
    (NONE, SYSTEM): "", (NONE, USER): "", (SYSTEM, USER): "", (ASSISTANT, USER): "", (USER, ASSISTANT): "",
    (NONE, ASSISTANT): "u", (SYSTEM, ASSISTANT): "u", (ASSISTANT, ASSISTANT): "u", (USER, USER): "a",
}
#: What is inserted at the end.
CLOSING = {NONE: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
STATES = range(4)

EDITS = "part int, at long, fault byte, edit string, new_role string, before string, after string"


def choices(initial: str, fault: int) -> list[tuple[int, int, str]]:
    """The states in which a turn can be retained: (state, cost, edit)."""
    if fault in (1, 2):
        return []
    extra, own = TRUNCATED * (fault == 3), INITIALS.get(initial)
    found = [] if own is None else [(own, COSTS[KEEP] + extra, KEEP)]
    return found + [(r, COSTS[REROLE] + extra, REROLE) for r in NEW if r != own]


def best_paths(turns: list[tuple[str, int]], ends: list[int]) -> Callable[[int], tuple[int, list]]:
    """The cheapest repair of turns (initial, fault) that ends in state q at the further cost ends[q].

    Returns a function of the state before: the cost, and the turns retained as (index, state, edit, cost), the rest being
    deleted. Of equal costs the audit decides: deletions go first, so the later next turn is better, then insertions, then keeping.
    """
    n, each = len(turns), COSTS[DELETE]
    deleted = [each * i for i in range(n + 1)]  # prefix sums: deletions before turn i
    least: dict[int, tuple] = {}  # state -> the running minimum over later turns: cost from the start, index, edit, own cost
    after: list[dict] = [{} for _ in range(n)]  # turn -> state -> what follows if it is retained in that state

    def follow(state: int, start: int) -> tuple[int, tuple | None]:
        """Cost after turn start - 1, and the next (index, state, edit, cost) that is retained."""
        best, chosen = (deleted[n] - deleted[start] + ends[state], -n, 0, ""), None
        for r, (cost, at, edit, own) in least.items():
            between = BETWEEN.get((state, r))
            if between is not None:
                found = (cost - deleted[start] + COSTS[INSERT] * len(between), -at, -len(between), edit)
                if found < best:
                    best, chosen = found, (at, r, edit, own)
        return best[0], chosen

    for i in range(n - 1, -1, -1):
        options = choices(*turns[i])
        follows = [follow(r, i + 1) for r, _, _ in options]
        for (r, own, edit), (rest, chosen) in zip(options, follows, strict=True):
            after[i][r] = chosen
            total = deleted[i] + own + rest
            if r not in least or total < least[r][0]:  # of equal costs the later turn stays
                least[r] = (total, i, edit, own)
    first = {p: follow(p, 0) for p in STATES}

    def path(state: int) -> tuple[int, list]:
        cost, chosen = first[state]
        found = []
        while chosen is not None:
            found.append(chosen)
            chosen = after[chosen[0]][chosen[1]]
        return min(cost, NEVER), found

    return path


def audit_of(n: int, state: int, path: list) -> str:
    """The initials of the edits of n turns whose retained ones are path, from a state; without what closes it."""
    out, done = [], 0
    for i, r, edit, _ in path:
        out.append(DELETE * (i - done) + INSERT * len(BETWEEN[state, r]) + edit)
        state, done = r, i + 1
    return "".join(out) + DELETE * (n - done)


def sum_up(turns: list[tuple[str, int]]) -> tuple[list[int], list[int]]:
    """For each pair of states before and after: the least cost, and the place of its audit among those of its first state."""
    costs, ranks = [NEVER] * 16, [0] * 16
    audits: list[list] = [[] for _ in STATES]
    for q in STATES:
        path = best_paths(turns, [0 if r == q else NEVER for r in STATES])
        for p in STATES:
            costs[4 * p + q], found = path(p)
            if costs[4 * p + q] < NEVER:
                audits[p].append((audit_of(len(turns), p, found), q))
    for p in STATES:
        for rank, (_, q) in enumerate(sorted(audits[p])):
            ranks[4 * p + q] = rank
    return costs, ranks


def join_parts(parts: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """The states before and after each consecutive part of a conversation, given what sum_up says of each."""
    to_go = [[COSTS[INSERT] * len(CLOSING[q]) for q in STATES]]
    for costs, _ in reversed(parts):
        to_go.append([min(costs[4 * p + q] + to_go[-1][q] for q in STATES) for p in STATES])
    state, found = NONE, []
    for (costs, ranks), rest in zip(parts, to_go[-2::-1], strict=True):
        q = min(STATES, key=lambda q: (costs[4 * state + q] + rest[q], ranks[4 * state + q]))
        found.append((state, q))
        state = q
    return found


def _runs(keys: list) -> Iterator[tuple[int, int]]:
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield start, i
            start = i


def _turns(light: pa.Table, start: int, end: int) -> list[tuple[str, int]]:
    return list(zip(light["initial"].slice(start, end - start).to_pylist(), light["fault"].slice(start, end - start).to_pylist(), strict=True))


def _border_sums(light: pa.Table) -> pa.Table:
    """What a partition holds of its first and its last conversation, which others may hold parts of."""
    light = light.sort_by("at")
    keys = light["ckey"].to_pylist()
    runs = list(_runs(keys))
    rows = []
    for start, end in dict.fromkeys([runs[0], runs[-1]]):
        costs, ranks = sum_up(_turns(light, start, end))
        rows.append({"ckey": keys[start], "part": light["part"][0].as_py(), "costs": costs, "ranks": ranks})
    return pa.Table.from_pylist(rows, pa.schema([("ckey", pa.string()), ("part", pa.int32()), ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64()))]))


def _join_borders(sums: pa.Table) -> pa.Table:
    rows = sums.sort_by("part").to_pylist()
    states = join_parts([(r["costs"], r["ranks"]) for r in rows])
    made = [
        {"part": r["part"], "ckey": r["ckey"], "first": p, "last": q, "ends": i == len(rows) - 1}
        for i, (r, (p, q)) in enumerate(zip(rows, states, strict=True))
    ]
    return pa.Table.from_pylist(made, pa.schema([("part", pa.int32()), ("ckey", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("ends", pa.bool_())]))


def _decide(light: pa.Table, borders: pa.Table) -> pa.Table:
    """The edit of every turn of a partition."""
    light = light.sort_by("at")
    known = {b["ckey"]: b for b in borders.to_pylist()}
    keys = light["ckey"].to_pylist()
    n = len(keys)
    edits, roles, before, after = [DELETE] * n, [None] * n, [""] * n, [""] * n
    for start, end in _runs(keys):
        border = known.get(keys[start])
        if border is None:
            state, closes, ends = NONE, True, [COSTS[INSERT] * len(CLOSING[q]) for q in STATES]
        else:
            state, closes = border["first"], border["ends"]
            ends = [0 if q == border["last"] else NEVER for q in STATES]
        for i, r, edit, _ in best_paths(_turns(light, start, end), ends)(state)[1]:
            edits[start + i], before[start + i] = edit, BETWEEN[state, r]
            roles[start + i] = NEW[r] if edit == REROLE else None
            state = r
        if closes:
            after[end - 1] = CLOSING[state]
    return pa.table({
        "part": light["part"], "at": light["at"], "fault": light["fault"], "edit": pa.array(edits, pa.string()),
        "new_role": pa.array(roles, pa.string()), "before": pa.array(before, pa.string()), "after": pa.array(after, pa.string()),
    })


def fault_of(text: Column, again: Column) -> Column:
    """The index in FAULTS of a turn's first fault; again says that its role and text came before."""
    body = F.rtrim(text, F.lit(WHITE))
    return (
        F.when(body == "", 1).when(again, 2).when(~F.right(body, F.lit(1)).isin(*ENDS), 3).otherwise(0).cast("byte")
    )


def plan_edits(messages: DataFrame) -> DataFrame:
    """The edits that repair conversations, one row per turn. messages: conv_id, turn, role, text; other columns are ignored.

    Returns conv_id, at (turns of a conversation ascend by it), turn, role, text, fault (index in FAULTS), edit (an initial of
    Keep, Rerole, Delete), new_role (of Rerole), and before and after: initials of the roles of empty turns inserted before it, and
    after a conversation's last turn.

    Turns go by turn, nulls first; equal turns by role, then text, so repeated rows are adjacent. A null role or text is one
    space: such a text is blank, such a role fits no place. A null conv_id is a conversation of its own. Roles count by their
    first character. No rows: no edits. A conversation may be of any length; its turns are dealt to tasks by ranges.
    """
    with scratch() as here:
        key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
        turns = messages.select(
            "conv_id", key.alias("ckey"), "turn",
            F.coalesce(F.col("role"), F.lit(" ")).alias("role"), F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        )
        # equal rows can't be told apart, so a number of their own lets a range end between them
        order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "rid")]
        ranged = turns.withColumn("rid", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
        placed = ranged.drop("rid").withColumn("at", F.monotonically_increasing_id())
        placed = here.keep(placed.withColumn("part", F.shiftright("at", 33).cast("int")), "turns")
        same = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
        seen = placed.groupBy("ckey", same.alias("same")).agg(F.min("at").alias("at")).select("at", F.lit(False).alias("again"))
        light = (
            placed.join(seen, "at", "left")
            .select("part", "at", "ckey", F.left("role", F.lit(1)).alias("initial"), fault_of(F.col("text"), F.col("again").isNull()).alias("fault"))
        )
        light = materialize(light, "turns-light")
        sums = light.groupBy("part").applyInArrow(_border_sums, "ckey string, part int, costs array<long>, ranks array<long>")
        borders = sums.groupBy("ckey").applyInArrow(_join_borders, "part int, ckey string, first int, last int, ends boolean")
        edits = light.groupBy("part").cogroup(borders.groupBy("part")).applyInArrow(_decide, EDITS)
        edits = here.keep(edits, "turn-edits")
    return placed.join(edits.drop("part"), "at").select("conv_id", "ckey", "at", "turn", "role", "text", "fault", "edit", "new_role", "before", "after")


def repaired_turns(edits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: conv_id, at, slot, role, text; (at, slot) is their order.

    edits: as plan_edits returns. Inserted turns have an empty text.
    """
    empty = lambda initials: F.transform(
        F.array_remove(F.split(initials, ""), ""),
        lambda i: F.struct(F.when(i == "u", NEW[USER]).otherwise(NEW[ASSISTANT]).alias("role"), F.lit("").alias("text")),
    )
    own = F.when(F.col("edit") != DELETE, F.array(F.struct(F.coalesce("new_role", "role").alias("role"), "text")))
    none = F.array().cast("array<struct<role: string, text: string>>")
    turns = F.concat(empty(F.col("before")), F.coalesce(own, none), empty(F.col("after")))
    return edits.select("conv_id", "at", F.posexplode(turns).alias("slot", "t")).select("conv_id", "at", "slot", "t.role", "t.text")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums, audit and hash of conversations whose turns come in order; a conversation isn't gathered, only its audit grows."""
    legal = {"su", "ua", "au"}
    key, at, found = object(), None, []

    def close():
        turns = at["turns"]
        gaps = 0 if turns is None else turns[1] - turns[0] + 1 - turns[2]
        return {
            "conv_id": at["conv_id"], "gaps": gaps, "blank": at["faults"][1], "duplicate": at["faults"][2], "truncated": at["faults"][3],
            "illegal": at["illegal"], "cost": at["cost"], "audit": at["audit"].decode(), "repaired_sha256": at["hash"].hexdigest(),
        }

    def put(role: str, text: str):
        at["hash"].update(("\n" * at["any"] + role + ":" + text).encode())
        at["any"] = True

    def insert(initials: str):
        for i in initials:
            put(NEW[INITIALS[i]], "")
            at["audit"] += INSERT.encode()
            at["cost"] += COSTS[INSERT]

    for batch in batches:
        for r in batch.to_pylist():
            if r["ckey"] != key:
                if at is not None:
                    found.append(close())
                key = r["ckey"]
                at = {"conv_id": r["conv_id"], "turns": None, "faults": [0] * 4, "illegal": 0, "cost": 0, "audit": bytearray(),
                      "hash": hashlib.sha256(), "any": False, "role": None, "after": ""}
            if (turn := r["turn"]) is not None:
                low, high, n = at["turns"] or (turn, None, 0)
                at["turns"] = (low, turn, n + (turn != high))
            initial = r["role"][:1]
            at["illegal"] += at["role"] is not None and at["role"] + initial not in legal
            at["role"] = initial
            at["faults"][r["fault"]] += 1
            insert(r["before"])
            at["audit"] += r["edit"].encode()
            at["cost"] += COSTS[r["edit"]]
            if r["edit"] != DELETE:
                at["cost"] += TRUNCATED * (r["fault"] == 3)
                put(r["new_role"] or r["role"], r["text"])
            insert(r["after"])
        if found:
            yield pa.RecordBatch.from_pylist(found, DIGEST)
            found = []
    if at is not None:
        yield pa.RecordBatch.from_pylist([close()], DIGEST)


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
DIGEST = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def digest(edits: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    edits: as plan_edits returns, conv_id and turn whole numbers. The hash of a whole conversation needs its text in one
    order, so its turns stream through one task, sorted by Spark; only the audit, which is a value of the row, grows with it.
    """
    text = F.when(F.col("edit") != DELETE, F.col("text")).alias("text")
    rows = edits.select(F.col("conv_id").cast("long"), "ckey", "at", F.col("turn").cast("long"), "role", text, "fault", "edit", "new_role", "before", "after")
    rows = rows.repartition("ckey").sortWithinPartitions("ckey", "at")
    kinds = ", ".join(["conv_id long", *(f"{c} long" for c in _COUNTS), "audit string", "repaired_sha256 string"])
    return rows.mapInArrow(_digests, kinds)
