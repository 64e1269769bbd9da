"""Chat formatting: minimum-cost repair of roles, then rendering.

A legal conversation is an optional system turn, then user and assistant in turn, ending with the assistant. The automaton has a state per
last role (none, system, user, assistant). Each given turn is kept, merged into the turn before it (same role), given another role,
or preceded by empty turns; a trailing user turn gets an empty answer. Costs are parameters, and dynamic programming over the
automaton finds the cheapest repair; of equal ones, each turn in order takes the cheapest step, then the role that comes first, then no merge.

A conversation may be as long as a third of the table, so it is no group. Rows are sorted by (conversation, turn, role, text) in ranges;
every piece of at most `PIECE` turns of one conversation becomes a cost matrix between states. A pass over the matrices from the end tells what it costs to
finish after each piece; with that, a piece is repaired as it is within the whole, so where ranges are cut does not show. Rendered rows are per given
turn; a merged turn is several rows with one output number, of which the first carries the header and the last the end mark.

Defined results: roles are stripped and lowered, common other names are mapped; an unknown or null role has to be replaced. Null texts are empty.
Ties in `turn` are put in order by role and text, null turns come first; repeated rows are turns of their own. Null conversation ids are one
conversation. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.tables import materialise

ROLES = ("system", "user", "assistant")
NAMES = {"human": "user", "prompter": "user", "bot": "assistant", "ai": "assistant", "gpt": "assistant", "model": "assistant", "developer": "system"}
NONE, SYSTEM, USER, ASSISTANT = range(4)
MERGE, RELABEL, INSERT = 10, 25, 30
PIECE = 1024
FAR = 1 << 40
KEYS = ("conv_id", "part", "piece")
ROWS = pa.list_(pa.struct([
    ("place", pa.int32()), ("local", pa.int64()), ("role", pa.string()), ("change", pa.string()), ("last", pa.bool_()),
]))

#: What may follow each state without inserted turns.
FOLLOWS = {NONE: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}


def ways(costs: tuple[int, int, int]) -> list[list[list[tuple[int, int, tuple[int, ...], bool]]]]:
    """By role (unknown as 0) and state: (cost, next state, roles inserted before, merged) of every legal step."""
    merge, relabel, insert = costs
    table = []
    for role in range(4):
        by_state = []
        for state in range(4):
            steps = []
            for to in (SYSTEM, USER, ASSISTANT):
                change = 0 if to == role else relabel
                if to in FOLLOWS[state]:
                    steps.append((change, to, (), False))
                elif to == state:
                    steps.append((change + merge, to, (), True))
                for middle in (USER, ASSISTANT):
                    if middle in FOLLOWS[state] and to in FOLLOWS[middle]:
                        steps.append((change + insert, to, (middle,), False))
            by_state.append(sorted(steps, key=lambda s: (s[0], s[1], s[3])))
        table.append(by_state)
    return table


def closing(state: int, costs: tuple[int, int, int]) -> int:
    """Cost of ending in a state: empty turns up to the assistant's."""
    return {NONE: 0, ASSISTANT: 0, USER: costs[2], SYSTEM: 2 * costs[2]}[state]


def suffix_costs(roles: list[int], end: list[int], steps) -> list[list[int]]:
    """Cheapest cost from each state before each turn to `end` after the last."""
    out = [end]
    for role in reversed(roles):
        after = out[-1]
        out.append([min((c + after[to] for c, to, _, _ in steps[role][s]), default=FAR) for s in range(4)])
    return out[::-1]


def piece_matrix(roles: list[int], steps) -> list[int]:
    """Costs from every state before a piece to every state after it, row by row."""
    columns = [suffix_costs(roles, [0 if t == e else FAR for t in range(4)], steps)[0] for e in range(4)]
    return [min(columns[e][s], FAR) for s in range(4) for e in range(4)]


def repaired(roles: list[int], state: int, end: list[int], steps) -> tuple[list[tuple[int, tuple[int, ...], bool]], int]:
    """(role, roles inserted before, merged) of every turn from `state` on, and the last state."""
    costs, out = suffix_costs(roles, end, steps), []
    for i, role in enumerate(roles):
        c, to, inserted, merged = min(steps[role][state], key=lambda s: s[0] + costs[i + 1][s[1]])
        out.append((to, inserted, merged))
        state = to
    return out, state


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one partition, with the partition, the piece and the place in it."""
    part, last, piece, place = TaskContext.get().partitionId(), object(), -1, 0
    for batch in batches:
        pieces, places = [], []
        for conv in batch.column("conv_id").to_pylist():
            if conv != last or place == PIECE:
                last, piece, place = conv, piece + 1, 0
            pieces.append(piece)
            places.append(place)
            place += 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(pieces), pa.int32()), pa.array(pieces, pa.int64()), pa.array(places, pa.int32())],
            names=[*batch.schema.names, "part", "piece", "place"],
        )


def matrix_rows(batches: Iterator[pa.RecordBatch], costs) -> Iterator[pa.RecordBatch]:
    steps = ways(costs)
    for batch in batches:
        made = [piece_matrix(roles, steps) for roles in batch.column("roles").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in KEYS), pa.array(made, pa.list_(pa.int64()))], names=[*KEYS, "matrix"]
        )


def costs_after(batches: Iterator[pa.RecordBatch], costs) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation from the last: what it costs to finish from each state after the piece."""
    last, after = object(), []
    for batch in batches:
        out = []
        for conv, matrix in zip(batch.column("conv_id").to_pylist(), batch.column("matrix").to_pylist()):
            if conv != last:
                last, after = conv, [closing(s, costs) for s in range(4)]
            out.append(after)
            after = [min(min(matrix[4 * s + e] + after[e] for e in range(4)), FAR) for s in range(4)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))], names=[*batch.schema.names, "after"])


def exit_rows(batches: Iterator[pa.RecordBatch], costs) -> Iterator[pa.RecordBatch]:
    """For every piece the state it leaves in, by the state it is entered in, when it is repaired as a part of the whole."""
    steps = ways(costs)
    for batch in batches:
        exits = [
            [repaired(roles, state, after, steps)[1] for state in range(4)]
            for roles, after in zip(batch.column("roles").to_pylist(), batch.column("after").to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*KEYS, "after")), pa.array(exits, pa.list_(pa.int32()))], names=[*KEYS, "after", "exits"]
        )


def states_between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of a conversation from the first: the state before each."""
    last, state = object(), NONE
    for batch in batches:
        enters = []
        for conv, exits in zip(batch.column("conv_id").to_pylist(), batch.column("exits").to_pylist()):
            if conv != last:
                last, state = conv, NONE
            enters.append(state)
            state = exits[state]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in (*KEYS, "after")), pa.array(enters, pa.int32())], names=[*KEYS, "after", "enters"]
        )


def repaired_rows(batches: Iterator[pa.RecordBatch], costs) -> Iterator[pa.RecordBatch]:
    """Per piece the output rows (place of the given turn or null, output turn, role, change, last of its output turn)."""
    steps = ways(costs)
    for batch in batches:
        out: list[list] = [[], [], []]
        left = []
        for roles, enters, after in zip(*(batch.column(c).to_pylist() for c in ("roles", "enters", "after"))):
            made, leaves = repaired(roles, enters, after, steps)
            left.append(leaves)
            rows, turn = [], -1
            for place, (given, (to, inserted, merged)) in enumerate(zip(roles, made)):
                for role in inserted:
                    turn += 1
                    rows.append({"place": None, "local": turn, "role": ROLES[role - 1], "change": "insert", "last": True})
                turn += not merged
                change = ("relabel" if to != given else "") + ("+" if to != given and merged else "") + ("merge" if merged else "")
                if merged and rows:
                    rows[-1]["last"] = False
                rows.append({"place": place, "local": turn, "role": ROLES[to - 1], "change": change or "keep", "last": True})
            out[0].append(turn + 1)
            out[1].append(made[0][2])
            out[2].append(rows)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in KEYS), pa.array(left, pa.int32()), pa.array(out[0], pa.int64()), pa.array(out[1], pa.bool_()), pa.array(out[2], ROWS)],
            names=[*KEYS, "leaves", "turns", "joins", "rows"],
        )


def formatted(conversations: DataFrame, costs: tuple[int, int, int] = (MERGE, RELABEL, INSERT)) -> DataFrame:
    """(conv_id, out_turn, position, turn, role, change, rendered): the repaired conversation, a row per given or inserted turn.

    Rows of (conv_id, turn, role, text); `turn` is null for inserted turns. The renderings of a conversation in the order of `position` are its text.
    """
    role = F.lower(F.regexp_replace(F.col("role").cast("string"), "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", ""))
    named = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in NAMES.items() for x in kv)), role), role)
    given = F.coalesce(F.array_position(F.array(*map(F.lit, ROLES)), named), F.lit(0)).cast("int")
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), given.alias("given"),
    )
    order = ["conv_id", "turn", "role", "text"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "conv_id long, turn long, role string, text string, given int, part int, piece long, place int"
    stored = materialise(ranged.mapInArrow(numbered, schema), "turns")

    pieces = stored.groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("place", "given"))).alias("r")).select(
        *KEYS, F.col("r.given").alias("roles")
    )
    keyed = "conv_id long, part int, piece long"
    matrices = pieces.mapInArrow(partial(matrix_rows, costs=costs), f"{keyed}, matrix array<long>")
    backward = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("piece"))
    costed = backward.mapInArrow(partial(costs_after, costs=costs), f"{keyed}, matrix array<long>, after array<long>")
    exits = pieces.join(costed.select("part", "piece", "after"), ["part", "piece"]).mapInArrow(
        partial(exit_rows, costs=costs), f"{keyed}, after array<long>, exits array<int>"
    )
    forward = exits.repartition("conv_id").sortWithinPartitions(*KEYS)
    states = forward.mapInArrow(states_between, f"{keyed}, after array<long>, enters int").select("part", "piece", "after", "enters")
    made = pieces.join(states, ["part", "piece"]).mapInArrow(
        partial(repaired_rows, costs=costs),
        f"{keyed}, leaves int, turns long, joins boolean, "
        "rows array<struct<place:int, local:long, role:string, change:string, last:boolean>>",
    )
    made = materialise(made, "repaired")
    along = W.partitionBy("conv_id").orderBy("part", "piece")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    offsets = made.select(
        "part", "piece", "leaves",
        F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("turns_before"),
        F.coalesce(F.sum(F.size("rows")).over(before), F.lit(0)).alias("rows_before"),
        F.lead("joins").over(along).alias("next_joins"),
    )
    rows = made.select("conv_id", "part", "piece", F.size("rows").alias("n"), "turns", F.posexplode("rows").alias("at", "r")).join(offsets, ["part", "piece"])
    texts = stored.select("part", "piece", "place", "turn", "text")
    final = F.col("r.last") & ~((F.col("at") == F.col("n") - 1) & F.coalesce("next_joins", F.lit(False)))
    out = rows.withColumn("place", F.col("r.place")).join(texts, ["part", "piece", "place"], "left").select(
        "conv_id", (F.col("turns_before") + F.col("r.local")).alias("out_turn"), (F.col("rows_before") + F.col("at")).alias("position"),
        "turn", F.col("r.role").alias("role"), F.col("r.change").alias("change"),
        rendered(F.col("r.role"), F.coalesce("text", F.lit("")), ~F.col("r.change").endswith("merge"), final).alias("rendered"),
    )
    ends = offsets.join(made.select("conv_id", "part", "piece", "turns", F.size("rows").alias("n")), ["part", "piece"]).filter("next_joins IS NULL")
    missing = F.when(F.col("leaves") == USER, F.array(F.lit("assistant"))).when(F.col("leaves") == SYSTEM, F.array(F.lit("user"), F.lit("assistant")))
    added = ends.select("*", F.posexplode(missing).alias("i", "role")).select(
        "conv_id", (F.col("turns_before") + F.col("turns") + F.col("i")).alias("out_turn"), (F.col("rows_before") + F.col("n") + F.col("i")).alias("position"),
        F.lit(None).cast("long").alias("turn"), "role", F.lit("insert").alias("change"),
        rendered(F.col("role"), F.lit(""), F.lit(True), F.lit(True)).alias("rendered"),
    )
    return out.unionByName(added)


def rendered(role: Column, text: Column, opens: Column, closes: Column) -> Column:
    # A marker inside a text gets one more backslash, so that a text cannot open or close a turn.
    text = F.regexp_replace(text, "<(\\\\*)\\|", "<$1\\\\|")
    head = F.when(opens, F.concat(F.lit("<|"), role, F.lit("|>\n"))).otherwise(F.lit("\n"))
    return F.concat(head, text, F.when(closes, F.lit("<|end|>\n")).otherwise(F.lit("")))
