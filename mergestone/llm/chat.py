"""Chat formatting: minimum-cost role repair over an automaton of legal turns.

Legal is an optional system turn, then user and assistant in turn, the user
first. Each turn of a conversation is kept, relabelled or merged into the turn
before it, and an empty turn may be inserted before it; dynamic programming
chooses the cheapest way, the first of equals in the order of ``_OPTIONS``.

A step of the programme is a matrix of least costs from state to state, and
these multiply (minimum for sum, sum for product). So turns are sorted by
range, cut into chunks of at most ``CHUNK`` rows and ``CHARACTERS`` bytes of
text (or one turn), and only conversations that
cross chunks need more: the product of each of their chunks, then the states
in which the cheapest path enters and leaves each chunk. No task ever holds a
whole conversation of unknown length.

Rendering is by pieces: a turn's piece closes the turn before it, opens its
own and holds its text, so a conversation's text is its pieces in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.llm.scratch import Scratch
from mergestone.llm.worker import tidy

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, INSERT = 1.0, 2.0, 3.0
#: Costs of ending in a state; a conversation may end with either speaker.
END = {START: 0.0, SYSTEM: INSERT, USER: 0.0, ASSISTANT: 0.0}
CHUNK, CHARACTERS = 5000, 8_000_000
#: Characters of a text that turns are put in order by, before a hash of the whole: range bounds are sampled from them.
SHOWN = 64
OTHER = 0  # the role of a turn whose label is none of ROLES


def _options(role: int) -> list[list[tuple[float, int, str, int]]]:
    """For each state the ways to take a turn of a role: (cost, next state, action, inserted role or 0)."""
    out = []
    for state in range(4):
        ways = []
        for to in (role, *(r for r in (USER, ASSISTANT, SYSTEM) if r != role)):
            if to == OTHER:
                continue
            change = 0.0 if to == role else RELABEL
            word = "keep" if to == role else "relabel"
            if to in NEXT[state]:
                ways.append((change, to, word, 0))
            if to == state:
                ways.append((change + MERGE, to, "merge" if to == role else "relabel+merge", 0))
            for between in NEXT[state]:
                if to in NEXT[between]:
                    ways.append((change + INSERT, to, f"insert+{word}", between))
        out.append(sorted(ways, key=lambda w: w[0]))
    return out


_OPTIONS = {role: _options(role) for role in (OTHER, SYSTEM, USER, ASSISTANT)}
_MATRIX = {}
for _role, _ways in _OPTIONS.items():
    _MATRIX[_role] = np.full((4, 4), np.inf)
    for _state, _list in enumerate(_ways):
        for _cost, _to, _, _ in _list:
            _MATRIX[_role][_state, _to] = min(_MATRIX[_role][_state, _to], _cost)


def role_number(label: str | None) -> int:
    label = (label or "").strip().lower()
    return ROLES.index(label) + 1 if label in ROLES else OTHER


def product(roles: list[int]) -> np.ndarray:
    """Least costs from state to state over a run of turns."""
    total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    for role in roles:
        total = (total[:, :, None] + _MATRIX[role][None, :, :]).min(axis=1)
    return total


def repair(roles: list[int], start: int = START, end: int | None = None) -> list[tuple[int, str, int, float]]:
    """(role, action, inserted role, cost) of each turn on the cheapest path from start to end, or to the cheapest end."""
    best = [{start: 0.0}]
    for role in roles:
        after: dict[int, float] = {}
        for state, cost in best[-1].items():
            for more, to, _, _ in _OPTIONS[role][state]:
                if cost + more < after.get(to, np.inf):
                    after[to] = cost + more
        best.append(after)
    state = end if end is not None else min(best[-1], key=lambda s: (best[-1][s] + END[s], s))
    out = []
    for role, before, total in zip(reversed(roles), reversed(best[:-1]), reversed(best[1:])):
        here = total[state]
        found = None
        for old in sorted(before):
            for way in _OPTIONS[role][old]:
                if way[1] == state and before[old] + way[0] == here and (found is None or way[0] < found[1][0]):
                    found = (old, way)
        old, (cost, to, action, inserted) = found
        out.append((to, action, inserted, cost))
        state = old
    return out[::-1]


def _opening(role: int) -> str:
    return f"<|{ROLES[role - 1]}|>\n"


def pieces(steps: list[tuple[int, str, int, float]], texts: list[str], first: bool, last: bool) -> list[str]:
    """The rendered piece of each turn; first and last: whether the conversation begins and ends here."""
    out = []
    for i, ((role, action, inserted, _), text) in enumerate(zip(steps, texts)):
        closing = "" if first and not i else "<|end|>\n"
        if action.endswith("merge"):
            out.append("\n" + text)
        elif inserted:
            out.append(f"{closing}{_opening(inserted)}<|end|>\n{_opening(role)}{text}")
        else:
            out.append(closing + _opening(role) + text)
    if last and out:
        role = steps[-1][0]
        out[-1] += "<|end|>\n" + (_opening(USER) + "<|end|>\n" if role == SYSTEM else "")
    return out


def _chunks(size: int, characters: int):
    """Numbers the rows of a sorted partition, and cuts it into chunks of so many rows, or characters of text, at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, done = TaskContext.get().partitionId() << 40, 0
        chunk, rows, held = base, 0, 0
        for batch in batches:
            chunks = []
            for n in pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist():
                if rows == size or rows and held + n > characters:
                    chunk, rows, held = base + done + len(chunks), 0, 0
                chunks.append(chunk)
                rows, held = rows + 1, held + n
            order = base + done + np.arange(batch.num_rows)
            done += batch.num_rows
            columns = [batch.column("conv_id"), pa.array(order, pa.int64()), pa.array(chunks, pa.int64()), batch.column("role"), batch.column("text")]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "place", "chunk", "role", "text"])

    return run


def _product(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("place")
    costs = product([role_number(r) for r in rows["role"]]).ravel()
    return pd.DataFrame({"conv_id": [rows["conv_id"].iloc[0]], "chunk": [rows["chunk"].iloc[0]], "costs": [costs.tolist()]})


def _crossing(rows: pd.DataFrame) -> pd.DataFrame:
    """The states in which a conversation's cheapest path enters and leaves each chunk; one row a chunk comes in."""
    rows = rows.sort_values("chunk")
    steps = [np.array(c).reshape(4, 4) for c in rows["costs"]]
    reach = [np.array([0.0, np.inf, np.inf, np.inf])]
    for m in steps:
        reach.append((reach[-1][:, None] + m).min(axis=0))
    leave = int(np.argmin(reach[-1] + np.array([END[s] for s in range(4)])))
    ends = []
    for m, before in zip(reversed(steps), reversed(reach[:-1])):
        enter = int(np.argmin(before + m[:, leave]))
        ends.append((enter, leave))
        leave = enter
    ends.reverse()
    n = len(ends)
    return pd.DataFrame({"conv_id": rows["conv_id"].to_numpy(), "chunk": rows["chunk"].to_numpy(), "enter": [e for e, _ in ends], "leave": [x for _, x in ends], "first": [i == 0 for i in range(n)], "last": [i == n - 1 for i in range(n)]})


def _repair(rows: pd.DataFrame, crossing: pd.DataFrame) -> pd.DataFrame:
    across = {r.conv_id: (r.enter, r.leave, r.first, r.last) for r in crossing.itertuples()}
    out = []
    for conv, turns in rows.sort_values("place").groupby("conv_id", sort=False):
        enter, leave, first, last = across.get(conv, (START, None, True, True))
        steps = repair([role_number(r) for r in turns["role"]], int(enter), None if leave is None else int(leave))
        texts = ["" if t is None or t != t else t for t in turns["text"]]
        shown = pieces(steps, texts, first, last)
        closing = [END[SYSTEM] if last and i == len(steps) - 1 and s[0] == SYSTEM else 0.0 for i, s in enumerate(steps)]
        out.append(pd.DataFrame({"conv_id": conv, "place": turns["place"].to_numpy(), "role": [ROLES[s[0] - 1] for s in steps], "action": [s[1] for s in steps], "inserted": [ROLES[s[2] - 1] if s[2] else None for s in steps], "cost": [s[3] + c for s, c in zip(steps, closing)], "piece": shown}))
    columns = ["conv_id", "place", "role", "action", "inserted", "cost", "piece"]
    return pd.concat(out, ignore_index=True)[columns] if out else pd.DataFrame(columns=columns)


def repair_roles(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """(conv_id, place, role, action, inserted, cost, piece): one row for each turn, to be read in order of place.

    Turns are in order of turn, role and text (its first ``SHOWN`` characters,
    then a hash of it); a null turn comes first, repeated rows are turns of
    their own. A role other than system, user and assistant, or null, must be
    relabelled. A null text is empty, a very long one stays whole. Rows without
    a conversation can't be placed and take no part; other columns are ignored;
    an empty table gives none.
    """
    spark = conversations.sparkSession
    scratch = Scratch(spark, "chat")
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    ).filter("conv_id IS NOT NULL")
    # the row's number only parts equal rows, so that any run of rows can be cut
    keys = ["conv_id", "turn", "role", F.substring("text", 1, SHOWN), F.xxhash64("text"), "row"]
    numbered = scratch.save("numbered", turns.withColumn("row", F.monotonically_increasing_id()))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = numbered.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed = scratch.save("placed", placed.mapInArrow(tidy(_chunks(chunk, CHARACTERS)), "conv_id long, place long, chunk long, role string, text string"))
    scratch.drop("numbered")
    ranges = placed.groupBy("conv_id").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).filter("a < b").select("conv_id")
    cut = placed.select("conv_id", "place", "chunk", "role").join(ranges, "conv_id", "left_semi")
    products = cut.groupBy("conv_id", "chunk").applyInPandas(_product, "conv_id long, chunk long, costs array<double>")
    crossing = products.groupBy("conv_id").applyInPandas(_crossing, "conv_id long, chunk long, enter int, leave int, first boolean, last boolean")
    kind = "conv_id long, place long, role string, action string, inserted string, cost double, piece string"
    return placed.groupBy("chunk").cogroup(crossing.groupBy("chunk")).applyInPandas(_repair, kind)


def digest(repaired: DataFrame) -> DataFrame:
    """For each conversation its cost, its repairs and a sum of hashes over its turns, which does not tell their order."""
    has = lambda word: F.sum(F.col("action").contains(word).cast("long"))
    return repaired.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"),
        F.sum("cost").alias("cost"),
        has("merge").alias("n_merged"),
        has("relabel").alias("n_relabelled"),
        has("insert").alias("n_inserted"),
        F.sum(F.length("piece")).cast("long").alias("n_chars"),
        F.sum(F.xxhash64("role", "action", "inserted", "piece").cast("decimal(38,0)")).alias("pieces_hash"),
    )
