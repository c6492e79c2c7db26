"""Repair of conversations: the cheapest edits that make the roles a system turn at most and then user and assistant in turn.

A place between turns has one of four states: nothing yet, behind a system turn, behind a user turn, behind an assistant turn.
``cost[state]`` is the least cost from there to the end.  Turns are cut into blocks of ``BLOCK``; a block is a function from the
costs behind it to those before it (least of sums, so blocks can be put together in any grouping), and the costs at the borders of
blocks are the checkpoints.  Inside a block costs are kept at every ``sqrt`` of its length only; walking forward, the costs between two checkpoints
are worked out again, and the first of the cheapest edits in ASCII order is taken.  No task holds the turns of a long
conversation: texts stay in rows, and a block is one letter a turn.
"""

from __future__ import annotations

import hashlib
from math import inf, isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.places import placed
from bizlens.llm.text import WORD, stored

BLOCK = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
#: State behind a turn of role user or assistant, by the state before it; the letter that such a turn has.
NEXT = (USER, USER, ASSISTANT, USER)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
END = (0, 4, 2, 0)  # behind the last turn, with what has to be inserted there
#: Letters of turns: fault (none, blank, duplicate, truncated) times four and role (system, user, assistant, other).
FIRST_LETTER = 65
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)


def _turn(letter: str) -> tuple[int, int]:
    return divmod(ord(letter) - FIRST_LETTER, 4)


def _moves(letter: str) -> list[list[tuple[str, int, int]]]:
    """Per state the edits of this turn in ASCII order: (letter, cost, state behind)."""
    fault, role = _turn(letter)
    moves = []
    for state in range(4):
        found = [("D", DELETE, state)]
        if fault in (CLEAN, TRUNCATED):
            extra = CUT * (fault == TRUNCATED)
            if (role == 0 and state == START) or (role == 1 and NEXT[state] == USER) or (role == 2 and NEXT[state] == ASSISTANT):
                found.append(("K", KEEP + extra, SYSTEM if role == 0 else NEXT[state]))
            found.append(("R", REROLE + extra, NEXT[state]))
        moves.append(found)
    return moves


MOVES = {chr(FIRST_LETTER + i): _moves(chr(FIRST_LETTER + i)) for i in range(16)}


def before(letter: str, costs: tuple) -> tuple:
    """Costs before a turn, inserts included, from the costs behind it."""
    raw = [min(cost + costs[state] for _, cost, state in moves) for moves in MOVES[letter]]
    user, assistant = min(raw[USER], INSERT + raw[ASSISTANT]), min(raw[ASSISTANT], INSERT + raw[USER])
    return (min(raw[START], INSERT + user), min(raw[SYSTEM], INSERT + user), user, assistant)


def checkpoints(letters: str, costs: tuple) -> tuple[int, dict[int, tuple]]:
    """Costs before the first turn and behind every ``step``-th; the step grows with the root of the length."""
    step = max(isqrt(len(letters)), 1)
    kept = {len(letters): costs}
    for at in range(len(letters) - 1, -1, -1):
        costs = before(letters[at], costs)
        if at % step == 0:
            kept[at] = costs
    return step, kept


def walk(letters: str, costs: tuple, starts: list[int], last: bool) -> tuple[dict[int, tuple[list[str], list[str], int]], tuple]:
    """From each start state the edits and given roles, one text each for every turn (and the end of the last block), and the
    state behind; and the costs before the first turn.

    A given role is ``u`` or ``a`` where the edit sets one, else ``-``.
    """
    step, kept = checkpoints(letters, costs)
    edits: dict[int, list[str]] = {s: [] for s in starts}
    given: dict[int, list[str]] = {s: [] for s in starts}
    now = {s: s for s in starts}

    def note(start: int, done: list[tuple[str, int]]) -> None:
        edits[start].append("".join(name for name, _ in done))
        given[start].append("".join("-" if name in "DK" else "u" if to == USER else "a" for name, to in done))
        now[start] = done[-1][1] if done else now[start]

    for low in range(0, len(letters), step):
        high = min(low + step, len(letters))
        behind = [kept[high]]
        for at in range(high - 1, low - 1, -1):
            behind.append(before(letters[at], behind[-1]))
        for at in range(low, high):
            due, ahead = behind[high - at], behind[high - at - 1]
            for start in starts:
                state, done = now[start], []
                while not done or done[-1][0] == "I":
                    tight = {name: to for name, cost, to in MOVES[letters[at]][state] if cost + ahead[to] == due[state]}
                    if INSERT + due[NEXT[state]] == due[state]:
                        tight["I"] = NEXT[state]
                    name = min(tight)
                    state = tight[name]
                    done.append((name, state))
                note(start, done)
    if last:
        for start in starts:
            state, done = now[start], []
            while END[state]:
                state = NEXT[state]
                done.append(("I", state))
            note(start, done)
    return {s: (edits[s], given[s], now[s]) for s in starts}, kept[0]


def block_costs(letters: str) -> list[float]:
    """Least costs from each state before a block to each state behind it, row by row (infinite where there is no way)."""
    columns = []
    for end in range(4):
        costs = tuple(0 if s == end else inf for s in range(4))
        for letter in reversed(letters):
            costs = before(letter, costs)
        columns.append(costs)
    return [columns[end][state] for state in range(4) for end in range(4)]


def conversation_key(conv_id: Column) -> Column:
    """A text that is never null: empty for a null id."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def marked_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) in order, with place, total, fault and role letter; stored.

    Null roles and texts are one space.  Order is by turn (null first), role and text.  A turn without a visible sign is blank; one
    with role and text of an earlier turn is a duplicate; one whose last visible sign is none of ``.!?`` is truncated.
    """
    rows = stored(turns.select(
        conversation_key(F.col("conv_id")).alias("conv"), "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")), "turns")
    at = stored(placed(rows, ["conv"], ["turn", "role", "text"], "turns_sorted").withColumn("mark", F.md5("text")), "turns_placed")
    # The first of equal turns, by place: a text that fills a third of the table comes back as one row a conversation.
    firsts = at.groupBy("conv", "role", "mark").agg(F.min("place").alias("place")).select("conv", "place", F.lit(True).alias("is_first"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\v\f\r")), -1, 1)
    fault = (F.when(~F.col("text").rlike(WORD), BLANK).when(F.col("is_first").isNull(), DUPLICATE)
             .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(CLEAN))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return at.join(firsts, ["conv", "place"], "left").select(
        "conv", "turn", "role", "text", "place", "total", fault.alias("fault"), F.char(FIRST_LETTER + 4 * fault + role).alias("letter"))


def _blocks(marked: DataFrame, block: int) -> DataFrame:
    """(conv, block, blocks, letters): one letter a turn, in order."""
    cut = marked.groupBy("conv", F.expr(f"place div {block}").alias("block"), F.expr(f"(total + {block - 1}) div {block}").alias("blocks"))
    pairs = cut.agg(F.sort_array(F.collect_list(F.struct("place", "letter"))).alias("pairs"))
    return pairs.select("conv", "block", "blocks", F.array_join(F.col("pairs.letter"), "").alias("letters"))


def _illegal(letters: str) -> int:
    roles = [(ord(x) - FIRST_LETTER) % 4 for x in letters]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(roles, roles[1:]))


def repair(turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The turns with their edits, and one row per conversation.

    Turns: conv, place, role, text, ``edits`` (what is inserted before, ``I`` each, then ``K``, ``R`` or ``D``), ``given`` (the
    roles that these set); a row without text at the end for what is inserted there.  Conversations: conv, n, blank,
    duplicate, truncated, illegal, gaps, cost, audit (all edits in order, one cell).

    Conversations without a turn don't occur; an empty table gives none.  ``block`` turns are a task's piece of a conversation.
    """
    marked = stored(marked_turns(turns), "turns_marked")
    blocks = stored(_blocks(marked, block), "turn_blocks")

    def measure(batches):
        for batch in batches:
            frame = batch.to_pandas()
            frame["costs"] = [block_costs(x) if n > 1 else [] for x, n in zip(frame["letters"], frame["blocks"])]
            yield pa.RecordBatch.from_pandas(frame[["conv", "block", "costs"]], preserve_index=False)

    def settle_costs(frame: pd.DataFrame) -> pd.DataFrame:
        frame, costs, found = frame.sort_values("block", ascending=False), END, []
        for matrix in frame["costs"]:
            found.append([float(c) for c in costs])
            costs = tuple(min(matrix[4 * s + e] + costs[e] for e in range(4)) for s in range(4))
        return pd.DataFrame({"conv": frame["conv"], "block": frame["block"], "behind": found})

    long = blocks.where("blocks > 1").select("conv", "block", "blocks", "letters")
    matrices = long.mapInArrow(measure, "conv string, block long, costs array<double>")
    behind = matrices.groupBy("conv").applyInPandas(settle_costs, "conv string, block long, behind array<double>")
    ready = blocks.join(stored(behind, "checkpoints"), ["conv", "block"], "left")

    def edit(batches):
        for batch in batches:
            rows = []
            for conv, number, blocks_, letters, costs in zip(*[batch.column(c).to_pylist() for c in ("conv", "block", "blocks", "letters", "behind")]):
                costs = END if costs is None else tuple(costs)
                starts = [START] if number == 0 else list(range(4))
                found, due = walk(letters, costs, starts, number == blocks_ - 1)
                faults = [(ord(x) - FIRST_LETTER) // 4 for x in letters]
                for start, (edits, given, end) in found.items():
                    rows.append((conv, number, blocks_, start, end, edits, given, len(letters), *[faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)],
                                 _illegal(letters), letters[0], letters[-1], None if number else int(due[START])))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=arrow)

    names = ["conv", "block", "blocks", "start", "end", "edits", "given", "n", "blank", "duplicate", "truncated", "illegal", "head", "tail", "cost"]
    arrow = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("blocks", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
                       ("edits", pa.list_(pa.string())), ("given", pa.list_(pa.string())), ("n", pa.int64()), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")],
                       ("head", pa.string()), ("tail", pa.string()), ("cost", pa.int64())])
    schema = ("conv string, block long, blocks long, start long, end long, edits array<string>, given array<string>, n long, blank long, duplicate long, "
              "truncated long, illegal long, head string, tail string, cost long")
    walked = stored(ready.mapInArrow(edit, schema), "walked")

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        """The walk that is taken in each block, and whether the roles across its lower border are out of order."""
        by_block = {b: part for b, part in frame.groupby("block")}
        state, tail, rows = START, None, []
        for number in sorted(by_block):
            row = by_block[number].set_index("start").loc[state]
            rows.append((row["conv"], number, state, 0 if tail is None else _illegal(tail + row["head"])))
            state, tail = int(row["end"]), row["tail"]
        return pd.DataFrame(rows, columns=["conv", "block", "start", "border"])

    narrow = walked.where("blocks > 1").select("conv", "block", "start", "end", "head", "tail")
    taken = narrow.groupBy("conv").applyInPandas(follow, "conv string, block long, start long, border long")
    single = walked.where("blocks = 1").withColumn("border", F.lit(0).cast("long"))
    chosen = stored(single.unionByName(walked.where("blocks > 1").join(taken, ["conv", "block", "start"])), "chosen")
    pieces = F.sort_array(F.collect_list(F.struct("block", F.array_join("edits", "").alias("e"))))
    sums = chosen.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("n", "blank", "duplicate", "truncated")], F.sum(F.col("illegal") + F.col("border")).alias("illegal"),
        F.max("cost").alias("cost"), pieces.alias("pieces"))
    gaps = marked.groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.countDistinct("turn").alias("turns"))
    gap = F.coalesce(F.col("high").cast("long") - F.col("low").cast("long") + 1 - F.col("turns"), F.lit(0).cast("long"))
    summary = sums.withColumn("audit", F.array_join(F.col("pieces.e"), "")).drop("pieces").join(gaps.select("conv", gap.alias("gaps")), "conv")

    each = chosen.select("conv", "block", F.posexplode(F.arrays_zip("edits", "given")).alias("at", "edit"))
    placed_edits = each.select("conv", (F.col("block") * block + F.col("at")).alias("place"), "edit.edits", "edit.given")
    return placed_edits.join(marked.select("conv", "place", "role", "text"), ["conv", "place"], "left"), summary


def repaired_turns(edited: DataFrame) -> DataFrame:
    """(conv, place, step, role, text): the turns that the edits leave or insert, in order of place and step."""
    step = F.posexplode(F.split("given", "")).alias("step", "gives")
    each = edited.where("given != ''").select("conv", "place", "role", "text", "edits", step)
    each = each.withColumn("edit", F.expr("substring(edits, step + 1, 1)")).where("edit in ('I', 'K', 'R')")
    role = F.when(F.col("gives") == "u", "user").when(F.col("gives") == "a", "assistant").otherwise(F.col("role"))
    return each.select("conv", "place", "step", role.alias("role"), F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def repaired_sha256(repaired: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): digest of the repaired ``role:text``, joined by newlines.

    A digest of one conversation is one chain, so its turns pass one task in order; they are streamed, never gathered.
    """
    dealt = repaired.repartition("conv").sortWithinPartitions("conv", "place", "step")

    def digest(batches):
        conv, chain = None, None
        for batch in batches:
            done = []
            for key, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")]):
                if key != conv:
                    if conv is not None:
                        done.append((conv, chain.hexdigest()))
                    conv, chain = key, hashlib.sha256()
                    chain.update(f"{role}:{text}".encode())
                else:
                    chain.update(f"\n{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], ["conv", "repaired_sha256"])
        if conv is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], pa.string()), pa.array([chain.hexdigest()], pa.string())], ["conv", "repaired_sha256"])

    return dealt.mapInArrow(digest, "conv string, repaired_sha256 string")
