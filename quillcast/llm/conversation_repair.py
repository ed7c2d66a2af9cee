"""Conversation repair: the cheapest edits that make turns alternate, by parallel Viterbi.

A conversation is cut into chunks of consecutive rows. Every chunk computes, from its last row
to its first, the least cost of what remains for each state it may be entered in. It starts from
a guess of the vector behind it. Fix-up passes hand every chunk the vector its successor came
to; a rerun ends where old and new vectors differ only by a constant, since from there on all
earlier ones do, too. The constants add up to the cost. With the true vectors
each chunk maps the state it is entered in to the one it is left in; these maps are composed by pointer
jumping, and the audit is traced chunk by chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillcast.llm.common import narrowed, slices
from quillcast.session import written

#: Rows of a chunk, as a power of two.
CHUNK_BITS = 8

SPACE = " \t\n\x0b\f\r"
#: Costs. Truncated rows that stay cost as much again as a new role.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States: nothing yet, behind s, behind u, behind a. What an inserted turn leads to from each.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
INITIAL = (None, None, "u", "a")
ROLE = {"u": "user", "a": "assistant"}
#: Cost of ending in each state: what is missing is inserted.
END = (0, 2 * INSERT, INSERT, 0)
GUESS = (0, 0, 0, 0)

# A row's symbol: x if it has to go, else the initial of its role (o for any other), upper case if truncated.
MUST_GO = "x"


def kept_state(symbol: str, state: int) -> int | None:
    """The state behind a row kept as it is; None if its role may not follow."""
    initial = symbol.lower()
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


#: Per symbol and state the costs and next states of keeping a row and of giving it a new role.
MOVES = {
    symbol: [
        [(extra, kept_state(symbol, state)), (REROLE + extra, NEXT[state])]
        for state in range(4)
        for extra in [TRUNCATED if symbol.isupper() else 0]
    ]
    for symbol in "suaoSUAO"
} | {MUST_GO: [[], [], [], []]}


def step_back(symbol: str, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row from those behind it; what is inserted before the row counts."""
    best = []
    for state, moves in enumerate(MOVES[symbol]):
        cost = DELETE + behind[state]
        for extra, to in moves:
            if to is not None and extra + behind[to] < cost:
                cost = extra + behind[to]
        best.append(cost)
    start, system, user, assistant = best
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(start, INSERT + user), min(system, INSERT + user), user, assistant


def normal(costs) -> tuple[tuple[int, ...], int]:
    """A vector with least cost 0, and what was taken off."""
    least = min(costs)
    return tuple(cost - least for cost in costs), least


def run_back(symbols: str, behind) -> tuple[tuple[int, ...], int]:
    costs = tuple(behind)
    for symbol in reversed(symbols):
        costs = step_back(symbol, costs)
    return normal(costs)


def fix_up(symbols: str, old_behind, old_front, old_gain: int, behind) -> tuple[tuple[int, ...], int]:
    """The run from ``behind``, as far as it differs from the run from ``old_behind`` by more than a constant."""
    old, new = tuple(old_behind), tuple(behind)
    for symbol in reversed(symbols):
        old, new = step_back(symbol, old), step_back(symbol, new)
        gaps = {b - a for a, b in zip(old, new, strict=True)}
        if len(gaps) == 1:
            return tuple(old_front), old_gain + gaps.pop()
    return normal(new)


def trace(symbols: str, behind, state: int, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits of a chunk entered in ``state``, and the state behind it."""
    costs = [tuple(behind)]
    for symbol in reversed(symbols):
        costs.append(step_back(symbol, costs[-1]))
    costs.reverse()
    audit, at = [], 0
    while at < len(symbols) or (last and END[state]):
        here = costs[at][state]
        if at == len(symbols):
            audit.append("I")
            state = NEXT[state]
        elif here == DELETE + costs[at + 1][state]:
            audit.append("D")
            at += 1
        elif here == INSERT + costs[at][NEXT[state]]:
            audit.append("I")
            state = NEXT[state]
        else:
            for letter, (extra, to) in zip("KR", MOVES[symbols[at]][state], strict=True):
                if to is not None and here == extra + costs[at + 1][to]:
                    audit.append(letter)
                    state, at = to, at + 1
                    break
    return "".join(audit), state


def repaired_turns(audit: str, turns: list[tuple[str, str]], state: int) -> list[tuple[str, str]]:
    """The turns of a chunk after its edits: (role, text)."""
    found, rows = [], iter(turns)
    for letter in audit:
        if letter == "I":
            state = NEXT[state]
            found.append((ROLE[INITIAL[state]], ""))
            continue
        role, text = next(rows)
        if letter == "R":
            state = NEXT[state]
            found.append((ROLE[INITIAL[state]], text))
        elif letter == "K":
            state = kept_state(role[:1], state)
            found.append((role, text))
    return found


# Spark ------------------------------------------------------------------------


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turn, role, text`` with faults planted by crc32 of conversation and turn modulo 20.

    0 drops a row, 1 empties its text, 2 takes its sentence ends, 3 repeats it, 4 makes it a
    user's. Nulls stand for one space, in the key, in roles and in texts.
    """
    given = narrowed(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    drawn = given.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), (F.crc32(key) % 20).alias("draw"))
    draw, text = F.col("draw"), F.col("text")
    changed = drawn.where(draw != 0).select(
        "conv_id",
        "turn",
        F.when(draw == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return changed.drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """All rows sorted by conversation and turn, nulls first, numbered by ``at``, written.

    Rows of one turn come by a digest of role and text, so that equal ones are neighbours. The last sort
    key tells all rows apart: a conversation, a turn or a row that makes up a third of
    the table is spread over tasks like any other.
    """
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    # Unlike null, the empty name cannot be mistaken: all others start with "=".
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv")
    same = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    keyed = rows.select(conv, "turn", role.alias("role"), text.alias("text"), same.alias("same"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv", "turn", "same", "tie"]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    return written(ordered.withColumn("at", F.monotonically_increasing_id()), "turns")


def _grown(frame: DataFrame) -> DataFrame:
    """For joins with what grows with the input: its files may be small enough to be broadcast, its rows are not."""
    return frame.hint("merge")


def _place() -> tuple[Column, Column]:
    """Partition and chunk of a row; chunks of a partition are numbered on end."""
    return F.shiftright("at", 33), F.shiftright("at", CHUNK_BITS)


def with_faults(turns: DataFrame) -> DataFrame:
    """``conv, at, turn, initial, fault, symbol`` of every row, without texts."""
    trimmed = F.rtrim("text", F.lit(SPACE))
    narrow = turns.select(
        "conv", "at", "turn", "same", F.substring("role", 1, 1).alias("initial"), (trimmed == "").alias("blank"), F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ended")
    )
    # One row per text of a conversation says where it comes first; the join back is by place, which no two rows share.
    first = narrow.groupBy("conv", "same").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    told = narrow.join(_grown(first), "at", "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("ended"), "truncated")
    own = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO).when(F.col("fault") == "truncated", F.upper(own)).otherwise(own)
    return told.select("conv", "at", "turn", "initial", fault.alias("fault")).withColumn("symbol", symbol)


def chunked(rows: DataFrame) -> DataFrame:
    """Chunks ``key, conv, block, next, symbols, initials, …``, written. ``key`` is the first row's place.

    ``next`` is the following chunk of the same conversation: the next block of the partition, or,
    behind its last one, the first of the next partition that has rows of it.
    """
    part, block = _place()
    listed = F.sort_array(F.collect_list(F.struct("at", "symbol", "initial")))
    chunks = (
        rows.groupBy("conv", part.alias("part"), block.alias("block"))
        .agg(listed.alias("rows"), *(F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")))
        .select(
            "conv", "part", "block", "blank", "duplicate", "truncated",
            F.col("rows")[0]["at"].alias("key"),
            F.array_join(F.transform("rows", lambda r: r["symbol"]), "").alias("symbols"),
            F.transform("rows", lambda r: r["initial"]).alias("initials"),
        )
    )
    chunks = written(chunks, "chunks")
    # At most a row per conversation and partition is put in order here.
    spans = chunks.groupBy("conv", "part").agg(F.max("block").alias("block"), F.min("key").alias("key"), F.count("*").alias("n"))
    after = Window.partitionBy("conv").orderBy("part")
    jumps = spans.withColumn("jump", F.lead("key").over(after)).where("jump is not null").select("conv", "part", "block", "jump")
    linked = chunks.join(_grown(jumps), ["conv", "part", "block"], "left")
    # Inside a partition the next chunk starts where its block does.
    within = spans.where("n > 1").select("conv", "part", F.col("block").alias("last"))
    linked = linked.join(_grown(within), ["conv", "part"], "left")
    in_place = F.when(F.col("block") < F.col("last"), F.shiftleft(F.col("block") + 1, CHUNK_BITS))
    return written(linked.withColumn("next", F.coalesce(in_place, "jump")).drop("last", "jump", "part"), "linked-chunks")


def _run_udf():
    @F.pandas_udf("front array<long>, gain long")
    def run(symbols: pd.Series, behind: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([run_back(s, map(int, b)) for s, b in zip(symbols, behind, strict=True)], columns=["front", "gain"])

    return run


def _fix_udf():
    @F.pandas_udf("front array<long>, gain long")
    def fix(symbols: pd.Series, old: pd.Series, front: pd.Series, gain: pd.Series, behind: pd.Series) -> pd.DataFrame:
        found = [
            fix_up(s, map(int, o), map(int, f), int(g), map(int, b)) for s, o, f, g, b in zip(symbols, old, front, gain, behind, strict=True)
        ]
        return pd.DataFrame(found, columns=["front", "gain"])

    return fix


def _vector(values) -> Column:
    return F.array(*(F.lit(value).cast("long") for value in values))


def backward_costs(chunks: DataFrame) -> DataFrame:
    """``key, behind, front, gain`` per chunk: normalised costs behind and in front, and the constant between, written.

    Passes are repeated until every chunk has run from the vector its successor came to. Turns
    pull the states together within a few rows, so two or three passes do; a chain of chunks that keeps
    them apart takes one pass per chunk and stays exact.
    """
    start = chunks.select("key", "next", "symbols", F.when(F.col("next").isNull(), _vector(END)).otherwise(_vector(GUESS)).alias("behind"))
    ran = start.withColumn("ran", _run_udf()("symbols", "behind")).select("*", "ran.*").drop("ran")
    vectors = written(ran, "vectors")
    while True:
        true_one = vectors.select(F.col("key").alias("next"), F.col("front").alias("wanted"))
        asked = vectors.where("next is not null").join(_grown(true_one), "next").where("wanted <> behind")
        asked = written(asked, "fix-up")
        if asked.isEmpty():
            return vectors.drop("symbols", "next")
        mended = asked.withColumn("ran", _fix_udf()("symbols", "behind", "front", "gain", "wanted"))
        mended = mended.select("key", "next", "symbols", F.col("wanted").alias("behind"), "ran.*")
        vectors = written(vectors.join(_grown(asked), "key", "left_anti").unionByName(mended), "vectors")


def _exits_udf():
    @F.pandas_udf("array<int>")
    def exits(symbols: pd.Series, behind: pd.Series) -> pd.Series:
        return pd.Series([[trace(s, list(map(int, b)), state, False)[1] for state in range(4)] for s, b in zip(symbols, behind, strict=True)])

    return exits


def entry_states(chunks: DataFrame) -> DataFrame:
    """``key, state``: the state in which each chunk is entered, by composing the maps of all chunks before it."""
    follows = chunks.where("next is not null")
    maps = follows.select(F.col("next").alias("key"), F.col("key").alias("before"), _exits_udf()("symbols", "behind").alias("map"))
    firsts = chunks.select("key").join(_grown(maps), "key", "left_anti").select("key", F.lit(None).cast("long").alias("before"), F.array(*[F.lit(START)] * 4).alias("map"))
    jumps = written(maps.unionByName(firsts), "maps")
    while not jumps.where("before is not null").isEmpty():
        reach = jumps.select(F.col("key").alias("before"), F.col("before").alias("far"), F.col("map").alias("first"))
        both = F.transform("first", lambda state: F.get("map", state))
        # "first" leads to the state before chunk "before", and "map" from there to this one.
        jumps = written(
            jumps.join(_grown(reach), "before", "left").select(
                "key", F.col("far").alias("before"), F.when(F.col("before").isNull(), F.col("map")).otherwise(both).alias("map")
            ),
            "maps",
        )
    return jumps.select("key", F.col("map")[0].alias("state"))


def _audit_udf():
    @F.pandas_udf("string")
    def audits(symbols: pd.Series, behind: pd.Series, state: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series([trace(s, list(map(int, b)), int(q), bool(end))[0] for s, b, q, end in zip(symbols, behind, state, last, strict=True)])

    return audits


def traced(chunks: DataFrame) -> DataFrame:
    """``key, conv, block, state, audit`` per chunk, written."""
    known = chunks.join(_grown(entry_states(chunks)), "key")
    return written(known.withColumn("audit", _audit_udf()("symbols", "behind", "state", F.col("next").isNull())).select("key", "conv", "block", "state", "audit"), "audits")


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by place, each with its chunk's audit, to repaired turns."""
    chunk, audit, state, turns = None, "", START, []

    def edited() -> pa.RecordBatch:
        found = repaired_turns(audit, turns, state)
        size = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk[0]] * size, pa.string()), pa.array([chunk[1]] * size, pa.int64()), pa.array(range(size), pa.int32()),
             pa.array([role for role, _ in found], pa.string()), pa.array([text for _, text in found], pa.string())],
            names=["conv", "key", "place", "role", "text"],
        )

    for batch in slices(batches):
        for row in batch.to_pylist():
            if chunk != (row["conv"], row["key"]):
                if chunk:
                    yield edited()
                chunk, audit, state, turns = (row["conv"], row["key"]), row["audit"], row["state"], []
            turns.append((row["role"], row["text"]))
    if chunk:
        yield edited()


def repaired(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv, key, place, role, text``: the turns after the edits, in order by key and place within a conversation."""
    _, block = _place()
    rows = turns.select("conv", block.alias("block"), "at", "role", "text").join(_grown(audits), ["conv", "block"])
    return rows.repartition("conv", "block").sortWithinPartitions("conv", "block", "at").drop("block").mapInArrow(_edit, "conv string, key long, place int, role string, text string")


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, said = None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"conv": [conv], "repaired_sha256": [said.hexdigest()]})

    for batch in slices(batches):
        for row in batch.to_pylist():
            if said is None or conv != row["conv"]:
                if said is not None:
                    yield told()
                conv, said = row["conv"], hashlib.sha256()
            else:
                said.update(b"\n")
            said.update(f"{row['role']}:{row['text']}".encode())
    if said is not None:
        yield told()


def digests(turns: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of the ``role:text`` lines of repaired turns.

    A digest reads its conversation from the first byte to the last, so each one passes through one task,
    row by row out of a sort that spills: nothing of it is held.
    """
    order = ["conv", "key", "place"]
    return turns.repartition("conv").sortWithinPartitions(*order).mapInArrow(_hash, "conv string, repaired_sha256 string")


def figures(rows: DataFrame, chunks: DataFrame, audits: DataFrame) -> DataFrame:
    """Per conversation: ``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``."""
    known = rows.where("turn is not null").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
    gaps = known.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).cast("long").alias("gaps"))
    pairs = F.zip_with(F.slice("initials", 1, F.size("initials") - 1), F.slice("initials", 2, F.size("initials")), lambda a, b: F.concat(a, b))
    heads = chunks.select(F.col("key").alias("next"), F.col("initials")[0].alias("head"))
    joint = F.concat(F.element_at("initials", -1), F.col("head"))
    legal = ["su", "ua", "au"]
    ends = chunks.join(_grown(heads), "next", "left").withColumn("illegal", F.size(F.filter(pairs, lambda p: ~p.isin(legal))) + F.coalesce((~joint.isin(legal)).cast("int"), F.lit(0)))
    counted = ends.groupBy("conv").agg(
        *(F.sum(name).cast("long").alias(name) for name in ("blank", "duplicate", "truncated", "illegal")),
        # The first chunk's front is that of an empty beginning; the constants of all chunks add up.
        (F.sum("gain") + F.min_by(F.col("front")[START], "key")).cast("long").alias("cost"),
    )
    told = audits.groupBy("conv").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("key", "audit"))), lambda a: a["audit"]), "").alias("audit"))
    return counted.join(_grown(gaps), "conv", "left").join(_grown(told), "conv").withColumn("gaps", F.coalesce("gaps", F.lit(0)))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Figures per conversation and the repaired turns; ``conv`` is "=" and the conversation's id, or empty for a null id.

    Rows are taken by turn, nulls first; rows of one turn come by a digest of role and text, equal
    ones next to each other. A row's first fault counts: blank (nothing but ASCII space), duplicate (role and text
    seen earlier), truncated (not ended by ``.!?``). Rows are kept, given the
    role user or assistant (3), or deleted (4; the only choice for blank and duplicate ones), turns without text are
    inserted (3), and a truncated row that stays costs 3 more, until the initials of the roles
    read ``(s?(ua)+)?``. Of the cheapest edits those whose initials D, I, K, R come first in ASCII are taken.

    Null roles and texts stand for one space; an empty role has no initial and cannot be kept.
    A text of any length is one row. No rows give no figures and no turns; other columns are ignored.
    """
    turns = in_order(narrowed(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col))
    faults = written(with_faults(turns), "faults")
    chunks = chunked(faults)
    solved = written(chunks.join(_grown(backward_costs(chunks)), "key"), "solved")
    audits = traced(solved)
    return figures(faults, solved, audits), repaired(turns, audits)
