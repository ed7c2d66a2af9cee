"""Chat formatting: tool calls linked to their results.

Calls and results meet by identifier in a hash join. A call may follow another one whose
result it uses; pointer jumping finds how deep each call lies in these chains, in a number
of rounds that grows with the logarithm of the longest. Arguments are checked against the
tool's schema, and each linked call is written as canonical JSON: keys sorted, no blanks,
text as it is.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillcast.llm.common import narrowed
from quillcast.session import written

#: What a property of a schema may be, and how Python's JSON reader shows it.
TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}

Schema = Mapping[str, object]


def problems(value: object, schema: Schema, at: str = "$") -> list[str]:
    """Where a value breaks its schema: type, required, properties, additionalProperties,
    items, enum, minimum, maximum, minLength and maxLength."""
    kind = schema.get("type")
    if kind:
        wanted = TYPES[kind]
        if not isinstance(value, wanted) or (isinstance(value, bool) and kind in ("integer", "number")):
            return [f"{at}: not of type {kind}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the allowed values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            found.append(f"{at}: out of range")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", math.inf):
        found.append(f"{at}: length out of range")
    if isinstance(value, list) and "items" in schema:
        for place, item in enumerate(value):
            found += problems(item, schema["items"], f"{at}[{place}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in schema.get("required", ()) if name not in value]
        for name in sorted(value):
            if name in known:
                found += problems(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{name}: unknown")
    return found


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def formatted(call_id: str, name: str | None, arguments: str | None, result: str | None, schemas: Mapping[str, Schema]) -> tuple[str, list[str]]:
    """The call as canonical JSON and what is wrong with it."""
    found = []
    try:
        value = json.loads(arguments) if arguments is not None else None
    except ValueError:
        value, found = arguments, ["$: no JSON"]
    else:
        if name not in schemas:
            found = ["$: unknown tool"]
        else:
            found = problems(value, schemas[name])
    return canonical({"id": call_id, "name": name, "arguments": value, "result": result}), found


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth, cyclic) for ``calls(call_id, after)``: 0 for a call that follows none.

    A call that follows an unknown one counts as following none. Calls on a circle, or
    behind one, are cyclic; their depth is null.
    """
    nodes = written(calls.groupBy("call_id").agg(F.min("after").alias("after")), "nodes")
    known = nodes.select(F.col("call_id").alias("above"))
    jumps = written(
        nodes.join(known, nodes["after"] == known["above"], "left").select("call_id", "above", F.when(F.col("above").isNull(), 0).otherwise(1).cast("long").alias("depth")),
        "jumps",
    )
    total = nodes.count()
    for _ in range(max(1, total).bit_length()):
        # A fork, so that a call many others follow is one side of a plain join.
        other = jumps.select(F.col("call_id").alias("node"), F.col("above").alias("next"), F.col("depth").alias("more"))
        climbing = jumps.where(F.col("above").isNotNull())
        if climbing.isEmpty():
            break
        moved = climbing.join(other, climbing["above"] == other["node"]).select("call_id", F.col("next").alias("above"), (F.col("depth") + F.col("more")).alias("depth"))
        jumps = written(moved.union(jumps.where(F.col("above").isNull())), "jumps")
    cyclic = F.col("above").isNotNull()
    return jumps.select("call_id", F.when(~cyclic, F.col("depth")).alias("depth"), cyclic.alias("cyclic"))


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """Calls with their results, in order; one row per identifier.

    ``calls(conv_id, call_id, turn, name, arguments, after)`` and ``results(call_id, turn,
    content)`` give (conv_id, call_id, depth, turn, name, status, valid, problems, copies,
    record). Status is ``linked``, ``unanswered`` (no result), ``orphan`` (a result without
    call, conv_id and name null) or ``cyclic``. Where an identifier has several calls or
    results, the one with the least turn and then content counts and ``copies`` says how
    many rows there were. Null identifiers cannot be linked and name one unanswered call or
    orphan each for all of them. Sorting by (conv_id, depth, turn, call_id) is a topological order.
    Empty tables are fine.
    """
    one_call = calls.groupBy("call_id").agg(
        F.min(F.struct("turn", "name", "arguments", "after", "conv_id")).alias("call"), F.count("*").alias("calls")
    )
    one_result = results.groupBy(F.col("call_id").alias("result_id")).agg(F.min(F.struct("turn", "content")).alias("result"), F.count("*").alias("results"))
    deep = depths(one_call.where(F.col("call_id").isNotNull()).select("call_id", F.col("call.after").alias("after")))
    joined = (
        written(one_call, "calls")
        .join(written(one_result, "results"), F.col("call_id") == F.col("result_id"), "full")
        .join(written(deep.withColumnRenamed("call_id", "deep_id"), "depths"), F.col("call_id") == F.col("deep_id"), "left")
    )

    @F.pandas_udf("record string, problems array<string>")
    def written_out(ids: pd.Series, names: pd.Series, arguments: pd.Series, contents: pd.Series) -> pd.DataFrame:
        rows = [formatted(*row, schemas) for row in zip(ids, names, arguments, contents, strict=True)]
        return pd.DataFrame(rows, columns=["record", "problems"])

    is_call = F.col("calls").isNotNull()
    status = F.when(~is_call, "orphan").when(F.coalesce("cyclic", F.lit(False)), "cyclic").when(F.col("results").isNull(), "unanswered").otherwise("linked")
    identifier = F.coalesce("call_id", "result_id")
    out = written_out(identifier, "call.name", "call.arguments", "result.content")
    return joined.select(
        F.col("call.conv_id").alias("conv_id"), identifier.alias("call_id"), "depth", F.coalesce("call.turn", "result.turn").alias("turn"),
        F.col("call.name").alias("name"), status.alias("status"), out.alias("out"),
        (F.coalesce("calls", F.lit(0)) + F.coalesce("results", F.lit(0))).cast("long").alias("copies"), is_call.alias("is_call"),
    ).select(
        "conv_id", "call_id", "depth", "turn", "name", "status",
        F.when(F.col("is_call"), F.size("out.problems") == 0).alias("valid"),
        F.when(F.col("is_call"), F.array_join("out.problems", "; ")).alias("problems"),
        "copies", F.col("out.record").alias("record"),
    )


#: Conversations seen as calls: a user asks, the next turn's assistant answers; a system turn sets up.
CHAT_SCHEMAS: dict[str, Schema] = {
    "ask": {
        "type": "object",
        "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "uses": {"type": "string"}},
        "required": ["prompt", "turn"],
        "additionalProperties": False,
    },
    "configure": {
        "type": "object",
        "properties": {"instructions": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
        "required": ["instructions", "turn"],
        "additionalProperties": False,
    },
}


def _identifier(conv: Column, turn: Column) -> Column:
    return F.concat(conv.cast("string"), F.lit("-"), turn.cast("string"))


def conversation_calls(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A table of chat turns as calls and results.

    User and system turns are calls named by conversation and turn. A user's call follows
    the user's call two turns earlier, if there is one. An assistant turn is the result of
    the turn before it. Rows without conversation, turn or role have no identifier and are
    passed over; a null text is a null argument or result.
    """
    rows = narrowed(turns, conv=conv_col, turn=turn_col, role=role_col, text=text_col).where("conv IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL")
    asks = F.col("role") == "user"
    earlier = _identifier(F.col("conv"), F.col("turn") - 2)
    options = {"ignoreNullFields": "false"}
    arguments = F.when(asks, F.to_json(F.struct(F.col("text").alias("prompt"), "turn"), options)).otherwise(
        F.to_json(F.struct(F.col("text").alias("instructions"), "turn"), options)
    )
    calls = rows.where("role <> 'assistant'").select(
        F.col("conv").alias("conv_id"), _identifier(F.col("conv"), F.col("turn")).alias("call_id"), "turn",
        F.when(asks, "ask").otherwise("configure").alias("name"), arguments.alias("arguments"), F.when(asks, earlier).alias("after"),
    )
    results = rows.where("role = 'assistant'").select(_identifier(F.col("conv"), F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results
