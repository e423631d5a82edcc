"""Chat formatting with linked tool calls, in DataFrame operations only.

Calls and results are hash-joined by (conversation, call id). A call may depend on one earlier call
(its parent); the depth of a call in that forest is found by pointer doubling, so a chain of n
calls takes log2(n) joins, and ordering lines by (depth, turn, call id) puts every call behind the
one it needs. Arguments are parsed once as variants and checked against the tool's schema, and
lines are written as canonical JSON: keys sorted at every level, no blanks, numbers without
trailing zeros.

No step gathers a conversation: rows stay one per call and one per message, so a conversation
that holds a third of all turns is spread like any other rows.

Defined results: a call id that is repeated in a conversation counts once, with its first turn; so
does a repeated result. Results without a call are ``orphan``, calls without a result
``unanswered``, calls on or behind a cycle of parents ``cycle`` (depth null), others ``answered``.
A parent that does not exist leaves the call at depth 0 with error ``parent``. Arguments that are
null or not a JSON object have error ``object``. Null conversation or call ids link with nothing
and are dropped. Messages with null text have null content, which JSON leaves out. Empty tables
give empty tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import discard, store

# Types of a schema, as the names Spark gives to variant values.
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$",
    "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY",
    "object": "^OBJECT",
}

Schema = Mapping[str, Mapping[str, object]]


def argument_errors(tool: Column, arguments: Column, schemas: Mapping[str, Schema]) -> Column:
    """A sorted array of errors: ``object``, ``tool``, ``missing:x``, ``type:x``, ``range:x``, ``unknown:x``.

    A schema maps a field to its ``type`` and, if wanted, ``required``, ``min`` and ``max``.
    """
    parsed = F.try_parse_json(arguments)
    out = F.array(F.lit("tool"))
    for name, schema in schemas.items():
        found = [F.transform(F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, schema))), _unknown)]
        for field, rule in schema.items():
            path = f"$.{field}"
            value = F.try_variant_get(parsed, path, "variant")
            error = F.when(~F.schema_of_variant(value).rlike(TYPES[rule["type"]]), F.lit(f"type:{field}"))
            number = F.try_variant_get(parsed, path, "double")
            if "min" in rule:
                error = error.when(number < rule["min"], F.lit(f"range:{field}"))
            if "max" in rule:
                error = error.when(number > rule["max"], F.lit(f"range:{field}"))
            absent = F.lit(f"missing:{field}") if rule.get("required") else F.lit(None).cast("string")
            found.append(F.array(F.when(value.isNull(), absent).otherwise(error)))
        out = F.when(tool == name, F.array_sort(F.array_compact(F.concat(*found)))).otherwise(out)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(is_object, out).otherwise(F.array(F.lit("object")))


def _unknown(key: Column) -> Column:
    return F.concat(F.lit("unknown:"), key)


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) for rows (conv_id, call_id, parent_id), unique by the first two."""
    known = calls.select("conv_id", F.col("call_id").alias("parent_id"), F.lit(True).alias("known"))
    state = calls.select("conv_id", "call_id", "parent_id").join(known, ["conv_id", "parent_id"], "left")
    up = F.when(F.col("known"), F.col("parent_id"))
    state = store(state.select("conv_id", "call_id", up.alias("up"), up.isNotNull().cast("int").alias("depth")), "depths")
    reach, n = 1, state.count()
    while reach <= n and not state.where("up is not null").isEmpty():
        ends = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        moved = state.where("up is not null").join(ends, ["conv_id", "up"])
        moved = moved.select("conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        after = store(state.where("up is null").unionByName(moved), "depths")
        discard(state)
        state, reach = after, reach * 2
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per call or orphan result, from calls (conv_id, call_id, parent_id, turn, tool, arguments)
    and results (conv_id, call_id, turn): both with status, depth, errors, result_turn."""

    def first(df: DataFrame, *columns: str) -> DataFrame:
        kept = df.where("conv_id is not null and call_id is not null")
        return kept.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", *columns)).alias("first"))

    own = first(calls, "parent_id", "tool", "arguments").select("conv_id", "call_id", "first.*")
    own = store(own, "calls")
    answers = first(results).select("conv_id", "call_id", F.col("first.turn").alias("result_turn"))
    linked = own.join(depths(own), ["conv_id", "call_id"]).withColumn("is_call", F.lit(True))
    linked = linked.join(answers, ["conv_id", "call_id"], "full")
    status = (
        F.when(F.col("is_call").isNull(), "orphan")
        .when(F.col("depth").isNull(), "cycle")
        .when(F.col("result_turn").isNull(), "unanswered")
        .otherwise("answered")
    )
    lost = F.when((F.col("depth") == 0) & F.col("parent_id").isNotNull(), F.array(F.lit("parent")))
    errors = F.concat(F.coalesce(lost, F.array().cast("array<string>")), argument_errors(F.col("tool"), F.col("arguments"), schemas))
    return linked.select(
        "conv_id", "call_id", "turn", "parent_id", "tool", "arguments", "depth", "result_turn",
        status.alias("status"), F.when(F.col("is_call"), errors).alias("errors"),
    )


def message_lines(messages: DataFrame, linked: DataFrame) -> DataFrame:
    """One row per message (conv_id, turn, role, text): call_id, status, depth, errors and ``line``.

    A message that issues a call carries it as ``call``, one that answers a call names it in
    ``answers``. Parallel calls of a message are its ``calls``, in order of their ids, and parallel
    answers its ``answer_ids``; ``call_id``, ``status`` and ``errors`` then list all, joined by
    ``;``, and ``depth`` is the greatest. Sort by conv_id, depth, turn to write whole conversations in
    dependency order.
    """
    calls = linked.where("status <> 'orphan'").groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(F.struct("call_id", "status", "depth", "errors", "tool", "parent_id", "arguments"))).alias("issued")
    )
    answered = linked.where("result_turn is not null").groupBy("conv_id", F.col("result_turn").alias("turn")).agg(
        F.sort_array(F.collect_list(F.struct("call_id", "status", "depth"))).alias("given")
    )
    # A row per message with calls, and per message with answers: messages stay one row each.
    rows = messages.select("conv_id", "turn", "role", "text").join(calls, ["conv_id", "turn"], "left")
    rows = rows.join(answered, ["conv_id", "turn"], "left")

    def written(c: Column) -> Column:
        return F.struct(
            F.try_parse_json(c["arguments"]).alias("arguments"), c["parent_id"].alias("depends_on"),
            c["call_id"].alias("id"), c["tool"].alias("tool"), (F.size(c["errors"]) == 0).alias("valid"),
        )

    def listed(name: str) -> Column:
        return F.when(F.size("issued") > 0, F.array_join(F.col(f"issued.{name}"), ";")).otherwise(F.array_join(F.col(f"given.{name}"), ";"))

    one, many = F.size("issued") == 1, F.size("issued") > 1
    line = F.to_json(
        F.struct(
            F.when(F.size("given") > 1, F.col("given.call_id")).alias("answer_ids"),
            F.when(F.size("given") == 1, F.col("given")[0]["call_id"]).alias("answers"),
            F.when(one, written(F.col("issued")[0])).alias("call"),
            F.when(many, F.transform("issued", written)).alias("calls"),
            F.col("text").alias("content"),
            "role",
            "turn",
        )
    )
    errors = F.transform(F.col("issued.errors"), lambda e: F.array_join(e, ","))
    return rows.select(
        "conv_id", "turn", "role", listed("call_id").alias("call_id"), F.coalesce(listed("status"), F.lit("plain")).alias("status"),
        F.coalesce(F.array_max("issued.depth"), F.array_max("given.depth")).alias("depth"),
        F.array_join(errors, ";").alias("errors"), line.alias("line"),
    )
