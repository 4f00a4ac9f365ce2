"""Tool calls of conversations: linked with their results, put in order, validated, written as canonical JSON.

Only column expressions, joins and aggregates are used. Calls and results meet in a join on conversation
and call id. The order puts a call after the one it follows: the number of calls before it in that
chain is found by pointer doubling, in as many joins as the longest chain has binary digits. Positions
come from one range exchange, so a conversation of any length spreads over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranks import with_rank

from .common import stored

# JSON schema types, and the variant types that fit them.
TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
    "null": "VOID",
}


@dataclass(frozen=True)
class Param:
    name: str
    type: str
    required: bool = False


@dataclass(frozen=True)
class Tool:
    name: str
    params: tuple[Param, ...]


class _Stored:
    """What the ranking helper writes with."""

    write = staticmethod(stored)


def chain_depths(calls: DataFrame) -> DataFrame:
    """``calls`` (conv_id, call_id, after) with ``depth``: how many calls come before in the chain.

    A call that follows nothing known has depth 0; one whose chain runs into a circle has null.
    """
    key = ["conv_id", "call_id"]
    known = calls.select("conv_id", F.col("call_id").alias("after"))
    rooted = calls.select(*key, "after").join(known.withColumn("known", F.lit(True)), ["conv_id", "after"], "left")
    jump = F.when(F.col("known"), F.col("after")).alias("jump")
    now = stored(rooted.select(*key, jump, F.when(F.col("known"), 1).otherwise(0).cast("long").alias("depth")))
    most = calls.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1
    for _ in range(most.bit_length() + 1):  # chains are no longer than the largest conversation has calls
        if not now.filter("jump is not null").limit(1).count():
            break
        there = now.select("conv_id", F.col("call_id").alias("jump"), F.col("jump").alias("next"), F.col("depth").alias("more"))
        moved = now.filter("jump is not null").join(there, ["conv_id", "jump"])
        moved = moved.select(*key, F.col("next").alias("jump"), (F.col("depth") + F.col("more")).alias("depth"))
        now = stored(moved.unionByName(now.filter("jump is null")))
    depth = F.when(F.col("jump").isNull(), F.col("depth")).alias("depth")
    return calls.join(now.select(*key, depth), key)


def argument_errors(tools: Sequence[Tool]) -> Column:
    """Sorted error codes of ``arguments`` (JSON text) of a call of ``tool``; an empty array if it is valid."""
    parsed = F.try_parse_json("arguments")
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    keys = F.json_object_keys("arguments")
    none = F.array().cast("array<string>")

    def of(tool: Tool) -> Column:
        codes = []
        for p in tool.params:
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{p.name}", "variant"))
            if p.required:
                codes.append(F.when(kind.isNull(), f"missing:{p.name}"))
            codes.append(F.when(kind.isNotNull() & ~kind.rlike(f"^(?:{TYPES[p.type]})$"), f"type:{p.name}"))
        unknown = F.array_except(keys, F.array(*[F.lit(p.name) for p in tool.params]).cast("array<string>"))
        unknown = F.transform(unknown, lambda k: F.concat(F.lit("unknown:"), k))
        return F.sort_array(F.concat(F.array_compact(F.array(*codes)) if codes else none, unknown))

    by_tool = reduce(lambda rest, t: F.when(F.col("tool") == t.name, of(t)).otherwise(rest), tools, F.array(F.lit("unknown_tool")))
    return F.when(is_object, by_tool).otherwise(F.array(F.lit("not_an_object")))


def canonical(column: str) -> Column:
    """JSON text as a variant: keys sorted, no white space, numbers in one form. Null if it does not parse."""
    return F.try_parse_json(column)


def link_calls(calls: DataFrame, results: DataFrame, tools: Sequence[Tool]) -> DataFrame:
    """Every call with its result, its place in the conversation, its errors and its canonical JSON.

    ``calls`` has conv_id, call_id, turn, tool, arguments (JSON text) and after (call_id or null); ``results``
    has conv_id, call_id, turn and content. Of calls with the same ids the first by turn, tool and
    arguments counts, of results the first by turn and content; ``copies`` tells how many there were.
    Positions start at 1 and follow depth, turn and call_id; calls in a circle come last, with the error
    ``circular``. Results without a call, and calls or results without conv_id or call_id, are not linked;
    :func:`unlinked` gives them. Null or broken arguments are the error ``not_an_object``.
    """
    key = ["conv_id", "call_id"]
    named = calls.filter("conv_id is not null and call_id is not null")
    first = F.min(F.struct("turn", "tool", "arguments", "after")).alias("first")
    one = stored(named.groupBy(*key).agg(first, F.count("*").alias("copies")).select(*key, "first.*", "copies"))
    answers = results.filter("conv_id is not null and call_id is not null").groupBy(*key)
    answers = answers.agg(F.min(F.struct("turn", "content")).alias("answer"), F.count("*").alias("n_results"))
    linked = chain_depths(one).join(answers, key, "left")
    ranked = with_rank(linked, ["conv_id", "depth", "turn", "call_id"], _Stored(), "rank")
    before = ranked.groupBy("conv_id").agg((F.min("rank") - 1).alias("before"))
    circular = F.when(F.col("depth").isNull(), F.array(F.lit("circular"))).otherwise(F.array().cast("array<string>"))
    message = F.struct(
        canonical("arguments").alias("arguments"),
        F.col("call_id").alias("id"),
        F.col("tool").alias("name"),
        F.col("answer.content").alias("result"),
    )
    return ranked.join(before, "conv_id").select(
        *key,
        (F.col("rank") - F.col("before")).alias("position"),
        "depth",
        "turn",
        "tool",
        F.col("answer.turn").alias("result_turn"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        "copies",
        F.concat(argument_errors(tools), circular).alias("errors"),
        F.to_json(message).alias("message"),
    )


def unlinked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results that no call has asked for, and calls and results without ids: ``kind``, conv_id, call_id, turn."""
    key = ["conv_id", "call_id"]
    alone = results.join(calls.select(*key).distinct(), key, "left_anti").select(*key, "turn")
    nameless = calls.filter("conv_id is null or call_id is null").select(*key, "turn")
    return alone.withColumn("kind", F.lit("result")).unionByName(nameless.withColumn("kind", F.lit("call")))
