"""Chat formatting: tool calls linked with their results, ordered, validated, as canonical JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmill.llm.common import n_words, store

KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}
#: The tools of the calls that ``turn_calls`` makes of a chat.
TOOLS: dict[str, dict] = {
    "search": {
        "type": "object",
        "required": ["query", "top"],
        "properties": {
            "query": {"type": "string", "minLength": 1},
            "top": {"type": "integer", "minimum": 1, "maximum": 80},
            "after": {"type": "array", "items": {"type": "string"}},
        },
        "additionalProperties": False,
    },
    "lookup": {
        "type": "object",
        "required": ["query"],
        "properties": {
            "query": {"type": "string", "maxLength": 400},
            "top": {"type": "integer"},
            "after": {"type": "array", "maxItems": 4},
        },
    },
}
NAMES = ("search", "lookup", "recall")


def is_kind(value: object, kind: str) -> bool:
    return isinstance(value, KINDS[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def fits(value: object, schema: Mapping) -> bool:
    """Whether a JSON value obeys a schema of types, bounds, enumerations, items and properties."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(is_kind(value, kind) for kind in kinds):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return schema.get("minimum", value) <= value <= schema.get("maximum", value)
    if isinstance(value, str):
        return schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value))
    if isinstance(value, list):
        return len(value) <= schema.get("maxItems", len(value)) and all(fits(x, schema.get("items", {})) for x in value)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(name not in value for name in schema.get("required", ())):
            return False
        if schema.get("additionalProperties") is False and not value.keys() <= known.keys():
            return False
        return all(fits(x, known.get(name, {})) for name, x in value.items())
    return True


def number(text: str) -> int | float:
    """A number with a point or exponent: whole ones below 2^53 are integers, so 1, 1.0 and 1e0 are one value."""
    value = float(text)
    if not math.isfinite(value):
        raise ValueError("no finite number")
    return int(value) if value.is_integer() and abs(value) < 1 << 53 else value


def no_constant(name: str) -> object:
    raise ValueError(f"{name} is no JSON")


def parsed(text: object) -> object:
    """The JSON value of a text; ``...`` if it is none or holds a number that is not finite.

    Of a name that an object repeats the last value counts.
    """
    try:
        return json.loads(text, parse_constant=no_constant, parse_float=number) if isinstance(text, str) else ...
    except (ValueError, RecursionError):
        return ...


#: Halves of a surrogate pair without the other half.
LONE = re.compile("[\ud800-\udfff]")


def canonical(record: object) -> str:
    """Sorted keys, no blanks, unescaped letters; a lone surrogate, which no UTF-8 has, stays an escape."""
    text = json.dumps(record, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    return LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def levels(calls: DataFrame) -> DataFrame:
    """``call_id, level``: 0 for a call that needs none of the others, else one more than the
    highest level it needs; null on a cycle and behind one.

    Every round settles the calls whose needs are all settled, with joins on identifiers
    only, so there are as many rounds as the longest chain has calls. Needs of identifiers
    that no call has do not count.
    """
    ids = calls.select("call_id")
    needs = calls.select("call_id", F.explode("needs").alias("need")).distinct()
    needs = store(needs.join(ids.withColumnRenamed("call_id", "need"), "need", "left_semi"), "needs")
    settled = store(ids.join(needs, "call_id", "left_anti").withColumn("level", F.lit(0)), "level")
    level, open_ = 0, ids.join(settled, "call_id", "left_anti")
    while not open_.isEmpty():
        level += 1
        waits = needs.join(settled, needs["need"] == settled["call_id"], "left_anti").select("call_id")
        ready = store(open_.join(waits, "call_id", "left_anti").withColumn("level", F.lit(level)), "level")
        if ready.isEmpty():
            break
        settled = settled.unionByName(ready)
        open_ = store(open_.join(ready, "call_id", "left_anti"), "open")
    return ids.join(settled, "call_id", "left")


def link(calls: DataFrame, results: DataFrame, tools: Mapping[str, Mapping] = TOOLS) -> DataFrame:
    """One row per call identifier: ``conv_id, turn, call_id, name, level, status, canonical``.

    ``calls`` has ``conv_id, turn, call_id, name, arguments`` (JSON text) and ``needs`` (identifiers);
    ``results`` has ``call_id, turn, content``. Of repeated calls or results of an identifier
    the first by turn counts, ties by content; rows without an identifier are left out.
    ``level`` and ``turn`` give the order. ``status`` is the first that holds of ``unknown tool``,
    ``invalid`` (no JSON, or against the tool's schema), ``cycle``, ``no result``, ``ok``.
    ``canonical`` has sorted keys, no blanks and unescaped letters; arguments that are no JSON
    stand there as a string. An empty table gives no rows.
    """
    calls = calls.where(F.col("call_id").isNotNull())
    one = calls.groupBy("call_id").agg(F.min(F.struct("turn", "conv_id", "name", "arguments", "needs")).alias("_c"))
    one = store(one.select("call_id", "_c.*"), "calls")
    found = results.where(F.col("call_id").isNotNull()).groupBy("call_id").agg(
        F.min(F.struct("turn", "content")).alias("_r")
    )
    level = store(levels(one.select("call_id", F.coalesce("needs", F.array()).alias("needs"))), "levels")
    linked = one.join(found, "call_id", "left").join(level, "call_id")

    @F.pandas_udf("status string, canonical string")
    def formatted(ids: pd.Series, names: pd.Series, arguments: pd.Series, contents: pd.Series, at: pd.Series, has: pd.Series) -> pd.DataFrame:
        out = []
        for call_id, name, text, content, level_, result in zip(ids, names, arguments, contents, at, has, strict=True):
            value = parsed(text)
            name = name if isinstance(name, str) else None
            if name not in tools:
                status = "unknown tool"
            elif value is ... or not fits(value, tools[name]):
                status = "invalid"
            elif pd.isna(level_):
                status = "cycle"
            else:
                status = "ok" if result else "no result"
            record = {
                "arguments": (text if isinstance(text, str) else None) if value is ... else value,
                "id": call_id,
                "name": name,
                "result": content if isinstance(content, str) else None,
            }
            out.append((status, canonical(record)))
        return pd.DataFrame(out, columns=["status", "canonical"])

    made = formatted("call_id", "name", "arguments", F.col("_r.content"), "level", F.col("_r").isNotNull())
    return linked.withColumn("_made", made).select("conv_id", "turn", "call_id", "name", "level", "_made.*")


def turn_calls(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read out of plain chats, which hold no calls of their own.

    Each assistant turn is a call of a tool that its turn number chooses, with its text as
    the query and its number of words as ``top``; it needs the assistant turn at half its
    number. The next turn, if the assistant's turn has one, is the result.
    """
    name = F.element_at(F.array(*[F.lit(x) for x in NAMES]), (F.pmod(F.col("turn"), F.lit(len(NAMES))) + 1).cast("int"))

    def call_id(turn):
        return F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))

    usable = chats.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    asks = usable.where("role = 'assistant'").select("conv_id", "turn", "text", name.alias("name"))
    before = asks.select("conv_id", F.col("turn").alias("_half")).distinct()
    half = F.floor(F.col("turn") / 2)
    found = asks.withColumn("_half", half).join(before.withColumn("_is", F.lit(True)), ["conv_id", "_half"], "left")
    needs = F.when(F.col("_is") & (F.col("_half") != F.col("turn")), F.array(call_id(F.col("_half")))).otherwise(
        F.expr("cast(array() AS array<string>)")
    )
    calls = found.withColumn("needs", needs).select(
        "conv_id",
        "turn",
        call_id(F.col("turn")).alias("call_id"),
        "name",
        F.to_json(F.struct(F.col("text").alias("query"), n_words(F.col("text")).alias("top"), F.col("needs").alias("after"))).alias(
            "arguments"
        ),
        "needs",
    )
    results = usable.select(call_id(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results
