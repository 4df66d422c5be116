"""Tool-call linking: calls and results joined by identifier, ordered, checked, written as canonical JSON.

Calls and results are tables. ``calls_of`` takes them from conversations, in two forms:

* messages that are JSON: an assistant's ``{"tool_calls": [{"id", "name", "arguments", "after"}]}`` and a
  tool's ``{"tool_call_id", "content"}``; ``after`` lists the calls that must come first;
* plain turns, which are all other messages, JSON or not: each user message is a call of the tool ``reply`` with arguments ``prompt`` and ``turn``,
  whose result is the next turn if the assistant speaks it, and which comes after the conversation's
  call two turns before.

``link`` hash-joins calls and results by conversation and identifier, orders calls so that each comes after
those it names, validates arguments against the tools' schemas and serialises every call with its result.
A call that only names earlier calls is in order by its turn; levels are worked out only for conversations
in which a call names a later one: inside one row for those of up to ``ROW_CALLS`` calls, so that a long
chain costs no job of its own, and round by round over tables for larger ones. What can't be placed is in a
circle or after one.

Native: DataFrame functions only.

Defined results: a call without result has ``result`` null and status "open"; of several results of one id the
first by turn counts; a result without call is status "orphan", and so is, with ``call_id`` null and its text as result, each tool
message that names no call; repeated ids are separate calls that share the
result; arguments that are not a JSON object, unknown tools and names of calls that do not exist are errors
of the call, which stays; null messages are skipped; empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandtide.llm import base

#: Calls of a conversation that are ordered inside one row.
ROW_CALLS = 2000
#: Tools up to which their schemas are broadcast.
BROADCAST_TOOLS = 10_000
#: Schema types and the variant types they accept.
ACCEPTS = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}
REPLY = [("reply", "prompt", "string", True, 1.0), ("reply", "turn", "integer", True, 0.0)]


def reply_schema(spark: SparkSession) -> DataFrame:
    """Schema rows of the tool that plain turns call: ``least`` is a least length or value."""
    rows = ", ".join(f"('{name}', '{param}', '{kind}', {str(required).lower()}, {least}D)" for name, param, kind, required, least in REPLY)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, param, type, required, least)")


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls (conv_id, turn, place, call_id, name, arguments, after) and results (conv_id, turn,
    call_id, content) of a table conv_id, turn, role, text."""
    m = conversations.select("conv_id", "turn", "role", "text").filter(F.col("text").isNotNull())
    read = F.from_json("text", "tool_calls array<struct<id:string,name:string,arguments:string,after:array<string>>>, tool_call_id string, content string")
    m = m.withColumn("j", F.when(F.col("text").rlike(r"^\s*\{") & F.col("role").isin("assistant", "tool"), read))
    names = F.when(F.col("role") == "assistant", F.size("j.tool_calls") > 0).when(F.col("role") == "tool", F.col("j.tool_call_id").isNotNull())
    is_json = F.coalesce(names, F.lit(False))
    spoken = m.filter(is_json)
    asked = spoken.filter("role = 'assistant'").select("conv_id", "turn", F.posexplode("j.tool_calls").alias("place", "c"))
    asked = asked.select("conv_id", "turn", "place", F.col("c.id").alias("call_id"), F.coalesce("c.name", F.lit("")).alias("name"), F.coalesce("c.arguments", F.lit("")).alias("arguments"), F.coalesce("c.after", F.array().cast("array<string>")).alias("after"))
    told = spoken.filter("role = 'tool'").select("conv_id", "turn", F.col("j.tool_call_id").alias("call_id"), F.coalesce("j.content", F.lit("")).alias("content"))

    turn_id = lambda turn: F.concat(F.lit("turn-"), turn.cast("string"))
    plain = m.filter(~is_json)
    loose = plain.filter("role = 'tool'").select("conv_id", "turn", F.lit(None).cast("string").alias("call_id"), F.col("text").alias("content"))
    asks = plain.filter("role = 'user'")
    named = asks.select(F.col("conv_id").alias("p_conv"), (F.col("turn") + 2).alias("p_turn")).distinct()
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), F.col("turn").alias("turn")))
    asks = asks.join(named, asks["conv_id"].eqNullSafe(named["p_conv"]) & (asks["turn"] == named["p_turn"]), "left")
    before = F.when(F.col("p_turn").isNotNull(), F.array(turn_id(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    asks = asks.select("conv_id", "turn", F.lit(0).alias("place"), turn_id(F.col("turn")).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), before.alias("after"))
    answers = plain.filter("role = 'assistant'").select("conv_id", "turn", turn_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    # The turn before may be no call (two assistant turns in a row): then there is nothing to link.
    ids = asks.select(F.col("conv_id").alias("a_conv"), F.col("call_id").alias("a_id")).distinct()
    answers = answers.join(ids, answers["conv_id"].eqNullSafe(ids["a_conv"]) & (answers["call_id"] == ids["a_id"]), "left_semi")
    return asked.unionByName(asks), told.unionByName(loose).unionByName(answers)


def _levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of the calls of conversations whose turns are not in order; level -1:
    the call is in a circle or after one."""
    edge = calls.select("conv_id", "call_id", "turn", "place", F.explode("after").alias("first"))
    at = calls.groupBy("conv_id", F.col("call_id").alias("first")).agg(F.min(F.struct("turn", "place")).alias("at"))
    edge = base.kept(edge.join(at, ["conv_id", "first"]), "call-edges")
    odd = edge.filter(F.col("at") >= F.struct("turn", "place")).select("conv_id").distinct()
    todo = base.kept(edge.join(odd, "conv_id", "left_semi").select("conv_id", "call_id", "first").distinct(), "open-edges")
    rest = base.kept(calls.join(odd, "conv_id", "left_semi").select("conv_id", "call_id").distinct(), "open-calls")
    few = rest.groupBy("conv_id").agg(F.count("*").alias("n")).filter(F.col("n") <= ROW_CALLS).select("conv_id")
    done, level = _levels_in_rows(rest.join(few, "conv_id", "left_semi"), todo), 0
    rest, todo = rest.join(few, "conv_id", "left_anti"), todo.join(few, "conv_id", "left_anti")
    while not rest.isEmpty():
        ready = base.kept(rest.join(todo, ["conv_id", "call_id"], "left_anti"), "ready-calls")
        if ready.isEmpty():
            return done.union(rest.withColumn("level", F.lit(-1)))
        done = base.kept(done.union(ready.withColumn("level", F.lit(level))), "levels")
        placed = ready.select("conv_id", F.col("call_id").alias("first"))
        todo = base.kept(todo.join(placed, ["conv_id", "first"], "left_anti"), "open-edges")
        rest = base.kept(rest.join(ready, ["conv_id", "call_id"], "left_anti"), "open-calls")
        level += 1
    return done


def _levels_in_rows(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """The same for whole conversations, a row each: every pass puts each call one level above the highest it
    names, until nothing moves. Only circles move for as many passes as there are calls."""
    named = edges.groupBy("conv_id", "call_id").agg(F.collect_list("first").alias("firsts"))
    rows = calls.join(named, ["conv_id", "call_id"], "left").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("call_id", "firsts"))).alias("c"))
    rows = rows.withColumn("ids", F.col("c.call_id"))
    below = F.transform("c", lambda c: F.transform(F.coalesce(c["firsts"], F.array().cast("array<string>")), lambda f: F.array_position("ids", f).cast("int") - 1))
    rows = rows.withColumn("below", below)
    lift = lambda at: F.transform("below", lambda b: F.coalesce(F.array_max(F.transform(b, lambda i: F.get(at, i) + 1)), F.lit(0)))
    start = F.transform("ids", lambda _: F.lit(0))
    moved = F.aggregate(
        F.sequence(F.lit(1), F.size("ids")),
        F.struct(F.transform("ids", lambda _: F.lit(-1)).alias("was"), start.alias("at")),
        lambda s, _: F.when(s["was"] == s["at"], s).otherwise(F.struct(s["at"].alias("was"), lift(s["at"]).alias("at"))),
        lambda s: s["at"],
    )
    each = rows.withColumn("at", moved).select("conv_id", F.size("ids").alias("n"), F.explode(F.arrays_zip("ids", "at")).alias("x"))
    return each.select("conv_id", F.col("x.ids").alias("call_id"), F.when(F.col("x.at") >= F.col("n"), -1).otherwise(F.col("x.at")).alias("level"))


def _problems(v: Column, params: Column) -> Column:
    """What is wrong with arguments ``v`` (a variant) under ``params``; sorted."""
    def of(p: Column) -> Column:
        value = F.try_variant_get(v, F.concat(F.lit("$['"), p["param"], F.lit("']")), "variant")
        kind = F.schema_of_variant(value)
        accepted = F.coalesce(*[F.when(p["type"] == t, kind.rlike(f"^({pattern})$")) for t, pattern in ACCEPTS.items()], F.lit(True))
        text = F.to_json(value)
        # A JSON string has two quotes more than characters; escapes only lengthen it.
        size = F.when(kind == "STRING", F.length(text) - 2.0).otherwise(F.try_variant_get(value, F.lit("$"), "double"))
        small = p["least"].isNotNull() & kind.rlike("^(STRING|BIGINT|DOUBLE|FLOAT|DECIMAL.*)$") & (size < p["least"])
        return F.when(value.isNull(), F.when(p["required"], F.concat(F.lit("missing:"), p["param"]))).when(~accepted, F.concat(F.lit("type:"), p["param"])).when(small, F.concat(F.lit("small:"), p["param"]))

    return F.array_compact(F.transform(params, of))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and per result without one: conv_id, level, turn, place, call_id, name, status
    ("linked", "open", "orphan"), n_errors and json. Ordered by (level, turn, place) every call of a
    conversation follows those it names; level is -1 in a circle."""
    first = results.filter("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min_by(F.struct("turn", "content"), F.struct("turn", "content")).alias("r"))
    first = first.union(results.filter("call_id IS NULL").select("conv_id", "call_id", F.struct("turn", "content").alias("r")))
    calls = base.kept(calls, "calls")
    exists = calls.select("conv_id", F.col("call_id").alias("one")).distinct()
    # Names of calls that do not exist.
    named = calls.select("conv_id", "call_id", F.explode("after").alias("one")).distinct()
    lost = named.join(exists, ["conv_id", "one"], "left_anti").groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set(F.concat(F.lit("unknown call:"), "one"))).alias("lost"))
    joined = calls.join(first, ["conv_id", "call_id"], "full").join(_levels(calls), ["conv_id", "call_id"], "left").join(lost, ["conv_id", "call_id"], "left")
    tools = schemas.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("param", "type", "required", "least"))).alias("params"))
    joined = joined.join(base.small(tools, BROADCAST_TOOLS), "name", "left")

    none = F.array().cast("array<string>")
    joined = joined.withColumn("v", F.try_parse_json("arguments")).withColumn("keys", F.json_object_keys("arguments"))
    extra = F.transform(F.array_except(F.array_distinct("keys"), F.transform("params", lambda p: p["param"])), lambda k: F.concat(F.lit("unknown:"), k))
    checked = F.when(F.col("params").isNull(), F.array(F.lit("unknown tool"))).when(F.col("v").isNull() | F.col("keys").isNull(), F.array(F.lit("not an object"))).otherwise(F.concat(_problems(F.col("v"), F.col("params")), F.array_sort(extra)))
    is_call = F.col("turn").isNotNull()
    joined = joined.withColumn("errors", F.when(is_call, F.concat(checked, F.coalesce("lost", none))).otherwise(none))
    status = F.when(~is_call, "orphan").when(F.col("r").isNull(), "open").otherwise("linked")
    body = F.to_json(F.struct(F.col("errors"), F.col("call_id").alias("id"), F.col("name"), F.col("r.content").alias("result"), status.alias("status")), {"ignoreNullFields": "false"})
    arguments = F.coalesce(F.to_json("v"), F.to_json(F.col("arguments").cast("variant")), F.lit("null"))
    whole = F.concat(F.lit('{"arguments":'), arguments, F.lit(","), F.substr(body, F.lit(2)))
    # Parsed again, so that keys are in order at every depth.
    return joined.select(
        "conv_id",
        F.when(is_call, F.coalesce("level", F.lit(0))).alias("level"),
        F.coalesce("turn", F.col("r.turn")).alias("turn"),
        F.coalesce("place", F.lit(0)).alias("place"),
        "call_id",
        "name",
        status.alias("status"),
        F.size("errors").cast("bigint").alias("n_errors"),
        F.to_json(F.try_parse_json(whole)).alias("json"),
    )
