"""Chat formatting: link tool calls with their results and write canonical JSON.

A message may hold ``<tool_call>{"id", "name", "arguments"}</tool_call>`` and
``<tool_result>{"id", "content"}</tool_result>`` parts. Calls and results of a conversation are
hash-joined by identifier, one row per identifier on each side, so repeated identifiers cannot fan
out. A call that names another's identifier as ``"$<id>"`` in its arguments depends on it; levels
of the dependency graph are found by joins over calls only, each round stored: chains of calls with
one need are followed by doubling jumps, in as many rounds as the logarithm of the longest, then
calls with several needs in as many rounds as they are nested. Arguments are validated against the
tools' schemas. Every message becomes one line of JSON with sorted keys.

Messages without such parts, nearly all of them, are formatted in the scan and never shuffled;
nothing is collected per conversation, so one may hold any share of all rows.

Defined results: a NULL text is JSON null; a part that is not valid JSON is a call or result
without identifier, invalid and unlinked; of repeated identifiers the first call and the last
result count; a result links only to a call of the same or an earlier turn; calls on a cycle, or
that depend on one, or on an unknown identifier, have level -1; lists follow the text, and ``order``
numbers them topologically: by level, unresolved ones last, then by place; repeated rows are formatted each for
itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm.store import dropped, stored

CALL = r"(?s)<tool_call>(.*?)</tool_call>"
RESULT = r"(?s)<tool_result>(.*?)</tool_result>"

#: Tools and their parameters: name -> (type, required). A parameter of the operator.
TOOLS: Mapping[str, Mapping[str, tuple[str, bool]]] = {
    "search": {"query": ("string", True), "limit": ("integer", False)},
    "calculate": {"expression": ("string", True)},
    "fetch": {"url": ("string", True), "headers": ("object", False)},
}

_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|DECIMAL.*",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
}
_CALLS = "array<struct<arguments:string,id:string,level:int,linked:boolean,name:string,order:int,result:string,valid:boolean>>"
_RESULTS = "array<struct<content:string,id:string,level:int,linked:boolean,order:int>>"
_KEY = ["_conv", "_turn", "_digest"]


def with_tool_parts(conversations: DataFrame) -> DataFrame:
    """Derive calls and results from turns that hold neither, without looking at other rows.

    A user turn calls a tool by an identifier of its own and names an earlier user turn; a quarter of
    the calls have an argument of the wrong type. An assistant turn answers the turn before it.
    References go back half the way, so chains grow with the logarithm of a conversation's length.
    """
    text, turn = F.col("text"), F.col("turn")
    about = F.translate(text, "<>$", "")
    back = (turn - 2 * F.ceil(turn / 4)).cast("long")
    given = F.when(turn >= 2, F.concat(F.lit("$t"), back)).otherwise(about)
    kind = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4))

    def call(name: str, *arguments: Column) -> Column:
        return F.to_json(
            F.struct(F.concat(F.lit("t"), turn).alias("id"), F.lit(name).alias("name"), F.struct(*arguments).alias("arguments"))
        )

    size = F.length(text)
    part = (
        F.when(kind == 0, call("search", given.alias("query"), size.alias("limit")))
        .when(kind == 1, call("calculate", given.alias("expression")))
        .when(kind == 2, call("fetch", given.alias("url"), F.struct(about.alias("from")).alias("headers")))
        .otherwise(call("search", given.alias("query"), size.cast("string").alias("limit")))
    )
    content = F.struct(size.alias("size"), about.alias("about"))
    answer = F.to_json(F.struct(F.concat(F.lit("t"), turn - 1).alias("id"), content.alias("content")))
    asked = F.concat(text, F.lit("<tool_call>"), part, F.lit("</tool_call>"))
    answered = F.concat(text, F.lit("<tool_result>"), answer, F.lit("</tool_result>"))
    told = F.when(F.col("role") == "user", asked).when((F.col("role") == "assistant") & (turn > 0), answered)
    bare = ~(text.rlike(CALL) | text.rlike(RESULT)) & turn.isNotNull()
    return conversations.withColumn("text", F.when(bare, F.coalesce(told, text)).otherwise(text))


def canonical_json(variant: Column) -> Column:
    """Keys sorted, no white space: variants keep the fields of objects in the order of keys."""
    return F.to_json(variant)


def valid_arguments(name: Column, arguments: Column, tools=TOOLS) -> Column:
    """Whether ``arguments`` (a variant) fit the schema of tool ``name``."""
    verdict = F.lit(False)
    for tool, parameters in tools.items():
        keys = F.json_object_keys(F.to_json(arguments))
        fits = F.size(F.array_except(keys, F.array(*map(F.lit, parameters)))) == 0
        for parameter, (kind, required) in parameters.items():
            value = F.variant_get(arguments, f"$['{parameter}']", "variant")
            typed = F.schema_of_variant(value).rlike(f"^({_TYPES[kind]})$")
            fits = fits & F.coalesce(typed, F.lit(not required))
        verdict = F.when(name == tool, F.coalesce(fits, F.lit(False))).otherwise(verdict)
    return F.coalesce(verdict, F.lit(False))


def _parts(marked: DataFrame, pattern: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(1))
    rows = marked.select(*_KEY, F.posexplode(found).alias("place", "raw")).distinct()
    return rows.withColumn("part", F.try_parse_json("raw"))


def tool_calls(marked: DataFrame, tools=TOOLS) -> DataFrame:
    part = F.col("part")
    arguments = F.try_variant_get(part, "$.arguments", "variant")
    rows = _parts(marked, CALL).select(
        *_KEY,
        "place",
        F.try_variant_get(part, "$.id", "string").alias("id"),
        F.try_variant_get(part, "$.name", "string").alias("name"),
        arguments.alias("arguments"),
    )
    refers = F.regexp_extract_all(F.to_json("arguments"), F.lit(r'"\$([^"$]+)"'), F.lit(1))
    return rows.withColumns(
        {
            "valid": valid_arguments(F.col("name"), F.col("arguments"), tools) & F.col("id").isNotNull(),
            "needs": F.coalesce(F.array_distinct(refers), F.array().cast("array<string>")),
            "arguments": canonical_json(F.col("arguments")),
        }
    )


def tool_results(marked: DataFrame) -> DataFrame:
    part = F.col("part")
    return _parts(marked, RESULT).select(
        *_KEY,
        "place",
        F.try_variant_get(part, "$.id", "string").alias("id"),
        canonical_json(F.try_variant_get(part, "$.content", "variant")).alias("content"),
    )


def _jumps(ids: DataFrame) -> DataFrame:
    """(_conv, id, jump, dist): where the chain of calls with a single need ends, and its length.

    Jumps double in each round. Those that lead to a cycle never end and still name a call with a
    single need after as many rounds as the longest possible chain takes.
    """
    jumps = ids.where(F.size("needs") == 1).select("_conv", "id", F.col("needs")[0].alias("jump"), F.lit(1).cast("long").alias("dist"))
    jumps = stored(jumps, "jumps")
    for _ in range(jumps.count().bit_length() + 1):
        ahead = jumps.select("_conv", F.col("id").alias("jump"), F.col("jump").alias("next"), F.col("dist").alias("more"))
        moved = jumps.join(ahead, ["_conv", "jump"], "left").select(
            "_conv",
            "id",
            F.coalesce("next", "jump").alias("jump"),
            (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"),
            F.col("next").isNotNull().alias("moved"),
        )
        after = stored(moved, "jumps")
        dropped(jumps)
        jumps = after
        if not jumps.where("moved").limit(1).count():
            break
    return jumps.select("_conv", "id", "jump", "dist")


def call_levels(calls: DataFrame) -> DataFrame:
    """(_conv, id, level): 0 without dependencies, else one more than the deepest; -1 if none."""
    ids = stored(
        calls.where("id IS NOT NULL")
        .groupBy("_conv", "id")
        .agg(F.array_distinct(F.flatten(F.collect_set("needs"))).alias("needs")),
        "needs",
    )
    jumps = _jumps(ids)
    ends = ids.where(F.size("needs") != 1)
    start = F.when(F.size("needs") == 0, 0).otherwise(-1).cast("long")
    levels = stored(ends.select("_conv", "id", start.alias("level"), F.lit(True).alias("fresh")), "levels")
    # What calls with several needs wait for: the ends of the chains that they name.
    several = ends.select("_conv", "id", F.explode("needs").alias("need"))
    chains = jumps.withColumnRenamed("id", "need")
    needs = several.join(chains, ["_conv", "need"], "left").select(
        "_conv", "id", F.coalesce("jump", "need").alias("need"), F.coalesce("dist", F.lit(0)).alias("dist")
    )
    needs = stored(needs, "needs")
    while needs.limit(1).count() and levels.where("fresh").limit(1).count():
        known = levels.select("_conv", F.col("id").alias("need"), F.col("level").alias("below"))
        ready = needs.join(known, ["_conv", "need"], "left").groupBy("_conv", "id")
        deepest = F.max(F.col("below") + F.col("dist")).alias("most")
        ready = ready.agg(F.min(F.coalesce("below", F.lit(-1))).alias("least"), deepest).where("least >= 0")
        after = levels.join(ready.select("_conv", "id", "most"), ["_conv", "id"], "left")
        fresh = (F.col("level") < 0) & F.col("most").isNotNull()
        now = F.when(fresh, F.col("most") + 1).otherwise(F.col("level"))
        after = stored(after.select("_conv", "id", now.alias("level"), fresh.alias("fresh")), "levels")
        dropped(levels)
        levels = after
    below = levels.select("_conv", F.col("id").alias("jump"), F.col("level").alias("below"))
    deeper = F.when(F.col("below") >= 0, F.col("below") + F.col("dist")).otherwise(-1)
    along = jumps.join(below, ["_conv", "jump"], "left").select("_conv", "id", deeper.alias("level"))
    return levels.select("_conv", "id", "level").union(along).withColumn("level", F.col("level").cast("int"))


def _ordered(parts: str, kind: str, schema: str) -> Column:
    """The parts in the order of the text, each with its place in the topological order."""
    last = F.lit(2**31 - 1)
    rank = lambda p: F.struct(F.when(p[kind]["level"] < 0, last).otherwise(p[kind]["level"]), p["place"])
    places = F.transform(F.array_sort(F.transform(parts, rank)), lambda r: r["place"])
    names = [f.split(":")[0] for f in schema.removeprefix("array<struct<").removesuffix(">>").split(",")]

    def told(p: Column) -> Column:
        order = (F.array_position(places, p["place"]) - 1).cast("int")
        return F.struct(*((order if n == "order" else p[kind][n]).alias(n) for n in names))

    return F.transform(parts, told)


def _message(calls: Column, results: Column) -> Column:
    fields = {
        "content": F.col("text"),
        "conv_id": F.col("conv_id"),
        "role": F.col("role"),
        "tool_calls": calls,
        "tool_results": results,
        "turn": F.col("turn"),
    }
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"})


def format_chat(conversations: DataFrame, *, tools=TOOLS) -> DataFrame:
    """(conv_id, turn, role, n_calls, n_results, n_linked, n_valid, level, message) per message."""
    rows = conversations.select("conv_id", "turn", "role", "text")
    marks = F.coalesce(F.col("text").rlike(CALL) | F.col("text").rlike(RESULT), F.lit(False))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<string>")
    plain = rows.where(~marks).select(
        "conv_id", "turn", "role", zero.alias("n_calls"), zero.alias("n_results"), zero.alias("n_linked"),
        zero.alias("n_valid"), zero.alias("level"), _message(none, none).alias("message"),
    )
    keyed = rows.where(marks).withColumns(
        {"_conv": F.col("conv_id"), "_turn": F.col("turn"), "_digest": F.sha2("text", 256)}
    )
    calls, results = stored(tool_calls(keyed, tools), "calls"), stored(tool_results(keyed), "results")
    levels = call_levels(calls)
    by_call = calls.where("id IS NOT NULL").groupBy("_conv", "id").agg(F.min("_turn").alias("called"))
    by_result = results.where("id IS NOT NULL").groupBy("_conv", "id").agg(
        F.max("_turn").alias("answered"), F.max_by("content", F.struct("_turn", "place")).alias("answer")
    )
    linked = by_call.join(by_result, ["_conv", "id"]).where(F.col("called") <= F.col("answered"))
    links = stored(linked, "links")

    told = calls.join(levels, ["_conv", "id"], "left").join(links, ["_conv", "id"], "left")
    call = F.struct(
        "place",
        F.struct(
            "arguments",
            "id",
            F.coalesce("level", F.lit(-1)).alias("level"),
            F.col("answered").isNotNull().alias("linked"),
            "name",
            F.col("answer").alias("result"),
            "valid",
        ).alias("call"),
    )
    calls_in = told.groupBy(*_KEY).agg(F.array_sort(F.collect_list(call)).alias("calls"))
    answered = results.join(links.select("_conv", "id", "called"), ["_conv", "id"], "left").join(
        levels, ["_conv", "id"], "left"
    )
    sure = F.coalesce(F.col("called") <= F.col("_turn"), F.lit(False))
    result = F.struct(
        "place", F.struct("content", "id", F.coalesce("level", F.lit(-1)).alias("level"), sure.alias("linked")).alias("result")
    )
    results_in = answered.groupBy(*_KEY).agg(F.array_sort(F.collect_list(result)).alias("results"))

    def met(df: DataFrame, side: DataFrame, tag: str) -> DataFrame:
        renamed = side.select(*(F.col(k).alias(f"{tag}{k}") for k in _KEY), *[c for c in side.columns if c not in _KEY])
        on = [df[k].eqNullSafe(renamed[f"{tag}{k}"]) for k in _KEY]
        return df.join(renamed, on, "left")

    both = met(met(keyed, calls_in, "c"), results_in, "r")
    call_list, result_list = _ordered("calls", "call", _CALLS), _ordered("results", "result", _RESULTS)
    # A list is empty, not null, where a message has only the other kind of part.
    call_list = F.coalesce(call_list, F.from_json(F.lit("[]"), _CALLS))
    result_list = F.coalesce(result_list, F.from_json(F.lit("[]"), _RESULTS))
    count = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    deepest = F.greatest(
        F.array_max(F.transform("calls", lambda c: c["call"]["level"])),
        F.array_max(F.transform("results", lambda r: r["result"]["level"])),
    )
    marked = both.select(
        "conv_id",
        "turn",
        "role",
        count(F.col("calls")).alias("n_calls"),
        count(F.col("results")).alias("n_results"),
        (
            count(F.filter("calls", lambda c: c["call"]["linked"]))
            + count(F.filter("results", lambda r: r["result"]["linked"]))
        ).alias("n_linked"),
        count(F.filter("calls", lambda c: c["call"]["valid"])).alias("n_valid"),
        F.coalesce(deepest, F.lit(0)).cast("long").alias("level"),
        _message(call_list, result_list).alias("message"),
    )
    return plain.unionByName(marked)
