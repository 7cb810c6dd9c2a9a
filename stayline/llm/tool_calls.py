"""Tool calls of conversations: linked to results, ordered, validated, in canonical JSON.

Messages are rows ``conv_id, turn, role, content``. An ``assistant`` message may hold
``{"tool_calls": [{"id", "name", "arguments", "after"}]}``, a ``tool`` message
``{"results": [{"tool_call_id", "content"}]}``; ``arguments`` is JSON text, ``after`` lists the
ids of calls that must be done before.

* Results are hash-joined to calls by conversation and id, so a conversation of any length is
  spread over all tasks.
* The order is topological: by turn, within a turn by level, over all its messages. Levels are
  longest paths among the calls of one turn, relaxed until nothing changes; calls still rising
  after as many rounds as there are calls are in or behind a cycle. A dependency on a later message can never be met and is an error of its
  own, as it would have to be part of a cycle through time; so no rounds over the data are needed.
* Arguments are checked against the tool's schema (a parameter of the job).
* Canonical JSON has sorted keys and no blanks, at every depth.

One row per call, and one per result without a call. All of it is DataFrame functions.
Defined results: messages that are no JSON hold no calls; NULL ids are errors and link to
nothing; of calls that share an id in one conversation the first counts, of results likewise,
and the others are reported; repeated message rows are read once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import written

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:array<string>>>>"
RESULTS = "struct<results:array<struct<tool_call_id:string,content:string>>>"

# JSON type names of variants; a whole number is also a number.
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DECIMAL.*|DOUBLE)$",
         "boolean": "^BOOLEAN$", "array": "^ARRAY<.*", "object": "^OBJECT<.*"}


def _held(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows with computed columns that later expressions take as they are: a generated column
    is never copied into the lambdas that read it."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _levels(needs: str) -> Column:
    """The level of each call of a turn from the places of the calls it needs; the number of
    calls and more within or behind a cycle.

    Levels are relaxed until a round changes none, so as often as the longest chain is long; a
    cycle goes on rising until every level outside of it is known.
    """
    start = F.transform(needs, lambda _: F.lit(0))

    def relax(levels: Column) -> Column:
        return F.transform(needs, lambda ds: F.coalesce(
            F.array_max(F.transform(ds, lambda d: F.get(levels, d) + 1)), F.lit(0)
        ))

    def step(state: Column, _) -> Column:
        again = F.transform(F.array(relax(state["levels"])), lambda new: F.struct(
            new.alias("levels"), (new == state["levels"]).alias("done")
        ))[0]
        return F.when(state["done"], state).otherwise(again)

    return F.aggregate(
        F.sequence(F.lit(0), F.size(needs)),
        F.struct(start.alias("levels"), F.forall(needs, lambda ds: F.size(ds) == 0).alias("done")),
        step, lambda state: state["levels"],
    )


def calls_of(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, place, level, in_cycle, call_id, name, arguments, after``.

    All messages of one conversation and turn are judged together; places run over them in the
    order of their contents.
    """
    read = messages.where(F.col("role") == "assistant").select("conv_id", "turn", "content").distinct()
    read = read.select("conv_id", "turn", "content", F.from_json("content", CALLS)["tool_calls"].alias("calls"))
    read = read.where(F.size("calls") > 0).groupBy("conv_id", "turn").agg(
        F.array_sort(F.collect_list(F.struct("content", "calls"))).alias("said")
    )
    read = _held(read, calls=F.flatten(F.transform("said", lambda m: m["calls"]))).drop("said")
    read = _held(read, ids=F.transform("calls", lambda c: F.coalesce(c["id"], F.lit(""))))
    # Of calls of one id the first is meant; what no call of the turn has needs no order in it.
    read = _held(read, needs=F.transform("calls", lambda c: F.filter(
        F.transform(
            F.coalesce(c["after"], F.array().cast("array<string>")),
            lambda d: F.coalesce(F.array_position("ids", d), F.lit(0)).cast("int") - 1,
        ), lambda place: place >= 0,
    )))
    read = _held(read, levels=_levels("needs"))
    return read.select(
        "conv_id", "turn", F.size("calls").alias("n"),
        F.posexplode_outer(F.arrays_zip("calls", "levels")).alias("place", "c"),
    ).select(
        "conv_id", "turn", "place", F.col("c.levels").alias("level"),
        (F.col("c.levels") >= F.col("n")).alias("in_cycle"), F.col("c.calls.id").alias("call_id"),
        F.col("c.calls.name").alias("name"), F.col("c.calls.arguments").alias("arguments"),
        F.col("c.calls.after").alias("after"),
    )


def results_of(messages: DataFrame) -> DataFrame:
    """``conv_id, result_turn, result_place, call_id, result``."""
    read = messages.where(F.col("role") == "tool").select("conv_id", "turn", "content").distinct()
    return read.select(
        "conv_id", F.col("turn").alias("result_turn"),
        F.posexplode(F.from_json("content", RESULTS)["results"]).alias("result_place", "r"),
    ).select("conv_id", "result_turn", "result_place", F.col("r.tool_call_id").alias("call_id"),
             F.col("r.content").alias("result"))


def _quoted(text: str | Column) -> Column:
    """A text as a JSON string: a list of it without the brackets."""
    listed = F.to_json(F.to_variant_object(F.array(text)))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def argument_errors(variant: str, text: str, schemas: dict) -> Column:
    """The errors of the arguments as a list of ``kind:parameter``, by the tool's schema.

    ``schemas``: tool to ``{parameter: (type, required)}``.
    """
    none = F.array().cast("array<string>")

    def checks(params: dict) -> Column:
        found = []
        for name, (kind, required) in sorted(params.items()):
            path = "$['" + name.replace("'", "\\'") + "']"
            value = F.try_variant_get(F.col(variant), path, "variant")
            typed = F.schema_of_variant(value).rlike(TYPES[kind])
            missing = F.lit(f"missing:{name}") if required else F.lit(None).cast("string")
            found.append(F.when(value.isNull(), missing).when(~typed, F.lit(f"type:{name}")))
        extra = F.transform(
            F.array_except(F.json_object_keys(text), F.array(*map(F.lit, sorted(params)))),
            lambda k: F.concat(F.lit("unexpected:"), k),
        )
        return F.concat(F.array_compact(F.array(*found)), F.array_sort(extra))

    known = reduce(
        lambda chain, item: chain.when(F.col("name") == item[0], checks(item[1])),
        sorted(schemas.items()), F.when(F.col("name").isNull(), F.array(F.lit("no_name"))),
    ).otherwise(F.array(F.lit("unknown_tool")))
    is_object = F.schema_of_variant(F.col(variant)).rlike(TYPES["object"])
    return F.when(F.col(variant).isNull(), F.array(F.lit("malformed"))).when(
        ~is_object, F.array(F.lit("no_object"))
    ).otherwise(F.coalesce(known, none))


def link(messages: DataFrame, schemas: dict) -> DataFrame:
    """``conv_id, turn, level, place, call_id, name, status, errors, result_turn, call``.

    ``turn, level, place`` sort the calls of a conversation in a topological order. ``status``
    is ``ok``, ``invalid`` (see ``errors``), ``no_result`` or ``orphan_result``. ``call`` is the
    canonical JSON of an ``ok`` call with its result.
    """
    by = ["conv_id", "call_id"]
    # Read several times below, and parsed once: both are written.
    calls, results = written(calls_of(messages), "calls"), written(results_of(messages), "results")
    first_call = calls.where("call_id IS NOT NULL").groupBy(*by).agg(
        F.min(F.struct("turn", "place")).alias("first")
    )
    first_result = results.where("call_id IS NOT NULL").groupBy(*by).agg(
        F.min(F.struct("result_turn", "result_place", "result")).alias("r")
    )
    same = [F.col(f"c.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by]

    # What each dependency finds: its call's turn, or nothing.
    needs = calls.where(F.size("after") > 0).select(
        "conv_id", F.col("turn").alias("from_turn"), F.col("place").alias("from_place"),
        F.explode("after").alias("call_id"),
    )
    met = needs.alias("c").join(first_call.alias("o"), same, "left").select(
        "c.conv_id", "from_turn", "from_place", F.col("o.first.turn").alias("dep_turn"),
    ).groupBy("conv_id", "from_turn", "from_place").agg(
        F.max(F.col("dep_turn").isNull()).alias("unknown"),
        F.max(F.coalesce(F.col("dep_turn") > F.col("from_turn"), F.lit(False))).alias("forward"),
    ).withColumnsRenamed({"conv_id": "m_conv"})

    full = (
        calls.alias("c").join(first_call.alias("o"), same, "left")
        .join(first_result.select(
            F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_id"), "r"
        ), F.col("c.conv_id").eqNullSafe(F.col("r_conv")) & (F.col("c.call_id") == F.col("r_id")), "left")
        .join(met, F.col("c.conv_id").eqNullSafe(F.col("m_conv"))
              & (F.col("c.turn") == F.col("from_turn")) & (F.col("c.place") == F.col("from_place")), "left")
        .select("c.*", "first", "r", "unknown", "forward",
                F.try_parse_json("arguments").alias("parsed"))
    )
    is_first = (F.col("first.turn") == F.col("turn")) & (F.col("first.place") == F.col("place"))
    own = F.array_compact(F.array(
        F.when(F.col("call_id").isNull(), F.lit("no_id")),
        F.when(F.col("call_id").isNotNull() & ~is_first, F.lit("repeated_id")),
        F.when(F.col("in_cycle"), F.lit("cycle")),
        F.when(F.col("unknown"), F.lit("unknown_dependency")),
        F.when(F.col("forward"), F.lit("later_dependency")),
        F.when(F.col("r.result_turn") < F.col("turn"), F.lit("early_result")),
    ))
    judged = full.withColumn(
        "errors", F.concat(own, argument_errors("parsed", "arguments", schemas))
    ).withColumn("status", F.when(F.size("errors") > 0, "invalid").when(
        F.col("r").isNull(), "no_result"
    ).otherwise("ok"))
    canonical = F.concat(
        F.lit('{"arguments":'), F.to_json("parsed"), F.lit(',"id":'), _quoted("call_id"),
        F.lit(',"name":'), _quoted("name"), F.lit(',"result":'), _quoted("r.result"), F.lit("}"),
    )
    rows = judged.select(
        "conv_id", "turn", "level", "place", "call_id", "name", "status",
        F.array_join("errors", ",").alias("errors"), F.col("r.result_turn").alias("result_turn"),
        F.when(F.col("status") == "ok", canonical).alias("call"),
    )
    orphans = results.alias("c").join(first_call.alias("o"), same, "left_anti")
    extra = results.alias("c").join(
        first_result.select(*by, F.col("r.result_turn").alias("t"), F.col("r.result_place").alias("p")).alias("o"),
        same,
    ).where("result_turn <> t OR result_place <> p").join(first_call.alias("f"), [
        F.col("c.conv_id").eqNullSafe(F.col("f.conv_id")), F.col("c.call_id") == F.col("f.call_id")
    ], "left_semi")
    null = F.lit(None)

    def unlinked(table: DataFrame, error: str) -> DataFrame:
        return table.select(
            "c.conv_id", F.col("result_turn").alias("turn"), null.cast("int").alias("level"),
            F.col("result_place").alias("place"), "c.call_id", null.cast("string").alias("name"),
            F.lit("orphan_result").alias("status"), F.lit(error).alias("errors"),
            F.col("result_turn"), null.cast("string").alias("call"),
        )

    return rows.union(unlinked(orphans, "no_call")).union(unlinked(extra, "repeated_result"))


# --- messages that carry calls, derived from plain conversations ---

SCHEMAS = {
    "search": {"query": ("string", True), "limit": ("integer", True), "exact": ("boolean", False)},
    "lookup": {"query": ("string", True), "tags": ("array", False)},
    "answer": {"query": ("string", True), "limit": ("number", False), "options": ("object", False)},
}


def messages_from(conversations: DataFrame) -> DataFrame:
    """Every line a user writes becomes a call, every line of the next answer a result.

    Names, arguments and dependencies follow from a check sum of the line, faults included.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    call_id = lambda turn, k: F.concat_ws("-", F.lit("c"), F.col("conv_id"), turn, k)

    def call(line: Column, k: Column) -> Column:
        sum_ = F.crc32(line)
        words = F.size(F.split(line, " "))
        plain = F.concat(
            F.lit('{"query": '), _quoted(line), F.lit(', "limit": '), words,
            F.when(sum_ % 5 == 0, F.lit(', "exact": "yes"')).otherwise(F.lit("")), F.lit("}"),
        )
        after = (
            F.when(sum_ % 3 == 0, F.array(call_id(F.col("turn"), k + 1)))
            .when(sum_ % 3 == 1, F.array(call_id(F.col("turn") - 2, F.lit(0)), call_id(F.col("turn"), k - 1)))
            .otherwise(F.array().cast("array<string>"))
        )
        return F.struct(
            call_id(F.col("turn"), k).alias("id"),
            F.element_at(F.array(*map(F.lit, [*SCHEMAS, "unlisted"])), (sum_ % 4).cast("int") + 1).alias("name"),
            F.when(sum_ % 11 == 0, F.lit("{")).otherwise(plain).alias("arguments"),
            after.alias("after"),
        )

    asked = F.to_json(F.struct(F.transform(lines, call).alias("tool_calls")))
    told = F.to_json(F.struct(F.transform(lines, lambda line, k: F.struct(
        call_id(F.col("turn") - 1, k).alias("tool_call_id"), line.alias("content")
    )).alias("results")))
    return conversations.select(
        "conv_id", "turn",
        F.when(F.col("role") == "user", "assistant").when(F.col("role") == "assistant", "tool")
        .otherwise(F.col("role")).alias("role"),
        F.when(F.col("role") == "user", asked).when(F.col("role") == "assistant", told)
        .otherwise(text).alias("content"),
    )
