"""Tool-call linking: calls and results meet by identifier, are ordered, validated and written as canonical JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.session import checkpointed

EVENT = ["conv_id", "turn", "kind", "call_id", "name", "payload", "needs"]
# JSON type names of a schema and how they begin in the type of a parsed value.
JSON_TYPES = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
    "null": ("VOID",),
}


def _field_errors(parsed: Column, field: str, rule: dict) -> list[Column]:
    """What is wrong with one field of the arguments: null where a check holds."""
    path = f"$['{field}']"
    found = F.call_function("variant_get", parsed, F.lit(path), F.lit("variant"))
    kind = F.call_function("schema_of_variant", found)
    right = F.lit(False)
    for prefix in JSON_TYPES[rule["type"]]:
        right = right | kind.startswith(prefix)
    errors = [F.when(found.isNotNull() & ~right, F.lit(f"type:{field}"))]
    if rule.get("required"):
        errors.append(F.when(found.isNull(), F.lit(f"missing:{field}")))
    number = F.call_function("try_variant_get", parsed, F.lit(path), F.lit("double"))
    if "minimum" in rule:
        errors.append(F.when(right & (number < rule["minimum"]), F.lit(f"minimum:{field}")))
    if "maximum" in rule:
        errors.append(F.when(right & (number > rule["maximum"]), F.lit(f"maximum:{field}")))
    if "enum" in rule:
        text = F.call_function("try_variant_get", parsed, F.lit(path), F.lit("string"))
        errors.append(F.when(right & ~text.isin(rule["enum"]), F.lit(f"enum:{field}")))
    return errors


def argument_errors(name: Column, payload: Column, schemas: dict[str, dict[str, dict]]) -> Column:
    """Array of what is wrong with the JSON arguments of a call, empty when they fit the tool's schema."""
    parsed = F.try_parse_json(payload)
    is_object = F.coalesce(F.call_function("schema_of_variant", parsed).startswith("OBJECT"), F.lit(False))
    checks = F.lit(None)
    for tool, fields in schemas.items():
        unknown = F.array_except(F.json_object_keys(payload), F.array(*[F.lit(f) for f in fields]))
        errors = [e for field, rule in fields.items() for e in _field_errors(parsed, field, rule)]
        all_errors = F.concat(F.array_compact(F.array(*errors)), F.transform(unknown, lambda k: F.concat(F.lit("unknown:"), k)))
        checks = F.when(name == tool, all_errors).otherwise(checks)
    return F.when(~is_object, F.array(F.lit("arguments"))).otherwise(F.coalesce(checks, F.array(F.lit("tool"))))


def _levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``row``, ``level`` of the nodes of conversations whose turns contradict the links; those on a cycle get null.

    Rounds of: a node all of whose predecessors have a level comes after the last of them. As many rounds as the
    longest chain in these conversations; each round moves the open nodes only.
    """
    waiting = checkpointed(edges.groupBy("row").agg(F.count("*").alias("open")))
    level = checkpointed(nodes.join(waiting, "row", "left_anti").select("row", F.lit(0).cast("long").alias("level")))
    done, front, depth = level, level, 0
    links = edges
    while not front.isEmpty() and not waiting.isEmpty():
        depth += 1
        hits = links.join(front.select(F.col("row").alias("after")), "after").groupBy("row").agg(F.count("*").alias("hits"))
        left = waiting.join(hits, "row", "left").select("row", (F.col("open") - F.coalesce("hits", F.lit(0))).alias("open"))
        left = checkpointed(left)
        front = left.filter("open = 0").select("row", F.lit(depth).cast("long").alias("level"))
        waiting = left.filter("open > 0")
        done = checkpointed(done.unionByName(front))
    return done


def _first_of(rows: DataFrame, events: DataFrame, name: str) -> DataFrame:
    """``<name>_key`` and the first row of each key, a struct of ``at`` (its turn) and ``row``.

    Least turn, then least name, then least payload. Payloads are looked up only for rows that tie in the first two.
    """
    placed = rows.withColumn("at", F.coalesce("turn", F.lit(-(2**62))))
    tied = placed.groupBy("key", "at", "name").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("row"))
    first = checkpointed(tied.groupBy("key").agg(F.min(F.struct("at", "name", "n", "row")).alias("first")))
    own = F.struct("first.at", "first.row").alias(name)
    ties = first.filter("first.n > 1").select(F.struct("key", "first.at", "first.name").alias("tie"))
    if ties.isEmpty():
        return first.select(F.col("key").alias(f"{name}_key"), own)
    # Structs are compared field by field, null with null.
    same = placed.join(ties, F.struct("key", "at", "name") == F.col("tie"), "left_semi").select("key", "row")
    same = same.join(events.select("row", "payload"), "row")
    least = checkpointed(same.groupBy("key").agg(F.min(F.struct("payload", "row")).alias("least")).select(F.col("key").alias("tied_key"), "least.row"))
    first = first.join(least, F.col("key") == F.col("tied_key"), "left")
    row = F.coalesce(F.col("row"), F.col("first.row"))
    return first.select(F.col("key").alias(f"{name}_key"), F.struct("first.at", row.alias("row")).alias(name))


def _written(events: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """``row``, ``wrong`` (what is wrong with a call's arguments) and ``json``, one row per distinct event."""
    call = F.col("kind") == "call"
    none = F.array().cast("array<string>")
    wrong = F.when(call, argument_errors(F.col("name"), F.col("payload"), schemas)).otherwise(none)
    parsed = F.try_parse_json("payload")
    as_call = F.to_json(F.struct(parsed.alias("arguments"), "call_id", "kind", "name"))
    as_text = F.to_json(F.struct(F.when(call, F.col("payload")).alias("arguments"), "call_id", F.when(~call, F.col("payload")).alias("content"), "kind", "name"))
    text = F.when(call & parsed.isNotNull(), as_call).otherwise(as_text)
    return events.select("row", wrong.alias("wrong"), text.alias("json")).dropDuplicates(["row"])


def link_tool_calls(events: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """One row per distinct event: ``conv_id``, ``turn``, ``kind``, ``call_id``, ``step``, ``status``, ``errors``, ``json``.

    ``events`` has ``conv_id``, ``turn``, ``kind`` ("call", "result", else a message), ``call_id``, ``name``,
    ``payload`` (a call's arguments as JSON, else text) and ``needs`` (ids of calls whose results a call uses).
    ``schemas`` maps a tool to its fields: type, required, minimum, maximum, enum.

    A result belongs to the first call (least turn, then least name and arguments) of its conversation and id.
    Order: by ``step``, then ``turn``. Where every link points back in turns, ``step`` is the turn. Elsewhere it is
    the number of links before the event; events on or behind a cycle come last, with status "cycle".
    ``status``: "ok", "invalid" (see ``errors``), "unanswered", "orphan" (a result without its call), "duplicate"
    (a further call or result of an id), "cycle". ``json`` has sorted keys, no blanks and no null fields;
    arguments that are no JSON stay a string.

    Repeated rows are one event. A null conversation is a conversation, a null turn comes first, a null call id
    links to nothing, a null payload is no JSON for a call and no content otherwise; ``needs`` of unknown ids give
    an error. Nothing is gathered per conversation: one conversation may hold any share of the rows. Further
    columns are not read; an empty table gives no rows.
    """
    # Links need no payload: it moves once, as the finished JSON under the hash of its row. The hash covers names and
    # nulls too, so what differs in any field is another event.
    events = events.select(*EVENT).withColumn("row", F.md5(F.to_json(F.struct(*EVENT))))
    slim = checkpointed(events.select(*[c for c in EVENT if c != "payload"], "row").distinct())
    slim = slim.withColumn("key", F.when(F.col("kind").isin("call", "result") & F.col("call_id").isNotNull(), F.struct("conv_id", "call_id")))
    first_call = _first_of(slim.filter("kind = 'call' AND key IS NOT NULL"), events, "call")
    first_result = _first_of(slim.filter("kind = 'result' AND key IS NOT NULL"), events, "result")
    linked = slim.join(first_call, F.col("key") == F.col("call_key"), "left").join(first_result, F.col("key") == F.col("result_key"), "left")
    linked = checkpointed(
        linked.select(
            "conv_id", "turn", "kind", "call_id", "needs", "row", F.col("call.row").alias("call_row"), F.col("call.at").alias("call_at"),
            F.col("result.row").alias("result_row"),
        )
    )
    here = F.coalesce("turn", F.lit(-(2**62)))
    own = linked.filter("kind = 'result' AND call_row IS NOT NULL").select("conv_id", "row", F.col("call_row").alias("after"), here.alias("at"), F.col("call_at").alias("after_at"))
    asked = linked.filter("kind = 'call'").select("conv_id", "row", here.alias("at"), F.explode_outer(F.array_distinct("needs")).alias("need")).filter("need IS NOT NULL")
    asked = asked.withColumn("need_key", F.struct("conv_id", F.col("need").alias("call_id")))
    asked = asked.join(first_call, F.col("need_key") == F.col("call_key"), "left").join(first_result, F.col("need_key") == F.col("result_key"), "left")
    source = F.coalesce("result", "call")
    asked = checkpointed(asked.select("conv_id", "row", "at", "need", source["row"].alias("after"), source["at"].alias("after_at")))
    missing = asked.filter("after IS NULL").groupBy("row").agg(F.array_sort(F.collect_set(F.concat(F.lit("needs:"), "need"))).alias("missing"))
    edges = own.unionByName(asked.filter("after IS NOT NULL").select(*own.columns))
    edges = checkpointed(edges.distinct())
    twisted = checkpointed(edges.filter("after_at >= at").select("conv_id").distinct())

    steps = None
    if not twisted.isEmpty():
        inside = lambda df: df.join(twisted.withColumnRenamed("conv_id", "odd"), F.col("conv_id").eqNullSafe(F.col("odd")), "left_semi")
        nodes = checkpointed(inside(linked).select("row"))
        level = _levels(nodes, checkpointed(inside(edges).select("row", "after")))
        steps = nodes.join(level, "row", "left").select(F.col("row").alias("odd_row"), "level")
    whole = linked.join(missing.withColumnRenamed("row", "missing_row"), F.col("row") == F.col("missing_row"), "left")
    if steps is None:
        whole = whole.withColumn("odd_row", F.lit(None).cast("long")).withColumn("level", F.lit(None).cast("long"))
    else:
        whole = whole.join(steps, F.col("row") == F.col("odd_row"), "left")
    whole = whole.join(_written(events, schemas).withColumnRenamed("row", "text_row"), F.col("row") == F.col("text_row"))
    whole = whole.withColumn("errors", F.concat("wrong", F.coalesce("missing", F.array().cast("array<string>"))))
    twisting = F.col("odd_row").isNotNull() & F.col("level").isNull()
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    later = (call & (F.col("call_row") != F.col("row"))) | (result & (F.col("result_row") != F.col("row")))
    status = (
        F.when(twisting, "cycle")
        .when(F.coalesce(later, F.lit(False)), "duplicate")
        .when(result & F.col("call_row").isNull(), "orphan")
        .when(F.size("errors") > 0, "invalid")
        .when(call & F.col("result_row").isNull(), "unanswered")
        .otherwise("ok")
    )
    step = F.when(twisting, F.lit(2**62)).when(F.col("odd_row").isNotNull(), F.col("level")).otherwise(F.col("turn"))
    return whole.select(
        "conv_id", "turn", "kind", "call_id", step.alias("step"), status.alias("status"), F.concat_ws(",", "errors").alias("errors"), "json",
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` as events: an assistant turn calls a tool, a user turn answers the turn before it.

    A call of up to 30 words is a search (``query``, ``limit`` by its words), a longer one writes a note (``body``,
    ``words``); each builds on the call two turns earlier.
    """
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    search = F.to_json(F.struct(words.alias("limit"), F.col("text").alias("query")))
    note = F.to_json(F.struct(F.col("text").alias("body"), words.alias("words")))
    call, result = F.col("role") == "assistant", F.col("role") == "user"
    name_id = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(call, "call").when(result, "result").otherwise("message").alias("kind"),
        F.when(call, name_id(0)).when(result, name_id(1)).alias("call_id"),
        F.when(call, F.when(words <= 30, "search").otherwise("note")).alias("name"),
        F.when(call, F.when(words <= 30, search).otherwise(note)).otherwise(F.col("text")).alias("payload"),
        F.when(call & (F.col("turn") >= 3), F.array(name_id(2))).otherwise(F.array().cast("array<string>")).alias("needs"),
    )
