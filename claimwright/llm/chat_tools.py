"""Tool calls in chats: linked to their results, ordered, validated, written as canonical JSON.

DataFrame functions only. Calls and results meet in a hash join on (conversation, call
id). A call may name calls it comes `after`, one or a list. Where it names one, how far
the chain reaches back is found by pointer doubling, in a number of joins that is the
logarithm of the longest chain; calls that come after several are then taken level by
level, each once all calls before it are known.
Positions are counted in ranges of the order, so a conversation of very many turns is
spread over tasks.

Messages have conv_id, turn, role and text. An assistant text that is a JSON object with
`tool_calls` (id, name, arguments, after) holds calls, and its `content`, if any, is a
message before them; a tool text with `tool_call_id` holds a result; all else is a plain
message.
"""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from claimwright.session import stage

# JSON kinds by the name Spark gives a variant's type.
KIND = """CASE WHEN {0} IS NULL THEN 'null' WHEN {0} = 'STRING' THEN 'string'
    WHEN {0} = 'BOOLEAN' THEN 'boolean' WHEN {0} IN ('TINYINT', 'SMALLINT', 'INT', 'BIGINT')
    THEN 'integer' WHEN {0} LIKE 'DECIMAL(%,0)' THEN 'integer'
    WHEN {0} LIKE 'DECIMAL%' OR {0} IN ('DOUBLE', 'FLOAT') THEN 'number'
    WHEN {0} LIKE 'ARRAY%' THEN 'array' WHEN {0} LIKE 'OBJECT%' THEN 'object' ELSE 'null' END"""


def canonical(json: str) -> Column:
    """Canonical JSON of a JSON text: sorted keys, no spaces; null if it is not valid."""
    return F.expr(f"to_json(try_parse_json({json}))")


def events(messages: DataFrame) -> DataFrame:
    """One row per plain message, call and result.

    `after` is the sorted list of ids a call names, null if it names none. `is_json`
    tells that the body of a message is JSON, the content of an assistant's object.
    """
    base = messages.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_conv"),
        F.coalesce("turn", F.lit(-1)).cast("bigint").alias("turn"), "role",
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("_v", F.expr(
        "CASE WHEN role IN ('assistant', 'tool') AND ltrim(text) LIKE '{%' THEN try_parse_json(text) END"))
    shown = base.selectExpr(
        "*",
        "CASE WHEN role = 'assistant' THEN try_variant_get(_v, '$.tool_calls', 'array<variant>') END AS _calls",
        "CASE WHEN role = 'tool' THEN try_variant_get(_v, '$.tool_call_id', 'string') END AS _answers",
    )
    calls = shown.filter("_calls IS NOT NULL").select(
        "conv_id", "_conv", "turn", "role", F.posexplode("_calls").alias("seq", "_c")
    ).selectExpr(
        "conv_id", "_conv", "turn", "seq", "'call' AS kind", "role",
        "try_variant_get(_c, '$.id', 'string') AS call_id",
        "try_variant_get(_c, '$.name', 'string') AS name",
        """CASE WHEN schema_of_variant(try_variant_get(_c, '$.after', 'variant')) LIKE 'ARRAY%'
           THEN nullif(array_sort(array_distinct(array_compact(
                transform(try_variant_get(_c, '$.after', 'array<variant>'),
                          a -> try_variant_get(a, '$', 'string'))))), array())
           ELSE nullif(array_compact(array(try_variant_get(_c, '$.after', 'string'))), array()) END AS after""",
        # Arguments may be an object or the text of one.
        """CASE WHEN schema_of_variant(try_variant_get(_c, '$.arguments', 'variant')) = 'STRING'
           THEN to_json(try_parse_json(try_variant_get(_c, '$.arguments', 'string')))
           ELSE to_json(try_variant_get(_c, '$.arguments', 'variant')) END AS body""",
        "false AS is_json")
    results = shown.filter("_answers IS NOT NULL").selectExpr(
        "conv_id", "_conv", "turn", "0 AS seq", "'result' AS kind", "role",
        "_answers AS call_id", "CAST(NULL AS STRING) AS name", "CAST(NULL AS ARRAY<STRING>) AS after",
        "to_json(try_variant_get(_v, '$.content', 'variant')) AS body", "false AS is_json")
    # Beside calls, or in place of them, stands the content; without any, an object that
    # holds no call is a message as it is.
    said = shown.filter("_answers IS NULL").withColumn("_said", F.expr(
        """CASE WHEN _calls IS NOT NULL
           THEN nullif(to_json(try_variant_get(_v, '$.content', 'variant')), 'null') END"""))
    plain = said.filter("_said IS NOT NULL OR _calls IS NULL OR size(_calls) = 0").selectExpr(
        "conv_id", "_conv", "turn", "CASE WHEN size(_calls) > 0 THEN -1 ELSE 0 END AS seq",
        "'message' AS kind", "role", "CAST(NULL AS STRING) AS call_id",
        "CAST(NULL AS STRING) AS name", "CAST(NULL AS ARRAY<STRING>) AS after",
        "coalesce(_said, text) AS body", "_said IS NOT NULL AS is_json")
    return calls.unionByName(results).unionByName(plain)


def chains(first: DataFrame) -> DataFrame:
    """(_conv, call_id, back, depth, loops) of calls that come after other calls.

    `first` has _conv, call_id, reach (the last turn of the call or its results) and
    after, a list. `back` is the greatest reach of all calls before, `depth` the length
    of the longest chain of them; a call that has a call before it whose chain never
    ends `loops`.
    """
    keys = ["_conv", "call_id"]
    before = first.select("_conv", F.col("call_id").alias("after"), F.col("reach").alias("back"))
    edges = stage(
        first.select(*keys, F.explode("after").alias("after")).join(before, ["_conv", "after"])
        .select(*keys, "after", "back"), "chat-edges")
    per_call = edges.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("after").alias("at"), F.min("back").alias("back"))
    # A single predecessor is followed until a call that has none, or several.
    now = stage(
        per_call.filter("_n = 1").select(
            *keys, "back", F.lit(1).cast("bigint").alias("depth"), "at", F.lit(True).alias("open")),
        "chat-chains")
    rounds = math.ceil(math.log2(now.count() + 1)) + 1
    for _ in range(rounds):
        if not now.filter("open").limit(1).count():
            break
        farther = now.select(
            "_conv", F.col("call_id").alias("at"), F.col("back").alias("_back"),
            F.col("depth").alias("_depth"), F.col("at").alias("_at"), F.col("open").alias("_open"))
        now = stage(
            now.join(farther, ["_conv", "at"], "left").select(
                *keys, F.greatest("back", "_back").alias("back"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                F.coalesce("_at", "at").alias("at"),
                F.coalesce("_open", F.lit(False)).alias("open")), "chat-chains")
    several = per_call.filter("_n > 1").select(*keys)
    if not several.limit(1).count():
        return now.select(*keys, "back", "depth", F.col("open").alias("loops"))
    several = stage(several, "chat-several")
    return joined_chains(now, edges, several)


def joined_chains(single: DataFrame, edges: DataFrame, several: DataFrame) -> DataFrame:
    """The chains of all calls, given those of `single` ones up to `at`, the next call that
    comes after none or several.

    Calls after several are known, level by level, once all they wait for are; those
    that never are, loop. The number of levels is that of such calls in one chain.
    """
    keys = ["_conv", "call_id"]
    steps = single.select(
        "_conv", F.col("call_id").alias("after"), F.col("back").alias("_back"),
        F.col("depth").alias("_depth"), "at", "open")
    waiting = stage(
        edges.join(several, keys).join(steps, ["_conv", "after"], "left")
        .select(*keys, F.coalesce("at", "after").alias("at"), F.greatest("back", "_back").alias("back"),
                (F.coalesce("_depth", F.lit(0)) + 1).alias("depth"),
                F.coalesce("open", F.lit(False)).alias("open"))
        .join(several.select("_conv", F.col("call_id").alias("at"), F.lit(True).alias("waits")),
              ["_conv", "at"], "left")
        .select(*keys, "at", "back", "depth",
                (F.col("open") | F.coalesce("waits", F.lit(False))).alias("waits")), "chat-waiting")
    known = None
    while True:
        ready = stage(
            waiting.groupBy(*keys).agg(
                F.max("back").alias("back"), F.max("depth").alias("depth"), F.max("waits").alias("waits"))
            .filter("NOT waits").select(*keys, "back", "depth", F.lit(False).alias("loops")), "chat-ready")
        if not ready.limit(1).count():
            break
        known = ready if known is None else stage(known.unionByName(ready), "chat-known")
        found = ready.select("_conv", F.col("call_id").alias("at"), F.col("back").alias("_back"),
                             F.col("depth").alias("_depth"))
        waiting = stage(
            waiting.join(ready.select(*keys), keys, "left_anti").join(found, ["_conv", "at"], "left")
            .select(*keys, "at", F.greatest("back", "_back").alias("back"),
                    (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                    (F.col("waits") & F.col("_depth").isNull()).alias("waits")), "chat-waiting")
    rest = waiting.groupBy(*keys).agg(F.max("back").alias("back"), F.max("depth").alias("depth")).withColumn(
        "loops", F.lit(True))
    joined = rest if known is None else known.unionByName(rest)
    ends = joined.select("_conv", F.col("call_id").alias("at"), F.col("back").alias("_back"),
                         F.col("depth").alias("_depth"), "loops")
    return single.join(ends, ["_conv", "at"], "left").select(
        *keys, F.greatest("back", "_back").alias("back"),
        (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
        (F.col("open") | F.coalesce("loops", F.lit(False))).alias("loops")).unionByName(joined)


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Calls with `errors`: what is missing, unknown or of a wrong type, in order.

    `schemas` has name, param, type and required. A tool without a schema is an error,
    and so are arguments that are no object.
    """
    tools = schemas.groupBy("name").agg(
        F.array_sort(F.collect_set(F.struct("param", "type", "required"))).alias("_params"))
    fields = F.expr("""transform(map_entries(from_json(body, 'map<string,variant>')),
        e -> named_struct('param', e.key, 'is', schema_of_variant(e.value)))""")
    kind = KIND.format("f.is")
    return (
        calls.join(tools, "name", "left").withColumn("_fields", fields).withColumn("errors", F.expr(f"""
        CASE WHEN _params IS NULL THEN array('no schema')
             WHEN _fields IS NULL OR NOT coalesce(body LIKE '{{%', false) THEN array('no object')
             ELSE array_sort(concat(
                transform(filter(_params, p -> p.required AND NOT exists(_fields, f -> f.param = p.param)),
                          p -> concat('missing ', p.param)),
                transform(filter(_fields, f -> NOT exists(_params, p -> p.param = f.param)),
                          f -> concat('unknown ', f.param)),
                transform(filter(_fields, f -> exists(_params, p -> p.param = f.param AND p.type <> {kind}
                              AND NOT (p.type = 'number' AND {kind} = 'integer'))),
                          f -> concat('wrong type ', f.param)))) END"""))
        .drop("_fields", "_params"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with `position`, 0, 1, ... in each conversation by `order`.

    The order is cut into ranges; a range counts its own rows of a conversation, and
    the counts of the ranges before are added.
    """
    keys = ["_conv", *order]
    ranged = stage(
        rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "chat-ranges")
    counts = ranged.groupBy("_conv", "_range").agg(F.count("*").alias("_n"))
    ahead = counts.select(
        "_conv", "_range",
        (F.sum("_n").over(Window.partitionBy("_conv").orderBy("_range")) - F.col("_n")).alias("_ahead"))
    inside = Window.partitionBy("_conv", "_range").orderBy(*order)
    return ranged.withColumn("_own", F.row_number().over(inside)).join(
        ahead, ["_conv", "_range"]).withColumn(
        "position", F.col("_ahead") + F.col("_own") - 1).drop("_range", "_own", "_ahead")


def link_tool_calls(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per message, call and result, in the order a model should read them.

    Columns: conv_id, position, kind, role, turn, call_id, status, errors, line. A row
    keeps its turn unless it must wait for what it depends on: a result for its call, a
    call for the results of the calls before it. status is `message`; for calls
    `linked`, `unanswered`, `duplicate` (an id used before; it links to nothing) or
    `loop` (a chain of `after` before it never ends; it keeps its turn); for results `linked`
    or `orphan`. line is canonical JSON. Null turns come first, null texts are empty,
    repeated rows stay and share their status, calls without id are unanswered.
    """
    rows = stage(events(messages), "chat-events")
    calls = rows.filter("kind = 'call'")
    answers = rows.filter("kind = 'result'").groupBy("_conv", "call_id").agg(
        F.max("turn").alias("_last"))
    key = F.struct("turn", "seq", "name", "body", "after")
    first = stage(
        calls.filter("call_id IS NOT NULL").groupBy("_conv", "call_id").agg(F.min(key).alias("_first"))
        .join(answers, ["_conv", "call_id"], "left")
        .select("_conv", "call_id", "_first", F.col("_first.turn").alias("_called"),
                F.col("_last").isNotNull().alias("_answered"),
                F.greatest("_first.turn", "_last").alias("reach"),
                F.col("_first.after").alias("after")), "chat-first")
    chain = chains(first.select("_conv", "call_id", "reach", "after"))
    known = first.select("_conv", "call_id", "_first", "_called", "_answered").join(
        chain, ["_conv", "call_id"], "left")
    linked = (
        argument_errors(calls, schemas).join(known, ["_conv", "call_id"], "left")
        .withColumn("_same", F.coalesce(key == F.col("_first"), F.lit(False)) | F.col("_first").isNull())
        .withColumn("status", F.expr("""CASE WHEN NOT _same THEN 'duplicate' WHEN loops THEN 'loop'
            WHEN _answered THEN 'linked' ELSE 'unanswered' END"""))
        .withColumn("_at", F.expr(
            "CASE WHEN _same AND NOT coalesce(loops, false) THEN greatest(turn, back) ELSE turn END"))
        .withColumn("_depth", F.expr(
            "CASE WHEN _same AND NOT coalesce(loops, false) THEN 2 * coalesce(depth, 0) ELSE 0 END")))
    answered = (
        rows.filter("kind = 'result'").withColumn("errors", F.expr("CAST(array() AS array<string>)"))
        .join(known, ["_conv", "call_id"], "left")
        .withColumn("status", F.expr("CASE WHEN _first IS NULL THEN 'orphan' ELSE 'linked' END"))
        .withColumn("_at", F.expr(
            "greatest(turn, _called, CASE WHEN NOT coalesce(loops, false) THEN back END)"))
        .withColumn("_depth", F.expr("""CASE WHEN _first IS NULL THEN 0
            ELSE 2 * CASE WHEN loops THEN 0 ELSE coalesce(depth, 0) END + 1 END""")))
    plain = rows.filter("kind = 'message'").withColumns({
        "errors": F.expr("CAST(array() AS array<string>)"), "status": F.lit("message"),
        "_at": F.col("turn"), "_depth": F.lit(0).cast("bigint")})
    columns = ["conv_id", "_conv", "_at", "_depth", "turn", "seq", "kind", "role", "call_id", "name",
               "body", "is_json", "status", "errors"]
    everything = linked.select(*columns).unionByName(answered.select(*columns)).unionByName(
        plain.select(*columns))
    # Spark leaves null fields out, so they are named as JSON text.
    text = "coalesce(to_json(to_variant_object(named_struct('x', {0}))), '{{\"x\":null}}')"
    value = "coalesce(substr({0}, 6, length({0}) - 6), 'null')"
    quoted = lambda c: value.format(text.format(c))
    line = F.expr(f"""to_json(try_parse_json(CASE kind
        WHEN 'call' THEN concat('{{"role":"assistant","id":', {quoted('call_id')},
             ',"name":', {quoted('name')}, ',"arguments":', coalesce(body, 'null'), '}}')
        WHEN 'result' THEN concat('{{"role":"tool","id":', {quoted('call_id')},
             ',"content":', coalesce(body, 'null'), '}}')
        ELSE concat('{{"role":', {quoted('role')}, ',"content":',
             CASE WHEN is_json THEN body ELSE {quoted('body')} END, '}}') END))""")
    order = ["_at", "_depth", "turn", "seq", "kind", "role", "call_id", "name", "body", "is_json"]
    return placed(everything, order).select(
        "conv_id", "position", "kind", "role", "turn", "call_id", "status",
        F.array_join("errors", "; ").alias("errors"), line.alias("line"))
