"""Operator 8: linking of tool calls to their results.

Calls and results meet in a full outer hash join on the call's identifier.
Calls form a forest: a call may depend on the result of one other call.  Its
level in the topological order is found by pointer doubling (each round follows
the pointer and squares it), so a chain of n calls takes log2(n) rounds and a
call that never reaches a root stands on a cycle.  Arguments are parsed as
variants and validated against the tool's schema; a linked message is
serialised as canonical JSON (sorted keys, no white space).

Only DataFrame functions are used.  Every join key is an identifier; no
conversation is gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kairo.session import materialize, release

#: Schema types and the variant types that satisfy them.
TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "boolean": ["BOOLEAN"],
         "number": ["BIGINT", "DOUBLE", "DECIMAL"], "array": ["ARRAY"], "object": ["OBJECT"]}


def _problems(tools: dict[str, dict[str, dict]]) -> Column:
    """Array of what is wrong with ``args`` (a variant) of the tool ``name``."""
    checks = [F.when(F.col("args").isNull(), F.lit("arguments are not JSON"))
              .when(~F.schema_of_variant("args").startswith("OBJECT"),
                    F.lit("arguments are not an object")),
              F.when(~F.coalesce(F.col("name").isin(*tools), F.lit(False)), F.lit("unknown tool"))]
    for tool, fields in tools.items():
        for field, rule in fields.items():
            path = "$['" + field.replace("'", "\\'") + "']"
            value = F.try_variant_get("args", path, "variant")
            kind = F.regexp_extract(F.schema_of_variant(value), r"^[A-Z]+", 0)
            # a JSON null reads as the type VOID: present, but of no type
            wrong = F.when(value.isNull(), F.lit(f"{field}: missing") if rule.get("required")
                           else F.lit(None)) \
                     .when(~kind.isin(*TYPES[rule["type"]]), F.lit(f"{field}: not {rule['type']}"))
            if "minimum" in rule:
                number = F.try_variant_get("args", path, "double")
                wrong = wrong.when(number < rule["minimum"], F.lit(f"{field}: too small"))
            if "enum" in rule:
                text = F.try_variant_get("args", path, "string")
                wrong = wrong.when(~text.isin(*rule["enum"]), F.lit(f"{field}: not allowed"))
            checks.append(F.when((F.col("name") == tool) & F.col("args").isNotNull()
                                 & F.schema_of_variant("args").startswith("OBJECT"), wrong))
    return F.array_compact(F.array(*checks))


def call_levels(calls: DataFrame) -> DataFrame:
    """``(call_id, level)`` for calls ``(call_id, depends_on)`` with distinct
    ids: 0 for a call that depends on nothing or on an unknown call, else one
    more than the call it depends on; null on or behind a cycle."""
    known = calls.select(F.col("call_id").alias("parent"))
    state, n = materialize(
        calls.join(known, calls.depends_on == known.parent, "left")
        .select("call_id", F.col("parent").alias("next"),
                F.col("parent").isNotNull().cast("long").alias("level")), "chat-levels")
    rounds = n.bit_length() + 1
    for _ in range(rounds):
        if state.filter("next IS NOT NULL").isEmpty():
            break
        up = state.select(F.col("call_id").alias("next"), F.col("next").alias("next2"),
                          F.col("level").alias("more"))
        after, _ = materialize(
            state.join(up, "next", "left")
            .select("call_id", F.col("next2").alias("next"),
                    (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "chat-levels",
            rows=n)
        release(state)
        state = after
    return state.select("call_id", F.when(F.col("next").isNull(), F.col("level")).alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, tools: dict[str, dict[str, dict]]
                    ) -> DataFrame:
    """``(call_id, conv_id, level, status, valid, problems, message)``.

    ``calls`` has ``call_id, conv_id, name, arguments, depends_on``; ``results``
    has ``call_id, content``; ``tools`` maps a tool to its fields' rules
    (``type``, ``required``, ``minimum``, ``enum``).  ``status`` is ``linked``,
    ``unanswered`` (no result) or ``orphan`` (a result without call: name,
    arguments and level are null and it is not valid).  Of calls with one
    identifier the smallest (by conversation, name, arguments, dependency)
    counts, and of results the smallest content.  Calls and results without an
    identifier are left out, since they cannot be linked.  A level is null on
    or behind a cycle, and such a call is not valid.  Repeated JSON keys make
    arguments unreadable.  Other columns are ignored.
    """
    one = calls.filter("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min(F.struct("conv_id", "name", "arguments", "depends_on")).alias("c")) \
        .select("call_id", "c.*")
    one, _ = materialize(one, "chat-calls")
    answers = results.filter("call_id IS NOT NULL").groupBy("call_id").agg(
        F.min("content").alias("content"), F.lit(True).alias("answered"))
    both = (one.withColumn("called", F.lit(True)).join(answers, "call_id", "full_outer")
            .join(call_levels(one.select("call_id", "depends_on")), "call_id", "left")
            .withColumn("args", F.try_parse_json("arguments")))
    status = F.when(F.col("called").isNull(), "orphan") \
              .when(F.col("answered").isNull(), "unanswered").otherwise("linked")
    problems = F.when(F.col("called").isNotNull(), F.concat(
        _problems(tools),
        F.array_compact(F.array(F.when(F.col("level").isNull(), F.lit("depends on itself")))))) \
        .otherwise(F.array(F.lit("result without call")))
    # keys stand in sorted order; the variant's own keys are sorted already
    message = F.concat(
        F.lit('{"arguments":'), F.coalesce(F.to_json("args"), F.lit("null")),
        F.lit(',"id":'), _quoted("call_id"), F.lit(',"level":'),
        F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"name":'), _quoted("name"), F.lit(',"result":'), _quoted("content"), F.lit("}"))
    return both.withColumn("problems", problems).select(
        "call_id", "conv_id", "level", status.alias("status"),
        (F.size("problems") == 0).alias("valid"), "problems", message.alias("message"))


def _quoted(column: str) -> Column:
    """A JSON string, or null."""
    as_json = F.to_json(F.struct(F.col(column).alias("v")))        # {"v":"..."}
    return F.when(F.col(column).isNull(), F.lit("null")) \
            .otherwise(as_json.substr(F.lit(6), F.length(as_json) - 6))


# --- calls that conversations give

TOOLS = {
    "search": {"query": {"type": "string", "required": True},
               "limit": {"type": "integer", "required": True, "minimum": 1}},
    "translate": {"query": {"type": "string", "required": True},
                  "strict": {"type": "boolean", "required": False}},
}


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every user turn as a call and every assistant turn as the result of the
    turn before it; a call depends on the call two turns earlier.  Some calls
    break their schema: the limit is a string, zero or missing, by length.  A
    turn without conversation or number has no identifier (null): it links with
    nothing, and ``link_tool_calls`` leaves it out."""
    c = conversations.select("conv_id", "turn", "role", "text")
    call_id = lambda turn: F.concat(F.col("conv_id"), F.lit("-"), turn)
    n = F.char_length(F.coalesce("text", F.lit("")))
    limit = F.when(n % 5 == 0, F.lit('"limit":"3",')).when(n % 5 == 1, F.lit("")) \
             .otherwise(F.concat(F.lit('"limit":'), (n % 7).cast("string"), F.lit(",")))
    search = F.concat(F.lit("{"), limit, F.lit('"query":'), _quoted("text"), F.lit("}"))
    strict = F.when(n % 2 == 0, F.lit("true")).otherwise(F.lit('"yes"'))
    translate = F.concat(F.lit('{"strict":'), strict, F.lit(', "query":'), _quoted("text"), F.lit("}"))
    users = c.filter("role = 'user'")
    calls = users.select(
        call_id(F.col("turn")).alias("call_id"), "conv_id",
        F.when(n % 3 == 0, "translate").otherwise("search").alias("name"),
        F.when(n % 3 == 0, translate).otherwise(search).alias("arguments"),
        call_id(F.col("turn") - 2).alias("depends_on"))
    results = c.filter("role = 'assistant'").select(
        call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH u AS (SELECT conv_id, turn, text, length(coalesce(text, '')) AS n FROM conversations
           WHERE role = 'user'),
k AS (SELECT conv_id || '-' || turn AS call_id, conv_id, turn, text, n,
             CASE WHEN n % 3 = 0 THEN 'translate' ELSE 'search' END AS name FROM u),
i AS (SELECT *, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
      FROM k),
l AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS level
      FROM i),
r AS (SELECT conv_id || '-' || (turn - 1) AS call_id, min(text) AS content FROM conversations
      WHERE role = 'assistant' GROUP BY 1),
b AS (SELECT coalesce(l.call_id, r.call_id) AS call_id, l.conv_id, l.level, l.name, l.text, l.n,
             r.content, l.call_id IS NULL AS orphan, r.call_id IS NULL AS unanswered
      FROM l FULL JOIN r ON l.call_id = r.call_id),
p AS (SELECT *, CASE WHEN orphan THEN ['result without call']
        ELSE list_filter([
          CASE WHEN text IS NULL THEN 'query: not string' END,
          CASE WHEN name = 'search' AND n % 5 = 0 THEN 'limit: not integer'
               WHEN name = 'search' AND n % 5 = 1 THEN 'limit: missing'
               WHEN name = 'search' AND n % 7 < 1 THEN 'limit: too small' END,
          CASE WHEN name = 'translate' AND n % 2 = 1 THEN 'strict: not boolean' END],
          lambda x: x IS NOT NULL) END AS problems,
        CASE WHEN orphan THEN 'null'
             WHEN name = 'translate' THEN '{"query":' || coalesce(to_json(text), 'null') || ',"strict":'
               || CASE WHEN n % 2 = 0 THEN 'true' ELSE '"yes"' END || '}'
             ELSE '{' || CASE WHEN n % 5 = 0 THEN '"limit":"3",' WHEN n % 5 = 1 THEN ''
                              ELSE '"limit":' || (n % 7) || ',' END
               || '"query":' || coalesce(to_json(text), 'null') || '}' END AS args FROM b)
SELECT call_id, conv_id, CAST(level AS BIGINT) AS level,
       CASE WHEN orphan THEN 'orphan' WHEN unanswered THEN 'unanswered' ELSE 'linked' END AS status,
       len(problems) = 0 AS valid, array_to_string(problems, '; ') AS problems,
       '{"arguments":' || args || ',"id":' || to_json(call_id) || ',"level":'
         || coalesce(CAST(level AS VARCHAR), 'null') || ',"name":' || coalesce(to_json(name), 'null')
         || ',"result":' || coalesce(to_json(content), 'null') || '}' AS message
FROM p
"""
