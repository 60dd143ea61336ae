"""Chat formatting with linked tool calls, with native expressions.

Messages are rows of (conversation, turn, role, text). The text of an assistant message may be JSON with `tool_calls`
(id, name, arguments, and `after`: ids of calls it needs), that of a tool message JSON with `tool_call_id` and
`content`; any other text is plain content. Calls and results are events of their own.

Results are hash-joined to calls by conversation and identifier; the first call with an identifier counts. Events
are ordered by turn, but each result behind its call and each call behind those it needs. Arguments are validated
against the schema of their tool. Each event is serialised as canonical JSON: sorted keys, no blanks. Conversations
are never gathered: positions come from counts carried over ranges, so one may hold any number of turns. Only the
links of a conversation that some joined rounds do not order (no texts, three numbers an end) are ordered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.operators.joins import join_unique
from millrace.operators.ranges import in_order, running_total_before
from millrace.session import materialize

# Rounds by joins; conversations in which events still move then are ordered each in a task, at any depth.
JOINED_ROUNDS = 8
_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|DECIMAL.*",
    "boolean": "BOOLEAN",
    "object": "OBJECT<.*",
    "array": "ARRAY<.*",
}
_CALLS = "array<struct<id:string,name:string,arguments:variant,after:array<string>>>"

Schema = Mapping[str, object]


def events_of(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per call, result and plain message: conv, turn, part, kind, role, call_id, name, arguments, after, content.

    JSON that is broken or has neither calls nor a call id is plain content. A null text has null content.
    """
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    looks = F.col("text").startswith("{") & F.col("role").isin("assistant", "tool")
    body = F.when(looks, F.try_parse_json("text"))
    rows = rows.withColumn("body", body)
    calls = F.when(
        (F.col("role") == "assistant") & F.schema_of_variant(F.expr("try_variant_get(body, '$.tool_calls', 'variant')")).startswith("ARRAY"),
        F.expr(f"try_variant_get(body, '$.tool_calls', '{_CALLS}')"),
    )
    answers = F.when(F.col("role") == "tool", F.expr("try_variant_get(body, '$.tool_call_id', 'string')"))
    rows = rows.withColumn("calls", calls).withColumn("answers", answers)
    nothing = "cast(null as string)"
    plain = F.when(F.col("calls").isNull() & F.col("answers").isNull(), F.expr(
        f"array(struct('message' as kind, {nothing} as call_id, {nothing} as name, cast(null as variant) as arguments, "
        "cast(null as array<string>) as after, text as content))"))  # fmt: skip
    result = F.when(F.col("answers").isNotNull(), F.expr(
        f"array(struct('result' as kind, answers as call_id, {nothing} as name, cast(null as variant) as arguments, "
        "cast(null as array<string>) as after, try_variant_get(body, '$.content', 'string') as content))"))  # fmt: skip
    made = F.expr(
        "concat(transform(calls, c -> struct('call' as kind, c.id as call_id, c.name as name, c.arguments as arguments, "
        f"c.after as after, {nothing} as content)), "
        "if(try_variant_get(body, '$.content', 'string') is null, "
        f"cast(array() as array<struct<kind:string,call_id:string,name:string,arguments:variant,after:array<string>,content:string>>), "
        f"array(struct('message' as kind, {nothing} as call_id, {nothing} as name, cast(null as variant) as arguments, "
        "cast(null as array<string>) as after, try_variant_get(body, '$.content', 'string') as content))))"
    )
    each = rows.select("conv", "turn", "role", F.posexplode(F.coalesce(plain, result, made)).alias("part", "event"))
    return each.select("conv", "turn", "part", "role", "event.*")


def _errors(schemas: Mapping[str, Schema]) -> Column:
    """What is wrong with the arguments of a call: sorted texts; empty if nothing."""
    cases = F.when(F.col("kind") != "call", F.array().cast("array<string>"))
    is_object = F.coalesce(F.schema_of_variant("arguments").startswith("OBJECT"), F.lit(False))
    for name, schema in sorted(schemas.items()):
        tests = []
        properties: Mapping = schema.get("properties", {})
        for field, kind in sorted(properties.items()):
            found = F.schema_of_variant(F.try_variant_get("arguments", f"$.{field}", "variant"))
            missing = F.lit(f"{field}: missing") if field in schema.get("required", ()) else F.lit(None).cast("string")
            wrong = F.when(~found.rlike(f"^({_TYPES[kind]})$"), F.lit(f"{field}: not of type {kind}"))
            tests.append(F.when(found.isNull() | (found == "VOID"), missing).otherwise(wrong))
        extra = F.array_except(F.json_object_keys(F.to_json("arguments")), F.array(*map(F.lit, sorted(properties))))
        all_tests = F.concat(F.filter(F.array(*tests), lambda t: t.isNotNull()) if tests else F.array().cast("array<string>"),
                             F.transform(extra, lambda k: F.concat(k, F.lit(": unknown"))))
        told = F.when(is_object, F.array_sort(all_tests)).otherwise(F.array(F.lit("arguments: not an object")))
        cases = cases.when(F.col("name") == name, told)
    return cases.otherwise(F.array(F.lit("unknown tool")))


def _settled(table: pa.Table) -> pa.Table:
    """(row, at, level, cyclic) for the ends of a conversation's links, as rounds without end would place them.

    An event ends at the latest turn that its needs reach. Only needs that end at the same turn can move it there;
    peeling along those gives the levels in one pass, and an event that it leaves over waits for itself or for a cycle.
    """
    ends = {c: table.column(c).to_numpy() for c in ("row", "at", "part", "needs", "first_at", "first_part")}
    ids, first = np.unique(np.concatenate((ends["row"], ends["needs"])), return_index=True)
    start, part = (np.concatenate((ends[a], ends[b]))[first] for a, b in (("at", "first_at"), ("part", "first_part")))
    # Events are numbered by turn, part and row, the order of events at the same place.
    order = np.lexsort((ids, part, start))
    number = np.empty(len(ids), np.int64)
    number[order] = np.arange(len(ids))
    own, need = (number[np.searchsorted(ids, ends[c])] for c in ("row", "needs"))
    ids, start = ids[order], start[order]

    waiting: list[list[int]] = [[] for _ in ids]
    for u, v in zip(own.tolist(), need.tolist(), strict=True):
        waiting[v].append(u)
    last = [-1] * len(ids)
    for top in range(len(ids) - 1, -1, -1):
        reach = [top] if last[top] < 0 else []
        while reach:
            v = reach.pop()
            if last[v] < 0:
                last[v] = top
                reach += [u for u in waiting[v] if last[u] < 0]
    end = start[np.array(last)]
    binds = end[own] == end[need]
    own, need = own[binds], need[binds]

    pending = np.bincount(own, minlength=len(ids)).tolist()
    level = [0] * len(ids)
    free = [v for v, n in enumerate(pending) if not n]
    while free:
        v = free.pop()
        for u in waiting[v]:
            if end[u] == end[v]:
                level[u] = max(level[u], level[v] + (u <= v))
                pending[u] -= 1
                if not pending[u]:
                    free.append(u)
    cyclic = np.array(pending) > 0
    level = np.where(cyclic, 0, level).astype(np.int32)
    return pa.table({"row": ids, "at": np.where(cyclic, start, end), "level": level, "cyclic": cyclic})


def _ordered(events: DataFrame, edges: DataFrame) -> DataFrame:
    """(row, at, level, cyclic): an event comes behind the events it needs, else at its turn.

    `edges`: (conv, row, needs), `conv` never null. An event stands at the turn and level of the last that it needs;
    one level behind it if turn, part and row alone would put it first. Events are moved there until none moves, which
    gives the same places in any order of moves. An event that would move for ever, as it waits for itself or for such
    an event, is cyclic: its order fails, and it keeps its turn.
    """
    start = F.coalesce("turn", F.lit(-1))
    places = events.select("row", start.alias("at"), F.lit(0).alias("level"), start.alias("turn"), "part")
    edges = materialize(edges, "needs")
    moved = None
    for _ in range(JOINED_ROUNDS):
        here = places if moved is None else (
            join_unique(places, moved, ["row"], "left")
            .select("row", F.coalesce("new_at", "at").alias("at"), F.coalesce("new_level", "level").alias("level"), "turn", "part")
        )
        key = here.select("row", F.struct("at", "level", "turn", "part", "row").alias("key"))
        met = join_unique(edges, key, ["row"], "inner").withColumnRenamed("key", "own")
        need = key.select(F.col("row").alias("needs"), F.col("key").alias("first"))
        met = join_unique(met, need, ["needs"], "inner").where(F.col("own") <= F.col("first"))
        tie = [F.struct(*[F.col(f"{side}.{c}") for c in ("turn", "part", "row")]) for side in ("own", "first")]
        level = F.col("first.level") + F.when(tie[0] <= tie[1], 1).otherwise(0)
        step = met.groupBy("row").agg(F.max(F.struct("first.at", level.alias("level"))).alias("behind"), F.first("conv").alias("conv"))
        step = step.select("row", F.col("behind.at").alias("new_at"), F.col("behind.level").alias("new_level"), "conv")
        step = materialize(step, "moved")
        if step.isEmpty():
            return here.select("row", "at", "level", F.lit(False).alias("cyclic"))
        late = step.select("conv").distinct()
        step = step.drop("conv")
        if moved is not None:
            step = materialize(step.union(moved.join(step, "row", "left_anti")), "moved")
        moved = step

    rest = join_unique(edges, materialize(late, "late"), ["conv"], "inner")
    rest = join_unique(rest, places.select("row", "at", "part"), ["row"], "inner")
    need = places.select(F.col("row").alias("needs"), F.col("at").alias("first_at"), F.col("part").alias("first_part"))
    rest = join_unique(rest, need, ["needs"], "inner").select("conv", "row", "at", "part", "needs", "first_at", "first_part")
    settled = rest.groupBy("conv").applyInArrow(_settled, "row long, at long, level int, cyclic boolean")
    settled = materialize(settled.withColumnsRenamed({"at": "end_at", "level": "end_level"}), "settled")
    final = join_unique(join_unique(places, moved, ["row"], "left"), settled, ["row"], "left")
    return final.select(
        "row",
        F.coalesce("end_at", "new_at", "at").alias("at"),
        F.coalesce("end_level", "new_level", "level").alias("level"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
    )


def format_chat(
    df: DataFrame,
    schemas: Mapping[str, Schema],
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv, turn, part, kind, call_id, linked, valid, errors, position (from 0) and json of every event.

    linked: a call has a result, a result has a call; null for plain messages. A call whose identifier an earlier
    call of the conversation has is not linked, nor are events without one. valid: linked and without errors (for a
    result: linked); null for plain messages. Events of equal place are ordered by part, then content. Conversations
    with a null id are one conversation, whose calls and results are linked like those of any other. Extra columns of `df` are not read; an empty table gives no rows.
    """
    events = events_of(df, conv, turn, role, text).withColumn("errors", _errors(schemas))
    shown = F.to_json(F.struct(
        "arguments", F.col("call_id").alias("call"), "content", F.col("conv").alias("conversation"), "kind", "name", "role", "turn"
    ))
    events = events.withColumn("json", shown).drop("arguments", "content", "name", "role")
    events = materialize(events.withColumn("row", F.monotonically_increasing_id()), "events")

    # A key that is never null, so that the events without a conversation meet as well.
    talk = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit(""))
    named = events.where(F.col("call_id").isNotNull()).withColumn("conv", talk)
    calls = named.where(F.col("kind") == "call")
    first = calls.groupBy("conv", "call_id").agg(F.min(F.struct("turn", "part", "row")).alias("first"))
    first = first.select("conv", "call_id", F.col("first.row").alias("needs"))
    results = named.where(F.col("kind") == "result").select("conv", "call_id", "row")
    links = materialize(join_unique(results, first, ["conv", "call_id"], "inner").select("conv", "row", "needs"), "links")
    after = calls.select("row", "conv", F.explode(F.array_distinct("after")).alias("call_id"))
    needed = join_unique(after, first, ["conv", "call_id"], "inner").select("conv", "row", "needs")
    places = _ordered(events, links.union(needed))

    linked = links.select("row").union(links.select(F.col("needs").alias("row"))).distinct().withColumn("met", F.lit(True))
    rows = join_unique(events, linked, ["row"], "left")
    rows = join_unique(rows, places, ["row"], "left")
    is_message = F.col("kind") == "message"
    met = F.coalesce("met", F.lit(False))
    errors = F.when(F.col("cyclic"), F.array_append("errors", F.lit("order: waits for itself"))).otherwise(F.col("errors"))
    rows = rows.withColumn("errors", errors).select(
        "conv", "turn", "part", "kind", "call_id",
        F.when(~is_message, met).alias("linked"),
        F.when(~is_message, met & (F.size("errors") == 0)).alias("valid"),
        "errors", "json", "at", "level", F.coalesce("turn", F.lit(-1)).alias("_turn"), F.xxhash64("json").alias("_content"), "row",
    )
    ordered = in_order(rows, ["conv"], ["at", "level", "_turn", "part", "_content", "row"])
    placed = running_total_before(ordered, ["conv"], F.lit(1), "position")
    return placed.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), "part", "kind", "call_id", "linked", "valid", "errors",
        F.col("position").cast("long").alias("position"), "json",
    )


# The tool of the registered query.
REPLY = {"reply": {"properties": {"prompt": "string", "turn": "integer"}, "required": ["prompt", "turn"]}}


# Faults of the registered query, by (31 * conv_id + turn) modulo 12 of a call; other remainders make sound calls.
NO_PROMPT, TEXT_TURN, EXTRA, OTHER_TOOL, TAKEN_ID, NEEDS_ITSELF, NEEDS_NEXT, SOUND, AFTER_NEXT, NEEDS_EACH_OTHER = range(10)


def as_tool_calls(conversations: DataFrame, faults: bool = False) -> DataFrame:
    """Turns as tool use: a user turn calls `reply` and needs the last user turn; the assistant's turn answers it.

    With `faults`, calls are spoilt by a rule on their key: arguments that are missing, of a wrong type or unknown, an
    unknown tool, the identifier of the call before, needs of itself, of a later call, and of a later call that needs
    this one.
    """
    key = "concat(conv_id, ':', turn{})"
    own, last, following = key.format(""), key.format(" - 2"), key.format(" + 2")
    kind = "pmod(31 * conv_id + turn, 12)" if faults else str(SOUND)
    arguments = (
        f"parse_json(case {kind} when {NO_PROMPT} then to_json(struct(turn as turn)) "
        f"when {TEXT_TURN} then to_json(struct(text as prompt, string(turn) as turn)) "
        f"when {EXTRA} then to_json(struct(1 as extra, text as prompt, turn as turn)) "
        "else to_json(struct(text as prompt, turn as turn)) end)"
    )
    needs = (
        f"case when {kind} = {NEEDS_ITSELF} then {own} when {kind} in ({NEEDS_NEXT}, {NEEDS_EACH_OTHER}) then {following} "
        f"when {kind} <> {AFTER_NEXT} or {kind} is null then {last} end"
    )
    call = (
        f"to_json(struct(array(struct(array({needs}) as after, {arguments} as arguments, "
        f"if({kind} = {TAKEN_ID}, {last}, {own}) as id, if({kind} = {OTHER_TOOL}, 'other', 'reply') as name)) as tool_calls))"
    )
    answer = f"to_json(struct(text as content, {key.format(' - 1')} as tool_call_id))"
    return conversations.selectExpr(
        "conv_id",
        "turn",
        "case role when 'user' then 'assistant' when 'assistant' then 'tool' else role end as role",
        f"case role when 'user' then {call} when 'assistant' then {answer} else text end as text",
    )


def op10_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    formatted = format_chat(as_tool_calls(table(spark, folder, "conversations"), faults=True), REPLY)
    return formatted.withColumn("errors", F.array_join("errors", ";"))


_SQL = """
with turns as (
  select conv_id, turn, role, text, case role when 'user' then 'call' when 'assistant' then 'result' else 'message' end as kind,
    case when role = 'user' then ((31 * conv_id + turn) % 12 + 12) % 12 end as fault
  from conversations),
events as (
  select *, case kind when 'call' then conv_id || ':' || (turn - if(fault = 4, 2, 0))
    when 'result' then conv_id || ':' || (turn - 1) end as call_id from turns),
calls as (
  select conv_id, call_id, min(turn) as turn, arg_min(fault, turn) as fault from events where kind = 'call' group by all),
answers as (select distinct conv_id, call_id from events where kind = 'result'),
linked as (
  select e.*,
    case kind when 'call' then e.turn = c.turn and a.call_id is not null when 'result' then c.call_id is not null end as met,
    case when kind = 'call' then e.fault = 5 or (e.fault = 4 and e.turn = c.turn) or (e.fault = 9 and n.call_id is not null)
        or (e.fault = 11 and coalesce(l.fault = 9, false))
      else coalesce(c.fault = 9 and n.call_id is not null, false) end as cyclic,
    -- A call that needs the next one, or the result of such a call, stands behind that.
    coalesce(if(kind = 'call', e.fault, c.fault) = 6 and n.call_id is not null, false) as moved,
    n.turn as next_turn
  from events e
    left join calls c on c.conv_id = e.conv_id and c.call_id = e.call_id
    left join answers a on a.conv_id = e.conv_id and a.call_id = e.call_id
    left join calls n on n.conv_id = e.conv_id and n.call_id = e.conv_id || ':' || (if(kind = 'call', e.turn, c.turn) + 2)
    left join calls l on l.conv_id = e.conv_id and l.call_id = e.conv_id || ':' || (e.turn - 2)),
judged as (
  select *, concat_ws(';',
    case when fault = 2 then 'extra: unknown' end,
    case when fault = 3 then 'unknown tool' when kind = 'call' and (fault = 0 or text is null) then 'prompt: missing' end,
    case when fault = 1 then 'turn: not of type integer' end,
    case when cyclic then 'order: waits for itself' end) as errors
  from linked)
select conv_id, turn, 0 as part, kind, call_id, case when kind <> 'message' then met end as linked,
  case when kind <> 'message' then met and errors = '' end as valid, errors,
  (row_number() over (partition by conv_id order by if(moved, next_turn, turn), moved, turn) - 1)::bigint as position,
  case
    when fault = 0 then to_json({'arguments': {'turn': turn}, 'call': call_id, 'conversation': conv_id, 'kind': kind,
      'name': 'reply', 'role': 'assistant', 'turn': turn})
    when fault = 1 then to_json({'arguments': {'prompt': text, 'turn': turn::varchar}, 'call': call_id, 'conversation': conv_id,
      'kind': kind, 'name': 'reply', 'role': 'assistant', 'turn': turn})
    when fault = 2 then to_json({'arguments': {'extra': 1, 'prompt': text, 'turn': turn}, 'call': call_id, 'conversation': conv_id,
      'kind': kind, 'name': 'reply', 'role': 'assistant', 'turn': turn})
    when kind = 'call' then to_json({'arguments': {'prompt': text, 'turn': turn}, 'call': call_id, 'conversation': conv_id, 'kind': kind,
      'name': if(fault = 3, 'other', 'reply'), 'role': 'assistant', 'turn': turn})
    when kind = 'result' then to_json({'call': call_id, 'content': text, 'conversation': conv_id, 'kind': kind, 'role': 'tool', 'turn': turn})
    else to_json({'content': text, 'conversation': conv_id, 'kind': kind, 'role': role, 'turn': turn}) end::varchar as json
from judged
"""

QUERIES = {"op10_tool_calls": op10_tool_calls}
CHECKS = {"op10_tool_calls": _SQL}
