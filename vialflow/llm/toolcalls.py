"""Tool calls linked to their results, ordered, checked and serialised.

Inputs are three tables:

* calls ``conv_id, call_id, seq, name, arguments`` (JSON text) ``, after``
  (ids of calls of the same conversation whose results the call uses);
* results ``conv_id, call_id, seq, content``;
* schemas ``name, parameter, type, required``: a row per parameter of a tool;
  types are string, integer, number, boolean, array, object.

Calls and results are joined by (conversation, call id). Calls are ordered
topologically by their dependencies: a call's level is one more than the
highest of the calls it waits for; chains are halved by pointer jumping, so
rounds follow the logarithm of the longest chain. Positions within a conversation
follow (level, seq, call id) and come from one range-partitioned running
count, so a conversation with a third of all calls is no single task's work.
Arguments are parsed once to VARIANT, whose text form has sorted keys and no
spaces; each field is checked against its schema row by a join.

Everything is DataFrame operations; nothing is collected but row counts.

Defined cases, as ``status`` of a call: ``no_id`` (NULL conversation or call
id), ``repeated_id`` (a call with the same id and a smaller (seq, name,
arguments) exists; rows equal in all columns count once), ``cycle`` (it waits
for itself, directly or not; no position), ``unknown_tool``,
``bad_arguments`` (NULL, no JSON object, a missing or unknown parameter, a
wrong type), ``missing_dependency`` (waits for an id that is no call),
``missing_result``, else ``ok``; the first that applies. A result without a
call, NULL ids included, has status ``orphan_result`` and no position; of several
results to an id the smallest (seq, content) counts, and of those with a NULL
id each distinct one. Empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vialflow.llm.common import materialise, prepare, read, register, scratch, tasks_for
from vialflow.llm.packing import running_start

KEY = ["conv_id", "call_id"]

#: The tools that the registered query knows: name, parameter, type, required.
SCHEMAS = (
    ("search", "query", "string", True), ("search", "limit", "integer", True), ("search", "turn", "integer", False),
    ("lookup", "query", "string", True), ("lookup", "limit", "integer", False), ("lookup", "turn", "integer", False),
    ("calculate", "query", "string", True), ("calculate", "limit", "number", True),
    ("calculate", "turn", "integer", True), ("calculate", "precise", "boolean", True),
)


def _kind(value: Column) -> Column:
    """JSON type of a VARIANT; whole numbers are integers."""
    s = F.schema_of_variant(value)
    whole = s.startswith("BIGINT") | (s.startswith("DECIMAL") & s.endswith(",0)"))
    return (F.when(whole, "integer").when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), "number")
            .when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when(s.startswith("ARRAY"), "array")
            .when(s.startswith("OBJECT"), "object").otherwise("null"))


def _jump(links: DataFrame, rounds: int) -> DataFrame:
    """Follows ``links`` (``conv_id, call_id, before, floor, far``: a call that
    waits for one other, its level is max(floor, level of ``before`` + far)) to
    the first call that is no link itself. Each round doubles the way covered, so
    a chain takes as many rounds as the logarithm of its length; what is then
    still on the way goes round a circle and is left out."""
    far = materialise(links.withColumn("_moved", F.lit(True)), "calls-links")
    for _ in range(rounds):
        t = far.select("conv_id", F.col("call_id").alias("before"), F.col("before").alias("_b"), F.col("floor").alias("_f"),
                       F.col("far").alias("_d"))
        on = F.col("_b").isNotNull()
        far = materialise(far.join(t, ["conv_id", "before"], "left").select(
            *KEY, F.coalesce("_b", "before").alias("before"),
            F.when(on, F.greatest("floor", F.col("_f") + F.col("far"))).otherwise(F.col("floor")).alias("floor"),
            F.when(on, F.col("far") + F.col("_d")).otherwise(F.col("far")).alias("far"), on.alias("_moved")), "calls-links")
        if far.where("_moved").isEmpty():
            break
    return far.where("not _moved").drop("_moved")


def levels(calls: DataFrame, waits: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of the calls that can be ordered.

    ``waits``: ``conv_id, call_id, before``, pairs of existing calls. A round
    settles the calls that wait for nothing, shortens every chain of calls that
    wait for one other each to one step (``_jump``), and hands both on to the
    calls that wait for several: steps to the same call merge into the longest,
    steps to settled calls become a least level. Rounds grow with the longest
    run of calls that still wait for several, never with the length of chains.
    What a round settles is written to one folder, a subfolder per round.
    """
    spark = calls.sparkSession
    path, rounds, schema = scratch(spark, "calls-level"), 0, None
    edges = materialise(waits.distinct().withColumn("far", F.lit(1)), "calls-waits")
    nodes = calls.select(*KEY, F.lit(0).alias("floor"))
    left = []  # links whose end is not settled yet, by round

    def settle(rows: DataFrame, part: str) -> DataFrame:
        rows.select(*KEY, "level").write.parquet(f"{path}/{part}")
        return spark.read.schema(schema).parquet(f"{path}/{part}")
    schema = nodes.select(*KEY, F.col("floor").alias("level")).schema
    while True:
        degree = edges.groupBy(KEY).agg(F.count(F.lit(1)).alias("_n"), F.min("before").alias("before"), F.min("far").alias("far"))
        all_nodes = materialise(nodes.join(degree, KEY, "left"), "calls-nodes")
        free = settle(all_nodes.where("_n is null").withColumnRenamed("floor", "level"), f"{rounds}-free")
        several = all_nodes.where("_n > 1")
        ends = free.select("conv_id", F.col("call_id").alias("before"), F.col("level").alias("_level"))
        links = all_nodes.where("_n = 1").select(*KEY, "before", "floor", "far")
        links = materialise(_jump(links, 2 + links.count().bit_length()).join(ends, ["conv_id", "before"], "left"), "calls-ends")
        settle(links.where("_level is not null").withColumn("level", F.greatest("floor", F.col("_level") + F.col("far"))),
               f"{rounds}-links")
        left.append(links.where("_level is null"))
        if several.isEmpty() or free.isEmpty():
            break
        # steps of the calls that wait for several: past links, and settled ends turned into least levels
        via = links.select("conv_id", F.col("call_id").alias("before"), F.col("before").alias("_end"), F.col("floor").alias("_f"),
                           F.col("far").alias("_d"))
        steps = (edges.join(several.select(KEY), KEY, "left_semi").join(via, ["conv_id", "before"], "left")
                 .select(*KEY, F.coalesce("_end", "before").alias("before"), (F.col("far") + F.coalesce("_d", F.lit(0))).alias("far"),
                         (F.col("far") + F.col("_f")).alias("_least")).join(ends, ["conv_id", "before"], "left"))
        steps = materialise(steps, "calls-steps")
        least = steps.groupBy(KEY).agg(F.max(F.greatest(F.coalesce("_least", F.lit(0)), F.coalesce(
            F.col("_level") + F.col("far"), F.lit(0)))).alias("_least"))
        nodes = several.join(least, KEY).select(*KEY, F.greatest("floor", "_least").alias("floor"))
        edges = materialise(steps.where("_level is null").groupBy(*KEY, "before").agg(F.max("far").alias("far")), "calls-waits")
        rounds += 1
    settled = lambda: spark.read.schema(schema).parquet(f"{path}/*")
    for k in range(rounds - 1, -1, -1):  # links that ended at a call of a later round
        ends = settled().select("conv_id", F.col("call_id").alias("before"), F.col("level").alias("_end"))
        settle(left[k].join(ends, ["conv_id", "before"]).withColumn("level", F.greatest("floor", F.col("_end") + F.col("far"))),
               f"{k}-late")
    return settled()


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per orphan result: ``conv_id, call_id, seq,
    position, level, status, line`` (canonical JSON of the call and result)."""
    calls = calls.select("conv_id", "call_id", "seq", "name", "arguments",
                         F.array_sort(F.array_distinct(F.coalesce("after", F.array().cast("array<string>")))).alias("after"))
    calls = calls.distinct()
    schemas = schemas.select("name", "parameter", "type", "required")
    has_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    body = F.struct("seq", "name", "arguments", "after")
    known = calls.where(has_id)
    one = known.groupBy(KEY).agg(F.min(body).alias("_b")).select(*KEY, "_b.*")
    one = materialise(one.withColumn("args", F.try_parse_json("arguments")), "calls-one")
    again = (known.withColumn("_b", body).join(one.select(*KEY, body.alias("_first")), KEY)
             .where(F.col("_b") != F.col("_first")).select(*KEY, "seq", F.lit("repeated_id").alias("status")))
    nameless = calls.where(~has_id).select(*KEY, "seq", F.lit("no_id").alias("status"))

    answers = (results.where(has_id).groupBy(KEY).agg(F.min(F.struct("seq", "content")).alias("_r"))
               .select(*KEY, F.col("_r.seq").alias("result_seq"), F.col("_r.content").alias("result")))
    orphans = answers.join(one.select(KEY), KEY, "left_anti").select(*KEY, F.col("result_seq").alias("seq"))
    lost = results.where(~has_id).select(*KEY, "seq", "content").distinct().select(*KEY, "seq")  # no call can have their ids
    orphans = orphans.unionByName(lost).withColumn("status", F.lit("orphan_result"))

    asked = one.select(*KEY, F.explode("after").alias("before"))
    ids = one.select("conv_id", F.col("call_id").alias("before"))
    waits = asked.join(ids, ["conv_id", "before"], "left_semi")
    dangling = asked.join(ids, ["conv_id", "before"], "left_anti").select(KEY).distinct().withColumn("_dangling", F.lit(True))
    level = levels(one, waits)

    # arguments against schemas, one row per field
    tools = schemas.groupBy("name").agg(F.count(F.when(F.col("required"), 1)).alias("_required"))
    fields = one.where(F.schema_of_variant("args").startswith("OBJECT")).select(*KEY, "name", "args")
    fields = fields.lateralJoin(fields.sparkSession.tvf.variant_explode(F.col("args").outer())).select(
        *KEY, "name", F.col("key").alias("parameter"), _kind(F.col("value")).alias("kind"))
    fits = (F.col("kind") == F.col("type")) | ((F.col("kind") == "integer") & (F.col("type") == "number"))
    checked = (fields.join(schemas, ["name", "parameter"], "left").groupBy(KEY).agg(
        F.count(F.when(F.col("required") & fits, 1)).alias("_given"),
        F.count(F.when(F.col("type").isNull() & F.col("parameter").isNotNull(), 1)).alias("_unknown"),
        F.count(F.when(~fits, 1)).alias("_wrong")))

    d = (one.join(answers, KEY, "left").join(level, KEY, "left").join(dangling, KEY, "left")
         .join(tools, "name", "left").join(checked, KEY, "left"))
    good = (F.col("_given") == F.col("_required")) & (F.col("_unknown") == 0) & (F.col("_wrong") == 0)
    status = (F.when(F.col("level").isNull(), "cycle").when(F.col("_required").isNull(), "unknown_tool")
              .when(~F.coalesce(good, F.lit(False)), "bad_arguments").when(F.col("_dangling"), "missing_dependency")
              .when(F.col("result_seq").isNull(), "missing_result").otherwise("ok"))
    # keys in ascending order, as canonical JSON has them
    line = F.to_json(F.struct("after", F.col("args").alias("arguments"), F.col("call_id").alias("id"), "name", "result"),
                     {"ignoreNullFields": "false"})
    d = materialise(d.select(*KEY, "seq", "level", status.alias("status"), line.alias("line")), "calls-linked")
    order = ["conv_id", "level", "seq", "call_id"]
    placed = running_start(d.where("level is not null").select(*order, F.lit(1).cast("long").alias("_one")),
                           order, "_one", "_start", tasks_for(calls))
    base = placed.groupBy("conv_id").agg(F.min("_start").alias("_base"))
    placed = placed.join(base, "conv_id").select(*KEY, (F.col("_start") - F.col("_base")).alias("position"))
    rest = nameless.unionByName(again).unionByName(orphans)
    rest = rest.withColumns({"level": F.lit(None).cast("int"), "line": F.lit(None).cast("string")})
    return (d.join(placed, KEY, "left").select(*KEY, "seq", "position", "level", "status", "line")
            .unionByName(rest.withColumn("position", F.lit(None).cast("long"))))


def as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results with the conversations' own ids and texts: an
    assistant turn stands for a call that uses the call before it, a later
    user turn for the result of the turn before it."""
    c = conversations.select("conv_id", "turn", "role", "text")
    call_id = lambda back: F.format_string("call-%d", F.col("turn") - back)
    tool = F.element_at(F.array(*[F.lit(t) for t in ("search", "lookup", "calculate", "browse")]),
                        (F.pmod("turn", F.lit(4)) + 1).cast("int"))
    size = F.length("text")
    args = F.to_json(F.struct(
        "turn", F.when(F.pmod(size, F.lit(7)) == 0, F.to_json(F.array(size))).alias("note"),
        F.when(F.pmod(size, F.lit(3)) == 0, F.lit(True)).alias("precise"), F.col("text").alias("query"), size.alias("limit")))
    calls = c.where("role = 'assistant'").select(
        "conv_id", call_id(0).alias("call_id"), F.col("turn").alias("seq"), tool.alias("name"), args.alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(call_id(2))).alias("after"))
    results = c.where("role = 'user' and turn > 0").select(
        "conv_id", call_id(1).alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content"))
    return calls, results


def _sql() -> str:
    rows = ", ".join(f"('{n}', '{p}', '{t}', {str(r).lower()})" for n, p, t, r in SCHEMAS)
    return f"""
with recursive schemas(name, parameter, type, required) as (values {rows}),
calls as (
  select conv_id, 'call-' || turn as call_id, turn as seq, ['search', 'lookup', 'calculate', 'browse'][turn % 4 + 1] as name,
    length(text) as size, text, case when turn >= 2 then 'call-' || (turn - 2) end as before
  from conversations where role = 'assistant'),
results as (
  select conv_id, 'call-' || (turn - 1) as call_id, turn as seq, text as content
  from conversations where role = 'user' and turn > 0),
fields as (
  select conv_id, call_id, name, unnest([
    {{'p': 'turn', 't': 'integer', 'v': seq::varchar}}, {{'p': 'limit', 't': 'integer', 'v': size::varchar}},
    {{'p': 'query', 't': 'string', 'v': to_json(text)::varchar}},
    {{'p': 'precise', 't': case when size % 3 = 0 then 'boolean' end, 'v': 'true'}},
    {{'p': 'note', 't': case when size % 7 = 0 then 'string' end, 'v': to_json('[' || size || ']')::varchar}}]) as f from calls),
given as (select conv_id, call_id, name, f.p as parameter, f.t as kind, f.v as v from fields where f.t is not null),
checked as (
  select given.conv_id, given.call_id, '{{' || string_agg('"' || given.parameter || '":' || v, ',' order by given.parameter) || '}}' as args,
    count(*) filter (required and (kind = type or (kind = 'integer' and type = 'number'))) as ok,
    count(*) filter (type is null or not (kind = type or (kind = 'integer' and type = 'number'))) as wrong
  from given left join schemas on given.name = schemas.name and given.parameter = schemas.parameter group by 1, 2),
deep(conv_id, call_id, level) as (
  select conv_id, call_id, 0 from calls where before is null
    or not exists (from calls b where b.conv_id = calls.conv_id and b.call_id = calls.before)
  union all select calls.conv_id, calls.call_id, level + 1 from deep join calls
    on calls.conv_id = deep.conv_id and calls.before = deep.call_id),
linked as (
  select calls.conv_id, calls.call_id, calls.seq, level,
    case when not exists (from schemas s where s.name = calls.name) then 'unknown_tool'
      when wrong > 0 or ok <> (select count(*) from schemas s where s.name = calls.name and required) then 'bad_arguments'
      when before is not null and not exists (from calls b where b.conv_id = calls.conv_id and b.call_id = calls.before)
        then 'missing_dependency'
      when results.seq is null then 'missing_result' else 'ok' end as status,
    '{{"after":' || case when before is null then '[]' else '["' || before || '"]' end || ',"arguments":' || args || ',"id":"'
      || calls.call_id || '","name":"' || calls.name || '","result":' || coalesce(to_json(content)::varchar, 'null') || '}}' as line
  from calls join deep using (conv_id, call_id) join checked using (conv_id, call_id)
  left join results on calls.conv_id = results.conv_id and calls.call_id = results.call_id)
select conv_id, call_id, seq, row_number() over (partition by conv_id order by level, seq, call_id) - 1 as position,
  level::int as level, status, line from linked
union all
select conv_id, call_id, seq, null, null, 'orphan_result', null from results
where not exists (from calls c where c.conv_id = results.conv_id and c.call_id = results.call_id)
"""


@register("op6_link_tool_calls", _sql())
def op6_link_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of all conversations with results, order, verdict and JSON line."""
    prepare(spark)
    calls, results = as_calls(read(spark, sf_dir, "conversations"))
    schemas = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("name"), F.lit(p).alias("parameter"), F.lit(t).alias("type"), F.lit(r).alias("required"))
        for n, p, t, r in SCHEMAS])))
    return link(calls, results, schemas)
