"""Execution history queries on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from framefold.constants import STATE_NAMES
from framefold.operators import history as H
from framefold.plans import views as V
from framefold.plans.registry import query
from framefold.sources.executions import EVENT_ORDER, recover_order, scan_executions, scan_history

#: Event ids are spread over all executions, so an execution has a handful of events in such a segment.
SMALL_SEGMENT = 1000


def _history(spark, sf):
    return V.history(spark, sf)


def _parsed(spark, sf):
    """Raw event documents as flat events; a timeline reads them once."""
    return scan_history(V.raw_history(spark, sf))


def _ms(c: str, name: str | None = None):
    return F.unix_millis(c).alias(name or c)


_NAME = "CASE state_name " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_NAMES.items()) + (
    " ELSE state_name END"
)

_VISITS = f"""{V.SQL_HIST},
opened AS (
  SELECT *, CASE WHEN type IN ('TaskStateEntered', 'MapStateEntered') THEN name
                 WHEN type = 'WaitStateEntered' AND seconds <> 0 THEN 'WaitForJob' END AS state_name FROM hist),
visits AS (
  SELECT execution_arn, state_name, min(id) AS first_id, arg_min(ms, id) AS entered_ms,
         arg_min(type, id) AS opening, arg_min(v, id) AS v
  FROM opened WHERE state_name IS NOT NULL GROUP BY 1, 2)"""

_CURRENT = """cur AS (
  SELECT *, last_value(CASE WHEN type IN ('TaskStateEntered', 'MapStateEntered') THEN name
                            WHEN type = 'TaskStateExited' THEN '' END IGNORE NULLS)
            OVER (PARTITION BY execution_arn ORDER BY id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state_name FROM hist)"""

_UNNAMED = ", ".join(f"'{t}'" for t in H.UNNAMED)

_STEPS = f"""{_VISITS}, {_CURRENT},
ev AS (
  SELECT execution_arn, state_name, id, type, ms, resource, output, error, cause FROM cur
  WHERE type IN ({_UNNAMED}) AND state_name <> ''
  UNION ALL
  SELECT h.execution_arn, w.state_name, h.id, h.type, h.ms, NULL, h.output, NULL, NULL
  FROM hist h JOIN visits w ON w.execution_arn = h.execution_arn AND w.state_name = 'ProcessRekognitionJobs'
  WHERE h.type = 'MapStateSucceeded' AND h.id > w.first_id),
marks AS (
  SELECT execution_arn, state_name,
    min(id) FILTER (type IN ('LambdaFunctionSucceeded', 'MapStateSucceeded', 'TaskSucceeded',
                             'LambdaFunctionFailed', 'TaskFailed')) AS term_id,
    max(id) FILTER (type IN ('LambdaFunctionSucceeded', 'MapStateSucceeded')) AS done_id,
    max(id) FILTER (type IN ('LambdaFunctionSucceeded', 'MapStateSucceeded') AND output IS NOT NULL) AS out_id,
    min(id) FILTER (type IN ('LambdaFunctionStarted', 'TaskStarted')) AS start_id,
    min(id) FILTER (type = 'LambdaFunctionScheduled' AND contains(lower(resource), 'lambda')) AS lam_id
  FROM ev GROUP BY 1, 2),
res AS (
  SELECT e.execution_arn, e.state_name, arg_max(e.resource, e.id) AS resource
  FROM ev e JOIN marks m USING (execution_arn, state_name)
  WHERE e.type = 'TaskScheduled' AND e.resource <> '' AND (m.term_id IS NULL OR e.id < m.term_id)
    AND (m.lam_id IS NULL OR e.id < m.lam_id) GROUP BY 1, 2),
state_rows AS (
  SELECT w.execution_arn, w.state_name, w.first_id, w.entered_ms, w.opening, w.v,
    CASE WHEN m.done_id IS NOT NULL OR t.type = 'TaskSucceeded' THEN 'SUCCEEDED'
         WHEN t.id IS NULL THEN 'RUNNING' ELSE 'FAILED' END AS status,
    CASE WHEN m.term_id IS NULL OR m.start_id < m.term_id THEN s.ms END AS started_ms,
    coalesce(d.ms, t.ms) AS completed_ms,
    CASE WHEN m.term_id IS NULL OR m.lam_id < m.term_id THEN split_part(l.resource, ':', -1) END AS lambda_name,
    r.resource,
    coalesce(o.output, CASE WHEN t.type = 'TaskSucceeded' THEN t.output END) AS output,
    CASE WHEN t.type IN ('LambdaFunctionFailed', 'TaskFailed') THEN t.error END AS error,
    CASE WHEN t.type IN ('LambdaFunctionFailed', 'TaskFailed') THEN t.cause END AS cause
  FROM visits w LEFT JOIN marks m USING (execution_arn, state_name)
  LEFT JOIN ev t ON t.execution_arn = w.execution_arn AND t.state_name = w.state_name AND t.id = m.term_id
  LEFT JOIN ev d ON d.execution_arn = w.execution_arn AND d.state_name = w.state_name AND d.id = m.done_id
  LEFT JOIN ev o ON o.execution_arn = w.execution_arn AND o.state_name = w.state_name AND o.id = m.out_id
  LEFT JOIN ev s ON s.execution_arn = w.execution_arn AND s.state_name = w.state_name AND s.id = m.start_id
  LEFT JOIN ev l ON l.execution_arn = w.execution_arn AND l.state_name = w.state_name AND l.id = m.lam_id
  LEFT JOIN res r ON r.execution_arn = w.execution_arn AND r.state_name = w.state_name
  WHERE w.opening <> 'WaitStateEntered')"""

_ORDERS = """orders_in AS (
  SELECT execution_arn, state_name, first_id AS id FROM visits
  UNION ALL SELECT execution_arn, NULL, id FROM hist
  WHERE type IN ('ExecutionStarted', 'ExecutionSucceeded', 'ExecutionFailed')),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY execution_arn ORDER BY id) - 1 AS step_order FROM orders_in)"""

_WAITS = """spans AS (
  SELECT execution_arn, 'WaitForJob' AS state_name, min(id) FILTER (seconds <> 0) AS first_id,
         arg_min(ms, id) FILTER (seconds <> 0) AS entered_ms,
         arg_min(seconds, id) FILTER (seconds <> 0) AS seconds,
         max(id) FILTER (type = 'WaitStateExited') AS exit_id,
         arg_max(ms, id) FILTER (type = 'WaitStateExited') AS exit_ms
  FROM hist WHERE type IN ('WaitStateEntered', 'WaitStateExited') GROUP BY 1),
waits AS (
  SELECT execution_arn, state_name, first_id, entered_ms, seconds,
         CASE WHEN exit_id > first_id THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status,
         CASE WHEN exit_id > first_id THEN exit_ms END AS completed_ms
  FROM spans WHERE first_id IS NOT NULL)"""


@query(
    "scan_history",
    f"""WITH {V.SQL_HIST} SELECT execution_arn, id, type, ms,
          CASE WHEN type IN ('TaskStateEntered', 'TaskStateExited', 'MapStateEntered') THEN name END AS name,
          CAST(seconds AS DOUBLE) AS seconds, resource, error, cause, coalesce(idx, 0) AS idx FROM hist""",
)
def _(spark, sf):
    return scan_history(V.raw_history(spark, sf)).select(
        "execution_arn", "id", "type", _ms("ts", "ms"), "name", "seconds", "resource", "error", "cause",
        F.col("index").alias("idx"),
    )


_RANK = "CASE type " + " ".join(f"WHEN '{t}' THEN {n}" for n, types in enumerate(EVENT_ORDER) for t in types) + (
    f" ELSE {len(EVENT_ORDER) // 2} END"
)


@query(
    "recover_order",
    f"""WITH {V.SQL_HIST} SELECT execution_arn, type, ms, CASE WHEN CAST(execution_arn AS BIGINT) % 3 = 0
          THEN row_number() OVER (PARTITION BY execution_arn ORDER BY ms, {_RANK}, type) ELSE id END AS id FROM hist""",
)
def _(spark, sf):
    """Every third execution lost the ids of some events; its events are numbered anew."""
    lost = (F.col("execution_arn").cast("bigint") % 3 == 0) & (F.col("id") % 2 == 0)
    events = _history(spark, sf).withColumn("id", F.when(~lost, F.col("id")))
    return recover_order(events).select("execution_arn", "type", _ms("ts", "ms"), "id")


@query("first_visit", f"WITH {_VISITS} SELECT execution_arn, state_name, first_id, entered_ms, opening FROM visits")
def _(spark, sf):
    return H.first_visit(_history(spark, sf)).select(
        "execution_arn", "state_name", F.col("id").alias("first_id"), _ms("ts", "entered_ms"),
        F.col("type").alias("opening"),
    )


@query(
    "attribute_events",
    f"""WITH {V.SQL_HIST}, {_CURRENT} SELECT execution_arn, id, type, nullif(state_name, '') AS state_name FROM cur""",
)
def _(spark, sf):
    return H.attribute_events(_history(spark, sf)).select("execution_arn", "id", "type", "state_name")


@query(
    "attribute_events_segmented",
    f"""WITH {V.SQL_HIST}, {_CURRENT} SELECT execution_arn, id, type, nullif(state_name, '') AS state_name FROM cur""",
)
def _(spark, sf):
    """The same with segments of a few events, so that most states are carried over."""
    events = H.attribute_events(_history(spark, sf), SMALL_SEGMENT)
    return events.select("execution_arn", "id", "type", "state_name")


_ALL_STEPS = f"""WITH {_STEPS}, {_ORDERS}, {_WAITS}
        SELECT execution_arn, state_name, {_NAME} AS step, status, entered_ms, started_ms, completed_ms, lambda_name,
               resource, output, error, cause, step_order,
               CASE WHEN lambda_name IS NOT NULL THEN 'Lambda: ' || lambda_name
                    WHEN resource IS NOT NULL THEN 'Resource: ' || resource
                    WHEN opening = 'MapStateEntered' THEN 'Map State: Processing ' || (v % 2 + 1) || ' job(s)'
                    ELSE 'State: ' || state_name END AS details
        FROM state_rows JOIN numbered USING (execution_arn, state_name)
        UNION ALL
        SELECT execution_arn, state_name, 'Wait 30s', status, entered_ms, NULL, completed_ms, NULL, NULL, NULL, NULL,
               NULL, step_order, 'Waiting 30 seconds'
        FROM waits JOIN numbered USING (execution_arn, state_name)
        UNION ALL
        SELECT execution_arn, NULL, CASE type WHEN 'ExecutionStarted' THEN 'Execution Started' ELSE 'Execution Failed' END,
               CASE type WHEN 'ExecutionStarted' THEN 'SUCCEEDED' ELSE 'FAILED' END, ms, NULL, NULL, NULL, NULL, NULL,
               error, cause, CASE type WHEN 'ExecutionStarted' THEN 0 ELSE 9999 END, NULL
        FROM hist WHERE type IN ('ExecutionStarted', 'ExecutionFailed')"""


def _step_rows(rows):
    return rows.select(
        "execution_arn", "state_name", "step", "status", _ms("entered_at", "entered_ms"),
        _ms("started_at", "started_ms"), _ms("completed_at", "completed_ms"),
        F.col("lambda").alias("lambda_name"), "resource", "output", "error", "cause",
        F.col("order").cast("bigint").alias("step_order"), "details",
    )


@query("steps", _ALL_STEPS)
def _(spark, sf):
    return _step_rows(H.steps(_parsed(spark, sf)))


@query("steps_segmented", _ALL_STEPS)
def _(spark, sf):
    """The same from segments of a few events, whose summaries are combined."""
    return _step_rows(H.steps(_parsed(spark, sf), segment_size=SMALL_SEGMENT))


@query(
    "step_duration",
    f"""WITH {_STEPS} SELECT execution_arn, state_name,
          coalesce(completed_ms - entered_ms, completed_ms - started_ms) / 1000.0::DOUBLE AS duration FROM state_rows""",
)
def _(spark, sf):
    rows = H.steps(_parsed(spark, sf)).where("state_name is not null and step not like 'Wait%'")
    return rows.select("execution_arn", "state_name", "duration")


@query(
    "order_steps",
    f"""WITH {_VISITS}, {_ORDERS} SELECT execution_arn, state_name, step_order FROM numbered WHERE state_name IS NOT NULL""",
)
def _(spark, sf):
    return H.step_orders(_history(spark, sf)).select(
        "execution_arn", "state_name", F.col("order").cast("bigint").alias("step_order")
    )


@query(
    "terminal_rows",
    f"""WITH {V.SQL_HIST} SELECT execution_arn, id AS first_id,
          CASE type WHEN 'ExecutionStarted' THEN 'Execution Started' ELSE 'Execution Failed' END AS step,
          CASE type WHEN 'ExecutionStarted' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
          ms AS entered_ms, error, cause
        FROM hist WHERE type IN ('ExecutionStarted', 'ExecutionFailed')""",
)
def _(spark, sf):
    return H.terminal_rows(_history(spark, sf)).select(
        "execution_arn", "first_id", "step", "status", _ms("entered_at", "entered_ms"), "error", "cause"
    )


@query(
    "wait_spans",
    f"""WITH {V.SQL_HIST}, {_WAITS} SELECT execution_arn, state_name, status, first_id, entered_ms, completed_ms,
          CAST(seconds AS DOUBLE) AS seconds FROM waits""",
)
def _(spark, sf):
    return H.wait_spans(_history(spark, sf)).select(
        "execution_arn", "state_name", "status", "first_id", _ms("entered_at", "entered_ms"),
        _ms("completed_at", "completed_ms"), "seconds",
    )


_PAIRS = f"""{_VISITS},
its AS (
  SELECT h.* FROM hist h JOIN visits w ON w.execution_arn = h.execution_arn AND w.state_name = 'ProcessRekognitionJobs'
  WHERE h.type LIKE 'MapIteration%' AND h.id > w.first_id),
firsts AS (SELECT execution_arn, idx, min(id) AS id FROM its WHERE type = 'MapIterationStarted' GROUP BY 1, 2),
ends AS (
  SELECT f.execution_arn, f.idx, f.id, arg_max(i.type, i.id) AS type, arg_max(i.ms, i.id) AS ms,
         arg_max(i.error, i.id) FILTER (i.type = 'MapIterationFailed') AS error,
         arg_max(i.cause, i.id) FILTER (i.type = 'MapIterationFailed') AS cause
  FROM firsts f JOIN its i ON i.execution_arn = f.execution_arn AND i.idx = f.idx AND i.id > f.id
  WHERE i.type <> 'MapIterationStarted' GROUP BY 1, 2, 3),
pairs AS (
  SELECT s.execution_arn, s.idx, s.id, s.ms AS started_ms,
         CASE e.type WHEN 'MapIterationSucceeded' THEN 'SUCCEEDED' WHEN 'MapIterationFailed' THEN 'FAILED'
                     ELSE 'RUNNING' END AS status,
         e.ms AS completed_ms, e.error, e.cause
  FROM its s LEFT JOIN ends e ON e.execution_arn = s.execution_arn AND e.idx = s.idx AND e.id = s.id
  WHERE s.type = 'MapIterationStarted')"""


@query("pair_iterations", f"WITH {_PAIRS} SELECT * FROM pairs")
def _(spark, sf):
    return H.pair_iterations(_history(spark, sf)).select(
        "execution_arn", F.col("index").alias("idx"), "id", _ms("started_at", "started_ms"), "status",
        _ms("completed_at", "completed_ms"), "error", "cause",
    )


@query(
    "iteration_progress",
    f"""WITH {_PAIRS} SELECT execution_arn, count(*) FILTER (status = 'SUCCEEDED') AS succeeded, count(*) AS total
        FROM pairs GROUP BY 1""",
)
def _(spark, sf):
    return H.iteration_progress(H.pair_iterations(_history(spark, sf)))


@query(
    "fanout",
    f"""WITH {V.SQL_HIST} SELECT execution_arn, id, 'entered' AS phase, v % 2 + 1 AS jobs FROM hist
        WHERE type = 'MapStateEntered'
        UNION ALL SELECT execution_arn, id, 'completed', (v % 2) * 2 FROM hist WHERE type = 'MapStateSucceeded'""",
)
def _(spark, sf):
    return H.fanout(_history(spark, sf))


@query(
    "name_states",
    f"WITH {_VISITS} SELECT execution_arn, state_name, {_NAME} AS step FROM visits",
)
def _(spark, sf):
    return H.name_states(H.first_visit(_history(spark, sf)).select("execution_arn", "state_name"))


@query(
    "enrich_steps",
    """SELECT 'arn:states:execution:media:' || o_orderkey AS execution_arn, state_name,
         CASE WHEN o_custkey % 2 = 0 THEN 'own'
              WHEN state_name = 'FinalizeResults'
                THEN '{"processed_count":' || CASE WHEN o_orderstatus = 'O' THEN o_custkey % 5 ELSE 0 END || ',"results":[]}'
              WHEN state_name = 'IndexVideo' THEN '{"indexed_count":0}'
              WHEN state_name = 'IngestVideo' THEN '{"ingested_count":'
                || CASE WHEN o_orderstatus = 'O' THEN o_custkey % 7 ELSE 0 END
                || ',"source_counts":{},"metadata_by_source":{},"metadata":['
                || CASE WHEN o_orderstatus = 'O' THEN '{"id":' || o_orderkey || '}' ELSE '' END || ']}' END AS output
       FROM orders, (VALUES ('IngestVideo'), ('FinalizeResults'), ('IndexVideo'), ('CheckJobStatus')) AS t(state_name)""",
)
def _(spark, sf):
    """Four steps per order's execution, half of them without an output of their own."""
    states = F.array(*map(F.lit, ["IngestVideo", "FinalizeResults", "IndexVideo", "CheckJobStatus"]))
    steps = V.table(spark, sf, "orders").select(
        F.concat(F.lit("arn:states:execution:media:"), F.col("o_orderkey").cast("string")).alias(
            "execution_arn"
        ),
        F.when(F.col("o_custkey") % 2 == 0, "own").alias("output"),
        F.explode(states).alias("state_name"),
    )
    return H.enrich_steps(steps, scan_executions(V.executions(spark, sf))).select(
        "execution_arn", "state_name", "output"
    )
