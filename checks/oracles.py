"""Plain SQL statements of what the queries must return."""

from __future__ import annotations

# ---- events -------------------------------------------------------------------------------

_LABELS = "['click', 'error', 'purchase', 'signup', 'view']"

_LOG = f"""
r AS (SELECT CAST(range AS BIGINT) AS r FROM range(1, 7)),
b AS (
  SELECT e.event_id AS id, e.user_id, e.event_type AS expected, r.r,
    CASE WHEN e.event_id % 3 = 0 THEN 'hard' ELSE 'easy' END AS difficulty,
    list_position({_LABELS}, e.event_type) - 1 AS ci,
    e.event_id % (CASE WHEN r.r % 2 = 0 THEN 1000 ELSE 400 END) AS m
  FROM events e CROSS JOIN r),
lab AS (
  SELECT *, {_LABELS}[CAST((CASE WHEN (id * 11 + r) % (4 + r) = 0 THEN (ci + 1) % 5 ELSE ci END)
    + 1 AS INT)] AS lab FROM b),
log AS (
  SELECT concat('v', r) AS run, concat('u', user_id, '-v', r) AS user_run, user_id, r, id,
    expected, difficulty,
    CASE m WHEN 0 THEN 'not json' WHEN 1 THEN concat('{{"category": "', lab, '_x"}}')
      WHEN 2 THEN '{{"category": 5}}' WHEN 3 THEN concat('["', lab, '"]') WHEN 4 THEN ''
      WHEN 5 THEN concat('{{"label": "', lab, '"}}')
      WHEN 6 THEN concat('{{"a": {{"b": 1}}, "category": "', lab, '"}} tail') WHEN 7 THEN 'null'
      ELSE CASE WHEN id % 5 = 0 THEN concat('Sure: {{"category": "', lab, '"}} ok')
        ELSE concat('{{"category": "', lab, '"}}') END END AS raw_output,
    (CASE WHEN r = 6 THEN 2 ELSE 1 END) * (40 + id % 20 + 2 * r) AS prompt_tokens,
    5 + id % 4 AS completion_tokens, CAST(100 + id % 50 + r AS DOUBLE) AS latency_ms
  FROM lab)
"""


def _parsed(source: str, key: str, labels: str, name: str) -> str:
    """CTEs that parse ``raw_output``. JSON functions raise on bad text, hence the nesting."""
    return f"""
{name}_1 AS (
  SELECT *, regexp_extract(raw_output, '(\\{{.*?\\}})', 1, 's') AS block,
    CASE WHEN json_valid(raw_output) THEN
      CASE WHEN trim(raw_output) <> 'null' THEN raw_output END END AS whole
  FROM {source}),
{name}_2 AS (
  SELECT *, CASE WHEN whole IS NOT NULL THEN whole
    WHEN json_valid(block) THEN block END AS obj FROM {name}_1),
{name}_3 AS (
  SELECT *, CASE WHEN obj IS NOT NULL THEN
      CASE WHEN json_type(obj, '$.{key}') = 'VARCHAR' THEN json_extract_string(obj, '$.{key}') END
    END AS answer FROM {name}_2),
{name} AS (
  SELECT *, CASE WHEN list_contains({labels}, answer) THEN answer ELSE 'PARSE_FAILURE' END
    AS predicted FROM {name}_3)
"""


def _metrics(source: str, run: str, labels: str, slices: str) -> str:
    """CTEs ``cells``, ``grid``, ``prf`` and ``sm`` over parsed predictions."""
    return f"""
classes AS (SELECT unnest({labels}) AS label),
slices AS (SELECT unnest({slices}) AS slice),
runs AS (SELECT DISTINCT {run} AS run_id FROM {source}),
sliced AS (
  SELECT {run} AS run_id, 'overall' AS slice, expected, predicted FROM {source}
  UNION ALL
  SELECT {run}, difficulty, expected, predicted FROM {source}),
cells AS (
  SELECT run_id, slice, expected AS y_true, predicted AS y_pred, count(*) AS n
  FROM sliced GROUP BY ALL),
outcomes AS (SELECT label FROM classes UNION ALL SELECT 'PARSE_FAILURE'),
dense AS (
  SELECT g.run_id, g.slice, g.y_true, g.y_pred, CAST(coalesce(c.n, 0) AS BIGINT) AS n
  FROM (SELECT run_id, slice, t.label AS y_true, p.label AS y_pred
        FROM runs, slices, classes t, outcomes p) g
  LEFT JOIN cells c USING (run_id, slice, y_true, y_pred)),
counts AS (
  SELECT run_id, slice, label,
    CAST(coalesce(sum(n) FILTER (WHERE y_true = label AND y_pred = label), 0) AS BIGINT) AS tp,
    CAST(coalesce(sum(n) FILTER (WHERE y_pred = label), 0) AS BIGINT) AS predicted,
    CAST(coalesce(sum(n) FILTER (WHERE y_true = label), 0) AS BIGINT) AS support
  FROM dense, classes GROUP BY ALL),
pr AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0::DOUBLE END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall FROM counts),
prf AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
    ELSE 0.0::DOUBLE END AS f1 FROM pr),
macro AS (SELECT run_id, slice, list_sum(list(f1 ORDER BY label)) / count(*) AS macro_f1
  FROM prf GROUP BY ALL),
whole AS (
  SELECT run_id, slice, CAST(sum(n) AS BIGINT) AS support,
    CAST(coalesce(sum(n) FILTER (WHERE y_true = y_pred), 0) AS BIGINT) AS correct,
    CAST(coalesce(sum(n) FILTER (WHERE y_pred = 'PARSE_FAILURE'), 0) AS BIGINT) AS parse_failures,
    CAST(coalesce(sum(n) FILTER (WHERE y_pred <> 'PARSE_FAILURE' AND y_pred <> y_true), 0)
      AS BIGINT) AS wrong
  FROM dense GROUP BY ALL),
sm AS (
  SELECT run_id, slice, support, correct, parse_failures,
    CASE WHEN support > 0 THEN correct / support ELSE 0.0::DOUBLE END AS accuracy,
    macro_f1,
    CASE WHEN 2 * correct + 2 * wrong + parse_failures > 0
      THEN 2 * correct / (2 * correct + 2 * wrong + parse_failures) ELSE 0.0::DOUBLE END
      AS micro_f1,
    CASE WHEN support > 0 THEN parse_failures / support ELSE 0.0::DOUBLE END AS parse_failure_rate
  FROM whole JOIN macro USING (run_id, slice))
"""


_SLICES = "['overall', 'easy', 'hard']"
_PARSED = f"WITH {_LOG}, {_parsed('log', 'category', _LABELS, 'pred')}"
_BY_RUN = f"{_PARSED}, {_metrics('pred', 'run', _LABELS, _SLICES)}"
_BY_USER = f"{_PARSED}, {_metrics('pred', 'user_run', _LABELS, _SLICES)}"

_SLICE_COLUMNS = """run_id, slice, support, correct, parse_failures,
  round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, round(micro_f1, 6) AS micro_f1,
  round(parse_failure_rate, 6) AS parse_failure_rate"""

_SLICE_METRICS = f"{_BY_RUN} SELECT {_SLICE_COLUMNS} FROM sm"

_TOTALS = """
tot AS (
  SELECT run AS run_id, count(*) AS n_predictions, sum(latency_ms) AS latency_ms,
    CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
    CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens
  FROM log GROUP BY run)
"""


def _cost(price_in: str, price_out: str) -> str:
    return f"(prompt_tokens * {price_in}::DOUBLE + completion_tokens * {price_out}::DOUBLE) / 1e6"


def _scores(model: str) -> str:
    """CTE ``scores``: what the gate compares, per user run."""
    cost = (
        f"CASE WHEN {model} = 'model-b' THEN {_cost('0.2', '0.3')}"
        f" ELSE {_cost('0.59', '0.79')} END"
    )
    f1 = ", ".join(
        f"max(f1) FILTER (WHERE label = '{label}') AS f1_{label}"
        for label in ("click", "error", "purchase", "signup", "view")
    )
    return f"""
utot AS (
  SELECT user_run AS run_id, user_id, r, sum(latency_ms) AS latency,
    sum(prompt_tokens) AS prompt_tokens, sum(completion_tokens) AS completion_tokens
  FROM log GROUP BY ALL),
f1s AS (SELECT run_id, {f1} FROM prf WHERE slice = 'overall' GROUP BY run_id),
scores AS (
  SELECT run_id, user_id, r, concat('u', user_id) AS chain, {model} AS model, latency,
    {cost} AS cost, macro_f1, parse_failure_rate, f1s.* EXCLUDE (run_id)
  FROM utot JOIN sm USING (run_id) JOIN f1s USING (run_id) WHERE slice = 'overall')
"""


_DROPS = ", ".join(
    f"{{'d': b.f1_{label} - c.f1_{label}, 'label': '{label}'}}"
    for label in ("click", "error", "purchase", "signup", "view")
)

_PAIRED = f"""{_BY_USER}, {_scores("CASE WHEN r = 5 THEN 'model-b' ELSE 'model-a' END")},
pairs AS (
  SELECT run_id AS candidate, concat('u', user_id, '-v', r - 1) AS baseline FROM scores WHERE r > 1
  UNION ALL SELECT run_id, 'u1-v1' FROM scores WHERE r = 1),
matched AS (
  SELECT candidate, baseline, c.user_id <> b.user_id AS other_data, c.model <> b.model
    AS other_model, c.macro_f1 - b.macro_f1 AS gain, c.macro_f1 AS new_f1, b.macro_f1 AS old_f1, [{_DROPS}] AS drops,
    1.0::DOUBLE - c.parse_failure_rate AS parse_rate,
    CASE WHEN b.cost > 0 THEN c.cost / b.cost END AS cost,
    CASE WHEN b.latency > 0 THEN c.latency / b.latency END AS latency
  FROM pairs JOIN scores c ON c.run_id = candidate JOIN scores b ON b.run_id = baseline),
judged AS (
  SELECT *, list_max(drops).d AS worst, list_max(drops).label AS worst_label FROM matched WHERE NOT other_data AND NOT other_model),
ruled AS (
  SELECT candidate, baseline, unnest([
    {{'position': 0, 'rule': 'macro_f1_gain', 'passed': gain >= 0.005::DOUBLE,
      'value': gain, 'limit': 0.005::DOUBLE, 'reason': concat('macro_f1 gain: ', printf('%+.4f', gain),
        ', from ', printf('%.4f', old_f1), ' to ', printf('%.4f', new_f1), ' (min +0.0050)')}},
    {{'position': 1, 'rule': 'class_f1_drop', 'passed': worst <= 0.05::DOUBLE,
      'value': worst, 'limit': 0.05::DOUBLE, 'reason': concat('per-class f1 drop: ', printf('%+.4f', worst),
        ' for ''', worst_label, ''' (max 0.0500)')}},
    {{'position': 2, 'rule': 'parse_rate', 'passed': parse_rate >= 0.99::DOUBLE,
      'value': parse_rate, 'limit': 0.99::DOUBLE,
      'reason': concat('parse rate: ', printf('%.4f', parse_rate), ' (min 0.9900)')}},
    {{'position': 3, 'rule': 'cost', 'passed': coalesce(cost <= 1.5::DOUBLE, true),
      'value': cost, 'limit': 1.5::DOUBLE,
      'reason': concat('cost multiplier: ', printf('%.2f', cost), 'x (max 1.50x)')}},
    {{'position': 4, 'rule': 'latency', 'passed': coalesce(latency <= 1.5::DOUBLE, true),
      'value': latency, 'limit': 1.5::DOUBLE,
      'reason': concat('latency multiplier: ', printf('%.2f', latency), 'x (max 1.50x)')}}], recursive := true)
  FROM judged),
verdicts AS (
  SELECT candidate, baseline, CASE WHEN bool_and(passed) THEN 'PROMOTE' ELSE 'REVERT' END
    AS verdict, coalesce(string_agg(rule, ',' ORDER BY position) FILTER (WHERE NOT passed), '')
    AS failed_rules
  FROM ruled GROUP BY ALL)
"""

_STEP = """
  s.macro_f1 - b.macro_f1 >= 0.005::DOUBLE
  AND greatest(b.f1_click - s.f1_click, b.f1_error - s.f1_error, b.f1_purchase - s.f1_purchase,
    b.f1_signup - s.f1_signup, b.f1_view - s.f1_view) <= 0.05::DOUBLE
  AND 1.0::DOUBLE - s.parse_failure_rate >= 0.99::DOUBLE
  AND (b.cost <= 0 OR s.cost / b.cost <= 1.5::DOUBLE)
  AND (b.latency <= 0 OR s.latency / b.latency <= 1.5::DOUBLE)
"""

_FOLD = f"""
fold AS (
  SELECT chain, r, run_id, CAST(NULL AS VARCHAR) AS baseline_run_id, 'BOOTSTRAP' AS verdict,
    run_id AS next_baseline_run_id FROM scores WHERE r = 1
  UNION ALL
  SELECT s.chain, s.r, s.run_id, b.run_id,
    CASE WHEN {_STEP} THEN 'PROMOTE' ELSE 'REVERT' END,
    CASE WHEN {_STEP} THEN s.run_id ELSE b.run_id END
  FROM fold f JOIN scores s ON s.chain = f.chain AND s.r = f.r + 1
  JOIN scores b ON b.run_id = f.next_baseline_run_id)
"""


def _recursive(ctes: str) -> str:
    return ctes.replace("WITH", "WITH RECURSIVE", 1)


_USER_FOLD = _recursive(f"""{_BY_USER}, {_scores("'model-a'")}, {_FOLD}""")
_EVENT_SCORES = _scores("'model-a'").replace("user_run AS run_id, user_id, r", "run AS run_id, r")
_EVENT_SCORES = _EVENT_SCORES.replace(
    "run_id, user_id, r, concat('u', user_id) AS chain", "run_id, r, 'events' AS chain"
)
_EVENT_FOLD = _recursive(f"{_BY_RUN}, {_EVENT_SCORES}, {_FOLD}")

# ---- documents ----------------------------------------------------------------------------

_DOCS = """
d AS (
  SELECT *, CASE WHEN coalesce(quality, 1) = 1 AND coalesce(toxic, 0) = 0 THEN 'easy'
    ELSE 'hard' END AS difficulty, doc_id % 50 AS c
  FROM documents LEFT JOIN labels USING (doc_id)),
ex AS (
  SELECT doc_id, c, CAST(doc_id AS VARCHAR) AS id, text, lang AS label, difficulty,
    CASE WHEN difficulty = 'hard' THEN source END AS note FROM d)
"""

_VIOLATIONS = f"""WITH {_DOCS},
bad AS (
  SELECT 'documents' AS file, doc_id + 1 AS line_no,
    CASE WHEN c IN (5, 8) THEN 'invalid JSON' WHEN c = 6 THEN 'not a JSON object'
      WHEN c = 4 THEN 'missing field' WHEN c = 7 THEN 'wrong type' WHEN c = 3 THEN 'duplicate id'
      WHEN c = 0 THEN 'unknown label' WHEN c IN (1, 10) THEN 'empty text'
      WHEN c = 2 THEN 'invalid difficulty' END AS violation,
    CASE WHEN c IN (4, 7) THEN 'label' WHEN c = 3 THEN CAST(doc_id - 1 AS VARCHAR)
      WHEN c = 0 THEN 'xx' WHEN c = 2 THEN 'medium' END AS detail
  FROM ex WHERE c IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 10))
"""


def _fingerprint_sql() -> str:
    row = " || ".join(
        f"CASE WHEN {name} IS NULL THEN '-' ELSE length({name}) || ':' || {name} END"
        for name in ("id", "text", "label", "difficulty", "note")
    )
    node = "sha256(string_agg(leaf, ',' ORDER BY leaf)) AS leaf, sum(n) AS n"
    return f"""WITH {_DOCS},
    h AS (SELECT sha256({row}) AS h FROM ex),
    l AS (SELECT h, h || ':' || count(*) AS leaf, count(*) AS n FROM h GROUP BY h),
    l6 AS (SELECT left(h, 6) AS p, {node} FROM l GROUP BY 1),
    l3 AS (SELECT left(p, 3) AS q, {node} FROM l6 GROUP BY 1),
    root AS (SELECT {node} FROM l3)
    SELECT CAST(n AS BIGINT) AS n_examples, left(sha256(n || ',' || leaf), 12) AS fingerprint FROM root"""


_TEMPLATES = """
prompts AS (SELECT * FROM (VALUES
  ('p1', 'Answer with JSON.'), ('p2', 'Answer with {JSON}.'), ('p3', 'Label it.'))
  t(version, system))
"""

# ---- prompts ------------------------------------------------------------------------------

_PROMPTS = """
p AS (
  SELECT concat('c', conv_id, 't', turn) AS version, (conv_id * 8 + turn) % 20 AS c,
    CASE WHEN turn > 0 THEN concat('c', conv_id, 't', turn - 1) END AS parent,
    role AS changelog, text AS system, concat('[', role, '] {{', role, '}} {text}')
      AS user_template
  FROM conversations)
"""


def _json_string(name: str) -> str:
    """ASCII-only JSON text of a column, character by character."""
    return f"""CASE WHEN {name} IS NULL THEN 'null' ELSE '"' || array_to_string(list_transform(
      string_split({name}, ''), lambda ch: CASE
        WHEN ch = '"' THEN '\\"' WHEN ch = '\\' THEN '\\\\'
        WHEN ch = chr(10) THEN '\\n' WHEN ch = chr(13) THEN '\\r' WHEN ch = chr(9) THEN '\\t'
        WHEN ch = chr(8) THEN '\\b' WHEN ch = chr(12) THEN '\\f'
        WHEN ord(ch) BETWEEN 32 AND 126 THEN ch
        WHEN ord(ch) < 65536 THEN printf('\\u%04x', ord(ch))
        ELSE printf('\\u%04x\\u%04x', 55296 + (ord(ch) - 65536) // 1024,
          56320 + (ord(ch) - 65536) % 1024) END), '') || '"' END"""


def _prompt_fingerprint_sql() -> str:
    fields = ("changelog", "parent", "system", "user_template", "version")
    body = " || ', ' || ".join(f"""'"{name}": ' || {_json_string(name)}""" for name in fields)
    return f"""WITH {_PROMPTS}
    SELECT version, left(sha256('{{' || {body} || '}}'), 12) AS fingerprint
    FROM p WHERE c NOT IN (0, 1, 2, 3, 4, 5, 6, 7)"""


# ---- orders -------------------------------------------------------------------------------

_PRIORITIES = "['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW']"
_ORDERS = f"""WITH pred AS (
  SELECT 'orders' AS run, o_orderkey AS id, o_orderpriority AS expected,
    o_orderstatus AS difficulty,
    CASE WHEN o_orderkey % 97 = 0 THEN 'PARSE_FAILURE' WHEN o_orderkey % 6 = 0
      THEN {_PRIORITIES}[CAST(list_position({_PRIORITIES}, o_orderpriority) % 5 + 1 AS INT)]
      ELSE o_orderpriority END AS predicted
  FROM orders), {_metrics('pred', 'run', _PRIORITIES, "['overall', 'F', 'O', 'P']")}
"""


ORACLES: dict[str, str] = {
    "slice_metrics": _SLICE_METRICS,
    "slice_metrics_joined": _SLICE_METRICS,
    "class_metrics": f"""{_BY_RUN} SELECT run_id, slice, label, tp, predicted, support,
        round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
        FROM prf""",
    "confusion_long": f"{_BY_RUN} SELECT * FROM dense",
    "confusion_wide": f"""{_BY_RUN} SELECT run_id, slice, y_true,
        {", ".join(f"CAST(sum(n) FILTER (WHERE y_pred = '{x}') AS BIGINT) AS {x}" for x in
                   ("click", "error", "purchase", "signup", "view", "PARSE_FAILURE"))}
        FROM dense GROUP BY ALL""",
    "classification_report": f"""{_BY_RUN}
        SELECT run_id, slice, 0 AS position, label AS item, round(precision, 6) AS precision,
          round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM prf
        UNION ALL SELECT run_id, slice, 1, 'accuracy', NULL, NULL, round(accuracy, 6), support
          FROM sm
        UNION ALL SELECT run_id, slice, 2, 'macro_f1', NULL, NULL, round(macro_f1, 6), support
          FROM sm
        UNION ALL SELECT run_id, slice, 3, 'micro_f1', NULL, NULL, round(micro_f1, 6), support
          FROM sm
        UNION ALL SELECT run_id, slice, 4, 'parse_failure_rate', NULL, NULL,
          round(parse_failure_rate, 6), support FROM sm""",
    "retarget_metrics": f"{_ORDERS} SELECT {_SLICE_COLUMNS} FROM sm",
    "unknown_true_labels": f"""WITH {_LOG} SELECT run AS run_id, concat(expected, '_old') AS y_true,
        count(*) AS n FROM log WHERE id % 97 = 0 GROUP BY ALL""",
    "unpaired_predictions": f"""WITH {_LOG} SELECT run AS run_id, id, 1 AS "repeat",
        CAST(1 AS BIGINT) AS n_inputs,
        CAST(CASE WHEN id % 101 = 0 THEN 0 ELSE 2 END AS BIGINT) AS n_outputs
        FROM log WHERE id % 101 = 0 OR id % 103 = 0""",
    "parse_predictions": f"{_PARSED} SELECT run AS run_id, id, predicted FROM pred",
    "parse_documents": """SELECT doc_id,
        CASE WHEN doc_id % 16 IN (0, 1, 2, 5, 6, 7, 8, 15) THEN lang ELSE 'PARSE_FAILURE' END
        AS predicted FROM documents""",
    "run_totals": f"WITH {_LOG}, {_TOTALS} SELECT * FROM tot",
    "run_cost": f"""WITH {_LOG}, {_TOTALS} SELECT run_id,
        CASE run_id WHEN 'v5' THEN 'model-b' WHEN 'v6' THEN 'x' ELSE 'model-a' END AS model,
        round(CASE run_id WHEN 'v5' THEN {_cost('0.2', '0.3')} WHEN 'v6' THEN 0.0::DOUBLE
          ELSE {_cost('0.59', '0.79')} END, 6) AS est_cost_usd FROM tot""",
    "run_summary": f"""{_BY_RUN}, {_TOTALS} SELECT run_id, run_id AS prompt_version,
        'model-a' AS model, support, round(accuracy, 6) AS accuracy,
        round(macro_f1, 6) AS macro_f1, round(parse_failure_rate, 6) AS parse_failure_rate,
        n_predictions, latency_ms, prompt_tokens, completion_tokens,
        round({_cost('0.59', '0.79')}, 6) AS est_cost_usd
        FROM sm JOIN tot USING (run_id) WHERE slice = 'overall'""",
    "run_record_nested": f"""{_BY_RUN}, {_TOTALS} SELECT run_id, slice, label,
        round(macro_f1, 6) AS macro_f1, sm.support AS slice_support, round(f1, 6) AS f1,
        prf.support AS support, round({_cost('0.59', '0.79')}, 6) AS est_cost_usd
        FROM prf JOIN sm USING (run_id, slice) JOIN tot USING (run_id)""",
    "run_ids": """WITH t AS (SELECT event_id, event_type,
        strftime(ts, '%Y%m%dT%H%M%S') || lpad(CAST(millisecond(ts) % 1000 AS VARCHAR), 3, '0')
        || 'Z' AS timestamp FROM events)
        SELECT event_id, timestamp, timestamp || '_' || event_type AS run_id FROM t""",
    "class_f1_delta": f"""{_PAIRED},
        split AS (SELECT candidate, baseline, drops, list_max(drops) AS top, unnest(drops) AS e
          FROM judged)
        SELECT candidate, baseline, e.label AS label, CASE WHEN round(e.d, 6) = 0 THEN 0.0::DOUBLE ELSE round(e.d, 6) END AS f1_drop,
          e = top AS is_worst FROM split""",
    "gate_decisions": f"{_PAIRED} SELECT * FROM verdicts",
    "gate_reasons": f"""{_PAIRED} SELECT candidate, baseline, verdict, position, rule, passed,
        CASE WHEN round(value, 6) = 0 THEN 0.0::DOUBLE ELSE round(value, 6) END AS value, "limit",
        CASE WHEN passed THEN '[PASS] ' ELSE '[FAIL] ' END || reason AS reason
        FROM ruled JOIN verdicts USING (candidate, baseline)""",
    "gate_incomparable": f"""{_PAIRED} SELECT candidate, baseline, 'INCOMPARABLE' AS verdict,
        CASE WHEN other_data THEN 'different dataset' ELSE 'different model' END AS reason
        FROM matched WHERE other_data OR other_model
        UNION ALL SELECT run_id, concat('u', user_id, '-v7'), 'INCOMPARABLE', 'unknown run'
        FROM scores WHERE r = 6""",
    "promotion_chain": f"{_EVENT_FOLD} SELECT * EXCLUDE (r) FROM fold",
    "promotion_chain_by_user": f"{_USER_FOLD} SELECT * EXCLUDE (r) FROM fold",
    "baseline_lookup": f"""{_USER_FOLD},
        last AS (SELECT chain, max_by(next_baseline_run_id, r) AS run_id FROM fold GROUP BY chain)
        SELECT last.chain, concat('v', r) AS prompt_version, run_id, round(macro_f1, 6) AS macro_f1
        FROM last JOIN scores USING (run_id)""",
    "validate_examples": f"{_VIOLATIONS} SELECT * FROM bad",
    "first_violation": f"{_VIOLATIONS} SELECT * FROM bad ORDER BY line_no LIMIT 1",
    "duplicate_ids": f"""WITH {_DOCS} SELECT 'documents' AS file, doc_id + 1 AS line_no,
        CAST(doc_id - 1 AS VARCHAR) AS id FROM ex WHERE c = 3""",
    "valid_examples": f"""WITH {_DOCS} SELECT doc_id + 1 AS line_no, id, text, label, difficulty,
        note FROM ex WHERE c NOT IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 11)""",
    "class_distribution": f"WITH {_DOCS} SELECT label, count(*) AS n FROM ex GROUP BY label",
    "dataset_summary": f"""WITH {_DOCS} SELECT count(*) AS n_examples,
        count(*) FILTER (WHERE difficulty = 'easy') AS n_easy,
        count(*) FILTER (WHERE difficulty = 'hard') AS n_hard FROM ex""",
    "dataset_fingerprint": _fingerprint_sql(),
    "prompt_registry": f"""WITH {_PROMPTS} SELECT version, parent, changelog,
        concat('[', changelog, '] {{', changelog, '}} ') AS lead
        FROM p WHERE c NOT IN (0, 1, 2, 3, 4, 5, 6, 7)""",
    "prompt_violations": f"""WITH {_PROMPTS} SELECT version AS stem,
        CASE c WHEN 5 THEN 'invalid YAML' WHEN 0 THEN 'missing field'
          WHEN 2 THEN 'version does not match file name' WHEN 4 THEN 'unsupported placeholder'
          ELSE 'empty field' END AS violation,
        CASE c WHEN 0 THEN 'system' WHEN 1 THEN 'system' WHEN 2 THEN version || 'x'
          WHEN 3 THEN 'parent' WHEN 6 THEN 'changelog' WHEN 7 THEN 'system, user_template' END
          AS detail
        FROM p WHERE c IN (0, 1, 2, 3, 4, 5, 6, 7)""",
    "prompt_fingerprints": _prompt_fingerprint_sql(),
    "render_prompts": f"""WITH {_TEMPLATES} SELECT version AS run_id,
        CAST(doc_id AS VARCHAR) AS id, 1 AS "repeat", system,
        CASE version WHEN 'p1' THEN 'Feedback: ' || text
          WHEN 'p2' THEN 'A {{x}} ' || text || ' / ' || text
          ELSE '{{text}} ' || text || '}}' END AS user
        FROM documents CROSS JOIN prompts""",
    "repeat_expand": """SELECT doc_id, CAST(doc_id AS VARCHAR) AS id, CAST(range AS INT) AS "repeat"
        FROM documents CROSS JOIN range(1, 4)""",
    "score_replay": f"""WITH {_DOCS}, a AS (
          SELECT ex.*, v, CASE WHEN (doc_id + v) % 7 = 0 THEN ''
            WHEN (doc_id + v) % 5 = 0 THEN '{{"category": "en"}}'
            ELSE concat('Label: {{"category": "', label, '"}}') END AS raw_output
          FROM ex CROSS JOIN (SELECT range AS v FROM range(1, 4)))
        SELECT concat('p', v) AS run_id, id, 1 AS "repeat", label AS expected, difficulty,
          CASE WHEN v = 3 OR (doc_id + v) % 7 = 0 THEN 'PARSE_FAILURE' WHEN (doc_id + v) % 5 = 0 THEN 'en'
            ELSE label END AS predicted, CASE WHEN v = 3 THEN '' ELSE raw_output END AS raw_output,
          CASE WHEN v = 3 OR doc_id % 3 = 0 THEN 0 ELSE 10 + doc_id % 9 END AS prompt_tokens,
          CASE WHEN v = 3 OR doc_id % 4 = 0 THEN 0 ELSE 3 + doc_id % 2 END AS completion_tokens,
          v < 3 AS is_recorded
        FROM a""",
    "score_client": f"""WITH {_TEMPLATES} SELECT version AS run_id,
        CAST(doc_id AS VARCHAR) AS id, 1 AS "repeat",
        'm:' || CAST(length(system) AS VARCHAR) || ':0.0' AS content,
        CAST(length(CASE version WHEN 'p1' THEN 'Feedback: ' || text
          WHEN 'p2' THEN 'A {{x}} ' || text || ' / ' || text
          ELSE '{{text}} ' || text || '}}' END) AS BIGINT) AS prompt_tokens,
        CAST(9 AS BIGINT) AS completion_tokens
        FROM documents CROSS JOIN prompts""",
    "scan_examples": f"""{_VIOLATIONS},
        placed AS (SELECT doc_id + 1 AS line_no, doc_id // 1000 AS part,
          row_number() OVER (PARTITION BY doc_id // 1000 ORDER BY doc_id) AS place FROM documents)
        SELECT part, place AS line_no, violation, detail FROM bad JOIN placed USING (line_no)""",
    "report_text": f"""{_BY_RUN},
        lines AS (SELECT run_id, slice, string_agg(rpad(label, 20, ' ') || lpad(printf('%.3f', precision), 10, ' ')
          || lpad(printf('%.3f', recall), 10, ' ') || lpad(printf('%.3f', f1), 10, ' ')
          || lpad(CAST(support AS VARCHAR), 10, ' '), chr(10) ORDER BY label) AS body FROM prf GROUP BY ALL)
        SELECT run_id, slice, concat_ws(chr(10), 'class                precision    recall        f1   support',
          repeat('-', 60), body, '', 'accuracy:            ' || printf('%.3f', accuracy),
          'macro_f1:            ' || printf('%.3f', macro_f1), 'micro_f1:            ' || printf('%.3f', micro_f1),
          'parse_failure_rate:  ' || printf('%.3f', parse_failure_rate) || ' (' || parse_failures || '/' || support || ')')
          AS text FROM sm JOIN lines USING (run_id, slice)""",
    "prompt_files": """WITH c AS (SELECT conv_id, conv_id % 8 AS c, string_agg(text, ' ' ORDER BY turn) AS system
          FROM conversations GROUP BY conv_id),
        f AS (SELECT *, concat('c', conv_id, CASE WHEN c = 4 THEN ' +%41é' ELSE '' END) AS stem FROM c)
        SELECT stem, CASE c WHEN 0 THEN 'not a YAML mapping' WHEN 1 THEN 'missing field' WHEN 2
            THEN 'version does not match file name' WHEN 3 THEN 'invalid YAML' END AS violation,
          CASE c WHEN 1 THEN 'system' WHEN 2 THEN stem || 'x' END AS detail,
          CASE WHEN c NOT IN (0, 1, 3) THEN CAST(length(system) AS INT) END AS n_chars FROM f""",
    "run_store_examples": f"""{_PARSED} SELECT run AS run_id, CAST(id AS VARCHAR) AS id, 1 AS "repeat", expected, difficulty,
        raw_output, predicted, CAST(prompt_tokens AS BIGINT) AS prompt_tokens,
        CAST(completion_tokens AS BIGINT) AS completion_tokens FROM pred""",
    "gate_cycle": f"""{_EVENT_FOLD} SELECT concat('v', fold.r) AS prompt_version,
        (SELECT count(*) FROM events) AS n_predictions, round(macro_f1, 6) AS macro_f1,
        verdict <> 'REVERT' AS became_baseline FROM fold JOIN scores USING (run_id) WHERE fold.r <= 3""",
    "run_store_roundtrip": f"""{_BY_RUN}, {_TOTALS}
        SELECT concat('20240201T00000000', right(run_id, 1), 'Z_', run_id) AS run_id,
          run_id AS prompt_version, CAST(prompt_tokens AS BIGINT) AS prompt_tokens,
          round({_cost('0.59', '0.79')}, 6) AS est_cost_usd, slice, round(macro_f1, 6) AS macro_f1,
          round(f1, 6) AS click_f1
        FROM prf JOIN sm USING (run_id, slice) JOIN tot USING (run_id)
        WHERE label = 'click' AND run_id IN ('v2', 'v5')""",
}
ORACLES["baseline_pointer"] = ORACLES["baseline_lookup"]
