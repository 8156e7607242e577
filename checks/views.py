"""Evaluation tables derived from the given star-schema tables, whole tables always."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.functions.json_text import canonical_json
from tallyspark.functions.parsing import parse_predictions
from tallyspark.operators.fingerprint import dataset_fingerprint, prompt_registry
from tallyspark.operators.validate import PROMPT_FIELDS
from tallyspark.plans.evaluate import EvalResult, run_summary
from tallyspark.operators.sharing import one_pass
from tallyspark.sources.tables import read_table
from tallyspark.task import TaskSpec

EVENT_TASK = TaskSpec(("click", "error", "purchase", "signup", "view"))
LANG_TASK = TaskSpec(("de", "en", "es", "fr"))
ORDER_TASK = TaskSpec(
    ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    response_key="priority",
    slices=("F", "O", "P"),
)
N_RUNS = 6
PRICES = {"model-a": (0.59, 0.79), "model-b": (0.2, 0.3)}


# ---- events: a prediction log of six runs -------------------------------------------------


def event_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Events as labelled examples."""
    return read_table(spark, folder, "events", "event_id", "user_id", "event_type", "props").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("props").alias("text"),
        F.col("event_type").alias("label"),
        F.when(F.col("event_id") % 3 == 0, "hard").otherwise("easy").alias("difficulty"),
        F.lit(None).cast("string").alias("note"),
    )


def event_outputs(spark: SparkSession, folder: str, by_user: bool = False) -> DataFrame:
    """Raw outputs of every run for every event; the right label or the next one."""
    name = "concat('u', user_id, '-v', r)" if by_user else "concat('v', r)"
    return (
        read_table(spark, folder, "events", "event_id", "user_id", "event_type")
        .withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(N_RUNS))))
        .selectExpr(
            "event_id AS id",
            "user_id",
            "r",
            f"{name} AS run_id",
            "1 AS repeat",
            "event_type AS expected",
            "IF(event_id % 3 = 0, 'hard', 'easy') AS difficulty",
            "array_position(array('click', 'error', 'purchase', 'signup', 'view'), event_type)"
            " - 1 AS ci",
            "event_id % IF(r % 2 = 0, 1000, 400) AS m",
        )
        .selectExpr(
            "*",
            "element_at(array('click', 'error', 'purchase', 'signup', 'view'), CAST("
            "IF((id * 11 + r) % (4 + r) = 0, (ci + 1) % 5, ci) + 1 AS INT)) AS lab",
        )
        .selectExpr(
            "run_id",
            "user_id",
            "r",
            "id",
            "repeat",
            "expected",
            "difficulty",
            """CASE m WHEN 0 THEN 'not json'
                WHEN 1 THEN concat('{"category": "', lab, '_x"}')
                WHEN 2 THEN '{"category": 5}'
                WHEN 3 THEN concat('["', lab, '"]')
                WHEN 4 THEN ''
                WHEN 5 THEN concat('{"label": "', lab, '"}')
                WHEN 6 THEN concat('{"a": {"b": 1}, "category": "', lab, '"} tail')
                WHEN 7 THEN 'null'
                ELSE IF(id % 5 = 0, concat('Sure: {"category": "', lab, '"} ok'),
                        concat('{"category": "', lab, '"}')) END AS raw_output""",
            "IF(r = 6, 2, 1) * (40 + id % 20 + 2 * r) AS prompt_tokens",
            "5 + id % 4 AS completion_tokens",
            "CAST(100 + id % 50 + r AS DOUBLE) AS latency_ms",
        )
    )


def event_predictions(spark: SparkSession, folder: str, by_user: bool = False) -> DataFrame:
    return parse_predictions(event_outputs(spark, folder, by_user), EVENT_TASK)


def _run_rows(heads: DataFrame, run: str, model: str) -> DataFrame:
    return heads.withColumn("r", F.explode(F.sequence(F.lit(1), F.lit(N_RUNS)))).select(
        "chain",
        F.expr(run).alias("run_id"),
        F.concat(F.lit("v"), F.col("r")).alias("prompt_version"),
        F.expr("timestampadd(DAY, r, TIMESTAMP'2024-02-01 00:00:00')").alias("ts"),
        "dataset_fp",
        F.expr(model).alias("model"),
        "r",
    )


def event_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The six runs over all events, one chain."""
    heads = one_pass(dataset_fingerprint(event_examples(spark, folder))).select(
        F.lit("events").alias("chain"), F.col("fingerprint").alias("dataset_fp")
    )
    return _run_rows(heads, "concat('v', r)", "'model-a'")


def user_runs(spark: SparkSession, folder: str, model: str = "'model-a'") -> DataFrame:
    """Six runs per user over that user's events, one chain per user."""
    heads = one_pass(dataset_fingerprint(event_examples(spark, folder), by=["user_id"])).select(
        F.concat(F.lit("u"), F.col("user_id")).alias("chain"),
        F.col("fingerprint").alias("dataset_fp"),
    )
    return _run_rows(heads, "concat(chain, '-v', r)", model)


def event_result(spark: SparkSession, folder: str) -> EvalResult:
    runs = event_runs(spark, folder)
    return run_summary(runs, event_predictions(spark, folder), EVENT_TASK, PRICES)


def user_result(spark: SparkSession, folder: str, model: str = "'model-a'") -> EvalResult:
    runs = user_runs(spark, folder, model)
    return run_summary(runs, event_predictions(spark, folder, by_user=True), EVENT_TASK, PRICES)


# ---- documents: labelled examples ---------------------------------------------------------


def document_examples(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as examples: the language is the label, a weak or toxic one is hard."""
    labels = read_table(spark, folder, "labels", "doc_id", "quality", "toxic")
    docs = read_table(spark, folder, "documents", "doc_id", "text", "lang", "source")
    return (
        docs.join(labels, "doc_id", "left")
        .withColumn(
            "difficulty",
            F.expr("IF(coalesce(quality, 1) = 1 AND coalesce(toxic, 0) = 0, 'easy', 'hard')"),
        )
        .select(
            "doc_id",
            F.col("doc_id").cast("string").alias("id"),
            "text",
            F.col("lang").alias("label"),
            "difficulty",
            F.when(F.col("difficulty") == "hard", F.col("source")).alias("note"),
        )
    )


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The examples as JSON lines; twelve kinds of fault by document number."""
    case = F.col("doc_id") % 50

    def unless(number: int, column: str, value) -> F.Column:
        return F.when(case == number, value).otherwise(F.col(column))

    good = F.to_json(
        F.struct(
            F.when(case == 3, (F.col("doc_id") - 1).cast("string"))
            .otherwise(F.col("id"))
            .alias("id"),
            F.when(case == 1, "  ")
            .when(case == 10, " \t ")
            .otherwise(F.col("text"))
            .alias("text"),
            F.when(case == 0, "xx").when(case != 4, F.col("label")).alias("label"),
            unless(2, "difficulty", "medium").alias("difficulty"),
            "note",
        )
    )
    numeric_label = F.to_json(F.struct("id", "text", F.lit(5).alias("label"), "difficulty"))
    raw = (
        F.when(case == 5, F.expr("left(good, length(good) - 1)"))
        .when(case == 6, F.concat(F.lit("["), F.col("good"), F.lit("]")))
        .when(case == 7, numeric_label)
        .when(case == 8, F.concat(F.col("good"), F.lit(" tail")))
        .when(case == 9, F.concat(F.lit("  "), F.col("good"), F.lit("\t ")))
        .when(case == 11, F.lit(" 　 "))
        .otherwise(F.col("good"))
    )
    return (
        document_examples(spark, folder)
        .withColumn("good", good)
        .select(
            F.lit("documents").alias("file"), (F.col("doc_id") + 1).alias("line_no"),
            raw.alias("raw"),
        )
    )


def document_answers(spark: SparkSession, folder: str) -> DataFrame:
    """One awkward raw output per document, built around its whole text."""
    docs = read_table(spark, folder, "documents", "doc_id", "text", "lang")
    plain = F.expr("""concat('{"category": "', lang, '"}')""")
    raw = (
        F.when(F.col("c") == 0, plain)
        .when(
            F.col("c") == 1,
            F.to_json(F.struct(F.col("text").alias("why"), F.col("lang").alias("category"))),
        )
        .when(F.col("c") == 2, F.concat("text", F.lit(" "), plain, F.lit(" "), "text"))
        .when(
            F.col("c") == 3,
            F.expr("""concat('{"a": {"b": 1}, "category": "', lang, '"} ', text)"""),
        )
        .when(F.col("c") == 4, F.expr("""concat("{'category': '", lang, "'}")"""))
        .when(
            F.col("c") == 5, F.expr("""concat('{"category": "xx", "category": "', lang, '"}')""")
        )
        .when(F.col("c") == 6, F.expr("""concat('{"n": NaN, "category": "', lang, '"}')"""))
        .when(F.col("c") == 7, F.concat(F.lit("﻿"), plain))
        .when(F.col("c") == 8, F.concat(F.lit("```json\n"), plain, F.lit("\n```")))
        .when(F.col("c") == 9, F.lit(" null\n"))
        .when(F.col("c") == 10, F.expr("""concat('["', lang, '"]')"""))
        .when(F.col("c") == 11, F.lit('{"category": 5}'))
        .when(
            F.col("c") == 12,
            F.concat(F.lit('{"why": "\n", "category": "'), "lang", F.lit('"}')),
        )
        .when(F.col("c") == 13, F.lit(None))
        .when(F.col("c") == 14, F.expr("""concat('{"n": -INF, "category": "', lang, '"}')"""))
        .otherwise(
            F.concat(
                F.lit('{"category": "\\u00'),
                F.lower(F.hex(F.substring("lang", 1, 1))),
                F.substring("lang", 2, 9),
                F.lit('"}'),
            )
        )
    )
    return docs.withColumn("c", F.col("doc_id") % 16).select("doc_id", raw.alias("raw_output"))


# ---- prompts ------------------------------------------------------------------------------


def render_prompts_set(spark: SparkSession) -> DataFrame:
    """Three prompts to render the documents with."""
    rows = [
        ("p1", None, "first", "Answer with JSON.", "Feedback: {text}"),
        ("p2", "p1", "braces", "Answer with {JSON}.", "A {{x}} {text} / {text}"),
        ("p3", "p2", "nested", "Label it.", "{{text}} {text}}}"),
    ]
    source = [(row[0], None, list(PROMPT_FIELDS), *row) for row in rows]
    return prompt_registry(spark.createDataFrame(source, schemas.PROMPT_SOURCE))


def conversation_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn of every conversation as a prompt version, some of them faulty."""
    turns = read_table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return (
        turns.withColumn("stem", F.expr("concat('c', conv_id, 't', turn)"))
        .withColumn("c", F.expr("(conv_id * 8 + turn) % 20"))
        .select(
            "stem",
            F.when(F.col("c") == 5, "invalid YAML").alias("decode_error"),
            F.expr(
                "IF(c = 0, array('version', 'parent', 'changelog', 'user_template'),"
                " array('version', 'parent', 'changelog', 'system', 'user_template'))"
            ).alias("fields"),
            F.expr("IF(c = 2, concat(stem, 'x'), stem)").alias("version"),
            F.expr(
                "CASE WHEN c = 3 THEN ' ' WHEN turn > 0 THEN concat('c', conv_id, 't', turn - 1)"
                " END"
            ).alias("parent"),
            F.expr("CASE WHEN c <> 6 THEN role END").alias("changelog"),
            F.expr("CASE WHEN c = 0 THEN NULL WHEN c IN (1, 7) THEN '  ' ELSE text END").alias(
                "system"
            ),
            F.expr(
                "CASE WHEN c = 4 THEN 'Q {name}: {text}' WHEN c = 7 THEN ''"
                " ELSE concat('[', role, '] {{', role, '}} {text}') END"
            ).alias("user_template"),
        )
    )


def one_prompt(spark: SparkSession, version: str) -> DataFrame:
    row = (version, None, list(PROMPT_FIELDS), version, None, "a version", "Answer with JSON.", "Event: {text}")
    return prompt_registry(spark.createDataFrame([row], schemas.PROMPT_SOURCE))


def conversation_files(spark: SparkSession, folder: str) -> DataFrame:
    """``stem, text``: a YAML file per conversation; by its number some are empty or faulty."""
    turns = read_table(spark, folder, "conversations", "conv_id", "turn", "text")
    whole = turns.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"]), " ").alias("system")
    )
    case = F.col("conv_id") % 8
    name = F.concat(F.lit("c"), F.col("conv_id"))
    stem = F.when(case == 4, F.concat(name, F.lit(" +%41é"))).otherwise(name)
    fields = {
        "version": F.when(case == 2, F.concat("stem", F.lit("x"))).otherwise(F.col("stem")),
        "parent": F.lit(None).cast("string"),
        "changelog": F.lit("from a talk"),
        "system": F.col("system"),
        "user_template": F.lit("{text}"),
    }
    # JSON text of ASCII is YAML too; characters beyond 16 bits would need another escape.
    plain = F.regexp_replace("system", r"[^\x{0}-\x{FFFF}]", "?")
    good = canonical_json(fields)
    lacking = canonical_json({name: value for name, value in fields.items() if name != "system"})
    text = F.when(case == 0, "").when(case == 1, lacking).when(case == 3, F.concat(good, F.lit("]"))).otherwise(good)
    return whole.withColumn("system", plain).withColumn("stem", stem).select("stem", text.alias("text"))


def document_completions(spark: SparkSession, folder: str) -> DataFrame:
    """Recorded completions of two of the three prompts for each document."""
    return (
        read_table(spark, folder, "documents", "doc_id", "lang")
        .withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
        .select(
            F.concat(F.lit("p"), F.col("v")).alias("run_id"),
            F.col("doc_id").cast("string").alias("id"),
            F.lit(1).alias("repeat"),
            F.expr(
                """CASE WHEN (doc_id + v) % 7 = 0 THEN NULL
                   WHEN (doc_id + v) % 5 = 0 THEN '{"category": "en"}'
                   ELSE concat('Label: {"category": "', lang, '"}') END"""
            ).alias("content"),
            F.expr("IF(doc_id % 3 = 0, NULL, 10 + doc_id % 9)").alias("prompt_tokens"),
            F.expr("IF(doc_id % 4 = 0, NULL, 3 + doc_id % 2)").alias("completion_tokens"),
            F.lit(1.5).alias("latency_ms"),
        )
    )


# ---- orders: another task -----------------------------------------------------------------


def order_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Order priorities as labels, order status as slices."""
    labels = ", ".join(f"'{label}'" for label in ORDER_TASK.classes)
    outputs = read_table(
        spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority"
    ).selectExpr(
        "'orders' AS run_id",
        "o_orderkey AS id",
        "o_orderpriority AS expected",
        "o_orderstatus AS difficulty",
        f"""CASE WHEN o_orderkey % 97 = 0 THEN 'n/a'
            WHEN o_orderkey % 6 = 0 THEN concat('{{"priority": "', element_at(array({labels}),
              CAST(array_position(array({labels}), o_orderpriority) % 5 + 1 AS INT)), '"}}')
            ELSE concat('{{"priority": "', o_orderpriority, '"}}') END AS raw_output""",
    )
    return parse_predictions(outputs, ORDER_TASK)
