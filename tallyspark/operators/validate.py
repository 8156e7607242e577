"""Validation of labelled example lines and of prompt rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.functions.json_text import (
    STRICT_OPTIONS,
    has_foreign_infinity,
    in_brackets,
    in_object,
    is_blank,
    is_strict_json,
    strip_space,
)
from tallyspark.functions.templates import template_is_supported
from tallyspark.operators.sharing import local_copy, one_pass
from tallyspark.task import TaskSpec

# The fields of the input contract.
#: Required fields of an example line, in the order in which absences are reported.
REQUIRED_FIELDS = ("id", "text", "label", "difficulty")
#: Required fields of a prompt file, and those that must also hold text.
PROMPT_FIELDS = ("version", "parent", "changelog", "system", "user_template")
PROMPT_TEXT_FIELDS = ("version", "changelog", "system", "user_template")

#: Shapes of a line.
OBJECT, OTHER, INVALID = "object", "other", "invalid"

_TYPED = "struct<id variant, text variant, label variant, difficulty variant, note string>"


def decode_lines(lines: DataFrame) -> DataFrame:
    """Strictly decode ``raw``; all other columns are kept.

    Adds the ``shape`` of the line, the absent required fields, the fields whose value has the
    wrong type, and the five fields. Blank lines go; they have been counted in the line numbers.
    Filter by ``raw`` before, not by what is decoded after: a filter on a decoded column is moved
    below the decoding, which then runs once more for it.
    """
    lines = lines.where(~is_blank(F.col("raw")))
    body = F.col("raw")
    # Two wrapped parses make the strictness test (see is_strict_json) and deliver the fields.
    typed = F.from_json(in_brackets(body), f"array<{_TYPED}>", STRICT_OPTIONS)
    keyed = F.from_json(in_object(body), "struct<r map<string,string>>", STRICT_OPTIONS)

    parsed = (
        lines.withColumn("raw", strip_space(F.col("raw")))
        .withColumn("_typed", typed)
        .withColumn("_keys", F.map_keys(keyed.getField("r")))
    )
    # A stripped line may close the wrapper early ("{},{}"); exactly one element is one value.
    is_object = (
        F.col("_keys").isNotNull()
        & (F.size("_typed") == 1)
        & F.get("_typed", F.lit(0)).isNotNull()
        & ~has_foreign_infinity(F.col("raw"))
    )
    shape = (
        F.when(is_object, OBJECT)
        .when(is_strict_json(F.col("raw")), OTHER)
        .otherwise(INVALID)
    )
    row = F.get("_typed", F.lit(0))
    # A value that is no valid variant (an object with repeated keys) has no kind of its own.
    kinds = {
        f"_{name}": F.coalesce(F.schema_of_variant(row.getField(name)), F.lit("NESTED"))
        for name in REQUIRED_FIELDS
    }

    def wrong(name: str) -> Column:
        allowed = ("STRING",) if name == "id" else ("STRING", "VOID")
        return ~F.col(f"_{name}").isin(*allowed)

    missing = F.array_except(
        F.array(*[F.lit(name) for name in REQUIRED_FIELDS]), F.col("_keys")
    )
    wrong_type = F.filter(
        F.array(*[F.when(wrong(name), F.lit(name)) for name in REQUIRED_FIELDS]),
        lambda name: name.isNotNull(),
    )

    def text(name: str) -> Column:
        value = row.getField(name)
        return F.when(F.col(f"_{name}") == "STRING", F.variant_get(value, "$", "string"))

    return parsed.withColumn("shape", shape).withColumns(kinds).select(
        *[name for name in lines.columns if name != "raw"],
        "shape",
        F.when(F.col("shape") == OBJECT, missing).alias("missing"),
        F.when(F.col("shape") == OBJECT, wrong_type).alias("wrong_type"),
        *[F.when(F.col("shape") == OBJECT, text(name)).alias(name) for name in REQUIRED_FIELDS],
        F.when(F.col("shape") == OBJECT, row.getField("note")).alias("note"),
    )


def repeated_ids(rows: DataFrame) -> DataFrame:
    """``(id, first_file, first_line)`` for every id, the absent one too, that occurs more than once."""
    position = F.struct("file", "line_no")
    return (
        rows.groupBy("id")
        .agg(F.min(position).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where("_copies > 1")
        .select(
            "id", F.col("_first.file").alias("first_file"), F.col("_first.line_no").alias("first_line")
        )
    )


def mark_duplicates(rows: DataFrame) -> DataFrame:
    """Add ``is_duplicate``: the id was already seen on an earlier line.

    The rows, one per line and without texts, go through one exchange that spreads them by position;
    both the count per id and the marking read it, so the lines are decoded once. Counting combines
    before it is shuffled, and a window that sorts all copies of one id in one task is not needed.
    Where the repeated ids turn out to be few, Spark broadcasts them to the rows where they lie;
    else both sides meet by id, and a partition that a hot id overfills is split.
    """
    spread = one_pass(rows)
    repeats = repeated_ids(spread).withColumnRenamed("id", "_id")
    # Null-safe, although an absent id repeats nothing: an implied "is not null" would be moved below
    # the exchange of one reader only, and the two would not share it any more.
    marked = spread.join(repeats, F.col("id").eqNullSafe(F.col("_id")), "left")
    later = F.struct("file", "line_no") > F.struct("first_file", "first_line")
    # One expression, for the same reason: its parts could be moved one by one.
    is_duplicate = F.when(F.col("id").isNotNull() & F.col("first_line").isNotNull(), later)
    return marked.select(*rows.columns, F.coalesce(is_duplicate, F.lit(False)).alias("is_duplicate"))


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """Every occurrence of an id after its first one."""
    ids = mark_duplicates(rows.select("file", "line_no", "id"))
    return ids.where("is_duplicate").select("file", "line_no", "id")


def check_rows(decoded: DataFrame, task: TaskSpec) -> DataFrame:
    """Name the first violation of every decoded line (null for a good line).

    What a line can show by itself is settled where it is decoded; only the verdict, its detail and
    the id travel on: ``file, line_no, violation, detail``.

    Precedence: invalid JSON, not an object, missing field, wrong type, duplicate id, unknown
    label, empty text, invalid difficulty. A later copy of an id counts as a duplicate even if
    the first copy has a violation of its own.
    """
    before = (
        F.when(F.col("shape") == INVALID, "invalid JSON")
        .when(F.col("shape") == OTHER, "not a JSON object")
        .when(F.size("missing") > 0, "missing field")
        .when(F.size("wrong_type") > 0, "wrong type")
    )
    # The good values are non-null here: nulls of label and difficulty are outside their sets.
    bad_label = ~F.coalesce(F.col("label").isin(list(task.classes)), F.lit(False))
    bad_difficulty = ~F.coalesce(F.col("difficulty").isin(list(task.slices)), F.lit(False))
    after = (
        F.when(bad_label, "unknown label")
        .when(F.coalesce(is_blank(F.col("text")), F.lit(True)), "empty text")
        .when(bad_difficulty, "invalid difficulty")
    )
    detail = (
        F.when(F.col("before") == "missing field", F.array_join("missing", ", "))
        .when(F.col("before") == "wrong type", F.array_join("wrong_type", ", "))
        .when(F.col("after") == "unknown label", F.col("label"))
        .when(F.col("after") == "invalid difficulty", F.col("difficulty"))
    )
    settled = (
        decoded.withColumn("before", before)
        .withColumn("after", F.when(F.col("before").isNull(), after))
        .select("file", "line_no", "id", "before", "after", detail.alias("detail"))
    )
    is_later = F.col("before").isNull() & F.col("is_duplicate")
    return mark_duplicates(settled).select(
        "file",
        "line_no",
        F.when(is_later, "duplicate id").otherwise(F.coalesce("before", "after")).alias("violation"),
        F.when(is_later, F.col("id")).otherwise(F.col("detail")).alias("detail"),
    )


def validate_examples(decoded: DataFrame, task: TaskSpec) -> DataFrame:
    """All bad lines: ``(file, line_no, violation, detail)``."""
    return check_rows(decoded, task).where(F.col("violation").isNotNull())


def valid_examples(decoded: DataFrame, task: TaskSpec) -> DataFrame:
    """The good lines as examples.

    Bad lines are few in a sound dataset: found first and brought together as a local table, they are
    broadcast and the texts do not move. Too many for that, they meet the lines in a shuffle.
    """
    bad = validate_examples(decoded, task).select("file", "line_no")
    few = local_copy(bad)
    return decoded.join(bad if few is None else F.broadcast(few), ["file", "line_no"], "left_anti").select(
        "file", "line_no", *REQUIRED_FIELDS, "note"
    )


def first_violation(violations: DataFrame) -> DataFrame:
    """The first bad line of each file."""
    first = F.min(F.struct("line_no", "violation", "detail")).alias("first")
    return violations.groupBy("file").agg(first).select("file", "first.*")


def raise_first_violation(violations: DataFrame) -> None:
    """Fail-fast form for loaders: one error that names the first bad line."""
    row = first_violation(violations).orderBy("file").first()
    if row is not None:
        detail = f" ({row['detail']})" if row["detail"] else ""
        raise ValueError(f"{row['file']}: line {row['line_no']}: {row['violation']}{detail}")


def check_prompts(prompts: DataFrame) -> DataFrame:
    """Name the first violation of every prompt row and cut the good templates into parts."""
    absent = F.array_except(F.array(*[F.lit(n) for n in PROMPT_FIELDS]), F.col("fields"))
    # A null text counts as empty; only the parent may be null, but not blank.
    checks = [
        F.when(F.coalesce(is_blank(F.col(n)), F.lit(True)), F.lit(n)) for n in PROMPT_TEXT_FIELDS
    ]
    checks.append(F.when(is_blank(F.col("parent")), F.lit("parent")))
    empty = F.filter(F.array(*checks), lambda name: name.isNotNull())
    violation = (
        F.when(F.col("decode_error").isNotNull(), F.col("decode_error"))
        .when(F.size(absent) > 0, "missing field")
        .when(F.size(empty) > 0, "empty field")
        .when(F.col("version") != F.col("stem"), "version does not match file name")
        .when(~template_is_supported(F.col("user_template")), "unsupported placeholder")
    )
    detail = (
        F.when(F.col("violation") == "missing field", F.array_join(absent, ", "))
        .when(F.col("violation") == "empty field", F.array_join(empty, ", "))
        .when(
            F.col("violation") == "version does not match file name", F.col("version")
        )
    )
    return prompts.withColumn("violation", violation).withColumn("detail", detail)


def prompt_violations(prompts: DataFrame) -> DataFrame:
    return (
        check_prompts(prompts)
        .where(F.col("violation").isNotNull())
        .select("stem", "violation", "detail")
    )
