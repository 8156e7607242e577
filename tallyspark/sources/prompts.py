"""The prompt registry: one YAML mapping per file, named after its version."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark import schemas
from tallyspark.operators.fingerprint import prompt_registry
from tallyspark.operators.validate import PROMPT_FIELDS, prompt_violations
from tallyspark.operators.sharing import local_copy


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import yaml

    def cells(stem: str, text: str) -> tuple:
        none = (None,) * len(PROMPT_FIELDS)
        try:
            data = yaml.safe_load(text)
        except Exception:  # noqa: BLE001 - a bad date in one file must not stop the others
            return (stem, "invalid YAML", [], *none)
        if not isinstance(data, dict):
            return (stem, "not a YAML mapping", [], *none)
        values = [data.get(name) for name in PROMPT_FIELDS]
        return (
            stem,
            None,
            [str(key) for key in data],
            *[None if value is None else str(value) for value in values],
        )

    for batch in batches:
        yield pd.DataFrame(
            [cells(stem, text) for stem, text in zip(batch["stem"], batch["text"])],
            columns=schemas.PROMPT_SOURCE.names,
        )


def _empty_stems(spark: SparkSession, folder: str) -> list[str]:
    """Stems of the files of zero bytes, which Spark's readers leave out."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    files = [f for f in system.listStatus(path) if f.isFile() and f.getLen() == 0]
    names = [f.getPath().getName() for f in files]
    return [name.removesuffix(".yaml") for name in names if name.endswith(".yaml")]


def scan_prompts(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """Every ``*.yaml`` file of a folder, or one of them, decoded but not judged; empty if none.

    A file that cannot be decoded, or is empty, is a row that says so.
    """
    empty = [
        (stem, "not a YAML mapping", [], *[None] * len(PROMPT_FIELDS))
        for stem in _empty_stems(spark, folder)
        if version in (None, stem)
    ]
    blank = spark.createDataFrame(empty, schemas.PROMPT_SOURCE)
    reader = spark.read.option("pathGlobFilter", "*.yaml")
    try:
        files = reader.text(folder, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return blank
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.yaml$", 1)
    # File names arrive percent-encoded, but a plus sign in them is just a plus sign.
    plain = F.url_decode(F.replace(stem, F.lit("+"), F.lit("%2B")))
    texts = files.select(plain.alias("stem"), F.col("value").alias("text"))
    if version is not None:
        texts = texts.where(F.col("stem") == version)
    return texts.mapInPandas(_decode, schemas.PROMPT_SOURCE).unionByName(blank)


def list_versions(spark: SparkSession, folder: str) -> DataFrame:
    return scan_prompts(spark, folder).select(F.col("stem").alias("version")).orderBy("version")


def load_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The usable prompts of a folder."""
    return prompt_registry(scan_prompts(spark, folder))


def load_prompt(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """One prompt; raises if it is absent or unusable."""
    found = local_copy(scan_prompts(spark, folder, version), 1)  # one small file
    if found.isEmpty():
        raise FileNotFoundError(f"prompt version {version!r} not found in {folder}")
    bad = prompt_violations(found).first()
    if bad is not None:
        detail = f" ({bad['detail']})" if bad["detail"] else ""
        raise ValueError(f"{folder}/{version}.yaml: {bad['violation']}{detail}")
    return prompt_registry(found)
