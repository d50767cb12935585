"""Sinks: idempotent upserts, appends with new columns, text and JSON files, history rows."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Sequence
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.functions import pyfn

RESULT_SCHEMA = (
    "article_id string NOT NULL, category string, original_html string, enriched_html string, status string, needs_review boolean, "
    "review_reasons array<string>, rules_applied array<string>, changed_node_count int, reviewed_node_count int, processed_node_count int, "
    "skipped_node_count int, prompt_tokens bigint, completion_tokens bigint, source_html_sha256 string, enriched_html_sha256 string, "
    "prompt_version string, model_deployment string, processed_at_utc string, error string"
)
RESULT_KEY = ("article_id", "prompt_version")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ensure(spark: SparkSession, path: str, schema: str = RESULT_SCHEMA) -> None:
    """An empty table where there is none."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)


def one_per_key(rows: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The newest row of each key; ties by all columns' digest, so that the choice doesn't depend on the plan."""
    tie = F.xxhash64(*(F.col(c) for c, t in rows.dtypes if "map<" not in t))
    order = [F.col(c).desc_nulls_last() for c in newest] + [tie]
    return rows.withColumn("__rank__", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rank__ = 1").drop("__rank__")


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after an upsert: a source row replaces the target's rows of its key, other rows stay. The source has
    one row for each key; columns that one side lacks are null."""
    return target.join(source.select(*keys), list(keys), "left_anti").unionByName(source, allowMissingColumns=True)


def upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str] = RESULT_KEY) -> None:
    """Upsert into a parquet table: the new state is written beside the table and then takes its place, so the old one is
    whole until the new one is."""
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not exists(spark, path):
        source.write.parquet(path)
        return
    staged = f"{path}.staged"
    merged(spark.read.parquet(path), source, keys).write.mode("overwrite").parquet(staged)
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = f"{path}.old"
    fs.delete(fs_path(old), True)
    fs.rename(fs_path(path), fs_path(old))
    fs.rename(fs_path(staged), fs_path(path))
    fs.delete(fs_path(old), True)


def append(df: DataFrame, path: str) -> None:
    """Append; new columns are allowed, as with_all_columns reads them."""
    df.write.mode("append").parquet(path)


def append_unless_empty(df: DataFrame, path: str) -> bool:
    if df.isEmpty():
        return False
    append(df, path)
    return True


def with_all_columns(spark: SparkSession, path: str) -> DataFrame:
    """A table with the columns of all its appends, null where an append lacks them."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_text(df: DataFrame, text: str, path: str) -> None:
    df.select(F.col(text).alias("value")).write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def history_rows(numbers: DataFrame, number: str = "num") -> DataFrame:
    """id, num and date of rows to append to the search history."""
    return numbers.select(F.expr("uuid()").alias("id"), F.col(number).cast("string").alias("num"), F.current_timestamp().alias("date"))


_DOCX_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def docx(paragraphs: Sequence[str]) -> bytes:
    """A Word file of plain paragraphs."""
    main = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(p)}</w:t></w:r></w:p>' for p in paragraphs)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as file:
        file.writestr(
            "[Content_Types].xml",
            f'{_DOCX_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Override PartName="/word/document.xml" '
            'ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>',
        )
        file.writestr(
            "_rels/.rels",
            f'{_DOCX_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" '
            'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>',
        )
        file.writestr("word/document.xml", f'{_DOCX_HEAD}<w:document xmlns:w="{main}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


def docx_files(df: DataFrame, key: str, paragraphs: str) -> DataFrame:
    """key and content of a Word file for each row's array of paragraphs."""
    return pyfn.exploded(df, [key], [paragraphs], "content binary", lambda ps: [(docx([p or "" for p in ps or []]),)])
