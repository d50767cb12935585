"""Sources: tables, rules, documents and configuration as DataFrames."""

from __future__ import annotations

import io
import os
import re
import zipfile
from collections.abc import Mapping
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import pyfn

RULE_SCHEMA = (
    "rule_id string, instruction string, priority int, active boolean, categories array<string>, html_tags array<string>, deterministic boolean"
)


def named(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog, or parquet where the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A table of a database; give partitionColumn, lowerBound, upperBound and numPartitions to read it in parallel."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def probed(df: DataFrame, text: str, key: str | None = None, category: str | None = None, default_category: str = "internal") -> DataFrame:
    """doc_id, html_text and category of any table: an error without the text column, a hash of the text as id and
    the default category where the others are missing or null. Rows without a text are left out."""
    if text not in df.columns:
        raise ValueError(f"column {text} is missing; there are {', '.join(df.columns)}")
    value = F.col(text).cast("string")
    made = F.sha2(value, 256)
    has = lambda c: c is not None and c in df.columns
    return df.where(F.col(text).isNotNull()).select(
        (F.coalesce(F.col(key).cast("string"), made) if has(key) else made).alias("doc_id"),
        value.alias("html_text"),
        (F.coalesce(F.col(category), F.lit(default_category)) if has(category) else F.lit(default_category)).alias("category"),
    )


def _or_all(c: Column) -> Column:
    return F.when(F.size(F.coalesce(c, F.array().cast("array<string>"))) == 0, F.array(F.lit("all"))).otherwise(c)


def rules(df: DataFrame) -> DataFrame:
    """Active rules; no category or tag means all; a null flag isn't active."""
    kept = df.where(F.col("active") == F.lit(True))
    return kept.withColumn("categories", _or_all(F.col("categories"))).withColumn("html_tags", _or_all(F.col("html_tags")))


def rules_from_json(spark: SparkSession, path: str) -> DataFrame:
    """Active rules of a JSON list; a rule without a flag is active, one without a priority has 100."""
    raw = spark.read.schema(RULE_SCHEMA).json(path, multiLine=True)
    return rules(
        raw.withColumn("active", F.coalesce("active", F.lit(True)))
        .withColumn("priority", F.coalesce("priority", F.lit(100)))
        .withColumn("deterministic", F.coalesce("deterministic", F.lit(False)))
    )


def whole_files(spark: SparkSession, path: str, strip: bool = False) -> DataFrame:
    """path and text of text or HTML files, each whole."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return text.withColumn("text", F.trim("text")) if strip else text


_WORD = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _docx(content: bytes) -> list[tuple[int, str, bool]]:
    with zipfile.ZipFile(io.BytesIO(content)) as file:
        root = ElementTree.fromstring(file.read("word/document.xml"))
    out = []
    for n, p in enumerate(root.iter(f"{_WORD}p")):
        text = "".join(t.text or "" if t.tag == f"{_WORD}t" else "\t" if t.tag == f"{_WORD}tab" else "\n" for t in p.iter() if t.tag in (f"{_WORD}t", f"{_WORD}tab", f"{_WORD}br"))
        out.append((n, text, not text.strip()))
    return out


def docx_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """path, index, text and is_empty of the paragraphs of Word files."""
    files = spark.read.format("binaryFile").load(path)
    return pyfn.exploded(files, ["path"], ["content"], "index int, text string, is_empty boolean", _docx)


def line_paragraphs(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, index, text and is_empty of the lines of a text; a null text has none."""
    lines = df.select(key, F.posexplode(F.split(text, "\n")).alias("index", "text"))
    return lines.withColumn("is_empty", F.trim("text") == "")


def settings(*layers: Mapping[str, str | None], env: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Configuration: the first layer with a value that isn't blank wins, the environment (upper-case names) last."""
    names = {n for layer in layers for n in layer}
    out: dict[str, str] = {}
    for n in sorted(names):
        for value in (*(layer.get(n) for layer in layers), env.get(re.sub(r"\W", "_", n).upper())):
            if value is not None and str(value).strip():
                out[n] = value
                break
    return out


def synthetic_documents(spark: SparkSession, count: int, chars: int, sections: int = 8) -> DataFrame:
    """doc_id and html of documents of exactly ``chars`` characters, made of numbered sections and a filler."""
    parts = [
        F.format_string(
            f"<h2>Section {n} of document %d</h2><p>Part <strong>{n}</strong> has <a href=\"#s{n}\">links</a> and {n * 7} %% of the whole.</p><ul><li>first<ol><li>inner</li></ol></li></ul>",
            F.col("id"),
        )
        for n in range(1, sections + 1)
    ]
    body = F.concat(F.lit("<div>"), *parts)
    tail, filler = "</p></div>", "The filler repeats itself. "
    room = F.lit(chars) - F.length(body) - len("<p>") - len(tail)
    html = F.concat(body, F.lit("<p>"), F.substring(F.repeat(F.lit(filler), F.lit(chars // len(filler) + 1)), F.lit(1), room), F.lit(tail))
    return spark.range(count).select(F.col("id").alias("doc_id"), html.alias("html"))
