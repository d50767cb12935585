import ast
import os
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from palimpsest.operators import relational, rewriting
from palimpsest.plans import catalog, enrich
from palimpsest.streaming import enrich as stream

ROOT = Path(__file__).resolve().parent.parent
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PAGES = [
    ("a1", "cards", "<h1>T</h1><p>We utilise 3 cards prior to noon. <b>Keep  this</b></p>"),
    ("a2", None, "<p>plain</p><!-- c -->"),
    ("a3", "fees", None),
    ("a4", "fees", ""),
    ("a5", "fees", "<p>Pay EUR 5 whenever you like."),
]


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame(PAGES, "article_id string, category string, html string")


def test_job_is_idempotent(spark, source, tmp_path):
    path = str(tmp_path / "results")
    job = enrich.Job("v1")
    assert enrich.run(spark, source, path, job) == 4
    got = {r.article_id: r for r in spark.read.parquet(path).collect()}
    assert got["a1"].enriched_html == "<h1>T</h1><p>We use 3 cards before noon. <b>Keep  this</b></p>" and got["a1"].status == "succeeded" and got["a1"].changed_node_count == 1
    assert got["a2"].category == "all" and got["a2"].enriched_html == got["a2"].original_html and got["a4"].processed_node_count == 0
    assert got["a5"].enriched_html == "<p>Pay EUR 5 when you like."
    assert enrich.run(spark, source, path, job) == 0
    assert enrich.run(spark, source.union(spark.createDataFrame([("a9", "x", "<p>new</p>")], source.schema)), path, job) == 1
    assert enrich.run(spark, source, path, enrich.Job("v2", batch_size=2)) == 2
    assert spark.read.parquet(path).count() == 7


@pytest.mark.parametrize("fault", ["drop", "number", "raise"])
def test_faults_return_the_original(source, fault):
    job = enrich.Job("v1", rewriter=rewriting.FaultyRewriter(rewriting.IdentityRewriter(), fault))
    got = {r.article_id: r for r in enrich.enriched(source, job).collect()}
    assert got["a5"].status == "review_required" and got["a5"].enriched_html == PAGES[4][2] and got["a5"].review_reasons


def test_numbered_lists_and_rules(spark):
    page = spark.createDataFrame([("a", "cards", "<ul><li>one prior to two</li></ul>")], "article_id string, category string, html string")
    rules = spark.createDataFrame(
        [("r1", "i", 1, True, ["cards"], None, False), ("r2", "i", 1, True, ["fees"], None, False)],
        "rule_id string, instruction string, priority int, active boolean, categories array<string>, html_tags array<string>, deterministic boolean",
    )
    got = enrich.enriched(page, enrich.Job("v", numbered_lists=True), rules).first()
    assert got.enriched_html == "<ol><li>one before two</li></ol>" and got.rules_applied == ["r1"]
    version = enrich.prompt_version(rules, "kb")
    assert re.fullmatch(r"kb-[0-9a-f]{12}", version) and version == enrich.prompt_version(rules.orderBy(F.desc("rule_id")), "kb")
    assert version != enrich.prompt_version(rules.withColumn("priority", F.lit(2)), "kb")


def test_experiment(spark, source):
    detail = enrich.experiment(spark, source.where("html is not null"), {"A": rewriting.IdentityRewriter(), "B": rewriting.RuleRewriter()}, {"B": 2})
    summary = {r.variant_id: r for r in relational.variant_summary(detail, "variant_id", "status", "elapsed_sec", "input_chars", ["changed", "invariants_ok"]).collect()}
    assert summary["A"].docs_total == summary["B"].docs_total == 4 and summary["A"].changed_rate == 0.0 and summary["B"].changed_rate > 0


def test_stream(spark, source, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "out")
    source.coalesce(1).write.parquet(folder)
    for _ in range(2):
        query = stream.start(stream.article_stream(spark, folder), path, str(tmp_path / "cp"), enrich.Job("v1"))
        query.awaitTermination(120)
        assert spark.read.parquet(path).count() == 4
    spark.createDataFrame([("b1", "x", "<p>more</p>")], source.schema).write.mode("append").parquet(folder)
    stream.start(stream.article_stream(spark, folder), path, str(tmp_path / "cp"), enrich.Job("v1")).awaitTermination(120)
    assert spark.read.parquet(path).count() == 5


def test_nothing_outside_the_folder_imports_it():
    for file in [*ROOT.glob("palimpsest/**/*.py"), ROOT / "bench.py"]:
        if "llm" in file.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(file.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(n.startswith("palimpsest.llm") for n in names), file


needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@needs_data
def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and "status" in df.columns


@needs_data
@pytest.mark.parametrize("name", [n for n in catalog.queries() if n in catalog.oracle_sql()])
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")

    def flat(v):
        if isinstance(v, (list, tuple)):
            return [flat(x) for x in v]
        return f"{v:.6g}" if isinstance(v, float) else v

    df = catalog.queries()[name](spark, DATA)
    got = df.select(*sorted(df.columns)).collect()
    want = con.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    assert sorted(df.columns) == sorted(columns)
    key = lambda r: repr([flat(v) for v in r])
    assert sorted(map(key, got)) == sorted(key([r[i] for i in order]) for r in want.fetchall())


@needs_data
@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in catalog.oracle_sql()])
def test_query_runs(spark, name):
    df = catalog.queries()[name](spark, DATA)
    rows = df.collect()
    assert rows or name in ("style_issues",)
    if name == "html_markers":
        assert all(r.same for r in rows)
