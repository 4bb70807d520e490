"""Every operator and stage over awkward and over empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import decontamination, exact, html, licenses, lines, mixing, pii, sharding, simhash, toxicity

ROWS = 16
NAMED = 13  # distinct identifiers, null as one


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(
        [(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "mail a.b")], "item_id long, text string"
    )


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1), (2, 0), (3, 0), (7, None), (None, 1), (8, 1), (10, 0)], "doc_id long, toxic int"
    )


REPORTS = {
    "lines": (lambda d, b, t: lines.line_report(d), NAMED),
    "exact": (lambda d, b, t: exact.exact_groups(d), ROWS),
    "simhash": (lambda d, b, t: simhash.simhash_classes(d), ROWS),
    "sharding": (lambda d, b, t: sharding.placed(d), ROWS),
    "mixing": (lambda d, b, t: mixing.mix(d), ROWS),
    "toxicity": (lambda d, b, t: toxicity.scored(d, t), ROWS),
    "pii": (lambda d, b, t: pii.spans_by_document(d), ROWS),
    "items": (lambda d, b, t: decontamination.with_items(d, b, "found"), ROWS),
    "licenses": (lambda d, b, t: licenses.with_licenses(d, "found"), ROWS),
    "drop lines": (lambda d, b, t: lines.drop_lines(d), ROWS),
}


@pytest.mark.parametrize("name", REPORTS)
def test_awkward_rows_all_come_back(name, awkward, bench, labels):
    run, rows = REPORTS[name]
    assert len(run(awkward, bench, labels).collect()) == rows


@pytest.mark.parametrize("name", REPORTS)
def test_empty_tables_give_empty_results(name, empty, bench, labels):
    assert REPORTS[name][0](empty, bench.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["mixing", "items", "licenses", "drop lines"])
def test_clashing_columns_keep_their_values(name, awkward, bench, labels):
    out = REPORTS[name][0](awkward, bench, labels)
    assert out.columns[: len(awkward.columns)] == awkward.columns
    assert out.where(F.col("weight") == "kept as it is").count() == ROWS


def test_notices_and_contaminated_pairs(awkward, empty, bench):
    assert licenses.notices(awkward).count() == 0
    found = decontamination.contaminated(awkward, bench).collect()
    assert sorted(r.doc_id for r in found) == [1, 2, 2, 3]
    assert {(r.item_id, r.distance) for r in found} == {(1, 0)}
    assert decontamination.contaminated(empty, bench).count() == licenses.notices(empty).count() == 0


def test_pages_without_html_host_or_rows(spark):
    rows = [(1, None, None), (2, "nonsense", ""), (None, "http://h.example/x", "<p>a</p>"), (3, "http://h.example/x", "plain"),
            (4, "http://h.example/y", "<div>" * 3000 + "deep"), (4, "http://h.example/y", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = pages.withColumns({"host": F.lit("h"), "wrapper": F.lit("w")})
    got = sorted((r.page_id or 0, r.text, r.host) for r in html.with_text(clash).collect())
    assert got == [(0, "a", "h"), (1, "", "h"), (2, "", "h"), (3, "plain", "h"), (4, "deep", "h"), (4, "deep", "h")]
    assert html.extracted(pages.limit(0)).collect() == []


@pytest.fixture
def tables(tmp_path, bench, labels):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_take_awkward_documents(spark, awkward, tables):
    docs, seen = awkward, []
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, tables)
        assert out.columns[: len(awkward.columns)] == awkward.columns
        out.write.parquet(f"{tables}/out{i}")
        docs = spark.read.parquet(f"{tables}/out{i}")
        seen.append(docs.count())
    assert all(seen)


def test_stages_take_empty_documents(spark, empty, tables):
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, tables).count() == 0


def test_workers_find_the_package_from_any_folder(tmp_path):
    """A session started elsewhere, with the package only on the driver's own path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    code = """
import sys
sys.path.insert(0, sys.argv[1])
from tickloom.session import local_session
from tickloom.llm import decontamination, html, licenses, simhash, toxicity
spark = local_session(2, 2)
docs = spark.createDataFrame([(1, "you idiot"), (2, "Released under the MIT License.")], "doc_id long, text string")
items = spark.createDataFrame([(1, "you idiot")], "item_id long, text string")
labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
pages = spark.createDataFrame([(1, "http://a.b/c", "<p>x</p>")], "page_id long, url string, html string")
found = [simhash.simhash_classes(docs), simhash.one_of_each(docs), decontamination.contaminated(docs, items),
         toxicity.scored(docs, labels), licenses.notices(docs), html.extracted(pages)]
print([x.count() for x in found])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    root = str(Path(__file__).resolve().parents[2])
    run = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert run.stdout.split("\n")[-2] == "[2, 2, 1, 2, 1, 1]", run.stderr[-2000:]
