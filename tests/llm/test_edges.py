"""Awkward input: every operator and stage gives a defined result for each row and does not fail."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cloudloom.llm import bpe, decontaminate, html_text, importance, pii, quality_rules, secret_scan, simhash, substrings, url_filter


def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (4, 0, 0), (4, None, 0), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, None), (None, "a b c"), (2, ""), (3, "plain3 token9"), (3, "plain3 token9")], "item_id long, text string")


def one_row_each(labels):
    return {
        "rules": lambda d: quality_rules.apply_rules(d),
        "secrets": lambda d: secret_scan.find_secrets(d),
        "resample": lambda d: importance.resample(d, labels),
        "components": lambda d: simhash.simhash_components(d),
        "bpe": lambda d: bpe.encode_documents(d, path()),
        "pii": lambda d: pii.find_personal_data(d),
        "repeats": lambda d: substrings.remove_repeats(d),
    }


NAMES = ["rules", "secrets", "resample", "components", "bpe", "pii", "repeats"]


@pytest.mark.parametrize("name", NAMES)
def test_one_row_for_each_document(awkward, labels, name):
    found = one_row_each(labels)[name](awkward)
    assert found.count() == awkward.count()
    assert found.where("doc_id is null").count() == 2 and found.where("doc_id = 5").count() == 3


@pytest.mark.parametrize("name", NAMES)
def test_an_empty_table_gives_an_empty_table(docs_of, labels, name):
    assert one_row_each(labels)[name](docs_of([])).count() == 0


def test_rules_on_awkward_rows(awkward):
    rows = {r.doc_id: r for r in quality_rules.apply_rules(awkward).where("doc_id in (1, 2, 3, 5, 7)").collect()}
    assert rows[1].n_words == rows[2].n_words == rows[3].n_words == 0 and rows[1].base_failed and not rows[1].kept
    assert rows[7].n_words == 4 and rows[7].word_chars == 7 and rows[5].kept


def test_leaks_on_awkward_rows(awkward, bench, docs_of):
    found = decontaminate.contaminated(awkward, bench)
    assert {(r.doc_id, r["items"]) for r in found.collect()} <= {(5, "3"), (None, "3"), (10, "3")}
    assert decontaminate.contaminated(docs_of([]), bench).count() == 0
    assert decontaminate.contaminated(awkward, bench.where("false")).count() == 0
    assert decontaminate.without_leaks(awkward, bench.where("false")).count() == awkward.count()


def test_urls_on_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (None, "http://a.net/x"), (5, "http://A.NET"), (5, "http://A.NET"), (6, "://" + "x" * 50_000), (7, "http://é.example.org/fr/?a=1&b=2#c")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("features", F.lit("clash"))
    found = {r.page_id: r for r in url_filter.filter_urls(pages).collect()}
    assert url_filter.filter_urls(pages).count() == len(rows)
    assert found[1].host == "" and found[2].path == "" and found[3].host == "" and found[1].verdict in ("allow", "block")
    assert found[5].rule is None and found[5].host == "a.net" and found[None].rule == "net/" and found[7].rule == "org/fr/"
    assert url_filter.filter_urls(pages.where("false")).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages.where("page_id < 4")).collect()} == {"allow"}


def test_pages_on_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>x"), (4, "<" * 50_000), (5, "<div>" * 5_000 + "deep"), (6, "plain"), (6, "plain")]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))
    found = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    assert found[1] == found[2] == "" and found[None] == "x" and found[5] == "deep" and found[6] == "plain"
    assert html_text.extract_text(pages).count() == 7 and html_text.extract_text(pages.where("false")).count() == 0


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_on_awkward_rows(spark, awkward, docs_of, sf_dir, k):
    name, stage = corpus_pipeline.STAGES[k]
    for docs in (awkward, docs_of([])):
        found = stage(spark, docs, sf_dir)
        rows = found.count()
        assert rows <= docs.count()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert found.columns == docs.columns and found.dtypes == docs.dtypes


def test_one_of_each_keeps_one_row_of_each_group(docs_of):
    long = " ".join(f"w{k}" for k in range(300))
    docs = docs_of([(3, long), (2, long), (2, long), (2, "other words here now"), (None, long), (None, "alone in its group"), (9, None), (8, "")])
    kept = simhash.one_of_each(docs)
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in kept.collect()) == [(0, "alone"), (2, "other"), (2, "w0 w1"), (8, "")]
    assert kept.columns == docs.columns


def test_slices_are_bounded_in_rows_and_bytes():
    import pyarrow as pa

    from cloudloom.llm.common import slices

    texts = ["a" * 10, None, "", "b" * 70, "c", "ä" * 30, *["d"] * 7]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["n", "text"])
    parts = list(slices([batch, batch.slice(0, 0), batch.slice(3, 2)], rows=4, size=60))
    assert [p.column(0).to_pylist() for p in parts] == [[0, 1, 2], [3], [4], [5], [6, 7, 8, 9], [10, 11, 12], [3], [4]]
    assert [t for p in parts[:6] for t in p.column(1).to_pylist()] == texts
