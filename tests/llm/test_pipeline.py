"""The registered queries and the pipeline over the smallest tables, beside plain Python or SQL."""

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from compare import check, oracle
from llm_words import words

from earshot.llm.queries import oracle_sql, queries

DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_": {"page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"},
    "op2_": {"doc_id", "n_shingles", "component_id", "kept"},
    "op3_": {"doc_id", "size", "source_size", "target", "taken"},
    "op4_": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op5_": {"page_id", "url", "text", "n_chars"},
    "op6_": {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"},
    "op7_": {"doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"},
    "op8_": {"doc_id", "n_tokens_before", "n_tokens"},
    "op9_": {"doc_id", "item_id", "score"},
    "op10_": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op11_": {"doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"},
    "op12_": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op13_": {"word", "form", "root", "n", "n_near", "form_n"},
}


def test_every_operator_is_registered():
    assert all(sum(name.startswith(op) for name in entry.queries()) == 1 for op in COLUMNS)
    assert "pipeline" in entry.queries() and set(queries()) <= set(entry.queries())


@pytest.mark.parametrize("op", COLUMNS)
def test_query_covers_its_table(spark, op):
    name = next(n for n in queries() if n.startswith(op))
    out = queries()[name](spark, DIR)
    assert COLUMNS[op] <= set(out.columns)
    if op == "op13_":  # a row per word: its SQL tells which
        return
    table = "pages" if op in ("op1_", "op5_") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    ids = sorted(r[0] for r in out.select(key).collect())
    every = sorted(r[0] for r in spark.read.parquet(f"{DIR}/{table}.parquet").select(key).collect())
    assert set(ids) <= set(every) if op == "op9_" else ids == every


@pytest.mark.parametrize("name", oracle_sql())
def test_query_equals_its_sql(spark, name):
    assert check(spark, oracle(DIR), name, queries()[name], oracle_sql()[name], DIR) == ""


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DIR}/labels.parquet").collect()}
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, DIR), corpus_pipeline.scratch_path(spark, name))
        after = {r.doc_id: r.text for r in docs.collect()}
        gone = set(before) - set(after)
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert {i for i in gone if labels.get(i) == 1 and len(before[i].split()) >= 20} == set()
            assert {i for i in after if labels.get(i) == 0} == set()
        if name == "decontamination":
            assert gone == {i for i, t in before.items() if any(x in " ".join(words(t)) for x in items)}
        if name == "privacy":
            assert not gone and any("[EMAIL]" in t for t in after.values()) and not any(".example.com" in t for t in after.values())
        if name != "mixing":
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        before = after
    assert {"size", "target", "taken"} <= set(docs.columns)


HELPERS = "_text _words _source _end _shards _safe _key _kept_id _copies _clean _place matches base kept clean_text terms".split()


def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeats, and columns named like those of the operators."""
    schema = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    prose = "The quiet river bends around the old mill and its water turns the wooden wheel all day long. "
    more = "".join(f"Line {i} tells of harvest number {i * 7919} in the valley. " for i in range(4000))
    rows = [
        (None, None, None, None, None),
        (1, None, "en", None, ""),
        (2, "a", None, 1, prose * 2),
        (2, "a", None, 1, prose * 2),
        (3, None, "en", 5, more),
        (None, "b", "en", 5, "Write to kim@example.org about the boats that came home before the storm, and " + prose.lower()),
        (4, "b", "en", 5, None),
    ]
    return spark.createDataFrame(rows, schema).selectExpr("*", *[f"'{c}!' AS `{c}`" for c in HELPERS])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_documents(spark, name, stage):
    docs = odd_documents(spark)
    out = stage(spark, docs, DIR)
    assert out.columns[: len(docs.columns)] == docs.columns
    found = out.collect()
    assert all(r[c] == f"{c}!" for r in found for c in HELPERS)
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in found)
    want = {
        "quality_rules": [-1, 3],  # the text of 2 repeats all its words
        "near_dedup": [-1, -1, 1, 2, 3, 4],
        "decontamination": [-1, -1, 1, 2, 2, 3, 4],
        "privacy": [-1, -1, 1, 2, 2, 3, 4],
        "mixing": [-1, 2, 2, 3],
    }
    assert ids == want[name]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_an_empty_table(spark, name, stage):
    docs = odd_documents(spark).where("false")
    out = stage(spark, docs, DIR)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == 0
