"""Queries take whole tables and whole texts."""

import pytest

from lakeknot.plans import fixtures, queries


@pytest.fixture
def long_docs(spark, tmp_path):
    """Documents of over 3,000 characters whose last words are their own; a folder like the driver's."""
    rows = [(k, "12 some filler words " * 200 + f"tail{k} lastword{k % 2}", "en") for k in range(6)] + [(6, "7 short road", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_addr_tokens_of_long_documents(spark, long_docs):
    rows = {r["doc_id"]: set(r["addr_tok"].split()) for r in queries.QUERIES["b7_addr_tok_documents"](spark, long_docs).collect()}
    assert sorted(rows) == list(range(7))
    assert all({"12", "filler", f"tail{k}", f"lastword{k % 2}"} <= rows[k] for k in range(6))


def test_scored_holds_all_pairs(spark, sf_dir):
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet").toPandas() for t in ("orders", "lineitem"))
    both = lines.merge(orders, left_on="l_orderkey", right_on="o_orderkey")
    rows = fixtures.scored(spark, sf_dir).select("s1_id", "cand_id").collect()
    assert sorted(map(tuple, rows)) == sorted(set(zip(both.o_custkey, both.l_partkey, strict=True)))


def test_never_a_candidate_is_not_retrieved(spark, sf_dir):
    _, noisy, found = queries.candidates(spark, sf_dir)
    true = {(r["owner"], r["entity_id"]) for r in noisy.select("owner", "entity_id").collect()}
    missed = true - {(r["s1_id"], r["cand_id"]) for r in found.collect()}
    rows = queries.QUERIES["l6_fn_reason"](spark, sf_dir).where("reason = 'never_a_candidate'").collect()
    assert {(r["s1_id"], r["cand_id"]) for r in rows} == missed
    total = queries.QUERIES["l2_loss_attribution"](spark, sf_dir).where("country = 'ALL'").first()
    assert (total["blocked"], total["blocked"] + total["tp"] + total["fn"]) == (len(missed), len(true))


def test_late_passages_retrieve(spark, long_docs):
    """Documents 1 and 5 share only a word at their ends that not all others have."""
    rows = queries.QUERIES["c9_reverse_topk_documents"](spark, long_docs).where("rn = 1 AND score > 0").collect()
    assert {(r["query"], r["id"]) for r in rows} == {(1, 5), (2, 0), (3, 5), (4, 0)}


def test_registry_joins_words_not_texts(spark, tmp_path):
    """The registry is that of the whole texts, odd ones included, and no text is sent to the join with customers."""
    long = "one two three four " + "filler " * 30_000
    texts = [long + f"end{k}" for k in range(10)] + [None, "", "word", "two words", "a  b   c", " led by a blank", "a b c d", "tab\tand more words here"]
    made = {
        "documents": ([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"),
        "customer": ([(k, k % 2) for k in range(40)], "c_custkey long, c_nationkey int"),
        "part": ([(k, f"part {k % 3}") for k in range(40)], "p_partkey long, p_name string"),
        "nation": ([(0, "PERU"), (1, "CHINA")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = fixtures.registry(spark, str(tmp_path))
    whole = fixtures._made(spark, str(tmp_path), fixtures.REGISTRY)
    assert got.count() == whole.count() > 40 and got.exceptAll(whole).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "substring_index(text" in plan
