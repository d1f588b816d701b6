"""Registered queries run over whole tables; the one with an SQL form equals it; the pipeline equals plain Python."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
import plain  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from oracle import compare, duck  # noqa: E402
from tallygrid.llm import queries, secrets  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) == []


def test_pipeline(spark):
    """Each stage's rows follow from the rows before it by the plain versions."""
    docs = queries.table(spark, SF, "documents")
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())

    first = stages["language_id"](spark, docs, SF)
    assert first.columns == docs.columns and set(rows(first)) <= set(rows(docs)) and first.count() >= 0.98 * docs.count()
    second = stages["ngram_jaccard"](spark, first, SF)
    before = rows(first)
    assert rows(second) == [p for p, (i, n, c) in zip(before, plain.near_copies(before)) if not n or i == c]
    third = stages["decontamination"](spark, second, SF)
    before = rows(second)
    assert rows(third) == [p for p, r in zip(before, plain.contamination(before, items)) if not r[5]]
    fourth = stages["secrets"](spark, third, SF)
    assert fourth.columns == docs.columns and fourth.count() == third.count()
    for (i, old), (j, new) in zip(rows(third), rows(fourth)):
        assert i == j and not plain.secrets(new) and (old == new) == (not plain.secrets(old) and "[SECRET]" not in new)
    assert all(r["n_chars"] == len(r["text"]) for r in fourth.collect())
    last = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in last.collect()) == [i for i, _ in rows(fourth)]
    assert secrets.scan(fourth).where("size(base) > 0").count() == 0
