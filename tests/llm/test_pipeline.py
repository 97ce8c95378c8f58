"""The registered queries and the pipeline on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from metaenrich.llm import bpe, edit_match, ordinal, pii_crf, registry, stages
from metaenrich.llm.common import table
from tests.llm.test_small import base_spans, classes, shingle_sets

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query_equals_its_sql(spark, tables, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    expected = con.sql(registry.oracle_sql()[name])
    found = registry.queries()[name](spark, tables).select(*expected.columns)
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())


def test_stages_against_brute_force(spark, tables):
    docs = table(spark, tables, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]

    good = stages.good_quality(spark, docs, tables)
    model = ordinal.train(docs, table(spark, tables, "labels"))
    kept = {r.doc_id for r in ordinal.score(docs, model).where("keep").collect()}
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == kept

    low = classes(shingle_sets([(i, r.text) for i, r in rows.items()]))
    assert {r.doc_id for r in stages.one_of_each_group(spark, docs.union(docs.limit(3)), tables).collect()} == {i for i in rows if low[i] == i}
    assert stages.one_of_each_group(spark, docs.union(docs.limit(3)), tables).count() == len({*low.values()})

    items = [r.text for r in table(spark, tables, "benchmark").collect()]
    clean = {r.doc_id for r in stages.without_benchmarks(spark, docs, tables).collect()}
    found = {r.doc_id for r in registry.queries()["op5_edit_match"](spark, tables).select("doc_id").collect()}
    assert found and clean == set(rows) - found
    short = {i: edit_match.plain(r.text or "") for i, r in rows.items() if len(r.text or "") < 3000}
    wanted = [edit_match.plain(t) for t in items]
    assert {i for i, body in short.items() if any(t in body for t in wanted)} <= found
    for t in wanted[:12]:
        near = {i for i, d in zip(short, distances(t, list(short.values())), strict=True) if d <= edit_match.budget(len(t))}
        assert near <= found
        again = edit_match.find_items(docs, spark.createDataFrame([(1, t)], "item_id int, text string")).collect()
        assert {r.doc_id for r in again} & set(short) == near

    masked = {r.doc_id: r for r in stages.redacted(spark, docs, tables).collect()}
    for i, r in rows.items():
        spans = [x.split(":") for x in base_spans(r.text or "")]
        assert not base_spans(masked[i].text or "") and all((r.text[int(a) : int(b)] not in masked[i].text) for _, a, b in spans)
        assert masked[i].n_chars == len(masked[i].text or "") and (spans or masked[i].text == r.text or "[" in masked[i].text)

    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    library.no_padding(), library.no_truncation()
    for r in stages.encoded(spark, docs, tables).collect():
        assert r.ids == library.encode(rows[r.doc_id].text or "", add_special_tokens=False).ids


def distances(item, texts):
    """Least edit distance of the item to a substring of each text, by the plain table, all texts at a time."""
    longest = max(map(len, texts))
    chars = np.zeros((len(texts), longest), np.int64)
    for i, t in enumerate(texts):
        chars[i, : len(t)] = [ord(c) for c in t]
    pattern, steps = np.array([ord(c) for c in item]), np.arange(len(item) + 1)
    row = np.tile(steps, (len(texts), 1))
    best = row[:, -1].copy()
    for j in range(longest):
        new = np.minimum(row + 1, np.concatenate([np.zeros((len(texts), 1), np.int64), row[:, :-1] + (chars[:, j : j + 1] != pattern)], axis=1))
        new[:, 0] = 0
        row = np.minimum.accumulate(new - steps, axis=1) + steps
        best = np.minimum(best, row[:, -1])
    return best.tolist()


def test_run(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    found = out.collect()
    assert 0 < len(found) < 200 and all(len(r.ids) == r.n_tokens for r in found)


def test_the_rest_works_without_this_part(tmp_path):
    for name in ("metaenrich", "configs", "__spark_entry__.py"):
        source = ROOT / name
        (shutil.copytree if source.is_dir() else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "metaenrich" / "llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)
