"""Top-k search and the pipeline against brute force, and the queries against their SQL."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sonorium.llm import op1_mixing, op2_ngram_join, op5_exact, op7_toxicity, op8_bpe, op10_topk, queries
from tests.compare import compare
from tests.llm.test_dedup import brute_exact, brute_pairs, grams

SF = "/root/testdata/sf0.001"
SQL = queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_queries(spark, name):
    assert compare(spark, queries.queries()[name], SQL.get(name), SF).startswith(("same", "rows only"))


def brute_top(rows, k, every):  # noqa: ANN001, ANN201
    items = {(i, tuple(np.float32(v).astype(float))) for i, v in rows}
    out = set()
    for i in {i for i, _ in items if i % every == 0}:
        ranked = sorted((-round(float(np.dot(v, w)), 9), j) for h, v in items if h == i for j, w in items if j != i)[:k]
        out |= {(i, r, j, round(-s, 8) + 0.0) for r, (s, j) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize(("every", "block", "group", "lead", "stretch"), [(20, 1024, 4096, 2, 8), (1, 8, 16, 2, 3), (3, 4, 5, 1, 1), (7, 16, 1, 50, 2)])
def test_top_k(spark, every, block, group, lead, stretch):
    rnd = np.random.default_rng(0)
    rows = [(i, (rnd.standard_normal(6) * (1 + i % 5) ** 2).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (5, rows[5][1]), (300, [0.0] * 6), (-20, rows[4][1]), (40, rows[9][1])]
    bad = [(None, rows[0][1]), (400, None), (401, []), (402, [1.0]), (403, [float("nan")] * 6), (404, [None] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + bad], "vec_id long, embedding array<float>, rank int, ids int").repartition(3)
    got = {(r[0], r[1], r[2], round(r[3], 8) + 0.0) for r in op10_topk.top_k(df, 7, every, block, group, lead, stretch).collect()}
    assert got == brute_top(rows, 7, every)
    for few in (df.limit(0), df.filter("vec_id = 0"), df.filter("vec_id = 21")):
        assert op10_topk.top_k(few).count() == 0


def test_moments_are_added_in_a_tree(spark):
    df = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i)]) for i in range(300)], "id long, v array<double>").repartition(20)
    axes, head = op10_topk.rotation(df, 3)
    x = np.array([r["v"] for r in df.collect()])
    assert np.allclose(np.abs(axes), np.abs(np.linalg.eigh(x.T @ x)[1][:, ::-1]), atol=1e-6) and 1 <= head <= 3


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lexicon = op7_toxicity.fit_lexicon(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scorer = op7_toxicity.Scorer(lexicon)
    import pyarrow as pa

    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    toxic = scorer.score(pa.array([t for _, t, _ in rows], pa.large_string()))[3]
    rows = [r for r, bad in zip(rows, toxic) if not bad]
    dropped = {i for i, _, dup in brute_exact(rows) if dup}
    rows = [r for r in rows if r[0] not in dropped]
    root = {i: i for i, _, _ in rows}

    def find(x):  # noqa: ANN001, ANN202
        while root[x] != x:
            x = root[x]
        return x

    for a, b in brute_pairs(rows):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    rows = [r for r in rows if not grams(r[1]) or find(r[0]) == r[0]]
    kept = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = Counter((r["doc_id"]) for r in op1_mixing.mix_sources(kept).collect())
    out = corpus_pipeline.run(spark, SF)
    got = out.collect()
    assert Counter(r["doc_id"] for r in got) == want
    assert all(r["round_trip"] for r in got)
    machine = op8_bpe.Codec(op8_bpe.read_ranks())
    text = {i: t for i, t, _ in rows}
    assert all(machine.decode(np.array(r["tokens"], np.int64)).tobytes().decode() == text[r["doc_id"]] for r in got)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    awkward = docs.limit(3).unionByName(docs.limit(2)).selectExpr("if(doc_id = 1, null, doc_id) doc_id", "if(doc_id = 2, null, text) text", "lang", "cast(null as string) source", "n_chars")
    for f in (op5_exact.drop_exact_duplicates, op2_ngram_join.drop_near_duplicates, op1_mixing.mix_sources):
        assert f(awkward).columns == docs.columns and f(awkward).count() >= 0
