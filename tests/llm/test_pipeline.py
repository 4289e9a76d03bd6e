"""run() against the same decisions taken by brute force, stage by stage."""

import corpus_pipeline as P
from stratus.llm import pieces, quality
from stratus.llm.queries import model_bytes
from tests.conftest import SF_SMALL

from . import brute


def decide(rows, items):
    """[(id, text, ...)] -> {id: text} before the last stage."""
    judged = [(i, quality.judge(t, quality.Rules())) for i, t in rows]
    rows = [(i, r[9]) for i, r in judged if r[6]]
    rows = [(i, t) for (i, t), (_, _, c) in zip(rows, brute.jaccard_groups(rows)) if i == c]
    rows = [(i, brute.dedup_row(*r)[4]) for (i, _), r in zip(rows, brute.removed([t for _, t in rows]))]
    out = {}
    for i, t in rows:
        n, hit, _ = brute.contamination(t, items)
        if not (hit and 20 * hit >= n):
            out[i] = t
    return out


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").toPandas()
    want = decide(list(zip(docs.doc_id, docs.text)), list(zip(bench.item_id, bench.text)))
    encoder = pieces.PieceModel(model_bytes())
    got = P.run(spark, SF_SMALL).collect()
    assert len(got) == len(want) and {r.doc_id for r in got} == set(want)
    for r in got:
        t = want[r.doc_id]
        assert r.lossless and list(r.piece_ids) == brute.encode_with_draws(t, r.doc_id, encoder, 17, 0.1)


def test_stages_keep_columns_and_take_hard_rows(spark, hard_docs, no_docs):
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, hard_docs, SF_SMALL)
        assert out.columns == hard_docs.columns
        assert stage(spark, no_docs, SF_SMALL).count() == 0
    kept = P.near_duplicates(spark, hard_docs, SF_SMALL).collect()
    assert sum(r.doc_id == 11 for r in kept) == 0 and sum(r.doc_id is None for r in kept) == 2
    assert all(r.lossless for r in P.pieces(spark, hard_docs, SF_SMALL).collect())
