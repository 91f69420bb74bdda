"""What operators store goes: at once where no result reads it, and all of it with the block that owns it."""

import os

import numpy as np
import pytest

from tallgrass.llm import queries, vectors
from tallgrass.llm.common import new_path, scratch, shared_dir, stored
from tests.conftest import SF

#: Tables that the lazy result of a query still reads.
LEFT = {
    "op1_mixing_score": 2, "op2_packing": 0, "op3_divergence": 2, "op4_quality_trees": 0, "op5_suffix_family": 1, "op6_projection_links": 2,
    "op7_jaccard_join": 3, "op8_line_dedup": 2, "op9_arc_to_warc": 1, "op10_fair_mixing": 1, "op11_polar_whitening": 0, "op12_toxicity_automata": 0, "op13_token_alignment": 1,
}


def _tables(spark):
    return set(os.listdir(shared_dir(spark)))


@pytest.mark.parametrize("name", LEFT)
def test_a_query_leaves_what_its_result_reads(spark, name):
    before = _tables(spark)
    with scratch(spark):
        rows = queries.QUERIES[name](spark, SF)
        left = _tables(spark) - before
        assert len(left) == LEFT[name], left
        assert rows.toArrow().num_rows > 0
    assert _tables(spark) == before


def test_the_pipeline_leaves_its_last_documents(spark):
    import corpus_pipeline

    before = _tables(spark)
    with scratch(spark):
        rows = corpus_pipeline.run(spark, SF)
        left = _tables(spark) - before
        assert [x.rpartition("-")[0] for x in left] == ["mixing-sources"]
        assert rows.toArrow().num_rows > 0
    assert _tables(spark) == before


def test_scratch_blocks_nest_and_end_with_errors(spark):
    before = _tables(spark)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        path = new_path(spark, "outer")
        with scratch(spark):
            stored(spark.range(3), "inner")
            kept = stored(spark.range(5), "kept", path)
        assert kept.count() == 5 and len(_tables(spark) - before) == 1
        stored(spark.range(2), "late")
        1 / 0  # noqa: B018
    assert _tables(spark) == before


def test_archives_stay_in_a_folder(spark, tmp_path):
    from tallgrass.llm import archives

    pages = spark.createDataFrame([(1, "http://a/", "x" * 120), (2, "http://b/", "x" * 120), (3, None, None)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in archives.archive_pages(pages, folder=str(tmp_path)).collect()}
    assert got == {1: ("response", None), 2: ("revisit", 1), 3: ("response", None)}
    assert archives.read_arc(spark, str(tmp_path / "arc")).count() == archives.read_warc(spark, str(tmp_path / "warc")).count() == 3


def test_links_just_above_the_limit_are_found(spark):
    """3,000 pairs at cosines from 0.93 to 0.94 in labels of different sizes."""
    r = np.random.default_rng(5)
    n, d = 3000, 32
    a = r.normal(size=(n, d))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = r.normal(size=(n, d))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = r.uniform(0.9301, 0.94, n)[:, None]
    b = cosine * a + np.sqrt(1 - cosine**2) * side
    label = np.where(np.arange(n) < 2000, 0, np.arange(n) % 40)
    rows = [(2 * i + k, [float(y) for y in x[i]], int(label[i])) for i in range(n) for k, x in ((0, a), (1, b))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    with scratch(spark):
        got = vectors.link_vectors(df).toPandas().set_index("vec_id")
    x = np.concatenate([np.stack([a[i], b[i]]) for i in range(n)])
    owner = np.repeat(label, 2)
    near = np.zeros(2 * n, np.int64)
    for part in np.unique(owner):
        on = np.flatnonzero(owner == part)
        near[on] = (x[on] @ x[on].T >= 0.93).sum(1) - 1
    assert near.sum() >= 2 * n and (got.n_links.loc[range(2 * n)].to_numpy() <= near).all()
    assert got.n_links.sum() >= 0.99 * near.sum()
