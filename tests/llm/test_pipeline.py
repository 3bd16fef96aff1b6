import re

import pytest

from tests.llm.test_llm import ROWS, SCHEMA, brute_groups

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark, sf):
    import corpus_pipeline as cp
    from filigrain.llm import quality
    from filigrain.llm.common import written

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{sf}/labels.parquet")
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).filter("score >= 0.7").collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] in good}
    steps = []
    for name, stage in cp.STAGES[:-1]:
        docs = written(stage(spark, docs, sf), name)
        assert docs.columns == columns
        steps.append([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {d for d, _ in steps[0]} == good
    best = {}
    for d, t in rows.items():
        key = "".join(WORD.findall(t))
        best[key] = min(best.get(key, (0, d)), (-len(t), d)) if key in best else (-len(t), d)
    copies = {d: rows[d] for _, d in best.values()}
    assert dict(steps[1]) == copies
    groups = brute_groups(copies, 5, 80)
    assert {d for d, _ in steps[2]} == {d for d, (_, root) in groups.items() if d == root}
    packed = cp.STAGES[-1][1](spark, docs, sf).toPandas()
    assert packed.groupby("doc_id").length.sum().sum() > 0
    assert set(packed.doc_id) == {d for d, _ in steps[3]}
    assert len(cp.run(spark, sf).toPandas()) == len(packed)


@pytest.fixture(scope="module")
def odd_folder(spark, tmp_path_factory):
    """A folder whose labels call short texts good."""
    at = tmp_path_factory.mktemp("odd")
    rows = [(i, 1 if len(str(i)) < 3 else 0, 0) for i in range(400)] + [(None, 1, None), (3, None, None)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


@pytest.mark.parametrize("place", range(5))
def test_stages_take_odd_rows(spark, odd_folder, place):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns, and an empty table."""
    import corpus_pipeline as cp

    name, stage = cp.STAGES[place]
    clash = f"{SCHEMA}, _id long, _hash string, _doc string, _copies long, _digest string, n long"
    docs = spark.createDataFrame([(*r, 1, None, "x", 2, None, 3) for r in ROWS], clash)
    got = stage(spark, docs, odd_folder)
    if place < 4:
        assert got.columns == docs.columns
        texts = {r[1] for r in ROWS}
        rows = got.collect()
        if name in ("exact_dedup", "near_dedup"):
            assert {r["text"] for r in rows} <= texts and len(rows) > 3
        if name == "near_dedup":
            assert {r["doc_id"] for r in rows} >= {None, 3, 4, 5, 8} and not {6, 7} & {r["doc_id"] for r in rows}
    else:
        assert got.groupBy("sequence_id", "offset").count().filter("count > 1").count() == 0
    nothing = stage(spark, docs.limit(0), odd_folder)
    assert nothing.count() == 0 and (place == 4 or nothing.columns == docs.columns)
