"""Registered queries against their SQL, and the corpus pipeline's rows."""

import os

import pytest

from paytrail.llm.queries import SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data absent")


def test_queries_match_sql(spark):
    from checks.compare import compare
    report = compare(spark, SF, keys=sorted(SQL), verbose=False)
    assert all(r.get("hash_match") and r.get("columns_match") for r in report.values()), report


def test_pipeline_keeps_documents_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    out = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in docs.collect()}
    assert len({r.doc_id for r in out}) == len(out) and {r.doc_id for r in out} <= ids
    assert len(out) > 0.6 * len(ids)


def test_decontamination_with_null_and_repeated_ids(spark, tmp_path):
    import corpus_pipeline

    item = "tom wrote that the old bridge over the river was built by seven men in one cold winter long ago"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"so {item}"), (None, "clean one"), (None, "clean two"), (7, f"and {item}"), (7, "clean three"),
            (8, item), (9, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in docs.collect() if item not in (r.text or ""))


def test_pipeline_follows_the_mixture(spark, monkeypatch):
    import corpus_pipeline

    def rows():
        return [tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot", "mix_pos").collect()]

    first = rows()
    monkeypatch.setattr(corpus_pipeline.pfair, "tempered", lambda counts: {s: 1 + 9 * (s == min(counts)) for s in counts})
    second = rows()
    for got in (first, second):
        by = {}
        for _, shard, slot, place in got:
            by.setdefault(shard, []).append((slot, place))
        assert all([s for s, _ in sorted(v)] == list(range(len(v))) and sorted(v) == sorted(v, key=lambda x: x[1])
                   for v in by.values())
    assert {r[:2] for r in first} == {r[:2] for r in second}
    assert {r[:3] for r in first} != {r[:3] for r in second}


CLASHING = "_a int, _n int, _k int, _id int, _digest int, score int, evidence int, row int, digest int, place int, shard int"


def test_stages_keep_clashing_columns_and_every_row(spark, tmp_path):
    import corpus_pipeline
    from paytrail.llm import hilbert

    spark.createDataFrame([(1, "zz yy xx ww vv uu")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = [(i if i % 4 else None, f"text number {chr(97 + i % 26)} {chr(97 + i // 26)} of many words", "en", "s" if i % 3 else None, 9) for i in range(60)]
    rows += [(5, "another text of this id", "de", "s", 1), (5, None, None, None, None), (5, None, None, None, None)]
    docs = spark.createDataFrame([(*r, *range(11)) for r in rows],
                                 f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")
    sf, out = str(tmp_path), docs
    for name, stage in corpus_pipeline.STAGES:
        before = out
        out = stage(spark, out, sf)
        assert out.count() == len(rows), name
        assert set(docs.columns) <= set(out.columns), name
        same = [c for c in before.columns if name != "sharding" or c != "shard"]
        assert sorted(map(repr, out.select(same).collect())) == sorted(map(repr, before.select(same).collect())), name
    placed = hilbert.shard(out, ["lang", "doc_id"], within="mix_pos")
    hilbert.write_shards(out, placed, f"{tmp_path}/shards", "mix_pos")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == len(rows)
    assert sorted(r.mix_pos for r in back.collect()) == list(range(len(rows)))
