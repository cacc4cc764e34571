"""The pipeline's stages on planted cases."""

import numpy as np
import pytest

import corpus_pipeline as p

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=220):
    r = np.random.default_rng(seed)
    syllables = "ka lo mi ne su ra ti vo pe da".split()
    return " ".join("".join(r.choice(syllables, r.integers(2, 5))) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    clean = [(i, prose(i)) for i in range(40)]
    near = prose(3).split()
    near[50] = "edited"
    passage = prose(777, 70)
    rows = clean + [(100, prose(5)), (101, " ".join(near)), (102, prose(60, 100) + " " + passage), (103, prose(61, 100) + " " + passage), (104, "!! ## " * 60), (105, "short"), (106, prose(62) + " " + prose(888, 30)), (107, None)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)] + [(104, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, prose(888, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, planted, tmp_path):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    columns = docs.columns
    left = {}
    for name, stage in p.STAGES:
        out = str(tmp_path / name.replace(" ", "-"))
        stage(spark, docs, planted).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "packing":
            assert docs.columns == columns
        left[name] = docs
    ids = {n: {r.doc_id for r in d.select("doc_id").collect()} for n, d in left.items()}
    assert not ids["quality rules"] & {104, 105, 107} and set(range(40)) <= ids["quality rules"]
    assert not ids["SimHash near-dedup"] & {100, 101} and set(range(40)) <= ids["SimHash near-dedup"]
    texts = {r.doc_id: r.text for r in left["substring dedup"].collect()}
    assert len(texts[102].split()) == 170 and len(texts[103].split()) == 100
    assert 106 not in ids["benchmark decontamination"] and set(range(40)) <= ids["benchmark decontamination"]
    assert ids["packing"] == ids["benchmark decontamination"]


def test_run_equals_stages(spark, planted):
    assert p.run(spark, planted).select("doc_id").distinct().count() == 42


def test_awkward_tables(spark, planted, tmp_path):
    """Further columns with operators' names, repeated rows, null ids and texts, and an empty table."""
    import datetime

    when = datetime.datetime(2024, 1, 2, 3, 4, 5, 123456)
    rows = [(i, prose(i), "en", "s", 1, when, {1: "a"}, i) for i in range(200, 206)]
    rows += [rows[0], (None, prose(300), "en", "s", 1, when, None, 9), (206, None, None, None, None, None, None, None), (207, "", "en", "s", 0, when, {}, 1)]
    rows = [(*r, 7, "x") for r in rows]
    docs = spark.createDataFrame(rows, SCHEMA + ", n_words timestamp, kept map<int,string>, item_id long, `a.b` int, _text_hash string")
    for name, df in (("rows", docs), ("none", docs.limit(0))):
        for i, (_, stage) in enumerate(p.STAGES):
            out = str(tmp_path / f"{name}{i}")
            columns = df.columns
            stage(spark, df, planted).write.parquet(out)
            df = spark.read.parquet(out)
            if i < len(p.STAGES) - 1:
                assert df.columns == columns
                if name == "rows":
                    got = df.collect()
                    assert sorted((r.doc_id or 0) for r in got) == ([0, 200, 200, 201, 202, 203, 204, 205] if i == 0 else [0, 200, 201, 202, 203, 204, 205])
                    assert {r.n_words for r in got} == {when} and {r.item_id for r in got} == {200, 201, 202, 203, 204, 205, 9}
        assert name == "rows" or df.count() == 0
