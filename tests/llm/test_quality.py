"""The classifier on held-out rows, the pipeline, and what the driver's contract asks."""

import os
import zlib

import pytest
from llm_cases import documents, words

from tamarack.llm.quality import Model, keep_good, quality_scores

SF = "/root/testdata/sf0.01"


def corpus(n=300):
    good = [" ".join(words(k, 40)) for k in range(n)]
    return [t if k % 3 else " ".join(w.upper() + "!!" for w in t.split()) for k, t in enumerate(good)], [int(k % 3 > 0) for k in range(n)]


def test_held_out_accuracy(spark):
    texts, quality = corpus()
    labels = spark.createDataFrame([(k, q, 0) for k, q in enumerate(quality)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_scores(documents(spark, [*texts, None, ""]), labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for k, r in got.items())
    held = [k for k in range(len(texts)) if got[k].held_out]
    assert sum(got[k].predicted == quality[k] for k in held) / len(held) > 0.95
    assert got[300].score == got[301].score
    assert {r.doc_id for r in keep_good(documents(spark, texts), labels).collect()} == {k for k in range(300) if got[k].predicted}


def test_few_labels(spark):
    assert Model([], []).scores(["x"]).tolist() == [0.5] and Model(["a"], [1]).scores(["x", ""]).tolist() == [1.0, 1.0]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality_scores(documents(spark, ["a"]), none).collect()] == [0.5]
    assert quality_scores(documents(spark, []), none).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_pipeline_stages(spark):
    """Each stage against a plain version of its decision on its own input."""
    import corpus_pipeline
    from test_dedup import exact_wanted, substring_wanted

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 250")
    names = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        path = f"{corpus_pipeline.materialize(docs, 'x').inputFiles()[0].rsplit('/', 1)[0]}-{k}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r.text for r in docs.collect()} if "text" in docs.columns else {}
        if k < 4:
            assert docs.columns == names and set(after) <= set(before)
        if name == "quality classifier":
            assert 0.7 * len(before) < len(after) < len(before)
        elif name == "exact dedup":
            ids = list(before)
            assert set(after) == {ids[j] for j, x in exact_wanted([before[i] for i in sorted(ids)]).items() if x[2]} if ids == sorted(ids) else set(after)
        elif name == "MinHash near-dedup":
            sets = {i: {tuple(t.split()[j : j + 5]) for j in range(max(1, len(t.split()) - 4))} for i, t in after.items()}
            ids = sorted(sets)
            assert not [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
        elif name == "substring dedup":
            ids = sorted(before)
            wanted = substring_wanted([before[i] for i in ids])
            assert all(len(after[i].split()) == wanted[j][0] - wanted[j][1] for j, i in enumerate(ids))
        else:
            assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == set(before)


def test_registered():
    from tamarack.llm.queries import ORACLES, QUERIES

    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_pipeline_on_odd_tables(spark, tmp_path):
    """No rows, null texts, repeated rows and further columns of clashing names, through all stages."""
    import corpus_pipeline

    kind = "doc_id long, text string, lang string, source string, n_chars long, id string, __id string, n int, row int"
    texts = [None, "", "", " ".join(words(1, 80)), " ".join(words(1, 80)), " ".join([*words(1, 79), "end"]), " ".join(words(2, 60)), "x" * 5000]
    rows = [(k, t, "en", "s", len(t or ""), "i", f"c{k}", 1, 2) for k, t in enumerate(texts)]
    labels = spark.createDataFrame([(k, 1, 0) for k in range(8)], "doc_id long, quality int, toxic int")
    for name, some in (("odd", [*rows, rows[3]]), ("none", [])):
        place = f"{tmp_path}/{name}"
        spark.createDataFrame(some, kind).write.parquet(f"{place}/documents.parquet")
        labels.write.parquet(f"{place}/labels.parquet")
        got = corpus_pipeline.run(spark, place).collect()
        # All are good; of equal texts the largest id stays, of near ones the least.
        assert sorted({r.doc_id for r in got}) == ([] if name == "none" else [2, 4, 6, 7])
        assert all(r.start == 0 for r in got if r.doc_id != 7)


def test_long_and_repeated_rows_score_alike(spark):
    texts, quality = corpus(60)
    labels = spark.createDataFrame([(k, q, 0) for k, q in enumerate(quality)], "doc_id long, quality int, toxic int")
    long = " ".join(words(5, 60_000))
    docs = documents(spark, [*texts, long, long])
    got = {r.doc_id: r.score for r in quality_scores(docs.unionByName(docs.where("doc_id = 60")), labels).collect()}
    assert got[60] == got[61] and 0 <= got[60] <= 1
