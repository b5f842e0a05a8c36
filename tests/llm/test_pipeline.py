"""The pipeline on a small corpus of planted cases, stage by stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from civitas.llm.common import stored


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = prose(30)
    rows = [(i, prose(80)) for i in range(150)]
    rows += [(150 + i, " ".join(w.upper() + "!!" for w in prose(60).split())) for i in range(60)]
    rows += [(300, rows[3][1].replace(" ", "  ")), (301, rows[4][1] + " tail"), (302, prose(20) + " " + item + " " + prose(20)), (303, None), (304, ""), (5, rows[5][1])]
    d = str(tmp_path_factory.mktemp("sf"))
    cols = lambda df: df.select("*", F.lit("en").alias("lang"), F.lit("src0").alias("source"), F.char_length("text").cast("long").alias("n_chars"))
    cols(spark.createDataFrame(rows, "doc_id long, text string")).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 150), 0) for i in range(210)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids, columns = {}, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(spark, stage(spark, docs, folder), str(tmp_path), f"s{i}")
        ids[name] = sorted(r[0] for r in docs.select("doc_id").collect())
        assert name == "packing" or docs.columns == columns
    good = set(range(150)) | {300, 301, 302}
    assert good <= set(ids["quality"]) and not set(range(150, 210)) & set(ids["quality"])
    assert 3 not in ids["exact copies"] and 300 in ids["exact copies"] and ids["exact copies"].count(5) == 1
    assert 4 in ids["near copies"] and 301 not in ids["near copies"] and 302 in ids["near copies"]
    assert 302 not in ids["decontamination"] and (good - {3, 301, 302}) <= set(ids["decontamination"])
    assert set(ids["packing"]) == set(ids["decontamination"])


def test_run_and_empty_table(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 100
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


def test_null_and_repeated_ids_keep_their_own_verdicts(spark, folder, tmp_path):
    rng = random.Random(9)
    prose = lambda: " ".join("".join(rng.choice("abcdefghijkl") for _ in range(6)) for _ in range(40))
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    a, b, c, d, e, f = (prose() for _ in range(6))
    leaky, bare = f"{prose()} {item}", prose()
    rows = [(None, a), (None, b), (None, a), (7, c), (7, d), (1, c), (7, d + " x"), (8, e), (8, leaky), (None, leaky + " y"), (9, f), (9, f), (9, bare.replace(" ", "", 1)), (9, bare)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    texts = []
    for i, stage in enumerate((corpus_pipeline.exact_copies, corpus_pipeline.near_copies, corpus_pipeline.decontaminated)):
        docs = stored(spark, stage(spark, docs, folder), str(tmp_path), f"n{i}")
        texts.append(sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr))
    exact = [(None, a), (None, b), (1, c), (7, d), (7, d + " x"), (8, e), (8, leaky), (None, leaky + " y"), (9, f), (9, bare)]
    assert texts[0] == sorted(exact, key=repr)
    near = [x for x in texts[1] if x not in ((7, d), (7, d + " x"))]
    assert near == sorted([(None, a), (None, b), (1, c), (8, e), (None, leaky + " y"), (9, f), (9, bare)], key=repr) and len(texts[1]) == len(near) + 1
    assert texts[2] == [x for x in texts[1] if x[1] != leaky + " y"]
    assert {r.doc_id for r in corpus_pipeline.packed(spark, docs, folder).collect()} == {x[0] for x in texts[2]}
