import os

import pytest

import corpus_pipeline
from tickloom.llm import minhash
from tickloom.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "benchmark_decontamination", "source_mixing", "sharding"]
    assert all(s.columns == docs.columns for s in stages[:-1])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in (docs, *stages)]
    assert ids[0] > ids[1] > ids[2] >= ids[3] == ids[4] == ids[5]
    found = {r.doc_id for r in minhash.near_duplicates(stages[0]).filter("kept").collect()}
    assert ids[2] == found  # every class leaves one document
    assert stages[4].select("shard").distinct().count() > 1


def test_run_equals_stages(spark, stages):
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, run.collect())) == sorted(map(str, stages[-1].collect()))


def test_every_operator_has_a_query():
    names = set(queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(oracle_sql()) < names


def test_no_local_checkpoint():
    folder = os.path.dirname(corpus_pipeline.__file__)
    for top in ("tickloom/llm", ""):
        for name in os.listdir(os.path.join(folder, top)):
            if name.endswith(".py"):
                with open(os.path.join(folder, top, name)) as f:
                    assert "localCheckpoint(" not in f.read()


def folder_of(spark, path, docs, labels):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(1, "one two three four five six seven eight nine ten eleven"), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


ROWS = [(1, None), (2, ""), (None, "a b"), (None, None), (3, "copy of a text"), (4, "copy of a text"), (4, "copy of a text"),
        (5, "so one two three four five six seven eight nine ten it is"), (6, "word " * 20_000)]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(3, 1, 1), (4, 1, 1)], [(None, 1, 1), (5, None, None)]])
def test_toxicity_keeps_all_where_nothing_can_be_learned(spark, make, tmp_path, labels):
    path = folder_of(spark, str(tmp_path / "sf"), make(ROWS), labels)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, path).count() == len(ROWS)


def test_edge_rows_and_clashing_columns_pass_all_stages(spark, make, tmp_path):
    path = folder_of(spark, str(tmp_path / "sf"), make(ROWS, clash=True), [])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, path)
        if name != "sharding":
            assert docs.columns == before.columns
        docs.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    ids = sorted((r.doc_id for r in docs.select("doc_id").collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 3, 6, None, None]  # one of the copies, and not the benchmark's passage


def test_an_empty_table_passes_all_stages(spark, make, tmp_path):
    path = folder_of(spark, str(tmp_path / "sf"), make([]), [])
    assert corpus_pipeline.run(spark, path).collect() == []
