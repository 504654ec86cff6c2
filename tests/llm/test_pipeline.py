import re

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_ngram_join import sets_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's rows, each stage reading what the one before wrote."""
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {"documents": docs.toPandas()}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        found[name] = docs.toPandas()
    return found


def test_columns_and_order(stages):
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "secrets", "mix", "packing"]
    for name in names[:-1]:
        assert list(stages[name].columns) == list(stages["documents"].columns)


def test_quality_keeps_good_and_drops_bad(stages, spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = set(stages["quality"].doc_id)
    known = stages["documents"].doc_id[stages["documents"].doc_id.isin(labels.index)]
    right = [(d in kept) == (labels[d] == 1) for d in known]
    assert sum(right) >= 0.97 * len(right)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["quality"], stages["near_duplicates"]
    sets = sets_of(zip(before.doc_id, before.text), 5)
    assert after.doc_id.is_unique and set(after.doc_id) <= set(before.doc_id)
    kept = sorted(after.doc_id)
    for at, a in enumerate(kept):
        for b in kept[at + 1 :]:
            assert 5 * len(sets[a] & sets[b]) < 4 * len(sets[a] | sets[b]) or not sets[a]
    for gone in set(before.doc_id) - set(kept):  # it had a link to an earlier or kept document
        assert any(5 * len(sets[gone] & s) >= 4 * len(sets[gone] | s) for d, s in sets.items() if d != gone)


def test_secrets_go_and_documents_stay(stages):
    before, after = (stages[n].set_index("doc_id").text for n in ("near_duplicates", "secrets"))
    assert sorted(before.index) == sorted(after.index)
    for doc_id, text in after.items():
        assert not re.search(r"[0-9a-f]{24,}", text)
        assert text == before[doc_id] or "[REDACTED]" in text


def test_mix_follows_targets_and_packing_takes_all(stages):
    from cohortlift.llm.source_mix import target_sizes

    before, after = stages["secrets"], stages["mix"]
    words = before.assign(n=before.text.str.split().map(len)).groupby("source").n.sum()
    targets = target_sizes(words.tolist(), [(5, 2, 1)[i % 3] for i in range(len(words))])
    taken = after.assign(n=after.text.str.split().map(len)).groupby("source").n.sum().reindex(words.index).fillna(0)
    assert abs(taken.sum() - words.sum()) < 0.1 * words.sum()
    for (_, got), want in zip(taken.items(), targets):
        assert abs(got - want) <= 0.35 * want + 50
    assert after.doc_id.value_counts().max() <= 3
    packed = stages["packing"]
    assert (packed.piece == 0).sum() == len(after)
    assert packed.groupby("sequence_id").length.sum().max() <= 4096
    assert packed.sequence_id.nunique() <= 1.02 * packed.length.sum() / 4096 + 1


def test_rows_not_ids_are_documents(spark):
    text, other = "a b c d e f g h i j", "k l m n o p q r s t u v"
    rows = [(1, text), (1, other), (2, text), (3, "z y x w v"), (3, "z y x w v"), (4, ""), (4, ""), (5, None), (None, text), (6, other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "7 as score", "8 as key", "9 as mark", "'q' as asked", "1 as _bucket", "'n' as node")
    kept = pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert len([r for r in got if r[1] == text and r[0] is not None]) == 1  # one of two copies, though its id has another text
    assert len([r for r in got if r[1] == other]) == 1 and got.count((3, "z y x w v")) == 1
    assert got.count((4, "")) == 2 and (5, None) in got and (None, text) in got and len(got) == 7
    assert {tuple(r)[2:] for r in kept.collect()} == {(7, 8, 9, "q", 1, "n")}
    assert pipeline.near_duplicates(spark, docs.limit(0), SF).count() == 0


def test_scores_of_the_input_are_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("*", "-1.5 as score", "'s' as _score")
    kept = pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and {(float(r.score), r._score) for r in kept.select("score", "_score").collect()} == {(-1.5, "s")}


def test_large_classes_are_dealt_and_stay_whole(spark, monkeypatch):
    from cohortlift.llm import ngram_join

    monkeypatch.setattr(ngram_join, "LARGE_CLASS", 3)
    rows = [(i, "one two three four five six") for i in range(40)] + [(100 + i, f"w{i} x{i} y{i} z{i} v{i}") for i in range(9)]
    rows += [(200, "one two three four five six seven"), (300, ""), (301, None)]
    found = {r.doc_id: r for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 3, 4).collect()}
    assert len(found) == len(rows) and {found[i].class_id for i in range(40)} == {0}
    assert {found[i].component_id for i in (*range(40), 200)} == {0} and found[200].class_id == 200
    assert all(found[i].component_id == i for i in (*range(100, 109), 300, 301))


def test_batches_are_bounded_by_bytes(spark, monkeypatch):
    import pyarrow as pa

    from cohortlift.llm import ngram_join
    from cohortlift.llm.staging import BATCH_BYTES

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"size": [batch.nbytes]})

    def largest(docs, *_):
        return max(r.size for r in docs.mapInArrow(sizes, "size long").collect())

    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(300, numPartitions=1).selectExpr("id as doc_id", "repeat(concat('w', id, ' '), 20000) as text")
    spark.conf.unset(setting)
    assert largest(docs) > 5 * BATCH_BYTES
    monkeypatch.setattr(ngram_join, "_components", largest)
    assert ngram_join.jaccard_components(docs) <= BATCH_BYTES + 200_000  # one row more than the bound
    assert spark.conf.get(setting, None) is None
    for _, stage in pipeline.STAGES[2:]:
        spark.conf.unset(setting)
        stage(spark, docs.selectExpr("*", "'s' as source"), SF)
        assert largest(docs) <= BATCH_BYTES + 200_000
    spark.conf.set(setting, "1000000")
    pipeline.secrets(spark, docs, SF)
    assert largest(docs) <= 1_200_000
    spark.conf.unset(setting)


def test_scores_do_not_depend_on_slices(spark, documents):
    import numpy as np
    import pyarrow as pa

    from cohortlift.llm import quality_mil
    from cohortlift.llm.words import text_slices

    texts = ["", None, "One two. Three!", "w " * 300, "ä b\nc"] * 3
    whole = [quality_mil.encode_passages(t)[0] for t in text_slices(pa.array(texts))]
    rows = [quality_mil.encode_passages(t)[0] for t in text_slices(pa.array(texts), 1)]
    assert np.array_equal(np.concatenate(whole), np.concatenate(rows))
