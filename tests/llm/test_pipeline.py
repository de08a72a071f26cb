"""The pipeline's stages, one after another, and on awkward input."""

from collections import defaultdict

from pyspark.sql import functions as F
from test_scores import plain_toxicity
from test_training_data import brute_components, brute_contamination, brute_ranges, texts

import corpus_pipeline
from fieldseries.llm import suffix_dedup, toxicity
from fieldseries.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_the_run_packs_what_is_left(spark):
    docs = table(spark, SF, "documents")
    left = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == docs.columns
        left = spark.createDataFrame(out.collect(), docs.schema)
        assert left.count() > 0
    ids = {r.doc_id for r in left.collect()}
    packed = corpus_pipeline.run(spark, SF).toPandas()
    assert set(packed.doc_id) == ids
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_each_stage_against_brute_force(spark):
    """On what its predecessor kept: rows that stay, and the texts that they stay with."""
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    model = toxicity.train(docs, table(spark, SF, "labels"))
    clean = {k for k, r in rows.items() if toxicity.score(model, plain_toxicity(model, r.text or ""), len(r.text or "")) < 0.3}
    left = spark.createDataFrame(stages["toxicity"](spark, docs, SF).collect(), docs.schema)
    assert {r.doc_id for r in left.collect()} == clean

    items = texts(left)
    sets, root = brute_components(items, 5, 80)
    groups = defaultdict(list)
    for i, ((k, _), r, s) in enumerate(zip(items, root, sets, strict=True)):
        groups[r if s else ("none", i)].append(k)
    left = spark.createDataFrame(stages["ngram_join"](spark, left, SF).collect(), docs.schema)
    assert {r.doc_id for r in left.collect()} == {min(g) for g in groups.values()}

    items = texts(left)
    cut = {}
    for (k, t), spans in zip(items, brute_ranges(items), strict=True):
        raw = (t or "").encode()
        cut[k] = None if t is None else suffix_dedup.kept(raw, [suffix_dedup.whole_characters(raw, a, b) for a, b in spans]).decode()
    left = spark.createDataFrame(stages["suffix_dedup"](spark, left, SF).collect(), docs.schema)
    assert dict(texts(left)) == cut

    bench = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    stay = {x[0] for x in brute_contamination(texts(left), bench) if not x[-1]}
    left = spark.createDataFrame(stages["decontamination"](spark, left, SF).collect(), docs.schema)
    assert {r.doc_id for r in left.collect()} == stay
    packed = stages["packing"](spark, left, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == stay


def test_further_columns_of_any_type(spark):
    """Maps, which have no order, and names that the operators use themselves."""
    docs = table(spark, SF, "documents").limit(60)
    more = docs.withColumns({"row": F.create_map(F.lit("a"), F.col("doc_id")), "id": F.lit(1), "number": F.lit("x"), "cls": F.array(F.lit(2)), "a b:c": F.lit(3), "none": F.lit(True)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SF)
        assert out.columns == more.columns, name
        assert all(r["row"] == {"a": r.doc_id} and r["a b:c"] == 3 for r in out.collect()), name


def test_an_empty_table_passes_through(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_toxic_documents_go(spark):
    docs = table(spark, SF, "documents").limit(3)
    bad = spark.createDataFrame([(10**6, "You idiot, you stupid worthless moron.", "en", "s", 1), (10**6, None, None, None, None)], docs.schema)
    kept = corpus_pipeline.STAGES[0][1](spark, docs.unionByName(bad), SF)
    assert [r.text for r in kept.filter("doc_id = 1000000").collect()] == [None]
