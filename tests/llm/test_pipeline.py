import corpus_pipeline
from contract_lake.llm import quality, simhash
from contract_lake.llm import queries as q
from tests.llm.conftest import SCHEMA
from tests.llm.test_suffixes import slow
from tests.llm.test_tokens_packing import check_packing

SF = "/root/testdata/sf0.01"


def test_stages_against_their_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("extra", quality.F.lit("x"))
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before, out = kept, stage(spark, docs, SF)
        if name == "best_fit_packing":
            check_packing(out.collect(), list(before.items()), 2048)
            break
        assert out.columns == columns
        out = corpus_pipeline.written(out, f"test-{name}")
        rows = out.collect()
        assert len({r.doc_id for r in rows}) == len(rows)
        kept = {r.doc_id: r.text for r in rows}
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert all(i in kept for i, good in labels.items() if good and i in before)
            assert sum(i in kept for i, good in labels.items() if not good) <= 1
        elif name == "simhash_near_dedup":
            groups = simhash.near_duplicates(docs).collect()
            assert set(kept) == {r.component_id for r in groups}
        elif name == "suffix_dedup":
            expected = slow(list(before.values()), 200)
            removed = {i: n for i, (_, n, _, _) in zip(before, expected, strict=True)}
            assert set(kept) == set(before)
            assert all((kept[i] == before[i]) == (removed[i] == 0) for i in before)
        else:
            assert kept == before
        docs = out


def test_run_packs_what_the_stages_leave(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len({r.doc_id for r in rows}) < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_stages_on_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        docs = docs.select(*[c.split()[0] for c in SCHEMA.split(", ")][:5])
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, SF), f"test-{name}")
        assert "sequence_id" in docs.columns


def test_every_operator_has_its_query():
    import __spark_entry__ as entry
    assert [n for n in range(1, 11) if not any(x.startswith(f"op{n}_") for x in entry.queries())] == []
    assert "pipeline" in entry.queries() and set(q.queries()) <= set(entry.queries())


def test_sequences_take_turns_in_the_order_of_the_mix(spark):
    from pyspark.sql import functions as F

    from contract_lake.llm import mixing

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    order = [r.doc_id for r in mixing.mixed(docs).collect()]
    mixed = corpus_pipeline.written(mixing.mixed(docs), "test-mixed")
    place = {r.doc_id: r.p for r in mixed.select("doc_id", mixing.place().alias("p")).collect()}
    assert sorted(place, key=place.get) == order
    rows = dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, mixed, SF).collect()
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append(place[r.doc_id])
    assert all(r.turn == min(held[r.sequence_id]) for r in rows)
    # another mix, other turns
    other = corpus_pipeline.written(docs.orderBy(F.desc("doc_id")), "test-unmixed")
    turns = {r.doc_id: r.turn for r in dict(corpus_pipeline.STAGES)["best_fit_packing"](spark, other, SF).collect()}
    assert any(turns[r.doc_id] != r.turn for r in rows)
