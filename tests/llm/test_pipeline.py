"""run() against the stages' decisions made apart from it."""

import corpus_pipeline
from corpusmill.llm import exact_dedup, mixing, neardup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    left = {r.doc_id: r for r in docs.collect()}
    toxic = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    left = {i: r for i, r in left.items() if i not in toxic}
    groups = {}
    for r in left.values():
        groups.setdefault(exact_dedup.normalise(r.text.encode()), []).append(r)
    left = {r.doc_id: r for r in (min(g, key=lambda r: (-len(r.text), r.doc_id)) for g in groups.values())}
    sets = {i: neardup.shingles(r.text.encode()) for i, r in left.items()}
    comp = {i: i for i in left}
    for _ in range(len(left)):
        moved = False
        for a in left:
            for b in left:
                if a < b and comp[a] != comp[b] and neardup.linked(len(sets[a] & sets[b]), len(sets[a]), len(sets[b])):
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    moved = True
        if not moved:
            break
    left = {i: r for i, r in left.items() if comp[i] == i}
    kept = spark.createDataFrame(list(left.values()), docs.schema)
    sampled = {r.doc_id for r in mixing.mix(kept).where("sampled").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == sampled and len(got) == len(sampled)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_stage_contract(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("fp", corpus_pipeline.neardup.F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert tuple(out.columns) == corpus_pipeline.COLUMNS
        assert stage(spark, docs.limit(0), SF).count() == 0
