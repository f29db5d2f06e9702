import corpus_pipeline as P
from paylake.llm import decontamination, mixing, ngram_join, quality, secrets
from paylake.llm.common import table


def test_stages_follow_their_operators(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = [name for name, _ in P.STAGES]
    assert names == ["quality", "distinct", "decontaminated", "secrets", "mix"]
    before = {r["doc_id"]: r for r in docs.collect()}
    found = dict(P.STAGES)

    good = found["quality"](spark, docs, sf_dir)
    scores = quality.quality_scores(docs, table(spark, sf_dir, "labels")).where("predicted = 1")
    ids = {r["doc_id"] for r in good.collect()}
    assert good.columns == docs.columns and ids == {r["doc_id"] for r in scores.collect()}

    distinct = found["distinct"](spark, good, sf_dir)
    groups = {r["component_id"] for r in ngram_join.similar_groups(good).collect()}
    ids = {r["doc_id"] for r in distinct.collect()}
    assert distinct.columns == docs.columns and ids == groups

    benchmark = table(spark, sf_dir, "benchmark")
    clean = found["decontaminated"](spark, distinct, sf_dir)
    bad = {r["doc_id"] for r in decontamination.contamination(distinct, benchmark).where("contaminated").collect()}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == ids - bad and bad

    masked = found["secrets"](spark, clean, sf_dir)
    assert masked.columns == docs.columns
    secret = {r["doc_id"] for r in secrets.secrets(clean).where("n_secrets > 0").collect()}
    for r in masked.collect():
        assert (r["text"] != before[r["doc_id"]]["text"]) == (r["doc_id"] in secret)

    mixed = found["mix"](spark, masked, sf_dir)
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(masked).collect()))
    whole = P.run(spark, sf_dir)
    assert sorted(map(str, whole.collect())) == sorted(map(str, mixed.collect()))


def test_odd_rows_pass(spark, sf_dir, make_docs, odd):
    docs = make_docs([*odd, (1, "some text of no note"), (1, "some text of no note")])
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    assert P.STAGES[-1][1](spark, docs, sf_dir).columns[:3] == ["doc_id", "source", "size"]
    for _, stage in P.STAGES:
        assert stage(spark, make_docs([]), sf_dir).count() == 0
