import zlib

import numpy as np

from paylake.llm import quality as Q
from paylake.llm.common import table


def test_held_out_accuracy(spark, sf_dir):
    d = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    rows = Q.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95


def test_fields_folds_and_odd_rows(spark, make_docs, odd, prose):
    good = [(i, prose(80, i).replace("w", "some ")) for i in range(60)]
    bad = [(i, " ".join([f"Buy{i}!!"] * 30)) for i in range(60, 100)]
    docs = make_docs(good + bad + odd + good[:2] + [(500, "long " * 300000)])
    labels = [(i, int(i < 60), None) for i in range(100)] + [(3, None, 0), (None, 1, 0), (7, 5, 0), (4, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == 100 + len(odd) + 3
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] is not None and r["doc_id"] < 100} == {i: int(i < 60) for i in range(100)}
    kept = Q.good_documents(docs, labels)
    assert kept.columns == docs.columns
    expected = sorted(str(r["doc_id"]) for r in got if r["predicted"])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == expected


def test_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert Q.quality_scores(make_docs([]), none).count() == 0
    assert Q.good_documents(make_docs([]), none).count() == 0
    assert [r["score"] for r in Q.quality_scores(make_docs([(1, "a"), (2, None)]), none).collect()] == [0.5, 0.5]


def test_scores_are_log_density_differences():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(5, 3))
    means = (np.zeros(3), np.ones(3))
    covariances = [np.diag([1.0, 2.0, 3.0]), np.eye(3) + 0.2]
    lower = [np.linalg.cholesky(c) for c in covariances]
    model = Q.Model(0.4, np.zeros(3), np.ones(3), means, tuple(map(np.linalg.inv, lower)),
                    tuple(float(np.log(np.diag(one)).sum()) for one in lower))

    def density(m, c):
        d = x - m
        return -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(c), d) - 0.5 * np.log(np.linalg.det(c))

    odds = np.log(0.4 / 0.6) + density(means[1], covariances[1]) - density(means[0], covariances[0])
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-odds)))
