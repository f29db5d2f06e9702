import random

import numpy as np
import pytest

from paylake.llm import token_counts as T


def written(tmp_path, files):
    paths = []
    for i, ids in enumerate(files):
        path = tmp_path / f"{i}.ids"
        path.write_bytes(np.array(ids, T.ID_TYPE).tobytes())
        paths.append(str(path))
    return paths


@pytest.mark.parametrize("block", [1, 2, 7, 64, 10**6])
def test_boundaries_of_blocks(spark, tmp_path, block):
    rng = random.Random(block)
    sep = 9
    files = [
        [rng.choice([1, 2, 3, sep]) for _ in range(200)], [1] * 50, [sep] * 20, [], [sep], [1, sep, *[2] * 100, sep, 3],
        [*[1] * 30, sep, *[2] * 64, sep, sep, *[3] * 7, sep],
    ]
    paths = written(tmp_path, files)
    expected = {}
    for path, ids in zip(paths, files, strict=True):
        lengths, n = [], 0
        for x in ids:
            lengths, n = ([*lengths, n], 0) if x == sep else (lengths, n + 1)
        expected |= {(path, i): c for i, c in enumerate([*lengths, n] if n else lengths)}
    frame = spark.createDataFrame([(p,) for p in [*paths, paths[0]]], "file string")
    got = {(r["file"], r["place"]): r["n_tokens"] for r in T.count_tokens(frame, sep, block).collect()}
    assert got == expected


def test_half_ids_are_refused(spark, tmp_path):
    (tmp_path / "x.ids").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole ids"):
        T.count_tokens(spark.createDataFrame([(str(tmp_path / "x.ids"),)], "file string")).collect()


def test_documents_round_trip(make_docs, odd, prose):
    rows = [*odd, (1, prose(500, 1)), (1, prose(500, 1)), (2, "<|endoftext|>"), (3, "a" * 100000), (4, " " * 5000 + "x")]
    got = sorted((str(r["doc_id"]), r["n_tokens"]) for r in T.document_tokens(make_docs(rows)).collect())
    assert got == sorted((str(i), len(T.token_ids(text))) for i, text in rows)
    assert T.document_tokens(make_docs([])).count() == 0
