"""The SQL of corpus queries, on the given table with planted copies and awkward vectors."""

import duckdb
import numpy as np
import pytest

from annolytics.llm import queries as Q


@pytest.mark.parametrize("planted", [False, True])
def test_embedding_dedup_equals_sql(spark, sf_dir, tmp_path, planted):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    if planted:
        rng = np.random.default_rng(5)
        top, size = max(r[0] for r in rows), len(rows[0][1])
        chain = [(v, label) for _, v, label in rows[:20] for _ in range(3)]
        near = [(np.add(v, rng.normal(0, 0.01, size) * np.linalg.norm(v) / 8).tolist(), label) for v, label in chain]
        odd = [(None, 1), ([0.0] * size, 1), ([float("nan")] * size, 1), (rows[0][1], None), (rows[0][1], rows[0][2]), (rows[0][1], rows[0][2] + 1)]
        rows += [(top + 1 + i, v, label) for i, (v, label) in enumerate(near + odd)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    base = duckdb.connect()
    base.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = base.execute(Q.oracle_sql()["op4_embedding_dedup"])
    names = [c[0] for c in want.description]
    got = Q.queries()["op4_embedding_dedup"](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(names)
    want = sorted(want.fetchall())
    assert sorted(map(tuple, got.select(*names).collect())) == want
    assert any(r[names.index("n_links")] for r in want) == planted
