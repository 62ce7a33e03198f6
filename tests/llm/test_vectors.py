import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import DATA, cosine_links
from pyspark.sql import functions as F

from ledgerloom.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, vec string, side string, n_links string"


def table(llm, rows):
    return llm.createDataFrame([(i, v, None, None, "x", None, "y") for i, v in rows], SCHEMA)


def groups(rng, sizes, dimensions=32, noise=0.02):
    out = []
    for size in sizes:
        centre = rng.normal(size=dimensions)
        out += [(centre + rng.normal(size=dimensions) * noise * rng.integers(0, 9)).astype(np.float32).tolist() for _ in range(size)]
    return list(enumerate(out))


def check(rows, got):
    degree, component = cosine_links({i: np.array(v, dtype=np.float32).astype(float) if v is not None and None not in v else v for i, v in rows})
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_links"], r["component_id"], r["kept"]) == (degree[r["vec_id"]], component[r["vec_id"]], component[r["vec_id"]] == r["vec_id"])


def run(llm, rows, **options):
    return [r.asDict() for r in vectors.link_vectors(table(llm, rows), **options).collect()]


def test_one_cell_is_exact_in_any_blocks(llm):
    rows = groups(np.random.default_rng(1), [1] * 60 + [2] * 20 + [7, 40, 90])
    check(rows, run(llm, rows))
    check(rows, run(llm, rows, block=16, visitor_block=16))


def test_odd_vectors(llm):
    rows = groups(np.random.default_rng(2), [5, 3])
    width = len(rows[0][1])
    rows += [(100, None), (101, []), (102, [0.0] * width), (103, [float("nan")] + [1.0] * (width - 1)), (104, [float("inf")] * width), (105, [None] + [1.0] * (width - 1)), (106, [1.0, 2.0])]
    rows += [(107, [1e-30 * x for x in rows[0][1]]), (108, [1e25 * x for x in rows[0][1]])]
    got = run(llm, rows)
    check([(i, np.float32(v).tolist() if v and None not in v else v) for i, v in rows], got)
    repeated = run(llm, rows[:5] + rows[:1] + [(None, rows[0][1])])
    assert len(repeated) == 7 and [(r["component_id"], r["kept"]) for r in repeated if r["vec_id"] is None] == [(None, False)]
    assert run(llm, []) == [] and run(llm, [(1, None)]) == [{"vec_id": 1, "n_links": 0, "component_id": 1, "kept": True}]


def test_many_cells_reach_the_recall(llm):
    """Pairs from the threshold up, in 24 cells, against brute force; none below the threshold is reported."""
    rng = np.random.default_rng(3)
    rows = groups(rng, [1] * 500 + [2] * 300 + [150], 48, 0.05)
    degree, _ = cosine_links({i: np.array(v, dtype=np.float32).astype(float) for i, v in rows})
    got = {r["vec_id"]: r["n_links"] for r in run(llm, rows, cell_rows=50)}
    assert all(got[i] <= degree[i] for i in got)
    assert sum(got.values()) >= 0.98 * sum(degree.values()) > 0
    pairs = [i for i in got if degree[i] == 1]
    assert sum(got[i] for i in pairs) >= 0.95 * len(pairs)


def test_vectors_of_few_directions_lose_no_link_in_hundreds_of_cells(llm):
    """Pairs just above the threshold in 16 directions of 384, as real embeddings lie."""
    rng = np.random.default_rng(6)
    basis = np.linalg.qr(rng.normal(size=(384, 16)))[0].T
    x = rng.normal(size=(500, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    n = rng.normal(size=x.shape)
    n -= np.einsum("ij,ij->i", n, x)[:, None] * x
    n /= np.linalg.norm(n, axis=1)[:, None]
    y = 0.901 * x + np.sqrt(1 - 0.901**2) * n
    rows = list(enumerate((np.concatenate((x, y)) @ basis).astype(np.float32).tolist()))
    check(rows, run(llm, rows, cell_rows=5))


def test_centres_are_unit_and_repeatable():
    rows = vectors.unit_rows(np.random.default_rng(4).normal(size=(300, 8)).tolist() + [[1.0] + [0.0] * 7] * 50)
    one, two = vectors.spherical_kmeans(rows, 12), vectors.spherical_kmeans(rows, 12)
    assert np.array_equal(one, two) and np.allclose(np.linalg.norm(one, axis=1), 1)


def test_representatives(llm):
    rows = groups(np.random.default_rng(5), [4, 1, 3], noise=0.001) + [(50, None)]
    kept = vectors.representatives(table(llm, rows))
    assert kept.columns == table(llm, rows).columns and sorted(r["vec_id"] for r in kept.collect()) == [0, 4, 5, 50]


def test_query(ask):
    data = pq.read_table(DATA / "embeddings.parquet").to_pandas()
    check(list(zip(data.vec_id, data.embedding)), ask("op9_embedding_dedup").to_dict("records"))


@pytest.mark.parametrize("kind", ["array<double>", "array<int>"])
def test_other_element_types(llm, kind):
    rows = table(llm, [(1, [1.0, 2.0]), (2, [2.0, 4.0])]).withColumn("embedding", F.col("embedding").cast(kind))
    assert [r["n_links"] for r in vectors.link_vectors(rows).collect()] == [1, 1]
