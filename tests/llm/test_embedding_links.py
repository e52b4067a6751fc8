"""Every link counts in one block only, whatever tiles and chunks its vectors come in."""

import numpy as np
import pytest

from domainpulse.llm import embedding_dedup as ed


def vectors(n=160, dims=64, seed=4):
    """Clusters of near vectors, many of them near the cosine limit, and some equal ones."""
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((8, dims))
    rows = [centres[i % 8] + rnd.standard_normal(dims) * rnd.choice([0.05, 0.15, 0.16, 0.17, 0.3]) for i in range(n)]
    return [tuple(map(float, r)) for r in rows] + [tuple(map(float, centres[0]))] * 40


def brute(rows, cosine):
    u = np.array(rows)
    u = u / np.linalg.norm(u, axis=1, keepdims=True)
    linked = (u @ u.T >= cosine) & ~np.eye(len(u), dtype=bool)
    reach = linked | np.eye(len(u), dtype=bool)
    while ((more := (reach.astype(int) @ reach.astype(int)) > 0) != reach).any():
        reach = more
    return {i: (int(linked[i].sum()), int(np.flatnonzero(reach[i])[0])) for i in range(len(u))}


@pytest.mark.parametrize("chunk,tile", [(4096, 1024), (7, 3), (16, 5)])
def test_links_do_not_hang_on_chunks_and_tiles(spark, monkeypatch, chunk, tile):
    monkeypatch.setattr(ed, "CHUNK", chunk)
    monkeypatch.setattr(ed, "TILE", tile)
    monkeypatch.setattr(ed, "PAIRS", 11)
    rows = vectors()
    df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ed.embedding_classes(df).collect()}
    assert got == brute(rows, ed.COSINE)


def test_the_first_block_of_a_pair_is_the_same_beside_any_other_rows():
    units = ed.unit(np.array(vectors()))
    whole = ed.turned(units)
    for size in (1, 2, 3, 17):
        parts = np.concatenate([ed.turned(units[i:i + size]) for i in range(0, len(units), size)])
        assert (parts == whole).all()
    left, right = np.triu_indices(len(units), 1)
    first = ed.first_blocks(whole[left], whole[right], ed.COSINE)
    swapped = ed.first_blocks(whole[right], whole[left], ed.COSINE)
    alone = [ed.first_blocks(whole[[i]], whole[[j]], ed.COSINE)[0] for i, j in zip(left[::97], right[::97])]
    assert (first == swapped).all() and (first[::97] == alone).all()
    linked = (units[left] * units[right]).sum(1) >= ed.COSINE
    assert (first[linked] < len(ed.blocks(64))).all()  # the pigeonhole: a link keeps some block's budget


def test_odd_vectors(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (None, [2.0, 0.0], "x"), (4, None, "x"), (5, [], "x"), (6, [0.0, 0.0], "x"),
         (7, [float("nan"), 1.0], "x"), (8, [1.0, None], "x"), (9, [1.0, 0.0, 0.0], "x"), (10, [1e300, 1e-300], "x")],
        "vec_id long, embedding array<double>, n_links string")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in ed.embedding_classes(df).collect())
    assert got == [(0, 3, 1, False), (1, 3, 1, True), (1, 3, 1, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True),
                   (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 3, 1, False)]
    assert ed.embedding_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("pays", [0, 1e9])
def test_links_over_rounds_of_meetings(spark, monkeypatch, pays):
    """One cell of all dimensions, and a grid; copies of the vectors in several rounds."""
    monkeypatch.setattr(ed, "PAYS", pays)
    monkeypatch.setattr(ed, "CHUNK", 7)
    monkeypatch.setattr(ed, "CHUNKS", 20)
    monkeypatch.setattr(ed, "ROUND_BYTES", 1)
    rounds, stored = [], ed.stored
    monkeypatch.setattr(ed, "stored", lambda df, name: (rounds.append(name), stored(df, name))[1])
    rows = vectors() + [(1.0, 0.0), (1.0, 0.01), (0.0, 1.0)]
    df = spark.createDataFrame([(i, list(v)) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in ed.embedding_classes(df).collect()}
    n = len(rows) - 3
    assert {k: got[k] for k in range(n)} == brute(rows[:n], ed.COSINE)
    assert [got[n + k] for k in range(3)] == [(1, n), (1, n), (0, n + 2)]
    assert rounds.count("vector-links") > 3 and ("vector-cells" in rounds) == (pays > 0)


def test_vectors_that_fill_all_dimensions_are_copied_once_a_chunk(spark, monkeypatch):
    """The copies of 102,564 vectors took 1.4 GB of disk in blocks of eight dimensions."""
    monkeypatch.setattr(ed, "CHUNK", 64)
    rnd = np.random.default_rng(9)
    rows = [(i, 1, list(map(float, rnd.standard_normal(64)))) for i in range(2000)]
    width, sizes, _ = ed._plan(spark.createDataFrame(rows, "node long, copies long, vector array<double>"), ed.COSINE)
    assert width is None and [(r["homes"], r["visits"], r["hs"]) for r in sizes.collect()] == [(2000, 0, ed.CHUNKS)]
    near = [(i, 1, list(map(float, c + rnd.standard_normal(64) * 0.01))) for i in range(2000) for c in [rows[i % 500][2]]]
    flat = [(i, 1, [*v[:3], *[1e-3 * x for x in v[3:]]]) for i, _, v in near]
    assert ed._plan(spark.createDataFrame(flat, "node long, copies long, vector array<double>"), 0.999)[0] is not None
