"""Embedding near-dedup by a subspace pigeonhole join.

Vectors are scaled to length 1, so cosine >= c means a squared distance of at
most 2 - 2c.  A fixed random rotation spreads that distance evenly, and the
rotated vector is split into blocks.  If a pair is within the whole budget,
then in at least one block it is within that block's share of the budget,
in proportion to the block's dimensions.  So

1. equal vectors are collapsed to one row with a count (partial aggregation:
   a vector that a third of all rows share costs one row per task);
2. blocks are as wide as lets the fewest pairs meet, counted on the vectors
   themselves, from ``BLOCK`` dimensions up; where no grid spares at least half
   of all pairs (vectors that fill all their dimensions), the one block of all
   dimensions is one cell;
3. in every block, a range join: the first ``GRID`` dimensions of the block
   lie in a grid of cells twice as wide as the block's radius, each vector
   is at home in one cell and visits the neighbouring cells that its radius
   reaches and that come before its own in order, so each pair meets in one
   cell;
4. cells are split into pairs of chunks, each joined in a task of its own; a
   task computes block distances in single precision with room for rounding
   (of wide blocks, over the first ``HEAD`` dimensions), takes the pairs within
   the block's budget as candidates and checks each one's cosine in double
   precision.  A link counts in the first block whose budget it keeps, by
   sums over the pair's own numbers in a fixed order: they come out alike in
   every task, so each link counts exactly once.  A vector goes to as many
   tasks as its cell has chunks, so chunks grow with the table up to what fits
   a task, and pairs of chunks are joined in rounds, of which one at a time has
   its copies on disk;
5. a task returns counts per vector and a spanning set of its links, never
   pairs; components come from the links.

Defined results: a vector that is null, empty, zero, or holds null or
non-finite components links with nothing and is its own component; vectors
of different lengths do not link; equal vectors link; a null id takes part
and its component_id is the smallest id reachable (null if none), kept is
then false; repeated rows count as separate vectors; an empty table gives
no rows; input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import bytes_in_files, small, stored
from domainpulse.llm.components import Sets, components

COSINE = 0.95
#: Least dimensions per block, gridded dimensions of a block, least rows per chunk, rows per tile of a task.
BLOCK, GRID, CHUNK, TILE = 8, 3, 4096, 512
#: A grid is used if at most this share of all pairs meets in it.
PAYS = 0.5
#: Chunks that a table of any size is split into, and the most numbers in a chunk.
CHUNKS, NUMBERS = 8, 1 << 22
#: Bytes of vectors' copies in a round, at least, and as a multiple of the table's files.
ROUND_BYTES, ROUND_TABLES = 256 << 20, 2
#: Dimensions of a block that candidates are looked for by, and room for rounding in single precision.
HEAD, ROUGH = 24, 1e-5
SEED = 17
#: Room for rounding in candidate search; the cosine itself is checked exactly.
SLACK = 1e-9
#: Pairs whose first block is looked for at a time.
PAIRS = 1 << 15


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by the largest component, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def turned(units: np.ndarray) -> np.ndarray:
    """Rotated rows.  Each row's sums run over its own numbers in a fixed order, whatever other rows are with it."""
    return np.einsum("ij,jk->ik", units, rotation(units.shape[1]))


def first_blocks(u: np.ndarray, v: np.ndarray, cosine: float, width: int | None = None) -> np.ndarray:
    """For each pair of rotated rows, the first block within its budget (the number of blocks if there is none)."""
    dims = u.shape[1]
    apart = (u - v) ** 2
    within = np.stack([np.einsum("ij->i", apart[:, p]) <= budget(p, dims, cosine) for p in blocks(dims, width)] + [np.ones(len(u), bool)])
    return within.argmax(axis=0)


def blocks(dims: int, width: int | None = None) -> list[slice]:
    width = width or BLOCK
    return [slice(i, min(i + width, dims)) for i in range(0, dims, width)]


def widths(dims: int) -> list[int]:
    """Widths of blocks to choose from, up to one block of all dimensions."""
    out = [BLOCK]
    while out[-1] < dims:
        out.append(2 * out[-1])
    return out


def budget(part: slice, dims: int, cosine: float) -> float:
    return (2 - 2 * cosine) * (part.stop - part.start) / dims + SLACK


def _placed(units: np.ndarray, cosine: float, width: int) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """(block, home, rows, cells) of the cells that rotated rows are at home in or visit."""
    for b, part in enumerate(blocks(units.shape[1], width)):
        radius = np.sqrt(budget(part, units.shape[1], cosine))
        grid = min(GRID, part.stop - part.start)
        at = units[:, part.start:part.start + grid] / (2 * radius)
        cell = np.floor(at).astype(np.int64)
        # with cells two radii wide, one neighbour per dimension is in reach; exactly on
        # the middle either would do, so both sides count as reached
        offset = at - cell
        for step in product((-1, 0, 1), repeat=grid):
            home = not any(step)
            # only cells before the own one are visited
            if not home and next(s for s in step if s) > 0:
                continue
            reach = np.ones(len(at), dtype=bool)
            for g, s in enumerate(step):
                if s:
                    reach &= offset[:, g] <= 0.5 + SLACK if s < 0 else offset[:, g] >= 0.5 - SLACK
            if reach.any():
                # coordinates of at most 1 and radii above sqrt(SLACK) / 9 leave 21 bits a dimension
                name = ((cell[reach] + np.array(step) + (1 << 20)) << (21 * np.arange(grid))).sum(axis=1)
                yield b, home, np.flatnonzero(reach), name


def _by_length(rows: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    for dims, same in rows.groupby(rows["vector"].map(len)):
        yield int(dims), same, turned(unit(np.stack(same["vector"].to_numpy()).astype(np.float64)))


def _cells(cosine: float, width: int):
    """(dims, block, cell, home, node) of every cell that a vector is at home in or visits."""

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, same, units in _by_length(batch):
                node = same["node"].to_numpy()
                for b, home, rows, name in _placed(units, cosine, width):
                    yield pd.DataFrame({"dims": dims, "block": b, "cell": name, "home": home, "node": node[rows]})

    return cells


def _cell_counts(cosine: float):
    """(width, dims, block, cell, homes, visits) of the cells at every width of blocks, counted batch by batch."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, _, units in _by_length(batch):
                for width in widths(dims):
                    for b, home, _, name in _placed(units, cosine, width):
                        cell, n = np.unique(name, return_counts=True)
                        yield pd.DataFrame({
                            "width": width, "dims": dims, "block": b, "cell": cell, "homes": n * home, "visits": n * (not home)})

    return count


def _rough(units: np.ndarray, part: slice, sign: int) -> np.ndarray:
    """The first dimensions of a block in single precision, so that products are minus half the squared distances."""
    head = units[:, part][:, :HEAD]
    half, one = (head * head).sum(axis=1, keepdims=True) / -2, np.ones((len(head), 1))
    return np.hstack([head, half, one] if sign > 0 else [head, one, half]).astype(np.float32)


def _join_chunks(cosine: float, width: int | None):
    """Counts and spanning links of one pair of chunks of one cell.  ``width``: of blocks, None for one block."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        dims, block = int(rows["dims"].iloc[0]), int(rows["block"].iloc[0])
        within = bool(rows["within"].iloc[0])
        left = rows[rows["side"] == 0].sort_values("node")
        right = left if within else rows[rows["side"] == 1].sort_values("node")
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        part = blocks(dims, width or dims)[block]
        x = unit(np.stack(left["vector"].to_numpy()).astype(np.float64))
        y = x if within else unit(np.stack(right["vector"].to_numpy()).astype(np.float64))
        rough_x = _rough(x @ rotation(dims), part, 1)
        rough_y = _rough((x if within else y) @ rotation(dims), part, -1)
        least = np.float32(-budget(part, dims, cosine) / 2 - ROUGH)  # the pairs that stay are measured again
        wx, wy = left["copies"].to_numpy(), right["copies"].to_numpy()
        nx, ny = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        sets = Sets(len(x) + (0 if within else len(y)))
        base = 0 if within else len(x)

        def links(us: np.ndarray, vs: np.ndarray) -> np.ndarray:
            """Which pairs are links of this block."""
            found = np.einsum("ij,ij->i", x[us], y[vs]) >= cosine
            if found.any():
                u, v = us[found], vs[found]
                found[found] = first_blocks(turned(x[u]), turned(y[v]), cosine, width or dims) == block
            return found

        def count(us: np.ndarray, vs: np.ndarray) -> None:
            for k in range(0, len(us), PAIRS):
                u, v = us[k:k + PAIRS], vs[k:k + PAIRS]
                own = links(u, v)
                u, v = u[own], v[own]
                np.add.at(nx, u, wy[v])
                np.add.at(ny, v, wx[u])
                for one, other in zip(u.tolist(), v.tolist()):
                    sets.join(one, base + other)

        pending: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for i in range(0, len(x), TILE):
            for j in range(i if within else 0, len(y), TILE):
                found = rough_x[i:i + TILE] @ rough_y[j:j + TILE].T >= least
                if within and i == j:
                    found = np.triu(found, 1)
                at = np.flatnonzero(found.ravel())  # far faster than places in two dimensions
                if len(at):
                    us, vs = np.divmod(at, found.shape[1])
                    pending.append((us + i, vs + j))
                    waiting += len(us)
                if waiting >= PAIRS:
                    count(*map(np.concatenate, zip(*pending)))
                    pending, waiting = [], 0
        if pending:
            count(*map(np.concatenate, zip(*pending)))
        if within:
            nx = nx + ny
            node, count = left["node"].to_numpy(), nx
        else:
            node, count = np.concatenate([left["node"], right["node"]]), np.concatenate([nx, ny])
        some = count > 0
        roots = node[[sets.root(k) for k in range(len(node))]]
        return pd.DataFrame({"a": node[some], "b": roots[some], "links": count[some]})

    return join


def _valid(vector: str = "embedding"):
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))


def _plan(distinct: DataFrame, cosine: float) -> tuple[int | None, DataFrame, int]:
    """The width of blocks (None: one block, one cell), its cells' sizes in rows and chunks, and the bytes copied to tasks."""
    lengths = stored(distinct.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")), "vector-lengths")
    n, dims, pairs = lengths.agg(F.sum("n"), F.max("dims"), F.sum(F.col("n").cast("double") * (F.col("n") - 1) / 2)).first()
    if not n:
        n, dims, pairs = 0, 1, 0
    counted = stored(distinct.select("vector").mapInPandas(
        _cell_counts(cosine), "width int, dims int, block int, cell long, homes long, visits long").groupBy(
        "width", "dims", "block", "cell").agg(F.sum("homes").alias("homes"), F.sum("visits").alias("visits")), "cell-counts")
    homes = F.col("homes").cast("double")
    met = counted.groupBy("width", "dims").agg(F.sum(homes * (homes - 1) / 2 + homes * F.col("visits")).alias("met"))
    # a short vector's one block stands for all greater widths, too
    by_width = {}
    for w, d, pairs_met in met.collect():
        by_width.setdefault(d, {})[w] = pairs_met
    totals = {w: sum(x[min(w, max(x))] for x in by_width.values()) for w in widths(dims)} if by_width else {}
    width = min(totals, key=totals.get, default=None)
    if width is not None and totals[width] > PAYS * pairs:
        width = None
    if width is None:
        sizes = lengths.select("dims", F.lit(0).alias("block"), F.lit(0).cast("long").alias("cell"), F.col("n").alias("homes"),
                               F.lit(0).cast("long").alias("visits"))
    else:
        widest = counted.groupBy("dims").agg(F.max("width").alias("w")).withColumnRenamed("dims", "d")
        sizes = counted.join(small(widest), F.col("dims") == F.col("d")).where(
            F.col("width") == F.least(F.col("w"), F.lit(width))).select("dims", "block", "cell", "homes", "visits")
    rows = max(1, min(max(CHUNK, -(-n // CHUNKS)), NUMBERS // dims))
    chunks = lambda c: F.ceil(F.col(c) / rows).cast("int")
    sizes = stored(sizes.where("homes > 0 and homes + visits > 1").withColumn("hs", chunks("homes")).withColumn(
        "vs", chunks("visits")), "cell-sizes")
    copies = sizes.agg(F.sum(F.col("homes") * (F.col("hs") + F.col("vs")) + F.col("visits") * F.col("hs"))).first()[0] or 0
    return width, sizes, copies * -(-bytes_in_files(distinct) // max(1, n))


def embedding_classes(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding)."""
    rows = vectors.select("vec_id", "embedding").withColumn("valid", _valid())
    distinct = stored(
        rows.where("valid").groupBy(F.col("embedding").alias("vector")).agg(
            F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.xxhash64("vector", F.size("vector"))), "vectors")
    width, sizes, copied = _plan(distinct, cosine)
    place = ["dims", "block", "cell"]
    if width is None:
        sized = distinct.select(
            F.size("vector").alias("dims"), F.lit(0).alias("block"), F.lit(0).cast("long").alias("cell"),
            F.lit(True).alias("home"), "node", "vector", "copies").join(small(sizes), place)
        vectors_here = ["vector", "copies"]
    else:
        cells = stored(distinct.select("node", "vector").mapInPandas(
            _cells(cosine, width), "dims int, block int, cell long, home boolean, node long"), "vector-cells")
        sized = cells.join(small(sizes), place)
        vectors_here = []
    own = F.pmod(F.xxhash64("node", "block"), F.when(F.col("home"), F.col("hs")).otherwise(F.col("vs"))).cast("int")
    # (i, j, within, side): a home chunk meets itself, the later home chunks, and every visiting chunk.
    meeting = lambda i, j, within, side: F.struct(
        i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(within).alias("within"), F.lit(side).alias("side"))
    upto = lambda a, b: F.when(a <= b, F.sequence(a, b)).otherwise(F.array().cast("array<int>"))
    c, zero = F.col("own"), F.lit(0)
    home = F.concat(
        F.array(meeting(c, c, True, 0)),
        F.transform(upto(c + 1, F.col("hs") - 1), lambda j: meeting(c, j, False, 0)),
        F.transform(upto(zero, c - 1), lambda i: meeting(i, c, False, 1)),
        F.transform(upto(zero, F.col("vs") - 1), lambda j: meeting(c, -1 - j, False, 0)))
    visit = F.transform(upto(zero, F.col("hs") - 1), lambda i: meeting(i, -1 - c, False, 1))
    met = sized.withColumn("own", own).withColumn("met", F.when(F.col("home"), home).otherwise(visit))
    # copies of the vectors are on disk for one round of meetings at a time
    rounds = max(1, -(-copied // max(ROUND_BYTES, ROUND_TABLES * bytes_in_files(distinct))))
    tables = []
    for k in range(rounds):
        now = F.filter("met", lambda m: F.pmod(F.xxhash64(*place, m["i"], m["j"]), F.lit(rounds)) == k)
        fat = met.withColumn("m", F.explode(now)).select(*place, "node", *vectors_here, "m.*")
        if not vectors_here:
            fat = fat.join(distinct.select("node", "vector", "copies"), "node")
        tables.append(stored(fat.groupBy(*place, "i", "j").applyInPandas(
            _join_chunks(cosine, width), "a long, b long, links long"), "vector-links"))
    found = reduce(DataFrame.union, tables)
    ties = components(found.select("a", "b"))
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    labelled = distinct.select("node", "least", "copies").join(counts, "node", "left").join(
        ties, F.col("node") == F.col("a"), "left").withColumn("root", F.coalesce("b", "node"))
    labelled = stored(labelled.select("node", "least", "root", (
        F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links")), "vector-labels")
    named = labelled.groupBy("root").agg(F.min("least").alias("component"))
    by_node = labelled.join(named, "root").select(F.col("node").alias("_node"), "n_links", "component")
    keyed = rows.withColumn("node", F.when(F.col("valid"), F.xxhash64("embedding", F.size("embedding"))))
    out = keyed.join(by_node, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("valid"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_classes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP8_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0, FALSE) AS ok
  FROM embeddings),
g AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE ok),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM g x JOIN g y ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.95),
reach AS (SELECT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS k FROM links GROUP BY a)
SELECT vec_id, coalesce(k, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM v LEFT JOIN comp ON comp.a = vec_id LEFT JOIN deg ON deg.a = vec_id
"""
