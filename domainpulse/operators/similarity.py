"""Nearest-N similar domains within a cluster, exact, over a partition that follows the density.

A self-join on the cluster label would emit every pair inside a cluster.
Instead:

1. **Sites.** Domains with identical feature vectors (in one cluster) collapse
   into one site with a member count.  Members are numbered by domain id
   inside their site with the distributed ordinal helper, so a site holding
   a third of all domains never lands in one task.
2. **Distance 0.** A member's nearest neighbours start with the other members
   of its own site, in id order; only the first N+1 members of each site
   ("heads") can ever be needed, so the join fans out to at most N+1 rows per
   member.
3. **Tree.** The sites of every cluster are split at the median of every
   coordinate at once, level by level, until a node holds at most ``LEAF`` of them.  A
   clump gets as many leaves as it needs and far sites share a few, whatever
   the extent.  Each node keeps the box around its sites.
4. **Other sites.** Sites with at most N members need ``r = N - (m - 1)`` more
   neighbours.  Each starts with its own leaf and holds a frontier of tree
   nodes by the distance of their boxes.  A round takes the nearest
   ``VISITS`` nodes of every frontier: inner nodes are replaced by their
   children, leaves are compared member by member.  Nodes farther than the
   r-th neighbour found so far leave the frontier; a site whose frontier is
   empty is done, and its neighbours are exact.

A site meets at most ``VISITS * LEAF`` others a round, and only of boxes
that are nearer than its r-th neighbour found before; identical vectors
never create pairs.  The tables of nodes and leaves are joined by node,
broadcast only while their counted rows are few.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from domainpulse.operators.ordinal import number_rows
from domainpulse.session import cut_lineage

#: Sites of a leaf, tree nodes that a site takes up in a round, rows of a table that is broadcast.
LEAF, VISITS, BROADCAST_ROWS = 64, 8, 20_000
#: Room for rounding in the distance to a box, relative to the coordinates.
ROUNDING = 1e-14


@dataclass
class Tree:
    """``leaves`` (node, members), ``children`` (node, below), ``roots`` (tree, node, leaf), ``sites`` with their leaf."""

    sites: DataFrame
    leaves: DataFrame
    children: DataFrame
    roots: DataFrame
    depth: int


@dataclass
class Search:
    """``found`` (site, best, met): the r nearest others and the number of sites met; ``rounds`` of the search."""

    found: DataFrame
    rounds: int


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def build_tree(sites: DataFrame, dims: int, leaf: int = LEAF) -> Tree:
    """The tree over ``sites`` (site, tree, x, ...); ``x`` is an array of ``dims`` doubles, ``tree`` names the cluster."""
    x = [F.col("x")[j] for j in range(dims)]
    todo = sites.withColumn("node", F.col("tree")).withColumn("parent", F.lit(None).cast("string"))
    done, boxes, depth = [], [], 0
    while True:
        stats = cut_lineage(todo.groupBy("tree", "parent", "node").agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.min(c) for c in x]).alias("lo"), F.array(*[F.max(c) for c in x]).alias("hi"),
            F.array(*[F.percentile_approx(c, 0.5, 1000) for c in x]).alias("mid")))
        # sites that rounding puts on one point stay together
        full = (F.col("n") > leaf) & F.exists(F.sequence(F.lit(0), F.lit(dims - 1)), lambda j: F.col("hi")[j] > F.col("lo")[j])
        boxes.append(stats.select("tree", "parent", "node", "lo", "hi", (~full).alias("leaf")))
        split = stats.where(full).select("node", "lo", "hi", "mid")
        if split.isEmpty():
            done.append(todo)
            break
        depth += 1
        lo, hi, mid = F.col("lo"), F.col("hi"), F.col("mid")
        # both sides of a coordinate that varies hold sites: a median that is the greatest value goes right
        side = [F.when(F.when(mid[j] == hi[j], (x[j] >= hi[j]) & (lo[j] < hi[j])).otherwise(x[j] > mid[j]), 1 << j).otherwise(0)
                for j in range(dims)]
        halves = todo.join(_small(split), "node", "left")
        done.append(halves.where(lo.isNull()).drop("lo", "hi", "mid"))
        below = F.concat_ws(".", "node", sum(side, F.lit(0)).cast("string"))
        todo = cut_lineage(halves.where(lo.isNotNull()).withColumn("parent", F.col("node")).withColumn("node", below).drop(
            "lo", "hi", "mid"))
    placed, nodes = done[0], boxes[0]
    for d, b in zip(done[1:], boxes[1:]):
        placed, nodes = placed.unionByName(d), nodes.unionByName(b)
    placed, nodes = cut_lineage(placed.drop("parent")), cut_lineage(nodes)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.collect_list(F.struct("node", "lo", "hi", "leaf")).alias("below"))
    members = [c for c in placed.columns if c not in ("tree", "node", "x")]
    leaves = placed.groupBy("node").agg(F.collect_list(F.struct(*members)).alias("members"))
    return Tree(placed, cut_lineage(leaves), cut_lineage(children), nodes.where("parent is null").select("tree", "node", "leaf"), depth)


def _to_box(box: Column, dims: int) -> Column:
    """Squared distance from ``x`` to a box, never above the true one."""
    total = F.lit(0.0)
    for j in range(dims):
        x, lo, hi = F.col("x")[j], box["lo"][j], box["hi"][j]
        gap = F.greatest(lo - x, x - hi) - F.lit(ROUNDING) * F.greatest(F.abs(x), F.abs(lo), F.abs(hi))
        gap = F.greatest(gap, F.lit(0.0))
        total = total + gap * gap
    return total


def search(tree: Tree, queries: DataFrame, squared, dims: int, visits: int = VISITS) -> Search:
    """The nearest members of other sites for ``queries`` (site, node, x, r, ...).

    ``squared(member)``: the squared distance from the query's columns to a leaf's member.
    """
    leaves, children = _small(tree.leaves), _small(tree.children)
    own = queries.columns

    def candidates(members: Column, r: Column, bound: Column) -> Column:
        """The r nearest heads of ``members`` within ``bound`` as (sq, id)."""
        others = F.transform(F.filter(members, lambda s: s["site"] != F.col("site")),
                             lambda s: F.struct(squared(s).alias("sq"), s["heads"].alias("heads")))
        near = F.filter(others, lambda s: bound.isNull() | (s["sq"].cast("double") <= bound))
        heads = F.flatten(F.transform(near, lambda s: F.transform(s["heads"], lambda h: F.struct(s["sq"].alias("sq"), h.alias("id")))))
        return F.slice(F.array_sort(heads), F.lit(1), r)

    def limit(best: Column) -> Column:
        """Squared distance of the r-th neighbour; null before there are r of them."""
        r = F.col("r")
        return F.when(F.size(best) >= r, F.element_at(best, r)["sq"].cast("double") * F.lit(1 + 1e-12))

    def prune(frontier: Column, bound: Column) -> Column:
        return F.array_sort(F.filter(frontier, lambda f: (f["node"] != F.col("node")) & (bound.isNull() | (f["d"] <= bound))))

    entry = lambda d, node, leaf: F.struct(d.alias("d"), node.alias("node"), leaf.alias("leaf"))
    roots = tree.roots.select("tree", F.array(entry(F.lit(0.0), F.col("node"), F.col("leaf"))).alias("frontier"))
    start = queries.join(leaves, "node").withColumn("best", candidates(F.col("members"), F.col("r"), F.lit(None).cast("double")))
    start = start.withColumn("met", F.size("members").cast("long")).drop("members").join(_small(roots), "tree")
    state = cut_lineage(start.withColumn("bound", limit(F.col("best"))).withColumn("frontier", prune(F.col("frontier"), F.col("bound"))))
    found, rounds = [], 0
    while True:
        found.append(state.where(F.size("frontier") == 0).select("site", "best", "met"))
        active = state.where(F.size("frontier") > 0)
        if active.isEmpty():
            break
        rounds += 1
        taken = active.select(*own, "bound", F.explode(F.slice("frontier", 1, visits)).alias("t")).withColumn("at", F.col("t.node"))
        none = F.array().cast(state.schema["best"].dataType)
        met = taken.where("t.leaf").join(leaves.withColumnRenamed("node", "at"), "at").select(
            "site", candidates(F.col("members"), F.col("r"), F.col("bound")).alias("more"),
            F.array().cast(state.schema["frontier"].dataType).alias("nodes"), F.size("members").cast("long").alias("seen"))
        opened = taken.where("not t.leaf").join(children.withColumnRenamed("node", "at"), "at").select(
            "site", none.alias("more"),
            prune(F.transform("below", lambda b: entry(_to_box(b, dims), b["node"], b["leaf"])), F.col("bound")).alias("nodes"),
            F.lit(0).cast("long").alias("seen"))
        news = met.unionByName(opened).groupBy("site").agg(
            F.flatten(F.collect_list("more")).alias("more"), F.flatten(F.collect_list("nodes")).alias("nodes"),
            F.sum("seen").alias("seen"))
        rest = F.slice("frontier", F.lit(visits + 1), F.greatest(F.size("frontier") - visits, F.lit(0)))
        merged = active.join(news, "site").withColumn(
            "best", F.slice(F.array_sort(F.concat("best", "more")), F.lit(1), F.col("r"))).withColumn("met", F.col("met") + F.col("seen"))
        merged = merged.withColumn("bound", limit(F.col("best"))).withColumn(
            "frontier", prune(F.concat(rest, F.col("nodes")), F.col("bound")))
        state = cut_lineage(merged.drop("more", "nodes", "seen"))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return Search(out, rounds)


def similar_domains(points: DataFrame, cols: Sequence[str], n: int = 5, group: str = "cluster_label",
                    id_col: str = "domain_id", weights: Sequence[float] | None = None) -> DataFrame:
    """For each domain: its ``n`` nearest other domains in the same ``group``.

    Output: id_col, group, neighbor_id, neighbor_rank (1..n), distance
    (Euclidean).  Neighbours are ordered by squared distance, then id.
    ``weights`` scale the squared differences per column.  Differences of
    decimal columns are exact, so equal differences tie exactly; without
    weights their squares and sums are exact, too.
    """
    cols = list(cols)
    key = [group, *cols]
    pts = points.select(id_col, *key)

    # 1. number members inside their site, distributed; a site goes by its first number
    numbered = number_rows(pts, [*key, id_col], out="_g", start=0)
    starts = numbered.groupBy(*key).agg(F.min("_g").alias("site"), F.count(F.lit(1)).alias("m"))
    members = cut_lineage(
        numbered.join(starts, key).select(id_col, *key, "site", (F.col("_g") - F.col("site")).alias("q"), "m"))

    # 2. neighbours inside the own site (distance 0)
    heads = members.where(F.col("q") <= n).select("site", F.col(id_col).alias("neighbor_id"), F.col("q").alias("hq"))
    same = members.where("m > 1").join(heads, "site").where(F.col("hq") != F.col("q")).select(
        id_col, group, "neighbor_id",
        (F.col("hq") + 1 - F.when(F.col("hq") > F.col("q"), 1).otherwise(0)).alias("neighbor_rank"),
        F.lit(0.0).alias("distance"),
    ).where(F.col("neighbor_rank") <= n)

    # 3. and 4. neighbours from other sites
    cross = nearest_sites(members, cols, n, group, id_col, weights).found
    ranked = cross.select("site", F.posexplode("best").alias("p", "b")).select(
        "site", F.col("p").alias("crank"), F.col("b.id").alias("neighbor_id"), F.sqrt(F.col("b.sq").cast("double")).alias("distance"))
    expanded = members.where(F.col("m") <= n).join(ranked, "site").select(
        id_col, group, "neighbor_id", (F.col("crank") + F.col("m")).alias("neighbor_rank"), "distance")
    return same.unionByName(expanded).withColumn("neighbor_rank", F.col("neighbor_rank").cast("int"))


def nearest_sites(members: DataFrame, cols: Sequence[str], n: int, group: str = "cluster_label", id_col: str = "domain_id",
                  weights: Sequence[float] | None = None, leaf: int = LEAF, visits: int = VISITS) -> Search:
    """Tree and search over the sites of ``members`` (id, group, cols, site, q, m)."""
    scale = [1.0] * len(cols) if weights is None else [float(w) ** 0.5 for w in weights]
    names = [f"c{j}" for j in range(len(cols))]
    sites = members.where(F.col("q") < n).groupBy("site", group, *cols, "m").agg(
        F.sort_array(F.collect_list(F.struct("q", F.col(id_col).alias("id")))).alias("h"))
    sites = sites.select(
        "site", "m", F.coalesce(F.col(group).cast("string"), F.lit("")).alias("tree"), *[F.col(c).alias(k) for c, k in zip(cols, names)],
        F.array(*[F.col(c).cast("double") * F.lit(s) for c, s in zip(cols, scale)]).alias("x"), F.col("h.id").alias("heads"))

    def squared(s: Column) -> Column:
        apart = [F.col(k) - s[k] for k in names]
        if weights is None:
            return sum((d * d for d in apart[1:]), apart[0] * apart[0])
        terms = [d.cast("double") * d.cast("double") * F.lit(float(w)) for d, w in zip(apart, weights)]
        return sum(terms[1:], terms[0])

    tree = build_tree(cut_lineage(sites), len(cols), leaf)
    queries = tree.sites.where(F.col("m") <= n).withColumn("r", (F.lit(n) - (F.col("m") - 1)).cast("int")).drop("heads")
    return search(tree, queries, squared, len(cols), visits)
