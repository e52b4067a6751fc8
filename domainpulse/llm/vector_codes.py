"""Vector code compression: product codes by Orchard search.

Components become integers floor(256 * x), so that every distance, sum and
mean is exact and results hang on nothing but the rows.  Vectors are cut into
``PARTS`` equal parts; each part position has a codebook of ``ENTRIES``
entries that starts at the vectors with the smallest ids and is refined by
``ROUNDS`` rounds of assignment and componentwise floor(sum / count).

Nearest entries are found by Orchard's method: every entry keeps the list of
all entries by distance from it.  A search walks the list of its best entry
so far; an entry met before is skipped by its mark; a nearer entry (or an
equally near one of lower index) takes over, and the walk jumps to the start
of that one's list; it ends at the first entry further from the best one
than twice the current distance, as by the triangle inequality no entry
from there on can be as near.  All searches of a batch walk at once in numpy.

A round is one pass over the rows: tasks search, and hand on their sums and
counts per part position and entry (``PARTS * ENTRIES`` rows a task), which
are summed in groups of at most ``FAN_IN`` tasks, level by level.  Only codebooks reach the driver and the
tasks; their size hangs on the parameters and the dimension alone.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped, and so are vectors that cannot be cut (no component,
or a length that the number of parts does not divide) and those of another
length than most rows have (the smaller length, if two are as frequent).
Fewer rows than entries make a smaller codebook.  Equal ids start the
codebook in the order of their vectors, null ids come last; equal vectors
are separate rows.  Integers of any size are exact (Python's own where 64 bits
do not hold the sums); an ``error`` or ``label_error`` beyond 64 bits is
null.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import small, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows that search at a time, and tasks whose sums one group adds up.
BATCH, FAN_IN = 4096, 256
#: Integers below this keep squares and sums of a batch within 64 bits.
SAFE = 1 << 24
LONG = 1 << 63


def integers(vectors) -> np.ndarray:
    """Rows of floor(SCALE * x): 64-bit integers, or Python's own where those are too small."""
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    if np.abs(x).max(initial=0.0) * SCALE < SAFE:
        return np.floor(x * SCALE).astype(np.int64)
    # a float this large may overflow when scaled; its ratio of integers does not
    scaled = lambda v: (lambda n, d: n * SCALE // d)(*v.as_integer_ratio())
    out = np.empty(x.shape, dtype=object)
    out[:] = [[scaled(v) for v in row] for row in x.tolist()]
    return out


def mixed_parts(matrix: np.ndarray, parts: int) -> np.ndarray:
    """(parts, rows, dimensions of a part)."""
    return matrix.reshape(len(matrix), parts, -1).transpose(1, 0, 2)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


class Neighbours:
    """Every entry's distance-sorted list of all entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        apart = squared(entries[:, None, :], entries[None, :, :])
        if apart.dtype == object:
            self.order = np.array([sorted(range(len(entries)), key=lambda j: (row[j], j)) for row in apart])
        else:
            self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        # a search starts at the entry that is nearest to all others
        self.start = min(range(len(entries)), key=lambda i: (int(sum(apart[i].tolist())), i))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index, squared distance) of each query's nearest entry, ties to the lower index, and distances computed."""
        n, k = len(queries), len(self.entries)
        best = np.full(n, self.start)
        near = squared(queries, self.entries[self.start])
        met = np.zeros((n, k), dtype=bool)
        met[:, self.start] = True
        place = np.zeros(n, dtype=np.int64)
        walking = np.arange(n)
        computed = n
        while len(walking):
            at = best[walking], place[walking]
            # squared: twice the distance is four times its square
            walking = walking[np.asarray(self.apart[at] <= 4 * near[walking], dtype=bool)]
            entry = self.order[best[walking], place[walking]]
            new = ~met[walking, entry]
            place[walking] += 1
            who, which = walking[new], entry[new]
            met[who, which] = True
            found = squared(queries[who], self.entries[which])
            computed += len(who)
            nearer = np.asarray((found < near[who]) | ((found == near[who]) & (which < best[who])), dtype=bool)
            who = who[nearer]
            best[who], near[who], place[who] = which[nearer], found[nearer], 0
            walking = walking[place[walking] < k]
        return best, near, computed


@dataclass(frozen=True)
class Codebooks:
    """(parts, entries, dimensions of a part) integers."""

    entries: np.ndarray

    def assign(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and squared distances, each (parts, rows)."""
        found = [Neighbours(book).search(part)[:2] for book, part in zip(self.entries, mixed_parts(matrix, len(self.entries)))]
        return np.stack([f[0] for f in found]), np.stack([f[1] for f in found])

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def usable(vector: str = "embedding") -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(F.col(vector), finite), F.lit(False))


def kept_vectors(vectors: DataFrame, parts: int) -> DataFrame:
    rows = vectors.select("vec_id", "embedding", "label").where(usable())
    rows = rows.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    lengths = rows.groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "dims").select("dims").first()
    return rows.where(F.size("embedding") == F.lit(usual[0] if usual else 0))


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> Codebooks | None:
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("embedding").limit(entries).collect()
    return Codebooks(mixed_parts(integers([r[0] for r in first]), parts)) if first else None


def _batches(frames: Iterator[pd.DataFrame], vector: str = "embedding"):
    for rows in frames:
        for i in range(0, len(rows), BATCH):
            part = rows.iloc[i:i + BATCH]
            yield part, integers(part[vector])


def _sums(books: Codebooks):
    """A task's count and componentwise sums per part position and entry."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], list[int]] = {}
        for _, matrix in _batches(frames):
            codes, _ = books.assign(matrix)
            for p, (code, part) in enumerate(zip(codes, mixed_parts(matrix, len(codes)))):
                order = np.argsort(code, kind="stable")
                present, begin = np.unique(code[order], return_index=True)
                added = np.add.reduceat(part[order], begin, axis=0)
                counts = np.diff([*begin, len(order)])
                for e, n, s in zip(present.tolist(), counts.tolist(), added.tolist()):
                    old = held.get((p, e))
                    new = [n, *s]
                    held[p, e] = new if old is None else [a + b for a, b in zip(old, new)]
        if held:
            yield pd.DataFrame({
                "task": uuid.uuid4().int % LONG, "part": [k[0] for k in held], "entry": [k[1] for k in held],
                "sums": [[str(v) for v in s] for s in held.values()]})

    return sums


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = [sum(map(int, column)) for column in zip(*rows["sums"])]
    return pd.DataFrame({"task": rows["task"].min(), "part": rows["part"].iloc[:1], "entry": rows["entry"].iloc[:1],
                         "sums": [[str(v) for v in total]]})


SUMS = "task long, part int, entry int, sums array<string>"


def refined(rows: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over ``rows``."""
    sums = stored(rows.select("embedding").mapInPandas(_sums(books), SUMS), "code-sums")
    tasks = sums.agg(F.count_distinct("task")).first()[0]
    while tasks:  # each level leaves one row per group; the last one per entry
        groups = -(-tasks // FAN_IN)
        sums = sums.groupBy("part", "entry", F.pmod(F.xxhash64("task"), F.lit(groups)).alias("group")).applyInPandas(_add, SUMS)
        tasks = groups if groups > 1 else 0
        sums = stored(sums, "code-sums") if tasks else sums
    entries = books.entries.astype(object)
    for r in sums.collect():  # at most one row per part position and entry
        n, *total = map(int, r["sums"])
        entries[r["part"], r["entry"]] = [s // n for s in total]
    if max(map(abs, entries.ravel().tolist())) < SAFE:
        entries = entries.astype(np.int64)
    return Codebooks(entries)


def _codes(books: Codebooks):
    def codes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, matrix in _batches(frames):
            code, distance = books.assign(matrix)
            text = code.T.astype(np.uint8).tobytes().hex()
            width = 2 * len(code)
            yield pd.DataFrame({
                "vec_id": rows["vec_id"], "label": rows["label"],
                "code": [text[i:i + width] for i in range(0, len(text), width)],
                "error": [str(e) for e in distance.astype(object).sum(axis=0)]})

    return codes


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Rows (vec_id, label, code, error) of the kept ``vectors`` (vec_id, embedding, label), and the codebooks.

    ``entries`` is at most 256, two hex digits a code.
    """
    rows = kept_vectors(vectors, parts)
    books = first_codebooks(rows, parts, entries)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, "
    if books is None:
        return rows.sparkSession.createDataFrame([], schema + "code string, error decimal(38,0)"), None
    for _ in range(rounds):
        books = refined(rows, books)
    coded = rows.mapInPandas(_codes(books), schema + "code string, error string")
    return stored(coded.withColumn("error", F.expr("try_cast(error AS decimal(38,0))")), "vector-codes"), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    # an error beyond 38 digits leaves its label's sum unknown, too
    lost = F.max(F.col("error").isNull())
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.when(~lost, F.expr("try_sum(error)")).alias("total"))
    sums = small(stored(sums, "label-errors"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", F.expr("try_cast(error AS bigint)").alias("error"), F.expr("try_cast(total AS bigint)").alias("label_error"),
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))


def _assigned(name: str, books: str) -> str:
    return f"""
{name} AS (
  SELECT p.vec_id, p.label, p.pos, arg_min(b.entry, (d, b.entry)) AS entry, min(d) AS d
  FROM (SELECT p.vec_id, p.label, p.pos, b.entry,
               list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM parts p JOIN {books} b USING (pos)) p JOIN {books} b USING (pos, entry)
  GROUP BY p.vec_id, p.label, p.pos)"""


def _refined(name: str, assigned: str, books: str) -> str:
    return f"""
{name} AS (
  SELECT pos, entry, coalesce(m.v, b.v) AS v FROM {books} b LEFT JOIN (
    SELECT pos, entry, list(CASE WHEN s >= 0 THEN s // n ELSE -((-s + n - 1) // n) END ORDER BY j) AS v
    FROM (SELECT a.pos, a.entry, j, sum(p.v[j])::BIGINT AS s, count(*) AS n
          FROM {assigned} a JOIN parts p USING (vec_id, pos), range(1, 5) r(j) GROUP BY a.pos, a.entry, j)
    GROUP BY pos, entry) m USING (pos, entry))"""


#: Of 64 dimensions, distinct ids.
OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, label, pos::INT AS pos, v[pos * 4 + 1:pos * 4 + 4] AS v FROM kept, range(0, 16) r(pos)),
b0 AS (SELECT pos, (row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1)::INT AS entry, v FROM parts
       QUALIFY row_number() OVER (PARTITION BY pos ORDER BY vec_id) <= 64),
{_assigned("a0", "b0")},{_refined("b1", "a0", "b0")},{_assigned("a1", "b1")},{_refined("b2", "a1", "b1")},{_assigned("a2", "b2")},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM b2),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, sum(d)::BIGINT AS error
          FROM a2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books
"""
