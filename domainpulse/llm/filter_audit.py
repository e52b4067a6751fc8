"""Filter interaction audit: what each filter of a chain removes in every order of the chain.

A document's failed filters are a combination of bits.  Once documents are
counted by part and combination, every order of the filters is arithmetic on
at most 2^5 counts a part:

1. one scan gives each row its digest and the bits of the filters that look
   at the row alone;
2. the filter on copies is an existential self-join: rows whose hash occurs
   more than once are joined left-semi, on hash, exact text and smaller
   doc_id, to one row per text with its least id.  A text's copies are
   salted by their bytes, so a text of a third of all rows is split over
   many tasks;
3. the semi-join's ids are united with the failures of the other filters and
   a grouped bit-or per (part, doc_id, digest) gives the combinations, a
   second group-by their counts with the labels;
4. each count is spread over the orders and steps and summed.

Defined results: a null text counts as empty (no words, so it fails only the
word count, and the copy filter if another empty text has a smaller id); a
null id is never a copy nor makes one, and has no label; rows with equal id
and text are not copies of each other; a document is good or toxic if any
label row of its id says 1; a null ``lang`` is the part ''; an empty table has
no parts and so no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from domainpulse.llm.common import documents, small, stored, text_or_empty

#: The filters in bit order; the last one needs the whole table.
FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of a text's copies that one task of the self-join takes.
SALT_BYTES = 4 << 20


def bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def row_failures(text: Column) -> Column:
    """Bits of the filters that need the row alone."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = {
        "A": n < MIN_WORDS,
        "B": F.lit(100) * distinct < F.lit(DISTINCT_PERCENT) * n,
        "C": F.lit(100) * capitals > F.lit(CAPITALS_PERCENT) * F.length(text),
        "D": text.rlike(SYMBOLS),
    }
    return sum((F.when(c, bit(f)).otherwise(0) for f, c in fails.items()), F.lit(0))


def copies_of_smaller_ids(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """The rows (doc_id, hash, text, ...) whose text a smaller doc_id has too.

    ``hashes``: (hash, doc_id, bytes) of the same rows without their texts.
    """
    repeated = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("held")).where("n > 1")
    salts = F.greatest(F.lit(1), F.ceil(F.col("held") / SALT_BYTES)).cast("int")
    repeated = small(stored(repeated.select("hash", salts.alias("salts")), "repeated-hashes"))
    able = rows.where("doc_id is not null").join(repeated, "hash")
    least = able.groupBy("hash", "text").agg(F.min("doc_id").alias("least"), F.max("salts").alias("salts"))
    firsts = least.select(
        F.col("hash").alias("_hash"), F.col("text").alias("_text"), "least",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("_salt"))
    salted = able.withColumn("salt", F.pmod(F.xxhash64("doc_id"), "salts").cast("int"))
    return salted.join(firsts, (F.col("hash") == F.col("_hash")) & (F.col("salt") == F.col("_salt"))
                       & (F.col("text") == F.col("_text")) & (F.col("least") < F.col("doc_id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): rows per part and combination of failed filters."""
    rows = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"), text_or_empty().alias("text")).withColumn(
        "hash", F.xxhash64("text"))
    key = ["part", "doc_id", "hash", "digest"]
    facts = stored(rows.select(
        "part", "doc_id", "hash", F.unhex(F.md5("text")).alias("digest"), F.octet_length("text").cast("long").alias("bytes"),
        row_failures(F.col("text")).alias("bits")), "filter-facts")
    copies = copies_of_smaller_ids(rows, facts.where("doc_id is not null").select("hash", "bytes"))
    failures = facts.select(*key, F.lit(1).cast("long").alias("n"), "bits").unionByName(
        copies.select("part", "doc_id", "hash", F.unhex(F.md5("text")).alias("digest"), F.lit(0).cast("long").alias("n"),
                      F.lit(bit("E")).alias("bits")))
    masks = failures.groupBy(*key).agg(F.sum("n").alias("n"), F.bit_or("bits").alias("mask"))
    by_id = masks.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = by_id.join(marked, F.col("doc_id") == F.col("_id"), "left")
    share = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c)
    return known.groupBy("part", "mask").agg(F.sum("n").alias("n"), share("good"), share("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``combinations``."""
    orders = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    spread = counts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    letter = F.substring(F.col("filter_order"), F.col("step"), F.lit(1))
    earlier = F.substring(F.col("filter_order"), F.lit(1), F.col("step") - 1)
    bits = lambda s: sum((F.when(s.contains(f), bit(f)).otherwise(0) for f in FILTERS), F.lit(0))
    spread = spread.withColumn("own", bits(letter)).withColumn("before", bits(earlier))
    mask, own, before, n = F.col("mask"), F.col("own"), F.col("before"), F.col("n")
    fails = mask.bitwiseAND(own) != 0
    gone = mask.bitwiseAND(before) != 0
    total = lambda cond, what=n: F.sum(F.when(cond, what).otherwise(0)).cast("long")
    # a document that fails k filters is removed by each of them in 1/k of all orders
    orders_first = (F.lit(len(list(permutations(FILTERS)))) / F.bit_count("mask")).cast("long")
    return spread.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(fails & ~gone).alias("removed"), total(fails & gone).alias("redundant"),
        total(mask == own).alias("unique_fails"), total(fails & ~gone, F.col("good")).alias("good_lost"),
        total(fails & ~gone, F.col("toxic")).alias("toxic_lost"), total(fails, n * orders_first).alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "lang", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    return audit(combinations(docs, labels))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT text, min(doc_id) AS least FROM words GROUP BY text),
failed AS (
  SELECT part, doc_id, (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END)
      || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
      || (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' ELSE '' END)
      || (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END)
      || (CASE WHEN least < doc_id THEN 'E' ELSE '' END) AS fails
  FROM words JOIN firsts USING (text)),
marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
marked AS (
  SELECT part, fails, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM failed LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step)),
counts AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM marked GROUP BY ALL),
seen AS (
  SELECT *, contains(fails, own) AS f, before <> '' AND regexp_matches(fails, '[' || before || 'x]') AS gone FROM counts, steps),
audit AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT f AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (f AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (f AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = own), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (f AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (f AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM seen GROUP BY ALL)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM audit
"""
