"""Mixing sources to target weights by hash-threshold histograms (operator 10).

A document's place in its source's order is a hash of its id. The words of
each source are summed by hash bucket (4,096 a level), the bucket in which the
budget ends is found from the running sums, and only rows of that bucket enter
the next, finer level, until it holds one row (or one hash value). Rows below
the threshold are taken: no sort of the documents, and a smaller budget's rows
are always among a larger one's. A source whose target is k times its size and
a remainder is taken k times whole, and once more below the threshold for the
remainder. The row on the boundary is taken if that ends nearer to the budget.

Sums are pre-aggregated by (source, bucket) before they are shuffled, so a
source with a third of all rows costs one row per bucket and task.

Cases: a null text has size 0 and is taken with 0 words; a null source is a
source of its own, last in order; repeated ids share a hash and are taken
together or not at all; empty tables give no rows; extra columns are ignored
by ``mix`` and kept by ``repeated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.llm.common import WORD, numbered, unpacked_row, whole_row, written

WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
HASH_BITS = 60
LEVEL_BITS = 12


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: str = "doc_id") -> Column:
    """60-bit hash of an id, the same in any SQL that has MD5."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
            most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size) with target: shares by weight, capped at ``most`` times the size.

    The level (target per unit of weight) rises in rounds until no source is
    above its cap; each round is one small aggregate of the source table.
    """
    ranked = numbered(sizes, [F.col("source").isNull(), F.col("source")], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    table = written(ranked.withColumn("weight", weight), "sources")
    cap = F.col("source_size") * most
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        above = cap.cast("double") < F.lit(level) * F.col("weight")
        n, fixed, free = table.agg(F.count_if(above), F.sum(F.when(above, cap)),
                                   F.sum(F.when(~above, F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, (total - (fixed or 0)) / free
    return table.select("source", "source_size",
                        F.least(cap.cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _with_source(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """``a`` with the columns of ``b`` for the same source; null is a source."""
    other = b.withColumnRenamed("source", "__source")
    return a.join(other, F.col("source").eqNullSafe(F.col("__source")), how).drop("__source")


def thresholds(rows: DataFrame, budgets: DataFrame, hash_bits: int = HASH_BITS,
               level_bits: int = LEVEL_BITS) -> DataFrame:
    """(source, threshold): rows of ``rows`` (source, size, place) below it sum to about ``budget``.

    ``budgets``: source, budget (0 up to the source's size). The bucket of a
    row at level l is its leading l * ``level_bits`` bits.
    """
    state = written(budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"),
                                   F.lit(0).cast("long").alias("below")), "thresholds")
    found = None
    for level in range(1, hash_bits // level_bits + 1):
        last = level * level_bits >= hash_bits
        above, here = hash_bits - (level - 1) * level_bits, hash_bits - level * level_bits
        inside = _with_source(rows.select("source", "size", "place"), state.select("source", "prefix")).where(
            F.shiftright("place", above) == F.col("prefix"))
        sums = (inside.select("source", F.shiftright("place", here).alias("bucket"), "size")
                      .groupBy("source", "bucket")
                      .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
        running = F.sum("size").over(Window.partitionBy("source").orderBy("bucket"))
        sums = sums.withColumn("before", running - F.col("size"))
        ends = (_with_source(sums, state)
                    .where(F.col("below") + F.col("before") + F.col("size") > F.col("budget"))
                    .groupBy("source").agg(F.min(F.struct("bucket", "before", "size", "n")).alias("end")))
        step = written(_with_source(state, ends, "left"), "thresholds")
        # no bucket passes the budget: all of the prefix is taken
        whole = step.where(F.col("end").isNull()).select(
            "source", F.shiftleft(F.col("prefix") + 1, above).alias("threshold"))
        split = step.where(F.col("end").isNotNull()).select(
            "source", "budget", F.col("end.bucket").alias("prefix"),
            (F.col("below") + F.col("end.before")).alias("below"), "end.size", "end.n")
        done = split if last else split.where("n = 1")
        nearer = F.col("below") + F.col("size") - F.col("budget") < F.col("budget") - F.col("below")
        settled = whole.union(done.select("source", F.shiftleft(
            F.col("prefix") + F.when(nearer, 1).otherwise(0), here).alias("threshold")))
        found = settled if found is None else found.union(settled)
        if last:
            break
        state = split.where("n > 1").select("source", "budget", "prefix", "below")
        if state.isEmpty():
            break
    return found


def plan(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """(source, source_size, target, whole, threshold) for rows (source, size, place)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = written(goal.withColumn("whole", whole.cast("long")), "targets")
    ends = thresholds(rows, goal.select("source", (
        F.col("target") - F.col("whole") * F.col("source_size")).alias("budget")))
    return written(_with_source(goal, ends, "left").withColumn(
        "threshold", F.coalesce("threshold", F.lit(0).cast("long"))), "plan")


def _copies() -> Column:
    return F.when(F.col("source_size") > 0,
                  F.col("whole") + (F.col("place") < F.col("threshold")).cast("long")).otherwise(0)


def _rows(docs: DataFrame) -> DataFrame:
    return written(docs.select("doc_id", "source", words_in().alias("size"), place().alias("place")),
                   "sizes")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    rows = _rows(docs)
    goal = plan(rows, weights, most)
    return _with_source(rows, goal).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * _copies()).alias("taken"))


def repeated(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, columns unchanged."""
    goal = plan(_rows(docs), weights, most)
    rows = docs.select(whole_row(docs).alias("row"), F.col("source"), place().alias("place"))
    taken = _with_source(rows, goal).withColumn("copy", F.explode(F.array_repeat(F.lit(1), _copies().cast("int"))))
    return taken.select(*unpacked_row(docs, "row"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
      FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS k FROM w),
c AS (SELECT o.*,
        ((SELECT sum(source_size) FROM o) - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE
          / ((SELECT sum(weight) FROM o) - coalesce(sum(weight) OVER b, 0)) AS level
      FROM o WINDOW b AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM c WHERE 3 * source_size >= level * weight ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(3 * source_size::DOUBLE, (SELECT level FROM l) * weight) AS target
      FROM w),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
         p.target - p.whole * p.source_size AS budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.place) AS own
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * CASE WHEN source_size = 0 THEN 0 ELSE whole + CASE
          WHEN upto <= budget THEN 1
          WHEN upto - own <= budget AND upto - budget < budget - (upto - own) THEN 1
          ELSE 0 END END)::BIGINT AS taken
FROM r
"""
