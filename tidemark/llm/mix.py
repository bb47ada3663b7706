"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every source gets a target number of words (:func:`targets`). Each of its
documents then has the same expected number of copies, target / source size.
The documents of a source stand in one fixed order (size class, then a hash of
the id); the prefix sum of expected copies plus one random offset per source
crosses integers, and a document is emitted once per integer it crosses.

At scale: prefix sums are never taken over a whole source. Documents are dealt
into cells (source, size class, slice of the hash), cells are counted, a prefix
sum over the cells gives each cell's offset, and only the rank inside a cell is
taken over its documents. A source with a third of all rows is many cells.

Defined results: a null source is a source of its own, ordered last; null and
empty texts have size 0 and still get their expected copies (0 words each);
an empty table gives an empty result; rows that repeat an id are ranked one
after the other; extra columns are kept, and columns named like the added ones
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
CELL_ROWS = 100_000
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Power of two of the size and the next three bits: sizes of one class
    differ by an eighth at most."""
    bits = F.length(F.bin(size)) - 1
    return F.when(size <= 0, F.lit(0)).otherwise(
        bits * 8 + (F.expr("shiftright(shiftleft(__size, 3), cast(length(bin(__size)) - 1 as int))") - 8) + 1).cast("int")


def _unit(hash_hex: Column) -> Column:
    """The first eight hex digits as a number in [0, 1)."""
    return F.conv(F.substring(hash_hex, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size)`` -> the same plus ``target``.

    Sources in code point order (null last) weigh ``weights`` in turn and share
    ``share`` of all sizes; a target stops at ``cap`` times its source's size
    and the excess goes to the others by weight, until none is above. With the
    sources by cap / weight, the level at which the first ones are full and the
    rest share by weight follows from prefix sums.
    """
    ranked = sizes.withColumn("__i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("__i") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("__w", w).withColumn("__cap", F.col("source_size") * F.lit(float(cap)))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("__cap") / F.col("__w"), "__i").rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
             / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))))
    leveled = ranked.withColumn("__level", F.when(F.col("__cap") / F.col("__w") >= level, level))
    # the first source whose cap isn't reached fixes the level of all that follow
    cut = leveled.withColumn("__at", F.min(F.when(F.col("__level").isNotNull(), F.struct(
        (F.col("__cap") / F.col("__w")).alias("r"), F.col("__i").alias("i"), F.col("__level").alias("level")))).over(everything))
    target = F.when(F.col("__at").isNull(), F.col("__cap")).otherwise(
        F.least(F.col("__cap"), F.col("__at.level") * F.col("__w")))
    return cut.select("source", "source_size", target.alias("target"))


def systematic_mix(docs: DataFrame, *, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = 42,
                   cell_rows: int = CELL_ROWS, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source") -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target``, ``copies`` and
    ``taken`` (words the mix takes). See the module text for defined results."""
    keyed = (docs.drop(*ADDED)
             .withColumn("__size", word_count(F.col(text_col)))
             .withColumn("__class", size_class(F.col("__size")))
             .withColumn("__hash", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))))
    # first a count by class only, which says how many slices the cells need
    rows = docs.count()
    slices = max(1, -(-rows // cell_rows))
    keyed = keyed.withColumn("__slice", F.floor(_unit(F.col("__hash")) * slices).cast("int"))
    cells = (keyed.groupBy(F.col(source_col).alias("source"), "__class", "__slice")
             .agg(F.count(F.lit(1)).alias("__n"), F.sum("__size").alias("__words")))
    # a source's cells are far fewer than its rows: prefix sums over them in order
    before = Window.partitionBy("source").orderBy("__class", "__slice").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    goal = targets(cells.groupBy("source").agg(F.sum("__words").alias("source_size")), weights, share, cap)
    offset = _unit(F.md5(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("source"), F.lit("")))))
    placed = (placed.join(goal.withColumnRenamed("source", "__goal"), F.expr("source <=> __goal"))
              .select(F.col("source").alias("__source"), F.col("__class").alias("__c"), F.col("__slice").alias("__s"),
                      "__before", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                      offset.alias("__offset")))
    cell = Window.partitionBy(F.col(source_col), "__class", "__slice").orderBy("__hash", F.col(id_col), "__size")
    ranked = keyed.withColumn("__rank", F.row_number().over(cell))
    joined = ranked.join(placed, F.col(source_col).eqNullSafe(F.col("__source"))
                         & (F.col("__class") == F.col("__c")) & (F.col("__slice") == F.col("__s")))
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(F.lit(0.0))
    at = F.col("__before") + F.col("__rank")
    crossed = F.floor(F.col("__offset") + rate * at) - F.floor(F.col("__offset") + rate * (at - 1))
    copies = F.least(crossed, F.ceil(rate)).cast("int")
    return joined.select(*[c for c in docs.columns if c not in ADDED], F.col("__size").alias("size"),
                         F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
                         copies.alias("copies"), (copies * F.col("__size")).cast("long").alias("taken"))


def emit(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """One row per copy, with ``columns`` only."""
    return mixed.filter("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)


def mixed_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns that are
    named like the added ones keep their own values. Rows taken zero times,
    among them empty texts of sources that are over their target, are left
    out; a null source or text is as in :func:`systematic_mix`; an empty table
    gives an empty result."""
    hidden = {c: f"__own_{c}" for c in docs.columns if c in ADDED}
    mixed = systematic_mix(docs.withColumnsRenamed(hidden), **options)
    return emit(mixed, [hidden.get(c, c) for c in docs.columns]).withColumnsRenamed({v: k for k, v in hidden.items()})


SQL = r"""
WITH k AS (
  SELECT doc_id, source, COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         MD5('42:' || COALESCE(doc_id::VARCHAR, '')) AS h
  FROM documents
), c AS (
  SELECT *, CASE WHEN size <= 0 THEN 0 ELSE (LEN(BIN(size)) - 1) * 8 + ((size << 3) >> (LEN(BIN(size)) - 1)::INT) - 7 END AS cls
  FROM k
), s AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         ROW_NUMBER() OVER (ORDER BY source ASC NULLS LAST) - 1 AS i
  FROM c GROUP BY source
), w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(i % 3 + 1)::INT] AS wt, source_size * 2.0::DOUBLE AS cp FROM s
), l AS (
  SELECT *, (SUM(source_size) OVER () * 1.5::DOUBLE - COALESCE(SUM(cp) OVER p, 0.0::DOUBLE))
            / (SUM(wt) OVER () - COALESCE(SUM(wt) OVER p, 0.0::DOUBLE)) AS lv
  FROM w WINDOW p AS (ORDER BY cp / wt, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
  SELECT source, source_size,
         COALESCE(LEAST(cp, (SELECT ARG_MIN(lv, (cp / wt, i)) FROM l WHERE cp / wt >= lv) * wt), cp) AS target,
         CAST('0x' || SUBSTR(MD5('42/' || COALESCE(source, '')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM l
), r AS (
  SELECT c.doc_id, c.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
         ROW_NUMBER() OVER (PARTITION BY c.source ORDER BY c.cls, c.h, c.doc_id, c.size) AS n
  FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * LEAST(FLOOR(u + rate * n) - FLOOR(u + rate * (n - 1)), CEIL(rate)))::BIGINT AS taken
FROM r
"""
