"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. Documents of a source are expected to be taken
``min(max_repeat, level * weight)`` times; a document's weight is ``FLOOR`` plus the number of binary digits of
its size, so that long documents are taken somewhat more often than short ones, and the source's
level is such that the expected words are its target. The whole part of that number are certain
copies. Its fractional part is the document's own inclusion probability ``pi_i`` in a Pareto order
sample: document i has rank ``odds(u_i) / odds(pi_i)`` with a reproducible uniform ``u_i``, and ranks are
taken in ascending order until the words that certain copies leave of the target are used up.

Scale: levels need one row per source and size class (at most 64). The rank cut of a source is found
without sorting the source: ranks are mapped to (0, 1) and summed in ``GRID`` cells per source
(pre-aggregated before the shuffle), the cell that holds the cut is cut into ``GRID`` cells again, and only
the one among these that holds the cut is ordered. A source with a third of all rows costs no more per
task than any other. Sources are few beside documents: their table, one row each, is ordered as a whole.

Edge cases: null text has size 0 and is never taken by the draw; a null source is a source of
its own, last in order; rows of equal id, source and text are numbered, and each number is a draw of
its own, so that neither repeated nor null ids form a block; an empty table gives an empty result; extra
columns pass through untouched (of rows equal in id, source and text, the least by the other columns
stands for all).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, table, uniform

GRID = 4096
FLOOR = 8
REPEATS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def source_targets(per: DataFrame, weights=(5, 2, 1), max_repeat: float = 3.0) -> DataFrame:
    """source, source_size to source, source_size, target.

    Targets are a water level: level * weight, cut at ``max_repeat * source_size``, with the
    level chosen so that targets sum to the sum of all sizes. Sources in order of
    limit / weight are capped from the front; the level after the last capped one is closed
    form, so no iteration is needed. Only the (small) table of sources is ordered as a whole.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("place", (F.row_number().over(order) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") + 1)
    per = per.withColumn("w", weight).withColumn("limit", F.col("source_size") * F.lit(float(max_repeat)))
    fill = Window.orderBy((F.col("limit") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = (
        per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("limit_before", F.coalesce(F.sum("limit").over(upto), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
        .withColumn("level_here", (F.col("total") - F.col("limit_before")) / F.col("w_left"))
    )
    # the first source that its level does not push over its limit sets the level for all after it
    free = F.when(F.col("level_here") * F.col("w") <= F.col("limit"), F.col("level_here"))
    per = per.withColumn("level", F.first(free, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("w"), F.col("limit")))
    return per.withColumn("target", target).select("source", "source_size", "target")


def size_class(size: Column) -> Column:
    """Binary digits of a size, 0 for 0."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("bigint")


def class_plan(units: DataFrame, weights=(5, 2, 1), max_repeat: float = 3.0) -> DataFrame:
    """One row per source and size class: source, class, source_size, target, whole, pi.

    A source's level is closed form like the level of all sources: classes in descending order of
    weight reach ``max_repeat`` first.
    """
    classes = units.groupBy("source", "class").agg(F.sum(F.col("size") * F.col("m")).alias("words"))
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat)
    targets = targets.withColumnRenamed("source", "_source")
    by = Window.partitionBy("source").orderBy(F.desc("class"))
    c = classes.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn("w", F.col("class") + FLOOR)
    capped = F.coalesce(F.sum("words").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))
    left = F.sum(F.col("w") * F.col("words")).over(by.rowsBetween(0, Window.unboundedFollowing))
    here = F.when(left > 0, (F.col("target") - max_repeat * capped) / left)
    c = c.withColumn("here", here)
    free = F.when(F.col("here") * F.col("w") <= max_repeat, F.col("here"))
    c = c.withColumn("level", F.first(free, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    c = c.withColumn("expected", F.least(F.lit(float(max_repeat)), F.coalesce(F.col("level") * F.col("w"), F.lit(float(max_repeat)))))
    c = c.withColumn("whole", F.floor("expected")).withColumn("pi", F.col("expected") - F.col("whole"))
    return c.select("source", "class", "words", "source_size", "target", "whole", "pi")


def rank(u: Column, pi: Column) -> Column:
    """Pareto rank q = odds(u) / odds(pi), mapped to q / (1 + q) in [0, 1); null where pi is 0."""
    q = (u / (F.lit(1.0) - u)) / F.nullif(pi / (F.lit(1.0) - pi), F.lit(0.0))
    return q / (F.lit(1.0) + q)


def draw(doc_id: Column, digest: Column, number: Column) -> Column:
    """The uniform number of a document's draw; ``number`` from 1 among rows of equal id, source and text."""
    return uniform(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(":"), number.cast("string"))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, digest of the text."""
    return docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("digest")
    )


def sized(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Units: a row per distinct id, source and text with its number of rows ``m``; and rows: each unit's
    rows by number, with the draw of each."""
    units = measured(docs).groupBy("doc_id", "source", "digest", "size").agg(F.count(F.lit(1)).alias("m"))
    units = cut(spark, units.withColumn("class", size_class(F.col("size"))), "mix-units")
    number = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m")))
    rows = units.where(F.col("m") <= REPEATS).withColumn("number", number)
    # many rows of one unit: dealt to tasks by the block of their numbers
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("m") - 1) / REPEATS)))
    many = units.where(F.col("m") > REPEATS).withColumn("block", block).repartition("doc_id", "digest", "block")
    low = F.col("block") * REPEATS
    many = many.withColumn("number", F.explode(F.sequence(low + 1, F.least(low + REPEATS, F.col("m"))))).drop("block")
    rows = rows.unionByName(many)
    return units, rows.select("doc_id", "source", "digest", "size", "m", "class", draw(F.col("doc_id"), F.col("digest"), F.col("number")).alias("u"))


def mixing_plan(spark: SparkSession, units: DataFrame, rows: DataFrame, weights=(5, 2, 1), max_repeat: float = 3.0) -> DataFrame:
    """class_plan plus the rank cut of each source: documents of rank below ``low`` or up to ``cut`` get
    one copy more."""
    classes = cut(spark, class_plan(units, weights, max_repeat), "mix-classes")
    plan = classes.select(F.col("source").alias("s"), F.col("class").alias("c"), "whole", "pi")
    rest = classes.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("whole") * F.col("words")).alias("certain"))
    rest = rest.select(F.col("source").alias("rs"), (F.col("target") - F.col("certain")).alias("rest"))
    drawn = (
        rows.where("size > 0").join(plan.where("pi > 0"), F.col("source").eqNullSafe(F.col("s")) & (F.col("class") == F.col("c")))
        .select("s", "size", rank(F.col("u"), F.col("pi")).alias("p"))
        .withColumn("fine", F.floor(F.col("p") * (GRID * GRID)))
        .withColumn("cell", F.floor(F.col("fine") / GRID))
    )

    def edge(cells: DataFrame, before: DataFrame, name: str) -> DataFrame:
        """The cell of each source that holds its cut: s, name, before (words up to it)."""
        cells = cells.join(before, F.col("s").eqNullSafe(F.col("rs")))
        upto = F.sum("words").over(Window.partitionBy("s").orderBy(name).rowsBetween(Window.unboundedPreceding, 0))
        cells = cells.withColumn("upto", F.col("before") + upto)
        return cells.where("upto >= rest and upto - words < rest").select(F.col("s").alias("rs"), F.col(name).alias("edge"), (F.col("upto") - F.col("words")).alias("before"), "rest")

    coarse = edge(drawn.groupBy("s", "cell").agg(F.sum("size").alias("words")), rest.withColumn("before", F.lit(0).cast("bigint")), "cell")
    inside = drawn.join(coarse, F.col("s").eqNullSafe(F.col("rs")) & (F.col("cell") == F.col("edge")))
    coarse = coarse.drop("edge")
    fine = cut(spark, edge(inside.groupBy("s", "fine").agg(F.sum("size").alias("words")), coarse, "fine"), "mix-edge")
    last = drawn.join(fine, F.col("s").eqNullSafe(F.col("rs")) & (F.col("fine") == F.col("edge")))
    last = last.groupBy("s", "edge", "p").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    last = last.withColumn("upto", F.col("before") + F.sum("words").over(Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)))
    cuts = last.groupBy("s").agg(
        (F.first("edge") / F.lit(float(GRID * GRID))).alias("low"), F.max(F.when(F.col("upto") - F.col("words") / 2 <= F.col("rest"), F.col("p"))).alias("cut")
    )
    plan = classes.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").withColumns({"low": F.coalesce("low", F.lit(0.0)), "cut": F.coalesce("cut", F.lit(-1.0))})
    names = {"source": "plan_source", "class": "plan_class"}
    return cut(spark, plan.select(*[F.col(c).alias(names.get(c, c)) for c in (*classes.columns, "low", "cut") if c != "words"]), "mix-plan")


def _planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (source, class, size, u) with the number of copies of each."""
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("class") == F.col("plan_class")))
    p = rank(F.col("u"), F.col("pi"))
    extra = (F.col("size") > 0) & (F.col("pi") > 0) & ((p < F.col("low")) | (p <= F.col("cut")))
    return joined.withColumn("copies", F.col("whole") + F.when(extra, 1).otherwise(0))


def mix(spark: SparkSession, docs: DataFrame, weights=(5, 2, 1), max_repeat: float = 3.0) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    units, rows = sized(spark, docs)
    return _planned(rows, mixing_plan(spark, units, rows, weights, max_repeat)).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def apply_mix(spark: SparkSession, docs: DataFrame, weights=(5, 2, 1), max_repeat: float = 3.0) -> DataFrame:
    """The mixed corpus: every document as many times as the mix takes it, with its columns."""
    units, rows = sized(spark, docs)
    plan = mixing_plan(spark, units, rows, weights, max_repeat)
    repeated = units.where("m > 1").select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest"))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    texts = docs.select(own, "doc_id", "source", word_count(F.col("text")).alias("size"), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("digest"))
    texts = texts.withColumn("class", size_class(F.col("size")))

    def taken(some: DataFrame) -> DataFrame:
        return some.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select("_row.*")

    if repeated.isEmpty():
        return taken(_planned(texts.withColumn("u", draw(F.col("doc_id"), F.col("digest"), F.lit(1))), plan))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("digest") == F.col("_digest"))
    once = texts.join(repeated, same, "left_anti")
    once = taken(_planned(once.withColumn("u", draw(F.col("doc_id"), F.col("digest"), F.lit(1))), plan))
    order = F.struct(*[F.col(f"_row.`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()])
    first = texts.join(repeated, same, "left_semi").groupBy("doc_id", "source", "digest").agg(F.min_by("_row", order).alias("_row"))
    total = _planned(rows.where("m > 1"), plan).groupBy("doc_id", "source", "digest").agg(F.sum("copies").alias("copies"))
    total = total.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest"), "copies")
    # copies of one row: dealt to tasks by blocks
    many = first.join(total, same).where("copies > 0").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / REPEATS))))
    many = many.repartition("digest", "block").withColumn("copies", F.least(F.lit(REPEATS).cast("bigint"), F.col("copies") - F.col("block") * REPEATS))
    return once.unionByName(taken(many))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = rf"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size, coalesce(md5(text), '') AS digest,
         row_number() OVER (PARTITION BY doc_id, source, text) AS number
  FROM documents),
rows_ AS (
  SELECT doc_id, source, size, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS class,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || digest || ':' || number), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM sizes),
per0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM rows_ GROUP BY source),
per1 AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS place FROM per0),
per2 AS (SELECT *, CASE place WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, source_size * 3.0::DOUBLE AS lim FROM per1),
per3 AS (SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
         coalesce(sum(lim) OVER f, 0)::DOUBLE AS lim_before, sum(w) OVER () - coalesce(sum(w) OVER f, 0) AS w_left
         FROM per2 WINDOW f AS (ORDER BY lim / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
per4 AS (SELECT *, (total - lim_before) / w_left AS here FROM per3),
lev AS (SELECT here AS level FROM per4 WHERE here * w <= lim ORDER BY lim / w, source NULLS LAST LIMIT 1),
per AS (SELECT source, source_size, least(lim, coalesce((SELECT level FROM lev) * w, lim)) AS target FROM per4),
cls0 AS (SELECT source, class, class + {FLOOR} AS cw, sum(size)::BIGINT AS words FROM rows_ GROUP BY source, class),
cls1 AS (SELECT c.*, per.source_size, per.target,
         coalesce(sum(words) OVER (PARTITION BY c.source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
         sum(cw * words) OVER (PARTITION BY c.source ORDER BY class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS remaining
         FROM cls0 c JOIN per ON c.source IS NOT DISTINCT FROM per.source),
cls2 AS (SELECT *, CASE WHEN remaining > 0 THEN (target - 3.0::DOUBLE * capped) / remaining END AS here FROM cls1),
cls3 AS (SELECT *, first_value(CASE WHEN here * cw <= 3.0 THEN here END IGNORE NULLS)
         OVER (PARTITION BY source ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS level FROM cls2),
cls4 AS (SELECT *, least(3.0::DOUBLE, coalesce(level * cw, 3.0::DOUBLE)) AS expected FROM cls3),
cls AS (SELECT *, floor(expected)::BIGINT AS whole, expected - floor(expected) AS pi,
        target - sum(floor(expected)::BIGINT * words) OVER (PARTITION BY source) AS rest FROM cls4),
drawn AS (SELECT s.*, cls.source_size, cls.target, cls.whole, cls.rest,
          CASE WHEN pi > 0 AND size > 0 THEN (u / (1.0 - u)) / (pi / (1.0 - pi)) END AS q
          FROM rows_ s JOIN cls ON s.source IS NOT DISTINCT FROM cls.source AND s.class = cls.class),
ranked AS (SELECT *, q / (1.0 + q) AS p FROM drawn),
cum AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
        sum(size) OVER (PARTITION BY source, p) AS tied FROM ranked WHERE p IS NOT NULL)
SELECT doc_id, size, source_size, target, (whole + CASE WHEN upto - tied / 2.0 <= rest THEN 1 ELSE 0 END) * size AS taken FROM cum
UNION ALL
SELECT doc_id, size, source_size, target, whole * size AS taken FROM ranked WHERE p IS NULL
"""
