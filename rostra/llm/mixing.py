"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostra.llm.common import cut, fresh, n_words, numbered

#: Within this much of an integer, a copy count is that integer.
EXACT = 1e-9


def source_targets(sources: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, source_size -> and weight, target.

    Sources in code-point order, null last, weigh weights in turn. A target is a weight's share of the total
    but at most `most` times its source; the excess is shared by weight among the others until none is above.
    With sources in the order of limit / weight, the water level is that of the first one that isn't filled, and
    those after it would give lower ones.
    One row a source: the number of sources bounds the windows over all of them.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward, every = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    return (
        weighed.withColumn("level", level)
        .withColumn("water", F.max(F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.col("level"))).over(every))
        .select("source", "source_size", "weight", F.least("limit", F.coalesce(F.col("water") * F.col("weight"), F.col("limit"))).alias("target"))
    )


def _chance(*of: Column) -> Column:
    """A number in [0, 1) that the values of `of` decide."""
    return F.pmod(F.xxhash64(*of), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _drawn(*of: Column) -> list[Column]:
    """A unit's place among those of its size, and its draw: two numbers that have nothing to do with each other."""
    return [_chance(F.lit("place"), *of).alias("place"), _chance(F.lit("draw"), *of).alias("chance")]


#: One merge of a chunk's running residual `a` with the next unit `x`; v holds both and the chance. A unit has
#: a size, and a mass: its size times the probability of an additional copy. Mass moves from one to the other
#: until one of them has none or all; the direction's chance keeps both expected masses as they were.
_STEP = """
(a, x) -> if(a.unit is null, named_struct('unit', x.unit, 'size', x.size, 'mass', x.mass, 'done', a.done),
  element_at(transform(array(named_struct('up', least(a.size - a.mass, x.mass), 'down', least(a.mass, x.size - x.mass))), v ->
    if(x.chance * (v.up + v.down) < v.down,
      if(a.size - a.mass <= x.mass,
        named_struct('unit', x.unit, 'size', x.size, 'mass', a.mass + x.mass - a.size, 'done', concat(a.done, array(named_struct('unit', a.unit, 'up', 1)))),
        named_struct('unit', a.unit, 'size', a.size, 'mass', a.mass + x.mass, 'done', concat(a.done, array(named_struct('unit', x.unit, 'up', 0))))),
      if(a.mass <= x.size - x.mass,
        named_struct('unit', x.unit, 'size', x.size, 'mass', a.mass + x.mass, 'done', concat(a.done, array(named_struct('unit', a.unit, 'up', 0)))),
        named_struct('unit', a.unit, 'size', a.size, 'mass', a.mass + x.mass - x.size, 'done', concat(a.done, array(named_struct('unit', x.unit, 'up', 1))))))), 1))
"""


def _round_chunks(units: DataFrame, unit: str) -> DataFrame:
    """Rounds the units (source, chunk, unit, size, mass, place, chance) of each chunk but one, the residual.

    Large units come first, so that the residual tends to be a small one; those of a size go by `place`. The draw,
    `chance`, must not depend on the order, else a unit's turn would tell its fate.
    Gives source, chunk, done (array of unit and up) and the residual's unit, size and mass.
    """
    start = f"named_struct('unit', cast(null as {unit}), 'size', 0D, 'mass', 0D, 'done', cast(array() as array<struct<unit:{unit},up:int>>))"
    return (
        units.groupBy("source", "chunk")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("rank"), "place", "unit", "size", "mass", "chance"))).alias("units"))
        .select("source", "chunk", F.expr(f"aggregate(units, {start}, {_STEP})").alias("r"))
        .select("source", "chunk", "r.done", "r.unit", "r.size", "r.mass")
    )


def mix_counts(docs: DataFrame, size: Column, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 42, fan: int = 128) -> DataFrame:
    """How often a mix takes each document: source, doc_id, size, source_size, target, rows, copies.

    One row for documents alike in source, doc_id and size; rows says how many, copies how often all of
    them are taken together. The expected copies of each document are target / source_size; whole parts
    are taken, and the fractions of a source are rounded dependently: chunks of about `fan` units leave
    one residual each, the residuals of a source meet in chunks of the next level, up to one chunk, whose
    residual is rounded by chance. So a source's taken size differs from its target by less than its
    largest document. Chance comes from doc_id, size and seed only: reruns agree. Documents of size 0 are
    taken by whole parts alone; null sources are one source, null ids one id; long texts count by all their words;
    an empty table gives no rows; other columns are ignored.
    """
    alike = cut(docs.select("source", "doc_id", size.alias("size")).groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows")))
    sources = source_targets(alike.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units")).withColumnRenamed("units", "n"), weights, most)
    counts = alike.groupBy("source").agg(F.count("*").alias("n"))
    sources = cut(sources.alias("s").join(counts.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source"))).select("s.*", "c.n"))
    largest = sources.agg(F.max("n")).first()[0] or 0

    expected = F.col("rows") * F.least(F.lit(float(most)), F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0)))
    planned = (
        alike.alias("d")
        .join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("d.*", "source_size", "target", expected.alias("expected"), F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.ceil(F.col("n") / fan)).alias("chunk"))
        .withColumn("whole", F.floor(F.col("expected") + EXACT))
        .withColumn("mass", F.greatest(F.lit(0.0), F.col("expected") - F.col("whole")) * F.col("size"))
        .withColumn("open", F.col("mass") > F.col("size") * EXACT)
    )
    kind = f"struct<doc_id:{docs.schema['doc_id'].dataType.simpleString()},size:bigint,rows:bigint,whole:bigint,source_size:bigint,target:double>"
    unit = F.struct("doc_id", "size", "rows", "whole", "source_size", "target")
    level = cut(
        _round_chunks(
            planned.where("open").select("source", "chunk", unit.alias("unit"), F.col("size").cast("double").alias("size"), "mass", *_drawn(F.lit(seed), "doc_id", "size")), kind
        )
    )
    levels, chunks = [level], -(-largest // fan)
    while chunks > 1:
        chunks = -(-chunks // fan)
        upper = F.pmod(F.xxhash64("chunk", F.lit(seed + len(levels))), F.lit(chunks))
        levels.append(cut(_round_chunks(levels[-1].select("source", upper.alias("chunk"), F.col("chunk").alias("unit"), "size", "mass", *_drawn(F.lit(seed + len(levels)), "source", "chunk")), "bigint")))

    top = levels[-1]
    fate = top.select("source", "chunk", (_chance(F.lit(seed), F.lit("top"), "source") * F.col("size") < F.col("mass")).cast("int").alias("up"))
    for level in levels[:0:-1]:
        fate = _decided(level, fate).select("source", F.col("unit").alias("chunk"), "up")
    done = _decided(levels[0], fate)
    return done.select("source", "unit.*", "up").unionByName(planned.where("not open").select("source", "doc_id", "size", "rows", "whole", "source_size", "target", F.lit(0).alias("up"))).select(
        "source", "doc_id", "size", "source_size", "target", "rows", (F.col("whole") + F.col("up")).alias("copies")
    )


def _decided(level: DataFrame, fate: DataFrame) -> DataFrame:
    """All units of a level: those rounded in their chunk, and residuals as fate says."""
    rest = level.alias("l").join(fate.alias("f"), F.col("l.source").eqNullSafe(F.col("f.source")) & (F.col("l.chunk") == F.col("f.chunk"))).select("l.source", "l.unit", "f.up")
    return level.select("source", F.explode("done").alias("d")).select("source", "d.unit", "d.up").unionByName(rest)


def mix_manifest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, copies of every row of docs.

    Size is the number of words (0 for a null text). Rows alike in source, doc_id and size share their
    copies evenly, so no row is taken more than the limit. An empty table gives no rows.
    """
    mixed = mix_counts(docs, n_words(docs["text"]), **options)
    own = F.floor(F.col("copies") / F.col("rows")) + F.when(F.col("nth") < F.col("copies") % F.col("rows"), 1).otherwise(0)
    return (
        numbered(mixed.withColumn("zero", F.lit(0).cast("long")), "zero", "rows", "nth")
        .withColumn("copies", own.cast("long"))
        .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """docs, each row as often as the mix takes it; columns and order of columns stay.

    Rows alike in source, doc_id and size are taken evenly: those with the lower text first.
    """
    words = n_words(docs["text"])
    size, m_source, m_id, m_size, rows, copies, nth = (fresh(docs, x) for x in ("words", "mixed_source", "mixed_id", "mixed_size", "rows_alike", "copies", "nth"))
    mixed = mix_counts(docs, words, **options).select("source", "doc_id", "size", "rows", "copies").toDF(m_source, m_id, m_size, rows, copies)
    held = docs.withColumn(size, words).join(mixed, F.col("source").eqNullSafe(F.col(m_source)) & F.col("doc_id").eqNullSafe(F.col(m_id)) & (F.col(size) == F.col(m_size)))
    # Rows that are alike share one draw; the rank among them is only needed where there are several.
    alike = Window.partitionBy(m_source, m_id, m_size).orderBy("text")
    several = held.where(F.col(rows) > 1).withColumn(nth, F.row_number().over(alike) - 1)
    both = held.where(F.col(rows) == 1).withColumn(nth, F.lit(0)).unionByName(several)
    own = F.floor(F.col(copies) / F.col(rows)) + F.when(F.col(nth) < F.col(copies) % F.col(rows), 1).otherwise(0)
    return both.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array_repeat(F.lit(1), own.cast("int"))).alias(nth)).drop(nth)
