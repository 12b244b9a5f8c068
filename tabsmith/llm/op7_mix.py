"""Mixing sources to target weights.

Every document gets a hash-random key (md5 of its id and a seed), which puts
each source into one reproducible random order.  The leading bits of the key
cut that order into range cells; one map-side-combined aggregation gives the
cell totals, a prefix sum over the cells of a source finds the cell in which
the source's budget ends, and only the rows of that one cell are sorted to find
the row at which it ends.  What is left is one *cut* per source (a row of a
small table), so each document's share is decided where the document is read:
no row is shuffled, however many rows one source holds.

A budget beyond the source's size repeats whole epochs; the remainder is cut at
the exact word.

Defined cases: null or empty text has size 0 and takes 0; a null source is a
source of its own, ordered last; rows equal in id and text are interchangeable
and share the words left at the cut evenly; a source of size 0 has target 0; an
empty table gives an empty result.  Extra columns are ignored by the digest and
kept by :func:`apply_mix`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.session import materialize

from .common import SPACE_CLASS, numbered, safe, word_count

#: Rows a range cell holds on average; only a source's last cell is sorted.
ROWS_PER_CELL = 1024
#: The table of cuts is broadcast up to so many sources, joined by shuffle beyond.
MAX_BROADCAST_SOURCES = 50_000


def source_targets(totals: DataFrame, weights: Sequence[int], share: float,
                   max_epochs: int) -> DataFrame:
    """(source, source_size) -> target words of each source.

    Sources by code point, null last, take the weights in turn.  A source never
    gets more than ``max_epochs`` times its size; what it can't take is reshared
    by weight.  That fixed point is found in one pass: ordered by size over
    weight, a source is full exactly if its fill level lies under the level that
    the sources from it onwards would share.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = totals.withColumn(
        "rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    by_level = everything.orderBy("level", "rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    filled = (ranked.withColumn("weight", weight.cast("long"))
              .withColumn("cap", F.col("source_size") * max_epochs)
              .withColumn("level", F.col("cap") / F.col("weight"))
              .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("left_budget",
                          F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("left_weight", F.sum("weight").over(everything)
                          - F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("share_level", F.col("left_budget") / F.col("left_weight"))
              .withColumn("full", F.col("level") <= F.col("share_level")))
    # The level is the one at the first source that isn't full; when all are
    # full no source needs it.
    common = F.min(F.when(~F.col("full"), F.struct("level", "rank", "share_level"))).over(everything)
    return filled.select(
        "source", "source_size",
        F.when(F.col("full") | common.isNull(), F.col("cap").cast("double"))
        .otherwise(F.col("weight") * common["share_level"]).alias("target"))


def _key(id_col: str, seed: str) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                          F.lit(f":{seed}")))


def _key_bits(key: Column, bits: int) -> Column:
    """The leading bits of a hexadecimal key, up to 28."""
    return F.shiftright(F.conv(F.substring(key, 1, 7), 16, 10).cast("long"), 28 - bits)


def _keyed(docs: DataFrame, seed: str, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """Adds the mix's own columns under one struct, so that no name can clash."""
    return docs.select(
        F.struct(F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"),
                 _key(f"`{id_col}`", seed).alias("key"),
                 F.xxhash64(F.col(f"`{text_col}`")).alias("tie")).alias("__mix"),
        *[F.col(f"`{c}`") for c in docs.columns])


def plan_mix(keyed: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5,
             max_epochs: int = 2) -> DataFrame:
    """One row per source: source, source_size, target, epochs (whole passes)
    and the cut, i.e. the row (key, size, tie) at which the last pass ends, with
    the words that each of the rows equal to it still gives."""
    rows = keyed.select("__mix.source", "__mix.size", "__mix.key", "__mix.tie")
    n = rows.count()
    bits = min(28, max(0, (max(n, 1) // ROWS_PER_CELL).bit_length()))
    rows = rows.withColumn("cell", _key_bits(F.col("key"), bits))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")),
                             weights, share, max_epochs)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0,
                    F.expr("cast(floor(target) as long) div source_size")).otherwise(F.lit(0)).cast("long")
    targets = (targets.withColumn("epochs", epochs)
               .withColumn("rest", F.when(F.col("source_size") > 0,
                                          budget - F.col("epochs") * F.col("source_size")).otherwise(F.lit(0))))
    in_order = Window.partitionBy("source").orderBy("cell")
    last_cells = (cells.withColumn("before", F.sum("cell_size").over(in_order) - F.col("cell_size"))
                  .join(targets.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
                  .where((F.col("before") <= F.col("rest"))
                         & (F.col("rest") < F.col("before") + F.col("cell_size")))
                  .select("s", F.col("cell").alias("last_cell"), (F.col("rest") - F.col("before")).alias("rest_in_cell")))
    # One cell of each source: rows equal in order are summed first.
    tied = materialize(rows.join(last_cells, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("last_cell")))
                       .groupBy("source", "rest_in_cell", "key", "size", "tie").agg(F.count("*").alias("n")), "mix-cell")
    # An id that repeats has all its texts at one key: down to one key, then one size.
    for level in ("key", "size"):
        sums = tied.groupBy("source", "rest_in_cell", level).agg(F.sum(F.col("size") * F.col("n")).alias("part"))
        in_level = Window.partitionBy("source").orderBy(level)
        here = (sums.withColumn("before", F.sum("part").over(in_level) - F.col("part"))
                .where((F.col("before") <= F.col("rest_in_cell")) & (F.col("rest_in_cell") < F.col("before") + F.col("part")))
                .select(F.col("source").alias("s"), F.col(level).alias("at"), (F.col("rest_in_cell") - F.col("before")).alias("rest")))
        tied = (tied.join(here, F.col("source").eqNullSafe(F.col("s")) & (F.col(level) == F.col("at")))
                .select("source", F.col("rest").alias("rest_in_cell"), "key", "size", "tie", "n"))
    row_order = Window.partitionBy("source").orderBy("key", "size", "tie")
    cuts = (tied.withColumn("here", F.col("size") * F.col("n"))
            .withColumn("before", F.sum("here").over(row_order) - F.col("here"))
            .where((F.col("before") <= F.col("rest_in_cell"))
                   & (F.col("rest_in_cell") < F.col("before") + F.col("here")))
            .select(F.col("source").alias("s"),
                    F.struct("key", "size", "tie").alias("cut"),
                    F.expr("(rest_in_cell - before) div n").alias("cut_words")))
    return (targets.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("source", "source_size", "target", "epochs", "cut", "cut_words"))


def _with_plan(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """Each row with its source's plan and the words of its last, partial pass."""
    plan = plan.select(F.struct("*").alias("__plan"))
    if plan.count() <= MAX_BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    at = F.struct("__mix.key", "__mix.size", "__mix.tie")
    extra = (F.when(F.col("__plan.cut").isNull(), F.lit(0))
             .when(at < F.col("__plan.cut"), F.col("__mix.size"))
             .when(at == F.col("__plan.cut"), F.col("__plan.cut_words")).otherwise(F.lit(0)))
    return (keyed.join(plan, F.col("__mix.source").eqNullSafe(F.col("__plan.source")))
            .withColumn("__extra", extra.cast("long")))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2,
        seed: str = "mix-1", id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """Digest of the mix: (id, size, source_size, target, taken) per document.

    The texts are read once; sizes and keys are kept in the shared folder.
    """
    keyed = _keyed(safe(docs, id_col, source_col, text_col), seed, id_col, source_col, text_col)
    keyed = materialize(keyed.select("__mix", F.col(f"`{id_col}`")), "mix-keys")
    plan = materialize(plan_mix(keyed, weights, share, max_epochs), "mix-plan")
    return _with_plan(keyed, plan).select(
        F.col(f"`{id_col}`"), F.col("__mix.size").alias("size"), F.col("__plan.source_size").alias("source_size"),
        F.col("__plan.target").alias("target"),
        (F.col("__plan.epochs") * F.col("__mix.size") + F.col("__extra")).alias("taken"))


def apply_mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, max_epochs: int = 2,
              seed: str = "mix-1", id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: a row for each pass that
    takes words of a document.  The one row per source at which its budget ends
    holds the words that the budget still takes; ``length_col``, if given, is
    set to that text's characters."""
    names, kinds = docs.columns, [f.dataType for f in docs.schema.fields]
    docs, (id_col, source_col, text_col) = numbered(docs, id_col, source_col, text_col)
    keyed = _keyed(docs, seed, id_col, source_col, text_col)
    small = materialize(keyed.select("__mix"), "mix-keys")
    plan = materialize(plan_mix(small, weights, share, max_epochs), "mix-plan")
    rows = _with_plan(keyed, plan)
    size, extra = F.col("__mix.size"), F.col("__extra")
    whole = F.when(size > 0, F.col("__plan.epochs") + (extra == size).cast("long")).otherwise(F.lit(0))
    part = (extra > 0) & (extra < size)
    passes = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole.cast("int")),
                      F.when(part, F.array(extra)).otherwise(F.array().cast("array<bigint>")))
    text = F.col(f"`{text_col}`")
    trimmed = F.regexp_replace(text, f"^[{SPACE_CLASS}]+", "")
    # What stands behind the words taken is the last piece of a limited split.
    behind = F.element_at(F.split(trimmed, f"[{SPACE_CLASS}]+", F.col("__words").cast("int") + 1), -1)
    cut_text = F.regexp_replace(F.left(trimmed, F.length(trimmed) - F.length(behind)), f"[{SPACE_CLASS}]+$", "")
    rows = rows.withColumn("__words", F.explode(passes))
    new_text = F.when(F.col("__words") < 0, text).otherwise(cut_text)
    columns = {c: F.col(c) for c in docs.columns}
    columns[text_col] = new_text
    if length_col in names:
        at = names.index(length_col)
        columns[f"c{at}"] = F.when(F.col("__words") < 0, F.col(f"c{at}")).otherwise(F.length(new_text)).cast(kinds[at])
    return rows.select(*[c.alias(n) for n, c in zip(names, columns.values(), strict=True)])


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(doc_id::VARCHAR || ':mix-1') AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
      FROM d GROUP BY source),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS share_level
      FROM w),
t AS (SELECT source, source_size, CASE WHEN cap::DOUBLE / weight <= share_level THEN cap::DOUBLE
        ELSE weight * (SELECT arg_min(share_level, (cap::DOUBLE / weight, rank)) FROM l WHERE cap::DOUBLE / weight > share_level) END AS target FROM l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
o AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.epochs, floor(b.target)::BIGINT - b.epochs * b.source_size AS rest,
        (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM o
"""
