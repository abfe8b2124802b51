"""Operator 12: mixing sources to target weights by pivotal dependent rounding.

All of it is DataFrame expressions.

1. A document's size is its number of words. Rows that agree in id, source,
   text and size are interchangeable and go on as one row with their number.
2. Sources in code-point order, null last, weigh 1, 2, 3, repeating, and share the
   words of all documents by weight. A target stops at ``cap`` times its source's
   words; what is over is shared again until no target is above. A source is above
   as soon as weight * rest / (weights left) is, and that level only rises, so a
   round needs no more than two sums of the sources.
3. A document is copied target / source size times on average: the whole part for
   certain, the fraction by dependent rounding. Fractions of one source are dealt in
   blocks of about BLOCK, and a block is folded: a pair exchanges mass, so that size times
   probability of the two stays the same, up or down with the chance that keeps either
   expectation, until one of the two is 0 or 1; the other meets the next. What a block
   has left over is an item of the next level, in blocks again: a tree of reductions.
   The last item of a source is drawn by its own probability. So a source's words miss
   its target by less than one document.

Draws are hashes of the rows and the seed: reruns agree, however rows are partitioned.
No group is larger than a block, and a hot source is spread over salts where its target is joined.

A null or empty text has size 0 and is taken for 0 words. A null id is an id of its own, a null
source a source. Of repeated rows each may be copied, and copies may differ by one.
An empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from candela.llm import text as tx

BLOCK = 128
SALTS = 64
#: Repeated rows are given out again in runs of so many.
RUN = 10_000
WHOLE = "decimal(38,0)"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def documents_by_key(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(source, item: (id, size, mark), rows): interchangeable rows as one."""
    text = F.col(text_col).cast("string")
    item = F.struct(F.col(id_col).cast("long").alias("id"), words_of(text).alias("size"), F.xxhash64(text).alias("mark"))
    return docs.select(F.col(source_col).cast("string").alias("source"), item.alias("item")).groupBy("source", "item").agg(F.count("*").alias("rows"))


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``place``, from 0, by code point, null last: places in ranges of sources, and the ranges' offsets."""
    ranges = sources.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id())
    ranges = tx.write_table(ranges, "mix-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = ranges.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))
    return ranges.join(offsets, "part").select("*", (F.row_number().over(within) - 1 + F.col("offset")).alias("place")).drop("part", "offset")


def source_targets(items: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, items, weight, target) of all sources."""
    sources = items.groupBy("source").agg(F.sum(F.col("item.size") * F.col("rows")).alias("source_size"), F.count("*").alias("items"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = tx.write_table(_ranked(sources).select("source", "source_size", "items", weight.cast("long").alias("weight")), "mix-sources")
    most = (F.col("source_size") * cap).cast(WHOLE)

    def above(rest: int, left: int) -> Column:
        return F.col("weight").cast(WHOLE) * F.lit(str(rest)).cast(WHOLE) > most * F.lit(str(left)).cast(WHOLE)

    start = sources.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    rest, left, capped = start.size or 0, start.weight or 1, 0
    while True:
        over = above(rest, left)
        row = sources.agg(
            F.count_if(over).alias("n"), F.sum(F.when(over, most)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("weight")
        ).first()
        if row.n == capped:
            break
        capped, rest, left = row.n, start.size - int(row.full), row.weight or 1
    share = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(left))
    return sources.withColumn("target", F.when(above(rest, left), most.cast("double")).otherwise(share))


def _draw(seed: int, *of: str) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 11) / F.lit(float(1 << 53))


_DONE = "array<struct<item:struct<id:bigint,size:bigint,mark:bigint>,up:boolean>>"


def _fold(members: str) -> str:
    """SQL of the pairwise exchange along ``members``: (item, p) of what is left, and the decided items."""
    # c is what is carried, x the next; shares are what the other's mass is worth to either
    to_c, to_x = "(x.item.size / c.item.size)", "(c.item.size / x.item.size)"
    rise, fall = f"least(1 - c.p, x.p * {to_c})", f"least(c.p, (1 - x.p) * {to_c})"
    up = f"(x.u * ({rise} + {fall}) < {fall})"
    ends = f"if({up}, 1 - c.p <= x.p * {to_c}, c.p <= (1 - x.p) * {to_c})"
    next_p = f"if({ends}, if({up}, x.p - (1 - c.p) * {to_x}, x.p + c.p * {to_x}), if({up}, c.p + x.p * {to_c}, c.p - (1 - x.p) * {to_c}))"
    step = (
        f"named_struct('item', if({ends}, x.item, c.item), 'p', least(1D, greatest(0D, {next_p})), "
        f"'done', concat(c.done, array(named_struct('item', if({ends}, c.item, x.item), 'up', if({ends}, {up}, NOT {up})))))"
    )
    start = f"named_struct('item', {members}[0].item, 'p', {members}[0].p, 'done', CAST(array() AS {_DONE}))"
    return f"aggregate(slice({members}, 2, size({members})), {start}, (c, x) -> {step})"


def rounded(items: DataFrame, seed: int) -> DataFrame:
    """(source, item, up): the dependent rounding of ``items`` (source, item, p, blocks); sizes are above 0.

    ``blocks`` is the number of blocks of the source at the first level.
    """
    depth = items.agg(F.max("blocks")).first()[0]
    outcomes, level = [], 0
    while depth:
        block = F.pmod(F.xxhash64(F.lit(seed + level), "source", "item"), F.col("blocks"))
        member = F.struct(_draw(seed + level, "item", "source").alias("u"), "item", "p")
        groups = items.groupBy("source", "blocks", block.alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
        folded = groups.select("source", "blocks", F.expr(_fold("members")).alias("c"))
        folded = tx.write_table(folded, f"mix-level-{level}")
        outcomes.append(folded.select("source", F.inline("c.done")))
        items = folded.select("source", "c.item", "c.p", F.ceil(F.col("blocks") / BLOCK).alias("blocks"))
        if depth == 1:
            break
        depth, level = math.ceil(depth / BLOCK), level + 1
    last = items.select("source", "item", (_draw(seed - 1, "item", "source") < F.col("p")).alias("up"))
    for outcome in outcomes:
        last = last.unionByName(outcome)
    return last


def allocation(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 17, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(source, id, size, mark, rows, source_size, target, copies, more): of ``rows`` equal rows all are copied ``copies`` times, and
    ``more`` of them once more."""
    items = tx.write_table(documents_by_key(docs, id_col, text_col, source_col), "mix-items")
    targets = source_targets(items, weights, cap)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.pmod(F.xxhash64("item"), F.lit(SALTS)).cast("int")
    known = F.struct("source", "salt")  # structs with null fields are equal
    left = items.withColumn("salt", salt).withColumn("at", known).drop("source", "salt")
    right = targets.withColumn("salt", salts).withColumn("at", known).drop("source", "salt")
    each = F.coalesce(F.col("target") / F.nullif(F.col("source_size").cast("double"), F.lit(0.0)), F.lit(0.0))
    planned = left.join(right, "at").select("at.source", "item", "rows", "source_size", "target", "items", each.alias("each"))
    extra = (F.col("each") - F.floor("each")) * F.col("rows")
    extra = F.when(F.col("item.size") > 0, extra).otherwise(F.lit(0.0))
    planned = planned.select(
        "source", "item", "rows", "source_size", "target", F.floor("each").alias("copies"), F.floor(extra).alias("sure"),
        (extra - F.floor(extra)).alias("p"), F.ceil(F.col("items") / BLOCK).alias("blocks"),
    )
    planned = tx.write_table(planned, "mix-planned")
    drawn = rounded(planned.filter("p > 0").select("source", "item", "p", "blocks"), seed)
    drawn = drawn.select(F.struct("source", "item").alias("at"), F.col("up").cast("long").alias("up"))
    found = planned.withColumn("at", F.struct("source", "item")).join(drawn, "at", "left")
    return found.select("source", "item.id", "item.size", "item.mark", "rows", "source_size", "target", "copies", (F.col("sure") + F.coalesce("up", F.lit(0))).alias("more"))


def per_row(allocated: DataFrame) -> DataFrame:
    """A row for each document row again: ``copies`` of it are in the mix."""
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / RUN)))
    run = allocated.withColumn("run", runs)
    last = F.least(F.col("rows"), (F.col("run") + 1) * RUN)
    row = run.withColumn("row", F.explode(F.sequence(F.col("run") * RUN + 1, last)))
    return row.withColumn("copies", F.col("copies") + (F.col("row") <= F.col("more")).cast("long")).drop("run", "row", "more", "rows")


def mixture(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3, seed: int = 17, id_col: str = "doc_id",
            text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken.

    Equal rows (id, source, text) are taken as one: that of the least hash stands for all copies.
    """
    text = F.col(text_col).cast("string")
    item = F.struct(F.col(id_col).cast("long").alias("id"), words_of(text).alias("size"), F.xxhash64(text).alias("mark"))
    at = F.struct(F.col(source_col).cast("string").alias("source"), item.alias("item"))
    rows = docs.select(at.alias("_at"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.groupBy("_at").agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row"))
    plan = allocation(docs, weights, cap, seed, id_col, text_col, source_col)
    times = (F.col("copies") * F.col("rows") + F.col("more")).alias("_times")
    plan = plan.select(F.struct("source", F.struct("id", "size", "mark").alias("item")).alias("_at"), times).filter("_times > 0")
    chosen = rows.join(plan, "_at").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_times") - 1) / RUN))))
    copy = F.sequence(F.col("_run") * RUN + 1, F.least(F.col("_times"), (F.col("_run") + 1) * RUN))
    return chosen.select("_row", F.explode(copy)).select("_row.*")


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = per_row(allocation(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
