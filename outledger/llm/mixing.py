"""Mixing sources to target weights by Pareto order sampling; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from outledger.llm import frames

#: Cells of each of the two histograms of the ranking number.
CELLS = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target. `sizes` has one row per source.

    Sources in code-point order, NULL last, take the weights in turn and divide `share` of all
    words. A target stops at `most` times its source; the excess goes to the others by weight until
    none is above. That is the water level: the smallest level at which targets min(cap, level *
    weight) add up, found in one pass in the order of cap / weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    every = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.lit(most) * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("pool", F.lit(share) * F.sum("source_size").over(every))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("all_weight", F.sum("weight").over(every))
        # The level if exactly the sources before this one are at their caps.
        .withColumn("level", (F.col("pool") - F.col("caps_before")) / (F.col("all_weight") - F.col("weight_before")))
    )
    reached = F.struct(F.row_number().over(by_ratio).alias("place"), "level")
    first = F.min(F.when(F.col("level") <= F.col("ratio"), reached)).over(every)
    return ranked.withColumn("water", first["level"]).select(
        *sizes.columns,
        F.least("cap", F.coalesce(F.col("water"), F.col("ratio")) * F.col("weight")).alias("target"),
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, size, source_size, target, taken (words) and copies of every row.

    `carry` names columns of `df` that come out as they are, such as a row number.

    Each document gets floor(target / source_size) certain copies. The words still missing come from
    a Pareto order sample: with u from a hash of the id and inclusion odds in proportion to size,
    documents are taken by ascending (u / (1 - u)) / odds until half of the next one would go beyond
    the source's missing words. So a source ends within half a document of its target.

    The order inside a source is never sorted as a whole: two histograms of the ranking number (4,096
    cells each) lead to the cell with the boundary, and only that cell's rows are sorted.

    A NULL text has size 0 and so 0 words taken; a NULL source is a source
    of its own; a NULL id hashes as the empty text. Rows with one id rank by text; equal rows
    are taken together. An empty table gives no rows; a source without words has target 0.
    """
    docs = frames.pick(df, doc_id=id_col, text=text_col, source=source_col, **{f"carry_{c}": c for c in carry})
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    u = (F.conv(F.substring(key, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(2.0**48)
    rows = frames.stored(
        docs.select(
            "doc_id", "source", frames.n_words("text").alias("size"), u.alias("u"),
            F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("tie"),
            *[f"carry_{c}" for c in carry],
        )
        .withColumn("odds", F.when(F.col("size") > 0, F.col("u") / (1 - F.col("u")) / F.col("size")))
        .withColumn("name", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))),
        "mix-rows",
    )
    sizes = rows.groupBy("name", "source").agg(
        F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n")
    )
    has_words = F.col("source_size") > 0
    copies = F.when(has_words, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = frames.stored(
        source_targets(sizes, weights, share, most)
        .withColumn("copies", copies.cast("long"))
        .withColumn("missing", F.col("target") - F.col("copies") * F.col("source_size"))
        # The odds of a document of mean size at u = 1/2.
        .withColumn("middle", F.when(has_words, F.col("n") / F.col("source_size"))),
        "mix-targets",
    )
    # Grows with the odds, and spreads them over (0, 1) so that cells hold about equally many.
    place = 1 / (1 + F.col("middle") / F.col("odds"))
    cell = F.least(F.lit(CELLS * CELLS - 1), F.floor(place * CELLS * CELLS)).cast("int")
    placed = rows.drop("source").join(targets.drop("source"), "name").withColumn("cell", cell)
    sized = placed.filter("size > 0").withColumn("upper", F.floor(F.col("cell") / CELLS).cast("int"))

    first = _edge(sized, "upper", F.lit(0))
    inside = sized.join(first.withColumnRenamed("edge", "upper"), ["name", "upper"])
    second = frames.stored(_edge(inside, "cell", F.col("before")), "mix-edges")
    last = inside.drop("before").join(second.withColumnRenamed("edge", "cell"), ["name", "cell"])
    run = Window.partitionBy("name").orderBy("odds", "tie", F.col("doc_id").cast("string"))
    earlier = F.coalesce(F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fits = F.col("before") + F.col("earlier") + F.col("size") / 2 <= F.col("missing")
    cut = (
        last.withColumn("earlier", earlier).filter(fits)
        .groupBy("name").agg(F.max(F.struct("odds", "tie")).alias("cut"))
    )
    edges = frames.stored(second.join(cut, "name", "left").select("name", "edge", "cut"), "mix-cuts")
    chosen = (F.col("cell") < F.col("edge")) | (
        (F.col("cell") == F.col("edge")) & (F.struct("odds", "tie") <= F.col("cut"))
    )
    extra = F.when(F.coalesce(chosen, F.lit(False)), 1).otherwise(0)
    return (
        placed.join(edges, "name", "left")
        .withColumn("copies", F.when(F.col("size") > 0, F.col("copies") + extra).otherwise(F.col("copies")))
        .select(
            "doc_id", "size", "source_size", "target",
            (F.col("copies") * F.col("size")).alias("taken"), "copies",
            *[F.col(f"carry_{c}").alias(c) for c in carry],
        )
    )


def _edge(rows: DataFrame, cell: str, base) -> DataFrame:
    """name, edge (the cell in which a source's missing words run out) and the words before it."""
    held = rows.groupBy("name", "missing", base.alias("base"), cell).agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("name").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum("held").over(earlier), F.lit(0))
    return (
        held.withColumn("before", before)
        .filter((F.col("before") <= F.col("missing")) & (F.col("missing") < F.col("before") + F.col("held")))
        .select("name", F.col(cell).alias("edge"), "before")
    )
