"""Percentiles per group, approximate or exact, without holding a group in one task.

``exact`` brackets every percentile with the mergeable sketch of ``percentile_approx`` and narrows the brackets, all groups and
percentiles at once, by sketches of the values inside them until at most ``INSIDE`` rows lie strictly inside any. Then it
counts: rows below and above the bracket collapse into one row each, equal values inside it too,
and the answer is read off the few values that remain. Linear interpolation between the two neighbours. The rows stay where
they are: what travels in each pass is a sketch or a few rows for each task and group.
"""

from pyspark.sql import DataFrame, Window as W, functions as F

from skygauge.store import cut_lineage

SKETCH_ACCURACY = 10_000
#: rows strictly inside a bracket that one task sorts
INSIDE = 20_000
#: a narrowing sketch cuts a bracket into so many parts
CUTS = 512
#: brackets of so many groups at most are sent to every task; beyond, rows and brackets are joined in parts of ``PART_ROWS``
GROUPS = 20_000
PART_ROWS = 2_000_000


def approx_percentiles(df: DataFrame, key: str, specs: dict, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """One row per key with ``{name: (column, p)}`` as observed values (no interpolation)."""
    return df.groupBy(key).agg(*[
        F.percentile_approx(c, F.lit(p), F.lit(accuracy)).alias(name) for name, (c, p) in specs.items()
    ])


def exact_percentiles(df: DataFrame, key: str, specs: dict, accuracy: int = SKETCH_ACCURACY) -> DataFrame:
    """One row per key with ``{name: (column, p)}``, interpolated; null when a group has no values."""
    margin = 4.0 / accuracy  # the sketch is off by at most 1/accuracy of the ranks
    values = df.select(key, *[F.col(c).cast("double").alias(f"_v_{n}") for n, (c, _) in specs.items()])
    sketch = cut_lineage(df.groupBy(key).agg(*[
        F.struct(
            F.count(c).alias("n"),
            F.percentile_approx(
                c, F.array(F.lit(max(0.0, p - margin)), F.lit(min(1.0, p + margin))), F.lit(accuracy)
            ).cast("array<double>").alias("edge"),
        ).alias(name)
        for name, (c, p) in specs.items()
    ]))
    groups, most = sketch.agg(F.count(F.lit(1)), F.max(F.greatest(F.lit(0), *[F.col(f"{n}.n") for n in specs]))).first()
    inside = (most or 0) * (2 * margin + 2 / accuracy)
    while inside > INSIDE:
        before, sketch = inside, _narrowed(values, sketch, key, specs, accuracy, groups, most)
        inside = _strictly_inside(values, sketch, key, specs, groups, most)
        if inside > before / 2:
            break  # what is left are few different values
    joined = _with_brackets(values, sketch, key, groups, most)
    # One long row per (key, percentile, value). Zone -1 / 1: below / above the bracket, zone 2: no
    # value; each collapses into one row. A group without values has no rank.
    def entry(name, p):
        v, edge = F.col(f"_v_{name}"), F.col(f"{name}.edge")
        zone = F.when(v.isNull(), 2).when(v < edge[0], -1).when(v > edge[1], 1).otherwise(0)
        return F.struct(
            F.lit(name).alias("name"), F.when(F.col(f"{name}.n") > 0, F.lit(p) * (F.col(f"{name}.n") - 1)).alias("rank"), v.alias("v"),
            zone.alias("zone"), F.when(zone == 0, v).alias("inside"),
        )
    entries = joined.select(key, F.inline(F.array(*[entry(n, p) for n, (_, p) in specs.items()])))
    counts = entries.groupBy(key, "name", "rank", "zone", "inside").agg(
        F.count(F.lit(1)).alias("same"), F.min("v").alias("least"), F.max("v").alias("most")
    )
    order = W.partitionBy(key, "name").orderBy("zone", "inside")
    ranked = counts.select(
        key, "name", "rank", "zone", "same", "least", "most",
        F.sum("same").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("upto"),
        F.lead("least").over(order).alias("next"),
    )
    # The first row whose cumulative count covers the lower rank holds the lower neighbour.
    covering = ranked.filter(F.col("rank").isNull() | (F.col("upto") - 1 >= F.floor("rank")))
    picked = covering.groupBy(key, "name").agg(
        F.min_by(F.struct("rank", "zone", "same", "least", "most", "upto", "next"), "upto").alias("r")
    )
    low, last = F.floor("r.rank"), F.col("r.upto") - 1
    share = F.col("r.rank") - low
    lower = (
        F.when(F.col("r.zone") == 0, F.col("r.least"))
        .when((F.col("r.zone") == -1) & (low == last), F.col("r.most"))
        .when((F.col("r.zone") == 1) & (low == last - F.col("r.same") + 1), F.col("r.least"))
    )
    upper = (
        F.when(share == 0, lower).when(low == last, F.col("r.next"))
        .when(F.col("r.zone") == 0, F.col("r.least"))
    )
    value = lower + (upper - lower) * share
    checked = F.when(value.isNull() & F.col("r.rank").isNotNull(), F.raise_error(F.lit("percentile outside its bracket")).cast("double")).otherwise(value)
    return picked.groupBy(key).agg(*[
        F.max(F.when(F.col("name") == name, checked)).alias(name) for name in specs
    ])


def _with_brackets(values: DataFrame, sketch: DataFrame, key: str, groups: int, most: int) -> DataFrame:
    if groups <= GROUPS:
        return values.join(F.broadcast(sketch), key)
    # joined by (key, part), so that a hot key's rows are never brought together
    parts = 1 + (most or 0) // PART_ROWS
    part = F.pmod(F.xxhash64(*[c for c in values.columns if c != key]), F.lit(parts)).cast("int")
    spread = sketch.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return values.withColumn("_part", part).join(spread, [key, "_part"]).drop("_part")


def _between(name: str):
    v, edge = F.col(f"_v_{name}"), F.col(f"{name}.edge")
    return v, v < edge[0], (v >= edge[0]) & (v <= edge[1]), (v > edge[0]) & (v < edge[1])


def _strictly_inside(values: DataFrame, sketch: DataFrame, key: str, specs: dict, groups: int, most: int) -> int:
    """The most rows between the edges of a bracket, without the edges' own."""
    counts = _with_brackets(values, sketch, key, groups, most).groupBy(key).agg(*[F.count_if(_between(n)[3]).alias(n) for n in specs])
    return counts.agg(F.max(F.greatest(F.lit(0), *[F.col(n) for n in specs]))).first()[0]


def _narrowed(values: DataFrame, sketch: DataFrame, key: str, specs: dict, accuracy: int, groups: int, most: int) -> DataFrame:
    """Brackets between the cuts next to the percentile in a sketch of the values inside the old ones."""
    grid = F.array(*[F.lit(i / CUTS) for i in range(CUTS + 1)])
    cuts = _with_brackets(values, sketch, key, groups, most).groupBy(key).agg(*[x for n in specs for x in (
        F.first(f"{n}.n").alias(f"_n_{n}"), F.count_if(_between(n)[1]).alias(f"_below_{n}"), F.count_if(_between(n)[2]).alias(f"_in_{n}"),
        F.percentile_approx(F.when(_between(n)[2], F.col(f"_v_{n}")), grid, F.lit(accuracy)).alias(f"_cuts_{n}"))])

    def edge(name, p, beyond):
        rank = F.lit(p) * (F.col(f"_n_{name}") - 1) - F.col(f"_below_{name}")
        rank = F.floor(rank) if beyond < 0 else F.ceil(rank)
        share = rank / F.greatest(F.col(f"_in_{name}") - 1, F.lit(1))
        place = F.floor(share * CUTS) + (-1 if beyond < 0 else 2)  # a cut further than the sketch's error
        return F.element_at(f"_cuts_{name}", (F.greatest(F.lit(0), F.least(F.lit(CUTS), place)) + 1).cast("int"))

    return cut_lineage(cuts.select(key, *[
        F.struct(F.col(f"_n_{n}").alias("n"), F.when(F.col(f"_n_{n}") > 0, F.array(edge(n, p, -1), edge(n, p, 1))).alias("edge")).alias(n)
        for n, (_, p) in specs.items()]))
