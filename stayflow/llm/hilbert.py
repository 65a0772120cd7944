"""Sharding along a Hilbert curve, in DataFrame operations only.

Metadata dimensions are quantised to ``BITS`` bits each, by the order of their values and about evenly filled, so that a range of bins is
a range of values. A cell of the resulting grid has an index on the Hilbert curve, and neighbours in several dimensions stay
neighbours in the order. The order is cut into runs of equal row counts (law ``rows``): files of one shard span few values of
every dimension, and readers skip the others by minimum and maximum.

Equal texts are one group. A group has one place, that of the row with its smallest id, whatever the other rows' metadata: groups are
ordered by curve index and text hash, rows of a group by a hash of the row. So a cut between two shards can divide one group at most.
The price: copies under another source or language widen the value ranges of the shard of their text.

No global sort is needed for the exact position. Rows that are equal are counted first and become one unit; units make up groups,
groups make up cells. Running totals over cells, over hash ranges of about ``PART_ROWS`` groups in a cell, and over hash ranges of about
``PART_ROWS`` units in a group give every unit its first position. A unit with many rows is spread again. Cells are at most 2 to the power
of bits times dimensions; only their counts, never rows, meet in one task.

Defined results: nulls of a dimension are its first value; a null text is an empty one (size 1: 0 bytes plus 1); rows that are equal
in every carried column get neighbouring slots; an empty table gives an empty result. Very long texts are only hashed. Further
columns may be carried along under one struct column, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

BITS = 6
SHARDS = 8
PART_ROWS = 1000
_HASH_RANGE = float(1 << 62)


def hilbert_index(coordinates: Sequence[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of integer coordinates below 2**bits (transpose form, Skilling 2004)."""
    n = len(coordinates)
    start = F.array(*[c.cast("long") for c in coordinates])
    steps = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(n)]

    def undo(x: Column, s: Column) -> Column:
        first, own = x[0], F.get(x, s["i"])
        low = s["q"] - 1
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        inverted = own.bitwiseAND(s["q"]) != 0
        change = lambda v, j: (
            F.when(inverted, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
            .when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap))
            .otherwise(v)
        )
        return F.when((s["i"] == 0) & ~inverted, x).otherwise(F.transform(x, change))

    if steps:
        listed = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q, i in steps])
        start = F.aggregate(listed, start, undo)
    gray = F.aggregate(
        start,
        F.expr("cast(array() as array<bigint>)"),
        lambda done, v: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)).bitwiseXOR(v))),
    )
    masks = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]) if bits > 1 else None

    def flipped(g: Column) -> Column:
        if masks is None:
            return g
        last = F.element_at(g, -1)
        turn = F.aggregate(
            masks, F.lit(0).cast("long"), lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
        )
        return F.transform(g, lambda v: v.bitwiseXOR(turn))

    # The bits of the dimensions in turn, highest first.
    places = [(b, i) for b in range(bits - 1, -1, -1) for i in range(n)]
    order = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b, i in places])
    return F.aggregate(
        order,
        F.struct(F.lit(0).cast("long").alias("index"), flipped(gray).alias("x")),
        lambda acc, p: F.struct(
            (acc["index"] * 2 + F.getbit(F.get(acc["x"], p["i"]), p["b"]).cast("long")).alias("index"),
            acc["x"].alias("x"),
        ),
        lambda acc: acc["index"],
    )


def depth_bins(values: DataFrame, bins: int, purpose: str) -> DataFrame:
    """(value, bin) from (value, n): the values in their order, nulls first, cut into bins of about equal sums of ``n``.

    Values are dealt to tasks by range; only one sum per range meets in one task.
    """
    counted = values.groupBy("value").agg(F.sum("n").alias("n")).repartitionByRange("value")
    ranged = stored(counted.withColumn("range", F.spark_partition_id()), f"hilbert-{purpose}")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("range").agg(F.sum("n").alias("m"))
    starts = sums.select("range", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("start"), F.sum("m").over(Window.partitionBy()).alias("all"))
    inside = Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside", F.sum("n").over(inside)).join(starts, "range")
    before = F.col("start") + F.coalesce("inside", F.lit(0))
    return placed.select("value", F.floor(before * bins / F.col("all")).cast("int").alias("bin"))


def part_number(hashed: Column, parts: Column) -> Column:
    """The hash space cut into ``parts`` ranges."""
    share = (F.shiftright(hashed, 2).cast("double") + (1 << 61)) / _HASH_RANGE
    return F.least(F.floor(share * parts), parts - 1).cast("long")


def running_start(counted: DataFrame, keys: Sequence[str], order: str, into: str) -> DataFrame:
    """Add the sum of ``n`` over the earlier rows of the same ``keys``."""
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counted.withColumn(into, F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def placed_groups(groups: DataFrame, dimensions: Sequence[str], bits: int, part_rows: int) -> DataFrame:
    """(g, curve_index, start, total) of (g, n, and one column per dimension)."""
    cell = F.lit(0).cast("long")
    binned = groups
    for i, d in enumerate(dimensions):
        bins = depth_bins(groups.select(F.col(d).alias("value"), "n"), 1 << bits, d)
        bins = stored(bins, "hilbert-bins")  # so that its size is known
        binned = binned.join(bins.withColumnRenamed("bin", f"_bin{i}"), F.col(d).eqNullSafe(F.col("value"))).drop("value")
        cell = cell * (1 << bits) + F.col(f"_bin{i}")
    celled = stored(binned.select("g", "n", cell.alias("cell")), "hilbert-groups")
    places = [F.shiftright("cell", bits * i).bitwiseAND(F.lit((1 << bits) - 1)) for i in reversed(range(len(dimensions)))]
    cells = celled.groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    before = Window.orderBy("curve_index").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("curve_index", hilbert_index(places, bits)).select(
        "cell",
        "curve_index",
        F.ceil(F.col("texts") / part_rows).alias("parts"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("cell_start"),
        F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    parted = celled.join(stored(cells, "hilbert-cells"), "cell").withColumn("part", part_number(F.col("g"), F.col("parts")))
    parts = parted.groupBy("cell", "part").agg(F.sum("n").alias("n"))
    parts = running_start(parts, ["cell"], "part", "part_start").drop("n")
    started = running_start(parted, ["cell", "part"], "g", "here").join(parts, ["cell", "part"])
    start = F.col("cell_start") + F.col("part_start") + F.col("here")
    return started.select("g", "curve_index", start.alias("start"), "total")


def placed_units(documents: DataFrame, dimensions: dict[str, Column], doc_id: Column, text: Column, rows: Column, bits: int, part_rows: int):
    """(g, r, n, first, curve_index, total, and doc_id, size, text_crc32) of every kind of equal rows; ``rows`` tells rows apart."""
    body = F.coalesce(text.cast("binary"), F.lit(b""))
    units = documents.select(
        F.xxhash64(body).alias("g"),
        rows.alias("r"),
        doc_id.alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
        *[c.alias(f"d_{name}") for name, c in dimensions.items()],
    )
    kinds = [f"d_{name}" for name in dimensions]
    units = units.groupBy(*units.columns).agg(F.count(F.lit(1)).alias("n"))
    units = stored(units, "hilbert-units")
    smallest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *kinds, "size")).alias("s")
    groups = units.groupBy("g").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("units"), smallest)
    groups = stored(groups.select("g", "n", "units", *[F.col(f"s.{k}").alias(k) for k in kinds], F.col("s.size").alias("d_size")), "hilbert-texts")
    placed = placed_groups(groups, [*kinds, "d_size"], bits, part_rows)
    # Groups of one unit need no further order.
    placed = placed.join(groups.select("g", F.ceil(F.col("units") / part_rows).alias("parts")), "g")
    parted = units.drop(*kinds).join(stored(placed, "hilbert-starts"), "g").withColumn("part", part_number(F.col("r"), F.col("parts")))
    parted = parted.repartition("g", "part")  # else the join's partitions, by group, would do for the windows
    parts = running_start(parted.groupBy("g", "part").agg(F.sum("n").alias("n")), ["g"], "part", "part_start").drop("n")
    inside = running_start(parted, ["g", "part"], "r", "here").join(parts, ["g", "part"])
    return inside.withColumn("first", F.col("start") + F.col("part_start") + F.col("here"))


def shard_rows(
    documents: DataFrame,
    dimensions: Sequence[str] = ("source", "lang"),
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    bits: int = BITS,
    part_rows: int = PART_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, curve_index, carried) of every row.

    The dimensions of the curve are the named columns and the size of the text.
    """
    told_apart = list(dict.fromkeys([doc_id, *dimensions, *carry]))
    row_hash = F.xxhash64(*[F.col(c) for c in told_apart], *[F.col(c).isNull() for c in told_apart])
    by_name = {f"{i}_{c}": F.col(c).cast("string") for i, c in enumerate(dimensions)}
    units = placed_units(documents, by_name, F.col(doc_id), F.col(text), row_hash, bits, part_rows)
    if carry:
        # Equal rows are one row here, too, and come back as often as they were.
        rows = documents.select(
            F.xxhash64(F.coalesce(F.col(text).cast("binary"), F.lit(b""))).alias("_g"), row_hash.alias("_r"), F.struct(*carry).alias("carried")
        )
        kept = stored(units, "hilbert-places")
        same = (F.col("_g") == F.col("g")) & (F.col("_r") == F.col("r"))
        single = rows.join(kept.where("n = 1"), same).drop("_g", "_r")
        many = rows.join(kept.where("n > 1"), same).groupBy("_g", "_r").agg(F.first("carried").alias("carried"))
        units = single.unionByName(many.join(kept.where("n > 1"), same).drop("_g", "_r"))
    else:
        units = units.withColumn("carried", F.lit(None).cast("string"))
    # A unit of very many rows is dealt out by blocks before it is spread.
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {part_rows}"))
    blocked = units.withColumn("block", F.explode(blocks))
    large = blocked.where(F.col("n") > part_rows).repartition("g", "r", "block")
    spread = blocked.where(F.col("n") <= part_rows).unionByName(large)
    last = F.least(F.col("n"), (F.col("block") + 1) * part_rows) - 1
    ranked = spread.withColumn("copy", F.explode(F.sequence(F.col("block") * part_rows, last)))
    ranked = ranked.withColumn("rank", F.col("first") + F.col("copy"))
    shard = F.expr(f"cast(rank * {shards} div total as int)")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("rank") - first).alias("slot"),
        "curve_index",
        "carried",
    )
