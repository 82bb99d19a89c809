"""Row numbers and buckets over a whole table, first rows per key, running offsets.

An unpartitioned window sends the whole table to one task. Row numbers come from a sort by range, so
every task holds a slice, and only one count per slice is summed up in a single place. Buckets need no
sort: their first rows are selected by counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registra.sources.shared import written

# monotonically_increasing_id() = partition number << 33 | row number inside the partition
_ROW_BITS = 33
# Digits of the selection: at most 2^14 counts for each place reach the driver.
_DIGIT_BITS = 14


def global_rank(df: DataFrame, order: list[Column], rank: str = "rank", total: str = "total_rows") -> DataFrame:
    """Adds the 0-based place of every row in the order, and the number of rows.

    The order must name every row (end it with the key); this also keeps the slices
    even when one value holds much of the table.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    stored = written(placed, "ranked")
    slice_number = F.shiftright("_place", _ROW_BITS)
    # One row per written partition: small whatever the table holds.
    sizes = stored.groupBy(slice_number.alias("_slice")).agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select(
        "_slice",
        (F.sum("_size").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, 0)) - F.col("_size")).alias("_start"),
        F.sum("_size").over(W.partitionBy()).alias(total),
    )
    in_slice = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        stored.withColumn("_slice", slice_number)
        .join(F.broadcast(starts), "_slice")
        .select(*df.columns, (F.col("_start") + in_slice).alias(rank), total)
    )


def _unsigned(value: int) -> int:
    """Whole numbers in the order of unsigned 64-bit ones."""
    return value + (1 << 63)


def rows_at(
    df: DataFrame, order: dict[str, Column], places: list[int] | None = None, buckets: int | None = None, counts: DataFrame | None = None
) -> list[tuple[int, ...]]:
    """The sort parts of the rows at some 0-based places of the order, or of the first rows of NTILE buckets.

    `order` names the ascending sort parts: whole numbers that hold no NULL and together name a row.
    The rows are never sorted or moved. A part is found digit by digit: tasks count the rows per digit among those that agree
    with all found so far, and the counts, at most 2^14 a place, tell the next digit. So the
    second part is looked at only in rows tied at the first. `df` is read once per digit
    of up to 14 bits: pass a written table. With `counts`, rows (first part, n) that add up to the table's, the first part is
    found in them, and of `df` only the rows tied there are asked for.
    """
    names = list(order)
    rows = df.select(*[value.cast("bigint").alias(name) for name, value in order.items()]).withColumn("_n", F.lit(1))
    ends = lambda columns: [f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    source = rows if counts is None else counts.select(F.col(names[0]).cast("bigint").alias(names[0]), F.col("n").alias("_n"))
    span = source.agg(F.sum("_n").alias("rows"), *ends(names if counts is None else names[:1])).first().asDict()
    total = span["rows"] or 0
    if buckets is not None:
        small, larger = divmod(total, buckets)
        places = [small * b + min(larger, b) for b in range(1, buckets)]
    wanted = {place: ((), place) for place in places if 0 <= place < total}
    for name in names:
        if f"min_{name}" not in span:  # the first part came from counts
            source = rows.filter(F.col(names[0]).isin(sorted({values[0] for values, _ in wanted.values()})))
            span |= source.agg(*ends(names[1:])).first().asDict()
        low, high = _unsigned(span[f"min_{name}"] or 0), _unsigned(span[f"max_{name}"] or 0)
        bits = (low ^ high).bit_length()
        # By place: values of the parts before, the leading digits of this part, the place among the rows that share them.
        found = {place: (values, low >> bits, left) for place, (values, left) in wanted.items()}
        key = F.col(name).bitwiseXOR(F.lit(-(1 << 63)))
        while bits and found:
            step = min(_DIGIT_BITS, bits)
            groups = sorted({(values, lead) for values, lead, _ in found.values()})
            group = F.lit(None).cast("int")
            for i, (values, lead) in enumerate(groups):
                agrees = F.shiftrightunsigned(key, bits) == lead if bits < 64 else F.lit(True)
                for other, value in zip(names, values):
                    agrees &= F.col(other) == value
                group = F.when(agrees, i).otherwise(group)
            bits -= step
            digit = F.shiftrightunsigned(key, bits).bitwiseAND((1 << step) - 1)
            counted = source.select(group.alias("group"), digit.alias("digit"), "_n").filter("group IS NOT NULL")
            sums = sorted(map(tuple, counted.groupBy("group", "digit").agg(F.sum("_n")).collect()))
            for place, (values, lead, left) in found.items():
                at = groups.index((values, lead))
                for g, d, n in sums:
                    if g == at and left < n:
                        found[place] = (values, lead << step | d, left)
                        break
                    left -= n if g == at else 0
        wanted = {place: ((*values, lead - (1 << 63)), left) for place, (values, lead, left) in found.items()}
    return [wanted[place][0] for place in sorted(wanted)]


def bucket_of(order: dict[str, Column], cuts: list[tuple[int, ...]]) -> Column:
    """1 and the number of cuts that a row has reached."""
    place = F.struct(*[value.cast("bigint").alias(name) for name, value in order.items()])
    at = [F.struct(*[F.lit(v).cast("bigint").alias(name) for name, v in zip(order, cut)]) for cut in cuts]
    return sum((F.when(place >= cut, 1).otherwise(0) for cut in at), F.lit(1))


def global_ntile(df: DataFrame, buckets: int, order: dict[str, Column], out: str) -> DataFrame:
    """NTILE(buckets) over the whole table: sizes differ by at most one, larger ones first.

    `order` as for `rows_at`, which selects the first row of each bucket; every row then compares itself with
    these few constants, so `df` is never shuffled.
    """
    return df.withColumn(out, bucket_of(order, rows_at(df, order, buckets=buckets)))


def descending_nulls_first(column: Column) -> list[Column]:
    """Sort parts for a whole number, to be compared ascending."""
    return [column.isNotNull(), -column.cast("bigint")]


def ascending_nulls_last(column: Column) -> list[Column]:
    return [column.isNull(), column]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], values: list[str]) -> DataFrame:
    """The values of the first row of every key.

    An aggregate, not a window: each task reduces its rows to one per key before the
    shuffle, so a key that holds a third of the table costs no more than any other.
    """
    row = F.min_by(F.struct(*values), F.struct(*[p.alias(f"p{i}") for i, p in enumerate(order)]))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, *[F.col(f"_row.{v}") for v in values])


def first_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, place: str = "place") -> DataFrame:
    """The first n rows of every key with their place 1..n.

    The rank filter lets Spark keep n rows per key in every task before the shuffle.
    """
    ranked = df.withColumn(place, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(place) <= n)


def _starts(sums: DataFrame, part: str, within: list[str]) -> DataFrame:
    """Sums of `_sum` over the smaller parts, restarting for every value of `within`."""
    before = W.partitionBy(*within).orderBy(part).rowsBetween(W.unboundedPreceding, 0)
    return sums.select(part, *within, (F.sum("_sum").over(before) - F.col("_sum")).alias("_start"))


def running_offset(df: DataFrame, key: str, size: Column, out: str, block: int = 1024) -> DataFrame:
    """Adds the sum of `size` over all rows with a smaller key.

    For unique, roughly dense whole-number keys, such as ids. Keys are cut into blocks and
    blocks into areas of as many blocks; a block or an area is added up by one task, and
    only the area sums, one per million ids, meet in a single place.
    """
    sized = df.withColumn("_size", size.cast("bigint")).withColumn("_block", F.floor(F.col(key) / block))
    blocks = (
        sized.groupBy("_block").agg(F.sum("_size").alias("_sum")).withColumn("_area", F.floor(F.col("_block") / block))
    )
    areas = blocks.groupBy("_area").agg(F.sum("_sum").alias("_sum"))
    area_starts = _starts(areas, "_area", []).withColumnRenamed("_start", "_area_start")
    starts = (
        _starts(blocks, "_block", ["_area"])
        .join(area_starts, "_area")
        .select("_block", (F.col("_start") + F.col("_area_start")).alias("_start"))
    )
    inside = W.partitionBy("_block").orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    return (
        sized.join(starts, "_block")
        .withColumn(out, F.col("_start") + F.sum("_size").over(inside) - F.col("_size"))
        .drop("_size", "_block", "_start")
    )
