"""Exact ranks, order statistics and running totals without a one-task window.

``ntile``, ``percentile`` and ``sum() over (order by …)`` without a partition pull every row into one
task.  The functions here give the same answers from bounded pieces:

* :func:`order_statistics` finds the rows at given ranks by bracketing them between pivots of a quantile sketch
  or a small sample, counting exactly, and narrowing the brackets (the selection method of Floyd and Rivest,
  1975, run as aggregates).  Only pivots and answers reach the driver.
* :func:`running` range-partitions the rows, sums inside each slice, and adds what earlier slices
  carry in.
* :func:`series_columns` cuts a long series into chunks that overlap by the reach of the window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from bizlens.session import checkpoint_folder

#: Input below this many bytes is cheaper to read again than to checkpoint.
REREAD_BYTES = 32 << 20
#: Frames computed from at most this many bytes may be sorted by one task (the sort spills).
SMALL_BYTES = 32 << 20
#: Plan nodes without a shuffle (fixed values).
READ_NODES = {"Project", "Filter", "LogicalRelation", "LogicalRDD", "LocalRelation", "Range", "Union"}
#: Rows one task may sort for a window; larger groups are split.
GROUP_ROWS = 1_000_000
#: Rows of one bracket that one task sorts at the end of a selection.
BRACKET_ROWS = 500_000
#: The sketch's ranks are off by at most one part in so many of the rows.
SKETCH_ACCURACY = 10_000
#: Expected sample size per bracket and round.
SAMPLE_ROWS = 20_000


def input_bytes(df: DataFrame) -> int:
    """Size of everything the plan reads, as the optimizer estimates it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def _node_names(plan) -> set[str]:
    children = plan.children()
    return {plan.nodeName()}.union(*[_node_names(children.apply(i)) for i in range(children.size())])


def settled(df: DataFrame, reread_bytes: int = REREAD_BYTES) -> DataFrame:
    """``df`` itself when it is cheap to compute again, else a checkpoint of it.

    For frames that several jobs read: the checkpoint is written once to the shared folder, so later
    jobs neither repeat the shuffles before it nor depend on executors that may be gone.  A scan with
    projections and filters is read again instead: its columns are pruned, a copy's would not be.
    """
    if input_bytes(df) <= reread_bytes:
        return df
    if _node_names(df._jdf.queryExecution().optimizedPlan()) <= READ_NODES:
        return df
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def is_small(df: DataFrame, small_bytes: int | None = None) -> bool:
    """Whether everything the plan reads is so little that one task can sort it."""
    return input_bytes(df) <= (SMALL_BYTES if small_bytes is None else small_bytes)


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group (of the whole frame without keys)."""
    if not keys:
        return df.count()
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.agg(F.max("_n")).first()[0] or 0


def _group_fits(df: DataFrame, keys: Sequence[str], group_rows: int, small_bytes: int | None) -> bool:
    return is_small(df, small_bytes) or largest_group(df, keys) <= group_rows


def sort_key(*order: tuple[Column | str, bool]) -> Column:
    """One comparable struct for several ``(column, ascending)`` pairs, nulls first when ascending and
    last when descending; a descending column has to be numeric."""
    parts = []
    for column, ascending in order:
        column = F.col(column) if isinstance(column, str) else column
        parts += [column] if ascending else [column.isNull(), -column]
    return F.struct(*[part.alias(f"k{i}") for i, part in enumerate(parts)])


@dataclass
class _Bracket:
    """A rank that is looked for among the keys between ``low`` and ``high``, both left out."""

    key: str
    rank: int
    inside: int
    below: int = 0
    low: object = None
    high: object = None
    answer: object = None


def _literal(key, dtype: DataType) -> Column:
    """A literal equal to a collected key, plain or struct."""
    if not isinstance(dtype, StructType):
        return F.lit(key).cast(dtype)
    return F.struct(*[F.lit(key[f.name]).cast(f.dataType).alias(f.name) for f in dtype.fields])


def _within(b: _Bracket, dtype: DataType) -> Column:
    condition = F.col(b.key).isNotNull()
    if b.low is not None:
        condition &= F.col(b.key) > _literal(b.low, dtype)
    if b.high is not None:
        condition &= F.col(b.key) < _literal(b.high, dtype)
    return condition


def _members(work: DataFrame, brackets: Sequence[_Bracket], dtype: DataType, rate: Callable[[_Bracket], float] | None = None) -> DataFrame:
    """(b, k): the keys of each bracket, all of one type, or a random part of them; a row belongs to no or few brackets."""
    tests = [_within(b, dtype) if rate is None else _within(b, dtype) & (F.col("_draw") < rate(b)) for b in brackets]
    cells = [F.when(test, F.struct(F.lit(i).alias("b"), F.col(b.key).alias("k"))) for i, (b, test) in enumerate(zip(brackets, tests))]
    return work.select(F.explode(F.array_compact(F.array(*cells))).alias("m")).select("m.b", "m.k")


def _by_type(brackets: Sequence[_Bracket], types: dict[str, DataType]) -> list[tuple[DataType, list[_Bracket]]]:
    found: dict[str, tuple[DataType, list[_Bracket]]] = {}
    for b in brackets:
        found.setdefault(types[b.key].json(), (types[b.key], []))[1].append(b)
    return list(found.values())


def _sampled_pivots(work: DataFrame, wide: Sequence[_Bracket], types, sample_rows: int, attempt: int) -> list[tuple]:
    """Two keys of a sample around the place of each rank; a bracket's sample is sorted as rows of one task."""
    found: dict[int, tuple] = {}
    drawn = work.withColumn("_draw", F.rand(attempt))
    for dtype, part in _by_type(wide, types):
        rows = _members(drawn, part, dtype, lambda b: sample_rows / b.inside)
        window = Window.partitionBy("b")
        share = F.lit(0.0)
        for i, b in enumerate(part):
            share = F.when(F.col("b") == i, (b.rank - b.below + 0.5) / b.inside).otherwise(share)
        size, place = F.count("*").over(window), F.row_number().over(window.orderBy("k"))
        margin = 2 * F.sqrt(F.col("size").cast("double")) + 2
        at = rows.select("b", "k", size.alias("size"), place.alias("place"), share.alias("share"))
        picks = at.groupBy("b").agg(
            F.max(F.when(F.col("place") <= F.greatest(F.floor(F.col("size") * F.col("share") - margin), F.lit(1)), F.col("k"))).alias("lo"),
            F.min(F.when(F.col("place") >= F.least(F.ceil(F.col("size") * F.col("share") + margin), F.col("size")), F.col("k"))).alias("hi"))
        for row in picks.collect():
            found[id(part[row["b"]])] = (row["lo"], row["hi"])
    return [found.get(id(b)) for b in wide]


def order_statistics(
    df: DataFrame,
    keys: dict[str, Column],
    ranks: Sequence[tuple[str, int]],
    totals: dict[str, int],
    bracket_rows: int = BRACKET_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    pivots: dict[tuple[str, int], tuple] | None = None,
) -> list:
    """The keys at 0-based ``ranks``, one ``(key name, rank)`` each.

    ``keys`` are plain columns or structs from :func:`sort_key`; rows with a null key do not count.  ``totals`` holds the
    number of rows per key, ``pivots`` two keys around each rank if a sketch has given them.  A round is a sample (unless pivots are
    given) and an aggregate over ``df``, whatever the number of ranks.  Brackets leave their ends out, so every round takes
    the whole ties of its pivots away and ends, however few different keys there are.
    """
    work = df.select(*[column.alias(name) for name, column in keys.items()])
    types = {field.name: field.dataType for field in work.schema.fields}
    brackets = [_Bracket(name, rank, totals[name]) for name, rank in ranks]
    attempt = 0
    while wide := [b for b in brackets if b.answer is None and b.inside > bracket_rows]:
        attempt += 1
        if attempt == 1 and pivots:
            chosen = [pivots[b.key, b.rank] for b in wide]
        else:
            chosen = _sampled_pivots(work, wide, types, sample_rows, attempt)
        pairs = [(b, *pair) for b, pair in zip(wide, chosen) if pair and pair[0] is not None]
        if not pairs:  # an empty sample; the next one is another
            continue
        counts = work.agg(*[
            F.count_if(test(F.col(b.key), _literal(pivot, types[b.key]))).alias(f"{name}{i}")
            for i, (b, low, high) in enumerate(pairs)
            for pivot, name, test in (
                (low, "a", lambda k, p: k < p), (low, "b", lambda k, p: k <= p),
                (high, "c", lambda k, p: k < p), (high, "d", lambda k, p: k <= p))]).first()
        for i, (b, low, high) in enumerate(pairs):
            before_low, to_low, before_high, to_high = (counts[f"{n}{i}"] for n in "abcd")
            end = b.below + b.inside
            if b.rank < before_low:
                b.high, b.inside = low, before_low - b.below
            elif b.rank < to_low:
                b.answer = low
            elif b.rank < before_high:
                b.low, b.high, b.below, b.inside = low, high, to_low, before_high - to_low
            elif b.rank < to_high:
                b.answer = high
            else:
                b.low, b.below, b.inside = high, to_high, end - to_high
    for dtype, part in _by_type([b for b in brackets if b.answer is None], types):
        counted = _members(work, part, dtype).groupBy("b", "k").agg(F.count("*").alias("n"))
        place = F.lit(0)
        for i, b in enumerate(part):
            place = F.when(F.col("b") == i, F.lit(b.rank - b.below)).otherwise(place)
        upto = F.sum("n").over(Window.partitionBy("b").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
        reached = counted.select("b", "k", upto.alias("upto"), place.alias("place")).where("upto > place")
        for row in reached.groupBy("b").agg(F.min("k").alias("k")).collect():
            part[row["b"]].answer = row["k"]
    return [b.answer for b in brackets]


def global_ntile(
    df: DataFrame, tiles: dict[str, Column], n: int, bracket_rows: int = BRACKET_ROWS,
    sample_rows: int = SAMPLE_ROWS, small_bytes: int | None = None,
) -> DataFrame:
    """``ntile(n)`` over the whole frame, one column per entry of ``tiles``.

    ``tiles`` maps an output name to a :func:`sort_key` that orders the rows totally.  The last row of
    each tile is found by selection; assigning the tiles is then a projection without shuffle or sort.
    Small input uses the window function.
    """
    if is_small(df, small_bytes):
        return df.withColumns({name: F.ntile(n).over(Window.orderBy(key)) for name, key in tiles.items()})
    df = settled(df)
    total = df.count()
    size, extra = divmod(total, n)
    ends = [end for end in (size * t + min(t, extra) - 1 for t in range(1, n)) if end >= 0]
    ranks = [(name, end) for name in tiles for end in ends]
    if not ranks:
        return df.withColumns({name: F.lit(1) for name in tiles})
    rows = order_statistics(df, tiles, ranks, dict.fromkeys(tiles, total), bracket_rows, sample_rows)
    types = {f.name: f.dataType for f in df.select(*[c.alias(k) for k, c in tiles.items()]).schema.fields}
    added = {}
    for name, key in tiles.items():
        marks = [row for (owner, _), row in zip(ranks, rows) if owner == name]
        tile = F.lit(len(marks) + 1)
        for place, mark in reversed(list(enumerate(marks, start=1))):
            tile = F.when(key <= _literal(mark, types[name]), F.lit(place)).otherwise(tile)
        added[name] = tile
    return df.withColumns(added)


def exact_quantiles(
    df: DataFrame,
    columns: dict[str, Column | str],
    probabilities: Sequence[float],
    bracket_rows: int = BRACKET_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    small_bytes: int | None = None,
    few_values: bool = False,
) -> dict[str, list]:
    """Exact quantiles with linear interpolation, nulls left out; values are doubles (None if no rows).

    ``percentile`` keeps every distinct value in one buffer, so it serves small input, and columns that
    can only have ``few_values``, such as dates; otherwise the quantiles are selected.
    """
    return quantiles_and(df, columns, probabilities, [], bracket_rows, sample_rows, small_bytes, few_values)[0]


def quantiles_and(
    df: DataFrame,
    columns: dict[str, Column | str],
    probabilities: Sequence[float],
    others: Sequence[Column],
    bracket_rows: int = BRACKET_ROWS,
    sample_rows: int = SAMPLE_ROWS,
    small_bytes: int | None = None,
    few_values: bool = False,
) -> tuple[dict[str, list], Row]:
    """:func:`exact_quantiles` and, from its first pass, the ``others``, named aggregates over ``df``.

    That pass takes row counts and a sketch of each column; the sketch's ranks are off by a known part of the rows, so two of
    its values enclose a quantile.  The second counts around them, the third sorts what lies between; only
    beyond ``bracket_rows`` times a third of the sketch's accuracy do more passes follow.
    """
    values = {name: (F.col(c) if isinstance(c, str) else c).cast("double") for name, c in columns.items()}
    spots = list(probabilities)
    if few_values or is_small(df, small_bytes):
        found = df.agg(*[F.percentile(value, F.lit(spots)).alias(f"_q{i}") for i, value in enumerate(values.values())], *others).first()
        return {name: found[f"_q{i}"] or [None] * len(spots) for i, name in enumerate(columns)}, found
    df = settled(df)
    margin = 3 / SKETCH_ACCURACY
    ends = [min(max(p + side, 0.0), 1.0) for p in spots for side in (-margin, margin)]
    first = df.agg(*[f for i, value in enumerate(values.values()) for f in (
        F.count(value).alias(f"_n{i}"), F.percentile_approx(value, ends, SKETCH_ACCURACY).alias(f"_e{i}"))], *others).first()
    totals = {name: first[f"_n{i}"] for i, name in enumerate(columns)}
    places = {name: [(int(p * (totals[name] - 1)), p * (totals[name] - 1) % 1) for p in spots] for name in columns if totals[name]}
    pivots = {}
    for i, name in enumerate(columns):
        for j, (low, part) in enumerate(places.get(name, [])):
            for rank in (low, low + 1) if part else (low,):
                pivots[name, rank] = tuple(first[f"_e{i}"][2 * j:2 * j + 2])
    ranks = sorted(pivots)
    narrow = df.select(*[value.alias(name) for name, value in values.items()])
    keys = {name: F.col(f"`{name}`") for name in columns}
    found = dict(zip(ranks, order_statistics(narrow, keys, ranks, totals, bracket_rows, sample_rows, pivots))) if ranks else {}
    result = {name: [None] * len(spots) for name in columns}
    for name, wanted in places.items():
        result[name] = [
            found[name, low] + (found[name, low + 1] - found[name, low]) * part if part else found[name, low]
            for low, part in wanted]
    return result, first


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    values: dict[str, Column],
    group_rows: int = GROUP_ROWS,
    slices: int | None = None,
    small_bytes: int | None = None,
) -> DataFrame:
    """Running sums ``rows unbounded preceding`` per key in ``order``, which must be total.

    Groups of at most ``group_rows`` rows use a plain window.  Otherwise the rows are range-partitioned
    by key and order; a slice gets the sums its key had in earlier slices.  At most the first key of a
    slice has such a carry, so the carry table has no more rows than there are slices.
    """
    df = settled(df)
    keys, order = list(keys), list(order)
    if _group_fits(df, keys, group_rows, small_bytes):
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({name: F.sum(value).over(window) for name, value in values.items()})
    spark = df.sparkSession
    checkpoint_folder(spark)
    slices = slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // GROUP_ROWS))
    inputs = {f"_value_{name}": value for name, value in values.items()}
    spread = (
        df.withColumns(inputs).repartitionByRange(slices, *keys, *order)
        .withColumn("_slice", F.spark_partition_id()).checkpoint()
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        spread.groupBy(*keys, "_slice")
        .agg(*[F.sum(f"_value_{name}").alias(f"_part_{name}") for name in values], F.lit(1).alias("_one"))
        .withColumns({f"_carry_{name}": F.sum(f"_part_{name}").over(earlier) for name in values})
        .withColumn("_later", F.sum("_one").over(earlier)).where("_later is not null")
        .select(F.col("_slice").alias("_at"), *[F.col(k).alias(f"_of_{k}") for k in keys],
                *[f"_carry_{name}" for name in values])
    )
    match = F.col("_slice") == F.col("_at")
    for key in keys:
        match &= F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    window = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = spread.join(F.broadcast(carry), match, "left")
    sums = {}
    for name in values:
        inside, before = F.sum(f"_value_{name}").over(window), F.col(f"_carry_{name}")
        sums[name] = F.coalesce(inside + before, inside, before)
    summed = joined.withColumns(sums)
    return summed.select(*df.columns, *values)


def series_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    reach: int,
    build: Callable[[Window], dict[str, Column]],
    group_rows: int = GROUP_ROWS,
    small_bytes: int | None = None,
) -> DataFrame:
    """Window columns that look back at most ``reach`` rows within a series.

    ``build`` gets the window (ordered, no frame) and returns the columns.  A series longer than
    ``group_rows`` is cut into chunks of that many rows, each with the last ``reach`` rows of the chunk
    before it.
    """
    df = settled(df)
    keys, order = list(keys), list(order)
    if _group_fits(df, keys, group_rows, small_bytes):
        return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order)))
    if group_rows < reach:
        raise ValueError("group_rows must not be smaller than reach")
    place = F.col("_place") - 1
    chunk = F.floor(place / group_rows)
    chunks = F.when(place % group_rows >= group_rows - reach, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    numbered = running(df, keys, order, {"_place": F.lit(1)}, group_rows, small_bytes=small_bytes)
    window = Window.partitionBy(*keys, "_chunk").orderBy("_place")
    added = build(window)
    return (
        numbered.withColumn("_chunk", F.explode(chunks)).withColumns(added)
        .where(F.col("_chunk") == chunk).select(*df.columns, *added)
    )
