"""Products bought together.

Counting pairs needs the pairs of every basket, so baskets with very many products are the danger.  Rows
are first reduced to one per basket and product.  If some basket is larger than a block:

* pairs that cannot reach the wanted count are not formed: by Cauchy and Schwarz a pair's count is at most
  the product of the two products' norms over all baskets.  For a top-n the count to reach is found from
  the pairs of a few strong products, whose n-th best count bounds the answer's from below.
* the products of such a basket are dealt into blocks, and every two blocks meet under their own key, so no
  task pairs more than about block by block products.
* products that are whole numbers travel packed: lists as differences, and pairs counted per task, a row
  per part of the pairs instead of a row per pair (:mod:`bizlens.operators.packed`).

All keep the result exact.
"""

from __future__ import annotations

import gc
import time
from functools import partial
from math import ceil

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType, StructType

from bizlens.operators import packed
from bizlens.operators.joins import attach
from bizlens.operators.scale import settled

cloudpickle.register_pickle_by_value(packed)  # workers need not find this package

#: Distinct products of one basket that one task pairs up.
BLOCK_PRODUCTS = 256
#: Strong products whose pairs give the first bound of a top-n.
PROBE_PRODUCTS = 512
#: Pairs that one task forms and counts: baskets are dealt by their pairs, since a few bytes of a basket make many of them.
TASK_PAIRS = 500_000
#: Pairs that one task forms and counts when they are packed, beyond so many parts: the rows of a shuffle grow with their square.
PACKED_PAIRS = 4_000_000
FEW_PARTS = 200
#: Rows of one basket, and of all baskets together, that one task makes distinct.
BASKET_ROWS = 1_000_000
LIST_ROWS = 500_000


def _cells(items: DataFrame, block: int, large: DataFrame | None, parts: int, entry: Column) -> DataFrame:
    """(_same, _first, _second): lists of products to be paired, all of one basket; within one list where ``_same``.

    A list has a row of its own and not one per product; it is copied once per block of its basket.  Without ``large`` the items
    are dealt by basket.
    """
    if large is None:
        lists = items.groupBy("_txn").agg(F.collect_list(entry).alias("_first"))
        return lists.select(F.lit(True).alias("_same"), "_first", F.col("_first").alias("_second"))
    sized = attach(items, large, "_txn", "_rows", "left")
    blocks = F.coalesce(F.ceil(F.col("_size") / block).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("_product"), blocks).cast("int")
    dealt = sized.select("_txn", own.alias("_i"), blocks.alias("_blocks"), entry.alias("_entry")).repartition(parts, "_txn", "_i")
    lists = dealt.groupBy("_txn", "_i", "_blocks").agg(F.collect_list("_entry").alias("_list"))
    copies = lists.select("_txn", "_i", "_list", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_j"))
    least, most = F.least("_i", "_j"), F.greatest("_i", "_j")
    met = copies.select("_txn", least.alias("_low"), most.alias("_high"), "_list").repartition(parts, "_txn", "_low", "_high")
    same = F.col("_low") == F.col("_high")
    both = met.groupBy("_txn", "_low", "_high").agg(F.collect_list("_list").alias("_lists"))
    return both.select(same.alias("_same"), F.get("_lists", F.lit(0)).alias("_first"), F.get("_lists", F.when(same, 0).otherwise(1)).alias("_second"))


def _pairs(items: DataFrame, block: int, large: DataFrame | None, floor: int, parts: int) -> DataFrame:
    """Counts of all pairs that can reach ``floor``."""
    entry = F.struct("_product", "_weight", *(["_square"] if floor > 1 else []))
    cells = _cells(items, block, large, parts, entry).select("_same", F.explode("_first").alias("a"), "_second")
    met = cells.select("_same", "a", F.explode("_second").alias("b"))
    together = ~F.col("_same") | (F.col("a._product") < F.col("b._product"))
    if floor > 1:
        together &= F.col("a._square") * F.col("b._square") >= F.lit(float(floor) ** 2 * (1 - 1e-9))
    pairs = met.where(together).select(
        F.least("a._product", "b._product").alias("product_a"), F.greatest("a._product", "b._product").alias("product_b"),
        (F.col("a._weight") * F.col("b._weight")).alias("_both"))
    return pairs.groupBy("product_a", "product_b").agg(F.sum("_both").alias("pair_count"))


def _sizes(sizes: DataFrame) -> tuple[int, int, float]:
    """Size of the largest basket, of all together, and the number of all pairs."""
    pairs = F.sum(F.col("_size").cast("double") * (F.col("_size") - 1) / 2)
    return tuple(value or 0 for value in sizes.agg(F.max("_size"), F.sum("_size"), pairs).first())


def _parts(pairs: float) -> int:
    """In how many parts all pairs are formed."""
    return max(1, ceil(pairs / TASK_PAIRS))


def _packed_parts(pairs: float) -> tuple[int, int]:
    """In how many parts packed pairs are formed, and in how many they are added up."""
    few = min(_parts(pairs), FEW_PARTS)
    return max(few, ceil(pairs / PACKED_PAIRS)), _prime(max(few, ceil(pairs / packed.HELD_PAIRS)))


def _prime(least: int) -> int:
    """The first prime from ``least`` on: ids that share a factor are dealt evenly by their remainders."""
    n = max(2, least)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def _kept(df: DataFrame) -> DataFrame:
    """``df`` settled, and the shuffle files before it let go if it was written: Spark removes them once nothing refers to them."""
    result = settled(df)
    if result is not df:
        del df
        for _ in range(2):  # listeners still hold the plan while they work off its events
            gc.collect()
            result.sparkSession.sparkContext._jvm.System.gc()
            time.sleep(0.5)
    return result


class _Packed:
    """Pairs of whole numbers; a basket of more than ``BASKET_ROWS`` rows is packed as several lists (``_share``)."""

    def __init__(self, named: DataFrame, weight: Column, by_rows: bool, block: int, most: int, rows: int):
        self.block, self.by_rows, self.rows, self.hot, self.keys = block, by_rows, rows, None, ["_basket"]
        self.txn = named.schema["_txn"]
        self.names = ["_product", "_weight"] if by_rows else ["_product"]
        listed = named.select("_txn", F.col("_product").cast("long").alias("_product"))
        if most > BASKET_ROWS:
            sizes = named.groupBy("_txn").agg(F.count("*").alias("_size")).where(F.col("_size") > BASKET_ROWS)
            shares = F.ceil(F.col("_size") / BASKET_ROWS).cast("int")
            self.hot = F.broadcast(settled(sizes.select("_txn", shares.alias("_shares"))))
            self.keys = ["_basket", "_share"]
            share = F.coalesce(F.pmod(F.xxhash64("_product"), "_shares").cast("int"), F.lit(0))
            listed = listed.join(self.hot, "_txn", "left").select("_txn", "_product", share.alias("_share"))
        self.lists = _kept(self._packed(self._spread(listed).groupBy(*self.keys, "_product").agg(weight.alias("_weight")), self.names))

    def _with_txn(self, columns: str) -> StructType:
        return StructType([self.txn, *StructType.fromDDL(columns).fields])

    def _spread(self, entries: DataFrame) -> DataFrame:
        return entries.withColumnRenamed("_txn", "_basket").repartition(max(1, ceil(self.rows / LIST_ROWS)), *self.keys)

    def _packed(self, spread: DataFrame, names: list[str]) -> DataFrame:
        share = F.lit(0) if self.hot is None else F.col("_share")
        lists = spread.groupBy(*self.keys).agg(F.collect_list(F.struct(*names)).alias("_list"))
        return lists.select("_basket", share.alias("_share"), "_list").mapInArrow(partial(packed.baskets, fields=len(names)), self._with_txn("_share int, _size int, _packed binary"))

    def listed(self, entries: DataFrame, names: list[str]) -> DataFrame:
        return self._packed(self._spread(entries), names)

    def entries(self) -> DataFrame:
        schema = self._with_txn("_share int, _product bigint, _weight bigint")
        return self.lists.mapInArrow(partial(packed.entries, fields=len(self.names)), schema)

    def norms(self) -> DataFrame:
        sums = self.lists.mapInArrow(partial(packed.squares, fields=len(self.names)), "_product bigint, _square bigint, _rows bigint")
        return sums.groupBy("_product").agg(F.sum("_square").cast("double").alias("_square"), F.sum("_rows").alias("_rows"))

    def _numbered(self, lists: DataFrame) -> DataFrame:
        """(_txn, _before, _total, _packed): blocks of a basket before a list, and all its blocks."""
        own = F.ceil(F.col("_size") / self.block).cast("int")
        if self.hot is None:
            return lists.select("_txn", F.lit(0).alias("_before"), own.alias("_total"), "_packed")
        owned = F.collect_list(F.struct("_share", own.alias("_own")))
        each = lists.join(self.hot, "_txn", "left_semi").groupBy("_txn").agg(owned.alias("_each"))
        joined = lists.join(F.broadcast(each), "_txn", "left")
        total = F.aggregate("_each", F.lit(0), lambda n, x: n + x["_own"])
        before = F.aggregate("_each", F.lit(0), lambda n, x: n + F.when(x["_share"] < F.col("_share"), x["_own"]).otherwise(0))
        return joined.select("_txn", F.coalesce(before, F.lit(0)).alias("_before"), F.coalesce(total, own).alias("_total"), "_packed")

    def pairs(self, lists: DataFrame, names: list[str], floor: int, min_count: int, parts: int, kinds: int) -> DataFrame:
        """Counts of all pairs that can reach ``floor``, of those with ``min_count``."""
        cut = partial(packed.blocks, fields=len(names), block=self.block)
        blocks = self._numbered(lists).mapInArrow(cut, self._with_txn("_i int, _blocks int, _packed binary"))
        dealt = blocks.repartition(parts, "_txn", "_i")
        copies = dealt.select("_txn", "_i", "_packed", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_j"))
        high = F.greatest("_i", "_j").cast("long")
        cell = F.shiftright(high * (high + 1), 1) + F.least("_i", "_j")
        met = copies.select("_txn", cell.alias("_cell"), "_packed").repartition(parts, "_txn", "_cell")
        lists = met.groupBy("_txn", "_cell").agg(F.collect_list("_packed").alias("_lists")).select("_lists")
        form = partial(packed.pairs, fields=len(names), weighted=self.by_rows, floor=floor if "_square" in names else 1, parts=kinds)
        formed, counts = lists.mapInArrow(form, "_part int, _pairs binary"), packed.counts
        return formed.groupBy("_part").applyInArrow(
            lambda table: counts(table, kinds, min_count), "product_a bigint, product_b bigint, pair_count bigint")


def _packed_pair_counts(
    named: DataFrame, weight: Column, by_rows: bool, block: int, most: int, rows: int, min_count: int, n: int | None, probe: int,
) -> DataFrame:
    """Counts of pairs of whole numbers, with the n-th best count as the least one when only ``n`` are wanted."""
    baskets = _Packed(named, weight, by_rows, block, most, rows)
    parts, kinds = _packed_parts(_sizes(baskets.lists)[2])
    lists, names, floor = baskets.lists, baskets.names, min_count
    if n is not None or min_count > 1:
        norms = baskets.norms()
        if n is not None:
            strong = norms.orderBy(F.desc("_square"), "_product").limit(probe).select("_product")
            few = baskets.listed(baskets.entries().join(F.broadcast(strong), "_product", "left_semi"), names)
            reached = _ranked(baskets.pairs(few, names, 1, 1, parts, kinds)).offset(n - 1).limit(1).collect()
            floor = max([floor] + [row.pair_count for row in reached])
        least, strongest = norms.agg(F.min("_square"), F.max("_square")).first()
        wanted = float(floor) ** 2 * (1 - 1e-9)
        if least * least < wanted:  # else no pair is ruled out
            able = norms.where(F.col("_square") * strongest >= F.lit(wanted)).withColumn("_square", F.col("_square").cast("long"))
            names = ["_product", "_weight", "_square"] if by_rows else ["_product", "_square"]
            lists = baskets.listed(attach(baskets.entries(), able, "_product", "_rows"), names)
    return baskets.pairs(lists, names, floor, max(min_count, floor), parts, kinds)


def _ranked(pairs: DataFrame) -> DataFrame:
    return pairs.orderBy(F.desc("pair_count"), "product_a", "product_b")


def pair_counts(
    df: DataFrame, txn: str, product: str, min_count: int = 1, n: int | None = None, by_rows: bool = True,
    block: int = BLOCK_PRODUCTS, probe: int = PROBE_PRODUCTS,
) -> DataFrame:
    """How often two products share a transaction, each unordered pair once (``product_a < product_b``).

    ``by_rows`` counts pairs of rows, so a product that is listed twice counts twice; otherwise every
    transaction counts a pair once.  ``min_count`` leaves out rarer pairs, ``n`` keeps the most frequent.
    """
    weight = F.count("*") if by_rows else F.lit(1).cast("long")
    known = df.where(F.col(txn).isNotNull() & F.col(product).isNotNull())
    named = known.select(F.col(txn).alias("_txn"), F.col(product).alias("_product"))
    most, rows, formed = _sizes(named.groupBy("_txn").agg(F.count("*").alias("_size")))
    kind = named.schema["_product"].dataType
    if most > block and isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        pairs = _packed_pair_counts(named, weight, by_rows, block, most, rows, min_count, n, probe)
        pairs = pairs.select(F.col("product_a").cast(kind), F.col("product_b").cast(kind), "pair_count")
        return pairs if n is None else _ranked(pairs).limit(n)
    large, parts = None, _parts(formed)
    if most > block:
        items = settled(named.groupBy("_txn", "_product").agg(weight.alias("_weight")))
        sizes = items.groupBy("_txn").agg(F.count("*").alias("_size"))
        parts = _parts(_sizes(sizes)[2])
        large = sizes.where(F.col("_size") > block).withColumn("_rows", F.col("_size"))
    else:
        items = named.repartition(parts, "_txn").groupBy("_txn", "_product").agg(weight.alias("_weight"))
    floor, kept = min_count, items
    if large is not None and (n is not None or min_count > 1):
        square = F.sum(F.col("_weight") * F.col("_weight")).cast("double")
        norms = items.groupBy("_product").agg(square.alias("_square"), F.count("*").alias("_rows"))
        if n is not None:
            strong = norms.orderBy(F.desc("_square"), "_product").limit(probe).select("_product")
            few = items.join(F.broadcast(strong), "_product", "left_semi")
            reached = _ranked(_pairs(few, block, large, 1, parts)).offset(n - 1).limit(1).collect()
            floor = max([floor] + [row.pair_count for row in reached])
        if floor > 1:
            strongest = norms.agg(F.max("_square")).scalar()
            able = norms.where(F.col("_square") * strongest >= F.lit(float(floor) ** 2 * (1 - 1e-9)))
            kept = attach(items, able, "_product", "_rows")
    pairs = _pairs(kept, block, large, floor if large is not None else 1, parts)
    if min_count > 1:
        pairs = pairs.where(F.col("pair_count") >= min_count)
    return pairs if n is None else _ranked(pairs).limit(n)
