"""Products bought by the same customers, ranked by lift.

Products are numbered by their buyers, the rarest first. A basket gives every
product in it the list of those with larger numbers, so that what travels is
one row a purchase and four bytes a pair; a task has all lists of its products,
counts their pairs by sorting numbers, and passes on those seen often enough.
A customer with many products would list all pairs of them in one task, so
baskets are cut into blocks of products: two blocks of one customer meet in a
place of their own, which sees at most BLOCK x BLOCK pairs. A product with very
many buyers is counted in several places, by its partners' numbers. Each task
keeps only the best partners of a product before the final ranking (a window
group limit).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.session import scratch_path

#: Products of one block of a basket.
BLOCK = 256
#: Pairs that a task counts, and buyers of a product that one place takes.
TASK_PAIRS = 1 << 22
PLACE_BUYERS = 1 << 16
#: Pairs that are listed, or held uncounted, at once.
LISTED_PAIRS = 1 << 18


def baskets(df: DataFrame, customer: str = "customer_id", product: str = "product_id") -> DataFrame:
    """(customer, product) once each; rows without either are left out."""
    rows = df.select(F.col(customer).alias("customer"), F.col(product).alias("product"))
    return rows.where(F.col("customer").isNotNull() & F.col("product").isNotNull()).distinct()


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(bought: DataFrame) -> DataFrame:
    """(product, buyers, number): products by rising buyers, then by name, numbered from 0."""
    sold = bought.groupBy("product").agg(F.count(F.lit(1)).alias("buyers"))
    # The id holds the task in its upper bits, the row in the lower 33.
    ids = _stored(sold.orderBy("buyers", "product").withColumn("id", F.monotonically_increasing_id()), "products")
    ids = ids.withColumn("task", F.shiftright("id", 33))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = ids.groupBy("task").agg(F.count(F.lit(1)).alias("n")).select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return ids.join(first, "task").select("product", "buyers", F.expr("int(start + id - shiftleft(task, 33))").alias("number"))


def _places(bought: DataFrame, products: DataFrame, block: int) -> DataFrame:
    """(customer, i, j, low, high): two blocks of one basket; of a block with itself ``high`` is empty. Above a number's 31 bits is the count of its places."""
    blocks = bought.groupBy("customer").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1")
    # Only heavy baskets are in ``blocks``; the others are one block.
    cut = bought.join(products, "product").select("customer", "number", F.expr(f"number + shiftleft(1 + buyers div {PLACE_BUYERS}, 31)").alias("packed")).join(blocks, "customer", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("number"), F.col("blocks")).cast("int"))
    met = cut.select("customer", "packed", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    return met.groupBy("customer", "i", "j").agg(
        F.collect_list(F.when(F.expr("own = i"), F.col("packed"))).alias("low"), F.collect_list(F.when(F.expr("own > i"), F.col("packed"))).alias("high")
    )


def _by_number(packed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers in rising order, in how many places each is counted)."""
    packed = np.array(packed, "i8")
    packed = packed[np.argsort(packed & 0x7FFFFFFF)]
    return (packed & 0x7FFFFFFF).astype("<i4"), packed >> 31


def _partner_lists(places: DataFrame) -> DataFrame:
    """(owner, slot, partners): the products of a place with larger numbers than their owner, as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, slots, lists, listed = [], [], [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(owners, pa.int32()), pa.array(slots, pa.int32()), pa.array(lists, pa.binary())], names=["owner", "slot", "partners"])

        def pairs(same: bool, low: tuple, high: tuple) -> Iterator[tuple[tuple, np.ndarray, np.ndarray]]:
            """(products, partners, where the partners of each product begin)."""
            if same:
                yield low, low[0], np.arange(1, len(low[0]) + 1)
            else:
                yield low, high[0], np.searchsorted(high[0], low[0])
                yield high, low[0], np.searchsorted(low[0], high[0])

        for some in batches:
            for same, low, high in zip(*(c.to_pylist() for c in some.columns)):
                low, high = (_by_number(x) for x in (low, high))
                for (own, ways), others, begins in pairs(same, low, high):
                    data = others.tobytes()
                    for owner, begin, n in zip(own.tolist(), begins.tolist(), ways.tolist()):
                        if begin == len(others):
                            continue
                        for slot in range(n):
                            rest = data[4 * begin :] if n == 1 else others[begin:][others[begin:] % n == slot].tobytes()
                            if rest:
                                owners.append(owner)
                                slots.append(slot)
                                lists.append(rest)
                        listed += len(others) - begin
                if listed >= LISTED_PAIRS:
                    yield batch()
                    owners, slots, lists, listed = [], [], [], 0
        if owners:
            yield batch()

    return places.select(F.expr("i = j"), "low", "high").mapInArrow(run, "owner int, slot int, partners binary")


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in rising order and the sums of their counts."""
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return key[starts], np.add.reduceat(np.concatenate(counts)[order], starts)


def _counted(lists: DataFrame, parts: Column, min_together: int) -> DataFrame:
    """(a, b, together) by number, a < b, of pairs listed at least ``min_together`` times; lists of one owner and slot meet in one of ``parts`` groups."""

    def run(table: pa.Table) -> pa.Table:
        keys, counts, new, held = [], [], [], 0

        def settle() -> None:
            """Count what is held; ``keys`` and ``counts`` are then one array each."""
            nonlocal keys, counts, new, held
            key = np.concatenate(new)
            key.sort()
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            keys.append(key[starts])
            counts.append(np.diff(np.r_[starts, len(key)]))
            if len(keys) > 1:
                key, count = _merged(keys, counts)
                keys, counts = [key], [count]
            new, held = [], 0

        for some in table.to_batches():
            lists = some.column(1)
            ends = np.frombuffer(lists.buffers()[1], "<i4")[lists.offset : lists.offset + len(lists) + 1] // 4
            sizes, partners = np.diff(ends), np.frombuffer(lists.buffers()[2], "<i4", ends[-1] - ends[0], 4 * ends[0])
            new.append(np.repeat(np.asarray(some.column(0)).astype(np.int64) << 32, sizes) | partners)
            held += len(partners)
            # Counting again what was counted pays once as much is new.
            if held >= TASK_PAIRS + (len(keys[0]) if keys else 0):
                settle()
        if new:
            settle()
        key, count = (keys[0], counts[0]) if keys else (np.zeros(0, "i8"), np.zeros(0, "i8"))
        often = count >= min_together
        columns = [(key[often] >> 32).astype("i4"), (key[often] & 0x7FFFFFFF).astype("i4"), count[often].astype("i8")]
        return pa.table([pa.array(c) for c in columns], names=["a", "b", "together"])

    dealt = lists.select("owner", "partners", F.pmod(F.xxhash64("owner", "slot"), parts).alias("part"))
    return dealt.groupBy("part").applyInArrow(run, "a int, b int, together long")


def _numbered_pairs(bought: DataFrame, block: int, min_together: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, together) by number, and the numbered products; ``bought`` is read several times."""
    products = numbered(bought)
    sizes = bought.groupBy("customer").agg(F.count(F.lit(1)).cast("double").alias("n"))
    parts = sizes.agg(F.expr(f"1 + bigint(coalesce(sum(n * (n - 1) / 2), 0) / {TASK_PAIRS})")).scalar()
    return _counted(_partner_lists(_places(bought, products, block)), parts, min_together), products


def pair_counts(bought: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, together) with a < b: how many customers bought both."""
    if block < 1:
        raise ValueError("block must be >= 1")
    pairs, products = _numbered_pairs(_stored(bought, "bought"), block, 1)
    for number, name in (("a", "x"), ("b", "y")):
        pairs = pairs.join(products.select(F.col("number").alias(number), F.col("product").alias(name)), number)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "together")


def co_purchases(
    df: DataFrame, k: int = 5, min_together: int = 2, customer: str = "customer_id", product: str = "product_id", block: int = BLOCK
) -> DataFrame:
    """The ``k`` best partners of every product: product, partner, rank, together, lift.

    Lift is how much more often two products share a customer than chance
    would have it: together x customers / (buyers of one x buyers of the other).
    Pairs with fewer than ``min_together`` common customers are not ranked. Ties
    go to the pair seen more often, then to the smaller partner.
    """
    if block < 1:
        raise ValueError("block must be >= 1")
    bought = _stored(baskets(df, customer, product), "bought")
    customers = bought.agg(F.count_distinct("customer")).scalar()
    pairs, products = _numbered_pairs(bought, block, min_together)
    for number, buyers in (("a", "na"), ("b", "nb")):
        pairs = pairs.join(products.select(F.col("number").alias(number), F.col("buyers").alias(buyers)), number)
    ways = pairs.select("together", F.explode(F.expr("array(struct(a AS number, na AS buyers, b AS partner, nb AS partner_buyers), struct(b AS number, nb AS buyers, a AS partner, na AS partner_buyers))")).alias("way")).select("together", "way.*")
    chance = (F.col("buyers") * F.col("partner_buyers")).cast("double")
    ways = ways.select("number", "partner", "together", ((F.col("together") * customers).cast("double") / chance).alias("lift"))
    # Partners with equal lift and count have equal buyers, and those are numbered by name.
    best = Window.partitionBy("number").orderBy(F.desc("lift"), F.desc("together"), "partner")
    ranked = ways.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    for number, name in (("number", "product"), ("partner", "partner_name")):
        ranked = ranked.join(products.select(F.col("number").alias(number), F.col("product").alias(name)), number)
    return ranked.select("product", F.col("partner_name").alias("partner"), "rank", "together", "lift")
