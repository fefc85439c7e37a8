"""Filling containers of fixed capacity by minimum bin slack over a histogram of sizes.

The fullest feasible combination of the sizes still available is found by a bitset subset-sum (one big integer per
size, bit s set when sum s can be reached), used for as many containers as the stock allows, and taken out; so one
step serves all containers of one pattern.  The planner needs the histogram only - at most ``capacity`` numbers,
however large the data - and gives at most a few patterns per size.  Items are then numbered per size and joined to
the plan: nothing but the histogram and the plan passes through the driver.

Defined results: an item longer than the capacity is cut into full pieces and a rest; items of size 0 (null and empty
texts) take no room and go to container 0; ties and repeated rows are ordered by key; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import cut

RANK_SLICES = 256  # at least, of the numbering within one size
SLICE_ROWS = 50_000  # items a slice holds, were all of one size


def fullest(sizes: list[int], stock: dict[int, int], capacity: int, first: int) -> list[int]:
    """The combination of stocked sizes that contains ``first`` and fills ``capacity`` best (largest sizes first)."""
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []  # (copies' size, copies, reach before)
    for s in sizes:
        have = stock[s] - (s == first)
        if s > room or have <= 0:
            continue
        left, chunk = min(have, room // s), 1
        while left > 0:  # binary splitting of the copies
            c = min(chunk, left)
            steps.append((s, c, reach))
            reach |= (reach << (s * c)) & mask
            left -= c
            chunk *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out = [first]
    for s, c, before in reversed(steps):
        if not before >> total & 1:
            out += [s] * c
            total -= s * c
    return out


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """[(sizes of one container, number of such containers)], using every item of the histogram once."""
    stock = {s: n for s, n in histogram.items() if n > 0 and 0 < s <= capacity}
    sizes = sorted(stock, reverse=True)
    out = []
    while sizes:
        combo = fullest(sizes, stock, capacity, sizes[0])
        need: dict[int, int] = {}
        for s in combo:
            need[s] = need.get(s, 0) + 1
        times = min(stock[s] // n for s, n in need.items())
        for s, n in need.items():
            stock[s] -= n * times
        sizes = [s for s in sizes if stock[s]]
        out.append((combo, times))
    return out


def pack(counted: DataFrame, key: str, size: str, capacity: int) -> DataFrame:
    """(container_id, key, piece, start_token, n_tokens) for every item and piece of ``counted``.

    ``counted`` should be cut from its source (checkpoint) as it is read twice.
    """
    spark = counted.sparkSession
    items = counted.select(F.col(key).alias("k"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("n"))
    full = F.greatest(F.ceil(F.col("n") / capacity).cast("long"), F.lit(1))
    pieces = items.select("k", "n", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece")).select(
        "k", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("start_token"), F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("piece") * capacity).alias("n_tokens")
    )
    # the numbering is cut into slices, as many as keep the most frequent size (full pieces, empty texts) from one task
    slices = max(RANK_SLICES, counted.count() // SLICE_ROWS)
    slice_ = F.pmod(F.xxhash64("k", "piece"), F.lit(slices)).cast("int")
    sized = pieces.withColumn("slice", slice_)
    counts = sized.groupBy("n_tokens", "slice").agg(F.count("*").alias("c"))
    offsets = counts.withColumn("before", F.sum("c").over(Window.partitionBy("n_tokens").orderBy("slice")) - F.col("c"))
    histogram = {r["n_tokens"]: r["c"] for r in counts.groupBy("n_tokens").agg(F.sum("c").alias("c")).collect()}
    rows, at, used = [], 0, dict.fromkeys(histogram, 0)
    for combo, times in plan(histogram, capacity):
        need: dict[int, int] = {}
        for s in combo:
            need[s] = need.get(s, 0) + 1
        for s, n in need.items():
            rows.append((s, used[s], used[s] + n * times, n, at))
            used[s] += n * times
        at += times
    rows.append((0, 0, histogram.get(0, 0), histogram.get(0, 1), 0))
    patterns = spark.createDataFrame(rows, "p_size long, lo long, hi long, per long, first long")
    # numbers 0.. within one size: rank inside a slice plus the rows of the slices before it
    inside = Window.partitionBy("n_tokens", "slice").orderBy("k", "piece")
    ranked = sized.withColumn("r", F.row_number().over(inside) - 1).join(offsets.select("n_tokens", "slice", "before"), ["n_tokens", "slice"])
    ranked = ranked.withColumn("r", F.col("r") + F.col("before"))
    hit = ranked.join(F.broadcast(patterns), (F.col("n_tokens") == F.col("p_size")) & (F.col("r") >= F.col("lo")) & (F.col("r") < F.col("hi")))
    container = F.when(F.col("n_tokens") == 0, F.lit(0).cast("long")).otherwise(F.col("first") + F.floor((F.col("r") - F.col("lo")) / F.col("per")))
    return hit.select(container.cast("long").alias("container_id"), F.col("k").alias(key), "piece", "start_token", "n_tokens")


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048) -> DataFrame:
    """Containers of ``capacity`` tokens of byte_bpe_50k for all rows of ``df``."""
    from .bpe import count_tokens

    return pack(cut(count_tokens(df, key, text)), key, "n_tokens", capacity)
