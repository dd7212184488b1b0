"""Problem 7: filling fixed-capacity containers with items.

Linear grouping, in shards of a bounded number of items: lengths above a fraction of the capacity
are sorted and rounded up within groups of equal cardinality; the few rounded sizes are packed by a
linear program over configurations (columns found by an integer knapsack), rounded down; actual
documents take the places of their group, the last place of a container the longest document that
fits, which takes back what rounding up lost; what is left is placed best-fit, large ones first,
small ones last.  A document longer than a container fills containers of its own and only its rest is
placed with the others.

Shards are drawn by hash of the id, so their number follows the data and none grows; each leaves at
most about one container partly filled.

Defined results: null and empty texts, and rows without an id, have no tokens and no container;
equal lengths are ordered by id, so the result is the same on every run; plans without a positive
capacity are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of equal cardinality; fraction of the capacity above which an item is large.
GROUPS, LARGE = 32, 0.08
#: Items that one task packs.
SHARD_ITEMS = 50_000


def best_column(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity that has the greatest value, and that value."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.flatnonzero(values > 1e-12)
    order = order[np.argsort(sizes[order], kind="stable")]
    size, value = sizes[order], values[order]
    fits = np.searchsorted(size, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        n = fits[c]
        if n:
            options = best[c - size[:n]] + value[:n]
            i = int(options.argmax())
            if options[i] > best[c] + 1e-12:
                best[c], choice[c] = options[i], order[i]
    column = np.zeros(len(sizes))
    c = capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            column[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[capacity]), column


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 200) -> list[tuple[np.ndarray, int]]:
    """Configurations of sizes and how often to use each, from the linear program rounded down."""
    k = len(sizes)
    # Coarser lengths keep the knapsack small: sizes are rounded up, so every configuration still fits.
    unit = max(1, capacity // 256)
    room = capacity // unit
    small = np.minimum(room, -(-sizes // unit)).astype(int)
    basis = np.diag((room // small).astype(float))
    uses = demand / np.diag(basis)
    for _ in range(rounds):
        try:
            prices = np.linalg.solve(basis.T, np.ones(k))
        except np.linalg.LinAlgError:
            break
        value, column = best_column(small, prices, room)
        if value <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, column)
        ratio = np.where(direction > 1e-9, uses / np.where(direction > 1e-9, direction, 1), np.inf)
        leave = int(np.argmin(ratio))
        if not np.isfinite(ratio[leave]):
            break
        uses = np.maximum(0, uses - ratio[leave] * direction)
        uses[leave] = ratio[leave]
        basis[:, leave] = column
    return [(basis[:, j].astype(int), int(uses[j] + 1e-9)) for j in range(k) if uses[j] >= 1 - 1e-9]


class _Bins:
    """Containers by free space; finds the fullest that still takes an item in constant time."""

    def __init__(self, capacity: int):
        self.capacity, self.free, self.at, self.mask = capacity, [], {}, 0

    def add(self, free: int) -> int:
        self.free.append(free)
        self._put(len(self.free) - 1, free)
        return len(self.free) - 1

    def _put(self, b: int, free: int) -> None:
        self.at.setdefault(free, []).append(b)
        self.mask |= 1 << free

    def place(self, size: int) -> int:
        fits = self.mask >> size
        if not fits:
            b = self.add(self.capacity)
            fits = self.mask >> size
        free = size + (fits & -fits).bit_length() - 1
        held = self.at[free]
        b = held.pop()
        if not held:
            self.mask &= ~(1 << free)
        self.free[b] = free - size
        self._put(b, free - size)
        return b


class _Stock:
    """Items by length; finds the longest one up to a length in constant time."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        for i in range(len(lengths) - 1, -1, -1):
            self.at[lengths[i]].append(i)
        self.mask = sum(1 << n for n, held in enumerate(self.at) if held)

    def longest(self, most: int) -> int:
        return (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1

    def take(self, length: int) -> int:
        held = self.at[length]
        i = held.pop()
        if not held:
            self.mask &= ~(1 << length)
        return i


def pack(lengths: np.ndarray, capacity: int, groups: int = GROUPS, large: float = LARGE) -> np.ndarray:
    """The container of each item; every length is between 1 and the capacity.  Items come sorted, longest first."""
    n = len(lengths)
    out = np.full(n, -1, np.int64)
    bins = _Bins(capacity)
    big = int(np.searchsorted(-lengths, -max(1, int(large * capacity)), "left"))
    if big:
        # Two items a group at least: few large items make fewer groups.
        cuts = np.linspace(0, big, max(1, min(groups, big // 2)) + 1).astype(int)
        rounded = lengths[cuts[:-1]]
        # Groups with the same rounded length are one.
        first = np.flatnonzero(np.concatenate([[True], rounded[1:] != rounded[:-1]]))
        begin, sizes = cuts[:-1][first], rounded[first].astype(int)
        stop = np.concatenate([begin[1:], [big]])
        lows = lengths[stop - 1]
        stock = _Stock(lengths[:big], capacity)
        for column, times in configurations(sizes, (stop - begin).astype(float), capacity):
            slots = [i for i in np.flatnonzero(column) for _ in range(column[i])]
            for _ in range(times):
                free, held = capacity, []
                # Actual documents take the places of their groups.  What rounding left free goes to
                # the last place, which takes the longest document that fits.
                for i in slots[:-1]:
                    top = stock.longest(min(free, int(sizes[i])))
                    if top < lows[i]:
                        continue
                    held.append(stock.take(top))
                    free -= top
                while (top := stock.longest(free)) > 0:
                    held.append(stock.take(top))
                    free -= top
                if not held:
                    break
                out[held] = bins.add(free)
    for i in np.flatnonzero(out < 0).tolist():
        out[i] = bins.place(int(lengths[i]))
    return out


def contain(counts: DataFrame, plans: DataFrame, id_col: str = "doc_id", shard_items: int = SHARD_ITEMS) -> DataFrame:
    """plan_id, container, id, piece, start, length, place for every document or piece under every plan.

    counts: id and tokens; plans: plan_id, seq_len, append_eos, a few rows (at most 1000).  start is
    the piece's first token in its document, place its first token in the container; the end token
    is part of the length.
    """
    listed = plans.where("plan_id is not null and seq_len > 0").limit(1001).collect()
    if len(listed) > 1000:
        raise ValueError("more than 1000 plans")
    schema = dict(counts.dtypes)
    if not listed:
        return counts.sparkSession.createDataFrame([], f"plan_id int, container string, `{id_col}` {schema[id_col]}, piece bigint, start bigint, length bigint, place bigint")
    shards = max(1, -(-counts.count() // shard_items))
    plan = F.explode(F.array(*[F.struct(F.lit(int(p["plan_id"])).alias("plan_id"), F.lit(int(p["seq_len"])).alias("seq_len"), F.lit(int(bool(p["append_eos"]))).alias("eos")) for p in listed]))
    items = counts.where("tokens > 0").select(F.col(id_col).alias("id"), "tokens", plan.alias("p")).select("id", "p.plan_id", "p.seq_len", (F.col("tokens") + F.col("p.eos")).alias("size"))
    items = items.withColumn("full", F.expr("size div seq_len")).withColumn("rest", F.expr("size % seq_len"))
    whole = items.where("full > 0").select("plan_id", "id", "seq_len", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1)).alias("piece"))
    whole = whole.select("plan_id", F.concat_ws("-", F.lit("w"), "id", "piece").alias("container"), "id", "piece", (F.col("piece") * F.col("seq_len")).alias("start"), F.col("seq_len").cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("place"))
    parts = items.where("rest > 0").select("plan_id", "seq_len", F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"), "id", F.col("full").alias("piece"), F.col("rest").alias("length"))
    kind = schema[id_col]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id"], ascending=[False, True], kind="stable")
        capacity = int(pdf["seq_len"].iloc[0])
        lengths = pdf["length"].to_numpy()
        box = pack(lengths, capacity)
        order = np.argsort(box, kind="stable")
        ends = np.cumsum(lengths[order])
        heads = np.concatenate([[True], box[order][1:] != box[order][:-1]])
        base = np.maximum.accumulate(np.where(heads, ends - lengths[order], 0))
        place = np.empty(len(box), np.int64)
        place[order] = ends - lengths[order] - base
        name = f"s{int(pdf['shard'].iloc[0])}-"
        return pd.DataFrame({"plan_id": pdf["plan_id"], "container": [name + str(b) for b in box.tolist()], "id": pdf["id"], "piece": pdf["piece"], "start": pdf["piece"] * capacity, "length": lengths, "place": place})

    rest = parts.groupBy("plan_id", "shard").applyInPandas(run, f"plan_id int, container string, id {kind}, piece bigint, start bigint, length bigint, place bigint")
    return whole.unionByName(rest).withColumnRenamed("id", id_col)


def usage(placed: DataFrame, plans: DataFrame) -> DataFrame:
    """Containers, tokens and share of used space per plan."""
    per = placed.groupBy("plan_id").agg(F.countDistinct("container").alias("containers"), F.sum("length").alias("tokens"))
    return per.join(plans.select("plan_id", "seq_len"), "plan_id").select("plan_id", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("seq_len"))).alias("used"))
