"""Hierarchical weighted hash tree for placing rows on shards (native).

A topology is a tree region -> rack -> shard. A row descends it: at each level
every child draws ``-ln(u) / weight`` with ``u`` hashed from the row's key and
the child's own name, and the smallest draw wins (a child wins with probability
weight / sum of weights). A draw depends on the key, the child's name and its
weight only, so when a weight changes, the draws of all other children stay:
a row moves only out of a subtree whose weight fell or into one whose weight
rose, and inside an unchanged subtree nothing moves.

Growing by one shard opens a region of its own (one rack, one shard). The new
subtree holds nothing else, hence one more shard takes rows into itself only.

All expressions are built-in functions (xxhash64, ln, array_min); no Python code
runs on the executors. Slots are numbered without one task per shard: a shard is
cut into hash ranges, the counts of the ranges are summed up in order, and rows
are numbered inside their range.

Defined results: a null key counts as the text ``null``; a null text has no
bytes (size 1, crc 0); equal keys land on the same shard; an empty table gives
an empty table; extra columns are ignored (``place`` keeps them).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.llm.common import written


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, base: int = 16, per_rack: int = 2, racks_per_region: int = 2) -> list[Shard]:
    """The tree for ``shards`` shards: the first ``base`` in full regions, each later one in its own region."""
    out = []
    for i in range(shards):
        if i < base:
            rack = i // per_rack
            out.append(Shard(f"g{rack // racks_per_region}", f"g{rack // racks_per_region}/k{rack % racks_per_region}", i))
        else:
            out.append(Shard(f"n{i}", f"n{i}/k0", i))
    return out


def _draw(key: Column, name: str, weight: float) -> Column:
    """-ln(u) / weight, u in (0, 1) from 52 hash bits."""
    bits = F.shiftrightunsigned(F.xxhash64(F.concat(key, F.lit("|" + name))), 12)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / F.lit(float(weight))


def _choose(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The child with the smallest draw; children: (name, weight, what it stands for)."""
    if len(children) == 1:
        return children[0][2]
    best = F.array_min(F.array(*[F.struct(_draw(key, name, w).alias("d"), F.lit(i).alias("i"))
                                 for i, (name, w, _) in enumerate(children)]))["i"]
    return reduce(lambda acc, iv: F.when(best == iv[0], iv[1][2]).otherwise(acc),
                  list(enumerate(children))[:-1], children[-1][2])


def shard_column(key: Column, shards: list[Shard]) -> Column:
    """The shard of ``key``; subtrees without weight are never chosen."""
    live = [s for s in shards if s.weight > 0]
    if not live:
        raise ValueError("a topology needs a shard with a positive weight")
    key = F.coalesce(key.cast("string"), F.lit("null"))

    def group(rows, level):
        out: dict[str, list[Shard]] = {}
        for s in rows:
            out.setdefault(getattr(s, level), []).append(s)
        return out

    def weight(rows):
        return sum(s.weight for s in rows)

    def leaf(rows):
        return _choose(key, [(f"{s.rack}/s{s.shard}", s.weight, F.lit(s.shard)) for s in rows])

    def rack(rows):
        return _choose(key, [(n, weight(r), leaf(r)) for n, r in group(rows, "rack").items()])

    return _choose(key, [(n, weight(r), rack(r)) for n, r in group(live, "region").items()]).cast("int")


def place(df: DataFrame, key: str, shards: list[Shard], grown: list[Shard] | None = None,
          shard_col: str = "shard", grown_col: str = "grown_shard") -> DataFrame:
    """Add the shard (and the shard under a ``grown`` topology) of every row."""
    out = df.withColumn(shard_col, shard_column(F.col(key), shards))
    return out if grown is None else out.withColumn(grown_col, shard_column(F.col(key), grown))


def number_slots(rows: DataFrame, rows_per_range: int = 100_000, shard_col: str = "shard", count_col: str = "copies", slot_col: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0, without gaps, in the order of a hash of the whole row.

    ``rows`` are different rows with their number of copies. They fall into hash ranges whose number follows the row
    count, so no task numbers a whole shard, whatever the keys are; copies of a row are one row until they have their
    numbers. The counts (shards x ranges rows) are the only table joined back.
    """
    rows = written(rows, "slots")
    ranges = max(1, -(-(rows.agg(F.sum(count_col)).first()[0] or 0) // rows_per_range))
    h = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in rows.columns if c != count_col])
    part = F.floor((F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))) * F.lit(float(ranges))).cast("int")
    rows = rows.withColumn("__h", h).withColumn("__range", part)
    counts = rows.groupBy(shard_col, "__range").agg(F.sum(count_col).alias("__n"))
    before = Window.partitionBy(shard_col).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard_col, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(shard_col, "__range").orderBy("__h", *[F.col(c).asc_nulls_first() for c in rows.columns if not c.startswith("__")]).rowsBetween(
        Window.unboundedPreceding, -1)
    first = F.col("__first") + F.coalesce(F.sum(count_col).over(inside), F.lit(0))
    out = rows.join(starts, [shard_col, "__range"]).withColumn("__from", first)
    return out.withColumn(slot_col, F.explode(F.sequence(F.col("__from"), F.col("__from") + F.col(count_col) - 1))).drop(
        "__h", "__range", "__first", "__from", count_col)


def shard_documents(docs: DataFrame, shards: int = 16, rows_per_range: int = 100_000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    now, later = topology(shards), topology(shards + 1)
    rows = place(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law")), "doc_id", now, later)
    out = number_slots(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), rows_per_range)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
