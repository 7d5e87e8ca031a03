"""The trie of all conversations' turns, built by halving the depth (van Emde Boas recursion).

A trie of height ``h`` is cut at half its depth: the prefixes up to the cut are named, the part
above is a trie of half the height, the parts below are a forest of such tries, one below each
named prefix. Both halves are cut again, all pieces of one height in the same round, so a trie of
depth ``D`` takes ``log2 D`` rounds whatever its width, and every prefix of every conversation is named
once. Names are 128-bit: of a turn from its role and text, of a stretch of ``2^k`` turns from its two
halves, of a prefix from the prefix at the cut above and the stretch below it.

Totals go the same way back: the totals of the pieces below a cut (their roots' totals) are grafted
onto the nodes between that cut and the one above, the lowest pieces first.

Rows are (conversation, depth); a conversation of any number of turns is spread over
tasks, and a prefix that all conversations share is counted by partial aggregates. The ids that end at one
node are joined to chunks of text first, and one task hashes a node's chunks in order without holding them.

Defined results: rows of equal turn are ordered by role and text; null roles and texts are empty; rows
without conv_id belong to no conversation and are left out; repeated rows are turns like others; an empty
table has no nodes (not even the root); extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.common import discard, freed_shuffles, written
from salesflow.operators.blocks import row_index

_SEED = 20_261_203


def _named(a: list, b: list) -> list[Column]:
    """A 128-bit name of two lists of columns, one for each half."""
    return [F.xxhash64(*a), F.xxhash64(F.lit(_SEED), *b)]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, i, s1, s2, chars): turns in order from 0, named by role and text."""
    rows = conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    with freed_shuffles(rows.sparkSession):
        rows = row_index(rows, ["turn", "role", "text"], ["conv_id"], "i")
    s1, s2 = _named(["role", "text"], ["text", "role"])
    return rows.select("conv_id", "i", s1.alias("s1"), s2.alias("s2"), F.length("text").cast("long").alias("chars"))


def rebuilt(rows: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, i, s1, s2, chars) after the opening of each family's first conversation, and all conv_ids.

    Conversation ``c`` opens with the first ``crc32(c) % most`` turns of ``c - c % family``, in place of as many of its own.
    """
    convs = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("size"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.select("conv_id", "size", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    convs = written(convs.join(sizes, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_size", F.lit(0)))), "trie-convs")
    openings = rows.where(F.col("i") < most - 1).withColumnRenamed("conv_id", "base")
    lead = convs.select("conv_id", "base", "h").join(openings, "base").where("i < h").select("conv_id", "i", "s1", "s2", "chars")
    own = rows.join(convs.select("conv_id", "h", "taken"), "conv_id").where("i >= h")
    own = own.select("conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("i"), "s1", "s2", "chars")
    return written(lead.unionByName(own), "trie-turns"), convs.select("conv_id")


def prefixes(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, int]:
    """(conv_id, d, n1, n2, chars): the name of every prefix, ``chars`` of its last turn; and the number of rounds."""
    deepest = rows.agg(F.max("i")).first()[0]
    rounds = 0 if deepest is None else (deepest + 1).bit_length()
    # names of whole stretches of 2^k turns, from their halves
    blocks = [rows]
    for _ in range(1, rounds):
        half = lambda odd: F.max(F.when(F.col("i") % 2 == odd, F.struct("s1", "s2", "chars")))  # noqa: B023, E731
        pairs = blocks[-1].groupBy("conv_id", F.shiftright("i", 1).alias("i")).agg(half(0).alias("a"), half(1).alias("b"))
        s1, s2 = _named(["a.s1", "b.s1"], ["a.s2", "b.s2"])
        whole = pairs.where("a is not null and b is not null")
        blocks.append(written(whole.select("conv_id", "i", s1.alias("s1"), s2.alias("s2"), F.col("b.chars").alias("chars")), "trie-blocks"))
    named = [convs.select("conv_id", F.lit(0).cast("long").alias("d"), *(F.lit(0).cast("long").alias(n) for n in ("n1", "n2", "chars")))]
    for k in reversed(range(rounds)):
        lower = blocks[k].where(F.col("i") % 2 == 0).withColumn("d", F.shiftleft("i", k))
        s1, s2 = _named(["n1", "s1"], ["n2", "s2"])
        name = [(F.col("d") + (1 << k)).alias("d"), s1.alias("n1"), s2.alias("n2"), "chars"]
        # below the root the name above is fixed; other cuts were named in earlier rounds
        found = lower.where("d = 0").withColumns({n: F.lit(0).cast("long") for n in ("n1", "n2")}).select("conv_id", *name)
        if k + 1 < rounds:
            cuts = named[1]
            for t in named[2:]:
                cuts = cuts.unionByName(t)
            below = lower.where("d > 0").join(cuts.select("conv_id", "d", "n1", "n2"), ["conv_id", "d"])
            found = found.unionByName(below.select("conv_id", *name))
        named.append(written(found, "trie-names"))
        if k:
            discard(blocks[k])
    out = named[0]
    for t in named[1:]:
        out = out.unionByName(t)
    return written(out, "trie-prefixes"), rounds


NODE = ["d", "n1", "n2"]


def nodes(members: DataFrame) -> DataFrame:
    """Nodes with smallest member, number of members and children, and the node above (p1, p2)."""
    found = members.groupBy(*NODE).agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"))
    above = members.select(F.col("conv_id").alias("owner"), (F.col("d") + 1).alias("d"), F.col("n1").alias("p1"), F.col("n2").alias("p2"))
    found = written(found.join(above, ["owner", "d"], "left"), "trie-nodes")
    children = found.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    out = written(found.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes")
    discard(found)
    return out


def subtree_totals(found: DataFrame, members: DataFrame, rounds: int) -> DataFrame:
    """(d, n1, n2, n_leaves, saved): sums over each node's subtree, grafted upward from the lowest pieces."""
    own = found.select(*NODE, F.col("owner").alias("conv_id"), (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    sums = [F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")]
    parts = [own]
    for k in range(rounds):
        # roots of the pieces of height 2^k below a cut: all that lies under them has been grafted onto them
        roots = None
        for p in parts:
            p = p.where(F.col("d").bitwiseAND(F.lit((2 << k) - 1)) == (1 << k))
            roots = p if roots is None else roots.unionByName(p)
        roots = roots.groupBy(*NODE).agg(F.max("conv_id").alias("conv_id"), *sums)
        piece = (F.shiftright("d", k) - 1).alias("piece")
        above = members.select("conv_id", *NODE, F.shiftright("d", k).alias("piece"))
        grafts = roots.select("conv_id", piece, "n_leaves", "saved").join(above, ["conv_id", "piece"])
        parts.append(written(grafts.select(*NODE, "conv_id", "n_leaves", "saved"), "trie-grafts"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*NODE).agg(*sums)


def ends(members: DataFrame, chunk: int = 1 << 13) -> DataFrame:
    """(d, n1, n2, ends_sha256) of nodes at which conversations end: SHA-256 of their ids, ascending, comma-joined."""
    last = members.groupBy("conv_id").agg(F.max(F.struct(*NODE)).alias("n")).select("n.d", "n.n1", "n.n2", "conv_id")

    def edges(d, n1, n2) -> np.ndarray:
        return np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (n1[1:] != n1[:-1]) | (n2[1:] != n2[:-1])])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, chunk) for i in range(0, batch.num_rows, chunk)):
                d, n1, n2, ids = (part.column(i).to_numpy() for i in range(4))
                start = edges(d, n1, n2)
                text = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(start, [*start[1:], len(ids)], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c[start]) for c in (d, n1, n2, ids)] + [pa.array(text)], [*NODE, "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != node:
                    if node is not None:
                        out.append((*node, sha.hexdigest()))
                    node, sha = row[:3], hashlib.sha256(row[4].encode())
                else:
                    sha.update(b"," + row[4].encode())
            yield pa.RecordBatch.from_pylist([dict(zip(names, o, strict=True)) for o in out], schema)
        if node is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*node, sha.hexdigest()), strict=True))], schema)

    names = [*NODE, "ends_sha256"]
    schema = pa.schema([*((n, pa.int64()) for n in NODE), ("ends_sha256", pa.string())])
    last = last.select(*NODE, F.col("conv_id").cast("long").alias("conv_id"))
    joined = last.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(
        chunks, "d long, n1 long, n2 long, first long, ids string")
    return joined.repartition("n1", "n2").sortWithinPartitions(*NODE, "first").mapInArrow(
        digests, "d long, n1 long, n2 long, ends_sha256 string")


def trie(conversations: DataFrame, family: int = 100, most: int = 6) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, convs = rebuilt(turns(conversations), family, most)
    members, rounds = prefixes(rows, convs)
    found = nodes(members)
    totals = subtree_totals(found, members, rounds)
    parents = found.select((F.col("d") + 1).alias("d"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    out = found.join(totals, NODE).join(ends(members), NODE, "left").join(parents, ["d", "p1", "p2"], "left")
    return out.select(F.col("owner").alias("conv_id"), F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
