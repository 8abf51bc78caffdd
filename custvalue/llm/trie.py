"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns. It is named by 128 bits: the XOR of the hashes of its
turns, each hashed with its depth, so names of all prefixes are running XORs, and the name of a
parent is the node's without the last turn.

Every node has an enter and an exit arc. Nodes are numbered in the order of their parents, so
siblings are neighbours, and each arc knows the next one: into the first child or out of a leaf,
on to the next sibling or out of the parent. The tour is a linked list that is ranked over all
tasks; with the arcs in their places, what a subtree holds is the difference of prefix sums at
the exit and the enter arc of its top.

No step gathers a conversation, a family of siblings or the members of a node in one task, but
for the hash of the members that end at a node: it depends on all of them in order, so one
task reads them, sorted, and holds one at a time.

Defined cases: a null role or text is empty; turns that share a number are ordered by the hashes of
role and text, so reruns agree; a null turn comes first; a null conv_id names no conversation,
and its turns are left out; repeated rows are turns of their own; very long texts are hashed in their row; an
empty table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custvalue.llm.common import settle, ship, text_of, word_count
from custvalue.llm.listrank import BLOCK, list_rank, numbered, prefix_sums

#: A conversation starts as that at its number less the remainder by FAMILY, for under SHARED turns.
FAMILY, SHARED = 20, 4
#: Turns of a conversation whose hashes are combined together.
DEPTHS = 4096
NAME = ["name_a", "name_b"]
PARENT = ["parent_a", "parent_b"]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), two hashes and the words of every turn."""
    role, text = text_of("role"), text_of("text")
    turns = conversations.where("conv_id is not null").select(
        "conv_id",
        "turn",
        F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit(1), text, role).alias("b"),
        word_count(text).alias("words"),
        # Rows alike in all else may be very many; this deals them over several ranges.
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "a", "b", "row"]
    found = numbered(turns, *(F.col(c) if isinstance(c, str) else c for c in order))
    return settle(found.select("conv_id", "number", "a", "b", "words"), "turns")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of rebuilt conversations (conv_id, depth from 1, a, b, words), and their lengths."""
    turns = ordered_turns(conversations)
    own = turns.groupBy("conv_id").agg(F.min("number").alias("start"), F.count("*").alias("size"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    own = own.withColumns({"base": base, "shared": F.crc32(F.col("conv_id").cast("string")) % SHARED})
    there = own.where("conv_id = base").select("base", F.col("size").alias("base_size"))
    convs = own.join(there, "base", "left")
    taken = F.least("shared", F.coalesce("base_size", F.lit(0)))
    convs = convs.withColumn("taken", taken)
    convs = settle(
        convs.withColumn("length", F.col("taken") + F.greatest(F.col("size") - F.col("shared"), F.lit(0))),
        "conversations",
    )
    placed = turns.join(convs.select("conv_id", "start", "shared", "taken"), "conv_id")
    place = F.col("number") - F.col("start")
    after = placed.where(place >= F.col("shared")).select(
        "conv_id", (place - F.col("shared") + F.col("taken") + 1).alias("depth"), "a", "b", "words"
    )
    heads = (
        placed.where((F.col("conv_id") % FAMILY == 0) & (place < SHARED - 1))
        .select(F.col("conv_id").alias("base"), (place + 1).alias("depth"), "a", "b", "words")
        .join(convs.select("conv_id", "base", "taken"), "base")
        .where(F.col("depth") <= F.col("taken"))
        .select("conv_id", "depth", "a", "b", "words")
    )
    return after.unionByName(heads), convs.select("conv_id", "length")


def named(turns: DataFrame, depths: int = DEPTHS) -> DataFrame:
    """Names of the prefix that ends with each turn, and of the one before it."""
    turns = settle(
        turns.select(
            "conv_id",
            "depth",
            "words",
            F.floor(F.col("depth") / depths).alias("part"),
            F.xxhash64("depth", "a", "b").alias("own_a"),
            F.xxhash64(F.lit(2), "depth", "b", "a").alias("own_b"),
        ),
        "rebuilt",
    )
    own, names = ["own_a", "own_b"], NAME
    # Only conversations of more than one part have a row here, one for each further part.
    parts = turns.groupBy("conv_id", "part").agg(*(F.bit_xor(c).alias(f"all_{c}") for c in own))
    several = turns.where("part > 0").select("conv_id").distinct()
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.join(several, "conv_id").select(
        "conv_id", "part", *(F.bit_xor(f"all_{c}").over(earlier).alias(f"before_{c}") for c in own)
    )
    upto = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    found = turns.withColumns({n: F.bit_xor(c).over(upto) for n, c in zip(names, own)})
    found = found.join(before, ["conv_id", "part"], "left").withColumns(
        {n: F.col(n).bitwiseXOR(F.coalesce(F.col(f"before_{c}"), F.lit(0))) for n, c in zip(names, own)}
    )
    return found.select(
        "conv_id",
        "depth",
        "words",
        *names,
        *(F.col(n).bitwiseXOR(F.col(c)).alias(p) for n, c, p in zip(names, own, PARENT)),
    )


def _ends_hashed(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conv_ids that end at each node, joined by commas."""
    ship(ends.sparkSession)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        a, b, digests = zip(*found)
        arrays = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digests, pa.string())]
        return pa.record_batch(arrays, names=[*NAME, "ends_sha256"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []
        for batch in batches:
            for a, b, conv_id in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (a, b):
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(b"%d" % conv_id)
                else:
                    state.update(b",%d" % conv_id)
            if len(done) >= 10_000:
                yield rows(done)
                done = []
        if node:
            yield rows([*done, (*node, state.hexdigest())])

    return (
        ends.select(*NAME, "conv_id")
        .repartition(*NAME)
        .sortWithinPartitions(*NAME, "conv_id")
        .mapInArrow(run, "name_a long, name_b long, ends_sha256 string")
    )


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """One row for each node: name, parent's name, depth, members, words of its last text, ends."""
    turns, lengths = rebuilt(conversations)
    prefixes = settle(named(turns), "prefixes")
    nodes = prefixes.groupBy(*NAME).agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.count("*").alias("n_convs"),
        F.first("words").alias("words"),
        *(F.first(p).alias(p) for p in PARENT),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = (
        lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
        .where("n_convs > 0")
        .select(
            *(zero.alias(n) for n in NAME),
            *("conv_id", zero.alias("depth"), "n_convs", zero.alias("words")),
            *(none.alias(p) for p in PARENT),
        )
    )
    ends = (
        prefixes.join(lengths, "conv_id")
        .where("depth = length")
        .select(*NAME, "conv_id")
        .unionByName(lengths.where("length = 0").select(*(zero.alias(n) for n in NAME), "conv_id"))
    )
    return nodes.unionByName(root).join(_ends_hashed(ends), NAME, "left")


def _linked(nodes: DataFrame) -> DataFrame:
    """Nodes with number, parent's number and conv_id, first child, number of children, and
    whether they are the last of their siblings."""
    order = [F.col(p).asc_nulls_first() for p in PARENT]
    rows = settle(numbered(nodes, *order, F.col("conv_id")), "nodes")
    # Siblings are neighbours: what a block has of a family is one row, whatever its size.
    parts = rows.where("depth > 0").groupBy(*PARENT, "block").agg(
        F.min("number").alias("first_child"), F.max("number").alias("last_child"), F.count("*").alias("n_children")
    )
    families = parts.groupBy(*PARENT).agg(
        F.min("first_child").alias("first_child"),
        F.max("last_child").alias("last_child"),
        F.sum("n_children").alias("n_children"),
    )
    tree = settle(rows.join(families.toDF(*NAME, "first_child", "last_child", "n_children"), NAME, "left"), "tree")
    parents = tree.select(
        *(F.col(n).alias(p) for n, p in zip(NAME, PARENT)),
        F.col("number").alias("parent"),
        F.col("conv_id").alias("parent_conv_id"),
        F.col("last_child").alias("last_sibling"),
    )
    # Joined by block as well, so a large family meets its parent in as many tasks as it has blocks.
    beside = parts.select(*PARENT, "block").join(parents, PARENT)
    return settle(
        tree.join(beside, [*PARENT, "block"], "left").select(
            *("number", "parent", "conv_id", "parent_conv_id", "depth", "n_convs", "words", "ends_sha256"),
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            "first_child",
            (F.col("number") == F.col("last_sibling")).alias("is_last"),
        ),
        "linked",
    )


def tour(nodes: DataFrame) -> DataFrame:
    """item and next of all arcs: node n is entered by arc 2n and left by arc 2n + 1."""
    enter, leave = F.col("number") * 2, F.col("number") * 2 + 1
    inward = F.when(F.col("n_children") > 0, F.col("first_child") * 2).otherwise(leave)
    onward = F.when(F.col("is_last"), F.col("parent") * 2 + 1).otherwise(enter + 2)
    onward = F.when(F.col("parent").isNotNull(), onward)
    arcs = F.array(
        F.struct(enter.alias("item"), inward.alias("next")),
        F.struct(leave.alias("item"), onward.alias("next")),
    )
    return nodes.select(F.inline(arcs))


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every node with its members, children, and the leaves and savings of its subtree."""
    nodes = _linked(prefix_nodes(conversations))
    # The rank counts from the end; sums over the arcs that follow serve as well as prefixes of
    # the reversed tour, in which a subtree's exit comes before its enter arc.
    arcs = settle(list_rank(tour(nodes)), "tour")
    leaf, saved = F.col("n_children") == 0, (F.col("n_convs") - 1) * F.col("words")
    enters = F.col("item") % 2 == 0
    weighed = arcs.withColumn("number", F.floor(F.col("item") / 2)).join(
        nodes.select("number", leaf.cast("long").alias("leaves"), saved.alias("saved")), "number"
    )
    weighed = weighed.select(
        "number",
        "rank",
        enters.alias("enters"),
        *(F.when(enters, F.col(v)).otherwise(0).alias(v) for v in ("leaves", "saved")),
    )
    sums = prefix_sums(weighed, "rank", "leaves", "saved", block=block)
    sign = F.when(F.col("enters"), 1).otherwise(-1)
    inside = sums.groupBy("number").agg(
        F.sum(F.col("leaves") * sign).alias("n_leaves"), F.sum(F.col("saved") * sign).alias("saved_tokens")
    )
    return nodes.join(inside, "number").select(
        *("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
