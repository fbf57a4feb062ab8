"""Prefix trie of conversations: every node is owned by its smallest member.

A conversation is a path of turns from the textless root, named by a chained hash.  The
conversation that owns a node owns every deeper node of its own path, so each one owns a
suffix of its path.  Windows mark the owned nodes; then one group-by of the prefix names sums
what the members occupy less what they own, which is what sharing the prefix saves.

Node names are dealt with a salt of the conversation, so the root and a common opening, which
very many conversations pass, are spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import Scratch

#: Conversation ids that one packed row of a node's ends holds at most.
PACK = 4096
_ROOT = hashlib.sha256(b"").digest()[:16]


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, p, digest, n): each turn's place from 0, the hash of its role and text, and its text's UTF-8 bytes.

    Turns are ordered by ``turn_col``, null first; equal ones by their hash.  A null role or
    text is empty.  Rows of a null conversation belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest")
    return rows.select("conv", (F.row_number().over(order) - 1).cast("long").alias("p"), "digest", "n")


def shared_openings(placed: DataFrame, convs: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """(conv, part, p, digest, n): each conversation opened by the first turns of its family's first conversation.

    Conversation c takes the first h turns of conversation c - c % family, all if there are
    fewer and none if there is no such conversation, then its own turns after its first h;
    h is the crc32 of c in decimal, modulo ``heads``.
    """
    h = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % heads
    heirs = convs.select("conv", (F.col("conv") - F.col("conv") % family).alias("base"), h("conv").alias("h"))
    opening = placed.filter(F.col("p") < heads - 1).withColumnRenamed("conv", "base").join(heirs, "base").filter("p < h")
    own = placed.filter(F.col("p") >= h("conv"))
    return opening.select("conv", F.lit(0).alias("part"), "p", "digest", "n").unionByName(own.select("conv", F.lit(1).alias("part"), "p", "digest", "n"))


def _paths(steps: DataFrame) -> DataFrame:
    """(conv, depth, key, n, last): the nodes on each conversation's path, root first.

    A task streams its conversations turn by turn and holds one name.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (conv, depth, key, n) of the row before, until it is known to be the last
        for b in batches:
            out: list[tuple] = []
            for conv, digest, n in zip(b.column("conv").to_pylist(), b.column("digest").to_pylist(), b.column("n").to_pylist()):
                if digest is None:
                    row = (conv, 0, _ROOT, 0)
                else:
                    row = (conv, held[1] + 1, hashlib.sha256(held[2] + digest).digest()[:16], n)
                if held is not None:
                    out.append((*held, digest is None))
                held = row
            yield _batch(out)
        if held is not None:
            yield _batch([(*held, True)])

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["conv", "depth", "key", "n", "last"])

    dealt = steps.repartition("conv").sortWithinPartitions("conv", "part", "p").select("conv", "digest", "n")
    return dealt.mapInArrow(scan, "conv long, depth int, key binary, n long, last boolean")


def _end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv): the hash of the comma-joined ids in ascending order.

    The ids are sorted over ranges, so those of one hot node are packed by many tasks; one
    task then streams the packs of a node, in order, through its hash.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, convs = b.column("key").to_pylist(), b.column("conv").to_pylist()
            out: list[tuple] = []
            i = 0
            while i < len(keys):
                j = i
                while j < len(keys) and j - i < PACK and keys[j] == keys[i]:
                    j += 1
                out.append((keys[i], convs[i], ",".join(map(str, convs[i:j]))))
                i = j
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.int64(), pa.string()))], ["key", "conv", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done: list[tuple] = []
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
                if k != key:
                    if state is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _out(done)
        if state is not None:
            yield _out([(key, state.hexdigest())])

    def _out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string())], ["key", "ends_sha256"])

    packed = ends.repartitionByRange("key", "conv").sortWithinPartitions("key", "conv").mapInArrow(pack, "key binary, conv long, ids string")
    return packed.repartition("key").sortWithinPartitions("key", "conv").select("key", "ids").mapInArrow(digest, "key binary, ends_sha256 string")


def prefix_trie(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``steps`` has the turns (conv, part, p, digest, n), ordered by part and p within a
    conversation; ``convs`` every conversation, those without a turn included.  Equal
    conversations share all their nodes.  No conversation gives no row, not even a root.  A
    conversation's turns pass through one task in order; nothing of it is held but one name.
    """
    s = Scratch(steps.sparkSession, "trie")
    roots = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("p"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("n"))
    parts = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = s.table(_paths(steps.unionByName(roots))).withColumn("salt", F.pmod(F.xxhash64("conv"), F.lit(parts)))
    # the smallest member under each salt, then of the node: a window sees one row a salt
    least = paths.groupBy("key", "salt").agg(F.min("conv").alias("least"), F.max(~F.col("last")).alias("deeper"))
    node = Window.partitionBy("key")
    owners = least.select("key", "salt", F.min("least").over(node).alias("owner"), F.max("deeper").over(node).alias("deeper"))
    # from a path's end up to its root
    up = Window.partitionBy("conv").orderBy(F.col("depth").desc())
    below = up.rowsBetween(Window.unboundedPreceding, 0)
    owned = F.col("owner") == F.col("conv")
    marked = paths.join(owners, ["key", "salt"]).select(
        "key", "conv", "depth", "owner",
        F.lead("owner").over(up).alias("parent"),
        F.coalesce(F.lag(owned).over(up), F.lit(False)).cast("long").alias("child"),
        F.sum(F.when(owned & F.col("last") & ~F.col("deeper"), 1).otherwise(0)).over(below).alias("leaf"),
        (F.sum("n").over(below) - F.sum(F.when(owned, F.col("n")).otherwise(0)).over(below)).alias("saved"),
    )
    nodes = marked.groupBy("key").agg(
        F.min("owner").alias("conv_id"),
        F.min("depth").cast("long").alias("depth"),
        F.min("parent").alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum("child").alias("n_children"),
        F.sum("leaf").cast("long").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
    )
    ends = _end_digests(paths.filter("last").select("key", "conv"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(ends, "key", "left").drop("key").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(none)))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes of the conversations as they are; see :func:`prefix_trie` and :func:`numbered_turns`."""
    placed = numbered_turns(turns, conv_col, turn_col, role_col, text_col)
    return prefix_trie(placed.withColumn("part", F.lit(0)), placed.select("conv").distinct())


def family_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", family: int = 5, heads: int = 9) -> DataFrame:
    """The nodes of the conversations rebuilt by :func:`shared_openings`."""
    placed = numbered_turns(turns, conv_col, turn_col, role_col, text_col)
    convs = turns.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv")).distinct()
    return prefix_trie(shared_openings(placed, convs, family, heads), convs)
