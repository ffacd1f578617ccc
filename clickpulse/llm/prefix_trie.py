"""Prefix trie of conversations by fixed-length block hashing.

A node of depth d is a distinct sequence of d turns (role and text) with which
some conversation starts; the root has no turn. A node is named by the smallest
conversation that starts with it, and its depth.

1. Turns become digests at once; texts go no further.
2. Each conversation is cut into blocks of ``BLOCK_TURNS`` turns. A block's digest is tagged with
   the block's number, and the tagged digests of a conversation are combined from the first on, so that
   equal keys mean equal openings. Conversations are grouped by these keys.
3. Where all conversations of an opening go on with one and the same block, the block is a
   chain: its turns' nodes have the block's members. Only where siblings diverge is the
   block's content compared turn by turn.
4. Sums over a subtree become sums over members: a node counts for its smallest conversation, and
   the nodes below node v are those that count for v's members, less those of v's own
   smallest one above v. No tree is walked.

Only counts and digests are grouped, with partial sums first, so a hot opening costs one row a
task. A conversation is never gathered: its turns are ranked and its blocks combined in
pieces. The list of the conversations that end at a node is digested as a stream of short sorted pieces.

Rows without a conversation take no part. Null roles and texts are empty ones. Turns go
by their number, null first; equal numbers by the digest of role and text, so repeated rows are
repeated turns. An empty table gives an empty result, not a lone root. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import running, stored, with_workers

BLOCK_TURNS = 4
#: Turn numbers, blocks and depths of one piece of a long conversation.
TURNS_OF_A_PIECE = 1024
#: Conversation ids (as a span of numbers) of one piece of an end list.
IDS_OF_A_PIECE = 256


def digest_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, place, digest, points``: the turns of each conversation, numbered from 1."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    turn = F.col(turn_col).cast("bigint")
    turns = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        turn.alias("_turn"),
        # The length of the role keeps role and text apart.
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"),
        F.length(text).cast("bigint").alias("points"),
        F.lit(1).alias("_one"),
    )
    piece = F.coalesce(F.floor(F.col("_turn") / TURNS_OF_A_PIECE), F.lit(-(2**62)))
    ranked = running(turns, ["conv_id"], piece, [F.col("_turn").asc_nulls_first(), F.col("digest")], place=("_one", "sum"))
    return ranked.select("conv_id", F.col("place").cast("bigint").alias("place"), "digest", "points")


def share_openings(turns: DataFrame, ids: DataFrame, every: int = 100, spread: int = 6) -> DataFrame:
    """Conversations rebuilt with common openings.

    Conversation c gets the first h turns of conversation c - c % ``every`` (all it has, none if it
    is absent), then its own turns after its first h; h is crc32 of c's decimal text, modulo ``spread``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread
    base = F.col("conv_id") - F.col("conv_id") % every
    openings = turns.where((F.col("conv_id") == base) & (F.col("place") < spread))
    openings = openings.select(F.col("conv_id").alias("base"), "place", "digest", "points")
    taken = ids.select("conv_id", h.alias("h"), base.alias("base")).join(openings, "base").where("place <= h")
    length = openings.groupBy("base").agg(F.max("place").alias("n"))
    own = turns.select("*", h.alias("h"), base.alias("base")).where("place > h").join(length, "base", "left")
    place = F.col("place") - F.col("h") + F.least(F.col("h"), F.coalesce("n", F.lit(0)))
    return taken.select("conv_id", "place", "digest", "points").unionByName(
        own.select("conv_id", place.alias("place"), "digest", "points")
    )


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node from its pieces in order; the state is one running hash."""
    names = ["conv_id", "depth", "ends_sha256"]
    key, state = None, None
    for batch in batches:
        done: list[tuple] = []
        for conv, depth, piece in zip(*(batch[c].to_pylist() for c in ("conv_id", "depth", "piece")), strict=True):
            if (conv, depth) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (conv, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        if done:
            yield pa.record_batch([pa.array(list(c)) for c in zip(*done, strict=True)], names=names)
    if key is not None:
        yield pa.record_batch([pa.array([x]) for x in (*key, state.hexdigest())], names=names)


def _key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("j"), F.sha2(F.array_join("turns.digest", ","), 256))


def prefix_trie(turns: DataFrame, ids: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node of the conversations of ``turns(conv_id, place, digest, points)``.

    ``ids(conv_id)`` names all conversations, those without a turn too. Columns: ``conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    with_workers(turns.sparkSession)
    ids = ids.where("conv_id IS NOT NULL").select("conv_id").distinct()
    node, block = ["conv_id", "depth"], ["j", "k1", "k2"]

    # Blocks, and keys that combine them from the first on.
    cut = turns.withColumn("j", F.floor((F.col("place") - 1) / block_turns))
    cut = cut.groupBy("conv_id", "j").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "points"))).alias("turns"))
    cut = cut.select("*", _key(1).alias("o1"), _key(2).alias("o2"), F.size("turns").alias("size"))
    cut = stored(cut, "trie-cut")
    keyed = running(
        cut.select("conv_id", "j", "o1", "o2", "size"),
        ["conv_id"],
        F.floor(F.col("j") / TURNS_OF_A_PIECE),
        ["j"],
        k1=("o1", "xor"),
        k2=("o2", "xor"),
    )
    members = stored(
        keyed.select(
            "conv_id", *block, F.expr("k1 ^ o1").alias("p1"), F.expr("k2 ^ o2").alias("p2"), "size"
        ),
        "trie-members",
    )

    # Openings of whole blocks, their siblings, their parents, and one copy of each one's content.
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).first()
    at_root = {"conv_id": F.lit(root["conv_id"]).cast("bigint"), "depth": F.lit(0).cast("bigint")}
    at_root = [c.alias(name) for name, c in at_root.items()]
    shared = members.groupBy(*block, "p1", "p2", "size").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")
    )
    shared = stored(shared, "trie-shared")
    kids = shared.groupBy("j", "p1", "p2").agg((F.count(F.lit(1)) > 1).alias("diverge"))
    above = shared.select(
        (F.col("j") + 1).alias("j"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above")
    )
    opened = (
        shared.join(kids, ["j", "p1", "p2"])
        .join(above, ["j", "p1", "p2"], "left")
        .withColumn("above", F.coalesce("above", at_root[0]))  # first blocks hang on the root
        .join(cut.select("conv_id", "j", "turns"), ["conv_id", "j"])
    )
    opened = stored(opened, "trie-opened")

    # Every turn of every block with the smallest conversation of its node: the block's own
    # in chains, the smallest of those with the same turns up to here where siblings diverge.
    step = F.expr(
        "transform(turns, (t, i) -> struct(int(i + 1) AS at, t.points AS points,"
        " IF(diverge, sha2(array_join(transform(slice(turns, 1, i + 1), u -> u.digest), ','), 256), NULL) AS so_far))"
    )
    steps = opened.select(*block, "p1", "p2", "conv_id", "n", "above", "diverge", F.inline(step))
    together = ["j", "p1", "p2", "at", "so_far"]
    # Stored, so that the join reads plain shuffles and can split the partition of a hot opening.
    least = stored(steps.where("diverge").groupBy(*together).agg(F.min("conv_id").alias("least")), "trie-least")
    chain = steps.where("NOT diverge").withColumn("least", F.col("conv_id"))
    steps = chain.unionByName(steps.where("diverge").join(least, together).select(*chain.columns))
    back = Window.partitionBy(*block).orderBy("at")
    steps = steps.select(
        *block,
        "at",
        F.col("least").alias("conv_id"),
        (F.col("j") * block_turns + F.col("at")).alias("depth"),
        F.coalesce(F.lag("least").over(back), "above").alias("parent_conv_id"),
        "n",
        "points",
    )
    steps = stored(steps, "trie-steps")
    nodes = steps.groupBy(*node).agg(
        F.max("parent_conv_id").alias("parent_conv_id"), F.sum("n").alias("n_convs"), F.max("points").alias("points")
    )
    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    top = ids.agg(F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = top.select(*at_root, none.alias("parent_conv_id"), "n_convs", zero.alias("points"))
    nodes = nodes.unionByName(top)
    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    nodes = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), node, "left").select(
        *node,
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("points")).alias("saved"),
    )
    nodes = stored(nodes, "trie-nodes")

    # What counts for each conversation, and the sums of it over the members of each node.
    counted = nodes.groupBy("conv_id").agg(
        F.sum("saved").alias("saved"), F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaves")
    )
    counted = stored(counted, "trie-counted")
    sums = [F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")]
    of_block = members.select("conv_id", *block).join(counted, "conv_id").groupBy(*block).agg(*sums)
    below = steps.select(*block, *node).join(of_block, block).groupBy(*node).agg(*sums)
    below = below.unionByName(counted.agg(*sums).select(*at_root, "saved", "leaves"))
    so_far = running(nodes, ["conv_id"], F.floor(F.col("depth") / TURNS_OF_A_PIECE), ["depth"], upto=("saved", "sum"))
    so_far = so_far.withColumn("over", F.col("upto") - F.col("saved")).drop("saved", "upto")

    # The conversations that end at each node.
    last = members.groupBy("conv_id").agg(F.max(F.struct("j", "k1", "k2", "size")).alias("end"))
    last = last.select(F.col("conv_id").alias("member"), "end.j", "end.k1", "end.k2", F.col("end.size").alias("at"))
    ends = steps.select(*block, "at", *node).join(last, [*block, "at"]).select(*node, "member")
    silent = ids.join(members.select("conv_id").distinct(), "conv_id", "left_anti").select(F.col("conv_id").alias("member"))
    ends = ends.unionByName(silent.select(*at_root, "member"))
    pieces = ends.groupBy(*node, F.floor(F.col("member") / IDS_OF_A_PIECE).alias("nr")).agg(
        F.array_join(F.sort_array(F.collect_list("member")).cast("array<string>"), ",").alias("piece")
    )
    lists = (
        pieces.repartition(*node)
        .sortWithinPartitions(*node, "nr")
        .select(*node, "piece")
        .mapInArrow(_list_digests, "conv_id long, depth long, ends_sha256 string")
    )
    return (
        so_far.join(below, node)
        .join(lists, node, "left")
        .select(
            *node,
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            (F.col("saved") - F.col("over")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
