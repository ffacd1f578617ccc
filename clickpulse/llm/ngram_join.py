"""N-gram Jaccard join with adaptive multi-match prefixes.

A document's set holds its distinct five-word shingles (see ``words``). Two
documents link when the Jaccard similarity of their sets is at least
``percent`` / 100. The join returns each document's component, and links are
only needed as far as they decide components.

The filter: order all tokens in one global order. If two sets of sizes n share
at least ``t = ceil(percent * n / 100)`` tokens, the first ``n - t + l`` tokens
of each share at least ``l``. A longer prefix (larger ``l``) costs postings and
saves candidates, so each document picks its own; a pair needs the smaller ``l``.

1. Documents with one and the same set form a class; the smallest id stands for it.
2. Tokens in hash order, ``l`` in proportion to the size: a class whose prefix has
   fewer than ``l`` tokens in common with others links with nobody.
3. Over the classes left, every token is counted. Tokens seen once cannot be
   shared, so a class with fewer than t shared tokens goes too. The rest are ordered
   rarest first, and each class picks the ``l`` with the least estimated cost:
   postings of its prefix plus candidates (postings / l) times their verification.
4. Star round: in each token's list every class meets a few central members only,
   and the pairs with most matches are verified. This makes most components.
5. Rest: in lists that still hold several components, pairs of different components
   are verified; pairs inside one component decide nothing and are skipped. A list of
   more than ``BLOCK`` members is cut into blocks, and pairs of blocks of different
   components are compared inside tasks by their exact intersections.

No list is ever gathered whole. The work of step 5 on a long list can grow with the
product of its components' sizes.

Null and empty texts have an empty set: no link, ``n_shingles`` 0, component of
their own id. Rows with one id count as one document: what links with one of its texts links
with all of them. Rows without an id take no part and get null as their component. Sets are compared by 64-bit shingle hashes; classes by
a 128-bit digest of the whole set. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.common import bit_table, bits_set, stored, with_workers
from clickpulse.llm.components import connected_components
from clickpulse.llm.words import chunks, shingles

PERCENT = 80
#: First filter: one more shared token is asked for every so many tokens of a set.
TOKENS_PER_MATCH = 16
#: Central members that a list's classes meet in the star round.
PIVOTS = 8
#: Members of a block of step 5.
BLOCK = 256
#: Bits of the filters for surviving ids (2 MB) and for tokens seen twice (4 MB). The
#: sizes are fixed; a full filter only passes on more rows, which exact joins drop.
FILTER_BITS = 1 << 24
TOKEN_BITS = 1 << 25


def required(n, percent: int = PERCENT):
    """Least overlap with any partner of a set of n tokens."""
    return -(-percent * n // 100)


def matches(n):
    """The ``l`` of the first filter: it grows with the size, never falls."""
    return np.maximum(1, -(-n // TOKENS_PER_MATCH))


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for lo, hi, raw, offsets in chunks(column):
        h, rows = shingles(raw, offsets)
        h = h.view(np.int64)
        for i in range(hi - lo):
            yield lo + i, np.unique(h[rows[i] : rows[i + 1]])


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _set_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys = [], []
        for _, tokens in _sets(batch["text"]):
            sizes.append(len(tokens))
            keys.append(_digest(tokens))
        yield pa.record_batch(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())],
            names=["doc_id", "n_shingles", "set_key"],
        )


def _lists(ids: pa.Array, rows: list[int], parts: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))
    return pa.record_batch([ids.take(pa.array(rows, pa.int64())), lists], names=names)


def _hash_prefixes(percent: int, bits: np.ndarray | None = None):
    """Prefixes in hash order, of one copy of each set per task; with ``bits``, only tokens that pass that filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies inside one task need to be sent once; it holds 16 bytes a row
        for batch in batches:
            rows, parts = [], []
            for i, tokens in _sets(batch["text"]):
                n = len(tokens)
                key = _digest(tokens)
                if n == 0 or key in seen:
                    continue
                seen.add(key)
                head = tokens[: n - required(n, percent) + int(matches(n))]
                if bits is not None:
                    head = head[bits_set(bits, head & (TOKEN_BITS - 1))]
                rows.append(i)
                parts.append(head)
            yield _lists(batch["doc_id"], rows, parts, ["doc_id", "tokens"])

    return run


def _whole_sets(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = batch["spot"].to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(bits_set(bits, spot)))
            rows, parts = [], []
            for i, tokens in _sets(batch["text"]):
                rows.append(i)
                parts.append(tokens)
            yield _lists(batch["doc_id"], rows, parts, ["class", "tokens"])

    return run


def best_matches(df: np.ndarray, n: int, t: int) -> int:
    """The ``l`` with the least estimated cost for a class with shared tokens of these frequencies, rarest first."""
    m = len(df)
    most = min(t, 64)
    # posting cost of the l-prefix, l = 1 .. most
    postings = np.cumsum(df - 1)[m - t : m - t + most].astype(np.float64)
    wanted = np.arange(1, len(postings) + 1)
    cost = postings + postings / wanted * max(1.0, n / 16)
    return int(np.argmin(cost)) + 1 if len(postings) else 1


def _adapted(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ells, uptos = [], []
            for n, shared in zip(batch["n"].to_pylist(), batch["dfs"], strict=True):
                t = required(n, percent)
                df = np.asarray(shared.values)
                ell = best_matches(df, n, t)
                ells.append(ell)
                uptos.append(len(df) - t + ell)
            yield pa.record_batch(
                [batch["class"], batch["n"], batch["m"], pa.array(ells, pa.int32()), pa.array(uptos, pa.int32()), batch["tokens"]],
                names=["class", "n", "m", "ell", "upto", "tokens"],
            )

    return run


def _may_link(percent: int, a: str = "a", b: str = "b") -> Column:
    """Sizes, and the tokens that anybody shares, allow the similarity."""
    n1, n2 = F.col(f"{a}.n"), F.col(f"{b}.n")
    m = F.least(F.col(f"{a}.m"), F.col(f"{b}.m"))
    return m * 100 >= (n1 + n2 - m) * percent


def _block_links(percent: int):
    """Links that join the components of two blocks: a spanning forest, so never more than members."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("class")
        size = len(group)
        tokens = np.concatenate(group["tokens"].to_numpy())
        lengths = group["tokens"].map(len).to_numpy()
        owner = np.repeat(np.arange(size), lengths)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        in_prefix = place < group["upto"].to_numpy()[owner]
        _, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
        keep = count[column] > 1
        owner, column, in_prefix = owner[keep], column[keep], in_prefix[keep]
        _, column = np.unique(column, return_inverse=True)
        overlap = np.zeros((size, size), np.float32)
        shared = np.zeros((size, size), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column, in_prefix = owner[order], column[order], in_prefix[order]
        width = 4096
        for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [lo, lo + width])
            x = np.zeros((size, width), np.float32)
            x[owner[a:b], column[a:b] - lo] = 1
            overlap += x @ x.T
            x[owner[a:b], column[a:b] - lo] = in_prefix[a:b]
            shared += x @ x.T
        n = group["n"].to_numpy()
        ell = group["ell"].to_numpy()
        comp = group["comp"].to_numpy()
        linked = 100 * overlap >= percent * (n[:, None] + n[None, :] - overlap)
        linked &= shared >= np.minimum(ell[:, None], ell[None, :])
        linked &= comp[:, None] != comp[None, :]
        out, parent = [], {}

        def root(c):
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
            p, q = root(comp[i]), root(comp[j])
            if p != q:
                parent[max(p, q)] = min(p, q)
                out.append((comp[i], comp[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return run


def _meeting(left: DataFrame, right: DataFrame, percent: int, more: Column) -> DataFrame:
    """``a, b, found``: pairs of classes that meet in at least as many of these list entries as they must."""
    return (
        left.alias("a")
        .join(right.alias("b"), "token")
        .where((F.col("a.class") != F.col("b.class")) & _may_link(percent) & more)
        .groupBy(F.col("a.class").alias("a"), F.col("b.class").alias("b"))
        .agg(F.count(F.lit(1)).alias("found"), F.max(F.least("a.ell", "b.ell")).alias("wanted"))
        .where("found >= wanted")
        .select("a", "b", "found")
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose exact similarity reaches the threshold."""
    pairs = stored(
        pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "join-pairs"
    )

    def side(c: str) -> DataFrame:
        # Only the sets that a pair asks for; a small table of pairs is broadcast, by Spark's own size check.
        wanted = sets.join(pairs.select(F.col(c).alias("class")).distinct(), "class", "left_semi")
        return wanted.select(F.col("class").alias(c), F.col("n").alias(f"n_{c}"), F.col("tokens").alias(f"t_{c}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.select("a", "b", (F.col("n_a") + F.col("n_b")).alias("n"), F.size(F.array_intersect("t_a", "t_b")).alias("o"))
    return both.where(F.col("o") * 100 >= (F.col("n") - F.col("o")) * percent).select("a", "b")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id`` for every row of ``docs``."""
    with_workers(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keys = stored(texts.mapInArrow(_set_keys, "doc_id long, n_shingles long, set_key binary"), "join-keys")
    known = keys.where("doc_id IS NOT NULL AND n_shingles > 0")
    several = known.groupBy("doc_id").agg((F.min("set_key") < F.max("set_key")).alias("several")).where("several")
    several = stored(several.select("doc_id"), "join-several")
    if several.isEmpty():
        return _near_sets(texts, keys, percent)

    # Some id has several texts: every row is joined under a number of its own, and the rows of an id
    # are put together as components.
    rows = stored(texts.withColumn("row", F.monotonically_increasing_id()), "join-rows")
    numbered = rows.select(F.when(F.col("doc_id").isNotNull(), F.col("row")).alias("doc_id"), "text")
    keys = stored(numbered.mapInArrow(_set_keys, "doc_id long, n_shingles long, set_key binary"), "join-row-keys")
    near = _near_sets(numbered, keys, percent).withColumnRenamed("doc_id", "row")
    near = stored(near.where("row IS NOT NULL").join(rows.select("row", "doc_id"), "row"), "join-near-rows")
    linked = near.where("n_shingles > 0")
    least = linked.groupBy("doc_id").agg(F.min("component_id").alias("a"))
    same = linked.join(least, "doc_id").select("a", F.col("component_id").alias("b"))
    met = connected_components(same, "join-ids").withColumnRenamed("node", "component_id")
    near = near.join(met, "component_id", "left").withColumn("of", F.coalesce("component", "component_id"))
    near = stored(near.select("doc_id", "n_shingles", "class_id", "of"), "join-of")
    # Numbers back to ids: the least of each class and component.
    classes = near.groupBy("class_id").agg(F.min("doc_id").alias("class"))
    components = near.groupBy("of").agg(F.min("doc_id").alias("component"))
    named = near.join(classes, "class_id").join(components, "of").select(
        "doc_id", "n_shingles", F.col("class").alias("class_id"), F.col("component").alias("component_id")
    )
    none = F.lit(None).cast("bigint")
    unknown = keys.where("doc_id IS NULL").select("doc_id", "n_shingles", none.alias("class_id"), none.alias("component_id"))
    return named.unionByName(unknown)


def _near_sets(texts: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """The join for rows of which an id (null for rows that take no part) has one set."""
    # 1. classes of equal sets
    # Stored, so that the join reads plain shuffles and can split the partition of a large class.
    known = keys.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stored(known.groupBy("set_key").agg(F.min("doc_id").alias("class")), "join-classes")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("class", "doc_id"))
    members = stored(
        keys.join(classes, "set_key", "left").select("doc_id", "n_shingles", own.alias("class")), "join-members"
    )
    texts = texts.where("doc_id IS NOT NULL")  # the other rows have no part in anything below
    sized = members.where("class IS NOT NULL AND n_shingles > 0").groupBy("class").agg(F.max("n_shingles").alias("n"))

    # 2. multi-match prefixes in hash order
    def postings(bits=None):
        rows = texts.mapInArrow(_hash_prefixes(percent, bits), "doc_id long, tokens array<long>")
        return rows.select("doc_id", F.explode("tokens").alias("token"))

    common = postings().groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    common = stored(common, "join-common")
    seen = bit_table(F.expr(f"token & {TOKEN_BITS - 1}L"), common, TOKEN_BITS)
    shared = postings(seen).join(common, "token", "left_semi")
    shared = stored(
        shared.join(members.select("doc_id", "class"), "doc_id").select("token", "class").distinct(), "join-shared"
    )
    common = shared.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    found = shared.join(common, "token", "left_semi").groupBy("class").agg(F.count(F.lit(1)).alias("found"))
    # A partner has percent of this size at least, and may ask for that size's matches only.
    least = F.greatest(F.lit(1), F.ceil(F.ceil(F.col("n") * percent / 100) / TOKENS_PER_MATCH))
    alive = found.join(sized, "class").where(F.col("found") >= least).select("class", "n")
    alive = stored(alive, "join-alive")

    # 3. whole sets of the classes left; false positives of the filter are only further candidates
    spotted = texts.withColumn("spot", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)))
    living = bit_table(F.pmod(F.xxhash64("class"), F.lit(FILTER_BITS)), alive, FILTER_BITS)
    sets = spotted.mapInArrow(_whole_sets(living), "class long, tokens array<long>")
    each = sets.select("class", F.explode("tokens").alias("token"))
    df = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    each = each.join(df, "token")
    # Classes with too few shared tokens go before any list is gathered.
    enough = each.groupBy("class").agg(F.count(F.lit(1)).alias("found")).join(alive, "class")
    enough = enough.where(F.col("found") * 100 >= F.col("n") * percent).select("class", "n")
    ordered = (
        each.join(enough, "class")
        .groupBy("class")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_set(F.struct("df", "token"))).alias("x"))
        .select("class", "n", F.size("x").cast("long").alias("m"), F.col("x.df").alias("dfs"), F.col("x.token").alias("tokens"))
        .where(F.col("m") * 100 >= F.col("n") * percent)
    )
    sets = stored(
        ordered.mapInArrow(_adapted(percent), "class long, n long, m long, ell int, upto int, tokens array<long>"),
        "join-sets",
    )
    heads = sets.select("class", "n", "m", "ell", F.explode(F.slice("tokens", F.lit(1), F.col("upto"))).alias("token"))
    common = heads.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    heads = stored(heads.join(common, "token", "left_semi"), "join-heads")

    # 4. star round
    central = Window.partitionBy("token").orderBy(F.col("m").desc(), F.xxhash64("class"))
    pivots = heads.withColumn("_k", F.row_number().over(central)).where(F.col("_k") <= PIVOTS).drop("_k")
    pairs = _meeting(heads, pivots, percent, F.lit(True))
    best = Window.partitionBy("a").orderBy(F.col("found").desc(), "b")
    pairs = pairs.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= PIVOTS)
    links = stored(_verified(pairs, sets, percent), "join-star-links")
    stars = stored(connected_components(links, "join-star"), "join-star-components")

    # 5. lists that still hold several components
    placed = heads.join(stars, heads["class"] == stars["node"], "left").select(
        "token", "class", "n", "m", "ell", F.coalesce("component", "class").alias("comp")
    )
    several = placed.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("size"))
    placed = stored(placed.join(several.where("x <> y").select("token", "size"), "token"), "join-rest")
    # Short lists: their pairs of different components, at most BLOCK / 2 for each entry.
    short = placed.where(F.col("size") <= BLOCK).drop("size")
    pairs = _meeting(short, short, percent, (F.col("a.class") < F.col("b.class")) & (F.col("a.comp") != F.col("b.comp")))
    rest = _verified(pairs, sets, percent)
    # Long lists: blocks. These count a pair's whole prefixes, so nothing depends on its short lists.
    long = placed.where(F.col("size") > BLOCK)
    per_comp = long.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c"))
    per_comp = per_comp.withColumn("large", F.col("c") >= BLOCK)
    small = per_comp.where("NOT large").groupBy("token").agg(F.sum("c").alias("s"))
    # A large component has blocks of its own; small ones share blocks.
    blocked = (
        long.join(per_comp, ["token", "comp"])
        .join(small, "token", "left")
        .select(
            "token",
            "class",
            "comp",
            F.struct("large", F.when(F.col("large"), F.col("comp")).otherwise(0).alias("comp")).alias("of"),
            F.when(F.col("large"), F.pmod(F.xxhash64("class"), F.ceil(F.col("c") / BLOCK)))
            .otherwise(F.pmod(F.xxhash64("comp"), F.ceil(F.coalesce("s", F.lit(1)) / BLOCK)))
            .alias("nr"),
        )
    )
    blocked = stored(blocked, "join-blocks")
    blocks = blocked.select("token", F.struct("of", "nr").alias("block")).distinct()
    left, right = blocks.withColumnRenamed("block", "p"), blocks.withColumnRenamed("block", "q")
    meets = left.join(right, "token").where("p <= q AND (p.of <> q.of OR NOT p.of.large)")
    meets = meets.select("token", "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    groups = (
        blocked.select("token", "class", "comp", F.struct("of", "nr").alias("block"))
        .join(meets, ["token", "block"])
        .join(sets, "class")
        .select("token", "p", "q", "class", "comp", "n", "ell", "upto", "tokens")
    )
    far = groups.groupBy("token", "p", "q").applyInPandas(_block_links(percent), "a long, b long")
    # Links between components, named by their smallest classes.
    named = rest.join(stars.withColumnRenamed("node", "a").withColumnRenamed("component", "p"), "a", "left")
    named = named.join(stars.withColumnRenamed("node", "b").withColumnRenamed("component", "q"), "b", "left")
    named = named.select(F.coalesce("p", "a").alias("a"), F.coalesce("q", "b").alias("b"))
    rest = connected_components(named.unionByName(far), "join-rest-links")

    # Components of components.
    final = members.join(stars.withColumnRenamed("node", "class"), "class", "left")
    final = final.withColumn("comp", F.coalesce("component", "class")).drop("component")
    final = final.join(rest.withColumnRenamed("node", "comp"), "comp", "left")
    return final.select(
        "doc_id", "n_shingles", F.col("class").alias("class_id"), F.coalesce("component", "comp").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and rows without an id; all columns."""
    marks = near_classes(docs, id_col, text_col, percent)
    dropped = marks.where("doc_id <> component_id").select(F.col("doc_id").alias("_drop")).distinct()
    return docs.join(dropped, docs[id_col] == dropped["_drop"], "left_anti")
