"""Prefix trie of conversations: nodes for shared beginnings, and sums over subtrees by centroid decomposition.

A node stands for the first d turns of the conversations that begin with them; it is found by a hash of these turns, two
64-bit words that are the exclusive or of the hashes of all (place, role, text), so that long conversations are hashed in
pieces. A node's members, counted, give its weight for nothing more than the grouping that makes the nodes: the turns
that its members still have, which is the sum of the members of all nodes below.

Sums over subtrees come from a centroid decomposition of the forest of parent edges. A component of the trie has a top.
Its nodes with more than half of its weight below them form one path down from the top; the last of them is the centroid,
below which no child holds more than half. The total of what lies at and below the centroid, inside the component, is
added to all nodes of that path, and the component falls apart into the subtrees of the centroid's children and the part
that is left above. Weights halve with each level, so that no node is touched more often than the logarithm of all turns,
however deep the trie is. Components of more than ``LOCAL_NODES`` nodes are split by Spark, all of one level together;
smaller ones, whole, inside the tasks that they are dealt to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillwright.operators.combine import join_lines
from tillwright.operators.scale import global_row_number
from tillwright.session import materialise

# Nodes of a component that a task decomposes by itself.
LOCAL_NODES = 1 << 16
# Turns of one conversation whose hashes are joined in one window; conversation ids of one piece of a list.
BLOCK_TURNS, CHUNK_IDS = 4096, 4096
# Conversations take their beginning from the one whose id is the next multiple of this below: up to SHARED - 1 turns.
FAMILY, SHARED = 20, 4
_KEY = ["depth", "p1", "p2"]


# ---- conversations ------------------------------------------------------------------------------------------


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: (``conv_id``, ``n_turns``) and (``conv_id``, ``depth``, ``role``, ``text``).

    Turns are ordered by ``turn`` (null first), equal ones by role and text. Conversation c has the first h turns of
    conversation c - c % 20 (all if fewer, none if there is none), then its own after its first h; h is the unsigned
    crc32 of c, written as a decimal number, modulo 4. A missing role or text is empty; rows without a conv_id belong to
    no conversation and take no part. Other columns are not read.
    """
    c = F.col("conv_id").cast("long")
    empty = F.lit("")
    plain = conversations.select(
        c.alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    ).filter("conv_id IS NOT NULL")
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text")]
    numbered = global_row_number(plain, order, "_rn")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED).cast("int")
    own = numbered.groupBy("conv_id").agg(F.min("_rn").alias("_start"), F.count("*").alias("_n")).withColumn("_taken", taken)
    own = materialise(own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % FAMILY), "conversations")
    bases = own.select(F.col("conv_id").alias("_base"), F.col("_n").alias("_there"))
    convs = own.join(bases, "_base", "left").withColumn("_head", F.least("_taken", F.coalesce("_there", F.lit(0))))
    convs = convs.withColumn("n_turns", F.col("_head") + F.greatest(F.col("_n") - F.col("_taken"), F.lit(0)))
    convs = materialise(convs, "conversations")
    placed = join_lines(numbered, convs.select("conv_id", "_start", "_taken", "_head"), "conv_id")
    placed = placed.withColumn("_at", F.col("_rn") - F.col("_start") + 1)
    later = placed.filter("_at > _taken").select("conv_id", (F.col("_at") - F.col("_taken") + F.col("_head")).alias("depth"), "role", "text")
    first = placed.filter(F.col("_at") < SHARED).select(F.col("conv_id").alias("_base"), F.col("_at").alias("depth"), "role", "text")
    heads = first.join(convs.select("conv_id", "_base", "_head"), "_base").filter("depth <= _head").select("conv_id", "depth", "role", "text")
    return convs.select("conv_id", "n_turns"), heads.unionByName(later)


# ---- nodes --------------------------------------------------------------------------------------------------


def _prefixes(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``conv_id``, ``depth``, ``n_turns``, ``words`` of the turn, key of the node (``p1``, ``p2``) and of its parent (``q1``, ``q2``)."""
    role, text = (F.coalesce(F.col(n).cast("string"), F.lit("")) for n in ("role", "text"))
    told = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    hashed = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        told.alias("_told"),
    ).select(
        "conv_id", "depth", "words", F.xxhash64("depth", "_told").alias("k1"), F.xxhash64("_told", F.lit("second"), "depth").alias("k2")
    )
    hashed = materialise(hashed.withColumn("_block", F.expr(f"(depth - 1) div {BLOCK_TURNS}")), "turns")
    before = W.partitionBy("conv_id").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = hashed.groupBy("conv_id", "_block").agg(F.bit_xor("k1").alias("_k1"), F.bit_xor("k2").alias("_k2"))
    blocks = blocks.select("conv_id", "_block", F.bit_xor("_k1").over(before).alias("_b1"), F.bit_xor("_k2").over(before).alias("_b2"))
    so_far = W.partitionBy("conv_id", "_block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    scanned = hashed.withColumns({"_x1": F.bit_xor("k1").over(so_far), "_x2": F.bit_xor("k2").over(so_far)})
    scanned = scanned.join(blocks.filter("_block > 0"), ["conv_id", "_block"], "left")
    zero = F.lit(0).cast("long")
    scanned = scanned.withColumns({f"p{i}": F.col(f"_x{i}").bitwiseXOR(F.coalesce(F.col(f"_b{i}"), zero)) for i in (1, 2)})
    scanned = join_lines(scanned, convs, "conv_id")
    return scanned.select(
        "conv_id", "depth", "n_turns", "words", "p1", "p2", *[F.col(f"p{i}").bitwiseXOR(F.col(f"k{i}")).alias(f"q{i}") for i in (1, 2)]
    )


def _nodes(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each node: ``conv_id``, key, parent's key and conv_id, ``n_convs``, ``n_children``, ``words``, ``weight``."""
    of_members = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")]
    below = rows.groupBy(*_KEY).agg(
        *of_members, *[F.min(c).alias(c) for c in ("q1", "q2", "words")], F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight")
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = (
        convs.agg(*of_members, F.sum(F.col("n_turns") + 1).alias("weight"))
        .filter("n_convs > 0")
        .withColumns({"depth": zero, "p1": zero, "p2": zero, "q1": none, "q2": none, "words": zero})
    )
    nodes = materialise(below.unionByName(root), "nodes")
    # Both sides are plain exchanges, so that a parent of very many children is split.
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    linked = materialise(nodes.join(parents, ["depth", "q1", "q2"], "left"), "nodes")
    children = linked.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2"))
    children = children.agg(F.count("*").alias("n_children"))
    return linked.join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))


# ---- sums over subtrees -------------------------------------------------------------------------------------

_TOP = ["top_depth", "t1", "t2"]


def subtree_sums(nodes: DataFrame, rows: DataFrame, values: dict[str, Column], local_nodes: int = LOCAL_NODES) -> DataFrame:
    """Key and, for each of ``values`` (whole numbers of a node), the sum over the node's subtree, itself included.

    ``rows`` has the key of the node of each conversation at each depth, and its parent's. It tells which nodes lie below
    a centroid, and in which child's subtree: those whose smallest conversation passes there.
    """
    zero, names = F.lit(0).cast("long"), list(values)
    state = nodes.select(
        "conv_id", *_KEY, "parent_conv_id", "weight",
        *[v.cast("long").alias(n) for n, v in values.items()], *[zero.alias(f"{n}_sum") for n in names],
        *[zero.alias(t) for t in _TOP],
    )
    columns, small, done = state.columns, [], []
    state = materialise(state, "components")
    while True:
        sizes = state.groupBy(*_TOP).agg(F.count("*").alias("_size"), F.max("weight").alias("_total"))
        large = materialise(sizes.filter(F.col("_size") > local_nodes), "large-components")
        if large.isEmpty():
            small.append(state)
            break
        small.append(state.join(large, _TOP, "left_anti"))
        inside = state.join(large, _TOP)
        heavy = F.col("weight") * 2 > F.col("_total")
        centre = F.max_by(F.struct("depth", "p1", "p2", "weight"), "depth").alias("c")
        centroids = materialise(inside.filter(heavy).groupBy(*_TOP, "_total").agg(centre).select(*_TOP, "_total", "c.*").toDF(
            *_TOP, "_total", "c_depth", "c1", "c2", "c_weight"), "centroids")
        inside = state.join(centroids, _TOP)
        # One look-up for each conversation that stands for nodes of a component deeper than its centroid.
        asked = inside.filter("depth > c_depth").select(*_TOP, "c_depth", "c1", "c2", "conv_id").distinct()
        met = rows.select("conv_id", (F.col("depth") - 1).alias("c_depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2"), F.col("q1").alias("c1"), F.col("q2").alias("c2"))
        passing = asked.join(met, ["conv_id", "c_depth", "c1", "c2"]).select(*_TOP, "conv_id", "n1", "n2")
        moved = materialise(inside.join(passing, [*_TOP, "conv_id"], "left"), "components")
        below = F.col("n1").isNotNull() & (F.col("depth") > F.col("c_depth"))
        is_centre = (F.col("depth") == F.col("c_depth")) & (F.col("p1") == F.col("c1")) & (F.col("p2") == F.col("c2"))
        totals = moved.filter(below | is_centre).groupBy(*_TOP).agg(*[F.sum(n).alias(f"_{n}") for n in names])
        moved = moved.join(totals, _TOP).withColumns({"_below": below, "_centre": is_centre})
        path = ~F.col("_below") & (F.col("weight") * 2 > F.col("_total"))
        moved = moved.withColumns({f"{n}_sum": F.col(f"{n}_sum") + F.when(path, F.col(f"_{n}")).otherwise(zero) for n in names})
        moved = moved.withColumn("weight", F.when(path & ~F.col("_centre"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")))
        fresh = {"top_depth": F.col("c_depth") + 1, "t1": F.col("n1"), "t2": F.col("n2")}
        moved = moved.withColumns({t: F.when(F.col("_below"), new).otherwise(F.col(t)) for t, new in fresh.items()})
        moved = materialise(moved.select(*columns, "_centre"), "components")
        done.append(moved.filter("_centre").select(*columns))
        state = moved.filter("NOT _centre").select(*columns)
    kept = [*_KEY, *[f"{n}_sum" for n in names]]
    found = [_local(reduce(DataFrame.unionByName, small), names).select(*kept), *[d.select(*kept) for d in done]]
    return reduce(DataFrame.unionByName, found).select(*_KEY, *[F.col(f"{n}_sum").alias(n) for n in names])


def decompose(parents: list[int], weights: list[int], values: list[list[int]], sums: list[list[int]]) -> None:
    """Add to ``sums`` the sums of ``values`` over the subtrees of one component, whose nodes come top first, parents
    before children (``parents``: their places, that of the top is not used). ``weights`` are used up."""
    label = [0] * len(parents)
    components = [list(range(len(parents)))]
    number = 0
    while components:
        nodes = components.pop()
        top = nodes[0]
        half = weights[top] / 2 if len(nodes) > 1 else 0
        centre = next(u for u in reversed(nodes) if weights[u] > half)
        number += 1
        for u in nodes:
            label[u] = number
        children: dict[int, list[int]] = {}
        mine = number
        totals = [v[centre] for v in values]
        above = []
        for u in nodes:
            if u != centre and parents[u] == centre and u != top:
                number += 1
                label[u] = number
                children[number] = [u]
            elif u != centre and u != top and label[parents[u]] != mine:
                label[u] = label[parents[u]]
                children[label[u]].append(u)
            else:
                if u != centre:
                    above.append(u)
                continue
            for i, v in enumerate(values):
                totals[i] += v[u]
        lost, u = weights[centre], centre
        while True:  # from the centroid to the top
            for i, total in enumerate(totals):
                sums[i][u] += total
            if u != centre:
                weights[u] -= lost
            if u == top:
                break
            u = parents[u]
        components.extend(children.values())
        if above:
            components.append(above)


def _local(state: DataFrame, names: list[str]) -> DataFrame:
    """Whole components, each in one task; a task holds one batch of rows and one component."""
    dealt = state.repartition(*_TOP).sortWithinPartitions(*_TOP, "depth", "conv_id")
    sums = [f"{n}_sum" for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        last: tuple | None = None

        def solved(rows: dict[str, list[int]], starts: list[int]) -> pa.RecordBatch:
            for begin, end in zip(starts, starts[1:], strict=False):
                place = {(c, d): i for i, (c, d) in enumerate(zip(rows["conv_id"][begin:end], rows["depth"][begin:end], strict=True))}
                parents = [place.get((p, d - 1), -1) for p, d in zip(rows["parent_conv_id"][begin:end], rows["depth"][begin:end], strict=True)]
                added = [rows[s][begin:end] for s in sums]
                decompose(parents, rows["weight"][begin:end], [rows[n][begin:end] for n in names], added)
                for s, new in zip(sums, added, strict=True):
                    rows[s][begin:end] = new
            return pa.RecordBatch.from_arrays([pa.array(rows[c], pa.int64()) for c in [*_KEY, *sums]], [*_KEY, *sums])

        for batch in batches:
            rows = batch.to_pydict()
            rows = {c: held.get(c, []) + v for c, v in rows.items()}
            tops = list(zip(*(rows[t] for t in _TOP), strict=True))
            starts = [i for i, t in enumerate(tops) if i == 0 or t != tops[i - 1]]
            if not starts:
                continue
            cut = starts[-1]  # the last component may go on
            held = {c: v[cut:] for c, v in rows.items()}
            if cut:
                yield solved({c: v[:cut] for c, v in rows.items()}, starts)
        if held:
            yield solved(held, [0, len(held["depth"])])

    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in [*_KEY, *sums]))


# ---- ends ---------------------------------------------------------------------------------------------------


def _ends(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """Key and ``ends_sha256`` of nodes where conversations end.

    A hash of one list is one sequence of bytes. The ids are sorted and written to pieces of text over all tasks, with a
    node's ids in as many as need be; only the pieces of a node meet, and run through the hash one after the other.
    """
    zero = F.lit(0).cast("long")
    ended = rows.filter("depth = n_turns").select(*_KEY, "conv_id").unionByName(
        convs.filter("n_turns = 0").select(zero.alias("depth"), zero.alias("p1"), zero.alias("p2"), "conv_id")
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in _KEY), strict=True))
            ids = batch.column("conv_id").to_pylist()
            starts = [i for i in range(len(ids)) if i == 0 or keys[i] != keys[i - 1] or i % CHUNK_IDS == 0]
            ends = [*starts[1:], len(ids)]
            columns = [pa.array([keys[i][k] for i in starts], pa.int64()) for k in range(3)] + [pa.array([ids[i] for i in starts], pa.int64())]
            text = [",".join(map(str, ids[i:j])) for i, j in zip(starts, ends, strict=False)] if ids else []
            yield pa.RecordBatch.from_arrays([*columns, pa.array(text, pa.string())], [*_KEY, "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            found = []
            for *this, text in zip(*(batch.column(c).to_pylist() for c in [*_KEY, "ids"]), strict=True):
                if this != key:
                    if key is not None:
                        found.append((*key, digest.hexdigest()))
                    key, digest = this, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if found:
                yield _hash_rows(found)
        if key is not None:
            yield _hash_rows([(*key, digest.hexdigest())])

    schema = "depth long, p1 long, p2 long"
    order = [*_KEY, "conv_id"]
    listed = ended.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pieces, f"{schema}, first long, ids string")
    return listed.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(hashes, f"{schema}, ends_sha256 string")


def _hash_rows(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], [*_KEY, "ends_sha256"])


# ---- the trie -----------------------------------------------------------------------------------------------


def prefix_trie(convs: DataFrame, turns: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """One row for each node of the trie of ``turns`` (``conv_id``, ``depth`` from 1 without gaps, ``role``, ``text``).

    ``conv_id``, the smallest member; ``depth``; ``parent_conv_id`` (root: null); ``n_convs``, members; ``n_children``;
    ``n_leaves``, childless nodes in its subtree; ``saved_tokens``, the words that the subtree's nodes hold for all their
    members but one; ``ends_sha256`` of the sorted conv_ids that end in the node. ``convs`` has ``conv_id`` and
    ``n_turns`` of every conversation, also of those without turns, which are members of the root only. A missing role or
    text is empty. Without conversations there is no node, not even the root.
    """
    convs = convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("n_turns").cast("long").alias("n_turns"))
    rows = materialise(_prefixes(convs, turns), "prefixes")
    nodes = materialise(_nodes(convs, rows), "nodes")
    values = {"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}
    sums = subtree_sums(nodes, rows, values, local_nodes)
    nothing = F.lit(hashlib.sha256().hexdigest())
    return (
        nodes.join(sums, _KEY)
        .join(_ends(convs, rows), _KEY, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
        )
    )


def with_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes with ``role`` and ``text`` of their last turn (the root: null)."""
    return nodes.join(turns.select("conv_id", "depth", "role", "text"), ["conv_id", "depth"], "left")
