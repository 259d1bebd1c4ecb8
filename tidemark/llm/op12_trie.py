"""The prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns; its members are the
conversations that start with it.  A node is named by its smallest member and
its depth, which no other node shares.

1. *Numbering.*  Turns are sorted over range partitions and numbered within
   each; a conversation that goes on in the next partition is carried by one
   offset a partition.  A conversation of any length is spread over tasks.
2. *Prefixes.*  A turn's term is a hash of its place and content; a prefix is
   the exclusive or of its terms (128 bits), scanned in stretches of
   ``STRETCH`` turns.  A node whose members disagree on the parent or on the
   last turn would be a collision, which raises an error.
3. *Nodes* are one aggregation by prefix, combined in each task first.
4. *Rollup.*  Sums over subtrees by centroid decomposition of the
   parent-edge forest.  A component's centroid is its lowest node that holds
   half of the component's weight at least; a node weighs as many turns as its
   members have from there on, which the aggregation by prefix already tells.
   The total of the centroid's subtree within the component is added to every
   node on the path from the centroid to the component's top; then the
   centroid goes, and its children's subtrees and the rest above are
   components of half the weight at most.  A path is read off the turns of one
   member of the centroid, so a round is a few joins on unique keys, whatever
   the depth of the trie.  Components of at most ``LOCAL`` nodes are finished
   in the task that holds them, by the same recursion.

Defined results: rows without conversation id are left out; null role and text
are empty; turns come by number, null first, those of equal number by the
digest of role and text, repeated rows one after another; an empty table gives
no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import c, join_spreading_hot, materialize, shuffle_width, text_of

#: turns scanned together; nodes of a component that one task finishes; ids hashed together
STRETCH, LOCAL, PIECE = 512, 20_000, 4096


def _plus(left: str, right: str):
    return F.col(left) + F.coalesce(F.col(right), F.lit(0))


def number_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """``(conv_id, i, item, size)``: each turn's place from 1 on, digest and code points."""
    width = shuffle_width(conversations.sparkSession)
    role, text = text_of(role_col), text_of(text_col)
    src = conversations.select(
        c(conv_col).cast("long").alias("conv_id"), c(turn_col).cast("long").alias("turn"), F.length(text).cast("long").alias("size"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("item"),
        F.monotonically_increasing_id().alias("uid")).where("conv_id IS NOT NULL")
    order = [F.asc_nulls_first("turn"), F.asc("item")]
    dealt = materialize(src.repartitionByRange(width, F.asc("conv_id"), *order, F.asc("uid"))
                        .select("conv_id", "turn", "item", "size", F.spark_partition_id().alias("part")), "turns")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a partition carries on one conversation at most, so there is an offset a partition at most
    offsets = (dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("offset", F.sum("n").over(before)).where("offset > 0").drop("n"))
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order)).cast("long")
    return (dealt.withColumn("own", own).join(F.broadcast(offsets), ["conv_id", "part"], "left")
            .select("conv_id", _plus("own", "offset").alias("i"), "item", "size"))


def rebuild(turns: DataFrame, hundred: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Each conversation with its first turns from the head of its hundred.

    Returns turns ``(conv_id, pos, item, size, len)`` and conversations
    ``(conv_id, len)``: the first ``h`` turns of conversation
    ``conv_id - conv_id % hundred``, then the own turns after the first ``h``,
    with ``h = crc32(conv_id) % heads``.
    """
    cut = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    head = turns.where((F.col("conv_id") % hundred == 0) & (F.col("i") < heads)).select(
        F.col("conv_id").alias("head"), F.col("i").alias("pos"), "item", "size")
    convs = (turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("h", cut)
             .withColumn("head", F.col("conv_id") - F.col("conv_id") % hundred))
    convs = (convs.join(head.groupBy("head").agg(F.count(F.lit(1)).alias("there")), "head", "left")
             .withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
             .withColumn("len", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))))
    convs = materialize(convs.select("conv_id", "head", "h", "taken", "len"), "conversations")
    first = convs.join(head, "head").where("pos <= h").select("conv_id", "pos", "item", "size", "len")
    rest = (turns.withColumn("h", cut).where("i > h").drop("h").join(convs, "conv_id")
            .select("conv_id", (F.col("i") - F.col("h") + F.col("taken")).alias("pos"), "item", "size", "len"))
    return materialize(first.unionByName(rest), "rebuilt"), convs.select("conv_id", "len")


KEY = ["depth", "k1", "k2"]
PARENT = ["parent_depth", "p1", "p2"]


def _prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with the key of the prefix that ends there and of the one before."""
    terms = turns.select("conv_id", "pos", "item", "size", "len", F.expr(f"(pos - 1) div {STRETCH}").alias("stretch"),
                         F.xxhash64("pos", "item").alias("t1"), F.xxhash64("item", "pos", F.lit("b")).alias("t2"))
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = (terms.groupBy("conv_id", "stretch").agg(F.bit_xor("t1").alias("o1"), F.bit_xor("t2").alias("o2"))
               .select("conv_id", "stretch", F.bit_xor("o1").over(before).alias("o1"), F.bit_xor("o2").over(before).alias("o2"))
               .where("stretch > 0"))
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = terms.withColumn("x1", F.bit_xor("t1").over(so_far)).withColumn("x2", F.bit_xor("t2").over(so_far))
    key = lambda x, o: F.col(x).bitwiseXOR(F.coalesce(F.col(o), F.lit(0)))
    return (own.join(carried, ["conv_id", "stretch"], "left")
            .withColumn("k1", key("x1", "o1")).withColumn("k2", key("x2", "o2"))
            .select("conv_id", "item", "size", "len", F.col("pos").alias("depth"), "k1", "k2",
                    (F.col("pos") - 1).alias("parent_depth"), F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"),
                    F.col("k2").bitwiseXOR(F.col("t2")).alias("p2")))


def _nodes(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for every node, the root included, with the key of its parent."""
    one = lambda x: F.when(F.min(x) == F.max(x), F.min(x)).otherwise(
        F.raise_error(F.lit("two prefixes have the same hash")).cast("long"))
    inner = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("size").alias("size"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"), F.min("parent_depth").alias("parent_depth"),
        one("p1").alias("p1"), one("p2").alias("p2"), F.min("item").alias("item"), F.max("item").alias("other"))
    inner = inner.withColumn("size", F.when(F.col("item") == F.col("other"), F.col("size")).otherwise(
        F.raise_error(F.lit("two prefixes have the same hash")).cast("long")))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                     F.sum(F.col("len") + 1).alias("weight")).where("n_convs > 0")
    root = root.select(*(zero.alias(k) for k in KEY), "conv_id", "n_convs", zero.alias("size"), "weight",
                       *(none.alias(k) for k in PARENT))
    return inner.select(*root.columns).unionByName(root)


# ---- the rollup ---------------------------------------------------------------


def roll_up(parent: list[int], weight: list[int], values: list[tuple[int, int]]) -> list[list[int]]:
    """Sums of both values over each node's subtree, by centroid decomposition.

    Nodes come parents first; ``parent`` is -1 at the top.  ``weight`` is
    positive and larger than the children's together.
    """
    out, weight = [[0, 0] for _ in parent], list(weight)
    todo = [list(range(len(parent)))]
    while todo:
        own = todo.pop()
        half = weight[own[0]]
        centroid = next(v for v in reversed(own) if 2 * weight[v] >= half)
        top, above, below, one, two = {centroid: centroid}, [], {}, 0, 0
        for v in own:
            at = top.get(v) if v == centroid else top.get(parent[v])
            if at is None:
                above.append(v)
                continue
            one, two = one + values[v][0], two + values[v][1]
            if v != centroid:
                top[v] = v if at == centroid else at
                below.setdefault(top[v], []).append(v)
        inside = set(above)
        out[centroid] = [out[centroid][0] + one, out[centroid][1] + two]
        v = parent[centroid]
        while v in inside:
            out[v][0], out[v][1], weight[v], v = out[v][0] + one, out[v][1] + two, weight[v] - weight[centroid], parent[v]
        todo += [x for x in (above, *below.values()) if x]
    return out


SUMS = "conv_id long, depth long, leaves long, saved long"


def _finish(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sums of whole components, which come one after another, parents first."""
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        names = list(zip(pdf["conv_id"].tolist(), pdf["depth"].tolist()))
        place = {x: k for k, x in enumerate(names)}
        parent = [place.get((p, d - 1), -1) for p, (_, d) in zip(pdf["parent"].tolist(), names)]
        sums = roll_up(parent, pdf["weight"].tolist(), list(zip(pdf["leaf"].tolist(), pdf["own"].tolist())))
        return pd.DataFrame({"conv_id": pdf["conv_id"].to_numpy(), "depth": pdf["depth"].to_numpy(),
                             "leaves": [x[0] for x in sums], "saved": [x[1] for x in sums]})
    held: list[pd.DataFrame] = []
    for pdf in frames:
        if not len(pdf):
            continue
        cut = ((pdf["tc"] != pdf["tc"].shift()) | (pdf["td"] != pdf["td"].shift())).to_numpy().nonzero()[0].tolist()
        done = []
        for a, b in zip(cut, [*cut[1:], len(pdf)]):
            part = pdf.iloc[a:b]
            if held and (held[-1]["tc"].iloc[0], held[-1]["td"].iloc[0]) != (part["tc"].iloc[0], part["td"].iloc[0]):
                done.append(solve(pd.concat(held)))
                held = []
            held.append(part)
        if done:
            yield pd.concat(done)
    if held:
        yield solve(pd.concat(held))


def _split(work: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: the sums that the centroids of the components add, and the components left."""
    comp = ["tc", "td"]
    centroids = (work.where("2 * weight >= total").groupBy(*comp).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("g"))
                 .select(*comp, F.col("g.depth").alias("gd"), F.col("g.conv_id").alias("gc"), F.col("g.weight").alias("gw")))
    # the child of the centroid that a node hangs on stands on the node's own path
    child = paths.select(F.col("conv_id").alias("_c"), F.col("depth").alias("_d"), F.col("node").alias("child"), F.col("parent").alias("_p"))
    met = work.join(centroids, comp)
    met = met.join(child, (met["conv_id"] == child["_c"]) & (met["gd"] + 1 == child["_d"]), "left")
    met = materialize(
        met.withColumn("centre", (F.col("depth") == F.col("gd")) & (F.col("conv_id") == F.col("gc")))
        .withColumn("below", (F.col("depth") > F.col("gd")) & F.coalesce(F.col("_p") == F.col("gc"), F.lit(False)))
        .drop("_c", "_d", "_p"), "split")
    totals = materialize(
        met.where("centre OR below").groupBy("gc", "gd", "td").agg(
            F.sum("leaf").alias("leaves"), F.sum("own").alias("saved"), F.max("gw").alias("gw")), "totals")
    steps = (totals.where("gd > td").withColumn("depth", F.explode(F.sequence("td", F.col("gd") - 1)))
             .select(F.col("gc").alias("conv_id"), "depth", "leaves", "saved", "gw"))
    path = materialize(steps.join(paths.select("conv_id", "depth", "node"), ["conv_id", "depth"])
                       .select(F.col("node").alias("conv_id"), "depth", "leaves", "saved", "gw"), "path")
    sums = path.drop("gw").unionByName(totals.select(F.col("gc").alias("conv_id"), F.col("gd").alias("depth"), "leaves", "saved"))
    left = met.where("NOT centre").join(path.select("conv_id", "depth", F.col("gw").alias("less")), ["conv_id", "depth"], "left")
    return sums, left.select("conv_id", "depth", "parent", "leaf", "own", (F.col("weight") - F.coalesce("less", F.lit(0))).alias("weight"),
                             F.when(F.col("below"), F.col("child")).otherwise(F.col("tc")).alias("tc"),
                             F.when(F.col("below"), F.col("gd") + 1).otherwise(F.col("td")).alias("td"))


def subtree_sums(nodes: DataFrame, paths: DataFrame | None, width: int, local: int = LOCAL) -> DataFrame:
    """``(conv_id, depth, leaves, saved)``: sums of ``leaf`` and ``own`` over every node's subtree.

    ``nodes``: ``(conv_id, depth, parent, leaf, own, weight)`` of one tree.
    ``paths``: the node ``(node, depth)`` of every prefix of conversation
    ``conv_id`` and the name ``parent`` of the node above; not needed for a
    tree of ``local`` nodes.
    """
    comp = ["tc", "td"]
    top = nodes.where("parent IS NULL").select(F.col("conv_id").alias("tc"), F.col("depth").alias("td")).first()
    if top is None:
        return nodes.select("conv_id", "depth", F.col("leaf").alias("leaves"), F.col("own").alias("saved"))
    # written, so that the first round's joins are on columns, not on constants
    state = materialize(nodes.withColumn("tc", F.lit(top["tc"])).withColumn("td", F.lit(top["td"])), "forest")
    added, ready = [], []
    while True:
        sizes = state.groupBy(*comp).agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total"))
        state = materialize(state.join(sizes, comp), "components")
        ready.append(state.where(F.col("n") <= local).drop("n", "total"))
        work = state.where(F.col("n") > local).drop("n")
        if work.isEmpty():
            break
        sums, state = _split(work, paths)
        added.append(sums)
    whole = ready[0]
    for x in ready[1:]:
        whole = whole.unionByName(x)
    whole = whole.withColumn("parent", F.coalesce("parent", F.lit(-1)))  # there is no node of depth -1
    out = whole.repartition(width, *comp).sortWithinPartitions(*comp, "depth", "conv_id").mapInPandas(_finish, SUMS)
    for x in added:
        out = out.unionByName(x.select("conv_id", "depth", "leaves", "saved"))
    return out.groupBy("conv_id", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


# ---- the members that end at a node ---------------------------------------------


def _pieces(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted ids of a node, up to ``PIECE`` of them in one string."""
    for pdf in frames:
        if not len(pdf):
            continue
        new = (pdf["node"] != pdf["node"].shift()) | (pdf["depth"] != pdf["depth"].shift())
        at = pdf.groupby(new.cumsum()).cumcount() // PIECE
        parts = pdf.assign(text=pdf["member"].astype(str)).groupby([new.cumsum(), at], sort=False)
        yield parts.agg(node=("node", "first"), depth=("depth", "first"), first=("member", "first"), text=("text", ",".join))


def _digests(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each node's pieces, which come in order; only the hash's state is held."""
    key, state = None, None
    for pdf in frames:
        out = []
        for node, depth, text in zip(pdf["node"].tolist(), pdf["depth"].tolist(), pdf["text"].tolist()):
            if (node, depth) != key:
                if key:
                    out.append((*key, state.hexdigest()))
                key, state = (node, depth), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pd.DataFrame(out, columns=["conv_id", "depth", "ends"])
    if key:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["conv_id", "depth", "ends"])


def ending_members(ends: DataFrame, width: int) -> DataFrame:
    """``(conv_id, depth, ends)``: SHA-256 of the ids, ascending and comma-joined, of the
    ``member`` rows of each ``(node, depth)``.

    A hash takes its bytes one after another, so a node's pieces go through one
    task in the end, as a stream; the sorting and joining before is spread.
    """
    order = ["node", "depth", "member"]
    pieces = (ends.repartitionByRange(width, *order).sortWithinPartitions(*order)
              .mapInPandas(_pieces, "node long, depth long, first long, text string"))
    return (pieces.repartition(width, "node", "depth").sortWithinPartitions("node", "depth", "first")
            .mapInPandas(_digests, "conv_id long, depth long, ends string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, local: int = LOCAL) -> DataFrame:
    """The nodes of the trie of ``turns(conv_id, pos, item, size, len)`` and ``convs(conv_id, len)``:
    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``."""
    width = shuffle_width(turns.sparkSession)
    prefixes = materialize(_prefixes(turns), "prefixes")
    found = materialize(_nodes(prefixes, convs), "trie_nodes")
    n_nodes, n_rows = found.count(), prefixes.count()

    children = found.where("depth > 0").groupBy(*PARENT).agg(F.count(F.lit(1)).alias("n_children"))
    children = children.select(*(F.col(p).alias(k) for p, k in zip(PARENT, KEY)), "n_children")
    nodes = materialize(found.join(children, KEY, "left").fillna(0, ["n_children"]), "nodes")
    above = nodes.select(*(F.col(k).alias(p) for p, k in zip(PARENT, KEY)), F.col("conv_id").alias("parent"),
                         F.col("n_children").alias("many"))
    nodes = materialize(join_spreading_hot(nodes, above, PARENT, "many", n_nodes).drop("many"), "tree")

    owner = nodes.select(*KEY, F.col("conv_id").alias("node"), "parent", F.col("n_convs").alias("many"))
    last = prefixes.where("depth = len").select(*KEY, F.col("conv_id").alias("member"))
    zero = F.lit(0).cast("long")
    last = last.unionByName(convs.where("len = 0").select(*(zero.alias(k) for k in KEY), F.col("conv_id").alias("member")))
    ends = ending_members(join_spreading_hot(last, owner, KEY, "many", n_rows).select("node", "depth", "member"), width)

    paths = None
    if n_nodes > local:
        paths = join_spreading_hot(prefixes.select("conv_id", *KEY), owner, KEY, "many", n_rows)
        root = F.lit(nodes.where("depth = 0").first()["conv_id"])
        start = convs.select("conv_id", zero.alias("depth"), root.alias("node"), F.lit(None).cast("long").alias("parent"))
        paths = materialize(paths.select("conv_id", "depth", "node", "parent").unionByName(start), "paths")
    own = nodes.select("conv_id", "depth", "parent", (F.col("n_children") == 0).cast("long").alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("size")).alias("own"), "weight")
    sums = subtree_sums(own, paths, width, local)
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children")
            .join(sums, ["conv_id", "depth"]).join(ends, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(none)).alias("ends_sha256")))
