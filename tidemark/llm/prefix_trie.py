"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. Turns are told by a digest, sequences by two 64-bit
hashes of the digests with their places, joined by exclusive or, so that a prefix of any length is
a running total and a long conversation can be worked on in parts by several tasks.

Neighbouring nodes with the same members form a chain (in a chain nothing branches or ends), told
by smallest member and number of members. What lies below a node is the rest of its chain, which
follows from running totals along the conversation, and what lies below the chain. For the latter the
forest of chains is decomposed: of every component the centroid is the lowest chain that holds over half
of its conversations. It is taken out; its subtree's total is the sum of its own and the totals of the
components below it, and is added to every chain on the path from the centroid to the component's top.
These paths are read off the members, which know all their chains, so nothing is chased link by link.
Components at least halve in conversations each round, however deep the trie. Those of `LOCAL` chains or
fewer are added up in a task from the bottom, many components a task.

Defined results: null role or text is empty; rows without a conv_id are no conversation and are left
out; turns with equal numbers (null is first) are in the order of role, then of their digest, and
repeated rows are turns of their own; an empty table has no node, not even a root. Other columns,
whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import stored

#: Chains of a component that is added up within one task.
LOCAL = 1000
#: Ids of a node that are sorted within one task.
LONG_LIST = 10_000
_EMPTY = hashlib.sha256(b"").hexdigest()


def turns(df: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, t1, t2, chars): turns without their texts, which t1 and t2 stand for."""
    role_, text_ = F.coalesce(df[role], F.lit("")), F.coalesce(df[text], F.lit(""))
    digest = F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    part = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]
    return df.where(df[conv_id].isNotNull()).select(
        df[conv_id].cast("long").alias("conv"), df[turn].alias("turn"), role_.alias("role"),
        part[0].alias("t1"), part[1].alias("t2"), F.length(text_).cast("long").alias("chars"),
    )


def placed_hash(t1: Column, t2: Column, place: Column) -> list[Column]:
    """Two hashes of a turn at a place, of which a sequence has the exclusive or."""
    return [F.xxhash64(t1, t2, place).alias("x1"), F.xxhash64(place, t2, t1, F.lit(1)).alias("x2")]


def _running(window: Window) -> list[Column]:
    return [
        F.expr("bit_xor(x1)").over(window).alias("h1"),
        F.expr("bit_xor(x2)").over(window).alias("h2"),
        F.sum("chars").over(window).alias("total"),
    ]


def rebuilt(rows: DataFrame, head: Column | None = None, origin: Column | None = None) -> DataFrame:
    """(conv, d, h1, h2, total, chars, last): each conversation's nodes from depth 1 on, and one row of
    depth 0 for a conversation that has none. total: characters up to the node. last: it ends there.

    head: so many first turns of a conversation are replaced by those of the conversation `origin`,
    both of column conv. Of a conversation of very many turns no task gets more than its part of the
    range-sorted rows.
    """
    head = F.lit(0) if head is None else head
    origin = F.col("conv") if origin is None else origin
    order = ("conv", F.asc_nulls_first("turn"), "role", "t1", "t2")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the number holds the partition, and the place within it
    ordered = stored(ordered.select("conv", "t1", "t2", "chars", F.monotonically_increasing_id().alias("number")))
    ordered = ordered.withColumn("part", F.shiftright("number", 33))
    of_conv = Window.partitionBy("conv").orderBy("part")
    parts = ordered.groupBy("conv", "part").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    parts = stored(
        parts.select(
            "conv", "part", "first",
            (F.sum("n").over(of_conv) - F.col("n")).alias("before"),
            F.sum("n").over(Window.partitionBy("conv")).alias("n_turns"),
        )
    )
    convs = parts.where("before = 0").select("conv", "n_turns", head.cast("long").alias("head"), origin.alias("origin"))
    convs = stored(convs)

    # the first turns of origins, at most as many as any conversation takes
    origins = convs.where("head > 0").groupBy("origin").agg(F.max("head").alias("most"))
    spots = ordered.join(parts.join(origins, F.col("conv") == F.col("origin")), ["conv", "part"])
    spots = spots.withColumn("place", F.col("number") - F.col("first") + F.col("before") + 1)
    spots = spots.where("place <= most").select(
        "conv", "place", *placed_hash(F.col("t1"), F.col("t2"), F.col("place")), "chars"
    )
    upto = Window.partitionBy("conv").orderBy("place")
    spots = spots.select("conv", "place", "chars", *_running(upto)).groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("place", "h1", "h2", "total", "chars"))).alias("nodes")
    )
    convs = convs.join(spots.withColumnRenamed("conv", "origin"), "origin", "left")
    taken = F.slice(F.coalesce("nodes", F.array()), F.lit(1), F.col("head").cast("int"))
    convs = convs.select("conv", "n_turns", "head", taken.alias("nodes")).withColumn("n_head", F.size("nodes").cast("long"))
    convs = stored(convs.withColumn("size", F.col("n_head") + F.greatest(F.col("n_turns") - F.col("head"), F.lit(0))))

    heads = convs.select("conv", "size", F.explode("nodes").alias("at")).select(
        "conv", F.col("at.place").alias("d"), "at.h1", "at.h2", "at.total", "at.chars",
        (F.col("at.place") == F.col("size")).alias("last"),
    )
    none = convs.where("size = 0").select(
        "conv", *(F.lit(0).cast("long").alias(c) for c in ("d", "h1", "h2", "total", "chars")), F.lit(True).alias("last")
    )
    # own turns follow: running totals within each part, then those of the parts before
    base = F.element_at("nodes", -1)
    base = {c: F.when(F.col("n_head") > 0, base[c]).otherwise(F.lit(0)).alias(f"base_{c}") for c in ("h1", "h2", "total")}
    known = parts.join(convs.select("conv", "head", "n_head", "size", *base.values()), "conv")
    own = ordered.join(known, ["conv", "part"])
    own = own.withColumn("place", F.col("number") - F.col("first") + F.col("before") + 1).where("place > head")
    own = own.withColumn("d", F.col("place") - F.col("head") + F.col("n_head"))
    own = own.select("*", *placed_hash(F.col("t1"), F.col("t2"), F.col("d")))
    within = Window.partitionBy("conv", "part").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    kept = ("conv", "part", "d", "size", "base_h1", "base_h2", "base_total", "chars")
    own = stored(own.select(*kept, *_running(within)))
    sums = own.groupBy("conv", "part").agg(F.max_by(F.struct("h1", "h2", "total"), "d").alias("x"))
    sums = sums.select("conv", "part", F.col("x.h1").alias("x1"), F.col("x.h2").alias("x2"), F.col("x.total").alias("chars"))
    earlier = of_conv.rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("conv", "part", *(F.coalesce(c, F.lit(0)).alias(f"carried_{n}") for c, n in zip(
        (F.expr("bit_xor(x1)").over(earlier), F.expr("bit_xor(x2)").over(earlier), F.sum("chars").over(earlier)),
        ("h1", "h2", "total"), strict=True,
    )))
    # only a conversation in several parts has something to carry
    carried = stored(carried.where("carried_h1 <> 0 or carried_h2 <> 0 or carried_total <> 0"))
    own = own.join(carried, ["conv", "part"], "left")
    whole = [
        reduce(lambda x, y: x.bitwiseXOR(y), (F.col(h), F.col(f"base_{h}"), F.coalesce(f"carried_{h}", F.lit(0)))).alias(h)
        for h in ("h1", "h2")
    ]
    total = F.col("total") + F.col("base_total") + F.coalesce("carried_total", F.lit(0))
    own = own.select("conv", "d", *whole, total.alias("total"), "chars", (F.col("d") == F.col("size")).alias("last"))
    return heads.unionByName(own).unionByName(none)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, h1, h2, part, piece, ids): joined ids of sorted rows, some of a node at a time, numbered in order."""
    part, piece = TaskContext.get().partitionId(), 0
    for batch in batches:
        out: list[tuple] = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("d", "h1", "h2", "conv")), strict=True)
        for key, group in groupby(rows, key=lambda r: r[:3]):
            out.append((*key, part, piece, ",".join(str(r[3]) for r in group)))
            piece += 1
        columns = zip(*out, strict=True) if out else [[]] * 6
        arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 5 + [pa.string()], strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["d", "h1", "h2", "part", "piece", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, h1, h2, sha) of nodes whose pieces come in order; holds one piece at a time."""

    def row(key: tuple, sha) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"d": [key[0]], "h1": [key[1]], "h2": [key[2]], "sha": [sha.hexdigest()]})

    last, sha = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            key = tuple(batch.column(c)[i].as_py() for c in ("d", "h1", "h2"))
            if key != last:
                if last:
                    yield row(last, sha)
                last, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(batch.column("ids")[i].as_py().encode())
    if last:
        yield row(last, sha)


def ends_hashed(ends: DataFrame, limit: int = LONG_LIST) -> DataFrame:
    """(d, h1, h2, sha): SHA-256 of the ids of the conversations that end at a node, ascending, comma-joined.

    A hash is computed in order, so the ids of one node have to pass one task, but never at once: those of more
    than `limit` are sorted by all tasks, joined to pieces there, and hashed piece by piece.
    """
    node = ["d", "h1", "h2"]
    many = stored(ends.groupBy(*node).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(*node))
    few = ends.join(many, node, "left_anti").groupBy(*node).agg(
        F.sha2(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ","), 256).alias("sha")
    )
    order = [*node, "conv"]
    listed = ends.join(many, node, "left_semi").repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = stored(listed.mapInArrow(_pieces, "d long, h1 long, h2 long, part long, piece long, ids string"))
    dealt = pieces.repartition(*node).sortWithinPartitions(*node, "part", "piece")
    return few.unionByName(dealt.mapInArrow(_hashed, "d long, h1 long, h2 long, sha string"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, leaves, saved): totals of the subtrees of components whose rows come together, parents first."""

    def totals(rows: list[tuple]) -> pa.RecordBatch:
        place = {(r[1], r[2]): i for i, r in enumerate(rows)}
        leaves, saved = [r[5] for r in rows], [r[6] for r in rows]
        for i in range(len(rows) - 1, -1, -1):
            up = place.get((rows[i][3], rows[i][4]))
            if up is not None:
                leaves[up] += leaves[i]
                saved[up] += saved[i]
        columns = {
            "v_rep": [r[1] for r in rows],
            "v_n": [r[2] for r in rows],
            "leaves": [x + r[7] for x, r in zip(leaves, rows, strict=True)],
            "saved": [x + r[8] for x, r in zip(saved, rows, strict=True)],
        }
        return pa.RecordBatch.from_pydict(columns, pa.schema([(c, pa.int64()) for c in columns]))

    held: list[tuple] = []
    names = ("rep", "n", "up_rep", "up_n", "leaves", "saved", "more_leaves", "more_saved")
    for batch in batches:
        comps = zip(batch.column("comp_rep").to_pylist(), batch.column("comp_n").to_pylist(), strict=True)
        for row in zip(comps, *(batch.column(c).to_pylist() for c in names), strict=True):
            if held and held[-1][0] != row[0] and len(held) >= LOCAL:
                yield totals(held)
                held = []
            held.append(row)
    if held:
        yield totals(held)


def _names(prefix: str, *columns: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}_{c}") for c in columns]


def rolled_up(vertices: DataFrame, paths: DataFrame, local: int = LOCAL) -> DataFrame:
    """(v_rep, v_n, leaves, saved): sums of leaves and saved over the subtree of each vertex.

    vertices: (rep, n, top, up_rep, up_n, leaves, saved), a vertex told by (rep, n), n falling towards the
    leaves; top: its depth; up: its parent. paths: (conv, rep, n, top, next_rep, next_n, next_top), for each conv that is
    some vertex's rep, the vertices on the path from the root to its last, each with the one below.
    """
    zero = F.lit(0).cast("long")
    root = vertices.where("up_rep is null").select(*_names("comp", "rep", "n", "top"))
    # one tree, so one row; its vertices start as one component
    start = root.first()
    if start is None:
        return vertices.select(*_names("v", "rep", "n"), "leaves", "saved")
    # m: conversations below, in the component; more: what centroids taken out below have added
    state = vertices.withColumns({"m": F.col("n"), "more_leaves": zero, "more_saved": zero})
    state = state.withColumns({c: F.lit(start[c]).cast("long") for c in root.columns})
    comp, vertex = ["comp_rep", "comp_n", "comp_top"], ["rep", "n"]
    done: list[DataFrame] = []
    small: list[DataFrame] = []
    while True:
        # written, so that a component of most vertices can be split in the join
        comps = stored(state.groupBy(*comp).agg(F.count("*").alias("size"), F.max("m").alias("most")))
        large = comps.where(F.col("size") > local)
        small.append(state.join(comps.where(F.col("size") <= local).select(*comp), comp, "left_semi"))
        if large.isEmpty():
            break
        state = state.join(large.select(*comp, "most"), comp)
        # the lowest vertex with over half; where no conversation is left, the lowest of all
        able = state.where("2 * m > most or most = 0")
        one = F.max_by(F.struct("rep", "n", "top", "m", "leaves", "saved", "more_leaves", "more_saved"), F.struct("top", "rep"))
        cents = stored(able.groupBy(*comp).agg(one.alias("c")).select(*comp, *(F.col(f"c.{f}").alias(f"c_{f}") for f in (
            "rep", "n", "top", "m", "leaves", "saved", "more_leaves", "more_saved"))))
        # below the centroid, a vertex goes to the component of the centroid's child on its way
        ways = paths.join(cents, (F.col("rep") == F.col("c_rep")) & (F.col("n") == F.col("c_n")))
        ways = ways.select(F.col("conv").alias("rep"), *comp, "c_n", "c_rep", "c_top", "next_rep", "next_n", "next_top")
        state = state.join(ways, ["rep", *comp], "left")
        is_centroid = (F.col("rep") == F.col("c_rep")) & (F.col("n") == F.col("c_n"))
        below = F.col("top") > F.col("c_top")
        state = state.where(~F.coalesce(is_centroid, F.lit(False))).withColumn("below", F.coalesce(below, F.lit(False)))
        state = stored(state.drop("c_n", "c_rep", "c_top", "most"))
        # a centroid's total in its component: its own and those of the components below it
        under = state.where("below").groupBy(*comp, "next_rep", "next_n").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        )
        under = under.groupBy(*comp).agg(F.sum("leaves").alias("u_leaves"), F.sum("saved").alias("u_saved"))
        cents = cents.join(under, comp, "left")
        cents = stored(cents.select(
            *comp, "c_rep", "c_n", "c_top", "c_m", "c_more_leaves", "c_more_saved",
            *((F.col(f"c_{x}") + F.coalesce(f"u_{x}", F.lit(0))).alias(f"t_{x}") for x in ("leaves", "saved")),
        ))
        done.append(cents.select(
            F.col("c_rep").alias("v_rep"), F.col("c_n").alias("v_n"),
            *((F.col(f"t_{x}") + F.col(f"c_more_{x}")).alias(x) for x in ("leaves", "saved")),
        ))
        # the path from the centroid to its component's top
        lines = paths.join(
            cents.select("c_rep", "c_top", "comp_top", "c_m", "t_leaves", "t_saved"), F.col("conv") == F.col("c_rep")
        )
        adds = lines.where("top >= comp_top and top < c_top").select(*vertex, "c_m", "t_leaves", "t_saved")
        state = state.select(
            *vertex, "top", "up_rep", "up_n", "leaves", "saved", "m", "more_leaves", "more_saved",
            *(F.when(F.col("below"), F.col(f"next_{c}")).otherwise(F.col(f"comp_{c}")).alias(f"comp_{c}")
              for c in ("rep", "n", "top")),
        )
        state = state.join(adds, vertex, "left")
        state = state.select(
            *vertex, "top", "up_rep", "up_n", "leaves", "saved",
            (F.col("m") - F.coalesce("c_m", F.lit(0))).alias("m"),
            *((F.col(f"more_{x}") + F.coalesce(f"t_{x}", F.lit(0))).alias(f"more_{x}") for x in ("leaves", "saved")),
            *comp,
        )
        state = stored(state)
    rest = reduce(DataFrame.unionByName, [s.select(
        "comp_rep", "comp_n", *vertex, "top", "up_rep", "up_n", "leaves", "saved", "more_leaves", "more_saved"
    ) for s in small])
    rest = rest.repartition("comp_rep", "comp_n").sortWithinPartitions("comp_rep", "comp_n", "top")
    summed = rest.mapInArrow(_summed, "v_rep long, v_n long, leaves long, saved long")
    return reduce(DataFrame.unionByName, done, summed)


def prefix_trie(
    df: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    head: Column | None = None,
    origin: Column | None = None,
    local: int = LOCAL,
    long_list: int = LONG_LIST,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (of the subtree: characters that all but one member of a node need not repeat), ends_sha256.

    head, origin: columns over `conv`; the first `head` turns of a conversation are taken from another.
    local: chains of a component that a task adds up. long_list: ids of a node that are hashed in pieces.
    """
    members = stored(rebuilt(turns(df, conv_id, turn, role, text), head, origin))
    node = ["d", "h1", "h2"]
    ends = ends_hashed(members.where("last").select(*node, "conv"), long_list)
    # the root holds every conversation; it takes no part in joins, where all would meet in it
    everyone = members.where("last").agg(F.min("conv").alias("rep"), F.count("*").alias("n")).where("n > 0")
    blank = {c: F.lit(0).cast("long") for c in (*node, "total", "chars")}
    counted = members.where("d > 0").groupBy(*node).agg(
        F.min("conv").alias("rep"), F.count("*").alias("n"), F.max("total").alias("total"), F.max("chars").alias("chars")
    )
    nodes = counted.unionByName(everyone.withColumns(blank)).join(ends, node, "left")
    nodes = stored(nodes)

    chains = nodes.groupBy("rep", "n").agg(
        F.min("d").alias("top"), F.max("d").alias("bottom"),
        F.min(F.col("total") - F.col("chars")).alias("before"), F.max("total").alias("after"),
    )
    chains = stored(chains)
    # the chains of each conversation that is the smallest member of one; a chain of one member is its last
    reps = chains.select(F.col("rep").alias("conv")).distinct()
    shared = nodes.where("n > 1 and d > 0").select(*node, "rep", "n")
    passed = members.where("d > 0").select("conv", *node).join(stored(reps), "conv", "left_semi").join(shared, node)
    passed = passed.groupBy("conv", "rep", "n").agg(F.min("d").alias("top"))
    alone = chains.where("n = 1 and top > 0").select(F.col("rep").alias("conv"), "rep", "n", "top")
    first = nodes.where("d = 0").select("rep", "n").first()
    passed = passed.unionByName(alone)
    if first:
        at_root = reps.select("conv", *(F.lit(first[c]).cast("long").alias(c) for c in ("rep", "n")), F.lit(0).cast("long").alias("top"))
        same = (F.col("rep") == F.lit(first["rep"])) & (F.col("n") == F.lit(first["n"]))
        passed = passed.where(~same).unionByName(at_root)
    along = Window.partitionBy("conv").orderBy("top")
    paths = stored(passed.select(
        "*", *(F.lead(c).over(along).alias(f"next_{c}") for c in ("rep", "n", "top")),
        *(F.lag(c).over(along).alias(f"up_{c}") for c in ("rep", "n")),
    ))

    own = paths.where("conv = rep").select("rep", "n", "up_rep", "up_n")
    children = own.where("up_rep is not null").groupBy(F.col("up_rep").alias("rep"), F.col("up_n").alias("n")).agg(
        F.count("*").alias("n_below")
    )
    chains = stored(chains.join(own, ["rep", "n"]).join(children, ["rep", "n"], "left").fillna(0, ["n_below"]))
    vertices = chains.select(
        "rep", "n", "top", "up_rep", "up_n",
        F.when(F.col("n_below") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * (F.col("after") - F.col("before"))).alias("saved"),
    )
    below = rolled_up(vertices, paths.drop("up_rep", "up_n"), local)
    below = below.select(F.col("v_rep").alias("rep"), F.col("v_n").alias("n"), "leaves", "saved")
    # written, so that a chain of very many nodes can be split in the join
    chains = stored(chains.join(below, ["rep", "n"]))
    placed = nodes.join(chains, ["rep", "n"])
    up = F.when(F.col("d") > F.col("top"), F.col("rep")).otherwise(F.col("up_rep"))
    spent = (F.col("n") - 1) * (F.col("total") - F.col("chars") - F.col("before"))
    return placed.select(
        F.col("rep").alias("conv_id"), F.col("d").alias("depth"), up.alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(F.col("d") < F.col("bottom"), 1).otherwise(F.col("n_below")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("saved") - spent).alias("saved_tokens"),
        F.coalesce("sha", F.lit(_EMPTY)).alias("ends_sha256"),
    )
