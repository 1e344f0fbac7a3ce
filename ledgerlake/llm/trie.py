"""Prefix trie of conversations, in double arrays.

Conversations that begin with the same turns share the nodes of these turns.  Equal conversations
are reduced to one path first.  Paths are dealt to shards by a prefix: the shortest of 1, 2, 4, ...
turns whose conversations have at most ``shard_turns`` turns together, so a frequent opening is
split further down and everything below the chosen prefix lies in one shard.  A shard numbers its
distinct turns densely and packs its paths into BASE and CHECK arrays (the child of state s by
turn c is BASE[s] + c, and is one only if CHECK of it is s); walking the paths through the arrays
gives the nodes and their aggregates.  Nodes above the chosen prefixes are shared by several
shards: each shard sends one partial row for each, and these are merged by the digest of the prefix
and summed up to their ancestors.

Turns are compared by 128 bits of the SHA-256 of role and text.

Defined cases: rows without a conversation id belong to none; a null role or text is empty;
several rows of one position are put in (role, text) order, so repeated rows are turns of their
own; a conversation without turns ends at the root; no conversations give no rows, not even a
root; other columns are ignored.  A conversation's turns (32 characters each, not the texts) are
one row, and with its own prefix one shard; texts may be of any length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
ENDS_NOWHERE = hashlib.sha256(b"").hexdigest()
#: Ids of one path that differ in so many low bits only are joined before they are hashed in order.
ID_CHUNK_BITS = 8
SHARD = ("bucket long, upper boolean, node string, parent string, above array<string>, conv_id long, depth long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends_sha256 string")


class DoubleArray:
    """A trie over sorted sequences of codes from 1 on, in BASE and CHECK arrays; state 0 is the root."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        self.base, self.check, self.free = [0], [0], 1
        ends = offsets[1:]
        todo = [(0, 0, len(offsets) - 1, 0)]
        while todo:
            state, lo, hi, depth = todo.pop()
            while lo < hi and offsets[lo] + depth == ends[lo]:      # paths that end here come first
                lo += 1
            if lo == hi:
                continue
            if hi - lo == 1:
                for code in flat[offsets[lo] + depth:ends[lo]].tolist():
                    state = self._place(state, [code])[0]
                continue
            here = flat[offsets[lo:hi] + depth]
            codes, starts = np.unique(here, return_index=True)
            stops = np.append(starts[1:], hi - lo)
            for child, a, z in zip(self._place(state, codes.tolist()), starts.tolist(), stops.tolist()):
                todo.append((child, lo + a, lo + z, depth + 1))

    def _place(self, state: int, codes: list[int]) -> list[int]:
        """Give the children of a state their places: the first base that fits in 64 tries, else the end."""
        check, first = self.check, self.free
        while first < len(check) and check[first] >= 0:
            first += 1
        self.free = first
        spread = [c - codes[0] for c in codes]
        for _ in range(64):
            if all(first + s >= len(check) or check[first + s] < 0 for s in spread):
                break
            first += 1
            while first < len(check) and check[first] >= 0:
                first += 1
        else:
            first = len(check)
        grow = first + spread[-1] + 1 - len(check)
        if grow > 0:
            check.extend([-1] * grow)
            self.base.extend([0] * grow)
        self.base[state] = first - codes[0]
        for s in spread:
            check[first + s] = state
        return [first + s for s in spread]

    def walk(self, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The state after every code of every sequence."""
        base, check = np.array(self.base), np.array(self.check)
        lengths, out = np.diff(offsets), np.empty(len(flat), np.int64)
        rows, state = np.arange(len(lengths)), np.zeros(len(lengths), np.int64)
        for depth in range(int(lengths.max(initial=0))):
            more = lengths[rows] > depth
            rows, state = rows[more], state[more]
            at = offsets[rows] + depth
            after = base[state] + flat[at]
            if not np.array_equal(check[after], state):
                raise AssertionError("a sequence left the trie")
            out[at] = state = after
        return out


def _shard_nodes(table: pa.Table) -> pa.Table:
    """The nodes of one shard's paths: whole ones, and partial ones of shared upper nodes."""
    paths, words = table.column("path").combine_chunks(), table.column("words").combine_chunks()
    offsets = paths.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    names = paths.flatten().dictionary_encode()
    codes = names.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    words = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n, first, whole, ends = (table.column(c).to_pylist() for c in ("n", "first", "whole_from", "ends"))
    # sort the paths, so that those under one prefix are neighbours
    parts = [codes[a:z].tolist() for a, z in zip(offsets, offsets[1:])]
    order = sorted(range(len(parts)), key=parts.__getitem__)
    lengths = np.array([len(parts[r]) for r in order], np.int64)
    flat = np.array([c for r in order for c in parts[r]], np.int64)
    starts, offsets = offsets, np.concatenate(([0], np.cumsum(lengths)))
    words = np.concatenate([words[starts[r]:starts[r + 1]] for r in order] or [words])
    n, first, whole = (np.array([v[r] for r in order], np.int64) for v in (n, first, whole))
    ends = [ends[r] for r in order]
    trie = DoubleArray(flat, offsets)
    states = trie.walk(flat, offsets)

    size = len(trie.check)
    convs, least, depth = np.zeros(size, np.int64), np.full(size, 2**63 - 1), np.full(size, -1)
    last_words, is_whole, ends_at = np.zeros(size, np.int64), np.zeros(size, bool), {}
    path_of = np.repeat(np.arange(len(order)), lengths)
    depths = np.arange(len(flat)) - offsets[path_of] + 1
    np.add.at(convs, states, n[path_of])
    np.minimum.at(least, states, first[path_of])
    depth[states], last_words[states] = depths, words
    is_whole[states] = depths >= whole[path_of]
    convs[0], least[0], depth[0] = n.sum(), first.min(), 0
    for row, (length, stop) in enumerate(zip(lengths.tolist(), offsets[1:].tolist())):
        ends_at[int(states[stop - 1]) if length else 0] = ends[row]

    # sums over subtrees, from the deepest nodes up; shared nodes collect from whole children only
    parent = np.array(trie.check)
    used = np.flatnonzero(depth >= 0)
    used = used[np.argsort(depth[used], kind="stable")]
    children, leaves, saved = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(children, parent[used[is_whole[used]]], 1)
    own = (convs - 1) * last_words
    for d in range(int(depth.max()), 0, -1):
        level = used[np.searchsorted(depth[used], d):np.searchsorted(depth[used], d, "right")]
        level = level[is_whole[level]]
        saved[level] += own[level]
        leaves[level] += children[level] == 0
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])

    # shared nodes are named by a digest of their prefix
    label, name, above = names.dictionary, {0: ""}, {0: []}
    shared = used[~is_whole[used]].tolist()
    code_of = dict(zip(states.tolist(), flat.tolist()))
    for s in shared:
        if s:
            up = int(parent[s])
            name[s] = hashlib.md5((name[up] + label[code_of[s] - 1].as_py()).encode()).hexdigest()
            above[s] = [*above[up], name[up]]
    rows = used.tolist()
    ups = [int(parent[s]) if s else None for s in rows]
    return pa.table({
        "bucket": pa.array([table.column("bucket")[0].as_py()] * len(rows), pa.int64()),
        "upper": pa.array(~is_whole[used]),
        "node": pa.array([name.get(s) for s in rows], pa.string()),
        "parent": pa.array([None if up is None else name.get(up) for up in ups], pa.string()),
        "above": pa.array([above.get(s) for s in rows], pa.list_(pa.string())),
        "conv_id": pa.array(least[used]),
        "depth": pa.array(depth[used]),
        "parent_conv_id": pa.array([None if up is None or up in name else int(least[up]) for up in ups], pa.int64()),
        "n_convs": pa.array(convs[used]), "n_children": pa.array(children[used]), "n_leaves": pa.array(leaves[used]),
        "saved_tokens": pa.array(saved[used]), "words": pa.array(last_words[used]),
        "ends_sha256": pa.array([ends_at.get(s) for s in rows], pa.string())})


def _ends(members: DataFrame) -> DataFrame:
    """(seq, ends) of members (seq, conv_id): the SHA-256 of each group's ascending ids, comma-joined.

    Ids are joined in chunks of neighbouring numbers, and the chunks hashed in order as they come, so
    no group is held whole.
    """
    joined = (members.groupBy("seq", F.shiftright("conv_id", ID_CHUNK_BITS).alias("chunk")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
              .select("seq", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids")))

    def run(batches):
        now, state = None, None
        for b in batches:
            out = []
            for seq, ids in zip(b.column("seq").to_pylist(), b.column("ids")):
                if seq != now:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = seq, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_py().encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["seq", "ends"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["seq", "ends"])

    return joined.repartition("seq").sortWithinPartitions("seq", "chunk").mapInArrow(run, "seq string, ends string")


def _paths(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv_id, path, words): the keys and word counts of every conversation's turns, in order."""
    role, text = text_or_empty(F.col("role")), text_or_empty(F.col("text"))
    key = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    keyed = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "position", role.alias("role"), text.alias("text"),
        key.alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    several = Window.partitionBy("conv_id", "position").orderBy("role", "text")
    listed = (keyed.withColumn("nth", F.row_number().over(several)).groupBy("conv_id")
              .agg(F.array_sort(F.collect_list(F.struct("position", "nth", "key", "words"))).alias("turns")))
    everyone = convs.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    turn = F.coalesce("turns", F.array().cast("array<struct<position:long,nth:int,key:string,words:long>>"))
    return (everyone.join(listed.withColumn("turns", F.col("turns").cast("array<struct<position:long,nth:int,key:string,words:long>>")), "conv_id", "left")
            .select("conv_id", F.transform(turn, lambda t: t["key"]).alias("path"), F.transform(turn, lambda t: t["words"]).alias("words")))


def _sharded(paths: DataFrame, shard_turns: int) -> DataFrame:
    """Distinct paths with their shard's bucket and the depth from which their nodes are whole there."""
    seq = F.sha2(F.array_join("path", ""), 256)
    named = cut(paths.withColumn("seq", seq))
    distinct = named.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"),
                                        F.first("path").alias("path"), F.first("words").alias("words"))
    distinct = cut(distinct.join(_ends(named.select("seq", "conv_id")), "seq"))
    size = F.size("path")
    powers = F.filter(F.expr("transform(sequence(0, 30), k -> shiftleft(1, k))"), lambda d: d < size)
    levels = F.when(size > 0, F.concat(powers, F.array(size))).otherwise(F.array(F.lit(0)))
    prefixes = distinct.select("seq", size.alias("turns"), F.explode(levels).alias("level"), "path").select(
        "seq", "turns", "level", F.sha2(F.concat_ws(",", F.col("level"), F.array_join(F.slice("path", F.lit(1), F.greatest("level", F.lit(1))), "")), 256).alias("prefix"))
    heavy = prefixes.groupBy("prefix").agg(F.sum("turns").alias("all")).filter(F.col("all") > shard_turns)
    # the first level that is not heavy; a path that has none stands by itself at its full length
    light = (prefixes.join(heavy, "prefix", "left").groupBy("seq")
             .agg(F.min(F.when(F.col("all").isNull(), F.struct("level", "prefix"))).alias("at"),
                  F.max(F.struct("level", "prefix")).alias("full"), F.max("turns").alias("turns")))
    total = distinct.agg(F.sum(size)).first()[0] or 0
    buckets = 1 + 2 * total // shard_turns
    level = F.coalesce(F.col("at.level"), F.col("full.level"))
    # only a level of 1, 2, 4, ... turns is counted over all paths that reach it
    all_there = F.col("at").isNotNull() & (level > 0) & (level.bitwiseAND(level - 1) == 0)
    return distinct.join(light.select(
        "seq", F.pmod(F.xxhash64(F.coalesce(F.col("at.prefix"), F.col("full.prefix"))), F.lit(buckets)).alias("bucket"),
        F.when(all_there, level).otherwise(level + 1).cast("long").alias("whole_from")), "seq")


def nodes(turns: DataFrame, convs: DataFrame, shard_turns: int = 10_000) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, position, role, text; convs: all conversations (conv_id), with or without turns.
    """
    dealt = _sharded(_paths(turns, convs), shard_turns).select("bucket", "path", "words", "n", "first", "whole_from", "ends")
    found = cut(dealt.groupBy("bucket").applyInArrow(_shard_nodes, SHARD))
    parts = found.filter("upper")
    shared = cut(parts.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("above").alias("above"), F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("whole_children"),
        F.sum("n_leaves").alias("whole_leaves"), F.sum("saved_tokens").alias("whole_saved"), F.first("words").alias("words"),
        F.max("ends_sha256").alias("ends_sha256")))
    below = shared.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("shared_children")).filter("node IS NOT NULL")
    counted = cut(shared.join(below, "node", "left")
                  .withColumn("n_children", F.col("whole_children") + F.coalesce("shared_children", F.lit(0))))
    sums = (counted.select(F.explode(F.concat("above", F.array("node"))).alias("node"),
                           (F.col("whole_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
                           (F.col("whole_saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
            .groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    ids = counted.select(F.col("node").alias("parent"), F.col("conv_id").alias("above_id"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    top = counted.join(sums, "node").join(ids, "parent", "left").withColumn("parent_conv_id", F.col("above_id"))
    # whole nodes right below a shared one learn its id through their shard's row of it
    of_shard = parts.select("bucket", F.col("node").alias("parent")).join(ids, "parent")
    whole = found.filter("NOT upper")
    edge = (whole.filter("parent IS NOT NULL").join(of_shard, ["bucket", "parent"])
            .withColumn("parent_conv_id", F.col("above_id")))
    rows = whole.filter("parent IS NULL").select(out).unionByName(edge.select(out)).unionByName(top.select(out))
    return rows.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(ENDS_NOWHERE)))
