"""The trie of conversation prefixes, in balanced parentheses.

A node is a distinct sequence of first turns; its members are the
conversations that begin with it.  Conversations are dealt into shards by
ranges of their turn digests, so a shard holds neighbours of the trie's
depth-first order.  A shard writes its part of the trie as a string of
parentheses, one pair a node, with the lowest excess of every block and of
every pair of blocks above (a range min-max tree).  ``findclose`` on it
delimits each subtree; the rank of leaf pairs "()" counts its leaves, a
cumulative array over the nodes in preorder sums its savings.

Only nodes on the paths of a shard's first and last conversation can also
belong to other shards.  These spines are merged in one stream over all
shards: at most two paths a shard, not data.  Their members' ids are hashed
in a stream over joined pieces of 65,536 ids, since a digest over a sequence
has to be taken in order.

Texts do not move: digests and word counts are made in the scan.  A turn is
24 bytes from there on.  A task holds one shard, of bounded size unless one
conversation alone is larger: its digests have to fit into a task.

Awkward rows: rows without a conversation id take no part; null roles and
texts are empty; turns without a number come first, equal numbers go by role,
then by the digest of role and text; repeated turns are turns.  Conversations
without turns are members of the root.  Turns are digested and counted whole,
whatever their length; equal means equal 128-bit digests.  Further columns
are not read.  An empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.batches import ragged
from trawl.plans.lineage import materialize

WORD = r"[^\x20\x09-\x0D]+"
SHARD_TURNS = 1 << 18
#: Conversations a shard has at least, as long as there are fewer shards than shuffle partitions.
SHARD_ROWS = 256
PIECE_IDS = 1 << 16
BLOCK = 64
QUERIES_AT_ONCE = 1 << 15


class Parentheses:
    """A string of balanced parentheses with range min-max blocks of its excess."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(bool)
        self.excess = np.cumsum(np.where(self.bits, 1, -1)).astype(np.int32)
        blocks = max(-(-len(bits) // BLOCK), 1)
        size = 1 << (blocks - 1).bit_length()
        padded = np.full(size * BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        padded[: len(bits)] = self.excess
        self.rows = padded.reshape(size, BLOCK)
        self.least = [self.rows.min(axis=1)]
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(axis=1))
        leaf = np.zeros(len(bits), dtype=bool)
        leaf[:-1] = self.bits[:-1] & ~self.bits[1:]
        self.leaf_rank = np.concatenate([[0], np.cumsum(leaf)])

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """The closing place of each opening one."""
        cuts = range(QUERIES_AT_ONCE, len(opens), QUERIES_AT_ONCE)
        return np.concatenate([np.zeros(0, np.int64), *(self._close(x) for x in np.split(opens, cuts))])

    def _close(self, opens: np.ndarray) -> np.ndarray:
        goal = self.excess[opens] - 1
        block, within = opens // BLOCK, opens % BLOCK
        own = (self.rows[block] <= goal[:, None]) & (np.arange(BLOCK) > within[:, None])
        found = own.any(axis=1)
        close = block * BLOCK + own.argmax(axis=1)
        if found.all():
            return close
        # up to the first neighbour on the right that goes low enough, then down to its first block
        left = np.flatnonzero(~found)
        node, aim, level = block[left], goal[left], np.zeros(len(left), dtype=np.int64)
        climbing = np.ones(len(left), dtype=bool)
        for up, least in enumerate(self.least[:-1]):
            here = climbing & (node % 2 == 0)
            low = np.flatnonzero(here)[least[node[here] + 1] <= aim[here]]
            node[low] += 1
            climbing[low], level[low] = False, up
            node[climbing] >>= 1
        for down in range(len(self.least) - 1, 0, -1):
            deep = np.flatnonzero(level >= down)
            first = node[deep] * 2
            node[deep] = first + (self.least[down - 1][first] > aim[deep])
        close[left] = node * BLOCK + (self.rows[node] <= aim[:, None]).argmax(axis=1)
        return close


def common_lengths(keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many first turns each sequence shares with the one before it; 0 for the first."""
    shared = np.zeros(len(lengths), dtype=np.int64)
    if len(lengths) < 2:
        return shared
    least = np.minimum(lengths[1:], lengths[:-1])
    depth = ragged(np.zeros_like(least), least)
    here = np.repeat(starts[1:], least) + depth
    there = np.repeat(starts[:-1], least) + depth
    differ = (keys[here] != keys[there]).any(axis=1)
    some = np.flatnonzero(least)
    if len(some):
        first = np.where(differ, depth, np.iinfo(np.int64).max)
        firsts = np.minimum.reduceat(first, (np.cumsum(least) - least)[some])
        shared[some + 1] = np.minimum(firsts, least[some])
    return shared


class Shard:
    """The trie of sorted sequences; nodes are numbered in preorder, the root is 0."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, keys: np.ndarray, words: np.ndarray):
        self.ids, self.lengths, self.keys = ids, lengths, keys
        starts = np.cumsum(lengths) - lengths
        shared = common_lengths(keys, starts, lengths)
        new = lengths - shared
        closes = np.concatenate([[0], lengths[:-1] - shared[1:]])
        runs = np.concatenate([[1], np.stack([closes, new], axis=1).ravel(), [lengths[-1] + 1]])
        self.parens = Parentheses(np.repeat(np.concatenate([[1], np.tile([0, 1], len(lengths)), [0]]), runs))
        self.opens = np.flatnonzero(self.parens.bits)
        self.close = self.parens.findclose(self.opens)
        n = len(self.opens)
        #: of each node: depth, place of its last turn, first sequence and the one behind its last
        self.depth = self.parens.excess[self.opens].astype(np.int64) - 1
        self.turn = np.concatenate([[-1], ragged(starts + shared, new)])
        self.first = np.concatenate([[0], np.repeat(np.arange(len(lengths)), new)])
        begins = np.cumsum(runs)[1:-1:2]
        self.stop = np.searchsorted(begins, self.close, side="right")
        self.behind = np.arange(n) + (self.close - self.opens + 1) // 2
        self.members = self.stop - self.first
        self.words = np.concatenate([[0], words[self.turn[1:]]])
        bounds = np.stack([self.first, self.stop], axis=1).ravel()
        self.least_id = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), bounds)[::2]
        by_depth = np.argsort(self.depth, kind="stable")
        spread = self.depth[by_depth] * n + by_depth
        over = np.searchsorted(spread, (self.depth - 1) * n + np.arange(n)) - 1
        self.parent = np.where(self.depth > 0, by_depth[over], -1)
        #: only these can have parts in other shards
        self.spine = (np.arange(n) <= lengths[0]) | (self.stop == len(lengths))
        inner = ~self.spine
        self.children = np.bincount(self.parent[1:][inner[1:]], minlength=n)
        leaf = self.behind == np.arange(n) + 1
        # leaf pairs of the subtree, without leaves of spines
        spine_leaves = np.concatenate([[0], np.cumsum(leaf & self.spine)])
        rank = self.parens.leaf_rank
        self.leaves = rank[self.close] - rank[self.opens] - (spine_leaves[self.behind] - spine_leaves[:-1])
        savings = np.concatenate([[0], np.cumsum(np.where(inner, (self.members - 1) * self.words, 0))])
        self.saved = savings[self.behind] - savings[:-1]
        # sequences that end with a node stand at the start of its range
        copies = np.concatenate([[True], (shared[1:] < lengths[1:]) | (lengths[1:] != lengths[:-1])])
        heads = np.flatnonzero(copies)
        last_node = np.cumsum(new)[heads]
        self.ends_at = np.full(n, -1)
        self.ends_at[last_node] = heads
        self.n_ends = np.zeros(n, dtype=np.int64)
        self.n_ends[last_node] = np.diff(np.append(heads, len(lengths)))

    def ends(self, node: int) -> np.ndarray:
        return self.ids[self.ends_at[node] : self.ends_at[node] + self.n_ends[node]]

    def spines(self) -> Iterator[tuple[int, int, int]]:
        """(path, depth, node): all of the first path, then what the last one has besides."""
        count = int(self.lengths[0]) + 1
        yield from ((0, d, d) for d in range(count))
        yield from ((1, int(self.depth[v]), int(v)) for v in np.flatnonzero(self.spine)[count:])


def joined(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
PARTS = f"kind int, shard int, path int, {NODE}, words long, turn binary, piece long, ends string"
FINAL, SPINE, IDS = 0, 1, 2


def shard_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, keys, words) of one shard -> its nodes; parts of those on spines, and their members' ids.

    A node below a spine has no ``parent_conv_id`` yet, but the path on which
    its parent lies, one depth up.
    """
    ids, lengths, keys, words = [], [], [], []
    for batch in batches:
        ids.append(batch.column("id").to_numpy(zero_copy_only=False))
        lengths.append(batch.column("keys").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        flat = batch.column("keys").flatten().cast(pa.binary(16))
        raw = np.frombuffer(flat.buffers()[1], dtype=np.uint64, offset=16 * flat.offset, count=2 * len(flat))
        keys.append(raw.reshape(-1, 2).copy())
        words.append(batch.column("words").flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    if not ids or not sum(map(len, ids)):
        return
    shard = Shard(*(np.concatenate(x) for x in (ids, lengths, keys, words)))
    number = TaskContext.get().partitionId()
    path_of = np.zeros(len(shard.depth), dtype=np.int64)
    path_of[shard.lengths[0] + 1 :] = 1

    def rows(kind: int, nodes: np.ndarray, **other) -> pa.RecordBatch:
        nothing = pa.nulls(len(nodes))
        made = {
            "kind": np.full(len(nodes), kind), "shard": np.full(len(nodes), number), "path": nothing,
            "conv_id": shard.least_id[nodes], "depth": shard.depth[nodes], "parent_conv_id": nothing,
            "n_convs": shard.members[nodes], "n_children": shard.children[nodes], "n_leaves": shard.leaves[nodes],
            "saved_tokens": shard.saved[nodes], "words": shard.words[nodes], "turn": nothing, "piece": nothing,
            "ends": nothing, **other,
        }
        return pa.RecordBatch.from_arrays([pa.array(v).cast(t) for v, t in zip(made.values(), TYPES)], list(made))

    inner = np.flatnonzero(~shard.spine)
    for first in range(0, len(inner), 1 << 14):
        nodes = inner[first : first + (1 << 14)]
        over = shard.parent[nodes]
        below = shard.spine[over]
        digests = [hashlib.sha256(joined(shard.ends(v)).encode()).hexdigest() for v in nodes.tolist()]
        yield rows(
            FINAL, nodes, ends=digests, path=pa.array(path_of[over], mask=~below),
            parent_conv_id=pa.array(shard.least_id[over], mask=below),
        )
    for path, depth, node in shard.spines():
        turn = shard.keys[shard.turn[node]].tobytes() if node else b""
        yield rows(SPINE, np.array([node]), path=[path], turn=[turn])
        members = shard.ends(node)
        for piece, first in enumerate(range(0, len(members), PIECE_IDS)):
            text = joined(members[first : first + PIECE_IDS])
            yield rows(IDS, np.array([node]), path=[path], piece=[piece], ends=[text])


TYPES = [pa.int32()] * 3 + [pa.int64()] * 8 + [pa.binary(), pa.int64(), pa.string()]
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
MERGED = f"node long, shard int, path int, {NODE}"


def merge_spines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spine parts of all shards in order -> for each part, its whole node.

    The path of the last part is a stack of nodes; a part that goes on with
    the same turn at the same depth belongs to the node there.
    """
    nodes: list[dict] = []
    stack: list[int] = []
    parts: list[tuple[int, int, int]] = []
    same = False
    for batch in batches:
        for row in batch.to_pylist():
            depth = row["depth"]
            if depth == 0:
                same = bool(stack)
            else:
                # a second path leaves the first one where it begins, with a turn of its own
                same = same and row["path"] == 0 and depth < len(stack) and nodes[stack[depth]]["turn"] == row["turn"]
            if same:
                node = nodes[stack[depth]]
                node["conv_id"] = min(node["conv_id"], row["conv_id"])
                for name in SUMS:
                    node[name] += row[name]
            else:
                del stack[depth:]
                row["parent"] = stack[-1] if stack else None
                stack.append(len(nodes))
                nodes.append(row)
            parts.append((stack[depth], row["shard"], row["path"]))
    for node in nodes:
        if node["parent"] is not None:
            nodes[node["parent"]]["n_children"] += 1
    # sums of a part hold all below it but spines; these add themselves to all above them
    own = [[int(n["n_children"] == 0), (n["n_convs"] - 1) * n["words"]] for n in nodes]
    for place in range(len(nodes) - 1, -1, -1):
        node, (leaves, saved) = nodes[place], own[place]
        node["n_leaves"] += leaves
        node["saved_tokens"] += saved
        if node["parent"] is not None:
            node["parent_conv_id"] = nodes[node["parent"]]["conv_id"]
            own[node["parent"]][0] += leaves
            own[node["parent"]][1] += saved
    names = [x.split()[0] for x in MERGED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32()] + [pa.int64()] * 7
    for first in range(0, len(parts), 1 << 14):
        some = parts[first : first + (1 << 14)]
        columns = list(zip(*some)) + [[nodes[p[0]][n] for p in some] for n in names[3:]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends) in order -> one digest a node, of the pieces joined by commas."""
    node, digest = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"node": pa.array([node], pa.int64()), "ends_sha256": [digest.hexdigest()]})

    for batch in batches:
        for place, piece in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if place == node:
                digest.update(b",")
            else:
                if digest is not None:
                    yield done()
                node, digest = place, hashlib.sha256()
            digest.update(piece.encode())
    if digest is not None:
        yield done()


def turn_lists(rows: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
               role_column: str = "role", text_column: str = "text") -> DataFrame:
    """(id, turns): the turns of each conversation in order, as (turn, role, key, words)."""
    named = rows.select(
        rows[id_column].cast("long").alias("id"), rows[turn_column].cast("long").alias("turn"),
        F.coalesce(rows[role_column].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows[text_column].cast("string"), F.lit("")).alias("text"),
    ).where("id IS NOT NULL")
    # the role's length tells where the text begins
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turn = F.struct(
        "turn", "role", F.unhex(F.md5(whole.cast("binary"))).alias("key"),
        F.regexp_count("text", F.lit(WORD)).alias("words"),
    )
    return named.select("id", turn.alias("turn")).groupBy("id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def spliced(lists: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """(id, turns): conversations that begin with turns of another one.

    The first h turns of conversation c - c % ``every`` stand in for c's own;
    h is the digest of c's number below ``heads``.
    """
    lists = materialize(lists)
    given = lists.where(F.col("id") % every == 0).select(
        F.col("id").alias("given"), F.slice("turns", 1, heads - 1).alias("head")
    )
    h = (F.crc32(F.col("id").cast("string").cast("binary")) % heads).cast("int")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    head = F.slice("head", F.lit(1), h)
    asked = lists.withColumn("given", F.col("id") - F.col("id") % every)
    return asked.join(given, "given", "left").select(
        "id", F.when(F.col("head").isNull(), own).otherwise(F.concat(head, own)).alias("turns")
    )


def prefix_trie(lists: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one row a node.

    ``lists`` holds (id, turns) with one row an id.
    """
    spark = lists.sparkSession
    paths = materialize(lists.select(
        "id", F.transform("turns", lambda t: t["key"]).alias("keys"), F.transform("turns", lambda t: t["words"]).alias("words")
    ))
    rows, turns = paths.agg(F.count("*"), F.sum(F.size("keys").cast("long"))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-(turns or 0) // SHARD_TURNS), min(partitions, -(-rows // SHARD_ROWS)), 1)
    dealt = paths.repartitionByRange(shards, "keys", "id").sortWithinPartitions("keys", "id")
    parts = materialize(dealt.mapInArrow(shard_parts, PARTS))

    spines = parts.where(F.col("kind") == SPINE).drop("kind", "piece", "ends")
    merged = materialize(
        spines.repartition(1).sortWithinPartitions("shard", "path", "depth").mapInArrow(merge_spines, MERGED)
    )
    place = ["shard", "path", "depth"]
    pieces = parts.where(F.col("kind") == IDS).select(*place, "piece", "ends")
    in_order = pieces.join(merged.select("node", *place), place).select("node", "shard", "piece", "ends")
    hashed = (
        in_order.repartition("node").sortWithinPartitions("node", "shard", "piece")
        .select("node", "ends").mapInArrow(hash_pieces, "node long, ends_sha256 string")
    )
    names = [x.split()[0] for x in NODE.split(", ")]
    none = F.lit(hashlib.sha256(b"").hexdigest())
    on_spines = merged.dropDuplicates(["node"]).join(hashed, "node", "left").select(
        *names, F.coalesce("ends_sha256", none).alias("ends_sha256")
    )
    whole = parts.where(F.col("kind") == FINAL)
    over = merged.select("shard", "path", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("over"))
    inner = whole.join(over, place, "left").select(
        *[F.coalesce("parent_conv_id", "over").alias(n) if n == "parent_conv_id" else F.col(n) for n in names],
        F.col("ends").alias("ends_sha256"),
    )
    return on_spines.unionByName(inner)
