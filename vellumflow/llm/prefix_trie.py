"""Prefix trie of conversations: which first turns are shared, and how much text sharing saves.

A turn becomes an id of ``WIDTH`` bytes, the UTF-8 length of its text as a big-endian number and the
first bits of a digest of role and text. A conversation is the string of its turns' ids, its key.
Keys are dealt over tasks in ranges of their order; each task puts its range into an adaptive
radix tree over single bytes: nodes of 4, 16, 48 and 256 places that grow when they are full, and
paths without branches kept as one piece. Only depths that are whole turns give nodes of the
result; branches inside an id are passed upwards.

A node that both neighbours of a range border share is *open*: it lies on the path of a range's
first or last key. All others are complete within their task, with all sums over their subtree.
Open nodes, at most two paths per task, are merged by their digest in Spark: counts are added, the
part of a subtree that lies in tasks is added once per path, and the open part of it as sums from
the bottom of each path upwards, every open node counted on one path only.

However many conversations share their first turns, or all turns, ranges stay even: conversations
with equal keys become one key first, with its ids as pieces of text in ascending order, which are
digested one after the other.

Results for odd input. Turns of a conversation are ordered by turn, null first; of equal turns by id, so
repeated rows stay in place. Null role or text is empty. Rows without conv_id belong to no conversation and are
left out. An empty table gives no nodes. A conversation's ids must fit a task, ``WIDTH`` bytes a turn; texts stay
out of all shuffles. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from vellumflow.llm.tables import Tables
from vellumflow.operators.joins import lookup

# Executors need not have this package: the task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a turn id, of them for the length of the text.
WIDTH, LENGTH = 16, 4
#: Turns of one range of keys, on average.
RANGE_TURNS = 100_000
#: Characters of one piece of a list of ids.
PIECE = 1 << 16
#: Rows of one Arrow batch of nodes.
BATCH = 1 << 13


# --- turns and keys ---------------------------------------------------------------------------


def turn_id(role: str = "role", text: str = "text") -> Column:
    """The id of a turn as hexadecimal digits, which sort like the bytes."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    size = F.lpad(F.hex(F.octet_length(t).cast("long")), 2 * LENGTH, "0")
    return F.upper(F.concat(size, F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256), 1, 2 * (WIDTH - LENGTH))))


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, ids): the turn ids of each conversation in order."""
    rows = turns.where(F.col(conv).isNotNull()).select(F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), turn_id(role, text).alias("id")).alias("at"))
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list("at")).alias("at")).select("conv", F.transform("at", lambda a: a["id"]).alias("ids"))


def keyed(sequences: DataFrame) -> DataFrame:
    """(conv, key): the ids of each sequence as one string of bytes."""
    return sequences.select("conv", F.unhex(F.array_join("ids", "")).alias("key"))


def _one_key_each(keys: DataFrame, tables: Tables) -> DataFrame:
    """(key, first, n, piece) rows: the conversations of equal keys as pieces of text, ids ascending."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size, out, room = None, None, [], 0, [], 0
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = str(c)
                if ids and (k != key or size > PIECE):
                    out.append((key, first, len(ids), ",".join(ids)))
                    room += len(key) + size
                    ids, size = [], 0
                    if len(out) >= BATCH or room > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)
                        out, room = [], 0
                if not ids:
                    key, first = k, c
                ids.append(text)
                size += len(text) + 1
        if ids:
            out.append((key, first, len(ids), ",".join(ids)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    names, types = ["key", "first", "n", "piece"], [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    # By both columns: a key with very many conversations is cut between tasks.
    ranged = keys.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    return tables.keep(ranged.mapInArrow(task, "key binary, first long, n long, piece string"), "keys")


# --- the tree ---------------------------------------------------------------------------------------


class Node:
    """A node of an adaptive radix tree: a piece of path, up to 256 children by their next byte, and what ends here.

    Up to 4 and up to 16 children lie beside their sorted bytes; up to 48 are found through 256 places of
    one byte; more have a place each.
    """

    __slots__ = ("path", "sample", "end", "keys", "kids")

    def __init__(self, path: bytes, sample: bytes, end: tuple | None = None):
        self.path, self.sample, self.end = path, sample, end
        self.keys: bytearray | None = bytearray()
        self.kids: list = []

    @property
    def layout(self) -> int:
        """How many children have room."""
        if self.keys is None:
            return 256
        if len(self.keys) == 256:
            return 48
        return 4 if len(self.kids) <= 4 else 16

    def find(self, byte: int) -> Node | None:
        if self.keys is None:
            return self.kids[byte]
        if len(self.keys) == 256:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, child: Node) -> None:
        """Set the child of a byte; a full layout grows to the next."""
        if self.keys is None:
            self.kids[byte] = child
        elif len(self.keys) == 256:
            if self.keys[byte]:
                self.kids[self.keys[byte] - 1] = child
            elif len(self.kids) < 48:
                self.kids.append(child)
                self.keys[byte] = len(self.kids)
            else:
                places: list = [None] * 256
                for b, at in enumerate(self.keys):
                    if at:
                        places[b] = self.kids[at - 1]
                places[byte] = child
                self.keys, self.kids = None, places
        else:
            at = self.keys.find(byte)
            if at >= 0:
                self.kids[at] = child
            elif len(self.kids) < 16:
                at = sum(b < byte for b in self.keys)
                self.keys.insert(at, byte)
                self.kids.insert(at, child)
            else:
                places = bytearray(256)
                for k, b in enumerate(self.keys):
                    places[b] = k + 1
                self.keys = places
                self.put(byte, child)

    def children(self) -> Iterator[Node]:
        """Children by ascending byte."""
        if self.keys is None:
            yield from (k for k in self.kids if k is not None)
        elif len(self.keys) == 256:
            yield from (self.kids[at - 1] for at in self.keys if at)
        else:
            yield from self.kids


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def insert(root: Node, key: bytes, end: tuple) -> None:
    """Put a key with what ends there into the tree."""
    node, at = root, 0
    while True:
        if at == len(key):
            node.end = end
            return
        child = node.find(key[at])
        if child is None:
            node.put(key[at], Node(key[at:], key, end))
            return
        same = common(child.path, key[at : at + len(child.path)])
        if same < len(child.path):
            # The path branches, or the key ends, inside the piece: cut it there.
            upper = Node(child.path[:same], child.sample)
            child.path = child.path[same:]
            upper.put(child.path[0], child)
            node.put(key[at], upper)
            child = upper
        node, at = child, at + same


class Below:
    """What lies below a place of the tree: conversations, sums of the nodes, and the topmost of them."""

    __slots__ = ("n", "conv", "leaves", "saved", "tops")

    def __init__(self, end: tuple | None):
        self.n, self.conv = (end[1], end[0]) if end else (0, None)
        self.leaves = self.saved = 0
        self.tops: list = []

    def add(self, other: Below) -> None:
        self.n += other.n
        self.conv = other.conv if self.conv is None else min(self.conv, other.conv)
        self.leaves += other.leaves
        self.saved += other.saved
        if len(other.tops) > len(self.tops):
            self.tops, other.tops = other.tops, self.tops
        self.tops += other.tops


def _path_digests(key: bytes) -> list[bytes]:
    """A digest of every prefix of whole turns, the empty one first."""
    h = hashlib.sha256(b"")
    out = [h.digest()[:16]]
    for at in range(0, len(key), WIDTH):
        h.update(key[at : at + WIDTH])
        out.append(h.copy().digest()[:16])
    return out


NODE = (
    "path string, digest binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string, last_bytes long"
)
NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]
NODE_TYPES = [pa.string(), pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.int64()]


def _nodes_of(root: Node, first: bytes, last: bytes, none: str) -> Iterator[list]:
    """The result's nodes of one task, as rows of ``NODE``; rows with a path are open.

    For open rows n_leaves and saved_tokens count what is complete below them, n_children their complete children.
    """
    paths = {"F": (first, _path_digests(first)), "L": (last, _path_digests(last))}
    names = {p: hashlib.sha256(key + p.encode()).hexdigest()[:32] for p, (key, _) in paths.items()}

    def close(node: Node, start: int, below: Below) -> Iterator[list]:
        """Rows of the whole turns that end inside the node's piece, deepest first; ``start`` is where it begins."""
        end = start + len(node.path)
        shared = [common(node.sample, first), common(node.sample, last)]
        depths = range(end // WIDTH, start // WIDTH, -1) if node is not root else (0,)
        for d in depths:
            p = d * WIDTH
            size = int.from_bytes(node.sample[p - WIDTH : p - WIDTH + LENGTH]) if d else 0
            ends = node.end[2] if node.end and p == end else none
            if p > max(shared):
                kids = len(below.tops)
                leaves = below.leaves if kids else 1
                saved = below.saved + (below.n - 1) * size
                row = [None, None, None, below.conv, d, None, below.n, kids, leaves, saved, ends, size]
                for top in below.tops:
                    top[5] = below.conv
                    yield top
                below.leaves, below.saved, below.tops = leaves, saved, [row]
            else:
                # Open: complete children get their parent's digest, sums below are handed to the merge.
                on = [k for k, s in zip("FL", shared) if p <= s]
                digest = paths[on[0]][1][d]
                for top in below.tops:
                    top[2] = digest
                    yield top
                for k in on:
                    one = k == on[0]
                    parent = paths[k][1][d - 1] if d else None
                    sums = (below.conv, below.n, len(below.tops), below.leaves, below.saved, ends if one else none)
                    conv, n, kids, leaves, saved, sha = sums if one else (below.conv, 0, 0, 0, 0, none)
                    yield [names[k], digest, parent, conv, d, None, n, kids, leaves, saved, sha, size]
                below.leaves, below.saved, below.tops = 0, 0, []

    # Depth first without recursion: a conversation may have any number of turns.
    stack = [(root, 0, root.children(), Below(root.end))]
    while stack:
        node, start, rest, below = stack[-1]
        child = next(rest, None)
        if child is not None:
            stack.append((child, start + len(node.path), child.children(), Below(child.end)))
            continue
        stack.pop()
        yield from close(node, start, below)
        if stack:
            stack[-1][3].add(below)


def _digest_of_nothing() -> str:
    return hashlib.sha256(b"").hexdigest()


def _trees(pieces: DataFrame, ranges: int) -> DataFrame:
    """The nodes of each range of keys."""
    none = _digest_of_nothing()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, first, last, state, held = None, None, None, None, None
        for batch in batches:
            for key, conv, n, piece in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if root is None:
                    root, first = Node(b"", key), key
                if key == last:
                    state.update(b",")
                    held = (held[0], held[1] + n)
                else:
                    if last is not None:
                        insert(root, last, (*held, state.hexdigest()))
                    last, state, held = key, hashlib.sha256(), (conv, n)
                state.update(piece.encode())
        if root is None:
            return
        insert(root, last, (*held, state.hexdigest()))
        rows: list = []
        for row in _nodes_of(root, first, last, none):
            rows.append(row)
            if len(rows) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), NODE_TYPES)], names=NODE_NAMES)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), NODE_TYPES)], names=NODE_NAMES)

    # By the key alone: all pieces of one key come to one task, one after the other.
    return pieces.repartitionByRange(ranges, "key").sortWithinPartitions("key", "first").mapInArrow(task, NODE)


# --- nodes that ranges share ----------------------------------------------------------------------------


def _merged(open_rows: DataFrame, tables: Tables) -> DataFrame:
    """Open nodes with their sums over the whole tree; one row per digest."""
    none = _digest_of_nothing()
    by_digest = open_rows.groupBy("digest").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("closed_children"), F.sum("n_leaves").alias("closed_leaves"), F.sum("saved_tokens").alias("closed_saved"),
        # At most one task has the key that ends here.
        F.coalesce(F.max(F.when(F.col("ends_sha256") != none, F.col("ends_sha256"))), F.lit(none)).alias("ends_sha256"),
        F.first("last_bytes").alias("last_bytes"), F.min("path").alias("owner"),
    )
    kids = by_digest.where("parent IS NOT NULL").groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("open_children"))
    known = by_digest.join(kids, "digest", "left").withColumn("n_children", F.col("closed_children") + F.coalesce("open_children", F.lit(0)))
    known = tables.keep(known, "open")
    # The node itself and what is complete below it, counted on one path through it.
    own_leaves = F.col("closed_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)
    own_saved = F.col("closed_saved") + (F.col("n_convs") - 1) * F.col("last_bytes")
    on_path = open_rows.select("path", "digest").join(known.select("digest", "owner", "depth", own_leaves.alias("leaves"), own_saved.alias("saved")), "digest")
    mine = F.col("owner") == F.col("path")
    upwards = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = on_path.select("digest", *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(upwards).alias(c) for c in ("leaves", "saved")])
    whole = sums.groupBy("digest").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    return tables.keep(known.join(whole, "digest"), "merged")


def nodes(keys: DataFrame) -> DataFrame:
    """The trie of (conv, key): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256 of each node."""
    tables = Tables(keys.sparkSession)
    pieces = _one_key_each(keys, tables)
    size = pieces.agg(F.sum(F.octet_length("key")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    ranges = max(1, -(-((size["bytes"] or 0) // WIDTH + size["n"]) // RANGE_TURNS))
    found = tables.keep(_trees(pieces, ranges), "nodes")
    merged = _merged(found.where("path IS NOT NULL").drop("parent_conv_id"), tables)
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    parents = merged.select(F.col("digest").alias("parent"), F.col("conv_id").alias("open_conv"))
    closed = lookup(found.where("path IS NULL"), parents, ["parent"], spread_by="conv_id")
    closed = closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "open_conv"))
    top = merged.join(parents, "parent", "left").withColumn("parent_conv_id", F.col("open_conv"))
    return closed.select(*result).unionByName(top.select(*result))
