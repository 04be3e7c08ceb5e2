"""Operator 12: the prefix trie of conversations, built as adaptive radix trees over turn ids.

1. A turn's id is 20 bytes, big-endian: 16 of the SHA-256 of its role and text, and the number of code points of its text.
   Texts are read once and never shuffled. (Two of n turns share an id with a chance of about n * n / 2**129.)
2. A conversation's key is its turns' ids in order: one row of 20 bytes a turn.
3. Keys are ordered by a range partitioning on (key, conversation); conversations of equal keys come together as
   runs of ids, so that a key of very many conversations is a few rows. A second range partitioning on the keys deals them into parts.
4. Each part's keys go into an adaptive radix tree (``art``), which is then walked bottom-up. Paths are bytes, and only
   depths that are a whole number of turns are nodes of the trie; a compressed path gives one for each turn in it.
5. A trie node whose conversations all lie in one part is complete there. The others stand on the path that two
   neighbouring parts share: they come as partial counts, told apart by a digest of their path, and are added up. A node
   shared with an earlier part is no new child, and adds no new text, in the later one; a last key that the next
   part extends is no leaf.

Saved code points of a subtree are kept as two sums, of (conversations x code points) and of code points over its
nodes: the difference is the sum of (conversations - 1) x code points, and both can be added up over parts.

Defined results: turns stand by turn number (null first), then role (null as empty), then id. Rows
without conversation id belong to no conversation. Repeated rows are turns of their own. Null or empty roles and texts are
equal. An empty table gives an empty result; a conversation without turns is a member of the root only. Extra columns of
any name are ignored. Keys (20 bytes a turn) are held whole: one conversation is worked on in one task, its texts are not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .art import Tree, common
from .batches import default_parallelism
from .storage import Scratch

TURN_BYTES = 20
CHUNK = 8192         # conversation ids of a chunk of equal keys
PART_KEYS = 100_000  # keys of a part, on average
LEFT, RIGHT = 1, 2
_NONE = hashlib.sha256().hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    """20 bytes as hex digits, so that ids can be joined as strings."""
    role, text = (F.coalesce(c, F.lit("")) for c in (role, text))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.concat(F.substring(digest, 1, 32), F.lpad(F.lower(F.hex(F.char_length(text))), 8, "0"))


def conversation_keys(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, key): the turns of each conversation, ``TURN_BYTES`` bytes each, in order."""
    order = [F.col(turn_col).isNotNull().alias("known"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role")]
    rows = turns.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.struct(*order, turn_id(F.col(role_col), F.col(text_col)).alias("turn_id")).alias("t"))
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return own.select("conv_id", F.unhex(F.array_join("turns.turn_id", "")).alias("key"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, first, n, ids) from rows sorted by key and id: decimal ids, comma-joined, at most ``CHUNK`` in a row."""
    names = ["key", "first", "n", "ids"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    key, ids = None, []
    for batch in batches:
        rows = []
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (k != key or len(ids) >= CHUNK):
                rows.append((key, ids[0], len(ids), ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(c)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names)
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((key, ids[0], len(ids), ",".join(map(str, ids))), kinds)], names)


class _End:
    """The conversations of one key."""

    __slots__ = ("key", "n", "first", "sha")

    def __init__(self, key: bytes):
        self.key, self.n, self.first, self.sha = key, 0, None, hashlib.sha256()

    def add(self, first: int, n: int, ids: str) -> None:
        """Chunks come in ascending order of ids."""
        self.sha.update(("," if self.n else "").encode() + ids.encode())
        self.first = first if self.first is None else self.first
        self.n += n


# (shared, node, parent): digests of the paths that parts share; else null
_ROW = [("node", pa.binary()), ("parent", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("spent", pa.int64()), ("distinct", pa.int64()), ("ends_sha256", pa.string())]


class _Walk:
    """The trie nodes of one part's tree."""

    def __init__(self, tree: Tree, first: bytes, last: bytes, before: int, after: int):
        """``before``, ``after``: turns that the first and last key share with the neighbouring parts; -1: no such part."""
        self.before, self.after, self.last = before, after, last
        self.paths = {LEFT: self._digests(first, before), RIGHT: self._digests(last, after)}
        tree.mark(first, LEFT)
        tree.mark(last, RIGHT)
        self.columns: list[list] = [[] for _ in _ROW]
        self._run(tree)

    @staticmethod
    def _digests(key: bytes, turns: int) -> list[bytes]:
        """Of the paths of 0 to ``turns`` turns."""
        sha, out = hashlib.sha256(), []
        for depth in range(turns + 1):
            out.append(sha.digest()[:16])
            sha.update(key[depth * TURN_BYTES:(depth + 1) * TURN_BYTES])
        return out

    def _shared(self, mark: int, depth: int) -> bytes | None:
        for side in (LEFT, RIGHT):
            if mark & side and depth < len(self.paths[side]):
                return self.paths[side][depth]
        return None

    def _run(self, tree: Tree) -> None:
        stack, done = [(tree.root, 0, False)], []  # (node, byte depth above it, children walked)
        while stack:
            node, above, walked = stack.pop()
            if not walked:
                stack.append((node, above, True))
                down = above + len(node.prefix)
                stack += [(child, down + 1, False) for _, child in node.items()]
            else:
                below = len(node.bytes) if node.layout <= 16 else sum(1 for _ in node.items())
                parts = done[len(done) - below:]
                del done[len(done) - below:]
                done.append(self._node(node, above, parts))

    def _node(self, node, above: int, parts: list[tuple]) -> tuple:
        """(key, conversations, least id, leaves, spent, distinct, topmost rows) of the tree below ``above``, its branching byte included."""
        key, n, first, leaves, spent, distinct, tops = node.end.key if node.end else parts[0][0], 0, None, 0, 0, 0, []
        for _, k, f, l, s, d, t in parts:
            n, leaves, spent, distinct = n + k, leaves + l, spent + s, distinct + d
            first = f if first is None else min(first, f)
            tops += t
        end = node.end
        if end is not None:
            n += end.n
            first = end.first if first is None else min(first, end.first)
        down = above + len(node.prefix)
        # turn-aligned depths of this node's path: below the branching byte of its parent, or the root
        least = 0 if above == 0 else (above - 1) // TURN_BYTES + 1
        for depth in range(down // TURN_BYTES, least - 1, -1):
            at = depth * TURN_BYTES
            own = end if at == down else None
            if not tops and not (own is not None and self.after == depth and node.mark & RIGHT and len(self.last) == at):
                leaves += 1
            held = node.mark & LEFT and depth <= self.before  # the part before has this node too
            size = int.from_bytes(key[at - 4:at], "big") if depth else 0
            spent += n * size
            distinct += 0 if held else size
            new = sum(1 for t in tops if not self._held(t))
            shared = self._shared(node.mark, depth)
            row = len(self.columns[0])
            for column, value in zip(self.columns, (shared, None, first, depth, None, n, new, leaves, spent, distinct, own.sha.hexdigest() if own else None)):
                column.append(value)
            for t in tops:
                if shared is None:
                    self.columns[4][t[0]] = first
                else:
                    self.columns[1][t[0]] = shared
            tops = [(row, held)]
        return key, n, first, leaves, spent, distinct, tops

    @staticmethod
    def _held(top: tuple[int, int]) -> bool:
        return bool(top[1])

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(self.columns, _ROW)], [n for n, _ in _ROW])


def _build(edges: dict[int, tuple[int, int]]):
    """Trees of whole parts; edges: part to the turns it shares with its neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, part, first, end = Tree(), None, None, None
        for batch in batches:
            for p, key, least, n, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "first", "n", "ids"))):
                if p != part:
                    if end is not None:
                        yield _Walk(tree, first.key, end.key, *edges[part]).batch()
                    tree, part, first, end = Tree(), p, None, None
                if end is None or end.key != key:
                    end = _End(key)
                    first = first or end
                    tree.insert(key, end)
                end.add(least, n, ids)
        if end is not None:
            yield _Walk(tree, first.key, end.key, *edges[part]).batch()
    return run


def prefix_trie(keys: DataFrame) -> DataFrame:
    """The trie's nodes from (conv_id, key), a row for each conversation.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): a node is named by its least
    conversation and its depth.
    """
    spark = keys.sparkSession
    scratch = Scratch(spark, "trie")
    keys = scratch.write(keys.select("conv_id", "key"), "keys")
    parts = max(default_parallelism(spark), keys.count() // PART_KEYS)
    chunked = keys.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _chunks, "key binary, first bigint, n bigint, ids string")
    chunks = scratch.write(chunked, "chunks")
    dealt = scratch.write(chunks.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "dealt")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = [-1 if x is None or y is None else common(x, y) // TURN_BYTES for x, y in zip(batch.column("last").to_pylist(), batch.column("next").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(turns, pa.int64())], ["part", "turns"])

    ends = dealt.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("last"))  # a row for each part
    ends = ends.withColumn("next", F.lead("low").over(Window.orderBy("part"))).select("part", "last", "next")
    after = {r["part"]: r["turns"] for r in sorted(ends.mapInArrow(shared, "part int, turns bigint").collect())}  # one number for each part
    order = list(after)
    edges = {p: (after[order[i - 1]] if i else -1, after[p]) for i, p in enumerate(order)}
    schema = ", ".join(f"{n} {'binary' if t == pa.binary() else 'string' if t == pa.string() else 'bigint'}" for n, t in _ROW)
    rows = scratch.write(dealt.repartition(parts, "part").sortWithinPartitions("part", "key", "first").mapInArrow(_build(edges), schema), "rows")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent", "distinct")]
    merged = rows.filter("node IS NOT NULL").groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), *sums, F.max("ends_sha256").alias("ends_sha256"))
    merged = scratch.write(merged, "merged")
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "spent", "distinct", "ends_sha256"]
    complete = rows.filter("node IS NULL")
    # nodes below shared ones take their parent's name from the sums; very many may hang on one: the join splits them
    hung = complete.filter("parent IS NOT NULL").select("parent", *columns).unionByName(merged.select("parent", *columns))
    names = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hung = hung.join(names.hint("merge"), "parent", "left").drop("parent")
    out = complete.filter("parent IS NULL").select("parent_conv_id", *columns).unionByName(hung)
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("spent") - F.col("distinct")).alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(_NONE)).alias("ends_sha256"))
