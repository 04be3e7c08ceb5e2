"""An adaptive radix tree over byte strings: node layouts of 4, 16, 48 and 256 children, and compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Node:
    """``prefix``: the bytes of a path without branches; ``end``: what is held for the key that ends after it.

    Layouts: up to 4 and up to 16 children as sorted bytes with children in parallel; up to 48 as an index of 256 bytes
    into the children; beyond that a child for each byte.
    """

    __slots__ = ("prefix", "end", "layout", "bytes", "children", "mark")

    def __init__(self, prefix: bytes, end=None):
        self.prefix, self.end, self.mark = prefix, end, 0
        self.layout, self.bytes, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout == 256:
            return self.children[byte]
        if self.layout == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        at = self.bytes.find(byte)
        return self.children[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> None:
        """Adds or replaces the child of ``byte``; a full layout grows."""
        if self.layout <= 16:
            at = bisect_left(self.bytes, byte)
            if at < len(self.bytes) and self.bytes[at] == byte:
                self.children[at] = node
                return
            if len(self.children) < self.layout:
                self.bytes.insert(at, byte)
                self.children.insert(at, node)
                return
            self._grow()
            self.put(byte, node)
        elif self.layout == 48:
            at = self.bytes[byte]
            if at:
                self.children[at - 1] = node
            elif len(self.children) < 48:
                self.children.append(node)
                self.bytes[byte] = len(self.children)
            else:
                self._grow()
                self.put(byte, node)
        else:
            self.children[byte] = node

    def _grow(self) -> None:
        if self.layout == 4:
            self.layout = 16
            return
        held = list(self.items())
        if self.layout == 16:
            self.layout, self.bytes, self.children = 48, bytearray(256), []
        else:
            self.layout, self.bytes, self.children = 256, bytearray(), [None] * 256
        for byte, node in held:
            self.put(byte, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        """(byte, child), ascending."""
        if self.layout <= 16:
            yield from zip(self.bytes, self.children)
        elif self.layout == 48:
            yield from ((b, self.children[at - 1]) for b, at in enumerate(self.bytes) if at)
        else:
            yield from ((b, node) for b, node in enumerate(self.children) if node is not None)


class Tree:
    """Keys of any length, also such as begin with one another."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, end) -> None:
        """Holds ``end`` (not None) for ``key``; a key comes once."""
        node, at, above, byte = self.root, 0, None, 0
        while True:
            prefix = node.prefix
            if not key.startswith(prefix, at):  # the path parts within the prefix
                same = common(prefix, key, at)
                top = Node(prefix[:same])
                node.prefix = prefix[same + 1:]
                top.put(prefix[same], node)
                top = self._hang(above, byte, top)
                at += same
                if at == len(key):
                    top.end = end
                else:
                    top.put(key[at], Node(key[at + 1:], end))
                return
            at += len(prefix)
            if at == len(key):
                node.end = end
                return
            above, byte = node, key[at]
            below = node.child(byte)
            if below is None:
                node.put(byte, Node(key[at + 1:], end))
                return
            node, at = below, at + 1

    def _hang(self, above: Node | None, byte: int, node: Node) -> Node:
        if above is None:
            self.root = node
        else:
            above.put(byte, node)
        return node

    def mark(self, key: bytes, bit: int) -> None:
        """Sets ``bit`` on the nodes along ``key``, which the tree holds."""
        node, at = self.root, 0
        while True:
            node.mark |= bit
            at += len(node.prefix)
            if at >= len(key):
                return
            node, at = node.child(key[at]), at + 1


def common(prefix: bytes, key: bytes, at: int = 0) -> int:
    """How many bytes of ``prefix`` stand in ``key`` at ``at``."""
    low, high = 0, min(len(prefix), len(key) - at)
    if key.startswith(prefix[:high], at):
        return high
    while high - low > 1:  # the first ``low`` bytes agree, the first ``high`` do not
        half = (low + high) // 2
        if key.startswith(prefix[low:half], at + low):
            low = half
        else:
            high = half
    return low
