"""An adaptive radix tree over byte strings: nodes grow from 4 to 16, 48 and 256 children, and a chain of bytes without
a branch is one node's prefix."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix

LAYOUTS = (4, 16, 48, 256)


class Node:
    """``value`` belongs to the string that ends with the prefix. Up to 16 children are a sorted list of bytes beside a
    list of nodes, up to 48 a table of 256 places into such a list, beyond that a table of 256 nodes."""

    __slots__ = ("children", "keys", "layout", "prefix", "value")

    def __init__(self, prefix: bytes, value: object = None):
        self.prefix, self.value = prefix, value
        self.layout, self.keys, self.children = 4, bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout == 256:
            return self.children[byte]
        if self.layout == 48:
            return self.children[self.keys[byte] - 1] if self.keys[byte] else None
        at = bisect_left(self.keys, byte)
        return self.children[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, node: Node) -> None:
        """Add a child, or replace the one that has the byte."""
        if self.layout == 256:
            self.children[byte] = node
        elif self.layout == 48:
            if self.keys[byte]:
                self.children[self.keys[byte] - 1] = node
            elif len(self.children) == 48:
                self._grow()
                self.put(byte, node)
            else:
                self.children.append(node)
                self.keys[byte] = len(self.children)
        else:
            at = bisect_left(self.keys, byte)
            if at < len(self.keys) and self.keys[at] == byte:
                self.children[at] = node
            elif len(self.keys) == self.layout:
                self._grow()
                self.put(byte, node)
            else:
                self.keys.insert(at, byte)
                self.children.insert(at, node)

    def _grow(self) -> None:
        pairs = list(self.pairs())
        self.layout = LAYOUTS[LAYOUTS.index(self.layout) + 1]
        if self.layout == 48:
            self.keys, self.children = bytearray(256), []
        elif self.layout == 256:
            self.keys, self.children = bytearray(), [None] * 256
        else:
            return
        for byte, node in pairs:
            self.put(byte, node)

    def pairs(self) -> Iterator[tuple[int, Node]]:
        """Bytes and children, by byte."""
        if self.layout == 256:
            yield from ((b, n) for b, n in enumerate(self.children) if n)
        elif self.layout == 48:
            yield from ((b, self.children[k - 1]) for b, k in enumerate(self.keys) if k)
        else:
            yield from zip(self.keys, self.children)


def insert(root: Node, key: bytes, value: object) -> None:
    """Put a string into the tree; the root's prefix is empty."""
    node, at = root, 0
    while True:
        if at == len(key):
            node.value = value
            return
        byte = key[at]
        below = node.child(byte)
        if below is None:
            node.put(byte, Node(key[at + 1 :], value))
            return
        rest = key[at + 1 : at + 1 + len(below.prefix)]
        if rest != below.prefix:
            shared = len(commonprefix([rest, below.prefix]))
            fork = Node(below.prefix[:shared])
            fork.put(below.prefix[shared], below)
            below.prefix = below.prefix[shared + 1 :]
            node.put(byte, fork)
            below = fork
        node, at = below, at + 1 + len(below.prefix)
