"""An adaptive radix tree over byte strings: nodes of 4, 16, 48 or 256 places, and compressed paths.

A key may end inside the tree; a node holds the values of the keys that end at it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any


class Sorted:
    """Children by sorted edge bytes, for few of them."""

    __slots__ = ("edges", "below", "room")

    def __init__(self, room: int = 4, edges: bytearray | None = None, below: list[Node] | None = None):
        self.room, self.edges, self.below = room, edges or bytearray(), below or []

    def get(self, edge: int) -> Node | None:
        at = bisect_left(self.edges, edge)
        return self.below[at] if at < len(self.edges) and self.edges[at] == edge else None

    def put(self, edge: int, node: Node) -> Sorted | Indexed:
        """The layout that holds the new child as well: this one, or the next larger one."""
        at = bisect_left(self.edges, edge)
        if at < len(self.edges) and self.edges[at] == edge:
            self.below[at] = node
            return self
        if len(self.edges) == self.room:
            larger = Sorted(16, self.edges, self.below) if self.room == 4 else Indexed(self)
            return larger.put(edge, node)
        self.edges.insert(at, edge)
        self.below.insert(at, node)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return zip(self.edges, self.below)


class Indexed:
    """Up to 48 children, found by a table from edge byte to slot."""

    __slots__ = ("slots", "below")

    def __init__(self, smaller: Sorted):
        self.slots, self.below = bytearray(256), list(smaller.below)
        for slot, edge in enumerate(smaller.edges, 1):
            self.slots[edge] = slot

    def get(self, edge: int) -> Node | None:
        slot = self.slots[edge]
        return self.below[slot - 1] if slot else None

    def put(self, edge: int, node: Node) -> Indexed | Direct:
        slot = self.slots[edge]
        if slot:
            self.below[slot - 1] = node
            return self
        if len(self.below) == 48:
            return Direct(self).put(edge, node)
        self.below.append(node)
        self.slots[edge] = len(self.below)
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((edge, self.below[slot - 1]) for edge, slot in enumerate(self.slots) if slot)


class Direct:
    """A place for every edge byte."""

    __slots__ = ("below",)

    def __init__(self, smaller: Indexed):
        self.below: list[Node | None] = [None] * 256
        for edge, node in smaller:
            self.below[edge] = node

    def get(self, edge: int) -> Node | None:
        return self.below[edge]

    def put(self, edge: int, node: Node) -> Direct:
        self.below[edge] = node
        return self

    def __iter__(self) -> Iterator[tuple[int, Node]]:
        return ((edge, node) for edge, node in enumerate(self.below) if node is not None)


class Node:
    """`path` are the bytes between the edge that leads here and the place where the node branches or a key ends."""

    __slots__ = ("path", "children", "values", "sample", "notes")

    def __init__(self, path: bytes, sample: Any, values: list):
        self.path, self.sample, self.values = path, sample, values
        self.children: Sorted | Indexed | Direct = Sorted()
        self.notes: Any = None


def shared_length(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of `a` stand at b[start:]."""
    n = min(len(a), len(b) - start)
    if a[:n] == b[start : start + n]:
        return n
    low, high = 0, n
    while low + 1 < high:
        middle = (low + high) // 2
        if a[:middle] == b[start : start + middle]:
            low = middle
        else:
            high = middle
    return low


class Tree:
    """`sample` of a node is the value of some key below it."""

    def __init__(self) -> None:
        self.root: Node | None = None

    def insert(self, key: bytes, value: Any) -> None:
        if self.root is None:
            self.root = Node(key, value, [value])
            return
        node, at, parent, edge = self.root, 0, None, 0
        while True:
            same = shared_length(node.path, key, at)
            if same < len(node.path):
                upper = Node(node.path[:same], node.sample, [])
                upper.children = upper.children.put(node.path[same], node)
                node.path = node.path[same + 1 :]
                if parent is None:
                    self.root = upper
                else:
                    parent.children = parent.children.put(edge, upper)
                node = upper
            at += same
            if at == len(key):
                node.values.append(value)
                return
            below = node.children.get(key[at])
            if below is None:
                node.children = node.children.put(key[at], Node(key[at + 1 :], value, [value]))
                return
            parent, edge, node, at = node, key[at], below, at + 1

    def preorder(self) -> Iterator[tuple[Node, Node | None, int, int]]:
        """(node, its parent, depth in bytes before its edge, depth where it branches or ends), parents before children."""
        stack = [(self.root, None, -1, len(self.root.path))] if self.root else []
        while stack:
            node, parent, above, end = stack.pop()
            yield node, parent, above, end
            below = [(child, node, end, end + 1 + len(child.path)) for _, child in node.children]
            stack += reversed(below)
