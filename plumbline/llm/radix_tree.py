"""An adaptive radix tree: byte strings in nodes whose layout follows their number of children."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from typing import Any

#: Children that a node holds in each of its layouts.
FEW, SOME, MANY, ALL = 4, 16, 48, 256


class Sorted:
    """Up to `room` children beside a sorted list of their bytes."""

    __slots__ = ("keys", "nodes", "room")

    def __init__(self, room: int):
        self.room, self.keys, self.nodes = room, bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.room == FEW:
            place = self.keys.find(byte)
            return self.nodes[place] if place >= 0 else None
        place = bisect_left(self.keys, byte)
        return self.nodes[place] if place < len(self.keys) and self.keys[place] == byte else None

    def put(self, byte: int, node: Node) -> Sorted | Indexed:
        if len(self.nodes) == self.room:
            return _grown(self, Sorted(SOME) if self.room == FEW else Indexed()).put(byte, node)
        place = bisect_left(self.keys, byte)
        self.keys.insert(place, byte)
        self.nodes.insert(place, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.keys, self.nodes, strict=True)


class Indexed:
    """Up to 48 children, found by a table of 256 places."""

    __slots__ = ("nodes", "places")

    def __init__(self):
        self.places, self.nodes = bytearray(ALL), []

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node) -> Indexed | Direct:
        if len(self.nodes) == MANY:
            return _grown(self, Direct()).put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, self.nodes[place - 1]) for byte, place in enumerate(self.places) if place)


class Direct:
    """A place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes: list[Node | None] = [None] * ALL

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Direct:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


def _grown(old, new):
    for byte, node in old.items():
        new.put(byte, node)
    return new


class Node:
    """The bytes that lead to a node past its parent's branch, its value, and its children."""

    __slots__ = ("prefix", "value", "children")

    def __init__(self, prefix: bytes, value: Any = None):
        self.prefix, self.value, self.children = prefix, value, None

    def put(self, byte: int, node: Node) -> None:
        self.children = (self.children or Sorted(FEW)).put(byte, node)

    def split(self, length: int) -> None:
        """Keep the first bytes of the prefix; the rest, with all the node had, becomes its only child."""
        lower = Node(self.prefix[length + 1 :], self.value)
        lower.children = self.children
        byte, self.prefix, self.value, self.children = self.prefix[length], self.prefix[:length], None, None
        self.put(byte, lower)


def _agree(key: bytes, at: int, prefix: bytes) -> int:
    if key.startswith(prefix, at):
        return len(prefix)
    length = 0
    for a, b in zip(key[at : at + len(prefix)], prefix, strict=False):
        if a != b:
            break
        length += 1
    return length


def insert(root: Node, key: bytes, value: Any) -> None:
    """Give a key its value; an earlier value of the same key is replaced."""
    node, at = root, 0
    while True:
        length = _agree(key, at, node.prefix)
        if length < len(node.prefix):
            node.split(length)
        at += length
        if at == len(key):
            node.value = value
            return
        child = node.children.get(key[at]) if node.children else None
        if child is None:
            node.put(key[at], Node(key[at + 1 :], value))
            return
        node, at = child, at + 1


def preorder(root: Node) -> list[tuple[Node, int, int, int]]:
    """Nodes, parents first: (node, place of its parent or -1, byte depth of the parent's end, of its own)."""
    found = [(root, -1, 0, len(root.prefix))]
    for place, (node, _, _, end) in enumerate(found):
        if node.children:
            found += [(child, place, end, end + 1 + len(child.prefix)) for _, child in node.children.items()]
    return found
