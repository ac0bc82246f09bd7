"""A compressed radix trie over byte strings whose terminals own the smallest identifier."""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix


class Node:
    __slots__ = ("children", "count", "keep", "label", "tag")

    def __init__(self, label: bytes):
        self.label = label  # bytes on the edge that leads here
        self.children: dict[int, Node] = {}
        self.count = 0  # rows that end here; 0: not a terminal
        self.keep = None
        self.tag = None


class RadixTrie:
    def __init__(self):
        self.root = Node(b"")
        self.held = 0  # bytes on edges

    def insert(self, text: bytes, keep, count: int = 1, tag=None) -> None:
        """Add ``count`` rows of ``text``; its terminal keeps the smallest identifier, None only if all are None."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.held += len(child.label)
                node, at = child, len(text)
            elif text.startswith(child.label, at):
                node, at = child, at + len(child.label)
            else:
                shared = len(commonprefix((child.label, text[at : at + len(child.label)])))
                middle = node.children[text[at]] = Node(child.label[:shared])
                child.label = child.label[shared:]
                middle.children[child.label[0]] = child
                node, at = middle, at + shared
        node.count += count
        node.tag = tag if node.tag is None else node.tag
        if keep is not None and (node.keep is None or keep < node.keep):
            node.keep = keep

    def terminals(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, Node]]:
        """Every stored string with its terminal, in byte order."""
        stack = [(node or self.root, prefix)]
        while stack:
            node, prefix = stack.pop()
            whole = prefix + node.label
            if node.count:
                yield whole, node
            stack.extend((node.children[b], whole) for b in sorted(node.children, reverse=True))

    def spill(self) -> Iterator[tuple[bytes, Node]]:
        """Give up the subtrees below the root one after the other, until the trie is empty."""
        if self.root.count:
            yield b"", self.root
        while self.root.children:
            _, child = self.root.children.popitem()
            yield from self.terminals(child)
        self.root, self.held = Node(b""), 0
