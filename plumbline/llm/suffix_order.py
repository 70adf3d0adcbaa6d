"""Deep-shallow sorting of byte strings, with the common prefixes of neighbours.

Shallow: a multikey quicksort. All strings that still share their beginning are told apart by
the next eight bytes; strings that are alone leave. It runs over all groups of equal beginning at
once, one level of bytes per pass, down to `SHALLOW` bytes. Deep: each group left, whose strings
share a long prefix, is ordered by a blind trie, which branches only where strings differ and
finds the place of a new string by one comparison.
"""

from __future__ import annotations

import numpy as np

#: Bytes ordered by the multikey quicksort.
SHALLOW = 32


class BlindTrie:
    """A trie that keeps branching depths and bytes only; texts are rows of equal width."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.width = len(texts[0])
        self.root: list = [self.width, None, [0]]  # depth, children by byte, leaves

    def _difference(self, a: bytes, b: bytes) -> int:
        """First place where two rows differ, by halving."""
        if a == b:
            return self.width
        low, high = 0, self.width
        while high - low > 1:
            middle = (low + high) // 2
            if a[low:middle] == b[low:middle]:
                low = middle
            else:
                high = middle
        return low

    def add(self, i: int) -> None:
        text, node = self.texts[i], self.root
        # Blind descent: bytes between branchings are not looked at.
        while node[1] is not None:
            node = node[1].get(text[node[0]]) or next(iter(node[1].values()))
        depth = self._difference(text, self.texts[node[2][0]])
        if depth == self.width:
            node[2].append(i)
            return
        other = self.texts[node[2][0]][depth]
        node = self.root
        while node[1] is not None and node[0] < depth:
            node = node[1][text[node[0]]]
        leaf = [self.width, None, [i]]
        if node[1] is not None and node[0] == depth:
            node[1][text[depth]] = leaf
        else:
            node[:] = [depth, {other: list(node), text[depth]: leaf}, None]

    def order(self) -> tuple[list[int], list[int]]:
        """Rows in order and the common prefix of each with the one before it (0 for the first)."""
        rows, common, stack = [], [], [(self.root, 0)]
        while stack:
            (depth, children, leaves), shared = stack.pop()
            if children is None:
                rows += leaves
                common += [shared] + [self.width] * (len(leaves) - 1)
                continue
            parts = sorted(children.items())
            # Pushed last to first; the first inherits what the node shares with what came before.
            for place in range(len(parts) - 1, -1, -1):
                stack.append((parts[place][1], depth if place else shared))
        return rows, common


def deep_shallow(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a matrix of bytes, and the common prefix of each row with the one before it."""
    count, width = rows.shape
    order = np.arange(count)
    common = np.zeros(count, np.int64)
    words = -(-width // 8)
    padded = np.zeros((count, words * 8), np.uint8)
    padded[:, :width] = rows
    keys = padded.view(">u8").astype(np.uint64)
    # Segments of `order` whose rows agree so far, by their first place; `open_` lists their places.
    open_ = np.arange(count)
    segment = np.zeros(count, np.int64)
    shallow = min(words, SHALLOW // 8)
    for word in range(shallow):
        if not len(open_):
            break
        mine = keys[order[open_], word]
        sorted_ = np.lexsort((mine, segment))
        order[open_] = order[open_][sorted_]
        mine = mine[sorted_]
        # `segment` is constant on each stretch of places, so sorting keeps it.
        new = np.ones(len(open_), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (mine[1:] != mine[:-1])
        split = np.flatnonzero(new[1:] & (segment[1:] == segment[:-1])) + 1
        # Common prefix where a segment splits: whole words before, then equal leading bytes.
        differing = (mine[split] ^ mine[split - 1]).astype(">u8").view(np.uint8).reshape(-1, 8) != 0
        common[open_[split]] = np.minimum(8 * word + differing.argmax(axis=1), width)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(open_)))
        segment = np.repeat(open_[starts], sizes)
        alive = np.repeat(sizes > 1, sizes)
        open_, segment = open_[alive], segment[alive]
    if len(open_):
        done = min(8 * shallow, width)
        starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(open_)), strict=True):
            places = open_[a:b]
            group = order[places]
            trie = BlindTrie([row.tobytes() for row in rows[group, done:]]) if done < width else None
            if trie is None:
                common[places[1:]] = width
                continue
            for i in range(1, len(group)):
                trie.add(i)
            found, shared = trie.order()
            order[places] = group[found]
            common[places[1:]] = np.array(shared[1:], np.int64) + done
    return order, common
