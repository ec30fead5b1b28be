"""Deep-shallow sorting of suffixes up to a given depth.

A multikey quicksort, whose characters are eight bytes wide and which treats all groups of a level at once, orders
suffixes by their first ``SHALLOW`` bytes. Groups that agree so far go to a blind trie each, which stores only where
strings branch, descends without comparing, and makes one full comparison per insertion.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 24


class BlindTrie:
    """Orders equally long strings. Inner nodes are [depth, {byte: node}], leaves (string, members)."""

    def __init__(self):
        self.root = None

    def insert(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = (string, [member])
            return
        node = self.root
        while type(node) is list:
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other = node[0]
        if other == string:
            node[1].append(member)
            return
        differ = int.from_bytes(other) ^ int.from_bytes(string)
        depth = len(string) - (differ.bit_length() + 7) // 8
        above, node = None, self.root
        while type(node) is list and node[0] < depth:
            above, node = node, node[1][string[node[0]]]
        leaf = (string, [member])
        if type(node) is list and node[0] == depth:
            node[1][string[depth]] = leaf
            return
        fresh = [depth, {other[depth]: node, string[depth]: leaf}]
        if above is None:
            self.root = fresh
        else:
            above[1][string[above[0]]] = fresh

    def leaves(self):
        """The members of each distinct string, in order of the strings."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
            elif node is not None:
                yield node[1]


def sort_suffixes(data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes by their first ``depth`` bytes, and for each in that order whether it opens a new string.

    ``data`` must go on for ``depth + 8`` bytes after the last start.
    """
    n = len(starts)
    order = np.arange(n)
    opens = np.zeros(n, bool)
    opens[:1] = True
    words = np.ndarray((len(data) - 7,), ">u8", buffer=np.ascontiguousarray(data), strides=(1,))
    level = 0
    live = np.arange(n)
    while level < min(shallow, depth) and len(live):
        group = np.cumsum(opens)[live]
        key = words[starts[order[live]] + level].astype(np.uint64)
        if depth - level < 8:
            key >>= np.uint64(8 * (8 - depth + level))
        by = np.lexsort((key, group))
        order[live], key = order[live[by]], key[by]
        changed = np.ones(len(live), bool)
        changed[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        opens[live] |= changed
        closes = np.concatenate([opens[1:], [True]])
        live = np.flatnonzero(~(opens & closes))
        level += 8
    if level < depth and len(live):
        raw = data.tobytes()
        heads = np.flatnonzero(opens[live])
        ends = np.concatenate([heads[1:], [len(live)]])
        places, members = live.tolist(), starts[order[live]].tolist()
        new_order, new_opens = order[live].tolist(), [False] * len(live)
        for a, b in zip(heads.tolist(), ends.tolist()):
            trie = BlindTrie()
            for i in range(a, b):
                trie.insert(raw[members[i] + level : members[i] + depth], i)
            at, was = a, new_order[a:b]
            for same in trie.leaves():
                new_opens[at] = True
                for i in same:
                    new_order[at] = was[i - a]
                    at += 1
        order[places], opens[places] = new_order, new_opens
    return order, opens
