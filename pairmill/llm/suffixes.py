"""Deep-shallow sorting of suffixes, cut at a fixed number of bytes.

Multikey quicksort brings the suffixes of all groups into order to a shallow depth: every round
splits each class three ways by its middle suffix's next eight bytes, and only the equal part goes
eight bytes deeper. What still shares the shallow prefix is ordered by a blind trie per class: a
suffix goes down by the branching bytes alone, is compared once with the leaf it comes to, and is
hung in where the two differ.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 24


def sort_suffixes(data: bytes, at: np.ndarray, group: np.ndarray, size: int,
                  shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order suffixes ``data[at:at + size]`` within their groups (ascending numbers).

    Returns the order, and for each place in it whether the suffix equals the one before. ``size``
    is eight or more.
    """
    words = _words(data)
    order = np.argsort(group, kind="stable")
    new = _changes(group[order])
    depth = np.zeros(len(at), np.int64)
    equal = np.zeros(len(at), bool)
    limit = min(shallow, size - 8)
    while True:
        bounds = np.append(np.flatnonzero(new), len(at))
        sizes = np.diff(bounds)
        busy = np.repeat((sizes > 1) & (depth[bounds[:-1]] < limit), sizes)
        if not busy.any():
            break
        part = np.flatnonzero(busy)
        own = order[part]
        key = words[at[own] + depth[part]]
        cls = np.cumsum(new[part]) - 1
        first = np.flatnonzero(new[part])
        middle = (first + np.append(first[1:], len(part))) // 2
        pivot = key[middle][cls]
        side = (key > pivot).astype(np.int64) - (key < pivot) + 1
        to = np.argsort(3 * cls + side, kind="stable")
        order[part] = own[to]
        split = _changes((3 * cls + side)[to])
        new[part] = split
        depth[part] = depth[part] + 8 * (side[to] == 1)
    for i in np.flatnonzero(sizes > 2):
        a, b = bounds[i], bounds[i + 1]
        order[a:b], equal[a:b] = _trie_order(data, at, order[a:b], int(depth[a]), size)
    # A trie of two leaves is one comparison: all of these at once.
    pairs = bounds[:-1][sizes == 2]
    if len(pairs):
        left, right, d = order[pairs], order[pairs + 1], depth[pairs]
        same, less = np.ones(len(pairs), bool), np.zeros(len(pairs), bool)
        for step in range(0, size, 8):
            place = np.minimum(d + step, size - 8)
            x, y = words[at[left] + place], words[at[right] + place]
            less |= same & (y < x)
            same &= x == y
        order[pairs] = np.where(less, right, left)
        order[pairs + 1] = np.where(less, left, right)
        equal[pairs + 1] = same
    return order, equal


def _words(data: bytes) -> np.ndarray:
    """The eight bytes from each place on, as a number in their order."""
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros(max(0, len(raw) - 7), np.uint64)
    for i in range(8):
        out |= raw[i:len(out) + i].astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def _changes(values: np.ndarray) -> np.ndarray:
    return np.append(True, values[1:] != values[:-1])[:len(values)]


class _Branch:
    """An inner node: the byte place where its suffixes differ, and the child of each byte."""

    __slots__ = ("at", "children")

    def __init__(self, at: int, children: dict):
        self.at = at
        self.children = children


def _trie_order(data: bytes, at: np.ndarray, members: np.ndarray, depth: int,
                size: int) -> tuple[list[int], list[bool]]:
    """Order of a class by a blind trie. Leaves are lists of equal suffixes, the text first."""
    root: _Branch | list | None = None
    for m in members.tolist():
        text = data[at[m] + depth:at[m] + size]
        if root is None:
            root = [text, m]
            continue
        node = root
        while isinstance(node, _Branch):
            node = node.children.get(text[node.at]) or next(iter(node.children.values()))
        seen = node[0]
        if seen == text:
            node.append(m)
            continue
        differ = int.from_bytes(seen, "big") ^ int.from_bytes(text, "big")
        place = len(text) - (differ.bit_length() + 7) // 8
        above, node = None, root
        while isinstance(node, _Branch) and node.at < place:
            above, node = node, node.children[text[node.at]]
        if isinstance(node, _Branch) and node.at == place:
            node.children[text[place]] = [text, m]
            continue
        branch = _Branch(place, {seen[place]: node, text[place]: [text, m]})
        if above is None:
            root = branch
        else:
            above.children[text[above.at]] = branch
    order: list[int] = []
    equal: list[bool] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if isinstance(node, _Branch):
            todo.extend(node.children[b] for b in sorted(node.children, reverse=True))
        else:
            order += node[1:]
            equal += [False] + [True] * (len(node) - 2)
    return order, equal
