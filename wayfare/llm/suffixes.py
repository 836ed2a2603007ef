"""Sorting strings deep and shallow: multikey quicksort to a shallow depth, blind tries below it."""

from __future__ import annotations

#: Bytes that the quicksort looks at; strings equal so far go to a blind trie.
SHALLOW, CHUNK = 64, 8


def common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class _Node:
    __slots__ = ("at", "kids", "some")

    def __init__(self, at: int, kids: dict, some: int):
        self.at, self.kids, self.some = at, kids, some


def blind_order(items: list[bytes], ids: list[int]) -> list[int]:
    """``ids`` by the strings they name.  A node holds a branching place and one child
    per byte there; a descent looks at those places only, and one comparison with the
    leaf that it reaches tells where the string belongs.  Equal strings share a leaf."""
    byte = lambda i, at: items[i][at] if at < len(items[i]) else -1
    root: _Node | list[int] = [ids[0]]
    for i in ids[1:]:
        node = root
        while isinstance(node, _Node):
            node = node.kids.get(byte(i, node.at)) or node.kids[next(iter(node.kids))]
        other = node[0]
        same = common(items[i], items[other])
        if same == len(items[i]) == len(items[other]):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, _Node) and node.at < same:
            above, node = (node, byte(i, node.at)), node.kids[byte(i, node.at)]
        if isinstance(node, _Node) and node.at == same:
            node.kids[byte(i, same)] = [i]
            continue
        made = _Node(same, {byte(i, same): [i], byte(other, same): node}, i)
        if above:
            above[0].kids[above[1]] = made
        else:
            root = made
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack += [node.kids[b] for b in sorted(node.kids, reverse=True)]
        else:
            out += node
    return out


def sorted_order(items: list[bytes]) -> list[int]:
    """Places of ``items`` in ascending order."""
    out: list[int] = []
    stack = [(list(range(len(items))), 0)]
    while stack:
        ids, depth = stack.pop()
        if len(ids) < 2:
            out += ids
        elif depth >= SHALLOW:
            out += blind_order(items, ids)
        else:
            pivot = items[ids[len(ids) // 2]][depth : depth + CHUNK]
            less, same, more = [], [], []
            for i in ids:
                key = items[i][depth : depth + CHUNK]
                (same if key == pivot else less if key < pivot else more).append(i)
            stack.append((more, depth))
            stack.append((same, depth + CHUNK if len(pivot) == CHUNK else SHALLOW))
            stack.append((less, depth))
    return out
