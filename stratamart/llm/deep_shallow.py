"""Deep-shallow ordering of many groups of byte strings at once.

Shallow: multikey quicksort whose characters are eight bytes, run over all groups side by
side: a round splits each group three ways around its middle element's word and moves the
equal part one word deeper. Deep: the groups that still agree at the shallow depth are
ordered by blind tries, which branch only where strings differ.
"""

from __future__ import annotations

import numpy as np

# Words of eight bytes that the multikey quicksort looks at.
SHALLOW = 3


def multikey_quicksort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``words`` (n, d) within their groups, and the classes of equal rows.

    ``group`` must ascend. Classes number the equal rows in order.
    """
    n, depth_end = words.shape
    order, part = np.arange(n), np.unique(group, return_inverse=True)[1].astype(np.int64)
    depth = np.zeros(n, np.int64)  # of the part a place belongs to
    while True:
        # Places whose part has several rows and words left to look at.
        sizes = np.bincount(part) if n else np.zeros(0, np.int64)
        open_ = (sizes[part] > 1) & (depth < depth_end)
        if not open_.any():
            return order, part
        starts = np.cumsum(sizes) - sizes
        middle = order[starts + sizes // 2]
        at = np.flatnonzero(open_)
        own = words[order[at], depth[at]]
        pivot = words[middle[part[at]], depth[at]]
        side = (own > pivot).astype(np.int64) - (own < pivot) + 1
        split = np.argsort(part[at] * 3 + side, kind="stable")
        side = side[split]
        order[at] = order[at][split]
        depth[at] += side == 1
        code = part * 3
        code[at] = part[at] * 3 + side
        part = np.cumsum(np.diff(code, prepend=code[0]) != 0)


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix of two strings of one length."""
    if a == b:
        return len(a)
    differ = int.from_bytes(a, "big") ^ int.from_bytes(b, "big")
    return len(a) - (differ.bit_length() + 7) // 8


def blind_trie(strings: list[bytes]) -> list[tuple[int, int]]:
    """(string number, common prefix with the one before) in order; strings differ.

    A node is [depth, {byte: child}], a leaf a string number.
    """
    root: list | int = 0
    for i, s in enumerate(strings[1:], 1):
        node = root
        while isinstance(node, list):  # blindly: any leaf below tells the place
            below = node[1]
            node = below.get(s[node[0]], next(iter(below.values())))
        depth = _common(s, strings[node])
        parent, node = None, root
        while isinstance(node, list) and node[0] < depth:
            parent, node = node, node[1][s[node[0]]]
        if isinstance(node, list) and node[0] == depth:
            node[1][s[depth]] = i
            continue
        leaf = node
        while isinstance(leaf, list):
            leaf = next(iter(leaf[1].values()))
        branch = [depth, {strings[leaf][depth]: node, s[depth]: i}]
        if parent is None:
            root = branch
        else:
            parent[1][s[parent[0]]] = branch
    out: list[tuple[int, int]] = []

    def walk(node, common: int) -> None:
        if not isinstance(node, list):
            out.append((node, common))
            return
        for k, byte in enumerate(sorted(node[1])):
            walk(node[1][byte], common if k == 0 else node[0])

    walk(root, 0)
    return out


def order_groups(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings (n, width) within ascending groups, and common prefixes.

    ``common[i]`` is the common prefix of the i-th string in order and the one before it;
    0 where a group begins.
    """
    n, width = rows.shape
    shallow = min(SHALLOW, width // 8)
    words = np.ascontiguousarray(rows[:, :8 * shallow]).view(">u8").astype(np.uint64)
    order, part = multikey_quicksort(words, group)
    common = np.zeros(n, np.int64)
    if n < 2:
        return order, common
    # Between classes: first differing byte of the shallow part, inside a group.
    same_group = group[order[1:]] == group[order[:-1]]
    head = rows[order, :8 * shallow]
    differs = head[1:] != head[:-1]
    lcp = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    common[1:] = np.where(same_group, lcp, 0)
    # Inside classes of equal shallow parts: deep.
    sizes = np.bincount(part)
    starts = np.cumsum(sizes) - sizes
    for k in np.flatnonzero(sizes > 1):
        low = starts[k]
        mine = order[low:low + sizes[k]]
        strings: dict[bytes, list[int]] = {}
        for i, s in zip(mine, map(bytes, rows[mine])):
            strings.setdefault(s, []).append(i)
        if len(strings) == 1:
            continue  # all equal: order and common prefixes stand
        keys = list(strings)
        at = low
        for place, (number, shared) in enumerate(blind_trie(keys)):
            held = strings[keys[number]]
            order[at:at + len(held)] = held
            common[at + 1:at + len(held)] = width
            if place:
                common[at] = shared
            at += len(held)
    return order, common
