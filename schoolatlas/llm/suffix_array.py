"""Suffix arrays by linear grouping, for many short strings at once.

Phase one keeps the suffixes of a string in groups ordered like their common Lyndon prefixes, first
by single symbols.  From the highest group down, each member finds its previous smaller suffix
by following the pointers of the groups done; the suffixes pointed at move, within their group,
behind the others, ordered by how many members of the current group point at them.  Phase two
reads the array from its front and puts, for each suffix read, the suffix before it and then
along its previous-smaller pointers the next ones at the front of their groups, until one has
its place.  No ranks are renamed and nothing recurses.

All strings of a batch take their steps together: a string is a row of a matrix, and a step is a
few array operations over the rows.
"""

from __future__ import annotations

import numpy as np

from schoolatlas.llm.common import ship

ship(__name__)


def _lyndon_groups(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per suffix: the first place of its group in the suffix array, and its previous smaller suffix (or -1)."""
    rows, width = symbols.shape
    column = np.arange(width)
    padded = column >= lengths[:, None]
    keyed = np.where(padded, np.iinfo(np.int16).max, symbols).astype(np.int16)
    order = np.argsort(keyed, axis=1, kind="stable")
    sorted_keys = np.take_along_axis(keyed, order, 1)
    new = np.ones((rows, width), bool)
    new[:, 1:] = sorted_keys[:, 1:] != sorted_keys[:, :-1]
    start = np.maximum.accumulate(np.where(new, column, 0).astype(np.int32), axis=1)
    group = np.empty((rows, width), np.int32)
    np.put_along_axis(group, order, start, 1)
    group[padded] = width + 1
    base = np.arange(rows) * width
    # sorted_by[slot] is the suffix in a slot of the array so far, slot_of its inverse, both over all rows.
    sorted_by = (order + base[:, None]).ravel()
    slot_of = np.empty(rows * width, np.int64)
    slot_of[sorted_by] = np.arange(rows * width)
    moving = np.zeros(rows * width, bool)
    # end_of[row, first place of a group] is its last place; start_at[row, last place] is the first.
    last = np.ones((rows, width), bool)
    last[:, :-1] = new[:, 1:]
    end_of = np.zeros(rows * width, np.int32)
    start_at = np.zeros(rows * width, np.int32)
    r, c = np.nonzero(last)
    end_of[r * width + start[r, c]] = c
    start_at[r * width + c] = start[r, c]
    group = group.ravel()
    previous = np.full(rows * width, -1, np.int32)
    target = start_at[base + lengths - 1].astype(np.int64)
    active = np.arange(rows)
    while len(active):
        first = base[active] + target
        sizes = end_of[first] - target + 1
        mine = np.repeat(target, sizes)
        row = np.repeat(base[active], sizes)
        at = sorted_by[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(mine))]
        now = (at - row - 1).astype(np.int32)
        previous[at] = now
        going = np.arange(len(at))
        while True:  # an equal member's pointer, if not final, is still not before the one sought
            going = going[now[going] >= 0]
            there = row[going] + now[going]
            more = group[there] >= mine[going]
            going, there = going[more], there[more]
            if not len(going):
                break
            now[going] = previous[there]
            previous[at[going]] = now[going]
        parent = (row + now)[now >= 0]
        if len(parent):
            parent.sort()
            first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
            parent, pointed = parent[first], np.diff(np.append(first, len(parent)))
            owner = parent // width * width + group[parent]  # group of the parent, over all rows
            key = owner * (width + 1) + pointed
            sort = np.argsort(key, kind="stable")
            parent, key, owner = parent[sort], key[sort], owner[sort]
            part = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            whole = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            moved = np.diff(np.append(whole, len(owner)))
            old = owner[whole]
            row_base = old // width * width
            end = end_of[old]
            rest = end - moved  # the last place of what stays
            stays = rest >= old - row_base
            end_of[old[stays]] = rest[stays]
            start_at[(row_base + rest)[stays]] = (old - row_base)[stays]
            of = np.searchsorted(whole, part, "right") - 1
            begins = rest[of] + 1 + (part - whole[of])
            size = np.diff(np.append(part, len(parent)))
            ends = begins + size - 1
            end_of[row_base[of] + begins] = ends
            start_at[row_base[of] + ends] = begins
            group[parent] = np.repeat(begins, size)
            # The moved go to the last slots of their old group, what stood there to the slots they leave.
            tail = np.repeat(row_base + rest + 1 - whole, moved) + np.arange(len(parent))
            moving[parent] = True
            stood = sorted_by[tail]
            stood = stood[~moving[stood]]
            moving[parent] = False
            left = slot_of[parent]
            left = left[left < np.repeat(row_base + rest + 1, moved)]
            sorted_by[left] = stood
            slot_of[stood] = left
            sorted_by[tail] = parent
            slot_of[parent] = tail
        on = target > 0
        active = active[on]
        target = start_at[base[active] + target[on] - 1].astype(np.int64)
    return group, previous


def suffix_arrays(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The suffix array of every row's first ``lengths`` symbols; the last of them must be the only 0 of its row."""
    rows, width = symbols.shape
    group, previous = _lyndon_groups(symbols, lengths)
    base = np.arange(rows) * width
    free = np.zeros(rows * width, np.int32)  # how many of a group have their place
    placed = np.zeros(rows * width, bool)
    out = np.zeros((rows, width), np.int32)
    flat = out.ravel()
    out[:, 0] = lengths - 1
    placed[base + lengths - 1] = True
    for i in range(int(lengths.max(initial=0))):
        open_ = np.flatnonzero(lengths > i)
        suffix, row = out[open_, i] - 1, base[open_]
        while True:
            on = suffix >= 0
            suffix, row = suffix[on], row[on]
            on = ~placed[row + suffix]
            suffix, row = suffix[on], row[on]
            if not len(suffix):
                break
            at = row + suffix
            slot = row + group[at]
            place = slot + free[slot]
            flat[place] = suffix
            free[slot] += 1
            placed[at] = True
            suffix = previous[at]
    return out
