"""Suffix arrays of one shard in numpy: Larsson-Sadakane refinement and Kasai prefixes.

A shard is the joined bytes of its segments. Suffixes end with their segment, and no
match crosses a segment's end.
"""

from __future__ import annotations

import numpy as np

# Sort keys pack two ranks and a position into 64 bits.
POSITION_BITS = 21
MAX_BYTES = 1 << POSITION_BITS
_FIRST = 4  # letters in the first sort key, nine bits each: 0 is the end


def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of all suffixes in ascending order; of equal ones the earlier segment first."""
    return refine(data, ends)[0]


def refine(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and for each place a number of letters shared with the place before.

    ``ends`` holds the end of each segment. Suffixes are sorted by their first letters,
    then, as Larsson and Sadakane do, only those still tied are sorted again, by the rank
    of the suffix that follows at the sorted depth, which doubles each time. Neighbours
    share at least as many letters as the depth at which they were still tied, and less
    than twice as many.
    """
    size = len(data)
    if size >= MAX_BYTES:
        raise ValueError("a shard must be below 2 MB")
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(size)
    lengths = np.diff(ends, prepend=0)
    segment = np.repeat(np.arange(len(ends), dtype=np.int32), lengths)
    left = (np.repeat(ends, lengths) - at).astype(np.int32)  # letters up to the segment's end
    key = np.zeros(size, np.uint64)
    letter = data.astype(np.uint64) + np.uint64(1)
    for k in range(_FIRST):
        key <<= np.uint64(9)
        key[:max(0, size - k)] |= np.where(left[:max(0, size - k)] > k, letter[k:], np.uint64(0))
    key <<= np.uint64(POSITION_BITS)
    key |= at.view(np.uint64)
    key.sort()
    order = (key & np.uint64(MAX_BYTES - 1)).view(np.int64)
    key >>= np.uint64(POSITION_BITS)
    head = np.ones(size, bool)
    head[1:] = key[1:] != key[:-1]
    rank = np.empty(size, np.int32)
    starts = np.flatnonzero(head)
    first = np.repeat(starts, np.diff(np.append(starts, size)))
    rank[order] = first
    shared = np.zeros(size, np.int32)
    places = np.flatnonzero(_tied(head))
    open_, first = order[places], first[places]
    depth, segments = _FIRST, len(ends)
    while len(open_):
        # Suffixes that have ended are told apart by their segment.
        second = rank[np.minimum(open_ + depth, size - 1)] + np.int64(segments)
        ended = np.flatnonzero(left[open_] <= depth)
        second[ended] = segment[open_[ended]]
        first <<= 2 * POSITION_BITS + 1
        second <<= POSITION_BITS
        key = (first | second | open_).view(np.uint64)
        key.sort()
        open_ = (key & np.uint64(MAX_BYTES - 1)).view(np.int64)
        order[places] = open_
        key >>= np.uint64(POSITION_BITS)
        head = np.ones(len(key), bool)
        head[1:] = key[1:] != key[:-1]
        # A group's rank is its first place. What was one group shares the depth sorted so far.
        starts = np.flatnonzero(head)
        first = np.repeat(places[starts], np.diff(np.append(starts, len(key))))
        rank[open_] = first
        old = key >> np.uint64(POSITION_BITS + 1)
        parted = places[1:][head[1:] & (old[1:] == old[:-1])]
        shared[parted] = depth
        tied = _tied(head)
        open_, places, first = open_[tied], places[tied], first[tied]
        depth *= 2
    # Suffixes that ended at once share what is left of them.
    shared[1:] = np.minimum(shared[1:], np.minimum(left[order[1:]], left[order[:-1]]))
    return order, shared


def _tied(head: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, from flags of group heads in order."""
    tied = ~head
    tied[:-1] |= ~head[1:]
    return tied


def common_prefixes(data: np.ndarray, ends: np.ndarray, order: np.ndarray, limit: int,
                    known: np.ndarray | None = None) -> np.ndarray:
    """For each place in the order, the letters (up to ``limit``) shared with the place before.

    Kasai's rule: the suffix one letter further shares at least one letter less with its
    own predecessor. Stretches of the text are walked side by side, one array step for
    all of them, and letters are compared eight at a time. ``known`` are the letters that
    the refinement knows of; where twice as many stay below the limit they are enough.
    """
    size = len(data)
    out = np.zeros(size, np.int64)
    if size < 2:
        return out
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(size)
    most = np.minimum(np.minimum(left, left[before]), limit)
    most[before < 0] = 0
    least = np.zeros(size, np.int64) if known is None else np.minimum(known[place], most)
    reach = None if known is None else np.maximum(2 * known[place], _FIRST)
    exact = np.ones(size, bool) if known is None else (reach > limit) & (least < most)
    wide = _eight(data)
    steps = max(64, int(np.sqrt(size) / 4))
    lanes = np.arange(0, size, steps)
    shared = np.zeros(len(lanes), np.int64)
    for k in range(steps):
        at = lanes + k
        if at[-1] >= size:
            lanes, shared, at = lanes[:-1], shared[:-1], at[:-1]
            if not len(at):
                break
        length = np.minimum(np.maximum(shared - 1, least[at]), most[at])
        going = np.flatnonzero(exact[at] & (length < most[at]))
        while len(going):
            here = at[going]
            n = length[going]
            gap = wide[here + n] ^ wide[before[here] + n]
            same = gap == 0
            n = np.minimum(n + 8, most[here])
            if not same.all():
                stop = ~same
                n[stop] = np.minimum(length[going[stop]] + _leading_bytes(gap[stop]), n[stop])
            length[going] = n
            going = going[same & (n < most[here])]
        shared = length
        out[place[at]] = length
    return out


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, first byte highest."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    out = np.zeros(len(data) + 8, np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k:k + len(out)]
    return out


def _leading_bytes(gap: np.ndarray) -> np.ndarray:
    """Leading zero bytes of non-zero values."""
    same = np.zeros(len(gap), np.int64)
    for k in range(1, 8):
        same += gap < np.uint64(1) << np.uint64(64 - 8 * k)
    return same


def repeated_starts(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Group number of each start whose ``length`` bytes also begin at another start, else -1.

    Starts in one group have equal strings. All strings must lie in their segments.
    """
    order, known = refine(data, ends)
    shared = common_prefixes(data, ends, order, length, known)
    asked = np.zeros(len(data), bool)
    asked[starts] = True
    where = np.flatnonzero(asked[order])
    group = np.full(len(data), -1, np.int64)
    if not len(where):
        return group[starts]
    joined = _between(shared, where) >= length
    number = np.cumsum(np.concatenate([[True], ~joined]))
    several = np.zeros(len(where), bool)
    several[1:] |= joined
    several[:-1] |= joined
    group[order[where[several]]] = number[several]
    return group[starts]


def _between(shared: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Letters shared by the suffixes of neighbouring places in ``where``."""
    if len(where) < 2:
        return np.zeros(0, np.int64)
    # The pieces run from behind one asked place up to and with the next.
    return np.minimum.reduceat(shared[:where[-1] + 1], where[:-1] + 1)
