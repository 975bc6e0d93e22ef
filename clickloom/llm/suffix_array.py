"""Suffix arrays by induced sorting and permuted longest common prefixes, vectorised with numpy.

The suffixes are classified as smaller (S) or larger (L) than their right neighbour. The substrings between
leftmost smaller (LMS) positions are sorted by inducing, named, and the string of names is sorted by the same
function; the sorted LMS suffixes then induce the whole array. A scan of the array is done bucket by bucket
instead of item by item: all items of a bucket are known when the scan arrives there, except those that the
bucket induces into itself, which are found in rounds. Small buckets are taken together.
"""

import numpy as np

#: Array items that a scan takes at once, as far as buckets allow.
STEP = 1 << 11


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start of each suffix of ``text`` (non-negative integers) in order; a suffix before its extensions."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    symbols, ranked = np.unique(text, return_inverse=True)
    codes = np.empty(n + 1, np.int64)
    codes[:n] = ranked.reshape(-1) + 1
    codes[n] = 0
    return _sorted(codes, len(symbols) + 1)[1:]


def _sorted(codes: np.ndarray, alphabet: int) -> np.ndarray:
    """Suffix array of ranks that end in a single zero."""
    n = len(codes)
    if alphabet == n:
        order = np.empty(n, np.int64)
        order[codes] = np.arange(n)
        return order
    if alphabet <= 1 << 16:
        codes = codes.astype(np.uint16)  # numpy sorts these by radix
    small = _smaller(codes)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    rough = _induce(codes, small, alphabet, lms)
    by_substring = rough[_is_lms(small, rough)]
    names, distinct = _named(codes, lms, by_substring)
    if distinct < len(lms):
        order = _sorted(names, distinct)
        by_substring = lms[order]
    return _induce(codes, small, alphabet, by_substring)


def _smaller(codes: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one to its right."""
    n = len(codes)
    differs = np.flatnonzero(codes[:-1] != codes[1:])
    # A run of equal symbols takes its kind from its end.
    last = differs[np.searchsorted(differs, np.arange(n - 1))] if n > 1 else differs
    small = np.ones(n, bool)
    small[:-1] = codes[last] < codes[last + 1]
    return small


def _is_lms(small: np.ndarray, at: np.ndarray) -> np.ndarray:
    return small[at] & (at > 0) & ~small[at - 1]


def _named(codes: np.ndarray, lms: np.ndarray, by_substring: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings in text order, and how many there are."""
    count = len(lms)
    where = np.empty(len(codes), np.int64)
    where[lms] = np.arange(count)
    nth = where[by_substring]
    ends = np.append(lms[1:], lms[-1])  # the last one is the end mark alone
    lengths = ends - lms + 1
    fresh = np.ones(count, bool)
    same = np.flatnonzero(lengths[nth[1:]] == lengths[nth[:-1]]) + 1
    step = 0
    while len(same):
        a, b = by_substring[same], by_substring[same - 1]
        equal = codes[a + step] == codes[b + step]
        same, step = same[equal], step + 1
        done = lengths[nth[same]] == step
        fresh[same[done]] = False
        same = same[~done]
    names = np.empty(count, np.int64)
    names[nth] = np.cumsum(fresh) - 1
    return names, int(fresh.sum())


def _induce(codes: np.ndarray, small: np.ndarray, alphabet: int, lms: np.ndarray) -> np.ndarray:
    """Array induced from LMS suffixes in the given order."""
    sizes = np.bincount(codes, minlength=alphabet)
    tails = np.cumsum(sizes)
    heads = tails - sizes
    order = np.full(len(codes), -1, np.int64)
    _place(order, codes, lms, tails.copy(), from_end=True)
    _scan(order, codes, small, heads, tails, larger=True)
    # The LMS suffixes find their places anew, among the other smaller ones.
    larger_end = heads + np.bincount(codes[~small], minlength=alphabet)
    slots = np.arange(len(codes))
    order[slots >= np.repeat(larger_end, sizes)] = -1
    order[0] = len(codes) - 1
    _scan(order, codes, small, heads, tails, larger=False)
    return order


def _place(order, codes, items, free, from_end):
    """Append items to their buckets in the given order; from the end, they stand in that order there."""
    if not len(items):
        return
    keys = codes[items]
    by_key = np.argsort(keys, kind="stable")
    keys = keys[by_key]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    lengths = np.diff(np.append(starts, len(keys)))
    nth = np.arange(len(keys)) - np.repeat(starts, lengths)
    touched = keys[starts]
    if from_end:
        free[touched] -= lengths
        order[np.repeat(free[touched], lengths) + nth] = items[by_key]
    else:
        order[np.repeat(free[touched], lengths) + nth] = items[by_key]
        free[touched] += lengths


def _scan(order, codes, small, heads, tails, larger):
    """One pass over the buckets, ascending for larger suffixes, descending for smaller ones.

    A descending pass is an ascending one over reversed positions, so ``seen`` holds items in scan order.
    """
    alphabet = len(heads)
    free = heads.copy() if larger else tails.copy()
    bounds = np.append(heads, tails[-1])
    at = 0 if larger else alphabet
    while at < alphabet if larger else at > 0:
        if larger:
            to = int(np.searchsorted(bounds, bounds[at] + STEP, side="right")) - 1
            low, high = at, min(alphabet, max(at + 1, to))
            at = high
        else:
            to = int(np.searchsorted(bounds, bounds[at] - STEP, side="left"))
            low, high = max(0, min(at - 1, to)), at
            at = low
        here = order[bounds[low]:bounds[high]]
        seen = here[here >= 0]
        if not larger:
            seen = seen[::-1]
        seen = _closed(seen, codes, small, low, high, larger)
        before = seen[seen > 0] - 1
        induced = before[small[before] != larger]
        if larger:
            _place(order, codes, induced, free, from_end=False)
        else:
            _place_down(order, codes, induced, free)


def _place_down(order, codes, items, free):
    """The first item of a bucket takes its last free place, the next one the place before."""
    if not len(items):
        return
    keys = codes[items]
    by_key = np.argsort(keys, kind="stable")
    keys = keys[by_key]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    lengths = np.diff(np.append(starts, len(keys)))
    nth = np.arange(len(keys)) - np.repeat(starts, lengths)
    touched = keys[starts]
    order[np.repeat(free[touched], lengths) - 1 - nth] = items[by_key]
    free[touched] -= lengths


def _closed(seen, codes, small, low, high, larger):
    """Items of buckets [low, high) in scan order, with those that these buckets induce into themselves.

    In a bucket the items of the induced kind that were there come first, then those that the scan induces in
    the order of their sources, then items of the other kind. Each round adds what the last one's items induce.
    """
    sign = 1 if larger else -1
    other = small[seen] == larger
    fresh, added, first = seen, np.zeros(0, np.int64), seen
    rounds = []
    while True:
        before = fresh[fresh > 0] - 1
        before = before[small[before] != larger]
        keys = codes[before]
        fresh = before[(keys >= low) & (keys < high)]
        if high - low == 1:
            if not len(fresh):
                return np.concatenate([seen[~other], *rounds, seen[other]]) if rounds else seen
            rounds.append(fresh)
            continue
        if not len(fresh):
            return seen
        added = np.concatenate([added, fresh])
        by_item = np.argsort(seen)
        source = by_item[np.searchsorted(seen, added + 1, sorter=by_item)]
        added = added[np.lexsort((source, sign * codes[added].astype(np.int64)))]
        kind = np.concatenate([2 * other.astype(np.int8), np.ones(len(added), np.int8)])
        seen = np.concatenate([first, added])
        seen = seen[np.lexsort((kind, sign * codes[seen].astype(np.int64)))]


def common_prefixes(text: np.ndarray, order: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Permuted common prefixes: of each suffix with its predecessor in the array, by text position.

    ``limit`` bounds the prefix at each position and must fall by at most one from a position to the next.
    Only values that don't follow from their left neighbour are found by comparing.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    known = np.zeros(n, bool)
    known[1:] = (before[1:] > 0) & (text[:-1] == text[np.maximum(before[1:], 1) - 1]) & (limit[1:] == limit[:-1] - 1)
    lengths = np.zeros(n, np.int64)
    open_ = np.flatnonzero(~known & (before >= 0))
    padded = np.concatenate([text.astype(np.uint8), np.zeros(8, np.uint8)])
    words = np.ndarray(n + 1, "<u8", padded, 0, (1,))
    while len(open_):
        a = open_ + lengths[open_]
        b = before[open_] + lengths[open_]
        differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        same = np.full(len(open_), 8, np.int64)
        odd = differ != 0
        low = differ[odd] & (~differ[odd] + np.uint64(1))
        same[odd] = np.bitwise_count(low - np.uint64(1)) // 8
        same = np.minimum(same, np.minimum(n - a, n - b))
        lengths[open_] += same
        open_ = open_[(same == 8) & (lengths[open_] < limit[open_])]
    start = np.maximum.accumulate(np.where(known, 0, at))
    return np.minimum(np.maximum(lengths[start] - (at - start), 0), limit)
