"""Periodic runs of words, found with an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q, at least `times` periods and `least` words long,
that no neighbouring word extends keeping the period. Its last square is right-branching: the suffixes at the two
halves agree in q words and no further. So for each LCP interval of depth q the suffixes i outside its largest
child are looked at, and i and i+q (or i-q and i) form such a square if the inverse suffix array puts the other one
into the same interval, in another child. Squares are rotated to the left as far as the period holds, which gives
the run, and runs of a multiple of the smallest period, which have the same bounds, are merged. Intervals are pairs
of positions in the LCP array; there are no tree nodes, and all steps are array operations over many texts.

Words are `[^\\x20\\x09-\\x0D]+`. A null text is read as empty; an empty text or one of blanks has no words, no runs
and an empty collapsed text. Texts are handled alone, so repeated rows give repeated results, ids may be null, and
other columns are left out. Texts of any length are handled whole; memory is some 120 bytes a word.
"""

import numpy as np
import pyarrow as pa

#: Texts are taken together up to about this many words; a longer text is taken alone.
TOGETHER = 250_000
#: Suffixes of small children tested at once.
TESTED = 2_000_000

RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Numbered(dict):
    """Words numbered in the order they are first asked for."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def suffix_ranks(codes, text, ends):
    """(levels, sa): levels[k] ranks each place by its first 2^k words within its text; the last is all different.

    Only places that are still equal to another one are sorted again in a level.
    """
    n = len(codes)
    order = np.lexsort((codes, text))
    fresh = np.r_[True, (codes[order[1:]] != codes[order[:-1]]) | (text[order[1:]] != text[order[:-1]])]
    first = np.flatnonzero(fresh)
    sizes = np.diff(np.r_[first, n])
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(first, sizes)
    sa, levels, step = order, [rank], 1
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(slots):
        places = sa[slots]
        after = places + step
        within = after < ends[places]
        follow = np.where(within, rank[np.where(within, after, 0)], -1) + 1
        group = rank[places]
        inner = np.lexsort((follow, group))
        places, group, follow = places[inner], group[inner], follow[inner]
        # Groups keep their slots, so the sorted members go back to the same slots.
        sa[slots] = places
        fresh = np.r_[True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])]
        first = np.flatnonzero(fresh)
        sizes = np.diff(np.r_[first, len(slots)])
        rank = rank.copy()
        rank[places] = np.repeat(slots[first], sizes)
        levels.append(rank)
        slots = slots[np.repeat(sizes > 1, sizes)]
        step *= 2
    return levels, sa


def neighbour_lcp(levels, sa, ends):
    """lcp[i]: words that the suffixes of slots i-1 and i share; 0 at both outer bounds."""
    n = len(sa)
    lcp = np.zeros(n + 1, dtype=np.int64)
    equal = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    # The highest level at which two neighbours still agree, then downwards for what follows.
    top = np.zeros(n + 1, dtype=np.int64)
    live = equal
    for k in range(1, len(levels)):
        live = live[levels[k][sa[live]] == levels[k][sa[live - 1]]]
        if not len(live):
            break
        top[live] = k
    lcp[equal] = 1 << top[equal]
    for k in range(len(levels) - 2, -1, -1):
        live = equal[top[equal] > k]
        a, b = sa[live - 1] + lcp[live], sa[live] + lcp[live]
        within = (a < ends[sa[live - 1]]) & (b < ends[sa[live]])
        live, a, b = live[within], a[within], b[within]
        lcp[live[levels[k][a] == levels[k][b]]] += 1 << k
    return lcp


def nearest(values, at, strict):
    """For each place in `at` (values above 0), the nearest place to the left with a smaller value.

    With strict=False one with an equal value will do. values[0] is 0.
    """
    left = np.arange(len(values)) - 1
    while len(at):
        at = at[values[left[at]] >= values[at]] if strict else at[values[left[at]] > values[at]]
        left[at] = left[left[at]]
    return left


def branching_squares(sa, isa, lcp, starts, ends):
    """(place, root) of all right-branching squares."""
    n = len(sa)
    at = np.flatnonzero(lcp > 0)
    low, same = nearest(lcp, at, True), nearest(lcp, at, False)
    high = (n - nearest(lcp[::-1], n - at[::-1], True))[::-1]
    # A child lies between two neighbouring bounds of its interval that have the interval's depth.
    inner = at[lcp[same[at]] == lcp[at]]
    followed = np.zeros(n + 1, dtype=bool)
    followed[same[inner]] = True
    last = at[~followed[at]]
    lo, hi = np.r_[same[at], last], np.r_[at, high[last]]
    of = np.r_[at, last]
    depth, left, right = lcp[of], low[of], high[of]
    by = np.lexsort((hi - lo, right, left))
    left_by, right_by = left[by], right[by]
    largest = np.r_[(left_by[1:] != left_by[:-1]) | (right_by[1:] != right_by[:-1]), True] if len(by) else np.zeros(0, bool)
    small = by[~largest]
    found, cut = [np.zeros((2, 0), dtype=np.int64)], np.cumsum(hi[small] - lo[small])
    while len(small):
        take = max(1, int(np.searchsorted(cut, TESTED)))
        now, small, cut = small[:take], small[take:], cut[take:] - cut[take - 1]
        size = hi[now] - lo[now]
        child = np.repeat(now, size)
        slot = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + lo[child]
        place, q = sa[slot], depth[child]
        for other, square in ((place + q, place), (place - q, place - q)):
            ok = (other >= starts[place]) & (other < ends[place])
            slot2 = isa[np.where(ok, other, 0)]
            ok &= (left[child] <= slot2) & (slot2 < right[child]) & ~((lo[child] <= slot2) & (slot2 < hi[child]))
            found.append(np.stack([square[ok], q[ok]]))
    return np.unique(np.concatenate(found, axis=1), axis=1)


def runs(codes, sizes, times=4, least=6):
    """Rows (text, start, length, period) by text, start and period, for the word codes of texts of the given sizes."""
    codes, sizes = np.asarray(codes, dtype=np.int64), np.asarray(sizes, dtype=np.int64)
    if not len(codes):
        return np.zeros((0, 4), dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    starts, ends = begin[text], (begin + sizes)[text]
    levels, sa = suffix_ranks(codes, text, ends)
    isa = levels[-1]
    place, q = branching_squares(sa, isa, neighbour_lcp(levels, sa, ends), starts, ends)
    end, first = place + 2 * q, place.copy()
    for k in range(len(levels) - 1, -1, -1):
        back = first - (1 << k)
        ok = back >= starts[place]
        ok[ok] = levels[k][back[ok]] == levels[k][back[ok] + q[ok]]
        first[ok] = back[ok]
    length = end - first
    kept = length >= np.maximum(least, times * q)
    first, end, q = first[kept], end[kept], q[kept]
    by = np.lexsort((q, end, first))
    first, end, q = first[by], end[by], q[by]
    alone = np.r_[True, (first[1:] != first[:-1]) | (end[1:] != end[:-1])] if len(by) else np.zeros(0, bool)
    first, end, q = first[alone], end[alone], q[alone]
    rows = np.stack([text[first], first - starts[first], end - first, q], axis=1) if len(first) else np.zeros((0, 4), np.int64)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def collapsed(words, found):
    """The words of a text without those that a run (start, length, period) contains after its first period."""
    if not len(found):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])


def periodic(docs, doc_id="doc_id", text="text", times=4, least=6):
    """doc_id, n_words, runs (array of start, length, period) and the collapsed text, one row per document."""

    def find(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            words = [(t or "").encode().split() for t in texts]
            lists, bodies, at = [], [], 0
            while at < len(words):
                upto, size = at + 1, len(words[at])
                while upto < len(words) and size + len(words[upto]) <= TOGETHER:
                    size += len(words[upto])
                    upto += 1
                group, numbers = words[at:upto], Numbered()
                codes = np.fromiter((numbers[w] for ws in group for w in ws), dtype=np.int64, count=size)
                rows = runs(codes, [len(ws) for ws in group], times, least)
                bounds = np.searchsorted(rows[:, 0], np.arange(len(group) + 1))
                for ws, low, high in zip(group, bounds[:-1], bounds[1:]):
                    lists.append([{"start": s, "length": n, "period": q} for s, n, q in rows[low:high, 1:].tolist()])
                    bodies.append(collapsed(ws, rows[low:high, 1:]).decode())
                at = upto
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(ws) for ws in words], pa.int64()), pa.array(lists, RUNS), pa.array(bodies, pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
