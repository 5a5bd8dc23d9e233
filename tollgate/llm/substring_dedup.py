"""Passages that repeat across documents, exactly or with small edits, by
seeding, collinear chaining and alignment.

Seeds are word k-mers, thinned to minimizers: of every W consecutive k-mers the
one with the least hash.  Any shared run of W + K - 1 words has a shared seed.
Seeds are joined to their first occurrence only (the anchor), never to each
other, so a seed with n occurrences gives n - 1 matches.  Every input task
first joins its own seeds and ships one occurrence of each, so a passage that a
third of all documents share sends one row per seed and task.

The matches of a document with one anchor document are merged to diagonal
segments and chained: the best chain of segments that increase in both texts,
less a cost for the words left out between them, comes from Fenwick trees of
prefix maxima over the positions in the anchor.  At most MAX_GAP words lie
between two segments in either text; blocks of that size turn the window into
a prefix of one block and a suffix of the block before.  Chains are extended and
aligned on the words of both texts; what aligns well is a fuzzy passage.  Of a
chain that does not align well as a whole, the longest spans that do are kept.

Seeds of one passage may have their first occurrences in many other texts.  Two
more kinds of seeds, joined to their own first occurrence, find such passages.
Pairs of repeating seeds with different anchors, at distances from LINKS on, are
linked to one seed: a text that holds one piece of the passage does not have
them.  And all runs of MIN_WORDS words whose seeds all repeat are seeds: an
exact passage is found whatever the anchors of its short seeds are.

A passage may be put together from several anchors.  Spans of a document that
touch are one passage, and it counts from MIN_WORDS words on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.staging import discard, materialise
from tollgate.llm.textarrays import Block, Words, blocks, mix, words

K, W = 6, 10
MIN_WORDS = 50  # of a passage
MIN_CHAIN = 12  # words between a chain's first and last seed
MAX_GAP = 32  # words between two segments of a chain
GAP_COST = 0.25  # per word left out in either text
IDENTITY = 0.8  # aligned words of a chain's longer side
JOIN_GAP = 4  # words between spans of one passage
LINKS = (16, 32, 48)  # words at least between the seeds of a link; the next one is taken, up to MAX_GAP beyond the last
_SEEDS = 1 << 21  # seeds that a task joins at a time
_SLICED = 1 << 24  # words of spans that are sent on at a time
_FOLD = np.uint64(0xD1B54A32D192ED03)


def seeds(w: Words, k: int = K, window: int = W) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimizers as (text, word position, k-mer hash), by text and position.

    A text with fewer than ``window`` k-mers has the least of them.  A seed
    that repeats the one before it is left out.
    """
    n = len(w.hash) - k + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * _FOLD + w.hash[j:j + n]
    h = mix(h)
    text = np.repeat(np.arange(len(w.counts)), w.counts)
    whole = text[:n] == text[k - 1:]
    h, own = h[whole], text[:n][whole]
    position = np.flatnonzero(whole) - w.offsets[own]
    if not len(h):
        return none, none, h
    chosen = np.zeros(len(h), bool)
    m = len(h) - window + 1
    if m > 0:
        least = h[:m].copy()
        for j in range(1, window):
            np.minimum(least, h[j:j + m], out=least)
        full = own[:m] == own[window - 1:]
        for j in range(window):
            chosen[j:j + m] |= full & (h[j:j + m] == least)
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    size = np.diff(np.append(first, len(own)))
    short = np.minimum.reduceat(h, first)
    chosen |= np.repeat(size < window, size) & (h == np.repeat(short, size))
    own, position, h = own[chosen], position[chosen], h[chosen]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return own[new], position[new], h[new]


def _content_keys(block: Block, w: Words) -> list[tuple[int, int]]:
    """128-bit keys of the texts' word sequences."""
    at = np.arange(len(w.hash)) - np.repeat(w.offsets[:-1], w.counts)
    out = np.zeros((2, block.n), np.uint64)
    some = np.flatnonzero(w.counts)
    for j in (0, 1):
        if len(some):
            out[j, some] = np.add.reduceat(mix(w.hash ^ mix(at.astype(np.uint64) + np.uint64(j << 40))), w.offsets[some])
    return list(zip(out[0].tolist(), out[1].tolist(), strict=True))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row its number of words and the task's first row with the same
    words; only that row keeps the text."""
    seen: dict[tuple[int, int], int] = {}
    for batch in batches:
        rows = batch.column("row").to_pylist()
        for block in blocks(batch.column("body")):
            w = words(block)
            own = rows[block.first:block.first + block.n]
            first = [seen.setdefault(key, row) for key, row in zip(_content_keys(block, w), own, strict=True)]
            if len(seen) > 500_000:
                seen.clear()
            new = np.array([a == b for a, b in zip(own, first, strict=True)])
            text_of = pa.array(block.first + np.arange(block.n), mask=~(new & (w.counts > 0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), batch.column("id").slice(block.first, block.n),
                 pa.array(w.counts.astype(np.int64)), pa.array(first, pa.int64()), batch.column("body").take(text_of)],
                names=["row", "id", "n_words", "first", "body"])


# A match's spot is its position in row, and in the lower 32 bits that in ref.
_MATCHES = "row long, ref long, spot long, gram long"
_MATCH = ["row", "ref", "spot", "gram"]


def _spot(pos: np.ndarray, rpos: np.ndarray) -> np.ndarray:
    return pos.astype(np.int64) << 32 | rpos


def _joined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Matches of a task's own keys, and one occurrence of each key (its ref is
    -1) to be joined to those of the other tasks; instead of rpos it has 1 where
    it has matches already."""
    gram, row, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(gram, kind="stable")
    gram, row, pos = gram[order], row[order], pos[order]
    first = np.concatenate([[True], gram[1:] != gram[:-1]])
    group = np.cumsum(first) - 1
    anchor = np.flatnonzero(first)[group]
    matched = row != row[anchor]
    many = np.bincount(group, weights=matched)[group] > 0
    keep = first | matched
    first, anchor, many = first[keep], anchor[keep], many[keep]
    ref, rpos = np.where(first, -1, row[anchor]), np.where(first, many, pos[anchor])
    return pa.RecordBatch.from_arrays(
        [pa.array(row[keep]), pa.array(ref), pa.array(_spot(pos[keep], rpos)), pa.array(gram[keep].view(np.int64))], names=_MATCH)


def _local_seeds(k: int, window: int):
    """Seeds of the texts, joined within the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            rows = batch.column("row").to_numpy()
            for block in blocks(batch.column("body")):
                text, pos, gram = seeds(words(block), k, window)
                parts.append((gram, rows[block.first + text], pos))
                waiting += len(gram)
                if waiting > _SEEDS:
                    yield _joined(parts)
                    parts, waiting = [], 0
        if waiting:
            yield _joined(parts)

    return run


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, put together from powers of two."""
    n = max(len(h) - size + 1, 0)
    out, part, done, m = np.zeros(n, np.uint64), h, 0, 1
    while m <= size:
        if size & m:
            out = mix(out * _FOLD + part[done:done + n])
            done += m
        part = mix(part[:-m] * _FOLD + part[m:])
        m *= 2
    return out


def _may_repeat(w: Words, chosen: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray, bounds: np.ndarray,
                k: int, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``size`` words that may repeat, as (text, first word).  ``at`` has
    the positions of each text's seeds that repeat, from ``bounds`` on.

    A seed is surely one in every text that has the run, if the run holds all
    the k-mers it was chosen from.  Runs with such a seed that does not repeat
    do not repeat.
    """
    of, pos, gram = chosen
    total = len(w.hash)
    there = np.zeros(total + 1, bool)
    there[np.repeat(w.offsets[:-1], np.diff(bounds)) + at] = True
    # A seed repeats at all of its places in a text, if it does at one.
    order = np.lexsort((gram, of))
    first = np.ones(len(order), bool)
    first[1:] = (gram[order][1:] != gram[order][:-1]) | (of[order][1:] != of[order][:-1])
    group = np.cumsum(first) - 1
    repeats = np.empty(len(order), bool)
    repeats[order] = (np.bincount(group, weights=there[w.offsets[of] + pos][order]) > 0)[group]
    # All texts on one line: a seed that does not repeat shuts out the runs that begin from lo to hi.
    runs = np.maximum(w.counts - size + 1, 0)
    of, pos = of[~repeats], pos[~repeats]
    lo = w.offsets[of] + np.clip(pos - (size - k - window + 1), 0, runs[of])
    hi = w.offsets[of] + np.clip(pos - window + 2, 0, runs[of])
    lo, hi = lo[lo < hi], hi[lo < hi]
    shut = np.cumsum(np.bincount(lo, minlength=total + 1) - np.bincount(hi, minlength=total + 1))[:total]
    text = np.repeat(np.arange(len(w.counts)), w.counts)
    start = np.arange(total) - w.offsets[text]
    free = (start < runs[text]) & (shut == 0)
    return text[free], start[free]


def _whole_windows(k: int, window: int, size: int):
    """Runs of ``size`` words that may repeat, as seeds that long, joined within
    the task.  ``at`` has the positions of a text's seeds that repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, waiting = [], 0
        for batch in batches:
            rows, places = batch.column("row").to_numpy(), batch.column("at")
            for block in blocks(batch.column("body")):
                w = words(block)
                if len(w.hash) < size:
                    continue
                values, bounds = _lists(places.slice(block.first, block.n))
                text, start = _may_repeat(w, seeds(w, k, window), values, bounds, k, window, size)
                if len(start):
                    h = window_hashes(w.hash, size)
                    parts.append((h[w.offsets[text] + start], rows[block.first + text], start))
                    waiting += len(start)
                if waiting > _SEEDS:
                    yield _joined(parts)
                    parts, waiting = [], 0
        if waiting:
            yield _joined(parts)

    return run


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by seed: every later occurrence with the first one; matches pass.
    The first one of a seed that repeats comes too, as its own match."""

    def of(row: np.ndarray, spot: np.ndarray, gram: np.ndarray) -> Iterator[pa.RecordBatch]:
        same = gram[1:] == gram[:-1]
        some = (spot & 1) > 0
        some[1:] |= same
        some[:-1] |= same
        row, spot, gram = row[some], spot[some], gram[some]
        if not len(gram):
            return
        order = np.lexsort((spot, row, gram))
        row, pos, gram = row[order], spot[order] >> 32, gram[order]
        many = (spot[order] & 1) > 0
        first = np.concatenate([[True], gram[1:] != gram[:-1]])
        group = np.cumsum(first) - 1
        head = np.flatnonzero(first)
        anchor = head[group]
        later = row != row[anchor]
        own = head[np.bincount(group, weights=later | many) > 0]
        at, anchor = np.concatenate([np.flatnonzero(later), own]), np.concatenate([anchor[later], own])
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[at]), pa.array(row[anchor]), pa.array(_spot(pos[at], pos[anchor])), pa.array(gram[at])], names=_MATCH)

    held: list[list[np.ndarray]] = []  # the last seed, which may go on: one occurrence per task
    for batch in batches:
        waits = batch.column("ref").to_numpy() < 0
        if not waits.all():
            yield batch.filter(pa.array(~waits)).select(_MATCH)
        now = [batch.column(c).to_numpy()[waits] for c in ("row", "spot", "gram")]
        gram = now[-1]
        if not len(gram):
            continue
        start = int(np.searchsorted(gram, gram[-1]))
        if start or (held and held[0][-1][0] != gram[0]):
            yield from of(*(np.concatenate(c) for c in zip(*held, [c[:start] for c in now], strict=True)))
            held = []
        held.append([c[start:] for c in now])
    if held:
        yield from of(*(np.concatenate(c) for c in zip(*held, strict=True)))


def _repeating(links: tuple[int, ...], widest: int):
    """From matches sorted by row: the positions of a row's seeds that repeat (``at``), and linked seeds.

    Two seeds are linked to the next one that begins at least so many words
    later, up to ``widest``, if their anchors differ: no text has given both.
    An anchor's own seeds are linked too, as the others' counterpart."""

    def of(row: np.ndarray, spot: np.ndarray, ref: np.ndarray, gram: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((spot, row))
        row, pos, ref, gram = row[order], spot[order] >> 32, ref[order], gram[order]
        once = np.ones(len(row), bool)
        once[1:] = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1])
        row, pos, ref, gram = row[once], pos[once], ref[once], gram[once]
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        size = np.diff(np.append(head, len(row)))
        at = pa.ListArray.from_arrays(pa.array(np.append(head, len(row)).astype(np.int32)), pa.array(pos.astype(np.int32)))
        none = pa.nulls(len(head), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[head]), none, none, none, at], names=[*_MATCH, "at"])
        # Positions of all rows on one line, rows further apart than any link.
        line = pos + np.repeat(np.cumsum(np.concatenate([[0], pos[head[1:] - 1] + widest + 1])) if len(head) else head, size)
        parts = []
        for least in links:
            other = np.searchsorted(line, line + least)
            some = np.flatnonzero(other < len(line))
            other = other[some]
            near = (row[some] == row[other]) & (line[other] - line[some] <= widest)
            split = (ref[some] != ref[other]) | (ref[some] == row[some])
            a, b = some[near & split], other[near & split]
            key = mix(gram[a].view(np.uint64) * _FOLD + mix(gram[b].view(np.uint64)))
            parts.append((key, row[a], pos[a]))
            if least == max(links):  # the far end too: there is no other link to a passage's last words
                parts.append((mix(key), row[b], pos[b]))
        if any(len(p[0]) for p in parts):
            made = _joined(parts)
            yield pa.RecordBatch.from_arrays([*made.columns, pa.nulls(made.num_rows, pa.list_(pa.int32()))],
                                             names=[*_MATCH, "at"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy() for c in ("row", "spot", "ref", "gram")]
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now, strict=True)]
            start = int(np.argmax(now[0] == now[0][-1]))  # the last row may go on
            held = [c[start:] for c in now]
            if start:
                yield from of(*[c[:start] for c in now])
        if held is not None:
            yield from of(*held)

    return run


class Fenwick:
    """Prefix maxima of (value, holder) over slots 0 .. n - 1."""

    def __init__(self, n: int):
        self.n = n
        self.best: dict[int, tuple[float, int]] = {}

    def put(self, slot: int, entry: tuple[float, int]) -> None:
        i = slot + 1
        while i <= self.n:
            if i not in self.best or self.best[i] < entry:
                self.best[i] = entry
            i += i & -i

    def get(self, slot: int) -> tuple[float, int]:
        """The largest of slots 0 .. slot."""
        out, i = (-np.inf, -1), slot + 1
        while i > 0:
            if i in self.best and self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


class Reach:
    """Largest entry among positions y - size .. y: in each block of ``size``
    positions one Fenwick tree runs forwards and one backwards."""

    def __init__(self, size: int):
        self.size = size
        self.trees: dict[tuple[int, bool], Fenwick] = {}

    def put(self, y: int, entry: tuple[float, int]) -> None:
        block, slot = divmod(y, self.size)
        for back, at in ((False, slot), (True, self.size - 1 - slot)):
            self.trees.setdefault((block, back), Fenwick(self.size)).put(at, entry)

    def get(self, y: int) -> tuple[float, int]:
        block, slot = divmod(y, self.size)
        out = (-np.inf, -1)
        for key, at in (((block, False), slot), ((block - 1, True), self.size - 1 - slot)):
            if key in self.trees:
                out = max(out, self.trees[key].get(at))
        return out


def chain(segments: list[tuple[int, int, int, int]], gap_cost: float = GAP_COST, max_gap: int = MAX_GAP) -> list[list[int]]:
    """Chains of segments (x, y, length, weight), best first; every segment is
    in one chain at most, and consecutive ones increase in x and y, with at
    most ``max_gap`` between them in either."""
    n = len(segments)
    if n == 1:
        return [[0]]
    score, before = [0.0] * n, [-1] * n
    starts: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    for i, (x, _, length, _) in enumerate(segments):
        starts.setdefault(x // max_gap, []).append(i)
        ends.setdefault((x + length) // max_gap, []).append(i)

    def end(i: int) -> int:
        return segments[i][0] + segments[i][2]

    def put(reach: Reach, i: int) -> None:
        x, y, length, _ = segments[i]
        reach.put(y + length, (score[i] + gap_cost * (x + y + 2 * length), i))

    for block in sorted(starts):
        best: dict[int, tuple[float, int]] = {}
        # Of the block before, what ended at most max_gap words ago: backwards, the window only grows.
        earlier, reach = sorted(ends.get(block - 1, ()), key=end), Reach(max_gap)
        for i in sorted(starts[block], key=lambda i: -segments[i][0]):
            while earlier and end(earlier[-1]) >= segments[i][0] - max_gap:
                put(reach, earlier.pop())
            best[i] = reach.get(segments[i][1])
        # Of this block, what has ended: an end comes before a start at the same place.
        reach = Reach(max_gap)
        for _, kind, i in sorted([(segments[i][0], 1, i) for i in starts[block]] + [(end(i), 0, i) for i in ends.get(block, ())]):
            if kind == 0:
                put(reach, i)
                continue
            x, y, _, weight = segments[i]
            value, j = max(best[i], reach.get(y))
            gain = value - gap_cost * (x + y)
            score[i] = weight + max(gain, 0.0)
            if gain > 0:
                before[i] = j
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = before[i]
        if path:
            out.append(path[::-1])
    return out


def _chains(k: int, min_chain: int, linked: bool = True):
    """Chains of each (row, ref) from its matches, which come sorted by row; not ``linked``, every diagonal segment is one."""

    def of(row: np.ndarray, ref: np.ndarray, spot: np.ndarray) -> pa.RecordBatch | None:
        pos, rpos = spot >> 32, spot & 0xFFFFFFFF
        diagonal = pos - rpos
        order = np.lexsort((pos, diagonal, ref, row))
        row, ref, pos, rpos, diagonal = (x[order] for x in (row, ref, pos, rpos, diagonal))
        new = np.ones(len(row), bool)
        new[1:] = ((row[1:] != row[:-1]) | (ref[1:] != ref[:-1]) | (diagonal[1:] != diagonal[:-1])
                   | (pos[1:] - pos[:-1] > MAX_GAP))
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(row)) - 1
        x, y, length = pos[at], rpos[at], pos[last] - pos[at] + 1
        weight = np.minimum(length + k - 1, (last - at + 1) * k)
        pair = np.ones(len(at), bool)
        pair[1:] = (row[at][1:] != row[at][:-1]) | (ref[at][1:] != ref[at][:-1])
        groups = np.append(np.flatnonzero(pair), len(at))
        out = []
        for a, b in zip(groups[:-1].tolist(), groups[1:].tolist(), strict=True):
            found = list(zip(x[a:b].tolist(), y[a:b].tolist(), length[a:b].tolist(), weight[a:b].tolist(), strict=True))
            for path in chain(found) if linked else [[i] for i in range(len(found))]:
                s = [found[i] for i in path]
                if s[-1][0] + s[-1][2] - s[0][0] >= min_chain - k + 1:
                    out.append((int(row[at[a]]), int(ref[at[a]]), [q[0] for q in s], [q[1] for q in s],
                                [q[2] + k - 1 for q in s]))
        if not out:
            return None
        c = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()),
                                           *(pa.array(q, pa.list_(pa.int32())) for q in c[2:])],
                                          names=["row", "ref", "xs", "ys", "lengths"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(c).to_numpy() for c in ("row", "ref", "spot")]
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now, strict=True)]
            start = int(np.argmax(now[0] == now[0][-1]))  # the last row may go on
            held = [c[start:] for c in now]
            if start and (made := of(*[c[:start] for c in now])) is not None:
                yield made
        if held is not None and (made := of(*held)) is not None:
            yield made

    return run


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of each requested span of a text, four bytes each."""
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            rows = batch.column("row").to_numpy()
            new = np.concatenate([[True], rows[1:] != rows[:-1]])
            hashes, counts = [], []
            for block in blocks(batch.column("body").take(pa.array(np.flatnonzero(new)))):
                w = words(block)
                hashes.append(w.hash.astype(np.uint32))
                counts.append(w.counts)
            line, count = np.concatenate(hashes), np.concatenate(counts)
            text = np.cumsum(new) - 1
            lo = np.maximum(batch.column("lo").to_numpy(), 0)
            size = np.maximum(np.minimum(batch.column("hi").to_numpy(), count[text]) - lo, 0)
            first = (np.cumsum(count) - count)[text] + lo
            ends = np.cumsum(size)
            for part in np.split(np.arange(len(size)), np.flatnonzero(np.diff(ends // _SLICED)) + 1):
                offsets = np.concatenate([[0], np.cumsum(size[part])])
                cut = line[np.repeat(first[part] - offsets[:-1], size[part]) + np.arange(offsets[-1])]
                spans = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(4 * offsets), pa.py_buffer(cut)])
                some = batch.slice(int(part[0]), len(part))
                yield pa.RecordBatch.from_arrays(
                    [some.column("chain"), some.column("side"), pa.array(lo[part].astype(np.int32)), spans.cast(pa.binary())],
                    names=["chain", "side", "lo", "words"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short word runs."""
    if not len(a) or not len(b):
        return 0
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return int(row[-1])


def columns(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int], lengths: list[int]) -> tuple[int, int, np.ndarray]:
    """A chain's alignment: its start in a and in b, and rows (words of a, words
    of b, equal words).

    Segments are compared word by word; gaps are equal words at both ends and
    the longest common subsequence of the rest, which is one row; both ends of
    the chain are extended over equal words.
    """
    x, y = xs[0], ys[0]
    room = min(x, y)
    differ = np.flatnonzero(a[x - room:x] != b[y - room:y])
    left = room - (int(differ[-1]) + 1 if len(differ) else 0)
    start_x, start_y = x - left, y - left

    def by_word(equal: np.ndarray) -> np.ndarray:
        return np.stack([np.ones(len(equal), np.int64), np.ones(len(equal), np.int64), equal.astype(np.int64)], axis=1)

    out = [by_word(np.ones(left, bool))]
    for sx, sy, n in zip(xs, ys, lengths, strict=True):
        over = max(x - sx, y - sy, 0)  # segments may overlap by up to a seed
        sx, sy, n = sx + over, sy + over, n - over
        if n <= 0:
            continue
        if sx > x or sy > y:
            gap = min(sx - x, sy - y)
            differ = np.flatnonzero(a[x:x + gap] != b[y:y + gap])
            head = int(differ[0]) if len(differ) else gap
            differ = np.flatnonzero(a[sx - gap + head:sx] != b[sy - gap + head:sy])
            tail = gap - head - (int(differ[-1]) + 1 if len(differ) else 0)
            inner = (a[x + head:sx - tail], b[y + head:sy - tail])
            out += [by_word(np.ones(head, bool)), np.array([[len(inner[0]), len(inner[1]), _common(*inner)]], np.int64),
                    by_word(np.ones(tail, bool))]
        out.append(by_word(a[sx:sx + n] == b[sy:sy + n]))
        x, y = sx + n, sy + n
    room = min(len(a) - x, len(b) - y)
    differ = np.flatnonzero(a[x:x + room] != b[y:y + room])
    out.append(by_word(np.ones(int(differ[0]) if len(differ) else room, bool)))
    return start_x, start_y, np.concatenate(out)


def align(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int], lengths: list[int]) -> tuple[int, int, int, int, int]:
    """Aligned span of a chain: start and end in a, in b, and its equal words."""
    x, y, steps = columns(a, b, xs, ys, lengths)
    dx, dy, equal = steps.sum(axis=0).tolist()
    return x, x + dx, y, y + dy, equal


def _diagonal(a: np.ndarray, b: np.ndarray, x: int, y: int, length: int) -> tuple[int, int, int, int, float]:
    """The whole span of a chain of one segment: start and end in a, in b, identity."""
    before, after = min(x, y), min(len(a) - x, len(b) - y)
    differ = np.flatnonzero(a[x - before:x + after] != b[y - before:y + after])
    i, j = differ.searchsorted((before, before + length)).tolist()
    left = before - int(differ[i - 1]) - 1 if i else before
    right = int(differ[j]) - before if j < len(differ) else after
    return x - left, x + right, y - left, y + right, (left + right - (j - i)) / max(left + right, 1)


def good_spans(a: np.ndarray, b: np.ndarray, xs: list[int], ys: list[int], lengths: list[int], identity: float,
               least: int) -> list[tuple[int, int, int, int, float]]:
    """Spans of a chain (start and end in a, in b, identity) with at least
    ``identity``: the whole chain, or else its longest such span, and the same
    again left and right of it, from ``least`` words on."""
    if len(xs) == 1:
        whole = _diagonal(a, b, xs[0], ys[0], lengths[0])
        if whole[-1] >= identity:
            return [whole]
    x, y, steps = columns(a, b, xs, ys, lengths)
    ends = np.concatenate([[[x, y, 0]], np.array([[x, y, 0]]) + np.cumsum(steps, axis=0)])

    def span(i: int, j: int) -> tuple[int, int, int, int, float]:
        (x0, y0, e0), (x1, y1, e1) = ends[i].tolist(), ends[j].tolist()
        return x0, x1, y0, y1, (e1 - e0) / max(x1 - x0, y1 - y0, 1)

    whole = span(0, len(steps))
    if whole[-1] >= identity:
        return [whole]
    # A span whose score is not negative has the identity.
    score = np.concatenate([[0.0], np.cumsum(steps[:, 2] - identity * steps[:, :2].max(axis=1))])
    out, left = [], [(0, len(steps))]
    while left:
        lo, hi = left.pop()
        if max(ends[hi, 0] - ends[lo, 0], ends[hi, 1] - ends[lo, 1]) < least:
            continue
        part = score[lo:hi + 1]
        # From each start the furthest end that is not lower: behind it all is.
        highest = np.maximum.accumulate(part[::-1])[::-1]
        furthest = np.searchsorted(-highest, -(part - 1e-9), side="right") - 1
        size = ends[lo + furthest, 0] - ends[lo:hi + 1, 0]
        i = int(size.argmax())
        j = int(furthest[i])
        if size[i] < least:
            continue
        i, j = lo + i, lo + j
        left += [(lo, i), (j, hi)]
        # Both ends are equal words.
        equal = np.flatnonzero(steps[i:j, 2])
        found = span(i + int(equal[0]), i + int(equal[-1]) + 1)
        if found[1] - found[0] >= least:
            out.append(found)
    return sorted(out)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column (null: empty)."""
    offsets = np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy())])
    return column.flatten().to_numpy(), offsets


def _aligned(identity: float, least: int):
    """Pairs up the two sides of each chain, which come sorted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            out = []
            column = batch.column("words").cast(pa.large_binary())
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] // 4
            words = np.frombuffer(column.buffers()[2] or b"", np.uint32)
            paths = [_lists(batch.column(c)) for c in ("xs", "ys", "lengths")]
            plain = zip(*(batch.column(c).to_pylist() for c in ("side", "chain", "lo", "row", "ref", "run")), strict=True)
            for n, (side, number, lo, row, ref, kind) in enumerate(plain):
                own = words[at[n]:at[n + 1]]
                if side == 0:
                    left = (number, lo, row, ref, kind, own.copy(), *(v[o[n]:o[n + 1]].copy() for v, o in paths))
                    continue
                if left is None or left[0] != number:
                    continue
                _, start, row, ref, kind, a, xs, ys, lengths = left
                for x0, x1, y0, y1, share in good_spans(a, own, (xs - start).tolist(), (ys - lo).tolist(), lengths.tolist(),
                                                        identity, least):
                    out.append((row, ref, kind, x0 + start, x1 + start, y0 + lo, y1 + lo, share))
            if out:
                c = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(v, pa.int64()) for v in c[:2]), pa.array(c[2], pa.bool_()),
                     *(pa.array(v, pa.int64()) for v in c[3:7]), pa.array(c[7], pa.float64())],
                    names=["row", "ref", "run", "start_word", "end_word", "ref_start", "ref_end", "identity"])

    return run


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                      k: int = K, window: int = W, identity: float = IDENTITY, links: tuple[int, ...] = LINKS) -> DataFrame:
    """One row per span of a document that repeats in another: doc_id,
    start_word, end_word, ref_doc_id, ref_start, ref_end, identity,
    passage_start, passage_end.

    Words are runs of non-white-space (ASCII), A-Z lower-cased.  A passage is a
    run of touching spans of at least ``min_words`` words.  The anchor document
    (ref) of a passage is not listed again on its own side.  A document whose
    words are all those of another is one span over the whole text; its copies
    are listed with one document that stands for them.  Null, empty and short
    texts give no row; null ids stay null; repeated rows count as copies; an
    empty table gives an empty result; other columns are not read.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    described = materialise(rows.mapInArrow(
        _describe, "row long, id long, n_words long, first long, body string"), "described")
    texts = described.filter("body is not null").select("row", "body")

    local = texts.filter(F.length("body") > 0).mapInArrow(_local_seeds(k, window), _MATCHES)

    def anchored(local: DataFrame) -> DataFrame:
        # Matches spread by row: a common seed would bring them together.
        deal = F.when(F.col("ref") < 0, F.col("gram")).otherwise(F.xxhash64("row"))
        return local.repartition(n, deal).sortWithinPartitions("gram").mapInArrow(_anchored, _MATCHES)

    def chained(matches: DataFrame, *options) -> DataFrame:
        return matches.filter("row != ref").select("row", "ref", "spot").repartition(n, "row").sortWithinPartitions(
            "row").mapInArrow(_chains(*options), "row long, ref long, xs array<int>, ys array<int>, lengths array<int>")

    matches = materialise(anchored(local), "matches")
    repeating = materialise(matches.repartition(n, "row").sortWithinPartitions("row").mapInArrow(
        _repeating(links, max(links) + MAX_GAP), _MATCHES + ", at array<int>"), "repeating")
    linked = anchored(repeating.filter("at is null").drop("at"))
    # Runs of min_words words have anchors of their own, whatever those of their seeds are.
    repeat = repeating.filter("at is not null").select("row", "at")
    runs = described.filter(F.col("body").isNotNull() & (F.col("n_words") >= min_words)).select("row", "body").join(
        repeat.hint("merge"), "row").select("row", "at", "body").mapInArrow(_whole_windows(k, window, min_words), _MATCHES)
    least = min(MIN_CHAIN, min_words)
    chains = materialise(chained(matches.unionByName(linked), k, least).withColumn("run", F.lit(False)).unionByName(
        chained(anchored(runs), min_words, min_words, False).withColumn("run", F.lit(True)))
        .withColumn("chain", F.monotonically_increasing_id()), "chains")
    discard(matches, repeating)

    # The words of both sides of each chain, with room to extend its ends.  What goes
    # on beyond min_words equal words is a run with a chain of its own.
    room = max(k + window, min_words)

    def side(number: int, row: str, starts: str) -> DataFrame:
        end = F.element_at(starts, -1) + F.element_at("lengths", -1)
        return chains.select("chain", F.lit(number).alias("side"), F.col(row).alias("row"),
                             (F.element_at(starts, 1) - room).alias("lo"), (end + room).alias("hi"))

    wanted = side(0, "row", "xs").unionByName(side(1, "ref", "ys"))
    cut = wanted.join(texts, "row").select("row", "chain", "side", "lo", "hi", "body").mapInArrow(
        _slices, "chain long, side int, lo int, words binary")
    own = chains.select("chain", F.lit(0).alias("side"), "row", "ref", "run", "xs", "ys", "lengths")
    sided = cut.join(own, ["chain", "side"], "left").select(
        "chain", "side", "lo", "words", "row", "ref", "run", "xs", "ys", "lengths")
    spans = materialise(sided.repartition(n, "chain").sortWithinPartitions("chain", "side").mapInArrow(
        _aligned(identity, min(MIN_CHAIN, min_words)), "row long, ref long, run boolean, start_word long, end_word long, ref_start long, ref_end long, "
        "identity double"), "spans")
    # The result reads no text any more.
    ids = materialise(described.select("row", "id", "n_words", "first"), "ids")
    discard(described, chains)
    # A run that lies on both sides inside spans of that length, but for JOIN_GAP words at
    # its ends, adds no passage.
    first = spans.filter("not run")
    long = first.select(F.col("row").alias("text"), F.col("start_word").alias("lo"), F.col("end_word").alias("hi")).unionByName(
        first.select(F.col("ref").alias("text"), F.col("ref_start").alias("lo"), F.col("ref_end").alias("hi"))).filter(
        F.col("hi") - F.col("lo") >= min_words).groupBy("text", "lo").agg(F.max("hi").alias("reach"))

    def inner(text: str, start: str, end: str) -> list:
        return [F.col(text).alias("text"), (F.col(start) + JOIN_GAP).alias("lo"), (F.col(end) - JOIN_GAP).alias("hi")]

    own_side, ref_side = inner("row", "start_word", "end_word"), inner("ref", "ref_start", "ref_end")
    asked = spans.filter("run").select(*own_side).unionByName(spans.filter("run").select(*ref_side)).distinct()
    before = Window.partitionBy("text").orderBy("lo", F.col("hi").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    inside = materialise(asked.unionByName(long, allowMissingColumns=True).withColumn("reach", F.max("reach").over(before)).filter(
        "reach >= hi").select("text", "lo", "hi"), "inside")
    runs_apart = spans.filter("run").withColumn("apart", F.lit(False))
    for of in (own_side, ref_side):
        runs_apart = runs_apart.withColumn("at", F.struct(*of)).join(
            inside.select(F.struct("text", "lo", "hi").alias("at"), F.lit(True).alias("known")), "at", "left").withColumn(
            "apart", F.col("apart") | F.col("known").isNull()).drop("at", "known")
    spans = first.unionByName(runs_apart.filter("apart").drop("apart")).drop("run")
    copies = ids.filter((F.col("first") != F.col("row")) & (F.col("n_words") > 0)).select(
        "row", F.col("first").alias("ref"), F.lit(0).cast("long").alias("start_word"), F.col("n_words").alias("end_word"),
        F.lit(0).cast("long").alias("ref_start"), F.col("n_words").alias("ref_end"), F.lit(1.0).alias("identity"))

    by_row = Window.partitionBy("row").orderBy("start_word", "end_word", "ref", "ref_start")
    reach = F.max("end_word").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.unionByName(copies).withColumn(
        "apart", F.coalesce((F.col("start_word") > reach + JOIN_GAP).cast("int"), F.lit(1))).withColumn(
        "island", F.sum("apart").over(by_row))
    whole = Window.partitionBy("row", "island")
    passages = islands.withColumn("passage_start", F.min("start_word").over(whole)).withColumn(
        "passage_end", F.max("end_word").over(whole)).filter(F.col("passage_end") - F.col("passage_start") >= min_words)
    return (passages.join(ids.select("row", F.col("id").alias("doc_id")), "row")
            .join(ids.select(F.col("row").alias("ref"), F.col("id").alias("ref_doc_id")), "ref")
            .select("doc_id", "start_word", "end_word", "ref_doc_id", "ref_start", "ref_end", "identity",
                    "passage_start", "passage_end"))
