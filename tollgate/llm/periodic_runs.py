"""Periodic runs of words by constant-time longest common extensions.

A run is a maximal stretch of words with smallest period q.  Runs come from
suffix trees, built online (Ukkonen) of the words and of their reversal; an
Euler tour of each tree and a sparse table over the tour's depths answer the
longest common extension of any two positions in constant time.  The longest
Lyndon word that starts at a position is a candidate root; there is one by
each of two opposite orders of the words, read off the tree's leaves.  Each
candidate is extended to both sides by its period.  Every run with at least
two periods has a root among the candidates.

Trees are built only over stretches that can hold a run: inside a run of
period q, all 4-grams after the first q recur at a distance of at most q.  A
text is cut into the unions of such stretches for q up to 1, 2, 4, 8, ...; the
condition is necessary, so no run is lost or cut.  Memory grows with the
longest such stretch of one text.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.textarrays import BLOCK, Words, blocks, mix, words

LEAST, EXPONENT = 6, 4
GRAM = 4

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


class SuffixTree:
    """Suffix tree of a sequence of positive integers, closed by a 0."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        n = len(s)
        first, last, link, kids = [0], [0], [0], [{}]
        self.leaf = leaf = [-1]  # the suffix of a leaf, -1 for inner nodes
        node = edge = length = pending = made = 0
        for i, c in enumerate(s):
            waiting = 0  # inner node of this step that still has no link
            pending += 1
            while pending:
                if not length:
                    edge = i
                branch = kids[node]
                below = branch.get(s[edge])
                if below is None:
                    branch[s[edge]] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    kids.append(None)
                    leaf.append(made)
                    made += 1
                    if waiting:
                        link[waiting] = node
                        waiting = 0
                else:
                    size = last[below] - first[below]
                    if length >= size:
                        node = below
                        edge += size
                        length -= size
                        continue
                    at = first[below] + length
                    if s[at] == c:
                        length += 1
                        if waiting:
                            link[waiting] = node
                        break
                    split = len(first)
                    first += [first[below], i]
                    last += [at, n]
                    link += [0, 0]
                    kids += [{s[at]: below, c: split + 1}, None]
                    leaf += [-1, made]
                    made += 1
                    branch[s[edge]] = split
                    first[below] = at
                    if waiting:
                        link[waiting] = split
                    waiting = split
                pending -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - pending + 1
        self.n, self.first, self.last, self.kids = n, first, last, kids

    def leaves(self, falling: bool = False) -> np.ndarray:
        """Rank of every suffix; with ``falling``, by the opposite order of the
        symbols.  A prefix ranks before what it begins, either way."""
        rank = np.empty(self.n, np.int64)
        stack, place = [0], 0
        kids, leaf = self.kids, self.leaf
        while stack:
            node = stack.pop()
            if leaf[node] >= 0:
                rank[leaf[node]] = place
                place += 1
                continue
            branch = kids[node]
            if falling:  # popped from the end: 0, then the largest first
                order = sorted(branch)
                if order[0] == 0:
                    order = [*order[1:], 0]
            else:
                order = sorted(branch, reverse=True)
            stack += [branch[c] for c in order]
        return rank

    def extensions(self) -> "Extensions":
        """The Euler tour with its depths."""
        depth, seen = [], np.empty(self.n, np.int64)
        first, last, kids, leaf = self.first, self.last, self.kids, self.leaf
        stack = [(0, 0)]
        while stack:
            node, d = stack.pop()
            if node < 0:  # back at an inner node
                depth.append(d)
                continue
            if leaf[node] >= 0:
                seen[leaf[node]] = len(depth)
                depth.append(self.n - leaf[node])
                continue
            depth.append(d)
            for child in kids[node].values():
                stack.append((-1, d))
                stack.append((child, d + last[child] - first[child]))
        return Extensions(np.array(depth, np.int32), seen)


class Extensions:
    """Longest common extensions: least depth of a tour between two leaves."""

    def __init__(self, depth: np.ndarray, seen: np.ndarray):
        self.seen = seen
        self.table = [depth]
        width = 1
        while 2 * width <= len(depth):
            row = self.table[-1]
            self.table.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        left, right = self.seen[a], self.seen[b]
        left, right = np.minimum(left, right), np.maximum(left, right)
        level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
        out = np.empty(len(left), np.int64)
        for k in np.unique(level).tolist():
            chosen = np.flatnonzero(level == k)
            row = self.table[k]
            out[chosen] = np.minimum(row[left[chosen]], row[right[chosen] + 1 - (1 << k)])
        return out


def _next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each position the next one with a smaller rank (or the end)."""
    n = len(rank)
    out = [n] * n
    open_, values = [], rank.tolist()
    for i, v in enumerate(values):
        while open_ and values[open_[-1]] > v:
            out[open_.pop()] = i
        open_.append(i)
    return np.array(out, np.int64)


def runs_of(symbols: list[int], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs with length >= max(least,
    exponent * period), by start and period; ``exponent`` is at least 2."""
    n = len(symbols)
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    if n < max(least, exponent):
        return []
    tree = SuffixTree(symbols)
    forward, backward = tree.extensions(), SuffixTree(symbols[::-1]).extensions()
    at = np.arange(n)
    start, period = [], []
    for falling in (False, True):
        start.append(at)
        period.append(_next_smaller(tree.leaves(falling)[:n]) - at)
    i, p = np.concatenate(start), np.concatenate(period)
    right, left = np.zeros(2 * n, np.int64), np.zeros(2 * n, np.int64)
    inner = np.flatnonzero(i + p < n)
    right[inner] = forward(i[inner], i[inner] + p[inner])
    inner = np.flatnonzero(i > 0)
    left[inner] = backward(n - i[inner], n - i[inner] - p[inner])
    length = left + p + right
    found = np.flatnonzero(length >= np.maximum(least, exponent * p))
    return sorted(set(zip((i - left)[found].tolist(), length[found].tolist(), p[found].tolist(), strict=True)),
                  key=lambda r: (r[0], r[2]))


def stretches(w: Words, least: int = LEAST, exponent: int = EXPONENT, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint word intervals of the block that hold every run whole, with a
    word to either side where the text has one."""
    n = len(w.hash)
    none = np.zeros(0, np.int64)
    if n < gram:
        return none, none
    text = np.repeat(np.arange(len(w.offsets) - 1), w.counts)
    h = mix(text[:n - gram + 1].astype(np.uint64))
    for j in range(gram):
        h = mix(h ^ w.hash[j:n - gram + 1 + j])
    whole = text[:n - gram + 1] == text[gram - 1:]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    back = np.full(len(h), n + 1, np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    back[~whole] = n + 1
    near = np.flatnonzero(back <= n)
    longest = int(w.counts.max())
    marks = np.zeros(n + 1, np.int64)
    scale, smallest = 1, 1  # of the periods smallest .. scale
    while len(near) and exponent * smallest <= longest:
        need = max(1, max(least, exponent * smallest) - (gram - 1) - smallest)
        chosen = near[back[near] <= scale]
        if len(chosen):
            cut = np.flatnonzero((np.diff(chosen) > 1) | (text[chosen[1:]] != text[chosen[:-1]]))
            begin = np.concatenate([[0], cut + 1])
            end = np.concatenate([cut + 1, [len(chosen)]])
            long = end - begin >= need
            a, b = chosen[begin[long]], chosen[end[long] - 1]
            lo = np.maximum(a - scale - 1, w.offsets[text[a]])
            hi = np.minimum(b + gram + 1, w.offsets[text[a] + 1])
            np.add.at(marks, lo, 1)
            np.add.at(marks, hi, -1)
        smallest, scale = scale + 1, scale * 2
    covered = np.cumsum(marks[:n]) > 0
    if not covered.any():
        return none, none
    fresh = np.ones(n, bool)
    fresh[1:] = ~covered[:-1] | (text[1:] != text[:-1])
    ends = np.ones(n, bool)
    ends[:-1] = ~covered[1:] | (text[1:] != text[:-1])
    return np.flatnonzero(covered & fresh), np.flatnonzero(covered & ends) + 1


def _numbered(sequence: list[bytes]) -> list[int]:
    """Words as integers from 1, equal words alike."""
    seen: dict[bytes, int] = {}
    return [seen.setdefault(x, len(seen) + 1) for x in sequence]


def _find(rewrite: Rewrite | None, least: int, exponent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for block in blocks(batch.column("body"), BLOCK):
                texts = []
                for i in range(block.n):
                    own = block.text(i).split()
                    if rewrite is not None:
                        own = rewrite(ids[block.first + i].as_py(), own)
                    texts.append(own)
                plain = pa.array([b" ".join(t) for t in texts], pa.large_binary()).cast(pa.large_string())
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                for part in blocks(plain, 4 * BLOCK):
                    w = words(part)
                    for a, b in zip(*(x.tolist() for x in stretches(w, least, exponent)), strict=True):
                        at = int(np.searchsorted(w.offsets, a, side="right")) - 1
                        lo, hi = a - int(w.offsets[at]), b - int(w.offsets[at])
                        own = texts[part.first + at]
                        found[part.first + at] += [(lo + s, n, q) for s, n, q in
                                                   runs_of(_numbered(own[lo:hi]), least, exponent)]
                collapsed = plain.to_pylist()
                for i, runs in enumerate(found):
                    if runs:
                        keep = np.ones(len(texts[i]), bool)
                        for s, n, q in runs:
                            keep[s + q:s + n] = False
                        collapsed[i] = b" ".join([t for t, k in zip(texts[i], keep.tolist(), strict=True) if k]).decode()
                yield pa.RecordBatch.from_arrays([
                    ids[block.first:block.first + block.n],
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found], pa.list_(
                        pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    pa.array(collapsed, pa.string())], names=["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST,
                  exponent: int = EXPONENT, rewrite: Rewrite | None = None) -> DataFrame:
    """One row per input row: doc_id, runs (start, length, period; words from
    0; by start and period) and collapsed, the words joined by one space
    without those that some run holds after its first period.

    ``rewrite`` gets the id and the words of a text and returns the words to
    work on.  Null and empty texts have no runs and an empty ``collapsed``;
    null ids and repeated rows each have their row; an empty table gives an
    empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    return rows.mapInArrow(_find(rewrite, least, exponent), "doc_id long, runs array<struct<start: long, length: long, "
                                                            "period: long>>, collapsed string")


def planted_repeats(doc_id: int | None, own: list[bytes]) -> list[bytes]:
    """The words that the query works on: every tenth id by its crc32 has its
    words from one place on repeated with one period (null ids: unchanged)."""
    n = len(own)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or not n or h % 10:
        return own
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return own[:a] + [own[a + (i - a) % p] for i in range(a, n)]


def run_digests(found: DataFrame) -> DataFrame:
    """The digest columns of ``periodic_runs``: n_runs, the longest run (ties:
    smallest start, then period) and the hashes of all runs and of the
    collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"),
                                                              r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
        (-F.col("_best.less")).alias("length"), F.col("_best.period").alias("period"),
        F.floor(-1000 * F.col("_best.less") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
