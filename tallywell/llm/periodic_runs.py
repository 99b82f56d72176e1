"""Periodic runs of words: suffix trees of a text and its reversal answer longest common extensions.

Ukkonen's algorithm builds both trees. A walk over the first lists its leaves and, between
neighbouring leaves, the depth of the shallowest node passed: of the Euler tour that is all
that a lowest common ancestor of two leaves needs, and a table of minima over powers of two
answers it in constant time. The longest Lyndon word at each position, in the order of the
words and in the reverse order, is a root candidate (every run has one among them); it is
extended to the right by the text's tree and to the left by the reversal's.

A word that stands less than three times in a stretch is in no run of three periods there, and
a sequence of eight words that stands once is in none either, so a text is first cut at these,
again and again, and trees are built of all that is left.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import id_and_text, text_batches

#: Least words and least periods of a run.
LEAST_WORDS = 24
LEAST_PERIODS = 3

_OPEN = 1 << 60


class SuffixTree:
    """Ukkonen's tree of ``codes`` (1 and above) and a terminator 0, with constant-time common extensions."""

    def __init__(self, codes: list[int]):
        self.size = len(codes)
        self._grow([*codes, 0])
        leaves, depths = self._tour(reverse=False)
        self.rank = np.empty(self.size + 1, np.int64)
        self.rank[leaves] = np.arange(self.size + 1)
        self.minima = [np.array(depths, np.int32)]
        width = 1
        while 2 * width <= len(depths):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _grow(self, s: list[int]) -> None:
        self.radix = radix = max(s) + 1
        start, end, link = [0], [0], [0]
        edges: dict[int, int] = {}
        node = edge = length = waiting = 0
        for i, c in enumerate(s):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    edge = i
                key = node * radix + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i)
                    end.append(_OPEN)
                    link.append(0)
                    link[unlinked] = node if unlinked else 0
                    unlinked = 0
                else:
                    span = end[child] - start[child]
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    at = start[child] + length
                    if s[at] == c:
                        link[unlinked] = node if unlinked else 0
                        length += 1
                        break
                    middle = len(start)
                    edges[key] = middle
                    edges[middle * radix + c] = middle + 1
                    edges[middle * radix + s[at]] = child
                    start += (start[child], i)
                    end += (at, _OPEN)
                    link += (0, 0)
                    start[child] = at
                    link[unlinked] = middle if unlinked else 0
                    unlinked = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.start, self.end = start, end
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        children = np.fromiter(edges.values(), np.int64, len(edges))
        order = np.argsort(keys)
        self.parents, self.letters = keys[order] // radix, keys[order] % radix
        self.children = children[order]

    def _tour(self, reverse: bool) -> tuple[list[int], list[int]]:
        """Suffixes in order, and the depths of the shallowest nodes between neighbours; the terminator is least either way."""
        key = np.where(self.letters == 0, 0, self.radix - self.letters) if reverse else self.letters
        order = np.lexsort((-key, self.parents))
        children = self.children[order].tolist()
        first = np.searchsorted(self.parents[order], np.arange(len(self.start) + 1)).tolist()
        start, end, size = self.start, self.end, self.size
        leaves, depths, shallowest = [], [], 0
        stack = [(0, 0, 0)]
        while stack:
            node, depth, above = stack.pop()
            shallowest = min(shallowest, above)
            if end[node] == _OPEN:
                leaves.append(start[node] - depth)
                depths.append(shallowest)
                shallowest = size
                continue
            depth += end[node] - start[node]
            stack += [(child, depth, depth) for child in children[first[node] : first[node + 1]]]
        return leaves, depths[1:]

    def rank_reversed(self) -> np.ndarray:
        """Places of the suffixes when words are ordered the other way round."""
        rank = np.empty(self.size + 1, np.int64)
        rank[self._tour(reverse=True)[0]] = np.arange(self.size + 1)
        return rank

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of the suffixes at ``i`` and at ``j``, which differ."""
        a, b = self.rank[i], self.rank[j]
        low, width = np.minimum(a, b), np.abs(a - b)
        level = np.frexp(width)[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            of = level == k
            table = self.minima[k]
            out[of] = np.minimum(table[low[of]], table[low[of] + width[of] - (1 << int(k))])
        return out


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """By position, where its longest Lyndon word ends: at the next suffix that is smaller."""
    ranks, ends, waiting = rank.tolist(), [0] * (len(rank) - 1), []
    for j, r in enumerate(ranks):
        while waiting and ranks[waiting[-1]] > r:
            ends[waiting.pop()] = j
        waiting.append(j)
    return np.array(ends, np.int64)


def _once(codes: np.ndarray, width: int) -> np.ndarray:
    """Places where a sequence of ``width`` codes begins that stands once only."""
    grams, covered = codes, 1
    while covered < width:
        step = min(covered, width - covered)
        pairs = grams[:-step] * (int(grams.max()) + 1) + grams[step:]
        _, grams = np.unique(pairs, return_inverse=True)
        covered += step
    return np.flatnonzero(np.bincount(grams)[grams] == 1)


def stretches(codes: np.ndarray, least_words: int = LEAST_WORDS) -> list[tuple[int, np.ndarray]]:
    """Places and codes of the stretches that can hold runs.

    In a run every word stands three times at least, and as it has three periods and
    ``least_words`` words, every sequence of a third of ``least_words`` stands twice.
    """
    done, waiting, width = [], [(0, codes)], max(1, least_words // LEAST_PERIODS)
    while waiting:
        at, part = waiting.pop()
        if len(part) < least_words:
            continue
        _, part, counts = np.unique(part, return_inverse=True, return_counts=True)
        cuts, reach = np.flatnonzero(counts[part] < LEAST_PERIODS), 1
        if not len(cuts):
            cuts, reach = _once(part, width), width
        if not len(cuts):
            done.append((at, part))
            continue
        borders = np.concatenate([[-1], cuts, [len(part) - reach + 1]])
        starts, stops = borders[:-1] + 1, borders[1:] + reach - 1
        for k in np.flatnonzero(stops - starts >= least_words):
            waiting.append((at + starts[k], part[starts[k] : stops[k]]))
    return done


def _runs_of_stretch(codes: np.ndarray, least_words: int) -> np.ndarray:
    n, letters = len(codes), (codes + 1).tolist()
    tree = SuffixTree(letters)
    place = np.arange(n)
    roots = [(place, lyndon_ends(rank) - place) for rank in (tree.rank, tree.rank_reversed())]
    i, period = np.unique(np.concatenate([np.stack(r, 1) for r in roots]), axis=0).T
    right = tree.common(i, i + period)
    # The first root of a run starts within its first period, so that over a period of the rest lies to its right.
    able = (right >= (LEAST_PERIODS - 2) * period) & (LEAST_PERIODS * (right + period) >= (LEAST_PERIODS - 1) * least_words)
    i, period, right = i[able], period[able], right[able]
    if not len(i):
        return np.empty((0, 3), np.int64)
    left = np.zeros(len(i), np.int64)
    inner = i > 0
    # Position x of the text is n - 1 - x of the reversal.
    left[inner] = SuffixTree(letters[::-1]).common(n - i[inner], n - i[inner] - period[inner])
    start, length = i - left, left + period + right
    long = length >= np.maximum(least_words, LEAST_PERIODS * period)
    return np.unique(np.stack([start, period, length], 1)[long], axis=0)


def find_runs(codes: np.ndarray, least_words: int = LEAST_WORDS) -> np.ndarray:
    """Rows ``start, period, length`` of all runs, by start, then period."""
    found = [_runs_of_stretch(part, least_words) + [at, 0, 0] for at, part in stretches(codes, least_words)]
    found = np.concatenate([np.empty((0, 3), np.int64), *found])
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 1], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 2], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(steps[:-1]) == 0)] if len(runs) else words


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest exact length by period; the first by start, then period, of equal ones."""
    best = None
    for start, period, length in runs.tolist():
        if best is None or length * best[1] > best[2] * period:
            best = (start, period, length)
    return best


def with_planted_runs(words: list, doc_id: int | None) -> list:
    """The contract's rule: in every tenth document by crc32 of its id, the words from a place on repeat."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    again = words[a : a + p]
    return words[:a] + (again * ((n - a) // p + 1))[: n - a]


def _codes(words: list) -> np.ndarray:
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """Per row: all runs of its text, the strongest of them, and the text with runs collapsed to their first period.

    ``doc_id``, ``runs`` (array of start, period, length by start, then period), ``start``, ``length``
    and ``period`` of the strongest run (null without one) and ``collapsed_text`` (kept words joined by
    one space). A null or empty text or one under 24 words has no run; repeated rows are rows of their
    own; equally strong runs go by start, then period; extra columns are left behind. ``planted``
    repeats words by the rule of ``with_planted_runs`` first; a null id counts as the empty text there.
    Rows are independent, so nothing is shuffled, and a lost task repeats its rows only.
    """
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("period", pa.int64()), ("length", pa.int64())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs, best, texts = [], [], []
        texts_in = batch.column("text").cast(pa.large_binary())
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_in):
            words = text.as_py().split()
            if planted:
                words = with_planted_runs(words, doc_id)
            found = find_runs(_codes(words)) if len(words) >= LEAST_WORDS else np.empty((0, 3), np.int64)
            runs.append([dict(zip(("start", "period", "length"), r)) for r in found.tolist()])
            best.append(strongest(found) or (None, None, None))
            texts.append(b" ".join(collapsed(words, found)).decode())
        columns = [batch.column("doc_id"), pa.array(runs, pa.list_(run))]
        columns += [pa.array([b[k] for b in best], pa.int64()) for k in (0, 2, 1)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], ["doc_id", "runs", "start", "length", "period", "collapsed_text"])

    fields = f"doc_id {kind}, runs array<struct<start:long,period:long,length:long>>, start long, length long, period long, collapsed_text string"
    return rows.mapInArrow(text_batches(work), fields)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from those of ``periodic_runs``; all texts and lists become digests in expressions."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "start",
        "length",
        "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
