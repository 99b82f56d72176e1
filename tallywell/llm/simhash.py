"""SimHash near-duplicates by a self-join of a binary trie.

Node pairs of the trie are traversed together from the root; each step down adds
the bits in which the two nodes differ, and pairs over the error budget are left.
The upper part of the traversal deals the fingerprints out: the nodes of the trie
that hold few enough fingerprints are the groups, and a fingerprint visits every
group it can reach within the budget. The lower part runs inside each group.
"""

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import id_and_text, materialize, text_batches

SHINGLE_WORDS = 3
SEED = 42
BUDGET = 3

#: Fingerprints in a node of the trie that is not split further, as long as the depth allows.
GROUP_FINGERPRINTS = 8192
TOP_BITS = 16

#: Node pairs that a task has in hand at a time.
PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64 bits; each is 1 if it is set in over half of the shingle hashes."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    size = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(size))))
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64, len(words) - size + 1)
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        part = hashes[a : a + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``bits`` (the fingerprint as a signed long) of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits.view(np.int64))], ["doc_id", "bits"])

    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(text_batches(work), f"doc_id {kind}, bits long")


class TopTrie:
    """The upper part of the trie, from the counts by the first bits. Node 1 is the root, 2n and 2n + 1 are below n."""

    def __init__(self, counts: np.ndarray, most: int = GROUP_FINGERPRINTS):
        self.depth = int(len(counts)).bit_length() - 1
        levels = [np.asarray(counts, np.int64)]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        self.counts = np.concatenate([np.zeros(1, np.int64), *reversed(levels)])
        self.leaf = self.counts <= most
        self.leaf[1 << self.depth :] = True

    def visits(self, tops: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For first bits, all leaves in reach: rows (place in ``tops``, leaf, differing bits)."""
        found = []
        who, node, off = np.arange(len(tops)), np.ones(len(tops), np.int64), np.zeros(len(tops), np.int64)
        for depth in range(self.depth + 1):
            at_leaf = self.leaf[node]
            found.append((who[at_leaf], node[at_leaf], off[at_leaf]))
            who, node, off = who[~at_leaf], node[~at_leaf], off[~at_leaf]
            if not len(who):
                break
            bit = tops[who] >> (self.depth - 1 - depth) & 1
            who, node, off = np.tile(who, 2), np.concatenate([2 * node + bit, 2 * node + 1 - bit]), np.concatenate([off, off + 1])
            near = (off <= budget) & (self.counts[node] > 0)
            who, node, off = who[near], node[near], off[near]
        return tuple(np.concatenate(x) for x in zip(*found))


def trie_pairs(a: np.ndarray, b: np.ndarray | None, budget: int = BUDGET) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of all pairs within the budget: of sorted ``a`` with sorted ``b``, or among ``a`` if ``b`` is None.

    A node is a range of a sorted array with a common prefix. Pairs of nodes go down
    one bit at a time; small ones are compared directly. Yields bounded blocks.
    """
    own = b is None
    b = a if own else b
    ones = {}

    def split(values: np.ndarray, side: str, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        if (side, bit) not in ones:
            ones[side, bit] = np.concatenate([[0], np.cumsum(values >> np.uint64(63 - bit) & np.uint64(1), dtype=np.int64)])
        count = ones[side, bit]
        return hi - (count[hi] - count[lo])

    start = np.array([[0, len(a), 0, len(b), 0]], np.int64)
    waiting = [(0, start)] if len(a) and len(b) else []
    while waiting:
        bit, nodes = waiting.pop()
        if len(nodes) > PAIRS_AT_ONCE:
            half = len(nodes) // 2
            waiting += [(bit, nodes[:half]), (bit, nodes[half:])]
            continue
        small = ((nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= 16) | (bit == 64)
        yield from _compare(a, b, nodes[small], budget, own)
        nodes = nodes[~small]
        if not len(nodes):
            continue
        alo, ahi, blo, bhi, off = nodes.T
        amid = split(a, "a", alo, ahi, bit)
        bmid = amid if own and a is b and np.array_equal(alo, blo) else split(b, "a" if own else "b", blo, bhi, bit)
        same = own & (alo == blo)
        down = [
            np.stack([alo, amid, blo, bmid, off], 1),
            np.stack([amid, ahi, bmid, bhi, off], 1),
            np.stack([alo, amid, bmid, bhi, off + 1], 1),
            np.stack([amid, ahi, blo, bmid, off + 1], 1)[~same],
        ]
        nodes = np.concatenate(down)
        near = (nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3]) & (nodes[:, 4] <= budget)
        if near.any():
            waiting.append((bit + 1, nodes[near]))


def _compare(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, budget: int, own: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
    ends = np.cumsum(sizes)
    at = 0
    while at < len(nodes):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), "right")))
        part, n = nodes[at:upto], sizes[at:upto]
        which = np.repeat(np.arange(len(part)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = (part[:, 3] - part[:, 2])[which]
        i, j = part[which, 0] + step // width, part[which, 2] + step % width
        near = np.bitwise_count(a[i] ^ b[j]) <= budget
        if own:
            near &= i < j
        yield i[near], j[near]
        at = upto


def _join(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the sets of i and j; each set is named by its smallest place, and every place knows it."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def group_links(resident: np.ndarray, visitor: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group, reduced to one per fingerprint: to the smallest it reaches inside the group."""
    everything = np.concatenate([resident, visitor])
    parent = np.arange(len(everything))
    for i, j in trie_pairs(resident, None, budget):
        _join(parent, i, j)
    for i, j in trie_pairs(resident, visitor, budget):
        _join(parent, i, j + len(resident))
    linked = np.flatnonzero(parent != np.arange(len(everything)))
    return everything[linked], everything[parent[linked]]


def links(distinct: DataFrame, budget: int = BUDGET, most: int = GROUP_FINGERPRINTS) -> DataFrame:
    """Links ``a, b`` between different values of ``bits``, as many as keep what is connected connected.

    ``distinct`` has every value once. The counts by the first 16 bits (65,536 numbers
    at most) shape the upper trie; everything else stays in tasks.
    """
    top = F.shiftrightunsigned("bits", 64 - TOP_BITS).cast("int")
    counts = np.zeros(1 << TOP_BITS, np.int64)
    for row in distinct.groupBy(top.alias("top")).agg(F.count("*").alias("n")).collect():
        counts[row["top"]] = row["n"]
    trie = TopTrie(counts, most)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.sort(batch.column("bits").to_numpy().view(np.uint64))
            tops, first = np.unique(bits >> np.uint64(64 - TOP_BITS), return_index=True)
            ends = np.append(first[1:], len(bits))
            for a in range(0, len(tops), 4096):
                part = tops[a : a + 4096].astype(np.int64)
                who, leaf, off = trie.visits(part, budget)
                home = np.zeros(len(part), np.int64)
                home[who[off == 0]] = leaf[off == 0]
                going = (off == 0) | (leaf > home[who])
                who, leaf, off = who[going] + a, leaf[going], off[going]
                order = np.lexsort((who, off > 0, leaf))
                who, leaf, visiting = who[order], leaf[order], off[order] > 0
                borders = np.flatnonzero(np.append(True, (leaf[1:] != leaf[:-1]) | (visiting[1:] != visiting[:-1])))
                rows = [np.concatenate([bits[first[w] : ends[w]] for w in who[x:y]]) for x, y in zip(borders, np.append(borders[1:], len(who)))]
                columns = [pa.array(leaf[borders]), pa.array(visiting[borders]), pa.array([r.tobytes() for r in rows], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["leaf", "visiting", "packed"])

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for visiting in (False, True):
            packed = b"".join(group.loc[group["visiting"] == visiting, "packed"])
            sides.append(np.unique(np.frombuffer(packed, np.uint64)))
        a, b = group_links(*sides, budget)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("bits").mapInArrow(deal, "leaf long, visiting boolean, packed binary")
    return materialize(dealt.groupBy("leaf").applyInPandas(meet, "a long, b long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of an edge ``a, b``; root is one node of the component.

    Every node points to the first of its neighbours and itself in a random order that is
    new in each round, and the edges move to what their ends point to, until none is left.
    Long chains shrink by a constant share per round, whatever their values. Rounds are
    written to the shared folder. A hub costs one row per task in the aggregation, and
    adaptive execution splits it in the joins.
    """
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = [F.struct(F.xxhash64(c, F.lit(len(rounds))).alias("rank"), F.col(c).alias("node")) for c in "ab"]
        pointed = both.select("a", ranked[0].alias("own"), ranked[1].alias("other")).groupBy("a").agg(F.min(F.least("own", "other")).alias("first"))
        parents = materialize(pointed.select(F.col("a").alias("node"), F.col("first.node").alias("root")), "parents")
        rounds.append(parents)
        left = parents.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = parents.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(left, "a").join(right, "b").where("ra <> rb")
        edges = materialize(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[-1]
    for parents in reversed(rounds[:-1]):
        higher = found.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        found = parents.join(higher, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    A component is what links of ``budget`` or fewer differing bits connect; its id is the
    smallest doc_id in it, null only if all are null. Copies share a fingerprint and enter
    the join once. A text without words has fingerprint zero and is linked like any other.
    """
    rows = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = materialize(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct")
    joined = components(links(distinct, budget)).withColumnRenamed("node", "bits")
    named = distinct.join(joined, "bits", "left").select("bits", "least", F.coalesce("root", "bits").alias("root"))
    named = materialize(named, "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(smallest, "root").select("bits", "component_id")
    shown = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return rows.join(ids, "bits").select("doc_id", shown, "component_id")



def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id (null first), then of the first copy.

    Rows are written with a key, so that repeated and null ids are told apart.
    """
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = materialize(docs.select(whole, F.monotonically_increasing_id().alias("key")), "keyed")
    ids = rows.select(F.struct(F.col("row").getField(id_col), F.col("key")).alias("id"), F.col("row").getField(text_col).alias("text"))
    found = near_duplicates(ids, "id", "text", budget)
    kept = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id.key")
    return rows.join(kept, "key", "left_semi").select("row.*")
