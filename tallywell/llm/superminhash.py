"""Near-duplicates by SuperMinHash: correlated ranks per shingle, banding, verification, union of links.

Every shingle draws a random permutation of the registers, one place per step, and offers
step + fraction to the register of that place. As no later step can offer less, a text is
done when the greatest of its registers is below the next step: texts of many shingles stop
after one step. Registers are banded into buckets, pairs that share a bucket are confirmed on
their full sets, and confirmed links are united into components.
"""

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.common import bitmap_of, id_and_text, in_slices, materialize
from tallywell.llm.simhash import components

SHINGLE_WORDS = 4
#: Least similarity in percent, compared in whole numbers.
LEAST_PERCENT = 80

#: A pair at 0.8 shares no band with a chance of (1 - 0.8^4)^32, about 5 in 10^8.
BANDS = 32
BAND_REGISTERS = 4

#: Text turned into registers at a time.
SLICE_BYTES = 1 << 20

#: Classes of a bucket that meet all others, by rank; what is left then is compared in blocks.
PIVOTS = (1, 16)
BLOCK_CLASSES = 512

#: Bits by which texts that need verification are told from others: a fixed 8 MB, whatever the input.
FILTER_BITS = 26


def shingle_hashes(words: list[bytes], size: int = SHINGLE_WORDS) -> np.ndarray:
    """The set of shingles as sorted 64-bit hashes; with fewer words, the whole sequence is one."""
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    digest = xxhash.xxh3_64_intdigest
    shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(size))))
    return np.unique(np.fromiter(map(digest, shingles), np.uint64, len(words) - size + 1))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def super_minhash(sets: list[np.ndarray], registers: int = BANDS * BAND_REGISTERS) -> np.ndarray:
    """Registers of every set (rows), each step in the upper and its fraction in the lower 32 bits."""
    out = np.full((len(sets), registers), np.iinfo(np.uint64).max)
    sizes = np.array([len(s) for s in sets], np.int64)
    hashes = np.concatenate([np.empty(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    places = None
    for step in range(registers):
        if not len(hashes):
            break
        drawn = _mixed(hashes + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        at = step + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(registers - step) >> np.uint64(32)).astype(np.int64)
        if places is None:
            register = at
        else:
            each = np.arange(len(hashes))
            register = places[each, at].astype(np.int64)
            places[each, at] = places[:, step]
            places[:, step] = register
        np.minimum.at(out.reshape(-1), owner * registers + register, np.uint64(step << 32) | drawn >> np.uint64(32))
        open_sets = out.max(axis=1) >= np.uint64(step + 1 << 32)
        left = open_sets[owner]
        hashes, owner, at = hashes[left], owner[left], at[left]
        if places is None:
            kind = np.uint8 if registers <= 256 else np.uint16
            places = np.tile(np.arange(registers, dtype=kind), (len(hashes), 1))
            places[np.arange(len(hashes)), at] = 0
            places[:, 0] = at
        else:
            places = places[left]
    return out


def buckets(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit bucket per band of every row of registers."""
    rows = signature.reshape(len(signature), bands, -1)
    found = np.broadcast_to(np.arange(bands, dtype=np.uint64), rows.shape[:2])
    for k in range(rows.shape[2]):
        found = _mixed(found * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, k])
    return found


def _words(text: bytes) -> tuple[list[bytes], bytes]:
    words = text.lower().split()
    return words, hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, ``key`` (digest of its words in order), ``n_shingles`` and ``buckets`` (empty without words)."""
    rows = id_and_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, most=SLICE_BYTES):
                keys, known = [], {}
                for text in part.column("text").cast(pa.large_binary()):
                    words, key = _words(text.as_py())
                    keys.append(key)
                    if key not in known:
                        known[key] = shingle_hashes(words)
                found = dict(zip(known, buckets(super_minhash(list(known.values()))).view(np.int64)))
                n = pa.array([len(known[k]) for k in keys], pa.int64())
                dealt = pa.array([found[k] if len(known[k]) else [] for k in keys], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(keys, pa.binary()), n, dealt], ["doc_id", "key", "n_shingles", "buckets"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, key binary, n_shingles long, buckets array<long>")


def _slot(key: bytes, doc_id: object) -> int:
    """Place of a row among the filter bits."""
    return xxhash.xxh3_64_intdigest(key + repr(doc_id).encode()) >> (64 - FILTER_BITS)


def _filter_bits(wanted: DataFrame) -> bytes:
    """The slots of the wanted rows as one bitmap of a fixed size, united from the bitmaps of tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = [_slot(k, d) for k, d in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64())], ["slot"])

    return bitmap_of(wanted.select("key", F.col("least").alias("doc_id")).mapInArrow(run, "slot long"), FILTER_BITS)


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``cid`` and ``hashes`` (the sorted set, packed) of the wanted classes ``cid, key, least``.

    A text is hashed and shuffled only if its bit in the filter is set; the join removes the few others.
    """
    rows = id_and_text(docs, id_col, text_col)
    bits = rows.sparkSession.sparkContext.broadcast(_filter_bits(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = bits.value
        for batch in batches:
            for part in in_slices(batch, most=SLICE_BYTES):
                keys, sets = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.large_binary())):
                    words, key = _words(text.as_py())
                    slot = _slot(key, doc_id)
                    if words and marked[slot >> 3] >> (slot & 7) & 1:
                        keys.append(key)
                        sets.append(shingle_hashes(words).tobytes())
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], ["key", "hashes"])

    read = rows.mapInArrow(run, "key binary, hashes binary")
    return read.join(wanted.select("key", "cid"), "key").dropDuplicates(["cid"]).select("cid", "hashes")


def shared_shingles(sets: DataFrame) -> DataFrame:
    """``cid``, ``n_shingles`` and ``shared``: how many of its shingles stand in another set, at least.

    The shingles that stand in two sets or more are kept as a bitmap of a fixed size, so a
    few others may count as shared, but never the other way round.
    """

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        hashes, n = np.unique(np.concatenate(sets), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["hash", "n"])

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting: list[np.ndarray] = []
            for packed in batch.column("hashes"):
                waiting.append(np.frombuffer(packed.as_buffer(), np.uint64))
                if waiting[-1].nbytes > SLICE_BYTES or len(waiting) == 1024:
                    yield counted(waiting)
                    waiting = []
            if waiting:
                yield counted(waiting)

    often = sets.mapInArrow(counts, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1")
    bits = sets.sparkSession.sparkContext.broadcast(bitmap_of(often.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).alias("slot")), FILTER_BITS))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(bits.value, np.uint8)
        for batch in batches:
            sizes, shared = [], []
            for packed in batch.column("hashes"):
                slots = np.frombuffer(packed.as_buffer(), np.uint64) >> np.uint64(64 - FILTER_BITS)
                sizes.append(len(slots))
                shared.append(int((marked[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1).sum()))
            yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(sizes, pa.int64()), pa.array(shared, pa.int64())], ["cid", "n_shingles", "shared"])

    return sets.mapInArrow(measure, "cid long, n_shingles long, shared long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = LEAST_PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("cid").alias("a"), F.col("hashes").alias("left")), "a")
    both = both.join(sets.select(F.col("cid").alias("b"), F.col("hashes").alias("right")), "b").select("a", "b", "left", "right")

    def linked(left: bytes, right: bytes) -> bool:
        x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * shared >= percent * (len(x) + len(y) - shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("left"), batch.column("right"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def _may_link(percent: int) -> Column:
    """Whether two sets can be similar enough: shingles that no other set has are in no intersection."""
    own = F.col("n_shingles") - F.col("shared") + F.col("n_b") - F.col("shared_b")
    return 100 * F.least("shared", "shared_b") >= percent * (own + F.greatest("shared", "shared_b"))


def _grouped(known: DataFrame) -> DataFrame:
    """``cid``, ``root`` and ``pool`` of the classes that share a bucket in which components are left to compare."""
    several = known.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_members = materialize(known.join(several.select("bucket", F.col("low").alias("a")), "bucket").select("cid", "root", "a"), "open")
    # Components that meet in a bucket are of one pool.
    pools = components(open_members.select("a", F.col("root").alias("b")).where("a <> b").distinct())
    pooled = open_members.select("cid", "root").distinct()
    return pooled.join(pools.select(F.col("node").alias("root"), F.col("root").alias("pool")), "root")


def _cells(pooled: DataFrame) -> DataFrame:
    """``cid``, ``root``, ``cell`` and ``side``: every class of a pool in the cells where its block meets the others.

    A block holds some ``BLOCK_CLASSES`` classes, of one component if that is large, of many
    small ones otherwise. Two blocks meet in one cell, unless both are of the same component.
    """
    of_root = pooled.groupBy("pool", "root").agg(F.count("*").alias("n"))
    small = of_root.where(F.col("n") < BLOCK_CLASSES).groupBy("pool").agg(F.sum("n").alias("all_small"))
    parts = F.ceil(F.when(F.col("n") < BLOCK_CLASSES, F.col("all_small")).otherwise(F.col("n")) / BLOCK_CLASSES)
    sized = pooled.join(of_root.join(small, "pool", "left").select("root", "n", parts.alias("parts")), "root")
    one = F.when(F.col("n") < BLOCK_CLASSES, F.lit(None)).otherwise(F.col("root"))
    dealt = F.pmod(F.xxhash64(F.when(one.isNull(), F.col("root")).otherwise(F.col("cid"))), F.col("parts"))
    placed = materialize(sized.select("cid", "root", "pool", one.alias("one"), F.xxhash64("pool", F.coalesce(one, F.lit(-1)), dealt).alias("block")), "blocks")
    blocks = materialize(placed.select("pool", "block", "one").distinct(), "met")
    other = blocks.select("pool", F.col("block").alias("right"), F.col("one").alias("right_one"))
    met = blocks.join(other, "pool").where((F.col("block") <= F.col("right")) & ~F.coalesce(F.col("one") == F.col("right_one"), F.lit(False)))
    met = met.select("pool", "block", "right", F.xxhash64("pool", "block", "right").alias("cell"))
    sides = met.select("pool", "block", "cell", F.lit(0).alias("side")).unionByName(
        met.where("block <> right").select("pool", F.col("right").alias("block"), "cell", F.lit(1).alias("side"))
    )
    return placed.join(sides, ["pool", "block"]).select("cid", "root", "cell", "side")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set on the left with each on the right."""
    tokens, place = np.unique(np.concatenate(left + right), return_inverse=True)
    sets = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    on_left = sets < len(left)
    both = (np.bincount(place[on_left], minlength=len(tokens)) > 0) & (np.bincount(place[~on_left], minlength=len(tokens)) > 0)
    number = np.cumsum(both) - 1
    sets, place = sets[both[place]], number[place[both[place]]]
    order = np.argsort(place, kind="stable")
    sets, place = sets[order], place[order]
    found = np.zeros((len(left), len(right)), np.float32)
    for a in range(0, int(both.sum()), 4096):
        lo, hi = np.searchsorted(place, [a, a + 4096])
        held = np.zeros((len(left) + len(right), 4096), np.float32)
        held[sets[lo:hi], place[lo:hi] - a] = 1
        found += held[: len(left)] @ held[len(left) :].T
    return found.astype(np.int64)


def cell_links(left: tuple[np.ndarray, np.ndarray, list], right: tuple[np.ndarray, np.ndarray, list], percent: int) -> list[tuple[int, int]]:
    """Links between sides of (cids, roots, sets), as many as unite all components that are linked there."""
    shared = _common(left[2], right[2])
    sizes = [np.array([len(x) for x in side[2]], np.int64) for side in (left, right)]
    near = 100 * shared >= percent * (sizes[0][:, None] + sizes[1][None, :] - shared)
    near &= left[1][:, None] != right[1][None, :]
    above: dict[int, int] = {}

    def top(root: int) -> int:
        while root in above:
            root = above[root]
        return root

    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
        a, b = top(int(left[1][i])), top(int(right[1][j]))
        if a != b:
            above[max(a, b)] = min(a, b)
            found.append((int(left[0][i]), int(right[0][j])))
    return found


def block_links(pooled: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components of one pool; all pairs of blocks are compared, each in a task's memory."""
    members = _cells(pooled).join(sets, "cid")

    def meet(cell: pd.DataFrame) -> pd.DataFrame:
        sides = []
        for side in (0, 1):
            rows = cell[cell["side"] == side]
            sides.append((rows["cid"].to_numpy(), rows["root"].to_numpy(), [np.frombuffer(x, np.uint64) for x in rows["hashes"]]))
        left, right = sides if len(sides[1][0]) else (sides[0], sides[0])
        found = cell_links(left, right, percent) if len(left[0]) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return members.groupBy("cell").applyInPandas(meet, "a long, b long")


def _moved(known: DataFrame, new: DataFrame, roots: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Members and ``roots`` (``cid, root``) after new links."""
    if roots is not None:
        new = _at_roots(new, roots)
    joined = components(new).select(F.col("node").alias("old"), F.col("root").alias("new"))
    if roots is None:
        roots = joined.select(F.col("old").alias("cid"), F.col("new").alias("root"))
    else:
        moved = roots.join(joined.withColumnRenamed("old", "root"), "root", "left").select("cid", F.coalesce("new", "root").alias("root"))
        first_time = joined.join(roots, joined["old"] == roots["cid"], "left_anti").select(F.col("old").alias("cid"), F.col("new").alias("root"))
        roots = moved.unionByName(first_time)
    roots = materialize(roots, "roots")
    rooted = roots.select("cid", F.col("root").alias("at"))
    return materialize(known.join(rooted, "cid", "left").withColumn("root", F.coalesce("at", "root")).drop("at"), "members"), roots


def links(crowded: DataFrame, sets: DataFrame, percent: int = LEAST_PERCENT) -> DataFrame:
    """``cid`` and ``root`` of all classes that are linked with another inside some bucket.

    Who shares most buckets is most likely the original of a group: first the one class of
    the highest degree in each bucket meets all others, then the next ones do, up to
    ``PIVOTS``, as far as components differ. That settles all buckets of up to that many
    others. The larger ones in which components are left go to ``block_links``, where all
    pairs across components are compared in blocks, so no link is lost, and groups never
    become rows for all their pairs. Pairs that can't be similar by the number of their own
    shingles are left out. ``crowded`` has ``bucket, cid, n`` (members of the bucket).
    """
    degrees = crowded.groupBy("cid").agg(F.sum("n").alias("degree"))
    able = shared_shingles(sets).where(100 * F.col("shared") >= percent * F.col("n_shingles"))
    known = materialize(crowded.join(degrees.join(able, "cid"), "cid").withColumn("root", F.col("cid")), "members")
    roots: DataFrame | None = None
    tested: DataFrame | None = None
    for low, high in zip((0, *PIVOTS), PIVOTS):
        several = known.where(F.col("n") > low + 1).groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        members = materialize(known.join(several.where("low < high").select("bucket"), "bucket"), "open")
        order = Window.partitionBy("bucket").orderBy(F.desc("degree"), "cid")
        first = members.withColumn("place", F.row_number().over(order)).where((F.col("place") <= high) & (F.col("place") > low))
        first = first.select("bucket", F.col("cid").alias("b"), F.col("root").alias("root_b"), F.col("n_shingles").alias("n_b"), F.col("shared").alias("shared_b"))
        pairs = members.join(first, "bucket").where((F.col("root") != F.col("root_b")) & _may_link(percent))
        pairs = pairs.select(F.least("cid", "b").alias("a"), F.greatest("cid", "b").alias("b")).distinct()
        pairs = pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")
        tested = materialize(pairs, "pairs")
        new = materialize(confirmed(tested, sets, percent), "links")
        if not new.isEmpty():
            known, roots = _moved(known, new, roots)
    pooled = materialize(_grouped(known.where(F.col("n") > PIVOTS[-1] + 1)), "pooled")
    if not pooled.isEmpty():
        new = materialize(block_links(pooled, sets, percent), "links")
        if not new.isEmpty():
            known, roots = _moved(known, new, roots)
    return roots if roots is not None else known.select("cid", "root").limit(0)


def _at_roots(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Links between the components that their ends are in by now."""
    for end in "ab":
        at = roots.select(F.col("cid").alias(end), F.col("root").alias("at"))
        edges = edges.join(at, end, "left").withColumn(end, F.coalesce("at", end)).drop("at")
    return edges.where("a <> b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LEAST_PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Rows are linked when their sets of shingles are ``percent`` similar or more; copies are
    linked by their words alone and enter the search once. A component's id is its smallest
    doc_id (null only if all are null), and rows with that id are kept. A null, empty or
    blank text has no shingle and is linked with nothing: its own id, kept. Repeated rows
    are rows of one component. Sets are sets of 64-bit hashes. Extra columns are left behind.
    """
    rows = materialize(signatures(docs, id_col, text_col), "signatures")
    worded = rows.where("n_shingles > 0")
    classes = worded.groupBy("key").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("buckets").alias("buckets"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select("cid", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    crowded = materialize(members.join(shared, "bucket"), "crowded")
    wanted = materialize(classes.drop("buckets").join(crowded.select("cid").distinct(), "cid"), "wanted")
    sets = materialize(full_sets(docs, wanted, id_col, text_col), "sets")
    named = classes.join(links(crowded, sets, percent), "cid", "left").select("key", "least", F.coalesce("root", "cid").alias("root"))
    named = materialize(named, "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(smallest, "root").select("key", "component_id")
    in_class = rows.where("n_shingles > 0").join(ids, "key").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return in_class.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
