"""Phrases of words that belong together, from a weighted de Bruijn graph per language.

Nodes are sequences of three words and edges of four; an edge weighs what it occurs. Every
place of a text adds one to the longest sequence that starts there, an edge where it can, a
shorter one where the piece ends or where no longer one can be frequent. So the count of a
shorter sequence is the flow out of it plus what ended at it, level by level: three words
from edges, two from three, one from two. Frequent edges between which a node has one way
in and one way out are compacted to paths, which carry weights and flows of their nodes.

A place can only start a frequent longer sequence if its pairs of words are frequent. Pairs
are counted by hash first, and a bitmap of fixed size tells of the frequent ones; what it
lets through by mistake is counted like the rest and changes nothing.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.llm.common import bitmap_of, in_slices, materialize

MOST_WORDS = 4
LEAST_COUNT = 30
COVER_PERCENT = 80
PHRASES_PER_LANGUAGE = 2000
SCORE_FACTOR = 2_000_000
UNKNOWN_LANGUAGE = "und"

#: Text whose sequences a task counts at a time before they are shuffled.
SLICE_BYTES = 8 << 20

#: Bits by which frequent pairs are told from others: a fixed 8 MB, whatever the input.
FILTER_BITS = 26

#: Bits by which pairs are counted for it; two pairs of one number can only be let through together.
COUNTED_BITS = FILTER_BITS + 10

#: One node in so many ends a path, which bounds the edges of a path; rounds reach paths of 2^10 edges.
PATH_BREAK = 64
PATH_ROUNDS = 10

_BREAK = 1
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r",
    b"abcdefghijklmnopqrstuvwxyz " + b"\n" * 10,
)


class Sequence:
    """Words of the texts of one language, in order, with breaks between pieces."""

    def __init__(self, language: str, texts: list[bytes]):
        self.language = language
        joined = b"\n".join(texts).translate(_PLAIN).replace(b"\n", b" \n ")
        seen = {b"": 0, b"\n": _BREAK}
        codes = np.fromiter((seen.setdefault(w, len(seen)) for w in joined.split(b" ")), np.int64)
        self.words = list(seen)
        self.codes = codes[codes > 0]
        breaks = np.append(np.flatnonzero(self.codes == _BREAK), len(self.codes))
        place = np.arange(len(self.codes))
        #: Words from here to the end of the piece, MOST_WORDS at most; 0 at a break.
        self.reach = np.minimum(breaks[np.searchsorted(breaks, place)] - place, MOST_WORDS)

    def pair_hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Places where a pair starts, and the 64-bit hash of language and pair there."""
        salt = np.uint64(xxhash.xxh3_64_intdigest(self.language.encode()))
        one = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        at = np.flatnonzero(self.reach >= 2)
        x = (one[self.codes[at]] ^ salt) * np.uint64(0x9E3779B97F4A7C15) + one[self.codes[at + 1]]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return at, x ^ (x >> np.uint64(29))

    def grams(self, frequent: np.ndarray) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        """By size, the different sequences that places add to, and how often; ``frequent`` is the bitmap of pairs."""
        at, hashes = self.pair_hashes()
        slots = hashes >> np.uint64(64 - FILTER_BITS)
        good = np.zeros(len(self.codes) + MOST_WORDS, bool)
        good[at] = frequent[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8) & 1
        size = (self.reach > 0).astype(np.int64)
        for k in range(2, MOST_WORDS + 1):
            size += (size == k - 1) & (self.reach >= k) & good[k - 2 : len(self.codes) + k - 2]
        ids, covered = self.codes, 1
        for k in range(1, MOST_WORDS + 1):
            if k > covered:
                _, ids = np.unique(ids[:-1] * len(self.words) + self.codes[k - 1 :], return_inverse=True)
                covered = k
            starts = np.flatnonzero(size == k)
            if len(starts):
                _, first, n = np.unique(ids[starts], return_index=True, return_counts=True)
                rows = zip(*(self.codes[starts[first] + j].tolist() for j in range(k)))
                yield k, [b" ".join(map(self.words.__getitem__, row)) for row in rows], n


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[Sequence]:
    for batch in batches:
        for part in in_slices(batch, most=SLICE_BYTES):
            by_language: dict[str, list[bytes]] = {}
            for language, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.large_binary())):
                by_language.setdefault(language, []).append(text.as_py())
            for language, texts in by_language.items():
                yield Sequence(language, texts)


def _lines(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text")
    return docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN_LANGUAGE)).alias("lang"), text)


def frequent_pairs(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT) -> bytes:
    """Bitmap over the upper bits of the hashes of all pairs that occur ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sequence in _sequences(batches):
            hashes, n = np.unique(sequence.pair_hashes()[1] >> np.uint64(64 - COUNTED_BITS), return_counts=True)
            if len(n):
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], ["pair", "n"])

    counted = _lines(docs, text_col, lang_col).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    slot = F.shiftright("pair", COUNTED_BITS - FILTER_BITS)
    marked = counted.where(F.col("n") >= least).select(slot.alias("slot"))
    return bitmap_of(marked, FILTER_BITS)


def graph(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT) -> DataFrame:
    """``lang, size, phrase, n``: edges (four words) and the places that end at shorter sequences."""
    bits = docs.sparkSession.sparkContext.broadcast(frequent_pairs(docs, text_col, lang_col, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.frombuffer(bits.value, np.uint8)
        for sequence in _sequences(batches):
            for size, phrases, n in sequence.grams(frequent):
                for a in range(0, len(phrases), 1 << 16):
                    part = pa.array(phrases[a : a + (1 << 16)], pa.binary()).cast(pa.string())
                    fixed = [pa.array([sequence.language] * len(part)), pa.array(np.full(len(part), size, np.int32)), part]
                    yield pa.RecordBatch.from_arrays([*fixed, pa.array(n[a : a + (1 << 16)])], ["lang", "size", "phrase", "n"])

    rows = _lines(docs, text_col, lang_col).mapInArrow(run, "lang string, size int, phrase string, n long")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def _first(phrase: str, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _last(phrase: str, words: int) -> Column:
    return F.substring_index(phrase, " ", -words)


def flows(edges: DataFrame) -> list[DataFrame]:
    """Counts ``lang, phrase, n`` of sequences of 1, 2, ... words: what flows on to longer ones plus what ended there."""
    level = edges.where(F.col("size") == MOST_WORDS).select("lang", "phrase", "n")
    found = [level]
    for size in range(MOST_WORDS - 1, 0, -1):
        onward = level.select("lang", _first("phrase", size).alias("phrase"), "n")
        ended = edges.where(F.col("size") == size).select("lang", "phrase", "n")
        level = materialize(onward.unionByName(ended).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), f"flow{size}")
        found.insert(0, level)
    return found


def paths(frequent: DataFrame, nodes: DataFrame) -> DataFrame:
    """Frequent edges compacted: ``lang, words, weights`` (of its edges) and ``flow`` (of its nodes, one more).

    Edges meet at a node with one frequent edge in and one out. Each edge points to the one
    after it, and pointers are doubled until all rest at the end of their path; edges of a
    closed ring have none and stay alone.
    """
    node = nodes.select("lang", F.col("phrase").alias("node"), F.col("n").alias("flow"))
    edges = frequent.select("lang", "phrase", "n", _first("phrase", MOST_WORDS - 1).alias("node"), _last("phrase", MOST_WORDS - 1).alias("to"))
    edges = materialize(edges.join(node, ["lang", "node"]).withColumn("id", F.monotonically_increasing_id()), "edges")
    out = edges.groupBy("lang", "node").agg(F.count("*").alias("outs"), F.min("id").alias("next")).where("outs = 1")
    into = edges.groupBy("lang", "to").agg(F.count("*").alias("ins")).where("ins = 1").withColumnRenamed("to", "node")
    unary = out.join(into, ["lang", "node"]).where(F.pmod(F.xxhash64("lang", "node"), F.lit(PATH_BREAK)) != 0)
    ahead = edges.select("id", "lang", F.col("to").alias("node")).join(unary, ["lang", "node"], "left").select("id", "next")
    state = materialize(ahead.select("id", F.coalesce("next", "id").alias("end"), F.col("next").isNotNull().cast("long").alias("steps")), "pointers")
    for _ in range(PATH_ROUNDS):
        further = state.select(F.col("id").alias("end"), F.col("end").alias("beyond"), F.col("steps").alias("more"))
        moved = state.join(further, "end").select("id", F.col("beyond").alias("end"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moved"))
        state = materialize(moved, "pointers")
        if state.where("moved").isEmpty():
            break
    placed = state.select("id", F.when(F.col("moved"), F.col("id")).otherwise(F.col("end")).alias("path"), F.when(F.col("moved"), 0).otherwise(-F.col("steps")).alias("place"))
    step = F.struct("place", "phrase", "n", "flow", "to", "lang")
    gathered = edges.join(placed, "id").groupBy("path").agg(F.sort_array(F.collect_list(step)).alias("steps"))
    last = F.element_at("steps", -1)
    words = F.concat(F.split(F.col("steps")[0]["phrase"], " "), F.transform(F.slice("steps", 2, PATH_BREAK * 1000), lambda s: F.substring_index(s["phrase"], " ", -1)))
    compact = gathered.select(last["lang"].alias("lang"), last["to"].alias("node"), words.alias("words"), F.col("steps.n").alias("weights"), F.col("steps.flow").alias("flows"))
    return compact.join(node, ["lang", "node"]).select("lang", "words", "weights", F.concat("flows", F.array("flow")).alias("flow"))


def _edges_of(compact: DataFrame) -> DataFrame:
    """Every edge of the paths, with the counts of its first and last three words."""
    place = F.explode(F.sequence(F.lit(1), F.size("weights"))).alias("i")
    each = compact.select("lang", "words", "weights", "flow", place)
    phrase = F.array_join(F.expr(f"slice(words, i, {MOST_WORDS})"), " ")
    return each.select("lang", F.lit(MOST_WORDS).alias("size"), phrase.alias("phrase"), F.expr("weights[i - 1]").alias("a"), F.expr("flow[i - 1]").alias("first"), F.expr("flow[i]").alias("last"))


def _best_of_each(rows: DataFrame, most: int) -> DataFrame:
    """The best rows of each language in every task, so that few are left to be ranked together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list[tuple]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                kept.setdefault(r["lang"], []).append((-r["score"], -r["a"], r["phrase"].encode(), r["l"], r["r"]))
            for language, best in kept.items():
                if len(best) > 2 * most:
                    kept[language] = sorted(best)[:most]
        for language, best in kept.items():
            best = sorted(best)[:most]
            columns = [[language] * len(best), [b[2].decode() for b in best], [-b[1] for b in best], [b[3] for b in best], [b[4] for b in best], [-b[0] for b in best]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["lang", "phrase", "a", "l", "r", "score"])

    return rows.mapInArrow(run, "lang string, phrase string, a long, l long, r long, score long")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST_COUNT, cover_percent: int = COVER_PERCENT, most: int = PHRASES_PER_LANGUAGE
) -> DataFrame:
    """The ``most`` best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A candidate is a phrase of 2 to 4 words inside a piece of a text that occurs ``least``
    times or more. It scores by its worst cut in two, floor(2,000,000 a / (l + r)), equal
    cuts by the shorter first part; it is dropped if a longer candidate around it has
    ``cover_percent`` of its count. Ties in rank go to the greater count, then to the lesser
    phrase by bytes, so no two rows tie. A null language is ``und``; null, empty and blank
    texts add nothing; repeated rows count each; other columns are left behind. Without
    candidates there are no rows.
    """
    edges = materialize(graph(docs, text_col, lang_col, least), "graph")
    by_size = flows(edges)
    frequent = [level.where(F.col("n") >= least) for level in by_size]
    compact = materialize(paths(frequent[3], by_size[2]), "paths")
    shorter = [
        level.select("lang", F.lit(size).alias("size"), "phrase", F.col("n").alias("a"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
        for size, level in ((2, frequent[1]), (3, frequent[2]))
    ]
    candidates = materialize(_edges_of(compact).unionByName(shorter[0]).unionByName(shorter[1]), "candidates")
    # A phrase inside one longer by two words is also inside one longer by one, which occurs at least as often.
    around = [candidates.where("size > 2").select("lang", F.expr(f"substring_index(phrase, ' ', {sign} * (size - 1))").alias("phrase"), "a") for sign in (1, -1)]
    covers = around[0].unionByName(around[1]).groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    wide = "CAST({} AS DECIMAL(19, 0))"
    covered = F.expr(f"100 * {wide.format('cover')} >= {cover_percent} * {wide.format('a')}")
    left = candidates.join(covers, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))

    cuts = left.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - size)").alias("right"),
        F.expr("CASE WHEN k = 3 THEN first END").alias("l_known"), F.expr("CASE WHEN size - k = 3 THEN last END").alias("r_known"),
    )
    parts = frequent[0].unionByName(frequent[1])
    # The flow of three words came with the path.
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l_found")), ["lang", "left"], "left")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r_found")), ["lang", "right"], "left")
    cuts = cuts.withColumn("l", F.coalesce("l_known", "l_found")).withColumn("r", F.coalesce("r_known", "r_found"))
    score = F.expr(f"{SCORE_FACTOR} * {wide.format('a')} div ({wide.format('l')} + {wide.format('r')})")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = _best_of_each(scored, most).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= most)
    totals = by_size[0].groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
