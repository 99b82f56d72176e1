"""Toxicity by the nearest labelled examples, found exactly in a block-max inverted index.

Texts are vectors of TF-IDF weights over the words and word beginnings that speak
for toxicity among labelled examples. The examples' postings are cut into blocks of
neighbouring examples with the largest weight of each term; blocks are opened in
the order of their bounds until no bound reaches the k-th cosine found. The
examples vote by cosine, all that tie with the last one too, with the share of toxic
ones among examples without any such term as the prior. Examples of one vector are one
entry of the index with their toxic and clean weight.
"""

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import annotate, crc32_mod, id_and_text, in_slices, materialize

#: Bound of the sample of labelled rows, by class.
TOXIC_EXAMPLES = 4_000
CLEAN_EXAMPLES = 8_000

#: Least chi-square of a term that speaks for toxicity, and least number of different texts with it.
LEAST_CHI2 = 40.0
LEAST_EXAMPLES = 5

#: Numbers of different words with a term that are terms themselves.
LEVELS = (2, 3, 5)

NEIGHBOURS = 15
BLOCK = 64
PRIOR_WEIGHT = 0.5

#: Cosines that differ by less are equal, as sums of floats are.
TIE = 1e-12

#: Word beginnings of these lengths are terms beside the words.
BEGINNINGS = (4, 5, 6)
_STRIPPED = ".,;:!?\"'()[]{}<>*#|%&$-_+=~`/\\"

#: Words that a task remembers the terms of; when full, it starts anew.
REMEMBERED = 200_000


def terms_of(word: str) -> tuple[str, ...]:
    """A bare word and its beginnings, which end in an asterisk."""
    bare = word.strip(_STRIPPED)
    if not bare:
        return ()
    return (bare, *(bare[:n] + "*" for n in BEGINNINGS if len(bare) >= n))


@dataclass
class Examples:
    """The chosen terms with their weights, and the labelled examples as an index.

    ``terms`` by place; ``idf`` by term; ``entries`` are (example, term, weight) with
    examples of length one; ``toxic`` (part of its weight that is toxic), ``share`` (labelled
    rows that it stands for) and ``rows`` (sampled rows, 1 if none are given) by example.
    """

    terms: list[str]
    idf: np.ndarray
    entries: np.ndarray
    toxic: np.ndarray
    share: np.ndarray
    prior: float
    rows: np.ndarray | None = None

    @cached_property
    def place(self) -> dict[str, int]:
        return {t: k for k, t in enumerate(self.terms)}

    @cached_property
    def blocks(self) -> int:
        return -(-len(self.toxic) // BLOCK)

    @cached_property
    def _postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Postings by term and block, where each begins, and the largest weight of each."""
        example, term, weight = self.entries["example"], self.entries["term"], self.entries["weight"]
        cell = term.astype(np.int64) * self.blocks + example // BLOCK
        order = np.lexsort((example, cell))
        starts = np.searchsorted(cell[order], np.arange(len(self.terms) * self.blocks + 1))
        most = np.zeros(len(self.terms) * self.blocks)
        np.maximum.at(most, cell, weight)
        return example[order], weight[order], starts, most.reshape(len(self.terms), self.blocks)

    def _first(self, found: list[tuple[int, float]], k: int) -> list[tuple[int, float]]:
        """Of entries in order, those that hold the first k rows, and all that tie with the last of them."""
        held = 0
        for at, (x, cosine) in enumerate(found):
            if held >= k and cosine < found[at - 1][1] - TIE:
                return found[:at]
            held += 1 if self.rows is None else int(self.rows[x])
        return found

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, ties: bool = False) -> list[tuple[int, float]]:
        """The k examples of the largest cosine above 0, ties to the smaller place; exact.

        With ``ties``, entries count by their rows, and all that tie with the k-th row are found.
        """
        examples, posted, starts, most = self._postings
        bounds = weights @ most[terms]
        best: list[tuple[int, float]] = []
        full = False
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or full and bounds[block] < best[-1][1] - TIE:
                break
            scores = np.zeros(BLOCK)
            for term, weight in zip(terms, weights):
                a, b = starts[term * self.blocks + block], starts[term * self.blocks + block + 1]
                scores[examples[a:b] % BLOCK] += weight * posted[a:b]
            found = np.flatnonzero(scores > (max(0.0, best[-1][1] - TIE) if full else 0.0))
            if not len(found):
                continue
            best += [(int(block) * BLOCK + int(x), float(scores[x])) for x in found]
            best = sorted(best, key=lambda e: (-e[1], e[0]))
            best = self._first(best, k) if ties else best[:k]
            full = (sum(int(self.rows[x]) for x, _ in best) if ties and self.rows is not None else len(best)) >= k
        return best

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), np.int64)
        weights = (1 + np.log([counts[t] for t in terms.tolist()])) * self.idf[terms]
        return terms, weights / np.linalg.norm(weights)

    def score(self, counts: Counter) -> tuple[float, list[tuple[int, float]]]:
        """Vote of the neighbours, and the neighbours as evidence."""
        if not counts or not len(self.toxic):
            return self.prior, []
        near = self.nearest(*self.vector(counts), ties=True)
        votes = [(cosine * self.share[x], self.toxic[x]) for x, cosine in near]
        total = sum(v for v, _ in votes)
        # the prior weighs as much as part of a neighbour of average standing
        own = PRIOR_WEIGHT * float(self.share.sum() / (len(self.share) if self.rows is None else self.rows.sum()))
        return (sum(v * toxic for v, toxic in votes) + own * self.prior) / (total + own), near


def _level(hits: int) -> str:
    """Name of the term of texts with so many different words with terms; no word looks like it."""
    return f" {hits}"


class _TermCounter(dict):
    """Places of the chosen terms in a word, remembered by word."""

    def __init__(self, place: dict[str, int]):
        super().__init__()
        self._place = place

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        found = tuple(self._place[t] for t in terms_of(word) if t in self._place)
        if len(word) < 64:
            self[word] = found
        return found

    def count(self, text: str) -> Counter:
        counts: Counter = Counter()
        hits = 0
        for word, n in Counter(text.lower().split()).items():
            hits += bool(self[word])
            for term in self[word]:
                counts[term] += n
        for level in LEVELS:
            if hits >= level:
                counts[self._place[_level(level)]] = 1
        return counts


def sample_examples(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id") -> DataFrame:
    """``text, toxic, share``: a bounded sample of labelled rows, in each class those of the least hash.

    Labels that contradict each other count as toxic. ``share`` is the number of labelled
    rows of the class over the number taken. The sample's ids are bounded, so they are
    broadcast and the texts are not shuffled.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = materialize(known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")), "labels")
    sizes = {r["toxic"]: r["n"] for r in known.where("toxic in (0, 1)").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    taken = []
    for toxic, most in ((1, TOXIC_EXAMPLES), (0, CLEAN_EXAMPLES)):
        share = max(1.0, sizes.get(toxic, 0) / most)
        taken.append(known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("_id"), "_id").limit(most).withColumn("share", F.lit(share)))
    ids = materialize(taken[0].unionByName(taken[1]), "sample")
    texts = id_and_text(docs, id_col, text_col)
    return materialize(texts.join(F.broadcast(ids), texts["doc_id"] == ids["_id"]).select("text", "toxic", "share"), "examples")


def choose_terms(examples: DataFrame) -> list[str]:
    """All terms of the sample that stand in toxic texts more often, by chi-square, then by name.

    Different texts are counted, so copies lend a term nothing. Of a word and its
    beginnings only the strongest is kept.
    """
    examples = examples.groupBy("text").agg(F.max("toxic").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found[toxic].update({t for word in set(text.lower().split()) for t in terms_of(word)})
        terms = list(found[0].keys() | found[1].keys())
        columns = [pa.array(terms, pa.string()), *(pa.array([f[t] for t in terms], pa.int64()) for f in found)]
        yield pa.RecordBatch.from_arrays(columns, ["term", "clean", "toxic"])

    rows = examples.mapInArrow(count, "term string, clean long, toxic long")
    rows = rows.groupBy("term").agg(F.sum("clean").cast("double").alias("b"), F.sum("toxic").cast("double").alias("a"))
    sizes = examples.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    toxic, clean = float(sizes["t"]), float(sizes["n"] - sizes["t"])
    if not toxic or not clean:
        return []
    d, c, n = toxic - F.col("a"), clean - F.col("b"), toxic + clean
    chi2 = n * F.pow(F.col("a") * c - F.col("b") * d, 2) / (toxic * clean * (F.col("a") + F.col("b")) * F.greatest(c + d, F.lit(0.5)))
    rows = rows.where((F.col("a") + F.col("b") >= LEAST_EXAMPLES) & (F.col("a") * clean > F.col("b") * toxic))
    best = rows.select("term", chi2.alias("chi2")).where(F.col("chi2") >= LEAST_CHI2)
    strength = {r["term"]: r["chi2"] for r in best.collect()}
    chains = {t: [b for b in terms_of(t) if b != t and b.endswith("*") and b in strength] for t in strength}
    weaker = {t for t, shorter in chains.items() if any(strength[b] >= strength[t] for b in shorter)}
    weaker |= {b for t, shorter in chains.items() for b in shorter if strength[b] < strength[t]}
    kept = sorted(strength.keys() - weaker, key=lambda t: (-strength[t], t))
    return [*kept, *map(_level, LEVELS)] if kept else []


def document_frequency(docs: DataFrame, terms: list[str], text_col: str = "text") -> tuple[np.ndarray, int]:
    """Documents with each term, of all documents, and the number of documents."""
    texts = docs.select(F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    place = {t: k for k, t in enumerate(terms)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, total = _TermCounter(place), np.zeros(len(place) + 1, np.int64)
        for batch in batches:
            for part in in_slices(batch):
                for text in part.column("text").to_pylist():
                    total[list(counter.count(text))] += 1
                total[-1] += part.num_rows
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "n"])

    df = np.zeros(len(terms) + 1, np.int64)
    for row in texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[row["term"]] = row["n"]
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", label_col: str = "toxic", id_col: str = "doc_id") -> Examples:
    """Index of a bounded sample of labelled rows; document frequencies are of all documents.

    Without labelled rows of both classes every document gets the share of toxic labels (0 if none).
    """
    examples = sample_examples(docs, labels, text_col, label_col, id_col)
    terms = choose_terms(examples)
    df, documents = document_frequency(docs, terms, text_col)
    idf = 1 + np.log((documents + 1) / (df + 1))
    place = {t: k for k, t in enumerate(terms)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _TermCounter(place)
        for batch in batches:
            counts = [counter.count(t) for t in batch.column("text").to_pylist()]
            kind = pa.list_(pa.int64())
            columns = [pa.array([list(c) for c in counts], kind), pa.array([list(c.values()) for c in counts], kind)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column("toxic"), batch.column("share")], ["terms", "counts", "toxic", "share"])

    rows = examples.mapInArrow(vectors, "terms array<long>, counts array<long>, toxic int, share double")
    plain = F.size("terms") == 0
    toxic_share, share = F.sum(F.col("toxic") * F.col("share")), F.sum("share")
    bare = rows.where(plain).agg(F.coalesce(toxic_share, F.lit(0.0)).alias("t"), F.coalesce(share, F.lit(0.0)).alias("n")).first()
    prior = bare["t"] / bare["n"] if bare["n"] else 0.0
    by_vector: dict[tuple, list[float]] = {}
    model = Examples(terms, idf, np.zeros(0), np.zeros(0), np.zeros(0), float(prior))
    for row in sorted(rows.where(~plain).collect()):
        place_, weight = model.vector(Counter(dict(zip(row["terms"], row["counts"]))))
        told = by_vector.setdefault((tuple(place_.tolist()), tuple(weight.round(12).tolist())), [0.0, 0.0, 0])
        told[row["toxic"]] += row["share"]
        told[2] += 1
    entries = [(k, t, w) for k, (at, weight) in enumerate(by_vector) for t, w in zip(at, weight)]
    model.entries = np.array(entries, [("example", np.int64), ("term", np.int64), ("weight", float)])
    clean, toxic, model.rows = np.array(list(by_vector.values()), float).reshape(-1, 3).T
    model.share = clean + toxic
    model.toxic = toxic / np.maximum(model.share, 1e-300)
    return model


def add_scores(docs: DataFrame, model: Examples, text_col: str = "text") -> DataFrame:
    """``row``, ``score``, ``predicted`` and ``evidence`` (cosine and majority label of the neighbours, one of each vector) of every row."""

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        counter, known, scores, evidence = _counter(model), {}, [], []
        for text in batch.column("text").to_pylist():
            counts = counter.count(text)
            key = tuple(sorted(counts.items()))
            if key not in known:
                known[key] = model.score(counts)
            score, near = known[key]
            scores.append(score)
            evidence.append([{"cosine": c, "toxic": int(model.toxic[x] >= 0.5)} for x, c in near])
        predicted = [int(s >= 0.5) for s in scores]
        kind = pa.list_(pa.struct([("cosine", pa.float64()), ("toxic", pa.int32())]))
        return [pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()), pa.array(evidence, kind)]

    return annotate(docs, text_col, work, "score double, predicted int, evidence array<struct<cosine:double,toxic:int>>")


def _counter(model: Examples) -> _TermCounter:
    """The term counter that goes with a model, made once per task."""
    if "_own_counter" not in model.__dict__:
        model.__dict__["_own_counter"] = _TermCounter(model.place)
    return model.__dict__["_own_counter"]


def training_labels(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows that may be learned from: crc32 of the id as text isn't a multiple of 5."""
    return labels.where(crc32_mod(labels[id_col], 5) != 0)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` of every row; null texts are empty and get the prior.

    Repeated rows get equal scores. Language, source, ids and labels are no inputs of a score.
    """
    model = fit(docs, training_labels(labels, id_col), text_col, id_col=id_col)
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    scored = add_scores(narrow, model)
    held_out = (crc32_mod(F.col("row.doc_id"), 5) == 0).alias("held_out")
    return scored.select("row.doc_id", held_out, "score", "predicted", "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that aren't predicted toxic, with all their columns."""
    model = fit(docs, training_labels(labels, id_col), text_col, id_col=id_col)
    return add_scores(docs, model, text_col).where("predicted = 0").select("row.*")
