"""Near-duplicates, language model, search, the queries and the pipeline against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry_points
import corpus_pipeline
import oracle
from tallywell.llm import katz, simhash, topk
from tallywell.llm.catalog import ORACLES, QUERIES, make_importable
from tests_llm_documents import documents

FOLDER = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits):
    """By value, the smallest linked value, following all links within 3 bits."""
    values = sorted(set(bits))
    root = {v: v for v in values}
    for _ in values:
        moved = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= 3 and root[b] < root[a]:
                    root[a], moved = root[b], True
        if not moved:
            return root
    return root


def test_near_duplicates_of_odd_documents(spark, odd_rows):
    rows = odd_rows + [(30, odd_rows[8][1] + " more"), (31, "THE quick"), (32, "the QUICK")]
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    bits = [plain_fingerprint(t) for _, t in rows]
    root = plain_components(bits)
    least = defaultdict(list)
    for (i, _), b in zip(rows, bits):
        least[root[b]].append(i)
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in least.items()}
    expected = Counter((i, f"{b:016x}", least[root[b]]) for (i, _), b in zip(rows, bits))
    assert Counter(map(tuple, found)) == expected
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_trie_join_finds_every_link():
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = [c ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False))) for c in centres for _ in range(30)]
    a = np.unique(np.array(values, np.uint64))
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 3
    pairs = {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(near, 1)))}
    found = [p for i, j in simhash.trie_pairs(a, None) for p in zip(i.tolist(), j.tolist())]
    assert set(found) == pairs and len(found) == len(pairs)
    left, right = a[::2], a[1::2]
    expected = {(int(i), int(j)) for i, j in zip(*np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= 3))}
    found = [p for i, j in simhash.trie_pairs(left, right) for p in zip(i.tolist(), j.tolist())]
    assert set(found) == expected and len(found) == len(expected)


def test_links_over_many_groups_give_the_same_components(spark):
    make_importable(spark)
    rng = np.random.default_rng(5)
    values = {int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False)) for c in rng.integers(0, 1 << 63, 12, dtype=np.uint64) for _ in range(25)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = simhash.links(spark.createDataFrame(signed, "bits long"), most=8)
    root = plain_components(values)
    found = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in simhash.components(links).collect()}
    groups = defaultdict(set)
    for v in values:
        groups[found.get(v, v)].add(v)
    expected = defaultdict(set)
    for v in values:
        expected[root[v]].add(v)
    assert {frozenset(g) for g in groups.values()} == {frozenset(g) for g in expected.values()}


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1200)], "a long, b long")
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert len({found[k] for k in range(301)}) == 1 and len({found[k] for k in range(1000, 1200)}) == 1 and len(found) == 501


def test_one_of_each_group_stays(spark, odd_rows):
    docs = documents(spark, odd_rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    groups = Counter(plain_components([plain_fingerprint(t) for _, t in odd_rows])[plain_fingerprint(r["text"])] for r in kept.collect())
    assert set(groups.values()) == {1} and len(groups) == len(set(plain_components([plain_fingerprint(t) for _, t in odd_rows]).values()))


class PlainKatz:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for words in texts:
            self.words.update(words)
            self.pairs.update(zip([b"", *words], words))
        self.n, self.v = self.words.total(), len(self.words)
        of_counts = lambda c: [sum(x == k for x in c.values()) for k in range(1, 7)]
        self.unigrams = katz.Unigrams(self.n, self.v, of_counts(self.words))
        self.factors = katz.discounts(of_counts(self.pairs))
        self.after = defaultdict(dict)
        for (a, b), c in self.pairs.items():
            self.after[a][b] = c

    def word(self, w):
        return float(self.unigrams.probability(np.array([self.words[w]]))[0])

    def pair(self, w, h):
        after, n = self.after.get(h, {}), max(1, self.words[h])
        share = {x: (self.factors[c] if c <= 5 else 1.0) * c / n for x, c in after.items()}
        spare = n / (n + 1) if share and 1 - sum(share.values()) < 1e-9 else 1.0
        if w in share:
            return share[w] * spare
        if not share:
            return self.word(w)
        return (1 - sum(share.values()) * spare) / (1 - sum(map(self.word, after))) * self.word(w)


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]


@pytest.fixture(scope="module")
def prose():
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(60)]
    weights = 1 / np.arange(1, 61)
    return [(k, " ".join(rng.choice(words, rng.integers(5, 60), p=weights / weights.sum()))) for k in range(200)]


def test_katz_scores(spark, prose, odd_rows):
    rows = prose + [(i, t) for i, t in odd_rows if t is None or len(t) < 20_000]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    plain = PlainKatz([words_of(t) for i, t in rows if not held(i)])
    expected = []
    for i, t in rows:
        words = words_of(t)
        base = sum(math.log10((plain.words[w] + 1) / (plain.n + plain.v + 1)) for w in words)
        score = sum(math.log10(plain.pair(w, h)) for h, w in zip([b"", *words], words))
        expected.append((i, held(i), len(words), sum(plain.words[w] > 0 for w in words), plain.n, base, score))
    found = [tuple(r) for r in katz.score_documents(documents(spark, rows)).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[5])
    for a, b in zip(sorted(found, key=order), sorted(expected, key=order), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])


def test_katz_distributions_sum_to_one(prose):
    plain = PlainKatz([words_of(t) for _, t in prose])
    unknown = plain.unigrams.unknown
    assert sum(map(plain.word, plain.words)) + unknown == pytest.approx(1)
    for history in (b"", b"w0", b"w59", b"never seen"):
        assert sum(plain.pair(w, history) for w in plain.words) + plain.pair(b"never seen", history) == pytest.approx(1)


def test_katz_without_rows_or_training(spark):
    assert katz.score_documents(documents(spark, [])).count() == 0
    held = [k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    rows = katz.score_documents(documents(spark, [(k, "only held out") for k in held])).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)


def test_top_k_with_ties_nulls_and_copies(spark):
    make_importable(spark)
    rng = np.random.default_rng(7)
    vectors = {k: rng.normal(size=8).astype(np.float32).tolist() for k in range(700)}
    for k in range(200, 420):
        vectors[k] = vectors[3]
    rows = [(k, v, 0) for k, v in vectors.items()]
    rows += [(900, None, 0), (1000, [1.0] * 7 + [None], 0), (1100, [float("nan")] * 8, 0), (1200, [float("inf")] * 8, 0), (None, [1.0] * 8, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    points = {k: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(np.int64) for k, v in vectors.items()}
    expected = {}
    for q in range(0, 700, 100):
        best = sorted((-int(points[q] @ p), k) for k, p in points.items() if k != q)[:10]
        expected[q] = [(k, -s) for s, k in best]
    found = defaultdict(list)
    for r in sorted(topk.search_embeddings(frame).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert dict(found) == expected
    assert topk.search_embeddings(frame.limit(0)).count() == 0


def test_top_k_sends_no_blocks_through_the_driver(spark, monkeypatch):
    """Many shards and blocks, in cells of several of both: the plan has no broadcast, whose rows grew with their product."""
    make_importable(spark)
    for name, value in (("SHARD_ROWS", 40), ("BLOCK_QUERIES", 4), ("CELL_BLOCKS", 3), ("LEAST_CELLS", 5)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(11)
    points = rng.integers(-3, 4, size=(600, 5)).astype(float)
    points[1] = 3e9
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(7, points[7].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    result = topk.search_embeddings(frame, query_step=20)
    assert "Broadcast" not in result._jdf.queryExecution().executedPlan().toString()
    whole = [(i, np.array(p, float) * 1024) for i, p in rows]
    found = defaultdict(list)
    for r in result.orderBy("query_id", "rank").collect():
        found[r.query_id].append((-r.score, r.vec_id))
    for q in range(0, 600, 20):
        assert found[q] == sorted((-int(p.astype(int) @ (points[q] * 1024).astype(int)), i) for i, p in whole if i != q)[:10]
    assert len(found) == 30


def test_tree_search_looks_at_few_points():
    rng = np.random.default_rng(8)
    points = rng.normal(scale=1000, size=(4096, 3)).astype(np.int64)
    tree = topk.Tree(np.arange(4096), points)
    query = points[5] * 2
    best, looked = tree.search(-1, query, tree.bounds(query[None])[0], 10, topk.NO_BOUND)
    assert sorted((-s, -i) for s, i in best) == sorted((-int(p @ query), k) for k, p in enumerate(points))[:10] and looked < 1024


def test_queries_are_registered_and_agree_with_their_sql(spark):
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    con = oracle.connect(FOLDER)
    for name, sql in ORACLES.items():
        assert oracle.differences(QUERIES[name](spark, FOLDER), con, sql) is None


def test_native_main_path_of_personal_data(spark):
    plan = QUERIES["op3_pii_bootstrap"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark):
    """Every stage but the last returns document columns and a subset of its ids; the last packs what is left."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, before = docs.columns, docs
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER)
        assert after.columns == columns
        path = corpus_pipeline.materialize(after, "stage")
        assert path.join(before, "doc_id", "left_anti").count() == 0
        before = path
        sizes.append(path.count())
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[3] == sizes[4] > 0
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in before.select("doc_id").collect()}
