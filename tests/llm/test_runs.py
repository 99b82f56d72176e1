"""Periodic runs against brute force, planted runs, odd rows."""

import hashlib
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywell.llm import periodic_runs
from tests_llm_documents import documents


def plain_runs(words, least=24):
    """All (start, period, length), by comparing words a period apart."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        k = 0
        while k < n - q:
            end = k
            while end < n - q and words[end] == words[end + q]:
                end += 1
            length = end - k + q
            smaller = any(all(words[x] == words[x + r] for x in range(k, k + length - r)) for r in range(1, q)) if end > k else True
            if length >= max(least, 3 * q) and not smaller:
                found.append((k, q, length))
            k = max(end, k + 1)
    return sorted(found)


def plain_digests(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {k for s, q, length in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[2] / r[1], -r[0], -r[1]), default=None)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    listed = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    numbers = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(runs), *numbers, digest(listed.encode()), digest(kept))


@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 9)), max_size=12))
@settings(max_examples=300, deadline=None)
def test_runs_equal_brute_force(parts):
    codes = [c for unit, times in parts for c in unit * times]
    for least in (24, 6, 3):
        found = periodic_runs.find_runs(np.array(codes, np.int64), least)
        assert [tuple(r) for r in found.tolist()] == plain_runs(codes, least)


@given(st.lists(st.integers(1, 3), min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_common_extensions_and_orders(codes):
    tree = periodic_runs.SuffixTree(codes)
    suffixes = sorted(range(len(codes) + 1), key=lambda k: codes[k:])
    assert [int(tree.rank[k]) for k in suffixes] == list(range(len(codes) + 1))
    turned = sorted(range(len(codes) + 1), key=lambda k: [-c for c in codes[k:]])
    assert [int(tree.rank_reversed()[k]) for k in turned] == list(range(len(codes) + 1))
    pairs = [(a, b) for a in range(len(codes)) for b in range(a + 1, len(codes))]
    if pairs:
        i, j = np.array(pairs).T
        expected = [next((k for k in range(len(codes)) if b + k >= len(codes) or codes[a + k] != codes[b + k]), 0) for a, b in pairs]
        assert tree.common(i, j).tolist() == expected


def test_long_texts_of_one_period_and_of_none():
    codes = np.arange(60_000) % 37
    assert periodic_runs.find_runs(codes).tolist() == [[0, 37, 60_000]]
    assert periodic_runs.find_runs(np.zeros(60_000, np.int64)).tolist() == [[0, 1, 60_000]]
    assert len(periodic_runs.find_runs(np.random.default_rng(1).integers(0, 40, 200_000))) == 0


def rows_with_runs(odd_rows):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(9)]
    rows = list(odd_rows)
    for k in range(100, 260):
        text = []
        for _ in range(rng.integers(1, 8)):
            text += list(rng.choice(words, rng.integers(1, 9))) * int(rng.integers(1, 12))
        rows.append((k, " ".join(text)))
    tied = "a b " * 12 + "x " + "c d " * 12
    return rows + [(300, tied), (300, tied), (301, "A a " * 12), (302, "one two " * 30)]


def test_digests_equal_brute_force(spark, odd_rows):
    short = [(i, t) for i, t in odd_rows if t is None or len(t) < 20_000]
    rows = rows_with_runs(short)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    found = periodic_runs.digests(periodic_runs.periodic_runs(documents(spark, rows), planted=True)).collect()
    assert Counter(map(tuple, found)) == Counter(plain_digests(i, t) for i, t in rows)


def test_runs_of_rows_as_they_are(spark, odd_rows):
    found = periodic_runs.periodic_runs(documents(spark, odd_rows))
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(odd_rows) and by_id[2]["runs"] == [] and by_id[2]["start"] is None and by_id[3]["collapsed_text"] == ""
    assert (by_id[5]["start"], by_id[5]["length"], by_id[5]["period"]) == (1, 30_000, 1) and by_id[5]["collapsed_text"].endswith("x word")
    assert by_id[7]["period"] == len(odd_rows[0][1].split()) and by_id[7]["collapsed_text"].split() == odd_rows[0][1].split()
    assert periodic_runs.periodic_runs(documents(spark, [])).count() == 0


def test_registered_query_equals_brute_force(spark):
    from tallywell.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    short = {i: t for i, t in docs if len(t or "") < 2_500}
    found = QUERIES["op13_suffix_tree_runs"](spark, folder).collect()
    assert len(found) == len(docs)
    assert {tuple(r) for r in found if r["doc_id"] in short} == {plain_digests(i, t) for i, t in short.items()}


