"""SuperMinHash registers, links and components against brute force."""

from collections import Counter, defaultdict

import numpy as np

from tallywell.llm import superminhash
from tests_llm_documents import documents


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()


def plain_result(rows):
    """(doc_id, n_shingles, component_id, kept) by comparing all sets with shared shingles."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    met = {(a, b) for ks in holders.values() for a in ks for b in ks if a < b}
    for a, b in met:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[top(a)] = top(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[top(k)].append(rows[k][0])
    least = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return Counter((rows[k][0], len(sets[k]), least[top(k)], rows[k][0] == least[top(k)]) for k in range(len(rows)))


def whole_permutations(hashes, registers):
    """Registers without stopping early, one shingle at a time."""
    out = [1 << 64] * registers
    for h in hashes.tolist():
        places = list(range(registers))
        for step in range(registers):
            drawn = int(superminhash._mixed(np.array([h], np.uint64) + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))[0])
            at = step + ((drawn & 0xFFFFFFFF) * (registers - step) >> 32)
            places[step], places[at] = places[at], places[step]
            out[places[step]] = min(out[places[step]], (step << 32) + (drawn >> 32))
    return out


def test_registers_with_early_stop_equal_whole_permutations():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 2, 9, 40, 300)] + [np.empty(0, np.uint64)]
    found = superminhash.super_minhash(sets, 32)
    for row, s in zip(found.tolist()[:-1], sets):
        assert row == whole_permutations(s, 32)


def test_registers_estimate_similarity():
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
        a, b = superminhash.super_minhash([np.unique(pool[:50]), np.unique(pool[10:])], 128)
        errors.append((a == b).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < np.sqrt(2 / 9 / 128)


def near_copies(rng, originals, copies, changes):
    rows = []
    for o in range(originals):
        base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for c in range(copies):
            words = list(base)
            for _ in range(rng.integers(0, changes) if c else 0):
                words[rng.integers(0, len(words))] = f"new{rng.integers(0, 10**9)}"
            rows.append((1000 * o + c, " ".join(words)))
    return rows


def test_components_equal_brute_force(spark, odd_rows):
    rng = np.random.default_rng(5)
    # With up to nine changed words many copies are linked through the original only, or not at all.
    rows = near_copies(rng, 12, 25, 9) + odd_rows + [(70_000, "THE Quick brown"), (70_001, "the quick  brown"), (70_002, "one two three four five"), (70_003, "one two three four")]
    rows += [(70_010, "a b c d e f g"), (70_011, "a b c d e f g h"), (70_012, "a b c d e f g h i j")]
    found = superminhash.near_duplicates(documents(spark, rows))
    assert Counter(map(tuple, found.collect())) == plain_result(rows)
    assert superminhash.near_duplicates(documents(spark, [])).count() == 0
    assert superminhash.near_duplicates(documents(spark, [(4, None), (None, " ")])).count() == 2


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    """Most copies are linked with none, some with a few others only; blocks are of any size."""
    rows = near_copies(np.random.default_rng(6), 2, 200, 16)
    for pivots, block in (((1, 16), 512), ((1, 2), 20)):
        monkeypatch.setattr(superminhash, "PIVOTS", pivots)
        monkeypatch.setattr(superminhash, "BLOCK_CLASSES", block)
        found = superminhash.near_duplicates(documents(spark, rows)).collect()
        assert Counter(map(tuple, found)) == plain_result(rows)


def test_cell_links_unite_what_is_linked():
    rng = np.random.default_rng(7)
    base = np.arange(5000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[: rng.integers(4000, 5000)], rng.integers(6000, 9000, 300, dtype=np.uint64)])) for _ in range(40)]
    for k, i, j in ((k, i, j) for k in (7,) for i in range(k) for j in range(k, 12)):
        assert superminhash._common(sets[:k], sets[k:12])[i, j - k] == len(np.intersect1d(sets[i], sets[j]))
    roots = np.arange(40) // 2
    found = superminhash.cell_links((np.arange(20), roots[:20], sets[:20]), (np.arange(20, 40), roots[20:], sets[20:]), 80)
    linked = [(i, j) for i in range(20) for j in range(20, 40) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]

    def groups(pairs):
        root = list(range(20))
        for i, j in pairs:
            a, b = root[roots[i]], root[roots[j]]
            root = [min(a, b) if x in (a, b) else x for x in root]
        return root

    assert groups(found) == groups(linked) and len(found) < 20 and set(found) <= set(linked)


def test_registered_query_equals_brute_force(spark):
    from tallywell.llm.catalog import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_superminhash"](spark, folder).collect()
    assert Counter(map(tuple, found)) == plain_result(rows)
