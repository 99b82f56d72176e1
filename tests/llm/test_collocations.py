"""Phrases from the weighted graph against plain counts: flows, paths, scores, odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np

from tallywell.llm import collocations
from tallywell.llm.catalog import make_importable

SCHEMA = "text string, lang string, n string, phrase string, score string, rank string, slot int, pair int"


def frame(spark, rows):
    make_importable(spark)
    return spark.createDataFrame([(t, lang, "n", "p", "s", "r", 0, 0) for t, lang in rows], SCHEMA)


def plain_counts(rows):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    return counts, totals


def plain_result(rows, least, most=2000):
    counts, totals = plain_counts(rows)
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def many_rows(odd_rows):
    rng = np.random.default_rng(9)
    words = np.array([f"w{k}" for k in range(30)] + ["Été", "İ", "x-y", "中文"])
    weights = 1 / np.arange(1, len(words) + 1)
    rows = []
    for k in range(150):
        chosen = rng.choice(words, rng.integers(0, 60), p=weights / weights.sum())
        rows.append((" ".join(w + rng.choice(["", "", "", ",", ".", "\n", " \t "]) for w in chosen), ["en", "de", None, "l\nm"][k % 4]))
    passage = " ".join(f"p{k}" for k in range(200))
    rows += [(f"{passage} Tail{k % 3}", "en") for k in range(7)] + [("a b c a b c a b c a b c a b c", "de")] * 5 + [("z " * 40, "fr")]
    return rows + [(t, "en") for _, t in odd_rows]


def test_phrases_equal_plain_counts(spark, odd_rows):
    rows = many_rows(odd_rows)
    for least, most in ((5, 2000), (3, 4)):
        found = collocations.collocations(frame(spark, rows), least=least, most=most)
        assert found.columns[:4] == ["lang", "rank", "phrase", "a"]
        assert sorted(map(tuple, found.collect())) == plain_result(rows, least, most)


def test_flows_are_the_counts_of_shorter_sequences(spark, odd_rows):
    rows = many_rows(odd_rows)
    counts, _ = plain_counts(rows)
    edges = collocations.graph(frame(spark, rows), least=5)
    for size, level in enumerate(collocations.flows(edges), 1):
        found = {(r["lang"], tuple(r["phrase"].split(" "))): r["n"] for r in level.where("n >= 5").collect()}
        assert found == {(lang, p): n for lang, f in counts.items() for p, n in f.items() if len(p) == size and n >= 5}


def test_paths_hold_every_frequent_edge_once(spark, odd_rows):
    rows = many_rows(odd_rows)
    counts, _ = plain_counts(rows)
    by_size = collocations.flows(collocations.graph(frame(spark, rows), least=5))
    compact = collocations.paths(by_size[3].where("n >= 5"), by_size[2]).collect()
    found = []
    for r in compact:
        assert len(r["words"]) == len(r["weights"]) + 3 == len(r["flow"]) + 2
        for i, n in enumerate(r["weights"]):
            found.append((r["lang"], tuple(r["words"][i : i + 4]), n))
        for i, n in enumerate(r["flow"]):
            assert n == counts[r["lang"]][tuple(r["words"][i : i + 3])]
    expected = [(lang, p, n) for lang, f in counts.items() for p, n in f.items() if len(p) == 4 and n >= 5]
    assert sorted(found) == sorted(expected)
    # The 197 edges of the passage that stands seven times lie on a few paths.
    assert sum(r["words"][0].startswith("p") for r in compact) < 20 and len(compact) < len(expected) / 2


def test_a_full_filter_changes_nothing(spark, odd_rows, monkeypatch):
    """With every pair let through all edges are shuffled, and the result is the same."""
    rows = many_rows(odd_rows)
    monkeypatch.setattr(collocations, "frequent_pairs", lambda *_: bytes([255]) * (1 << collocations.FILTER_BITS - 3))
    assert sorted(map(tuple, collocations.collocations(frame(spark, rows), least=5).collect())) == plain_result(rows, 5)


def test_without_words_there_are_no_rows(spark):
    for rows in ([], [(None, None), ("", "en"), (" .\n", "en")], [("one two", "en")]):
        assert collocations.collocations(frame(spark, rows)).count() == 0
