"""BPE, packing and training order against the tokenizers library and by exact round trips."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywell.llm import bpe, packing, training_order
from tallywell.llm.tokens import default_path, encode, library_tokenizer
from tests_llm_documents import documents


def library_ids(text):
    return library_tokenizer(default_path()).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sé1<|>")), max_size=60))
def test_any_text_has_the_ids_of_the_library(text):
    assert list(bpe.Encoder(default_path()).encode(text)) == library_ids(text) == encode(text, default_path())


def test_forced_boundaries_cut_inside_words():
    words = bpe._Words(default_path())
    cut = words.cut("abc中文qض".encode())
    assert len(cut) > 1 and b"".join(cut) == "abc中文qض".encode()


def test_huge_blank_runs():
    text = "a" + " " * 120_000 + "b" + "\n" * 70_000
    assert encode(text, default_path()) == library_ids(text)


def test_bpe_of_odd_documents(spark, odd_rows):
    rows = bpe.digests(bpe.encode_documents(documents(spark, odd_rows))).collect()
    expected = []
    for i, text in odd_rows:
        ids = library_ids(text)
        back = library_tokenizer(default_path()).decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_empty_tables(spark):
    none = documents(spark, [])
    assert bpe.encode_documents(none).count() == 0
    assert packing.pack_documents(none).count() == 0
    assert training_order.materialise(none, "k").count() == 0


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing_of_odd_documents(spark, odd_rows):
    rows = packing.pack_documents(documents(spark, odd_rows)).collect()
    check_packing(rows, 1024)
    expected = Counter()
    for i, text in odd_rows:
        ids = np.array([*library_ids(text), 2], "<u4")
        first = (len(ids) - 1) % 1024 + 1
        for piece, (a, b) in enumerate(zip([0, *range(first, len(ids), 1024)], range(first, len(ids) + 1, 1024))):
            expected[i, piece, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), min_size=1, max_size=30))
def test_a_plan_uses_every_piece_once_within_capacity(counts):
    plan = packing.plan_patterns(dict(counts), 64)
    used = Counter()
    for pattern, copies in plan:
        assert sum(pattern) <= 64 and copies > 0
        for length in pattern:
            used[length] += copies
    assert used == Counter(counts)
    bins: list[int] = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        fit = next((k for k, used_of in enumerate(bins) if used_of + length <= 64), None)
        if fit is None:
            bins.append(length)
        else:
            bins[fit] += length
    assert sum(c for _, c in plan) <= 1.05 * len(bins) + 1


def test_exact_complements_fill_whole_sequences():
    assert packing.plan_patterns({600: 5, 424: 5}, 1024) == [((600, 424), 5)]
    assert sum(c for _, c in packing.plan_patterns({500: 4, 300: 4, 124: 4, 100: 4}, 1024)) == 4


def test_one_length_with_most_pieces(spark):
    rows = packing.pack_documents(documents(spark, [(k, "same words") for k in range(3000)])).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 3000
    assert check_packing(rows, 1024) == -(-3000 // (1024 // 3))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_the_permutation_is_one(n):
    order = training_order.Permutation(n, "key")
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.numbers(slots) == np.arange(n)).all()
    if n > 60:
        assert (slots != training_order.Permutation(n, "other").slots(np.arange(n))).any()


def test_training_order_round_trip(spark, odd_rows, tmp_path):
    folder = str(tmp_path / "shards")
    docs = documents(spark, odd_rows).coalesce(1)
    total = training_order.write_training_order(docs, folder, "key", length=64, shard_sequences=100)
    rows = training_order.read_training_order(spark, folder, length=64, shard_sequences=100).collect()
    assert sorted(r["slot"] for r in rows) == list(range(total))
    assert all(r["at"] == (r["slot"] - 100 * r["shard"]) * 129 for r in rows)
    numbers = training_order.Permutation(total, "key").numbers(np.array([r["slot"] for r in rows]))
    stream = np.concatenate([np.frombuffer(r["ids"], "<u2") for _, r in sorted(zip(numbers, rows), key=lambda x: x[0])])
    expected = [t for _, text in odd_rows for t in [*library_ids(text), 2]]
    assert stream[: len(expected)].tolist() == expected and set(stream[len(expected) :].tolist()) <= {2}
    later = training_order.read_training_order(spark, folder, 150, length=64, shard_sequences=100).collect()
    assert sorted(r["slot"] for r in later) == list(range(150, total))
