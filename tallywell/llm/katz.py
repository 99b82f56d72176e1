"""Katz backoff bigram model over all documents, and the score of every document under it.

Texts are cut into chunks of a few MB. A chunk knows its different words and pairs
of words with their counts, and asks the tables that hold them: it sends what it
counted and gets back the totals, so that counting and looking up share one
exchange. First the words go to hash buckets (the unigram table), then the pairs
go to the bucket of their first word (the bigram table); a first word with more
than a bucket's share of all tokens is spread over several buckets by its second
word. Good-Turing discounts come from the counts of counts of the whole tables, and
the backoff weight of a first word from sums over all its seen successors, which
makes every conditional distribution sum to one.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import crc32_mod, id_and_text, in_slices, materialize

CHUNK_BYTES = 8 << 20
CHUNKS_PER_BUCKET = 2
LEAST_BUCKETS = 16

#: Counts above this one are not discounted.
DISCOUNTED = 5

#: The word that ends a text; it also stands before the first word.
END = b""


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 3)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), kind)


def _pack_words(words: list[bytes]) -> bytes:
    return zstandard.compress(b"\n".join(words), 3)


def _unpack_words(packed: bytes) -> list[bytes]:
    return zstandard.decompress(packed).split(b"\n")


def _encode(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Places in the list of different words, and that list."""
    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def write_chunks(docs: DataFrame, id_col: str, text_col: str, held_out) -> tuple[DataFrame, int]:
    """The table of chunks, bucketed by chunk so that replies come to it without moving it, and its row count.

    A row has the documents' ids, marks and sizes, the different words, the text as places
    in them, and the training count of each word.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("held", held_out)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in in_slices(batch, most=CHUNK_BYTES):
                words: list[bytes] = [END]
                sizes = []
                for text in part.column("text").to_pylist():
                    own = text.encode("utf-8", "replace").lower().split()
                    words += own
                    words.append(END)
                    sizes.append(len(own) + 1)
                places, different = _encode(words)
                stream, held = places[1:], np.repeat(part.column("held").to_numpy(zero_copy_only=False), sizes)
                counts = np.bincount(stream[~held], minlength=len(different))
                lists = [pa.ListArray.from_arrays([0, part.num_rows], x) for x in (part.column("doc_id"), part.column("held"), pa.array(sizes, pa.int32()))]
                packed = (_pack_words(different), _pack(stream.astype(np.uint32)), _pack(counts.astype(np.uint32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), *lists, *(pa.array([x], pa.binary()) for x in packed)],
                    ["chunk", "ids", "held", "sizes", "words", "stream", "counts"],
                )
                number += 1

    schema = f"chunk long, ids array<{kind}>, held array<boolean>, sizes array<int>, words binary, stream binary, counts binary"
    name = f"katz_chunks_{uuid.uuid4().hex}"
    parts = max(8, 2 * rows.rdd.getNumPartitions())
    rows.mapInArrow(cut, schema).write.bucketBy(parts, "chunk").saveAsTable(name)
    chunks = docs.sparkSession.table(name)
    return chunks, chunks.select("chunk").count()


def _word_buckets(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)).astype(np.uint64) % np.uint64(buckets)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places that go to it, in order."""
    order = np.argsort(bucket, kind="stable")
    values, starts = np.unique(bucket[order], return_index=True)
    for value, own in zip(values.tolist(), np.split(order, starts[1:])):
        yield int(value), own


def count_words(chunks: DataFrame, buckets: int) -> DataFrame:
    """Written rows of two sorts: ``table`` rows, the unigram table by bucket, and ``reply`` rows by chunk and bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, counts = _unpack_words(row["words"]), _unpack(row["counts"], np.uint32)
                asked = [(b, row["chunk"], _pack_words([words[k] for k in own]), _pack(counts[own])) for b, own in _by_bucket(_word_buckets(words, buckets))]
                columns = [pa.array(c, t) for c, t in zip(zip(*asked), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "words", "counts"])

    def answer(key: tuple, asked: pa.Table) -> pa.Table:
        rows = asked.to_pylist()
        lists = [_unpack_words(r["words"]) for r in rows]
        places, different = _encode([w for words in lists for w in words])
        counted = np.concatenate([_unpack(r["counts"], np.uint32) for r in rows])
        total = np.bincount(places, counted, len(different)).astype(np.int64)
        bucket = key[0].as_py()
        seen = total[total > 0]
        of_counts = np.bincount(np.minimum(seen, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2].tolist()
        out = [{"sort": "table", "bucket": bucket, "words": _pack_words(different), "totals": _pack(total), "tokens": int(seen.sum()), "types": len(seen), "of_counts": of_counts}]
        at = 0
        for row, words in zip(rows, lists):
            own = places[at : at + len(words)]
            at += len(words)
            out.append({"sort": "reply", "bucket": bucket, "chunk": row["chunk"], "places": _pack(own.astype(np.uint32)), "totals": _pack(total[own])})
        return pa.Table.from_pylist(out, _WORD_SCHEMA)

    asked = chunks.select("chunk", "words", "counts").mapInArrow(ask, "bucket long, chunk long, words binary, counts binary")
    schema = "sort string, bucket long, chunk long, words binary, places binary, totals binary, tokens long, types long, of_counts array<long>"
    return materialize(asked.groupBy("bucket").applyInArrow(answer, schema), "unigrams")


_WORD_SCHEMA = pa.schema(
    [("sort", pa.string()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("words", pa.binary()), ("places", pa.binary()), ("totals", pa.binary())]
    + [("tokens", pa.int64()), ("types", pa.int64()), ("of_counts", pa.list_(pa.int64()))]
)


def discounts(of_counts: list[int]) -> np.ndarray:
    """Katz's factors for counts 0 to ``DISCOUNTED``, from the numbers of types seen 1, 2, ... times.

    Good-Turing estimates up to the largest count for which they lie between 0 and 1;
    where they never do, half a count is taken from the types seen once.
    """
    factors = np.ones(DISCOUNTED + 1)
    n = [0, *of_counts]
    for most in range(DISCOUNTED, 0, -1):
        if not all(n[1 : most + 2]):
            continue
        cut = (most + 1) * n[most + 1] / n[1]
        found = [((r + 1) * n[r + 1] / n[r] / r - cut) / (1 - cut) if cut < 1 else 0.0 for r in range(1, most + 1)]
        if all(0 < d < 1 for d in found):
            factors[1 : most + 1] = found
            return factors
    factors[1] = 0.5
    return factors


class Unigrams:
    """Discounted unigram probabilities; what the discounts leave is one class of unknown words."""

    def __init__(self, tokens: int, types: int, of_counts: list[int]):
        self.tokens, self.types = tokens, types
        self.factors = discounts(of_counts)
        taken = sum((1 - self.factors[r]) * r * n for r, n in enumerate(of_counts[:DISCOUNTED], 1))
        # without any type seen a few times nothing would be left for unknown words
        self.whole = tokens if taken > 0 else tokens + 1
        self.unknown = (taken or 1) / max(1, self.whole)

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.factors[np.minimum(counts, DISCOUNTED) * (counts <= DISCOUNTED)] * counts / max(1, self.whole), self.unknown)


class Chunk:
    """A chunk's words with their totals and ids, and its different pairs."""

    def __init__(self, row: dict, replies: list[dict], buckets: int, tokens: int):
        words = _unpack_words(row["words"])
        self.bucket = _word_buckets(words, buckets).astype(np.int64)
        self.total = np.zeros(len(words), np.int64)
        self.place = np.zeros(len(words), np.uint32)
        answered = {r["bucket"]: r for r in replies if r["sort"] == "reply"}
        for b, own in _by_bucket(self.bucket):
            self.total[own] = _unpack(answered[b]["totals"], np.int64)
            self.place[own] = _unpack(answered[b]["places"], np.uint32)
        self.word = _unpack(row["stream"], np.uint32).astype(np.int64)
        end = words.index(END)
        self.before = np.append(end, self.word[:-1])
        self.held = np.repeat(np.array(row["held"]), row["sizes"])
        known = (self.total[self.word] > 0) & (self.total[self.before] > 0)
        key = self.before * len(words) + self.word
        pairs, at = np.unique(key[known], return_inverse=True)
        self.pair_of = np.full(len(key), -1)
        self.pair_of[known] = at
        self.first, self.second = pairs // len(words), pairs % len(words)
        self.trained = np.bincount(at[~self.held[known]], minlength=len(pairs))
        spread = 1 + self.total * buckets // max(1, tokens)
        self.salts = spread
        mixed = (self.place[self.second] * np.uint32(2654435761) >> np.uint32(8)).astype(np.int64) + self.bucket[self.second]
        self.pair_bucket = (self.bucket[self.first] + mixed % spread[self.first]) % buckets

    def asked(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By bucket: places of pairs that go there, and first words whose sums are wanted from there."""
        firsts = np.unique(self.first)
        salts = np.minimum(self.salts[firsts], buckets)
        every = np.repeat(firsts, salts)
        step = np.arange(len(every)) - np.repeat(np.cumsum(salts) - salts, salts)
        wanted = dict(_by_bucket((self.bucket[every] + step) % buckets))
        pairs = dict(_by_bucket(self.pair_bucket))
        none = np.zeros(0, np.int64)
        for b in sorted(wanted.keys() | pairs.keys()):
            yield b, pairs.get(b, none), every[wanted.get(b, none)]


_PAIR_SCHEMA = pa.schema(
    [("sort", pa.string()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("firsts", pa.binary()), ("seconds", pa.binary())]
    + [("counts", pa.binary()), ("sums", pa.binary()), ("of_counts", pa.list_(pa.int64()))]
)

#: Sums of a first word over its seen successors: how many have count 1, 2, ..., the larger counts, their unigram probability.
_SUMS = DISCOUNTED + 2


def count_pairs(chunks: DataFrame, words: DataFrame, buckets: int, unigrams: Unigrams) -> DataFrame:
    """Written rows of two sorts as in ``count_words``: the bigram table by bucket, and replies."""
    tokens = unigrams.tokens

    def ask(row: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for each in row.to_pylist():
            chunk = Chunk(each, replies.to_pylist(), buckets, tokens)
            ids = chunk.bucket.astype(np.uint64) << np.uint64(32) | chunk.place
            for b, pairs, firsts in chunk.asked(buckets):
                second = chunk.second[pairs]
                packed = (ids[chunk.first[pairs]], chunk.bucket[second].astype(np.uint32), chunk.place[second], chunk.trained[pairs].astype(np.uint32), chunk.total[second], ids[firsts])
                out.append((b, each["chunk"], *map(_pack, packed)))
        names = ["bucket", "chunk", "first", "second_bucket", "second", "counts", "second_total", "wanted"]
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 6]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, kinds)], names)

    def answer(key: tuple, asked: pa.Table) -> pa.Table:
        bucket, rows = key[0].as_py(), asked.to_pylist()
        kinds = {"first": np.uint64, "second_bucket": np.uint32, "second": np.uint32, "counts": np.uint32, "second_total": np.int64}
        parts = {name: [_unpack(r[name], kind) for r in rows] for name, kind in kinds.items()}
        sizes = [len(x) for x in parts["first"]]
        first, second_bucket, second, counts, second_total = (np.concatenate(parts[name]) for name in kinds)
        second = second_bucket.astype(np.uint64) << np.uint64(32) | second
        order = np.lexsort((second, first))
        new = np.ones(len(order), bool)
        new[1:] = (first[order][1:] != first[order][:-1]) | (second[order][1:] != second[order][:-1])
        group = np.cumsum(new) - 1
        total = np.bincount(group, counts[order], int(new.sum())).astype(np.int64)
        back = np.empty(len(order), np.int64)
        back[order] = group
        lead = order[new]
        heads, head_of = np.unique(first[lead], return_inverse=True)
        sums = np.zeros((len(heads), _SUMS))
        for r in range(1, DISCOUNTED + 1):
            sums[:, r - 1] = np.bincount(head_of, total == r, len(heads))
        sums[:, -2] = np.bincount(head_of, np.where(total > DISCOUNTED, total, 0), len(heads))
        sums[:, -1] = np.bincount(head_of, np.where(total > 0, unigrams.probability(second_total[lead]), 0), len(heads))
        seen = total > 0
        of_counts = np.bincount(np.minimum(total[seen], DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2].tolist()
        table = (first[lead][seen], second[lead][seen], total[seen].astype(np.uint32))
        out = [{"sort": "table", "bucket": bucket, "firsts": _pack(table[0]), "seconds": _pack(table[1]), "counts": _pack(table[2]), "of_counts": of_counts}]
        at = 0
        for row, n in zip(rows, sizes):
            wanted = _unpack(row["wanted"], np.uint64)
            where = np.minimum(np.searchsorted(heads, wanted), max(0, len(heads) - 1))
            own = np.where((heads[where] == wanted)[:, None], sums[where], 0.0) if len(heads) else np.zeros((len(wanted), _SUMS))
            reply = {"sort": "reply", "bucket": bucket, "chunk": row["chunk"], "counts": _pack(total[back[at : at + n]].astype(np.uint32)), "sums": _pack(own.T)}
            out.append(reply)
            at += n
        return pa.Table.from_pylist(out, _PAIR_SCHEMA)

    replies = words.where("sort = 'reply'").select("sort", "bucket", "chunk", "places", "totals")
    schema = "bucket long, chunk long, first binary, second_bucket binary, second binary, counts binary, second_total binary, wanted binary"
    asked = chunks.select("chunk", "held", "sizes", "words", "stream").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(ask, schema)
    kept = "sort string, bucket long, chunk long, firsts binary, seconds binary, counts binary, sums binary, of_counts array<long>"
    return materialize(asked.groupBy("bucket").applyInArrow(answer, kept), "bigrams")


def _score(chunk: Chunk, replies: list[dict], buckets: int, unigrams: Unigrams, factors: np.ndarray) -> np.ndarray:
    """Log10 probability of every token: of the pair if it was seen, else backed off to the word."""
    counts = np.zeros(len(chunk.first), np.int64)
    sums = np.zeros((len(chunk.total), _SUMS))
    answered = {r["bucket"]: r for r in replies if r["sort"] == "pair"}
    for b, pairs, firsts in chunk.asked(buckets):
        counts[pairs] = _unpack(answered[b]["counts"], np.uint32)
        np.add.at(sums, firsts, _unpack(answered[b]["sums"], np.float64).reshape(_SUMS, -1).T)
    history = np.maximum(chunk.total, 1)
    seen = (sums[:, :DISCOUNTED] @ (factors[1:] * np.arange(1, DISCOUNTED + 1)) + sums[:, -2]) / history
    # where no count is discounted, one more is added to the history for what was not seen
    spare = np.where(1 - seen < 1e-9, history / (history + 1), 1.0)
    backoff = np.where(seen > 0, (1 - seen * spare) / np.maximum(1 - sums[:, -1], 1e-12), 1.0)

    own = np.log10(unigrams.probability(chunk.total))
    scores = own[chunk.word] + np.log10(backoff[chunk.before])
    found = np.flatnonzero(chunk.pair_of >= 0)
    found = found[counts[chunk.pair_of[found]] > 0]
    count, before = counts[chunk.pair_of[found]], chunk.before[found]
    factor = np.where(count <= DISCOUNTED, factors[np.minimum(count, DISCOUNTED)], 1.0)
    scores[found] = np.log10(factor * count / history[before] * spare[before])
    return scores


def score_documents(docs: DataFrame, held_out=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The model learns from the rows for which the column ``held_out`` (by default: crc32 of the
    id as text, modulo 7, is 2) is false. Null and empty texts are the end token alone;
    repeated rows count as often as they stand there and get equal scores. Words never
    seen in training form one class. Chunks are written to a bucketed table of the
    warehouse, the tables of words and pairs to the shared folder.
    """
    held_out = F.col("doc_id").isNotNull() & (crc32_mod(F.col("doc_id"), 7) == 2) if held_out is None else held_out
    chunks, number = write_chunks(docs, id_col, text_col, held_out)
    buckets = max(LEAST_BUCKETS, number // CHUNKS_PER_BUCKET)
    words = count_words(chunks, buckets)
    unigrams = Unigrams(*_sums(words, ("tokens", "types")))
    pairs = count_pairs(chunks, words, buckets, unigrams)
    factors = discounts(_sums(pairs, ())[0])
    tokens, types = unigrams.tokens, unigrams.types
    kind = docs.schema[id_col].dataType.simpleString()

    def score(row: pa.Table, replies: pa.Table) -> pa.Table:
        parts = []
        for k, each in enumerate(row.to_pylist()):
            told = replies.to_pylist()
            chunk = Chunk(each, told, buckets, tokens)
            starts = np.cumsum(each["sizes"]) - each["sizes"]
            total = chunk.total[chunk.word]
            base = np.log10((total + 1) / (tokens + types + 1))
            columns = [np.add.reduceat(x, starts) for x in ((total > 0).astype(np.int64), base, _score(chunk, told, buckets, unigrams, factors))]
            ids = row.column("ids").combine_chunks()[k].values
            held, sizes = row.column("held").combine_chunks()[k].values, pa.array(each["sizes"], pa.int64())
            train = pa.array(np.full(len(ids), tokens, np.int64))
            parts.append(pa.table([ids, held, sizes, pa.array(columns[0]), train, pa.array(columns[1]), pa.array(columns[2])], _SCORES))
        return pa.concat_tables(parts) if parts else pa.table([pa.array([], t) for t in (row.schema.field("ids").type.value_type, pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2)], _SCORES)

    none = F.lit(None).cast("binary")
    replies = words.where("sort = 'reply'").select("sort", "bucket", "chunk", "places", "totals", none.alias("counts"), none.alias("sums"))
    more = pairs.where("sort = 'reply'").select(F.lit("pair").alias("sort"), "bucket", "chunk", none.alias("places"), none.alias("totals"), "counts", "sums")
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.drop("counts").groupBy("chunk").cogroup(replies.unionByName(more).groupBy("chunk")).applyInArrow(score, schema)


_SCORES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def _sums(rows: DataFrame, names: tuple[str, ...]) -> list:
    """Totals over the table rows: of the named columns, and of the counts of counts."""
    places = [F.sum(F.get("of_counts", F.lit(k))).alias(f"n{k}") for k in range(DISCOUNTED + 1)]
    found = rows.where("sort = 'table'").agg(*[F.sum(n).alias(n) for n in names], *places).first()
    return [*(found[n] or 0 for n in names), [found[f"n{k}"] or 0 for k in range(DISCOUNTED + 1)]]
