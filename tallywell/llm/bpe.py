"""BPE encoding and decoding by forced boundaries.

Two neighbouring bytes that stand next to each other inside no token of the
vocabulary can never end up in one token, so a text may be cut between them.
The pieces between such cuts (and between the words of the pre-tokenizer) are
encoded one by one, and each different piece only once per task while it is remembered.
"""

import functools
from array import array
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import id_and_text, sha256_of_ids, text_batches
from tallywell.llm.tokens import default_path, piece_encoder, vocabulary

#: Words that a task remembers; when full, it starts anew.
REMEMBERED = 400_000


class _Words(dict):
    """Ids of the pre-tokenizer's words, which are cut at the forced boundaries first."""

    def __init__(self, path: str):
        super().__init__()
        inside = {pair for token in vocabulary(path).ids for pair in zip(token, token[1:])}
        self._never = {(a, b) for a in range(256) for b in range(256)} - inside
        self._merged = piece_encoder(path)

    def cut(self, word: bytes) -> list[bytes]:
        """The fragments of a word; no token reaches over their borders."""
        if self._never.isdisjoint(zip(word, word[1:])):
            return [word]
        borders = [0, *(i for i, pair in enumerate(zip(word, word[1:]), 1) if pair in self._never), len(word)]
        return [word[a:b] for a, b in zip(borders, borders[1:])]

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = tuple(chain.from_iterable(map(self._merged, self.cut(word.encode()))))
        if len(word) < 64:
            self[word] = ids
        return ids


class Encoder:
    """Encodes and decodes single texts."""

    def __init__(self, path: str):
        self._vocabulary = vocabulary(path)
        self._words = _Words(path)
        self._pattern = regex.compile(public_tokenizers.PATTERN)

    def encode(self, text: str) -> array:
        out = array("i")
        for k, part in enumerate(self._vocabulary.split_specials(text)):
            if k % 2:
                out.append(self._vocabulary.specials[part])
            elif part:
                out.extend(chain.from_iterable(map(self._words.__getitem__, self._pattern.findall(part))))
        return out

    def decode(self, ids) -> str:
        return b"".join(map(self._vocabulary.of_id.__getitem__, ids)).decode("utf-8", errors="replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` (the tokens of the whole text) and ``decoded`` (the text of these ids).

    One row per input row, repeated rows included; a null or empty text has no ids.
    Special strings of the vocabulary inside a text become their id. Extra columns
    are not read. Nothing is shuffled; a task holds a few MB of text at a time.
    """
    path = path or default_path()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, ends, ids, decoded = encoder(path), array("i", [0]), array("i"), []
        for text in batch.column("text").to_pylist():
            own = coder.encode(text)
            ids.extend(own)
            ends.append(len(ids))
            decoded.append(coder.decode(own))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(text_batches(work), f"doc_id {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """Token count and SHA-256 of ids and decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_of_ids(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
