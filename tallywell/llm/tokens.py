"""Byte-level BPE vocabulary files: bytes of each token, special strings, exact encoding."""

import functools
import json
import re
from collections.abc import Callable

import public_tokenizers
import tiktoken
import tokenizers

#: Default vocabulary; a path can be given to every operator instead.
BYTE_BPE = "byte_bpe_50k.json"

#: Longest run of white space that the pattern engine of the fast encoder takes.
LONGEST_BLANK = 50_000


def default_path() -> str:
    return public_tokenizers.path(BYTE_BPE)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """One vocabulary file: ``ids`` by bytes, ``of_id`` bytes by id, ``specials`` by string."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        self.specials = {t["content"]: t["id"] for t in stored["added_tokens"]}
        to_byte = byte_characters()
        self.ids = {
            bytes(to_byte[c] for c in token): number
            for token, number in stored["model"]["vocab"].items()
            if token not in self.specials
        }
        size = 1 + max([*self.ids.values(), *self.specials.values()])
        self.of_id: list[bytes] = [b""] * size
        for token, number in self.ids.items():
            self.of_id[number] = token
        for token, number in self.specials.items():
            self.of_id[number] = token.encode()
        longest_first = sorted(self.specials, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None

    def split_specials(self, text: str) -> list[str]:
        """Ordinary and special parts in turn; the odd places are special."""
        if self.special_pattern is None:
            return [text]
        return self.special_pattern.split(text)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@functools.lru_cache(maxsize=2)
def library_tokenizer(path: str) -> tokenizers.Tokenizer:
    tokenizer = tokenizers.Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.lru_cache(maxsize=2)
def _fast_encoding(path: str) -> tiktoken.Encoding:
    words = vocabulary(path)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=words.ids, special_tokens=words.specials)


def piece_encoder(path: str) -> Callable[[bytes], list[int]]:
    """Merges one piece of bytes, without splitting it into words first."""
    return _fast_encoding(path)._encode_single_piece


_BLANK = re.compile(r"\s{%d}" % LONGEST_BLANK)


def encode(text: str, path: str) -> list[int]:
    """Ids as the tokenizers library gives them without special tokens added.

    The merges run in tiktoken, several times faster with the same ids; texts with
    huge runs of white space, which it can't take, go to the library itself.
    """
    if len(text) >= LONGEST_BLANK and _BLANK.search(text):
        return library_tokenizer(path).encode(text, add_special_tokens=False).ids
    if any(s in text for s in vocabulary(path).specials):
        return _fast_encoding(path).encode(text, allowed_special="all")
    return _fast_encoding(path).encode_ordinary(text)
