"""Tokenizer access inside tasks.

Where parts are cached, a text is cut where no token and no rule of its tokenizer can reach across, so the ids of the
parts, one after the other, are the ids of the text. Each Python worker keeps the parts it has met; the cache is bounded,
and what falls out is simply encoded again. Byte-level ids need no cache: whole texts are encoded by rank.
"""

from __future__ import annotations

import array
import json
import os
from functools import cached_property

#: Parts a worker keeps, and the longest part it keeps.
CACHE_PARTS = 600_000
CACHE_LENGTH = 64


def load(path: str):
    """The tokenizer of a file, single-threaded; Spark's tasks are the parallel part."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PartCache:
    """Values of text parts: a fixed table first, then what this worker has encoded itself.

    A full cache takes no more parts, as those met first are mostly the frequent ones; it starts anew once it
    has been passed by many times its size, so a change of language is followed.
    """

    def __init__(self, encode, table: dict | None = None, parts: int = CACHE_PARTS):
        self.encode, self.table, self.parts, self.passed = encode, table or {}, parts, 0
        self.kept: dict = dict(self.table)

    def values(self, parts: list[str]) -> list:
        """The value of each part, in order."""
        out = list(map(self.kept.get, parts))
        if None in out:
            missing = [i for i, v in enumerate(out) if v is None]
            new = list({parts[i]: None for i in missing})
            found = dict(zip(new, self.encode(new), strict=True))
            for i in missing:
                out[i] = found[parts[i]]
            if len(self.kept) < self.parts + len(self.table):
                self.kept.update((p, v) for p, v in found.items() if len(p) <= CACHE_LENGTH)
            else:
                self.passed += len(found)
                if self.passed > 10 * self.parts:
                    self.kept, self.passed = dict(self.table), 0
        return out


def word_parts(text: str) -> list[str]:
    """Parts for a tokenizer that drops white space and lets nothing reach across it."""
    return text.replace("\n", " ").split(" ")


def byte_alphabet() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte, by the byte's Latin-1 code."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def rank_encoder(spec: dict):
    """The byte-level encoding of a tokenizers file by tiktoken, whose equal answer costs far less.

    That library merges by the rank of an id; None where the file's merges are not in the order of their ids.
    """
    import public_tokenizers
    import tiktoken

    back, ids = {c: b for b, c in byte_alphabet().items()}, spec["vocab"]
    plain = {t: i for t, i in ids.items() if all(c in back for c in t)}
    order = [ids.get("".join(m if isinstance(m, list) else m.split(" "))) for m in spec["merges"]]
    if sorted(plain.values()) != list(range(256 + len(order))) or order != list(range(256, 256 + len(order))):
        return None
    ranks = {bytes(back[c] for c in t): i for t, i in plain.items()}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class ByteIds:
    """Ids of whole texts as little-endian unsigned 16-bit bytes (the vocabulary is checked to fit)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path, self.special = path, [t["content"] for t in spec["added_tokens"]]
        if max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) >= 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.plain = rank_encoder(spec["model"])

    @cached_property
    def tok(self):
        """The tokenizer itself, loaded where a text asks for it."""
        return load(self.path)

    def __call__(self, text: str) -> bytes:
        if self.plain is None or any(s in text for s in self.special):
            return array.array("H", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        return array.array("H", self.plain(text)).tobytes()


_WORKER: dict = {}


def byte_ids(path: str) -> ByteIds:
    """The encoder of this Python worker; it keeps nothing of the texts it has met."""
    if path not in _WORKER:
        _WORKER[path] = ByteIds(path)
    return _WORKER[path]
