"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once.

The tokenizer is one that drops white space and splits before its merges, so no token crosses
an ASCII blank: a text's ids are those of its blank-separated chunks, one after the other. A
task keeps the ids of the chunks it has met, up to a bounded number.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable
from functools import cache

import numpy as np

WORD_BPE = "word_bpe_49k.json"
END_ID = 1
ID_TYPE = np.dtype("<u4")

# Chunks (words) that one generation of what a worker remembers holds, about 150 bytes each;
# there are two at a time, so that frequent ones stay. The longest remembered, in bytes.
_CHUNKS_KNOWN = 300_000
_WORDS_KNOWN = 160_000
_LONGEST_KNOWN = 48
# Places (a power of two) in which a generation notes that it has met something once.
_PLACES = 1 << 22

# How the tokenizer splits, for chunks of printable ASCII and Latin-1 letters.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")


def vocabulary_path(name: str = WORD_BPE) -> str:
    """Where this machine keeps a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_PACK = [struct.Struct(f"<{n}I").pack for n in range(16)]


def packed_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers; few are packed without an array."""
    if len(ids) < len(_PACK):
        return _PACK[len(ids)](*ids)
    return np.asarray(ids, ID_TYPE).tobytes()


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Known:
    """A bounded memory in two generations: what the older one still serves moves on.

    Most chunks are met once and never again, so one is only kept when it is met a second time;
    until then it is a mark in a table of places, where two may share one.
    """

    def __init__(self, most: int):
        self.most = most
        self.young: dict = {}
        self.old: dict = {}
        self.met = bytearray(_PLACES)

    def older(self, key):
        value = self.old.get(key)
        if value is not None:
            self._keep(key, value)
        return value

    def put(self, key, value) -> None:
        place = hash(key) & (_PLACES - 1)
        if self.met[place]:
            self._keep(key, value)
        else:
            self.met[place] = 1

    def _keep(self, key, value) -> None:
        if len(self.young) >= self.most:
            self.old, self.young = self.young, {}
            self.met = bytearray(_PLACES)
        self.young[key] = value


class ChunkEncoder:
    """Texts (UTF-8) to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._letters = _byte_letters()
        self._chunks = Known(_CHUNKS_KNOWN)
        self._words = Known(_WORDS_KNOWN)
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._special = tuple(t.content for t in added)

    def encode(self, text: bytes) -> bytes:
        chunks = text.split()
        parts = list(map(self._chunks.young.get, chunks))
        if None in parts:
            known = self._chunks
            for i, part in enumerate(parts):
                if part is None:
                    chunk = chunks[i]
                    ids = known.young.get(chunk) or known.older(chunk)
                    if ids is None:
                        ids = self._chunk(chunk)
                        if len(chunk) <= _LONGEST_KNOWN:
                            known.put(chunk, ids)
                    parts[i] = ids
        return b"".join(parts)

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha() and len(chunk) <= _LONGEST_KNOWN:
            return self._word(chunk.lower().decode("ascii"))
        text = chunk.decode("utf-8")
        if len(chunk) > _LONGEST_KNOWN or not _PLAIN.fullmatch(text) or self._has_special(text):
            return self._whole(text)
        return b"".join(map(self._word, _SPLIT.findall(text.lower())))

    def _has_special(self, text: str) -> bool:
        return "<" in text and any(s in text for s in self._special)

    def _whole(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return packed_ids(ids)

    def _word(self, word: str) -> bytes:
        ids = self._words.young.get(word) or self._words.older(word)
        if ids is None:
            spelled = word
            if not word.isascii():
                spelled = "".join(map(self._letters.__getitem__, word.encode("utf-8")))
            ids = packed_ids([t.id for t in self._model.tokenize(spelled)])
            self._words.put(word, ids)
        return ids


@cache
def chunk_encoder(name: str = WORD_BPE) -> ChunkEncoder:
    """One encoder per worker process, so that what it has learnt serves its later tasks."""
    return ChunkEncoder(vocabulary_path(name))


def document_ids(texts: Iterable[bytes | None], name: str = WORD_BPE, end_id: int = END_ID):
    """The ids of each text, with the end id; a missing text is empty."""
    encoder = chunk_encoder(name)
    end = np.array([end_id], ID_TYPE).tobytes()
    for text in texts:
        yield encoder.encode(text or b"") + end
