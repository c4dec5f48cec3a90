"""SentencePiece encoding and decoding by a Viterbi search shared over common prefixes.

A text is normalised as the model's files say (a mark in front, blanks to marks) and falls into
marked words: no piece of the vocabulary holds a mark after another character, so the best
segmentation of a text is that of its marked words. Where no piece joins letters with signs or
digits, or holds a line feed, words end there too. A task gathers the distinct words of a
batch, sorts them, which makes them the leaves of a trie in depth-first order, and keeps the
forward scores of the prefix that a word shares with the one before it.

Characters without a piece fall back to their bytes.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import ID_TYPE, Known, packed_ids, vocabulary_path

PIECES = "piece_bpe_32k.model"
MARK = "▁"
# Fixed value: how far below the least piece an unknown character scores.
UNKNOWN_PENALTY = 10.0

# Words that one generation of what a worker remembers holds, and the longest of them.
_WORDS_KNOWN = 220_000
_LONGEST_KNOWN = 40
# Characters of text whose words are sorted together; a longer text is sorted alone.
_CHARS_AT_ONCE = 3_000_000


class PieceCodec:
    """Texts to piece ids and back, for one model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        plain = [i for i in plain if not model.is_unused(i)]
        self._score = {names[i]: model.get_score(i) for i in plain}
        self._id = {names[i]: i for i in plain}
        if any(MARK in p.lstrip(MARK) for p in self._score):
            raise ValueError("a piece goes on over a mark, so words are not independent")
        self._words = word_pattern(self._score)
        # Pieces backwards, as a trie: a node is its children and the score of the piece it ends.
        self._ends: dict[str, list] = {}
        for piece, score in self._score.items():
            children = self._ends
            for c in reversed(piece):
                node = children.setdefault(c, [{}, None])
                children = node[0]
            node[1] = score
        self._unknown = min(self._score.values()) - UNKNOWN_PENALTY
        self._byte = {int(n[3:5], 16): i for i, n in enumerate(names) if model.is_byte(i)}
        self._text = [b""] * size
        for i in plain:
            self._text[i] = names[i].replace(MARK, " ").encode("utf-8")
        for byte, i in self._byte.items():
            self._text[i] = bytes([byte])
        self._known = Known(_WORDS_KNOWN)

    # --- encoding ---

    def encode_batch(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers; null is empty."""
        run, size = [], 0
        for text in texts:
            run.append(text or "")
            size += len(run[-1])
            if size >= _CHARS_AT_ONCE:
                yield from self._encode_run(run)
                run, size = [], 0
        yield from self._encode_run(run)

    def _encode_run(self, texts: list[str]) -> Iterator[bytes]:
        split = [self._words.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts]
        known = self._known
        # What is remembered may be replaced as words are met, so the run keeps what it needs.
        young, now = known.young, {}
        missing = set().union(*split).difference(young)
        for word in list(missing):
            ids = known.older(word)
            if ids is not None:
                now[word] = ids
                missing.remove(word)
        now.update(self._encode_sorted(sorted(missing)))
        for words in split:
            parts = list(map(young.get, words))
            if None in parts:
                parts = [now[w] if p is None else p for w, p in zip(words, parts, strict=True)]
            yield b"".join(parts)
        for word in missing:
            if len(word) <= _LONGEST_KNOWN:
                known.put(word, now[word])

    def _encode_sorted(self, words: list[str]) -> dict[str, bytes]:
        """Ids of sorted words: positions of the prefix shared with the last word are kept."""
        ends, unknown = self._ends, self._unknown
        best, back, last = [0.0], [0], ""
        out = {}
        for word in words:
            marked = word.replace(" ", MARK)
            shared = _shared(last, marked)
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(marked) + 1):
                start = origin = end - 1
                node = ends.get(marked[start])
                if node is None:
                    best.append(best[start] + unknown)
                    back.append(start)
                    continue
                children, score = node
                top = best[start] + (unknown if score is None else score)
                # Longer pieces win ties: they start first.
                while start and (node := children.get(marked[start - 1])) is not None:
                    start -= 1
                    children, score = node
                    if score is not None and best[start] + score >= top:
                        top, origin = best[start] + score, start
                best.append(top)
                back.append(origin)
            last = marked
            out[word] = self._ids(marked, back)
        return out

    def _ids(self, marked: str, back: list[int]) -> bytes:
        cuts = [len(marked)]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        ids = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            own = self._id.get(marked[a:b])
            if own is not None:
                ids.append(own)
            else:
                ids += [self._byte[x] for x in marked[a:b].encode("utf-8")]
        return packed_ids(ids)

    # --- decoding ---

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are no text become the replacement character."""
        raw = b"".join(map(self._text.__getitem__, np.frombuffer(ids, ID_TYPE).tolist()))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def _shared(a: str, b: str) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    return next(i for i in range(most) if a[i] != b[i])


def word_pattern(pieces: Iterable[str]) -> re.Pattern:
    """Where a text may be cut, with blanks for marks, so that no piece crosses a cut.

    Always before blanks; between signs of ASCII and other characters unless a piece holds both;
    around digits if they stand alone in their pieces; around line feeds that no piece holds.
    """
    plain = [p.lstrip(MARK) for p in pieces]
    sign = f"[{re.escape(string.punctuation)}]"
    apart = not any(0 < len(re.findall(sign, p)) < len(p) for p in plain)
    alone = "" if any(len(p) > 1 and re.search("[0-9]", p) for p in plain) else "0-9"
    feeds = "" if any("\n" in p for p in plain) else "\n"
    signs = re.escape(string.punctuation) if apart else ""
    parts = [
        rf" *[^ {signs}{alone}{feeds}]+",
        rf" *[{signs}]+" if signs else "",
        rf" *[{alone}]" if alone else "",
        feeds,
        " +",
    ]
    return re.compile("|".join(filter(None, parts)))


@cache
def codec(name: str = PIECES) -> PieceCodec:
    """One codec per worker process."""
    return PieceCodec(vocabulary_path(name))


def encode(docs: DataFrame, model: str = PIECES) -> DataFrame:
    """(doc_id, ids: binary of little-endian unsigned 32-bit numbers) for each row of ``docs``.

    A missing or empty text has no ids. Other columns are ignored; repeated rows are encoded
    each. A mark in a text stands for a blank.
    """
    return _texts(docs).mapInArrow(lambda batches: _encoded(batches, model), "doc_id long, ids binary")


def decode(encoded: DataFrame, model: str = PIECES) -> DataFrame:
    """(doc_id, ids, text) of encoded documents: the text again, with marks as blanks."""
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda batches: _decoded(batches, model), "doc_id long, ids binary, text string"
    )


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def _encoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in _runs(batch, pc.utf8_length(batch["text"]), _CHARS_AT_ONCE):
            ids = pa.array(codec(model).encode_batch(run["text"].to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([run["doc_id"], ids], ["doc_id", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in _runs(batch, pc.binary_length(batch["ids"]), _CHARS_AT_ONCE * ID_TYPE.itemsize):
            texts = (codec(model).decode(i.as_py() or b"") for i in run["ids"])
            yield pa.RecordBatch.from_arrays(
                [run["doc_id"], run["ids"], pa.array(texts, pa.string())],
                ["doc_id", "ids", "text"],
            )


def _runs(batch: pa.RecordBatch, sizes: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose rows first reach ``most`` together; what is made of a slice, and
    not of a whole batch, is in memory at a time."""
    start, size = 0, 0
    for at, own in enumerate(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).tolist(), 1):
        size += own
        if size >= most or at == batch.num_rows:
            yield batch.slice(start, at - start)
            start, size = at, 0


def round_trip(docs: DataFrame, model: str = PIECES) -> DataFrame:
    """What ``encode`` gives and ``decode`` makes of it again: doc_id, ids, n_ids, ids_crc32 and
    the decoded text's text_sha256. Nothing is shuffled or stored; one worker does both."""
    both = _texts(docs).mapInArrow(
        lambda batches: _decoded(_encoded(batches, model), model),
        "doc_id long, ids binary, text string",
    )
    return both.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / ID_TYPE.itemsize).cast("bigint").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )
