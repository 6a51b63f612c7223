"""Byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from batchkit.llm.common import slices

# The pattern by which byte-level vocabularies split text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
# A single space before a character that is no white space always starts a new match of PATTERN.
BOUNDARY = re.compile(r" (?=\S)")
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:!?]*)")
# Entries that a worker keeps of each kind; what does not fit is computed again.
REMEMBERED = 300_000


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a vocabulary entry stands for.

    Printable bytes stand for themselves, the others are numbered from 256 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one byte-level vocabulary file.

    For every prefix of a piece there is exactly one token with which its encoding can end: one
    that is a suffix of the prefix and is compatible with the last token of what is before it.
    An automaton over the vocabulary names the suffixes, ``compatible`` tests pairs; following the
    stored tokens back from the end gives the ids. Time is linear in the length of the piece.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        plain = (
            model["type"] == "BPE"
            and not spec["normalizer"]
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(
                model.get(k)
                for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
            )
            and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        alphabet, vocab = byte_alphabet(), model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.content = {
            i: bytes(alphabet[c] for c in s) for s, i in vocab.items() if s not in self.added
        } | {i: s.encode() for s, i in self.added.items()}
        self.rank: dict[tuple[int, int], int] = {}
        halves: dict[int, list[tuple[int, int, int]]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.rank[a, b] = rank
            halves.setdefault(whole, []).append((rank, a, b))
        # tokens along the right and the left edge, smallest first, with the rank that ends each
        self.right_edge: dict[int, list[tuple[int, float]]] = {}
        self.left_edge: dict[int, list[tuple[int, float]]] = {}
        self.memo: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        tokens = sorted((i for s, i in vocab.items() if s not in self.added), key=lambda i: min(
            (rank for rank, _, _ in halves.get(i, ())), default=-1
        ))
        for i in tokens:
            made = (
                ((), ())
                if len(self.content[i]) == 1
                else next(
                    (
                        (self._ended(self.right_edge[b], rank), self._ended(self.left_edge[a], rank))
                        for rank, a, b in halves.get(i, ())
                        if a in self.right_edge and b in self.left_edge and not self._crosses(a, b, rank)
                    ),
                    None,
                )
            )
            if made is None:  # never the encoding of its own bytes, so never in any encoding
                continue
            self.right_edge[i] = [*made[0], (i, math.inf)]
            self.left_edge[i] = [*made[1], (i, math.inf)]
            text = self.content[i].decode("latin-1")
            self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.pattern = regex.compile(PATTERN)
        names = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(names)})") if names else None
        self.pieces: dict[str, bytes] = {"": b""}
        self.chunks: dict[str, bytes] = {}

    @staticmethod
    def _ended(edge: list[tuple[int, float]], rank: int) -> list[tuple[int, float]]:
        return [*edge[:-1], (edge[-1][0], rank)]

    def _crosses(self, a: int, b: int, before: float) -> bool:
        """Whether some merge of rank under ``before`` joins the end of ``a`` with the start of ``b``.

        Walks through both edges in the order in which their tokens are merged away. Of equal
        ranks the merge further left comes first.
        """
        ends, starts = self.right_edge[a], self.left_edge[b]
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = ends[i], starts[j]
            rank = self.rank.get((x, y), math.inf)
            if rank < x_ends and rank <= y_ends and rank < before:
                return True
            if x_ends <= y_ends:
                i += 1
                if i == len(ends):
                    return False
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` in a row are encoded as just these two tokens."""
        fits = not self._crosses(a, b, math.inf)
        if len(self.memo) < 2 * REMEMBERED:
            self.memo[a << 32 | b] = fits
        return fits

    def piece(self, data: bytes) -> list[int]:
        """The ids of one piece of text that the pattern does not split."""
        last, memo = [-1] * (len(data) + 1), self.memo
        for end, (token, length) in self.automaton.iter(data.decode("latin-1")):
            end += 1
            if last[end] < 0:
                start = end - length
                if start:
                    fits = memo.get(last[start] << 32 | token)
                    if fits is None:
                        fits = self.compatible(last[start], token)
                    if not fits:
                        continue
                last[end] = token
        ids, end = [], len(data)
        while end:
            ids.append(last[end])
            end -= len(self.content[last[end]])
        return ids[::-1]

    def _chunk(self, text: str) -> bytes:
        out = []
        plain = PLAIN.fullmatch(text)  # Latin letters and marks behind them need no other pattern
        for piece in plain.groups() if plain else self.pattern.findall(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = np.array(self.piece(piece.encode("utf-8")), "<i4").tobytes()
                if len(self.pieces) < REMEMBERED and len(piece) < 50:
                    self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return b"".join(
                np.array([self.added[p]], "<i4").tobytes() if k % 2 else self._plain(p)
                for k, p in enumerate(parts)
            )
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        first, *chunks = text.split(" ")
        found = list(map(self.chunks.get, chunks))  # known without the space in front
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            if not chunks[at] or chunks[at][0].isspace():  # several blanks in a row
                return self._spaced(text)
            found[at] = self._new_chunk(chunks[at])
        return self._chunk(first) + b"".join(found)

    def _spaced(self, text: str) -> bytes:
        first, *chunks = BOUNDARY.split(text)
        return self._chunk(first) + b"".join(self.chunks.get(c) or self._new_chunk(c) for c in chunks)

    def _new_chunk(self, chunk: str) -> bytes:
        ids = self._chunk(" " + chunk)
        if len(self.chunks) < REMEMBERED // 2 and len(chunk) < 50:
            self.chunks[chunk] = ids
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids; unknown ids give nothing, broken UTF-8 the replacement character."""
        try:
            data = b"".join(map(self.content.__getitem__, ids))
        except KeyError:
            data = b"".join(self.content.get(i, b"") for i in ids)
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """One encoder per worker and file, kept from task to task."""
    return Bpe(path)


def encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """``id`` and ``ids`` of batches with ``id`` and ``text``."""
    bpe = load(path)
    for batch in slices(batches, "text"):
        found = [bpe.encode(t) for t in batch["text"].to_pylist()]
        offsets = np.cumsum([0, *map(len, found)]) // 4
        flat = np.frombuffer(b"".join(found), "<i4")
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
        yield pa.RecordBatch.from_arrays([batch["id"], lists], ["id", "ids"])


def decode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """``id``, ``ids`` and the ``text`` they stand for, of batches with ``id`` and ``ids``."""
    bpe = load(path)
    for batch in batches:
        texts = [bpe.decode(ids.values.to_numpy(zero_copy_only=False).tolist()) for ids in batch["ids"]]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["ids"], pa.array(texts, pa.string())], ["id", "ids", "text"]
        )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and ``ids`` (array of int) of every whole text, as the vocabulary at ``path`` encodes it.

    Strings of added tokens become these tokens, none are added. ``path`` is a file on every
    executor. Null texts count as empty and have no ids; rows with null or repeated ids are encoded
    like others. An empty table gives no rows; other columns are not read.
    """
    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    encoded = rows.mapInArrow(lambda batches: encode_batches(batches, path), f"id {kind}, ids array<int>")
    return encoded.withColumnRenamed("id", id_col)


def decode(
    tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """Id, ``ids`` and the ``text`` they stand for. Null arrays count as empty; null ids are skipped."""
    rows = tokens.select(F.col(id_col).alias("id"), F.coalesce(ids_col, F.array()).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    decoded = rows.mapInArrow(
        lambda batches: decode_batches(batches, path), f"id {kind}, ids array<int>, text string"
    )
    return decoded.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``decode`` makes of what ``encode`` gives, in one worker instead of one for each step."""
    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    both = rows.mapInArrow(
        lambda batches: decode_batches(encode_batches(batches, path), path),
        f"id {kind}, ids array<int>, text string",
    )
    return both.withColumnRenamed("id", id_col)
