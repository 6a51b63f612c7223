"""Packing of tokenized documents into sequences of fixed length."""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from batchkit.llm.bpe import byte_alphabet
from batchkit.llm.common import slices
from batchkit.operators.staging import Stage

# Words, and parts of words, whose ids a worker keeps; what does not fit is encoded again.
REMEMBERED = 300_000
LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:!?]*)")


def pack_ids(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class WordTokenizer:
    """Ids of a tokenizers file, encoded word by word and remembered.

    Only for tokenizers that never look across a space: their normaliser keeps spaces apart from
    other characters and their pre-tokenizer drops white space. The file is probed for that, and for
    whether a word of Latin letters may go straight to its model, lower-cased and in the byte alphabet,
    apart from the marks behind it; all other words go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = {b: ord(c) for c, b in byte_alphabet().items()}
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"": b""}
        if not all(
            self._whole(f"{a} {b}\n{a}") == self._whole(a) + self._whole(b) + self._whole(a)
            for a, b in (("x", "y"), ("It's", "3rd."), ("é,", "́e"), ("ΑΣ", "-"))
        ):
            raise ValueError(f"the tokenizer of {path} looks across white space")
        probes = ("The", "house,", "Éa...", "straße!?", "ÜBER;", "aé:", "ÿÀx", "the.,;:!?")
        self.direct = all(self._latin(LATIN.fullmatch(p)) == self._whole(p) for p in probes)

    def _whole(self, text: str) -> bytes:
        return pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _latin(self, word: re.Match) -> bytes:
        return self._part(word[1].lower()) + self._part(word[2])

    def _part(self, text: str) -> bytes:
        ids = self.parts.get(text)
        if ids is None:
            spelled = text.encode().decode("latin-1").translate(self.letters)
            ids = pack_ids([t.id for t in self.model.tokenize(spelled)])
            if len(self.parts) < REMEMBERED and len(text) < 50:
                self.parts[text] = ids
        return ids

    def _word(self, word: str) -> bytes:
        latin = self.direct and LATIN.fullmatch(word)
        ids = self._latin(latin) if latin else self._whole(word)
        if len(self.known) < REMEMBERED and len(word) < 50:
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        words = text.replace("\n", " ").split(" ")
        found = list(map(self.known.get, words))
        at = -1
        for _ in range(found.count(None)):  # the words met first are the frequent ones
            at = found.index(None, at + 1)
            found[at] = self._word(words[at])
        return b"".join(found)


@lru_cache(maxsize=2)
def load(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces(
    docs: DataFrame,
    path: str,
    size: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The pieces of every document: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    A document is its ids by the tokenizers file at ``path`` (on every executor, no tokens added)
    and then ``end_id``; those longer than ``size`` are cut. ``with_ids`` adds the ids as binary
    column ``ids`` of little-endian unsigned 32-bit integers, over which the checksum is.

    Null and empty texts are one piece of length 1. Each row is a document, also where ids are
    null or repeated. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()
    names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for batch in slices(batches, "text"):
            at, number, start, length, check, ids = [], [], [], [], [], []
            for row, data in enumerate(map(tokenizer.encode, batch["text"].to_pylist())):
                data += end
                for k, first in enumerate(range(0, len(data), 4 * size)):
                    part = data[first : first + 4 * size]
                    at.append(row)
                    number.append(k)
                    start.append(first // 4)
                    length.append(len(part) // 4)
                    check.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [
                batch["id"].take(pa.array(at)),
                pa.array(number, pa.int32()),
                *(pa.array(c, pa.int64()) for c in (start, length, check)),
                *[pa.array(ids, pa.binary())] * with_ids,
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


class OpenBins:
    """Online best fit over at most ``limit`` open bins.

    Open bins are filed by free space; bit f of ``free`` says that there is a bin with f left. The
    tightest bin that fits is the lowest bit from the wanted length on. When one bin too many is
    open, the fullest is closed.
    """

    def __init__(self, size: int, limit: int):
        self.size, self.limit = size, limit
        self.free = 0
        self.bins: list[deque[int]] = [deque() for _ in range(size + 1)]
        self.open = self.made = 0

    def put(self, length: int) -> tuple[int, int]:
        """The number of the bin that takes a piece, and the place in it."""
        fits = self.free >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bin = self._take(space)
        else:
            space, bin = self.size, self.made
            self.made += 1
        if space > length:
            self.bins[space - length].append(bin)
            self.free |= 1 << (space - length)
            self.open += 1
            if self.open > self.limit:
                self._take((self.free & -self.free).bit_length() - 1)
        return bin, self.size - space

    def _take(self, space: int) -> int:
        bin = self.bins[space].popleft()
        self.open -= 1
        if not self.bins[space]:
            self.free &= ~(1 << space)
        return bin


def pack(
    pieces: DataFrame,
    size: int = 2048,
    open_bins: int = 1024,
    pieces_per_task: int = 50_000,
    ahead: int = 1024,
    id_col: str = "doc_id",
    longest_first: bool = False,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of at most ``size`` tokens.

    The pieces are dealt out at random but for good, about ``pieces_per_task`` to a task: by a hash of what
    is known of them and of their place in ``pieces``, so that rows that repeat are spread too. Each task
    places its own one by one in the order of the hash by ``OpenBins`` with at most ``open_bins``, of which
    the fullest closes first. It looks ``ahead`` at so many pieces at most and takes the longest of these
    first; 1 is without looking ahead. With ``longest_first`` all pieces of a task are sorted and no bin
    closes, which is not online and not bounded. Sequences are gapless from 0. ``pieces`` should be a
    written table, as it is counted first. Further columns stay; a longer piece raises an error.
    """
    tasks = max(1, round(pieces.count() / pieces_per_task))
    columns = pieces.columns
    place = F.monotonically_increasing_id()
    order = "_order"
    while order in columns:
        order += "_"
    dealt = pieces.withColumn(order, F.xxhash64(id_col, "piece", "start", "ids_crc32", place))
    dealt = dealt.repartition(tasks, order)
    first = [F.desc("length")] if longest_first else []
    dealt = dealt.sortWithinPartitions(*first, order).drop(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, sys.maxsize if longest_first else open_bins)
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            lengths = batch["length"].to_pylist()
            if lengths and max(lengths) > size:
                raise ValueError(f"a piece is longer than {size}")
            placed = [(0, 0)] * len(lengths)
            for first in range(0, len(lengths), ahead):
                window = range(first, min(first + ahead, len(lengths)))
                for row in sorted(window, key=lambda row: -lengths[row]):
                    placed[row] = bins.put(lengths[row])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([base + b for b, _ in placed], pa.int64()),
                    pa.array([o for _, o in placed], pa.int64()),
                ],
                [*columns, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str, size: int = 2048, stage: Stage | None = None, **options
) -> DataFrame:
    """``pieces`` of all documents with their places by ``pack``; lengths are written in between."""
    stage = stage or Stage(docs.sparkSession)
    return pack(stage.put(pieces(docs, path, size, **options), "pieces"), size)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id``, ``length`` and ``ids`` (binary) of pieces packed ``with_ids``.

    A sequence has ``size`` tokens at most, so its pieces are a bounded group.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.aggregate(
            parts, F.lit(b""), lambda whole, part: F.concat(whole, part["ids"])
        ).alias("ids"),
    )
