"""Document fingerprints by weighted SimHash, and those within a Hamming radius by permuted block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from batchkit.llm import cells
from batchkit.llm.common import slices
from batchkit.llm.words import Codes
from batchkit.operators.staging import Stage

BITS = 256
LONG_WORD, PART = 40, 4
# Bit b of every byte value as +1 or -1: a histogram of bytes times this is the vote on eight bits.
VOTES = 2 * np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64) - 1
CODES = Codes(lambda word: xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 1))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _words(text: str) -> list[str]:
    words = text.lower().split()
    if words and max(map(len, words)) > LONG_WORD:
        words = [
            part
            for word in words
            for part in (
                [word]
                if len(word) <= LONG_WORD
                else [word[i : i + PART] for i in range(len(word) - PART + 1)]
            )
        ]
    return words


def terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's terms and their weights as whole numbers.

    Terms are its lower-cased words and its pairs of neighbouring words; a word above 40 characters
    (a text without blanks) is taken as its overlapping parts of four. A term that occurs n times
    weighs 16 * (1 + ln n), rounded, so that common words do not outvote all others.
    """
    words = _words(text)
    single = np.fromiter(map(CODES.__getitem__, words), np.uint64, len(words))
    paired = _mix(single[:-1] * np.uint64(0x9E3779B97F4A7C15) + single[1:])
    found, counts = np.unique(np.concatenate([single, paired]), return_counts=True)
    return found, np.rint(16 * (1 + np.log(counts))).astype(np.int64)


def fingerprint(text: str, bits: int = BITS) -> bytes:
    """Each term votes with its weight for or against every bit, by the bits of its hash.

    ``bits`` is a multiple of 64. A text without words has the fingerprint zero.
    """
    found, weights = terms(text)
    if not len(found):
        return bytes(bits // 8)
    votes = []
    for word in range(bits // 64):
        hashed = _mix(found + np.uint64((word + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1))
        octets = hashed.astype("<u8").view(np.uint8).reshape(-1, 8)
        for place in range(8):
            votes.append(np.bincount(octets[:, place], weights, 256) @ VOTES)
    return np.packbits(np.concatenate(votes) > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of bits in which two fingerprints agree."""
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / (8 * len(a))


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the first of ``following``, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def block_tables(bits: int, radius: int, shared: int) -> list[np.ndarray]:
    """The leading bits of every permuted table.

    The bits are cut into ``radius + shared`` blocks. Differing bits spoil ``radius`` of them at most,
    so two prints within the radius agree in ``shared`` whole blocks. There is a table for every
    choice of so many blocks, with these moved to the front.
    """
    blocks = np.array_split(np.arange(bits), radius + shared)
    chosen = [np.concatenate(c) for c in combinations(blocks, shared)]
    if max(map(len, chosen)) > 63:
        raise ValueError("fewer shared blocks or a larger radius: a key has 63 bits at most")
    return chosen


def _unpack(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1)


def count_within(
    prints: DataFrame,
    radius: int = 12,
    bits: int = BITS,
    shared_blocks: int = 1,
    block: int = 1024,
    column: str = "fingerprint",
    stage: Stage | None = None,
) -> DataFrame:
    """``fingerprint`` and ``n_near``: how many other rows lie within ``radius`` bits of it.

    Only fingerprints that have such rows are returned, each once. Equal fingerprints are one point
    with a weight, so a group of copies of any size costs one row. Points that agree in the leading
    bits of one of the ``block_tables`` are compared in Arrow batches; a pair that meets in several
    tables counts in the first. The tables miss no pair. A crowded cell is cut into blocks (see
    ``cells``) and hands on one sum for each of its points, never its pairs. With the default 13 tables
    a key has 19 or 20 bits; for inputs far above 10^8 distinct prints raise ``shared_blocks``.

    Rows without a fingerprint take no part; an empty table gives no rows.
    """
    stage = stage or Stage(prints.sparkSession)
    leading = block_tables(bits, radius, shared_blocks)
    points = stage.put(
        prints.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("point"))
        .agg(F.count(F.lit(1)).alias("weight")),
        "points",
    )

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = np.unpackbits(_unpack(batch["point"].to_pylist()), axis=1)
            for number, chosen in enumerate(leading):
                keys = flat[:, chosen] @ (1 << np.arange(len(chosen), dtype=np.int64))
                which = pa.array(np.full(len(keys), number, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [which, pa.array(keys), batch["point"], batch["weight"]],
                    ["_table", "_key", "point", "weight"],
                )

    entered = stage.put(
        points.mapInArrow(enter, "_table int, _key long, point binary, weight long"), "tables"
    )
    cell = ["_table", "_key"]
    dealt = cells.meetings(entered, cell, "point", stage, block)
    masks = np.zeros((len(leading), bits), np.uint8)
    for number, chosen in enumerate(leading):
        masks[number, chosen] = 1
    masks = np.packbits(masks, axis=1).view(np.uint64)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, after in cells.whole_groups(batches, [*cell, *cells.GROUP]):
            busy = after > 0
            busy[1:] |= busy[:-1].copy()
            at = np.flatnonzero(busy)
            if not len(at):
                continue
            words = np.zeros((table.num_rows, bits // 64), np.uint64)
            words[at] = _unpack(table["point"].take(pa.array(at)).to_pylist()).view(np.uint64)
            weight, number = table["weight"].to_numpy(), table["_table"].to_numpy()
            found = np.zeros(table.num_rows, np.int64)
            for a, b in cells.pairs(after, table):
                for part in np.array_split(np.arange(len(a)), len(a) // 100_000 + 1):
                    x, y = a[part], b[part]
                    differ = words[x] ^ words[y]
                    near = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= radius
                    x, y, differ = x[near], y[near], differ[near]
                    agree = ((differ[:, None, :] & masks) == 0).all(axis=2)
                    first = agree.argmax(axis=1) == number[x]
                    x, y = x[first], y[first]
                    np.add.at(found, x, weight[y])
                    np.add.at(found, y, weight[x])
            some = pa.array(np.flatnonzero(found))
            yield pa.RecordBatch.from_arrays(
                [table["point"].combine_chunks().take(some), pa.array(found).take(some)],
                ["point", "others"],
            )

    others = dealt.mapInArrow(compare, "point binary, others long")
    twins = points.filter("weight > 1").select("point", (F.col("weight") - 1).alias("others"))
    return (
        others.unionByName(twins)
        .groupBy("point")
        .agg(F.sum("others").alias("n_near"))
        .withColumnRenamed("point", column)
    )


RESULT = "n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
ENDS = "_part int, _end string, _text binary"


class Results:
    """Rows of results in columns, turned into Arrow batches."""

    def __init__(self, bits: int):
        self.bits = bits
        self.rows: list[tuple] = []
        self.ids: list[pa.Array] = []

    def add(self, id: pa.Array, text: str, following: str, own: bytes, other: bytes, *more) -> None:
        edited = edit(text, following)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        changed = own if edited == text else fingerprint(edited, self.bits)
        self.ids.append(id)
        self.rows.append(
            (len(text), sha, own, changed, likeness(own, changed), likeness(own, other), *(more or (None,) * 3))
        )

    def add_end(self, id: pa.Array, end: str, packed: bytes, part: int) -> None:
        self.ids.append(id)
        self.rows.append((*(None,) * 6, part, end, packed))

    def batch(self, id_type: pa.DataType) -> pa.RecordBatch:
        kinds = (
            pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64(),
            pa.int32(), pa.string(), pa.binary(),
        )
        columns = list(zip(*self.rows, strict=True)) or [()] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        ids = pa.concat_arrays(self.ids) if self.ids else pa.array([], id_type)
        names = [part.split()[0] for part in f"{RESULT}, {ENDS}".split(", ")]
        self.rows, self.ids = [], []
        return pa.RecordBatch.from_arrays([ids, *arrays], ["id", *names])


def compare_edits(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bits: int = BITS,
    radius: int = 12,
    stage: Stage | None = None,
) -> DataFrame:
    """The fingerprint of every document beside those of its edited text and of the next document.

    Returns id, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex
    digits), ``near_edited``, ``near_next`` (shares of equal bits) and ``n_near``, the number of other
    documents within ``radius`` bits. The edited text is ``edit`` of the text and the next one in order
    of the id, after the last one the first.

    The texts, compressed, are shuffled once, by ranges of the id. A task walks through its sorted
    documents; the last of it waits for the first of the next task, so each task leaves two
    texts, which a second small job brings together. Repeated ids are ordered by a hash of the
    text, and equal rows are spread over tasks too. Null texts count as empty and null ids are first.
    A single document is its own next. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    stage = stage or Stage(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text).alias("_hash"),
        F.monotonically_increasing_id().alias("_salt"),
        text.alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in slices(batches, "text"):
            data = [t.encode("utf-8", "surrogatepass") for t in batch["text"].to_pylist()]
            packed = [len(d).to_bytes(8) + codec.compress(d, asbytes=True) for d in data]
            columns = [*batch.columns[:3], pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "_hash", "_salt", "packed"])

    order = ["id", "_hash", "_salt"]
    sorted_rows = (
        rows.mapInArrow(pack, f"id {kind}, _hash long, _salt long, packed binary")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("id", "packed")
    )

    def unpack(packed: bytes) -> str:
        size = int.from_bytes(packed[:8])
        data = pa.Codec("zstd").decompress(packed[8:], size, asbytes=True) if size else b""
        return data.decode("utf-8", "surrogatepass")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, results, before = TaskContext.get().partitionId(), Results(bits), None
        for batch in slices(batches, "packed"):
            for row, packed in enumerate(batch["packed"].to_pylist()):
                id, text = batch["id"].slice(row, 1), unpack(packed)
                own = fingerprint(text, bits)
                if before is None:
                    results.add_end(id, "first", packed, part)
                else:
                    results.add(*before[:2], text, before[2], own)
                before = id, text, own, packed
            yield results.batch(batch["id"].type)
        if before is not None:
            results.add_end(before[0], "last", before[3], part)
            yield results.batch(before[0].type)

    walked = stage.put(sorted_rows.mapInArrow(walk, f"id {kind}, {RESULT}, {ENDS}"), "walked")
    ends = walked.filter("_end IS NOT NULL").select("id", "_part", "_end", "_text")
    # one row for each task of the walk
    following = ends.filter("_end = 'first'").select(
        F.coalesce(
            F.lag("_part").over(Window.orderBy("_part")), F.max("_part").over(Window.partitionBy())
        ).alias("_part"),
        F.col("_text").alias("_next"),
    )
    open_rows = ends.filter("_end = 'last'").join(following, "_part").select("id", "_text", "_next")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        results = Results(bits)
        for batch in batches:
            for row in range(batch.num_rows):
                text, other = (unpack(batch[c][row].as_py()) for c in ("_text", "_next"))
                own = fingerprint(text, bits)
                results.add(batch["id"].slice(row, 1), text, other, own, fingerprint(other, bits))
            yield results.batch(batch["id"].type)

    closed = stage.put(open_rows.mapInArrow(finish, f"id {kind}, {RESULT}, {ENDS}"), "closed")
    done = walked.filter("_end IS NULL").union(closed).drop("_part", "_end", "_text")
    near = stage.put(count_within(done, radius, bits, stage=stage), "near")
    return done.join(near, "fingerprint", "left").select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
