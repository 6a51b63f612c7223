"""Frequent phrases and their cohesion, counted by multikey quicksort of suffixes.

Every word starts a suffix of its piece, cut after ``depth`` words. A three-way multikey quicksort groups
equal suffixes: the suffixes that agree in their first d words form one partition, and its size is the
number of occurrences of this phrase of d words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from batchkit.llm.common import slices
from batchkit.operators.staging import Stage

END = 0  # the code of the end of a piece: no word
DITTO = 1  # the code of the mark for the word of the row before
SMALL = 64  # rows of a partition that is not split further

# Every mark that ends a piece becomes a line feed, every other separator of words a blank.
MARKS = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\t", b"\n" * 9 + b" ")


def tokens(text: bytes) -> list[bytes]:
    """Lower-cased words (A-Z) in order; ``.``, which no word can hold, stands for the end of a piece."""
    return text.lower().translate(MARKS).replace(b"\n", b" . ").split()


def equal_groups(
    columns: list[np.ndarray], weights: np.ndarray | None, least: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """The equal partitions of a three-way multikey quicksort.

    ``columns[d]`` has the code of word d of every row, ``END`` behind the last one. Yields a number of
    words, one row of each partition whose rows agree in so many first words, the partition's weight (the
    count of this phrase), and whether its rows are equal in whole. Phrases shorter than a row can be come
    once as such, and once more as whole rows if rows end there.

    All open partitions are split in one step: the word of a row in the middle is the pivot, the rows with
    a smaller, an equal and a larger word are put apart, in the order they had, and the equal ones
    go one word deeper. Without ``weights`` every row weighs one. Partitions that weigh less than
    ``least`` are abandoned, a row that is alone is in order already, and small partitions of which two words
    are left at most are put in order at once, as a quicksort does with its short ends.
    """
    depth_max, total = len(columns), len(columns[0])
    words = np.concatenate(columns)  # word d of row i is at d * total + i
    width = int(words.max(initial=0)).bit_length()
    bits = 2 * width
    rows = np.arange(total, dtype=np.int32)
    sizes = np.array([total] if total else [], np.int64)
    depths = np.zeros(len(sizes), np.int64)
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        alone = sizes == 1
        # two words are left at most, and fit into one number with the place of their partition
        small = ~alone & (sizes <= SMALL) & (depths >= depth_max - 2) & (bits + len(sizes).bit_length() < 64)
        if alone.any() or small.any():
            yield from _alone(columns, weights, rows[starts[alone]], depths[alone], least)
            some = rows[np.repeat(small, sizes)]
            yield from _small(words, total, weights, some, sizes[small], depths[small], width, depth_max, least)
            left = ~(alone | small)
            rows, sizes, depths = rows[np.repeat(left, sizes)], sizes[left], depths[left]
            starts = np.cumsum(sizes) - sizes
            if not len(sizes):
                return
        pivots = words.take(depths * total + rows[starts + sizes // 2])
        here = words.take(np.repeat(depths * total, sizes) + rows)
        there = np.repeat(pivots, sizes)
        sides = (here < there, here == there, here > there)
        fewer, same = (np.add.reduceat(side, starts, dtype=np.int64) for side in sides[:2])
        counts = np.stack([fewer, same, sizes - fewer - same], axis=1)
        places = (np.cumsum(counts) - counts.ravel()).reshape(counts.shape)
        moved = np.empty_like(rows)
        for k, side in enumerate(sides):
            before = np.cumsum(counts[:, k]) - counts[:, k]
            at = np.flatnonzero(side)
            moved[np.arange(len(at)) + np.repeat(places[:, k] - before, counts[:, k])] = rows[at]
        rows, owner = moved, np.repeat(np.arange(len(sizes)), 3)
        equal = np.tile([False, True, False], len(sizes))
        sizes = counts.ravel()
        filled = sizes > 0
        sizes, owner, equal = sizes[filled], owner[filled], equal[filled]
        starts = np.cumsum(sizes) - sizes
        weight = sizes if weights is None else np.add.reduceat(weights.take(rows), starts)
        ended = equal & (pivots[owner] == END)
        depths = depths[owner] + equal
        live = weight >= least
        whole = live & (ended | (depths == depth_max))
        for d in range(depth_max):
            for final, chosen in ((False, live & equal & ~whole), (True, whole)):
                some = np.flatnonzero(chosen & (depths - ended == d + 1))
                if len(some):
                    yield d + 1, rows[starts[some]], weight[some], final
        live &= ~whole
        rows, sizes, depths = rows[np.repeat(live, sizes)], sizes[live], depths[live]


def _alone(columns, weights, rows, depths, least):
    """What is left to say of single rows, whose first ``depths`` words are settled."""
    weight = np.ones(len(rows), np.int64) if weights is None else weights[rows]
    some = weight >= least
    rows, depths, weight = rows[some], depths[some], weight[some]
    lengths = sum((c[rows] != END).astype(np.int64) for c in columns)
    for d in range(len(columns)):
        for final, chosen in (
            (False, (depths <= d) & (lengths > d) & (d + 1 < len(columns))),
            (True, lengths == d + 1),
        ):
            if chosen.any():
                yield d + 1, rows[chosen], weight[chosen], final


def _small(words, total, weights, rows, sizes, depths, width, depth_max, least):
    """The equal partitions inside small ones, by the one or two words that are not settled."""
    if not len(rows):
        return
    depth = np.repeat(depths, sizes)
    here = words.take(depth * total + rows).astype(np.int64)
    further = (here != END) & (depth + 1 < depth_max)
    there = np.zeros_like(here)
    there[further] = words.take((depth[further] + 1) * total + rows[further])
    key = np.repeat(np.arange(len(sizes)), sizes) << 2 * width | here << width | there
    order = np.argsort(key)
    key, rows, depth, here, there = (x[order] for x in (key, rows, depth, here, there))
    weight = None if weights is None else weights.take(rows)
    for step, word, keep in ((0, here, None), (1, there, (here != END) & (depth + 1 < depth_max))):
        prefix = key >> width if step == 0 else key
        starts = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1]))
        if weight is None:
            sums = np.diff(np.append(starts, len(key)))
        else:
            sums = np.add.reduceat(weight, starts)
        live = sums >= least
        if keep is not None:
            live &= keep[starts]
        starts, sums = starts[live], sums[live]
        ended = word[starts] == END
        length = depth[starts] + step + ~ended
        final = ended | (length == depth_max)
        for d in range(1, depth_max + 1):
            for whole in (False, True):
                some = (length == d) & (final == whole)
                if some.any():
                    yield d, rows[starts[some]], sums[some], whole


class Words(dict):
    """Codes of the words that a task meets, in the order it meets them."""

    def __init__(self):
        super().__init__({b".": END, b",": DITTO})

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int32, len(words))

    def hashes(self) -> np.ndarray:
        """Hashes of the words by their codes, the same in every task."""
        return np.fromiter(map(xxhash.xxh64_intdigest, self), np.uint64, len(self))


def route(lang: str, leading: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """A hash of the language and the leading words of every row."""
    mixed = np.full(len(leading[0]), xxhash.xxh64_intdigest(lang), np.uint64)
    for codes in leading:
        mixed = (mixed ^ hashes[codes]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def parcels(
    lang: str,
    columns: list[np.ndarray],
    counts: np.ndarray,
    names: list[bytes],
    hashes: np.ndarray,
    level: int,
    parts: int,
) -> Iterator[tuple[int, int, bytes]]:
    """The rows of a language by ``route`` of ``level`` words modulo ``parts``: bucket, rows, packed rows.

    Packed are the words of the rows, each once, the places of the rows' words among them and the counts; a
    word that is the same as in the row before, as are all words in front of it, is a mark.
    """
    bucket = (route(lang, columns[:level], hashes) % np.uint64(parts)).astype(np.int64)
    key, width, bits = bucket, len(names).bit_length(), parts.bit_length()
    for codes in columns:  # rows with the same first words side by side, as far as a number goes
        if bits + width > 63:
            break
        key, bits = key << width | codes, bits + width
    order = np.argsort(key)
    bucket, counts = bucket[order], counts[order]
    lines = np.stack([c[order] for c in columns], axis=1)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    same = np.logical_and.accumulate(lines[1:] == lines[:-1], axis=1)
    same[starts[1:] - 1] = False
    lines[1:][same] = DITTO
    codec = pa.Codec("zstd", 1)
    for first, last in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)], strict=True):
        distinct, places = np.unique(lines[first:last], return_inverse=True)
        text = b" ".join([names[code] for code in distinct.tolist()])
        number = counts[first:last]
        kinds = [np.min_scalar_type(int(most)) for most in (len(distinct), number.max())]
        data = text + places.astype(kinds[0]).tobytes() + number.astype(kinds[1]).tobytes()
        head = b"".join(n.to_bytes(8) for n in (len(data), len(text), *(k.itemsize for k in kinds)))
        yield int(bucket[first]), last - first, head + codec.compress(data, asbytes=True)


def unpack(packed: bytes, rows: int, depth: int, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a line for each row) and counts of packed rows."""
    size, text, *widths = (int.from_bytes(packed[i : i + 8]) for i in range(0, 32, 8))
    data = pa.Codec("zstd").decompress(packed[32:], size, asbytes=True)
    codes = words.of(data[:text].split(b" "))
    places, counts = (np.dtype(f"u{width}") for width in widths)
    lines = codes[np.frombuffer(data, places, rows * depth, text)].reshape(rows, depth)
    for d in range(depth - 1):
        known = np.where(lines[:, d] != DITTO, np.arange(rows), 0)
        lines[:, d] = lines[np.maximum.accumulate(known), d]
    counts = np.frombuffer(data, counts, rows, text + rows * depth * places.itemsize)
    return lines, counts.astype(np.int64)


class Suffixes:
    """Suffixes of texts as pointers into one row of word codes, some languages side by side."""

    def __init__(self, depth: int):
        self.depth = depth
        self.clear()

    def clear(self) -> None:
        self.words = Words()
        self.langs: list[str] = []
        self.runs: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        self.langs.append(lang)
        self.runs.append(self.words.of(tokens(text)))
        self.size += len(self.runs[-1])

    def combined(self, buckets: int) -> pa.RecordBatch:
        """Each language and suffix once, with the number of its occurrences, as ``PARCELS``."""
        gap = np.zeros(self.depth, np.int32)
        line = np.concatenate([part for run in self.runs for part in (run, gap)])
        langs = list(dict.fromkeys(self.langs))
        numbers = {lang: k for k, lang in enumerate(langs)}
        spoken = np.array([numbers[lang] + 1 for lang in self.langs], np.int32)
        spoken = np.repeat(spoken, [len(run) + self.depth for run in self.runs])
        pointers = np.flatnonzero(line)
        columns = [spoken[pointers], line[pointers]]
        for d in range(1, self.depth):
            columns.append(np.where(columns[-1] == END, END, line[pointers + d]))
        groups = equal_groups(columns, None, 1)
        found = [(rows, weight) for _, rows, weight, whole in groups if whole]
        made = []
        if found:
            rows = np.concatenate([r for r, _ in found])
            counts = np.concatenate([w for _, w in found])
            spelled = list(self.words), self.words.hashes()
            for k, lang in enumerate(langs):
                own = columns[0][rows] == k + 1
                if own.any():
                    some = [c[rows[own]] for c in columns[1:]]
                    total = int(counts[own].sum())
                    for parcel in parcels(lang, some, counts[own], *spelled, 1, buckets):
                        made.append((lang, *parcel, total))
                        total = 0
        self.clear()
        columns = zip(*made, strict=True) if made else ((), (), (), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, PARCEL_TYPES, strict=True)], PARCEL_NAMES
        )


PARCELS = "lang string, bucket long, rows long, packed binary, n long"
PARCEL_NAMES = [part.split()[0] for part in PARCELS.split(", ")]
PARCEL_TYPES = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64())


def local_suffixes(
    docs: DataFrame, depth: int, window: int, buckets: int, text_col: str, lang_col: str
) -> DataFrame:
    """The suffixes of all texts in parcels, one for each language and ``route`` of the leading word.

    Each task sorts about ``window`` suffixes at a time, so equal ones are one row with a count. ``n`` adds
    up to the number of words of a language.
    """
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = Suffixes(depth)
        for batch in slices(batches, "text"):
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for lang, text in zip(batch["lang"].to_pylist(), texts, strict=True):
                suffixes.add(lang, text)
                if suffixes.size >= window:
                    yield suffixes.combined(buckets)
        if suffixes.size:
            yield suffixes.combined(buckets)

    return rows.mapInArrow(run, PARCELS)


def _spelled(names: list[bytes], lines: np.ndarray, lang: str, counts: np.ndarray):
    """A batch of phrases: language, words and count. Only the words they hold are spelled."""
    distinct, places = np.unique(lines, return_inverse=True)
    words = pa.array([names[code] for code in distinct.tolist()], pa.binary()).cast(pa.string())
    flat = words.take(pa.array(places.ravel()))
    listed = pa.ListArray.from_arrays(
        pa.array(np.arange(len(lines) + 1, dtype=np.int32) * lines.shape[1]), flat
    )
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(lines), np.int32)))
    return pa.RecordBatch.from_arrays([langs, listed, pa.array(counts)], ["lang", "words", "f"])


PHRASES = "lang string, words array<string>, f long"


def phrase_counts(
    suffixes: DataFrame, depth: int, least: int, stage: Stage, rows_per_task: int
) -> DataFrame:
    """``lang``, ``words`` and ``f`` of all phrases of up to ``depth`` words with f >= ``least``.

    ``suffixes`` is a written table of ``local_suffixes``. Parcels of one bucket, which hold all rows of
    their leading words, meet in one task, and ``equal_groups`` counts them. A bucket of more than
    ``rows_per_task`` rows is dealt out anew by the first two words of its rows, after equal ones of some
    parcels are combined, a part of it that is still too large by three, and so on. The counts of the words that no longer meet are added up on the way.
    """
    keys = ["lang", "bucket"]
    ready, found, left = [], [], suffixes.select("lang", "bucket", "rows", "packed", F.lit(0).alias("level"))
    for level in range(1, depth):
        sizes = left.groupBy(*keys).agg(F.sum("rows").alias("_all"))
        hot = sizes.filter(F.col("_all") > rows_per_task)
        hot = hot.withColumn("_groups", F.ceil(F.col("_all") / rows_per_task))
        hot = stage.put(hot, f"crowded-{level}")
        groups = hot.agg(F.sum("_groups")).first()[0]
        if not groups:
            break
        crowded = left.join(hot, keys)
        ready.append(left.join(hot, keys, "left_anti"))

        def deal(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[str, int, int], tuple[Words, list]] = {}
            for batch in batches:
                for lang, bucket, rows, packed, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    words, some = held.setdefault((lang, bucket, parts), (Words(), []))
                    some.append(unpack(packed, rows, depth, words))
            for (lang, bucket, parts), (words, some) in held.items():
                columns = list(np.concatenate([lines for lines, _ in some]).T)
                weights = np.concatenate([counts for _, counts in some])
                some.clear()
                merged = [(r, w) for _, r, w, whole in equal_groups(columns, weights, 1) if whole]
                at, counts = (np.concatenate(x) for x in zip(*merged, strict=True))
                columns = [c[at] for c in columns]
                spelled = list(words), words.hashes()
                made = [
                    (lang, (bucket * 1_000_003 + part) % (1 << 61), n, data)
                    for part, n, data in parcels(lang, columns, counts, *spelled, level + 1, parts)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made, strict=True), PARCEL_TYPES, strict=False)],
                    PARCEL_NAMES[:4],
                )

        def add(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lang, rows, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    words = Words()
                    lines, counts = unpack(packed, rows, depth, words)
                    lines = lines[:, :level]
                    full = lines[:, -1] != END
                    lines, counts = lines[full], counts[full]
                    if len(lines):
                        new = np.flatnonzero(np.append(True, (lines[1:] != lines[:-1]).any(axis=1)))
                        yield _spelled(list(words), lines[new], lang, np.add.reduceat(counts, new))

        # parcels of a bucket meet in groups of bounded size, so that those dealt out anew are not tiny
        group = F.pmod(F.xxhash64("packed"), F.col("_groups"))
        gathered = crowded.withColumn("_group", group).repartition(groups, *keys, "_group")
        dealt = gathered.select("lang", "bucket", "rows", "packed", 4 * F.col("_groups")).mapInArrow(
            deal, ", ".join(PARCELS.split(", ")[:4])
        )
        left = stage.put(dealt.withColumn("level", F.lit(level)), f"dealt-{level}")
        summed = crowded.select("lang", "rows", "packed").mapInArrow(add, PHRASES).groupBy("lang", "words").agg(F.sum("f").alias("f"))
        found.append(summed.filter(F.col("f") >= least))
    ready.append(left)
    routed = ready[0]
    for more in ready[1:]:
        routed = routed.unionByName(more)
    tasks = max(1, round(routed.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0] / rows_per_task))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[Words, list]] = {}
        for batch in batches:
            for lang, _, rows, packed, level in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, parts = held.setdefault((lang, level), (Words(), []))
                parts.append(unpack(packed, rows, depth, words))
        for (lang, level), (words, parts) in held.items():
            columns = list(np.concatenate([lines for lines, _ in parts]).T)
            weights = np.concatenate([counts for _, counts in parts])
            parts.clear()
            names = list(words)
            # a word that is rare at its place is part of no frequent phrase: the row ends before it
            for d in range(1, depth):
                rare = np.bincount(columns[d], weights, len(names)) < least
                ends = rare[columns[d]]
                for further in range(d, depth):
                    columns[further] = np.where(ends, END, columns[further])
            frequent: dict[int, list] = {}
            for length, rows, weight, whole in equal_groups(columns, weights, least):
                if length > level and (length == depth or not whole):
                    frequent.setdefault(length, []).append((rows, weight))
            for length, some in frequent.items():
                rows, weight = (np.concatenate(x) for x in zip(*some, strict=True))
                lines = np.stack([c[rows] for c in columns[:length]], axis=1)
                yield _spelled(names, lines, lang, weight)

    counted = routed.repartition(tasks, *keys, "level").mapInArrow(count, PHRASES)
    for more in found:
        counted = counted.unionByName(more)
    return counted


def mine(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    absorbed: int = 50,
    top: int = 2000,
    window: int = 1 << 20,
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_task: int = 600_000,
    buckets: int = 256,
    stage: Stage | None = None,
) -> DataFrame:
    """The most cohesive phrases of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces, these at blanks and tabs
    into words. Phrases of 2 to ``longest`` words that occur a >= ``least`` times are candidates. Cutting one
    after k words gives l and r, the counts of both parts, and floor(1000000 * a * a / (l * r)); the lowest
    score counts, among equals that of the smallest k. A candidate that lies inside a longer one with
    at least ``absorbed`` percent of its count is dropped. The ``top`` of each language are returned by score, a
    (both descending) and phrase (by its bytes). ``n`` is the number of words of the language.

    Suffixes are sorted and combined in each task (``local_suffixes``), then routed by leading words
    and counted (``phrase_counts``), about ``rows_per_task`` in a task. ``buckets`` says how far a language is
    dealt out at once; buckets that are too large for a task are dealt out further. Products are decimals of 38 digits, exact up to counts of 14.
    Null languages are ``und``, null texts empty; a very long text is one window of its own. Repeated
    rows count each time, an empty table or one without frequent phrases gives no rows, other columns
    are not read.
    """
    stage = stage or Stage(docs.sparkSession)
    suffixes = stage.put(
        local_suffixes(docs, longest, window, buckets, text_col, lang_col), "suffixes"
    )
    totals = stage.put(suffixes.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    counts = phrase_counts(suffixes, longest, least, stage, rows_per_task)
    phrases = stage.put(
        counts.select("lang", F.array_join("words", " ").alias("phrase"), "words", "f"), "phrases"
    )
    candidates = phrases.filter(F.size("words") > 1)
    cuts = candidates.select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - 1),
                lambda k: F.struct(
                    k.alias("k"),
                    F.array_join(F.slice("words", F.lit(1), k), " ").alias("first"),
                    F.array_join(F.slice("words", k + 1, F.size("words")), " ").alias("rest"),
                ),
            )
        ).alias("cut"),
    ).select("lang", "phrase", "a", "cut.*")
    for side, name in (("first", "l"), ("rest", "r")):
        known = phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(known, ["lang", side])
    a, l, r = (F.col(c).cast("decimal(14,0)") for c in ("a", "l", "r"))
    cuts = cuts.withColumns({"_over": a * a * F.lit(1_000_000).cast("decimal(7,0)"), "_under": l * r})
    scored = (
        cuts.withColumn("score", F.expr("_over div _under"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inside = candidates.filter(F.size("words") > 2).select(
        "lang",
        F.col("f").alias("_longer"),
        F.explode(
            F.expr(
                "flatten(transform(sequence(2, size(words) - 1), m -> "
                "transform(sequence(1, size(words) - m + 1), i -> array_join(slice(words, i, m), ' '))))"
            )
        ).alias("phrase"),
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.col("_longer").isNull() | (100 * F.col("_longer") < absorbed * F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    place = F.row_number()
    # the best of ever larger parts of a language, so that no step brings more than 8 * top rows together
    for parts in (64, 8, 1):
        kept = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
        kept = kept.withColumn("rank", place.over(Window.partitionBy("lang", "_part").orderBy(*order)))
        kept = kept.filter(F.col("rank") <= top)
    return (
        kept.join(totals, "lang")
        .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
    )
