"""Web archives: WARC records with revisits, read back into one ordered index of captures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from batchkit.operators.staging import Stage

END = "\r\n\r\n"
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "url_key string, timestamp string, page_id long, url string, file string, offset long, length long, "
    "payload_bytes long, payload_digest string, record_type string, refers_to long"
)
ORDER = ["url_key", "timestamp", "page_id", "file", "offset"]
NO_ID = "<urn:uuid:00000000-0000-0001-0000-000000000000>"  # of records whose page has no id


def record_id(page_id: Column) -> Column:
    """A URN in UUID form that holds the 64 bits of the id; ``NO_ID`` for null."""
    digits = F.lower(F.lpad(F.hex(page_id.cast("long")), 16, "0"))
    urn = F.concat(
        F.lit("<urn:uuid:00000000-0000-0000-"), F.substring(digits, 1, 4), F.lit("-"),
        F.substring(digits, 5, 12), F.lit(">"),
    )
    return F.coalesce(urn, F.lit(NO_ID))


def page_of(urn: str) -> int | None:
    if urn == NO_ID:
        return None
    number = int(urn.strip("<>").replace("-", "")[-16:], 16)
    return number - (1 << 64) if number >> 63 else number


def header_safe(text: Column) -> Column:
    """Blanks and line ends, which would end a header field, percent-encoded."""
    for bad, code in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A")):
        text = F.replace(text, F.lit(bad), F.lit(code))
    return text


def with_revisits(pages: DataFrame, least_bytes: int, stage: Stage) -> DataFrame:
    """Adds ``bytes`` of the payload and ``refers_to``, null but for repeated payloads.

    Payloads are equal if their SHA-256 and lengths are. Each group's largest id is found by an
    aggregate that combines before the shuffle. Only groups of two or more are joined back: Spark
    broadcasts the written list if it is small, and splits hot digests where it is not.
    """
    rows = pages.withColumns(
        {
            "bytes": F.octet_length("html").cast("long"),
            "same": F.unhex(F.sha2(F.col("html"), 256)),
        }
    )
    groups = (
        rows.filter(F.col("bytes") >= least_bytes)
        .groupBy("same", "bytes")
        .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .drop("n")
    )
    found = rows.join(stage.put(groups, "repeated"), ["same", "bytes"], "left")
    # of rows that repeat the response's id, all are responses: no record refers to itself
    other = F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    return found.withColumn("refers_to", other).drop("first", "same")


def records(rows: DataFrame) -> DataFrame:
    """The text of one WARC record per row, without the two line ends behind it."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    fields = [
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", record_id(F.col("id"))),
        ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", header_safe(F.col("url"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(F.col("html")))),
        ("WARC-Profile", F.when(revisit, SAME_PAYLOAD)),
        ("WARC-Refers-To", F.when(revisit, record_id(F.col("refers_to")))),
        ("Content-Type", F.lit("application/http;msgtype=response")),
        ("Content-Length", F.octet_length(block).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]  # null if there is none
    head = F.concat_ws("\r\n", F.lit(VERSION), *lines)
    return rows.select(F.concat(head, F.lit(END), block).alias("value"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    date_col: str | None = None,
    date: str = "2024-01-01T00:00:00Z",
    least_bytes: int = 1000,
    stage: Stage | None = None,
) -> None:
    """Write one gzipped archive per task below ``path``, a record for each page.

    Of pages with equal payloads (the html in UTF-8, null as empty) of at least ``least_bytes``, the
    one with the largest id is a response and the others are revisits of it, without payload; all
    smaller ones are responses. ``date_col`` holds the time of capture as text, else it is ``date``.
    A row without an id has a record of its own, read back as null; it refers to the response like any
    other copy, and where no copy has an id all of them are responses. A null url is written as empty.
    An empty table gives archives without records.
    """
    stage = stage or Stage(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(url_col, F.lit("")).alias("url"),
        F.coalesce(html_col, F.lit("")).alias("html"),
        (F.coalesce(F.col(date_col), F.lit(date)) if date_col else F.lit(date)).alias("date"),
    )
    made = records(with_revisits(rows, least_bytes, stage))
    made.write.option("lineSep", END).option("compression", "gzip").mode("overwrite").text(path)


@dataclass
class Reader:
    """Takes an archive piece by piece and gives its records as they become complete.

    Only the current record is held. Offsets and lengths are those in the unpacked archive.
    """

    file: str
    offset: int = 0
    head: dict[str, str] | None = None
    head_size: int = 0
    need: int = 0
    parts: list[bytes] = field(default_factory=list)
    size: int = 0

    def feed(self, data: bytes) -> Iterator[dict]:
        self.parts.append(data)
        self.size += len(data)
        while self.size >= self.need:
            data = b"".join(self.parts)
            if self.head is None:
                end = data.find(b"\r\n\r\n")
                # a file may end inside what the pieces were cut at, so line ends may be left over
                if end < 0 or not data.strip(b"\r\n"):
                    self.parts = [data]
                    return
                first, *lines = data[:end].decode("utf-8").split("\r\n")
                if first != VERSION:
                    raise ValueError(f"{self.file} has no record at {self.offset}")
                self.head = dict(line.split(": ", 1) for line in lines)
                self.head_size = end + 4
                self.need = int(self.head["Content-Length"]) + 4
                data = data[end + 4 :]
            if len(data) < self.need:
                self.parts, self.size = [data], len(data)
                return
            block, rest = data[: self.need - 4], data[self.need :]
            yield self._entry(self.head, block)
            self.offset += self.head_size + self.need
            self.head, self.need = None, 0
            self.parts, self.size = [rest], len(rest)
            if not rest:
                return

    def _entry(self, head: dict[str, str], block: bytes) -> dict:
        start = block.index(b"\r\n\r\n") + 4
        http = dict(line.split(": ", 1) for line in block[: start - 4].decode("utf-8").split("\r\n")[1:])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        length, refers = int(http["Content-Length"]), head.get("WARC-Refers-To")
        if refers is None:
            payload = memoryview(block)[start:]
            if len(payload) != length or hashlib.sha1(payload).hexdigest() != digest:
                raise ValueError(f"{self.file}: the payload at {self.offset} is damaged")
        return {
            "url_key": url_key(head["WARC-Target-URI"]),
            "timestamp": "".join(c for c in head["WARC-Date"] if c.isdigit()),
            "page_id": page_of(head["WARC-Record-ID"]),
            "url": head["WARC-Target-URI"],
            "file": self.file,
            "offset": self.offset,
            "length": self.head_size + self.need,
            "payload_bytes": length,
            "payload_digest": digest,
            "record_type": head["WARC-Type"],
            "refers_to": None if refers is None else page_of(refers),
        }


def url_key(url: str) -> str:
    """The address with its host's labels reversed, so that sites sort together; no fragment."""
    rest = url.partition("#")[0]
    scheme, found, tail = rest.partition("://")
    if not found:
        return rest
    cut = min((i for i in map(tail.find, "/?") if i >= 0), default=len(tail))
    host, port = tail[:cut].rpartition("@")[2].lower(), ""
    if ":" in host:
        host, _, port = host.partition(":")
    standard = {"http": "80", "https": "443"}.get(scheme.lower())
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    return f"{labels}{f':{port}' if port and port != standard else ''}){tail[cut:] or '/'}"


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below ``path``, payloads checked against their digests.

    A gzipped file cannot be split, so one task reads it from the start, in order and in pieces.
    """
    pieces = spark.read.option("lineSep", END).text(path).select(
        "value", F.col("_metadata.file_path").alias("file")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader("")
        schema = None
        for batch in batches:
            rows = []
            for value, file in zip(batch["value"], batch["file"].to_pylist(), strict=True):
                if file != reader.file:
                    reader = Reader(file)
                rows += reader.feed(value.as_buffer().to_pybytes() + b"\r\n\r\n")
            schema = schema or index_schema()
            yield pa.RecordBatch.from_pylist(rows, schema)

    return pieces.mapInArrow(run, INDEX)


def index_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in INDEX.split(", "))])


class LoserTree:
    """Merges sorted runs with one comparison a level for each row.

    A leaf stands for a run; an inner node holds the run that lost there, the winner moves up.
    """

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.heads = [next(r, None) for r in runs]
        self.losers = [-1] * len(runs)
        self.winner = -1
        for run in range(len(runs)):
            self._play(run)

    def _less(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[a] is not None
        return (self.heads[a], a) < (self.heads[b], b)

    def _play(self, run: int) -> None:
        node = (run + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # first to arrive while the tree is built
                self.losers[node] = run
                return
            if self._less(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.winner = run

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and self.heads[self.winner] is not None:
            run = self.winner
            yield self.heads[run]
            self.heads[run] = next(self.runs[run], None)
            self._play(run)


def merge_index(index: DataFrame, stage: Stage, rows_per_task: int = 200_000) -> DataFrame:
    """The index in the order of url key, timestamp and id, over all tasks like after ``orderBy``.

    Each task of ``index`` sorts its rows into a run, and all runs are written. Ranges of the key
    are then dealt out, with timestamp and id behind it so that one url with very many captures is
    split, and each task merges the parts of the runs in its range.
    """
    runs = stage.put(
        index.withColumn("run", F.spark_partition_id()).sortWithinPartitions(*ORDER), "runs"
    )
    tasks = max(1, -(-runs.count() // rows_per_task))
    ranges = runs.repartitionByRange(tasks, *ORDER).sortWithinPartitions("run", *ORDER)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [pa.Table.from_batches([b]) for b in batches]
        if not tables:
            return
        table = pa.concat_tables(tables)
        run = table["run"].to_pylist()
        # nulls first, as Spark sorts them
        keys = [[(v is not None, v) for v in table[c].to_pylist()] for c in ORDER]
        starts = [i for i in range(len(run)) if not i or run[i] != run[i - 1]]
        ends = [*starts[1:], len(run)]
        parts = [zip(*(k[a:b] for k in keys), range(a, b)) for a, b in zip(starts, ends, strict=True)]
        order = [row[-1] for row in LoserTree([iter(p) for p in parts])]
        yield from table.drop_columns("run").take(pa.array(order, pa.int64())).to_batches(10_000)

    return ranges.mapInArrow(merge, INDEX)


def archive(
    pages: DataFrame, stage: Stage | None = None, path: str | None = None, **options
) -> DataFrame:
    """Write archives of all pages, read them back and return the merged index.

    ``path`` is a shared folder for the archives, in the stage folder unless given.
    """
    spark = pages.sparkSession
    stage = stage or Stage(spark)
    path = path or stage.path("archives")
    write_archives(pages, path, stage=stage, **options)
    return merge_index(read_index(spark, path), stage)
