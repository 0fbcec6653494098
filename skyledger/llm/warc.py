"""WARC archives, and their captures in global order by an external merge.

Archives are text files of records in UTF-8, compressed as a whole, so that Spark's own
sinks and readers commit and find them on any file system. A reader takes the files apart
at record starts and lets each record's Content-Length decide where it really ends, so a
payload may hold anything.

The index of the captures is sorted like an external sort: each task sorts the captures it
read (a run), runs are cut by ranges of (URL key, timestamp, page), and each range merges
its pieces of the runs with a loser tree. Ranges follow each other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import meet, pieces, taken, written
from skyledger.llm.url_filter import host_and_path

#: Payloads of fewer bytes are always stored.
REVISIT_BYTES = 1_000
#: Captures that one merging task takes.
RANGE_ROWS = 200_000

_START = "WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def with_revisits(pages: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` (page_id, url, payload, timestamp) with digest, bytes and refers_to.

    Of equal payloads of at least ``at_least`` bytes, those of smaller ids refer to the
    largest; others refer to nothing. A null payload is empty. Rows without an id refer
    to nothing. Only repeated digests take part in the join, in slices if there are many
    of one.
    """
    known = pages.withColumn("payload", F.coalesce(F.col("payload").cast("string"), F.lit(""))).withColumns(
        {"digest": F.sha1("payload"), "bytes": F.octet_length("payload").cast("bigint")}
    )
    narrow = known.where(F.col("bytes") >= at_least).select("page_id", "digest", "bytes")
    repeated = written(
        narrow.groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1"),
        "repeated-payloads",
    )
    referring = written(
        meet(narrow, repeated, ["digest", "bytes"], "n", pages.count(), "inner")
        .where("page_id <> refers_to")
        .select("page_id", "digest", "refers_to")
        .distinct(),
        "revisits",
    )
    return known.join(referring, ["page_id", "digest"], "left")


def write_archives(pages: DataFrame, path: str) -> None:
    """A record for every row of ``with_revisits``: a response, or a revisit without the
    payload. Line breaks in a URL are percent-encoded."""
    revisit = F.col("refers_to").isNotNull()
    name = F.md5(F.concat_ws(" ", "page_id", "digest"))
    uuid = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    url = F.replace(F.replace(F.col("url").cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))

    def field(label: str, value: F.Column) -> F.Column:
        return F.coalesce(F.concat(F.lit(f"{label}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    record = F.concat(
        F.lit(_START),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", uuid),
        field("WARC-Date", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        field("WARC-Target-URI", url),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        field("WARC-Profile", F.when(revisit, _PROFILE)),
        field("Page-ID", F.col("page_id")),
        field("Refers-To-Page-ID", F.col("refers_to")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
        F.lit("\r\n\r"),  # the sink ends the line, and so the record
    )
    pages.select(record.alias("value")).write.option("compression", "gzip").text(path)


_CAPTURE = pa.schema(
    [
        ("run", pa.int32()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("timestamp", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)


def _records(parts: Iterator[str]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record, from texts that were cut at record starts."""
    fields, block, need = None, b"", 0
    for part in parts:
        raw = part.encode()
        if fields is not None:  # the cut was inside a payload
            block += b"\r\n\r\n" + _START.encode() + raw
        else:
            head, _, block = raw.removeprefix(_START.encode()).partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
            need = int(fields["Content-Length"])
        if len(block) >= need:
            yield fields, block[:need]
            fields = None
    if fields is not None:
        raise ValueError("an archive ends inside a record")


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its run (the reading task), page, URL, timestamp, type, what it
    refers to, and size and digest of the full payload. A stored payload is hashed again
    and held against the record."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, out = TaskContext.get().partitionId(), []
        texts = (text for batch in batches for part in pieces(batch, 64) for text in taken(part, "value"))
        for fields, block in _records(texts):
            head, _, payload = block.partition(b"\r\n\r\n")
            size = int(head.rpartition(b"Content-Length: ")[2])
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if fields["WARC-Type"] == "response" and (
                len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
            ):
                raise ValueError(f"the payload of {fields['WARC-Record-ID']} is not what its record says")
            page, refers = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
            out.append(
                (
                    run,
                    None if page is None else int(page),
                    fields.get("WARC-Target-URI"),
                    fields.get("WARC-Date"),
                    fields["WARC-Type"],
                    None if refers is None else int(refers),
                    size,
                    digest,
                )
            )
            if len(out) == 4096:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    read = spark.read.option("lineSep", "\r\n\r\n" + _START).text(path)
    return read.mapInArrow(
        parse,
        "run int, page_id bigint, url string, timestamp string, record_type string, refers_to bigint, "
        "payload_bytes bigint, payload_digest string",
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CAPTURE, strict=True)], schema=_CAPTURE
    )


class LoserTree:
    """Merges sorted lists of keys: inner nodes hold the loser of their match, so a new
    key plays one match per level."""

    def __init__(self, runs: list[list]):
        self.runs, self.at = runs, [0] * len(runs)
        self.losers: list[int] = [-1] * len(runs)
        self.winner = self._build(1)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's next key goes before run b's; used-up runs go last."""
        a_left, b_left = self.at[a] < len(self.runs[a]), self.at[b] < len(self.runs[b])
        if not (a_left and b_left):
            return a_left
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return (x, a) < (y, b)

    def _build(self, node: int) -> int:
        n = len(self.runs)
        if node >= n:
            return node - n
        a, b = self._build(2 * node), self._build(2 * node + 1)
        a, b = (a, b) if self._less(a, b) else (b, a)
        self.losers[node] = b
        return a

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, place in it) in the order of the keys; equal keys by run."""
        n = len(self.runs)
        while self.at[self.winner] < len(self.runs[self.winner]):
            best = self.winner
            yield best, self.at[best]
            self.at[best] += 1
            node = (best + n) // 2
            while node:
                if self._less(self.losers[node], best):
                    self.losers[node], best = best, self.losers[node]
                node //= 2
            self.winner = best


def merged_index(captures: DataFrame) -> DataFrame:
    """``captures`` (as read) in global order of URL key, timestamp and page: ``range``
    numbers the ranges in order, ``place`` the captures in each.

    Runs are written sorted, and a range gets its piece of each in the written order, so the
    loser tree merges them as they come: nothing is sorted again. Ranges cover the whole key, so captures of one URL, however
    many, are dealt to several. Nulls come first.
    """
    host, path = host_and_path(F.col("url"))
    key = F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), path)
    keyed = captures.withColumn("url_key", F.coalesce(key, F.lit("")))
    order = ["url_key", "timestamp", "page_id"]
    runs = written(keyed.sortWithinPartitions(*order), "capture-runs")
    ranges = max(1, math.ceil(runs.count() / RANGE_ROWS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        null_first = lambda v: (v is not None, v)
        keys = list(zip(*(map(null_first, table[c].to_pylist()) for c in order), strict=True))
        # a piece of a run ends where another begins: where its writer's number changes or
        # the keys go back
        run = table["run"].to_pylist()
        cuts = [k for k in range(1, len(keys)) if run[k] != run[k - 1] or keys[k] < keys[k - 1]]
        starts = [0, *cuts]
        own = [keys[a:b] for a, b in zip(starts, [*cuts, len(keys)], strict=True)]
        merged = [starts[r] + k for r, k in LoserTree(own)]
        n = len(merged)
        out = table.take(pa.array(merged)).append_column(
            "range", pa.array([TaskContext.get().partitionId()] * n, pa.int32())
        )
        yield from out.append_column("place", pa.array(range(n), pa.int64())).combine_chunks().to_batches()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in runs.schema)
    return runs.repartitionByRange(ranges, *order).mapInArrow(merge, f"{kinds}, range int, place bigint")


def numbered(index: DataFrame) -> DataFrame:
    """``index`` with ``place`` counted from 0 over all ranges, by the sizes of the ranges
    before. There is one size per RANGE_ROWS captures. An empty index stays empty."""
    held = written(index, "capture-index")
    sizes = held.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("range", F.coalesce(before, F.lit(0)).alias("_before"))
    return held.join(offsets, "range").withColumn("place", F.col("place") + F.col("_before")).drop("_before")
