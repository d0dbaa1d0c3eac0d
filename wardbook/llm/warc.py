"""WARC archives of captures and their merged index."""

from __future__ import annotations

import base64
import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardbook.llm.common import run_folder, stored

# The file format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "<urn:capture:{}>"

# Seconds that captures without a time are spread over: from 2024 into the year 9945, so that dates have four-digit years.
SPAN = 250_000_000_000


def url_key(url: Column) -> Column:
    """Host read from its end, then path and query; what is no URL is its own key."""
    plain = F.regexp_replace(F.lower(url), "#.*$", "")
    host = F.regexp_replace(F.try_parse_url(plain, F.lit("HOST")), r"^www\.", "")
    rest = F.regexp_replace(plain, "^[a-z][a-z0-9+.-]*://[^/?]*", "")
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    return F.coalesce(key, plain, F.lit(""))


def one_line(url: Column) -> Column:
    """A URL as archives hold it, so that its key is the same before and after."""
    return F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(capture, when: str, url: str | None, html: str | None, refers_to) -> str:
    """A record without its closing two line ends.

    A revisit keeps the headers of the response, so the payload's length stays known.
    """
    payload = (html or "").encode("utf-8", "replace")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{END}"
    uri = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    again = refers_to is not None
    block = len(http.encode()) + (0 if again else len(payload))
    head = [
        VERSION,
        f"WARC-Type: {'revisit' if again else 'response'}",
        f"WARC-Record-ID: {ID.format('' if capture is None else capture)}",
        f"WARC-Date: {when}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        *([f"WARC-Refers-To: {ID.format(refers_to)}", f"WARC-Profile: {IDENTICAL}"] if again else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {block}",
    ]
    return "\r\n".join(head) + END + http + ("" if again else payload.decode())


def _headers(head: bytes) -> dict[str, str]:
    # Only the space after the colon goes: a URL may begin or end with white space.
    pairs = (line.partition(":") for line in head.decode().split("\r\n")[1:])
    return {name.lower(): value.removeprefix(" ") for name, _, value in pairs}


def _number(uri: str) -> int | None:
    inner = uri[len("<urn:capture:") : -1]
    return int(inner) if inner else None


class Reader:
    """Records of one archive from the stretches between its ``END`` marks, in their order.

    Only lengths say where a record ends, since a payload may hold the mark itself or end
    in half of one.
    """

    def __init__(self, name: str):
        self.name, self.parts, self.size, self.need, self.head, self.offset = name, [], 0, 0, None, 0

    def feed(self, stretch: bytes) -> Iterator[dict]:
        self.parts += [stretch, END.encode()]
        self.size += len(stretch) + len(END)
        while self.size and self.size >= self.need:
            data = b"".join(self.parts)
            if self.head is None:
                if not data.startswith(VERSION.encode()):
                    # The last stretch of a file may lack its mark; the one put there is left over.
                    if data != END.encode():
                        raise ValueError(f"{self.name}: no record begins at {self.offset}")
                    break
                head, _, data = data.partition(END.encode())
                self.head, self.length = _headers(head), len(head) + len(END)
                self.need = int(self.head["content-length"]) + len(END)
            else:
                if data[self.need - len(END) : self.need] != END.encode():
                    raise ValueError(f"{self.name}: the record at {self.offset} does not end where its length says")
                yield self._read(data[: self.need - len(END)])
                data = data[self.need :]
                self.offset += self.length + self.need
                self.head, self.need = None, 0
            self.parts, self.size = [data], len(data)

    def _read(self, block: bytes) -> dict:
        http, _, payload = block.partition(END.encode())
        size, digest = int(_headers(http)["content-length"]), self.head["warc-payload-digest"].removeprefix("sha1:")
        refers = self.head.get("warc-refers-to")
        if refers is None and (len(payload) != size or payload_digest(payload) != digest):
            raise ValueError(f"{self.name}: payload at {self.offset} does not match its digest")
        return {
            "page_id": _number(self.head["warc-record-id"]),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": self.head["warc-type"],
            "refers_to": None if refers is None else _number(refers),
            "url": self.head["warc-target-uri"],
            "captured": self.head["warc-date"],
            "archive": self.name,
            "position": self.offset,
        }


CAPTURES = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint,"
    " url string, captured string, archive string, position bigint"
)


def write_archives(
    pages: DataFrame, folder: str, firsts_folder: str, *, id_col: str, url_col: str, html_col: str, time_col: str | None, min_bytes: int
) -> None:
    """One archive per task, its records sorted by URL key and time: a capture run."""
    payload = F.coalesce(F.col(html_col), F.lit(""))
    seconds = F.pmod(F.coalesce(F.col(id_col), F.lit(0)), F.lit(SPAN))
    when = F.timestamp_seconds(F.lit(1_704_067_200) + seconds) if time_col is None else F.col(time_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"), one_line(F.col(url_col)).alias("url"), payload.alias("html"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        F.unhex(F.sha1(payload)).alias("sha"), F.octet_length(payload).alias("n"),
    )
    firsts = (
        rows.filter(F.col("n") >= min_bytes)
        .groupBy(F.col("sha").alias("_sha"), F.col("n").alias("_n"))
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1")
    )
    # Stored, so that the join reads plain shuffles and splits a hot payload. Repeated payloads
    # grow with the crawl: the join is shuffled at every size, never broadcast.
    firsts = stored(firsts, firsts_folder)
    joined = rows.join(firsts.hint("merge"), (F.col("sha") == F.col("_sha")) & (F.col("n") == F.col("_n")), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    runs = joined.select("page_id", "captured", "url", "html", refers.alias("refers"), url_key(F.col("url")).alias("key"))
    runs = runs.sortWithinPartitions("key", "captured", "page_id")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256).select(["page_id", "captured", "url", "html", "refers"])
                yield pa.RecordBatch.from_arrays([pa.array([record(*r) for r in zip(*(c.to_pylist() for c in rows.columns))], pa.string())], ["value"])

    # Rows of a text file end with the separator, which is how a record ends.
    runs.mapInArrow(build, "value string").write.mode("overwrite").option("lineSep", END).option("compression", "gzip").text(folder)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The captures in all archives of a folder.

    A compressed archive is never split, so a task streams it in order and holds one
    record at a time.
    """
    stretches = spark.read.option("lineSep", END).text(folder).select(F.col("_metadata.file_name").alias("archive"), "value")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, schema = None, _schema()
        for batch in batches:
            found = []
            for name, stretch in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if reader is None or reader.name != name:
                    _ended(reader)
                    reader = Reader(name)
                found += reader.feed(stretch.encode())
            yield pa.RecordBatch.from_pylist(found, schema)
        _ended(reader)

    return stretches.mapInArrow(parse, CAPTURES)


def _ended(reader: Reader | None) -> None:
    if reader is not None and reader.head is not None:
        raise ValueError(f"{reader.name}: the last record is cut off")


def _schema() -> pa.Schema:
    return pa.schema([(name, pa.int64() if kind == "bigint" else pa.string()) for name, kind in (c.split() for c in CAPTURES.split(","))])


def merge(runs: Iterable[Iterator[tuple]]) -> Iterator[tuple]:
    """Rows of sorted runs in order, by a loser tree: each row costs one path to the root.

    Inner node k holds the loser of its two sides; equal rows come in the order of runs.
    """
    runs = [iter(r) for r in runs]
    width = 1 << max(0, (len(runs) - 1).bit_length())
    head = [next(r, None) for r in runs] + [None] * (width - len(runs))

    def before(a: int, b: int) -> bool:
        return head[a] is not None and (head[b] is None or (head[a], a) < (head[b], b))

    loser, winner = [0] * width, [*[0] * width, *range(width)]
    for node in range(width - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], loser[node] = (a, b) if before(a, b) else (b, a)
    top = winner[1]
    while head and head[top] is not None:
        yield head[top]
        head[top] = next(runs[top], None)
        node = (top + width) // 2
        while node:
            if before(loser[node], top):
                loser[node], top = top, loser[node]
            node //= 2


def merge_index(captures: DataFrame, *, block: int = 64, fan_in: int = 256, task_rows: int = 500_000) -> DataFrame:
    """Captures with ``url_key`` and ``history_position``, which numbers all of them in order
    of URL key, time and id.

    Every archive is a run in that order already. Tasks own ranges of the order, so even
    one key that holds a third of all captures is spread; there are as many as leave about
    ``task_rows`` captures to each. A task receives its part of each run, run after run, lays
    them on its own disk in blocks and merges ``fan_in`` runs at a time, with a block of each
    in memory, into longer runs, until one pass takes them all. A task's part of the order
    is numbered from its own start.
    """
    spark = captures.sparkSession
    keyed = captures.withColumn("url_key", url_key(F.col("url")))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-captures.count() // task_rows))
    parts = keyed.repartitionByRange(tasks, "url_key", "captured", "page_id").sortWithinPartitions("archive", "position")
    names = keyed.columns

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, where = TaskContext.get().partitionId() << 33, {n: names.index(n) for n in ("archive", "url_key", "captured", "page_id")}
        with tempfile.TemporaryFile() as spool:

            def lay(rows: list[tuple]) -> int:
                at = spool.seek(0, 2)
                pickle.dump(rows, spool)
                return at

            def rows(blocks: list[int]) -> Iterator[_Row]:
                for at in blocks:
                    spool.seek(at)
                    yield from map(_Row, pickle.load(spool))

            runs: list[list[int]] = []
            last, held = None, []
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if row[where["archive"]] != last or len(held) == block:
                        if held:
                            runs[-1].append(lay(held))
                            held = []
                        if row[where["archive"]] != last:
                            runs.append([])
                        last = row[where["archive"]]
                    page = row[where["page_id"]]
                    held.append(((row[where["url_key"]], row[where["captured"]], page is not None, page or 0), row))
            if held:
                runs[-1].append(lay(held))
            while len(runs) > fan_in:
                longer = []
                for group in range(0, len(runs), fan_in):
                    ordered = merge([rows(blocks) for blocks in runs[group : group + fan_in]])
                    longer.append([])
                    while part := [tuple(row) for row in islice(ordered, block)]:
                        longer[-1].append(lay(part))
                runs = longer

            out, count = [], 0
            for _, row in merge([rows(blocks) for blocks in runs]):
                out.append((*row, base + count))
                count += 1
                if len(out) == 1024:
                    yield _batch(out, names)
                    out = []
            if out:
                yield _batch(out, names)

    return parts.mapInArrow(merged, f"{CAPTURES}, url_key string, history_position bigint")


class _Row(tuple):
    """(key, row), compared by key alone."""

    def __lt__(self, other):
        return self[0] < other[0]

    def __eq__(self, other):
        return self[0] == other[0]

    __hash__ = None


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    schema = _schema().append(pa.field("url_key", pa.string())).append(pa.field("history_position", pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def archive_captures(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    time_col: str | None = None,
    min_bytes: int = 0,
    folder: str | None = None,
) -> DataFrame:
    """Write every page as a WARC record, read the archives back and merge their index.

    Of pages with equal payloads of at least ``min_bytes`` the one with the smallest id is
    a response and the others are revisits that refer to it; smaller payloads are all
    responses. Returns what the archives say of each page: ``page_id``, ``payload_bytes``,
    ``payload_digest`` (base32 SHA-1), ``record_type``, ``refers_to``, ``url``,
    ``captured``, ``archive``, ``position`` in the uncompressed archive, ``url_key`` and
    ``history_position`` in the merged capture history.

    Without ``time_col`` a page's time is 2024-01-01 plus its id in seconds (its remainder by
    ``SPAN``, for ids beyond or below zero). Null html is
    an empty payload, a null URL reads as an empty one, line ends in URLs are escaped. A
    null id refers to the smallest id of its payload, or is a response if there is none;
    rows that repeat the smallest id are all responses. Further columns are ignored; an
    empty table gives no rows. Archives stay below ``folder``.
    """
    folder = folder or run_folder(pages.sparkSession, "warc")
    write_archives(pages, f"{folder}/archives", f"{folder}/firsts", id_col=id_col, url_col=url_col, html_col=html_col, time_col=time_col, min_bytes=min_bytes)
    captures = stored(read_archives(pages.sparkSession, f"{folder}/archives"), f"{folder}/captures")
    return merge_index(captures)
