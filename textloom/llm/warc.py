"""WARC archives of captured pages, and their index by external merge.

Records are put together in SQL and written by Spark's text writer: an archive is a gzip file of records, of few if
they are long. Each archive read back gives a run of captures sorted by URL key and time; runs are merged by a loser
tree within ranges of keys, so that all ranges in order are the globally ordered histories. A range's runs stay Arrow
batches, of which only the heads are Python rows.
"""

import io
import re

import pyarrow as pa
from pyspark.sql import functions as F

from ._store import narrow, never_empty, new_path, partitions, stage

#: Payloads of up to so many bytes share an archive with so many records; longer ones have it to themselves.
ARCHIVES = ((64 << 10, 4_000), (4 << 20, 64))
#: Captures of a merged range, on average, and of a run's head, at most.
RANGE_CAPTURES, HEAD = 200_000, 32
#: A payload's digest is joined by broadcast if more than this share of the repeated ones, and so many, have it: there are 1 / HOT of them at most.
HOT, LEAST_HOT = 1 / 4096, 1000
#: Captures without a time are a second apart from this epoch second on, by page_id.
FIRST_SECOND = 1_704_067_200
ID = "<urn:textloom:page:"


def sha1_base32(column):
    """SHA-1 of the UTF-8 bytes in upper-case base32: 5 hexadecimal digits are 4 of base 32."""
    h = F.sha1(column.cast("binary"))
    quads = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*quads)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def captures(pages):
    """(page_id, url, payload, date, digest, bytes) of rows of page_id, url, html and, if there is one, captured_at (text, as a WARC date)."""
    rows = narrow(pages, page_id="bigint", url="string", html="string", captured_at="string")
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    second = F.timestamp_seconds(F.lit(FIRST_SECOND) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(10**9)))
    date = F.date_format(F.to_utc_timestamp(second, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.coalesce("html", F.lit(""))
    return rows.select("page_id", uri.alias("url"), payload.alias("payload"), F.coalesce(F.regexp_extract("captured_at", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", 0), date).alias("date")).select(
        "*", sha1_base32(F.col("payload")).alias("digest"), F.octet_length("payload").cast("bigint").alias("bytes")
    )


def records(pages, least: int = 0):
    """(record, bytes) of every row: a response, or a revisit of the response with the same payload and the smallest page_id; bytes are the payload's.

    Payloads of fewer than least bytes are responses always. Rows repeated with a response's page_id and payload are
    responses too. A null page_id comes after all others; where all of a payload's are null, all are responses.
    """
    spark, rows = pages.sparkSession, captures(pages)
    first = stage(rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").withColumnRenamed("digest", "of_digest"), "warc-first", spark)
    most = max(LEAST_HOT, int((first.agg(F.sum("n")).first()[0] or 0) * HOT))

    # broadcast: 1 / HOT digests at most; so no digest that a third of all pages share, as empty ones do, is a key of a shuffle
    hot = F.broadcast(never_empty(first.where(F.col("n") > most).select(F.col("of_digest").alias("hot_digest"), F.col("first").alias("hot")), ""))
    rest = first.where(F.col("n") <= most).select("of_digest", F.col("first").alias("rest"))
    rows = rows.join(hot, (F.col("digest") == F.col("hot_digest")) & (F.col("bytes") >= least), "left")
    # rows that have met then, by a key of their own, none
    own = F.when(F.col("hot").isNull() & (F.col("bytes") >= least), F.col("digest")).otherwise(F.xxhash64("url", "page_id").cast("string"))
    rows = rows.withColumn("own", own).join(rest, F.col("own") == F.col("of_digest"), "left").withColumn("first", F.coalesce("hot", "rest"))
    name = lambda page: F.concat(F.lit(ID), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), F.col("digest"), F.lit(">"))
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("page_id")), F.lit("\r\nWARC-Date: "), F.col("date"), F.lit("\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), name(F.col("first")), F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return rows.select(F.concat(head, block, F.lit("\r\n\r\n")).alias("record"), "bytes")


def write_archives(pages, path: str, least: int = 0, archives=ARCHIVES) -> None:
    """Archives of records(pages, least) in a new folder. archives: rising sizes of payloads, and records of an archive up to each."""
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    kind = lambda x: sum(((x > most).cast("int") for most, _ in archives), F.lit(0))
    present = {r.kind for r in narrow(pages, html="string").groupBy(kind(size).alias("kind")).count().collect()} or {0}
    rows = records(pages, least)
    # the writer ends each line with the last character of its record
    line = F.substring("record", F.lit(1), F.length("record") - 1).alias("value")
    # a write for each size of payloads, one for most tables
    for k in sorted(present):
        of_kind = rows.where(kind(F.col("bytes")) == k) if len(present) > 1 else rows
        of_kind.select(line).write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", [*(n for _, n in archives), 1][k]).text(path)


def parse(stream):
    """(offset, length, header, block) of each record of an open archive; an error where one is cut short or malformed."""
    at = 0
    while line := stream.readline():
        start, header = at, {}
        at += len(line)
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {start}")
        while (line := stream.readline()) not in (b"\r\n", b""):
            at += len(line)
            name, _, value = line.partition(b":")
            header[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        size = int(header["content-length"])
        block = stream.read(size)
        if line != b"\r\n" or len(block) < size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"the record at byte {start} is cut short")
        at += len(line) + size + 4
        yield start, at - start, header, block


def url_key(url: str) -> str:
    """The URL without scheme, user, www, fragment and default port, its host's labels reversed: org,example)/path?query."""
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url)
    if not m:
        return url.partition("#")[0].lower()
    host = re.sub(r"^www\d*\.", "", m[1].rpartition("@")[2].lower())
    host = re.sub(r":(80|443)?$", "", host)
    return ",".join(reversed(host.split("."))) + ")" + (m[2] if m[2][:1] == "/" else "/" + m[2])


_CAPTURE = "url_key string, captured_at string, record_id string, page_id bigint, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, run string, offset bigint, length bigint"
_NAMES = [x.split()[0] for x in _CAPTURE.split(", ")]
_ARROW = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _CAPTURE.split(", ")])


def _page(record_id: str | None) -> int | None:
    found = (record_id or "").removeprefix(ID).partition(":")[0]
    return None if found in ("", "null") else int(found)


def capture(offset: int, length: int, header: dict, block: bytes, run: str) -> tuple:
    """A record's entry. A response's size and digest are taken from its payload; a revisit has them from its headers."""
    from base64 import b32encode
    from hashlib import sha1

    head, _, payload = block.partition(b"\r\n\r\n")
    digest = header["warc-payload-digest"].removeprefix("sha1:")
    if header["warc-type"] == "response":
        size, found = len(payload), b32encode(sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"the payload of {header['warc-record-id']} doesn't match its digest")
    else:
        size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1])
    return url_key(header["warc-target-uri"]), header["warc-date"], header["warc-record-id"], _page(header["warc-record-id"]), header["warc-type"], _page(header.get("warc-refers-to")), digest, size, run, offset, length


def read_archives(spark, path: str):
    """A run of captures for each archive in the folder, sorted by URL key, time and record id. Archives are read as a stream, a record at a time."""

    def run(batches):
        import gzip

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                with gzip.open(io.BytesIO(content.as_buffer())) as stream:
                    rows = sorted(capture(*r, name.rpartition("/")[2]) for r in parse(stream))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    # files are read whole: a task holds spark.sql.files.maxPartitionBytes of them, or one
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").load(path).select("path", "content")
    return files.mapInArrow(run, _CAPTURE)


class LoserTree:
    """The smallest heads of sorted runs one by one: a match for each level of the tree. Nodes hold the loser of their match."""

    def __init__(self, runs: list):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.losers = [-1] * max(1, k)
        winners = [-1] * k + list(range(k))
        for at in range(k - 1, 0, -1):
            a, b = winners[2 * at], winners[2 * at + 1]
            winners[at], self.losers[at] = (a, b) if self.before(a, b) else (b, a)
        self.winner = winners[1] if k else -1

    def before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None if x is None or y is None else (x, a) < (y, b)

    def __iter__(self):
        while self.winner >= 0 and (head := self.heads[self.winner]) is not None:
            yield head
            w = self.winner
            self.heads[w] = next(self.runs[w], None)
            at = (w + len(self.runs)) // 2
            while at:
                if self.before(self.losers[at], w):
                    self.losers[at], w = w, self.losers[at]
                at //= 2
            self.winner = w


def _heads(parts):
    """Rows of a run, one by one, with what they are sorted by in front."""
    for batch in parts:
        for k in range(0, batch.num_rows, HEAD):
            for row in zip(*(c.to_pylist() for c in batch.slice(k, HEAD).columns)):
                yield row[0], row[1], row[2], row


def _merged(batches):
    from pyspark import TaskContext

    # rows come run by run, each run sorted; a range holds RANGE_CAPTURES on average
    runs, last = [], object()
    for batch in batches:
        names = batch.column(8).to_pylist()
        begins = [i for i, name in enumerate(names) if name != (names[i - 1] if i else last)]
        cuts = sorted({0, *begins, len(names)}) if names else []
        for a, b in zip(cuts, cuts[1:]):
            if a in begins:
                runs.append([])
            runs[-1].append(batch.slice(a, b - a))
        last = names[-1] if names else last
    order = TaskContext.get().partitionId() << 40
    out = []
    for *_, row in LoserTree([_heads(r) for r in runs]):
        out.append((*row, order))
        order += 1
        if len(out) == 5000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(rows):
    schema = _ARROW.append(pa.field("capture_order", pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def merge_index(runs, range_captures: int = RANGE_CAPTURES):
    """All captures with capture_order, by which they are globally sorted by URL key, time and record id. runs: a stored table, as of read_archives().

    Ranges are cut by all three, so that the captures of one URL may lie in several.
    """
    spark = runs.sparkSession
    count = max(1, min(runs.count() // range_captures + 1, 100_000), partitions(spark))
    key = ["url_key", "captured_at", "record_id"]
    return runs.repartitionByRange(count, *key, "run", "offset").sortWithinPartitions("run", *key, "offset").mapInArrow(_merged, _CAPTURE + ", capture_order bigint")


def archive_and_index(pages, least: int = 0, path: str | None = None):
    """pages written as archives (in a new shared folder unless path says where), read back, and indexed: a row for each record in merge_index()'s columns."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(pages, path, least)
    return merge_index(stage(read_archives(spark, path), "warc-runs", spark))
