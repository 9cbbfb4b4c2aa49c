"""WARC archives of pages, and a global capture index by external merge.

1. Payload digests are computed, and for each digest of a payload of at least
   ``MIN_REVISIT`` bytes the smallest page id; its page is written as a response,
   equal pages as revisits of it.
2. Each task writes archives (gzip members, one a record, a new file after
   ``ARCHIVE_BYTES``) to the shared folder and sorts each archive's captures by
   URL key and time: a run. Files of failed attempts are never named by the index.
3. External merge: the runs are cut into ranges of the URL key, time and id, of about
   ``RANGE`` captures each, so that a task's share stays the same as tables grow, and
   in each range a loser tree merges the runs' parts. The ranges' counts turn
   places within them into places in the whole order, so a URL's captures form a
   globally ordered history. A frequent URL or host is cut like any other key.
4. The archives are read again with Spark's binary reader; digests and sizes of
   responses come from the bytes read, and must agree with the index.

Archives are written through ``pyarrow.fs``, to the store that the shared folder's
URI names; without a scheme, to Spark's default file system, where they are read.

Defined results: null payloads are empty; null URLs have the empty URL key; null
page ids never come first in a group of equal payloads (a group of null ids is
all responses); rows repeated with the smallest id are all responses; an empty
table gives no archives and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, table, written
from strata.session import new_work_path

MIN_REVISIT, ARCHIVE_BYTES, RANGE = 100, 8 << 20, 20_000
URL = re.compile(r"[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)(?:\?([^#]*))?")
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
RUN = ("page_id long, url_key string, time string, run string, at long, length long, digest string, payload_bytes long, "
       "record_type string, refers_to long")
RECORD = ("run string, at long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "url string, whole boolean")


def url_key(url: str | None) -> str:
    """Host labels from the top down, path, sorted query; lower case, no ``www.``,
    user, port or fragment. What isn't a URL with a host is its own key."""
    url = (url or "").strip(" ").lower()
    m = URL.match(url)
    host = m and re.sub(":[0-9]*$", "", m[1].rpartition("@")[2]).removeprefix("www.")
    if not host:
        return url
    query = "&".join(sorted((m[3] or "").split("&")))
    return ",".join(reversed(host.split("."))) + ")" + (m[2].rstrip("/") or "/") + (f"?{query}" if query else "")


def record_id(kind: str, page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{page_id}')}>"


def to_record(page_id, url, payload: bytes, digest: str, record_type: str, refers_to, time: str) -> bytes:
    """A WARC/1.1 record. The page ids and the full payload's size stand in X- fields."""
    head = {"WARC-Type": record_type, "WARC-Record-ID": record_id(record_type, page_id), "WARC-Date": time,
            "WARC-Target-URI": url, "WARC-Payload-Digest": f"sha256:{digest}", "X-Page-Id": page_id, "X-Payload-Length": len(payload)}
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if record_type == "revisit":
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 "WARC-Refers-To": record_id("response", refers_to), "X-Refers-To": refers_to}
    body = http + (payload if record_type == "response" else b"")
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": len(body)}
    lines = "".join(f"{k}: {str(v).translate({10: ' ', 13: ' '})}\r\n" for k, v in head.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + body + b"\r\n\r\n"


def from_record(data: bytes) -> dict:
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    number = lambda k: int(fields[k]) if k in fields else None
    body = rest[:int(fields["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2]
    digest, response = fields["WARC-Payload-Digest"].removeprefix("sha256:"), fields["WARC-Type"] == "response"
    return {"page_id": number("X-Page-Id"), "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To"),
            "payload_bytes": len(payload) if response else number("X-Payload-Length"),
            "payload_digest": hashlib.sha256(payload).hexdigest() if response else digest, "url": fields.get("WARC-Target-URI"),
            "whole": not response or (hashlib.sha256(payload).hexdigest() == digest and len(payload) == number("X-Payload-Length"))}


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member."""
    at, view = 0, memoryview(data)
    while at < len(data):
        gz, parts, used = zlib.decompressobj(31), [], at
        while not gz.eof:
            parts.append(gz.decompress(view[used:used + (1 << 16)]))
            used += 1 << 16
        end = min(used, len(data)) - len(gz.unused_data)
        yield at, b"".join(parts)
        at = end


def resolve(pages: DataFrame, page_id="page_id", url="url", html="html") -> DataFrame:
    """Pages with digest, size, record type and what a revisit refers to."""
    payload = F.coalesce(F.col(html), F.lit(""))
    pages = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("html"),
                         F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    firsts = (pages.filter(F.col("payload_bytes") >= MIN_REVISIT).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return pages.join(firsts, "digest", "left").select(
        "page_id", "url", "html", "digest", "payload_bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def store_uri(spark, folder: str) -> str:
    """``folder`` as ``pyarrow.fs`` names it, on the file system that Spark takes it to be on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:").removeprefix("//") if uri.startswith("file:") else uri


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives; the captures of each, a sorted run."""
    uri = store_uri(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        schema = pa.schema([("page_id", pa.int64()), ("url_key", pa.string()), ("time", pa.string()), ("run", pa.string()),
                            ("at", pa.int64()), ("length", pa.int64()), ("digest", pa.string()), ("payload_bytes", pa.int64()),
                            ("record_type", pa.string()), ("refers_to", pa.int64())])
        out, name, at, captures = None, "", 0, []

        def closed():
            out.close()
            captures.sort(key=lambda c: (c["url_key"], c["time"], c["page_id"] is not None, c["page_id"] or 0))
            return pa.RecordBatch.from_pylist(captures, schema)

        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
                if out is None:
                    name, at, captures = f"{uuid.uuid4().hex}.warc.gz", 0, []
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                time = (START + timedelta(seconds=(row["page_id"] or 0) % 31_536_000)).strftime("%Y-%m-%dT%H:%M:%SZ")
                gz = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = gz.compress(to_record(row["page_id"], row["url"], row["html"].encode("utf-8"), row["digest"],
                                             row["record_type"], row["refers_to"], time)) + gz.flush()
                out.write(data)
                captures.append({k: row[k] for k in ("page_id", "digest", "payload_bytes", "record_type", "refers_to")}
                                | {"url_key": url_key(row["url"]), "time": time, "run": name, "at": at, "length": len(data)})
                at += len(data)
                if at >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return pages.mapInArrow(run, RUN)


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the
    winner goes up; after a run's head is taken only its path is played again."""

    def __init__(self, runs: list[list]):
        self.runs, self.at, self.k = runs, [0] * len(runs), max(1, len(runs))
        self.tree = [-1] * self.k
        for r in range(len(runs)):
            self._play(r)

    def _key(self, r: int):
        return (0, self.runs[r][self.at[r]], r) if self.at[r] < len(self.runs[r]) else (1, None, r)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self._key(a), self._key(b)
        return x < y if x[0] == y[0] == 0 else (x[0], x[2]) < (y[0], y[2])

    def _play(self, r: int) -> None:
        node = (r + self.k) // 2
        while node > 0:
            if self.tree[node] == -1:  # still being built: wait here for an opponent
                self.tree[node] = r
                return
            if self._beats(self.tree[node], r):
                self.tree[node], r = r, self.tree[node]
            node //= 2
        self.tree[0] = r

    def __iter__(self):
        while self.runs:
            r = self.tree[0]
            if self.at[r] >= len(self.runs[r]):
                return
            yield self.runs[r][self.at[r]]
            self.at[r] += 1
            self._play(r)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All captures with ``position`` in the order by URL key, time and id."""
    order = ["url_key", "time", "page_id", "run", "at"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches))
        if not whole.num_rows:
            return
        keys = [whole.column(c).to_pylist() for c in order]
        key = [(u, t, p is not None, p or 0, r, a, i) for i, (u, t, p, r, a) in enumerate(zip(*keys))]
        parts: dict[str, list] = {}
        for k in key:  # rows come run by run, each sorted
            parts.setdefault(k[4], []).append(k)
        merged = [k[-1] for k in LoserTree(list(parts.values()))]
        out = whole.take(pa.array(merged)).append_column("place", pa.array(range(len(merged)), pa.int64()))
        yield from out.combine_chunks().to_batches()

    ranges = max(1, -(-runs.count() // RANGE))
    ranged = runs.repartitionByRange(ranges, *order).sortWithinPartitions("run", "url_key", "time", "page_id")
    merged = written(ranged.withColumn("range", F.spark_partition_id()).mapInArrow(merge, RUN + ", range int, place long"), "capture_index")
    counts = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))  # a row a range
    before = counts.select("range", F.coalesce(F.sum("n").over(
        W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return merged.join(broadcast_if_small(written(before, "ranges")), "range").withColumn("position", F.col("before") + F.col("place")).drop("range", "place", "before")


def read_archives(spark, folder: str) -> DataFrame:
    """A row for each record of the archives in ``folder``, from the bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("run", pa.string()), ("at", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                            ("url", pa.string()), ("whole", pa.bool_())])
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                records = [{"run": name.rsplit("/", 1)[1], "at": at} | from_record(x) for at, x in members(data.as_buffer())]
                yield pa.RecordBatch.from_pylist(records, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return files.select("path", "content").mapInArrow(run, RECORD)


def archive(pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Writes, indexes and reads back; one row for each page."""
    spark = pages.sparkSession
    folder = folder or new_work_path(spark, "warc")
    runs = written(write_archives(resolve(pages, **columns), folder), "capture_runs")
    index = merge_runs(runs).select("run", "at", "url_key", "time", "position", F.col("digest").alias("index_digest"))
    return read_archives(spark, folder).join(index, ["run", "at"])


def query(spark, sf_dir):
    return archive(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "time", "position", "whole")


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, lower(trim(coalesce(url, ''), ' ')) AS u FROM pages),
d AS (SELECT page_id, u, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d),
m AS (SELECT *, regexp_extract(u, '^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)(\?[^#]*)?', ['host', 'path', 'query']) AS m FROM f),
h AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(m.host, '^.*@', ''), ':[0-9]*$', ''), '^www\.', '') AS host,
  rtrim(m.path, '/') AS path, array_to_string(list_sort(string_split(substr(m.query, 2), '&')), '&') AS query FROM m),
k AS (SELECT *, CASE WHEN host = '' THEN u ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')'
  || (CASE WHEN path = '' THEN '/' ELSE path END) || (CASE WHEN query = '' THEN '' ELSE '?' || query END) END AS url_key,
  strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id % 31536000), '%Y-%m-%dT%H:%M:%SZ') AS time FROM h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to, url_key, time,
  row_number() OVER (ORDER BY url_key, time, page_id) - 1 AS position, true AS whole FROM k
"""
