"""WARC archives written and read by index.

Writing gives one archive a task, each record a gzip member of its own, and an index row (file, offset, length, URL,
digest) per record, which is stored as Parquet before anything is read. Reading takes selected index rows,
sorted by file and offset, joins neighbouring byte ranges to one read, and parses the records in them. A task
that is run again writes another file, and the index names those of tasks that ended.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftlode.llm.workspace import Workspace, checked_join

#: Bytes between two ranges that are read along, of one read, and of the records of a task, about.
GAP, READ, TASK = 64 << 10, 4 << 20, 64 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(path: str) -> str:
    return path if ":/" in path else f"file://{path}"


def _name(page_id) -> str:
    return f"<urn:siftlode:page:{'' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record as a gzip member; a revisit leaves out the payload and says how long it is."""
    http = _HTTP % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", "WARC-Date: 2000-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + block + b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def write_archives(pages: DataFrame, ws: Workspace, least: int = 0) -> DataFrame:
    """The index of the archives written of ``pages(page_id, url, html)``.

    Of equal payloads of ``least`` bytes or more, the smallest page_id's is a response and the others revisit it; rows that
    repeat that id are responses too. A null html is an empty payload; a null id comes after all others.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    digests = ws.write(rows.select("page_id", F.sha1("payload").alias("sha1"), F.length("payload").alias("size")), "digests").filter(F.col("size") >= least)
    firsts = digests.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null").select("sha1", "first")
    firsts = ws.write(firsts, "firsts")
    # a payload may be that of a third of all pages
    again = checked_join(digests, firsts, "sha1", "inner", 96 * firsts.count()).filter(~F.col("page_id").eqNullSafe(F.col("first"))).select(F.col("page_id").alias("again"), "sha1", "first").distinct()
    again = ws.write(again, "again")
    keyed = rows.withColumn("page", F.xxhash64("page_id", F.sha1("payload")))
    told = again.select(F.xxhash64("again", "sha1").alias("page"), F.col("first").alias("refers_to"))
    told = checked_join(keyed, told, "page", "left", 24 * again.count()).select("page_id", "url", "payload", "refers_to")
    folder = _uri(f"{ws.root}/archives")

    def run(batches):
        fs, path = pa.fs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        at = 0
        with fs.open_output_stream(f"{path}/{name}", compression=None) as out:
            for b in batches:
                index = []
                for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    member = record(page_id, url, payload, digest, refers_to, refers_to is not None)
                    out.write(member)
                    index.append((page_id, url, digest, name, at, len(member)))
                    at += len(member)
                cols = zip(*index, strict=True) if index else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    names = ["page_id", "url", "digest", "file", "offset", "length"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
    index = ws.write(told.mapInArrow(run, "page_id long, url string, digest string, file string, offset long, length long"), "index")
    ws.keep("index")
    return index


def read_archives(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records of the selected index rows: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to`` (and ``payload``)."""
    folder = _uri(folder)

    def runs(rows):
        """Rows of one file whose ranges lie close together."""
        group, end = [], 0
        for r in rows:
            if group and (r[0] != group[0][0] or r[1] > end + GAP or r[1] + r[2] - group[0][1] > READ):
                yield group
                group = []
            group.append(r)
            end = r[1] + r[2]
        if group:
            yield group

    def number(name: str) -> int | None:
        tail = name.rstrip(">").rsplit(":", 1)[1]
        return int(tail) if tail else None

    def run(batches):
        fs, path = pa.fs.FileSystem.from_uri(folder)
        file, opened = None, None
        for b in batches:
            out = []
            for group in runs(zip(*(c.to_pylist() for c in b.columns), strict=True)):
                if group[0][0] != file:
                    file = group[0][0]
                    if opened:
                        opened.close()
                    opened = fs.open_input_file(f"{path}/{file}")
                base = group[0][1]
                data = opened.read_at(group[-1][1] + group[-1][2] - base, base)
                for _, offset, length in group:
                    head, block = parse(data[offset - base : offset - base + length])
                    http, _, body = block.partition(b"\r\n\r\n")
                    revisit = head["WARC-Type"] == "revisit"
                    size = int(http.rsplit(b"Content-Length: ", 1)[1]) if revisit else len(body)
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base64.b32encode(hashlib.sha1(body).digest()).decode()
                    refers_to = number(head["WARC-Refers-To"]) if revisit else None
                    out.append((number(head["WARC-Record-ID"]), size, digest, head["WARC-Type"], refers_to, None if revisit else body))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[: len(names)], kinds, strict=False)], names)
        if opened:
            opened.close()

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * with_payload]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    chosen = index.select("file", "offset", "length")
    # told by the records' bytes, as the rows of the index are small
    tasks = max(-(-(chosen.agg(F.sum("length")).first()[0] or 0) // TASK), index.sparkSession.sparkContext.defaultParallelism)
    chosen = chosen.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return chosen.mapInArrow(run, schema)


def archived(pages: DataFrame, least: int = 0, with_payload: bool = False) -> DataFrame:
    """Every page written to archives and read back by the index.

    Null and empty htmls are empty payloads; pages of any length are written and read whole, one at a time; of ties of payload the smallest id
    is the response, and so are all rows that repeat it; a null id revisits where any other id has its payload, and has a record without number.
    Other columns are ignored. An empty table gives an empty result.
    """
    ws = Workspace(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, ws, least), f"{ws.root}/archives", with_payload)
