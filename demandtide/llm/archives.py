"""WARC records in ZIP packages: written by tasks, read back by ranges without extraction.

Each task writes packages ``part-<task>-<number>.zip`` to a shared folder. A package holds two stored
(uncompressed) members: ``archive/data.warc.gz``, one gzip member per record, and
``indexes/index.cdxj``, one JSON line per record with its offset and length. A package is written
under a name of its attempt and then renamed, so a task that runs again replaces its own files.

Reading needs no more than ranges: the end of the file gives the end-of-central-directory record
(and its ZIP64 form), the directory gives the members, the index member gives each record's place,
and records are read from the archive member where they lie. Index rows are dealt out anew, so one
large package is read by many tasks.

Of records with equal payloads of at least ``least`` bytes the one of the smallest page id is a
response, the others revisit it, naming its URI and date. Rows that share that id and payload are
all responses. Every record has an id of its own; all have the date of the writing call.

Defined results: a null html is an empty payload, a null url an empty one; null ids come last and are kept
as null; an empty table gives no package and no rows; other columns are not read.
"""

from __future__ import annotations

import datetime
import gzip
import hashlib
import json
import math
import struct
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandtide.llm import base
from demandtide.session import scratch_dir

#: Bytes of records after which a task begins its next package.
PACKAGE_BYTES = 32 << 20
#: Bytes of packages that one task reads, in slices of the second size, and the most tasks to deal them to.
TASK_BYTES, SLICE_BYTES, MOST_TASKS = 32 << 20, 1 << 20, 100_000
#: Repeated payloads up to which their table is broadcast.
BROADCAST_PAYLOADS = 100_000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"


def typed(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """``page_id, url, payload, payload_digest, record_type, refers_to, refers_to_url`` of each page."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("payload_digest"))
    long = rows.filter(F.length("payload") >= least)
    first = long.groupBy("payload_digest").agg(F.min(F.struct("page_id", "url")).alias("least"), F.min("page_id").alias("first"), F.count("*").alias("c")).filter("c > 1")
    first = first.select("payload_digest", "first", F.when(F.col("least.page_id").isNotNull(), F.col("least.url")).alias("first_url"))
    joined = rows.join(base.small(base.kept(first, "payloads"), BROADCAST_PAYLOADS), "payload_digest", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"), F.when(again, F.col("first_url")).alias("refers_to_url"))


def record(place: str, date: str, page_id, url: str, payload: bytes, digest: str, kind: str, refers_to=None, refers_to_url: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit has the head of the answer only. ``place`` tells records apart."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if kind == "revisit" else head + payload
    name = hashlib.sha256(json.dumps([place, page_id, url, digest]).encode()).hexdigest()
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:sha256:{name}>"), ("WARC-Date", date), ("WARC-Target-URI", " ".join(url.split())), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-ID", json.dumps(page_id))]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To-Target-URI", " ".join((refers_to_url or "").split())), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-ID", json.dumps(refers_to))]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_packages(rows: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Writes what ``typed`` gives; one row ``path, size, records`` per package."""
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("size", T.LongType()), T.StructField("records", T.LongType())])
    # One date and name for the whole call: a task that runs again writes the same records.
    date, call = datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ"), folder.rpartition("/")[2]

    def run(batches):
        context, number = TaskContext.get(), 0
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)

        def all_rows():
            for batch in batches:
                yield from zip(*[batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to", "refers_to_url")])

        todo = all_rows()
        row = next(todo, None)
        while row is not None:
            name = f"{root}/part-{context.partitionId():06d}-{number:04d}.zip"
            attempt = f"{name}.{context.taskAttemptId()}"
            index, at = [], 0
            with fs.open_output_stream(attempt) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as package:
                with package.open(DATA, "w", force_zip64=True) as data:
                    while row is not None and at < package_bytes:
                        page_id, *rest = (x.as_py() for x in row)
                        place = f"{call}/{context.partitionId()}/{number}/{len(index)}"
                        packed = gzip.compress(record(place, date, page_id, *rest), 1, mtime=0)
                        data.write(packed)
                        index.append(json.dumps({"page_id": page_id, "offset": at, "length": len(packed)}))
                        at += len(packed)
                        row = next(todo, None)
                package.writestr(INDEX, "\n".join(index) + "\n")
            size = fs.get_file_info(attempt).size
            fs.move(attempt, name)
            number += 1
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size]), pa.array([len(index)])], schema=to_arrow_schema(schema))

    return base.kept(rows.mapInArrow(run, schema), "packages")


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """Start and length of every stored member, from the central directory."""
    tail_at = max(0, size - 65_557)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no central directory")
    count, length, start = struct.unpack("<H", tail[end + 10 : end + 12])[0], *struct.unpack("<II", tail[end + 12 : end + 20])
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        file.seek(struct.unpack("<Q", tail[end - 12 : end - 4])[0])
        wide = file.read(56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("bad ZIP64 record")
        count, length, start = struct.unpack("<QQQ", wide[32:56])
    file.seek(start)
    directory, at, found = file.read(length), 0, {}
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("bad directory entry")
        method, = struct.unpack("<H", directory[at + 10 : at + 12])
        packed, plain, n, extra, note = struct.unpack("<IIHHH", directory[at + 20 : at + 34])
        local, = struct.unpack("<I", directory[at + 42 : at + 46])
        name = directory[at + 46 : at + 46 + n].decode()
        x, stop = at + 46 + n, at + 46 + n + extra
        while x + 4 <= stop:  # ZIP64: only the fields that do not fit, in this order
            kind, length = struct.unpack("<HH", directory[x : x + 4])
            if kind == 1:
                values = iter(struct.unpack(f"<{length // 8}Q", directory[x + 4 : x + 4 + length // 8 * 8]))
                plain = next(values) if plain == 0xFFFFFFFF else plain
                packed = next(values) if packed == 0xFFFFFFFF else packed
                local = next(values) if local == 0xFFFFFFFF else local
            x += 4 + length
        if method == 0:
            file.seek(local)
            head = file.read(30)
            found[name] = (local + 30 + sum(struct.unpack("<HH", head[26:30])), packed)
        at = stop + note
    return found


def parse(block: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of a record."""
    head, _, rest = block.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def read_packages(packages: DataFrame, folder: str, id_type: T.DataType) -> DataFrame:
    """Every record of the packages: ``page_id, url, payload, payload_digest`` (of the payload read,
    or, for a revisit, as stated), ``record_type, refers_to``."""
    places = T.StructType([T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType([T.StructField("page_id", id_type), T.StructField("url", T.StringType()), T.StructField("payload", T.BinaryType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", id_type)])

    def indexes(batches):
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, size in zip(batch.column("path").to_pylist(), batch.column("size").to_pylist()):
                with fs.open_input_file(path) as file:
                    found = members(file, size)
                    start = found[DATA][0]
                    file.seek(found[INDEX][0])
                    lines = [json.loads(x) for x in file.read(found[INDEX][1]).decode().splitlines()]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array([start + x["offset"] for x in lines], pa.int64()), pa.array([x["length"] for x in lines], pa.int64())], schema=to_arrow_schema(places))

    def records(batches):
        fs, _ = pafs.FileSystem.from_uri(folder)
        opened, file = None, None
        try:
            for batch in batches:
                out, held = [], 0
                for path, offset, length in zip(*[batch.column(c).to_pylist() for c in ("path", "offset", "length")]):
                    if path != opened:
                        if file is not None:
                            file.close()
                        opened, file = path, fs.open_input_file(path)
                    file.seek(offset)
                    fields, payload = parse(zlib.decompress(file.read(length), 31))
                    kind = fields["WARC-Type"]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['X-Page-ID']} is damaged")
                    out.append((json.loads(fields["X-Page-ID"]), fields.get("WARC-Target-URI", ""), payload, digest, kind, json.loads(fields.get("X-Refers-To-Page-ID", "null"))))
                    held += len(payload)
                    if held > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), to_arrow_schema(schema))], schema=to_arrow_schema(schema))
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), to_arrow_schema(schema))], schema=to_arrow_schema(schema))
        finally:
            if file is not None:
                file.close()

    # Stated numbers of tasks: the rows are small, but each stands for bytes to read.
    tasks = min(MOST_TASKS, max(1, math.ceil((packages.agg(F.sum("size")).first()[0] or 0) / TASK_BYTES)))
    listed = packages.select("path", "size").repartition(tasks, "path").mapInArrow(indexes, places)
    slices = listed.repartition(tasks, "path", F.floor(F.col("offset") / SLICE_BYTES)).sortWithinPartitions("path", "offset")
    return slices.mapInArrow(records, schema)


def round_trip(spark: SparkSession, pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 100) -> DataFrame:
    """Writes a record for each page, reads the packages back and gives, per record, page_id,
    payload_bytes and payload_digest (of the whole payload, a revisit's from the response it refers
    to), record_type and refers_to."""
    folder = scratch_dir(spark, "warc")
    packages = write_packages(typed(pages, page_id, url, html, least), folder)
    back = read_packages(packages, folder, pages.schema[page_id].dataType)
    back = base.kept(back.select("page_id", F.length("payload").cast("bigint").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"), "records")
    answers = back.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("whole"))
    again = back.filter("record_type = 'revisit'").join(answers, ["refers_to", "payload_digest"], "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return back.filter("record_type = 'response'").select(*columns).union(again.withColumn("payload_bytes", F.col("whole")).select(*columns))
