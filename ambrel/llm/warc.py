"""WARC archives whose records are compressed one by one with a dictionary of their own file.

An archive is a .warc.zst file: a skippable frame that holds a Zstandard dictionary, then one frame a record. Every file
carries its own dictionary, trained on the file's first records up to SAMPLE_BYTES (a file of fewer trains on all), so any
file can be read alone, and a record can be read alone once its file's dictionary is known. Files without enough records
to train on have an empty dictionary frame and plain frames. Records are a task's rows in order, FILE_ROWS - 1 a file.

Spark's own writer and committer write the bytes, so an archive may stand in any store that Spark reaches, and a task that
is run again leaves one copy: frames are the values of a text table whose line separator is an empty skippable frame,
which decoders pass over. Frames may hold any bytes; files are read back whole and walked frame by frame.

Equal payloads are archived once. Payload digests (SHA-1) are summed up narrowly: the first page of each digest, with how
many rows it has. Only digests of several rows go back to the pages, by a broadcast while they are at most BROADCAST_ROWS,
by a join that sets hot digests apart beyond. The page with the smallest page_id holds the payload (a null id comes last),
the others are revisit records that name it. Of rows alike in page_id, url and html one is the first, as if they were
numbered. ``least`` is the size from which equal payloads are looked for; smaller ones are all archived.

Reading raises if a record's block, payload or digest is not what its headers say, or a file ends within a record.

A null html is an empty payload. A null url has no target address in its record; white space and control characters in
an address are percent-coded, as the format has no room for them. Pages of any size are records of their own. Rows may
repeat and ids be null: each row is a record. An empty table makes an archive without records. Columns other than
page_id, url and html are not archived, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT, as_table, new_path

FILE_ROWS, DICTIONARY_BYTES, SAMPLE_BYTES, LEVEL, BROADCAST_ROWS = 8192, 1 << 16, 1 << 22, 6, 100_000
#: Fixed values of the format: the magic numbers of a dictionary's frame, of an empty skippable frame and of a Zstandard frame.
DICTIONARY_MAGIC, EMPTY_FRAME, FRAME_MAGIC = b"\x5d\x2a\x4d\x18", b"\x50\x2a\x4d\x18\0\0\0\0", b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page, digest: str, place: str = "") -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'{page}|{digest}|{place}'.encode()).digest()[:16], version=5)}>"


def make_record(page, url: str | None, payload: bytes, revisit: bool, first, date: str = DATE, place: str = "") -> bytes:
    """A record with an HTTP response of ``payload``, or one that refers to page ``first`` for it."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    heads = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, digest, place)), ("WARC-Date", date)]
    if url is not None:
        heads.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)))
    if page is not None:
        heads.append(("Page-ID", page))
    if revisit:
        heads += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, digest)), *[("Refers-To-Page-ID", first)] * (first is not None)]
    heads += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in heads).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """A record's fields; ValueError where it isn't what its headers say."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    heads = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(heads.get("Content-Length", -1))]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or heads["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError("damaged record: its block is not what its headers say")
    http, _, payload = block.partition(b"\r\n\r\n")
    size, digest, revisit = int(re.search(rb"Content-Length: (\d+)", http)[1]), heads["WARC-Payload-Digest"].removeprefix("sha1:"), heads["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError("damaged record: its payload is not what its headers say")
    number = lambda k: int(heads[k]) if k in heads else None
    return {"page_id": number("Page-ID"), "url": heads.get("WARC-Target-URI"), "payload_bytes": size, "payload_digest": digest, "record_type": heads["WARC-Type"], "refers_to": number("Refers-To-Page-ID"), "payload": None if revisit else payload}


def with_types(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html, revisit and first of every row: whether its payload is archived with page ``first``."""
    key = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"), key.alias("digest"))
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.col("url").isNull().alias("no_url"), "url")
    alike = rows.where(F.octet_length("html") >= least).groupBy("digest", "page_id", "url").agg(F.count(F.lit(1)).alias("k"))
    several = alike.groupBy("digest").agg(F.sum("k").alias("n"), F.min(F.struct(order.alias("o"), "k")).alias("f")).where("n > 1")
    several = several.select("digest", "n", F.struct(F.col("f.o.page_id").alias("page_id"), F.col("f.o.url").alias("url"), F.col("f.k").alias("k")).alias("first"))
    several = as_table(several, "payloads")
    many = several.agg(F.count(F.lit(1)).alias("digests"), F.max("first.k").alias("alike"), F.sum("n").alias("rows")).first()
    if not many["digests"]:
        return rows.select("page_id", "url", "html", F.lit(False).alias("revisit"), F.lit(None).cast("long").alias("first"))
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    if many["digests"] <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(several.select("digest", "first")), "digest", "left")
    else:  # fewer than HOT digests have more than one in HOT of these rows
        is_hot = F.col("n") * HOT > many["rows"]
        hot = several.where(is_hot).select("digest", "first")
        rest = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
        joined = rows.join(F.broadcast(hot), "digest").unionByName(rest.join(several.where(~is_hot).select("digest", "first").hint("merge"), "digest", "left"))
    known = F.col("first").isNotNull()
    out = joined.select("page_id", "url", "html", (known & ~is_first).alias("revisit"), F.when(known, F.col("first.page_id")).alias("first"), F.coalesce(F.when(known & is_first, F.col("first.k")), F.lit(1)).alias("k"))
    single = out.where("k = 1").drop("k")
    if many["alike"] == 1:
        return single
    # rows alike in everything: each set once, then its other rows as revisits
    sets = out.where("k > 1").dropDuplicates(["page_id", "url", "html"])
    others = sets.select("page_id", "url", "html", F.lit(True).alias("revisit"), "first", F.explode(F.sequence(F.lit(2).cast("long"), F.col("k")))).drop("col")
    return single.unionByName(sets.drop("k")).unionByName(others)


def frames(rows: DataFrame, least: int = 0, date: str = DATE, file_rows: int = FILE_ROWS) -> DataFrame:
    """The frames of a task's files in order: of every ``file_rows`` the first is the dictionary's."""

    def run(batches):
        import zstandard
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()

        def packed(records, trained):
            plain = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True) if trained is None else zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
            return [plain.compress(r) for r in records]

        def train(records):
            try:  # fixed parameters: no search over them
                return zstandard.train_dictionary(DICTIONARY_BYTES, records, k=512, d=8, level=LEVEL)
            except zstandard.ZstdError:  # too little to learn from
                return None

        made = lambda out: pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
        held, size, written, trained, ready = [], 0, 0, None, False

        def begin():
            nonlocal held, trained, ready, written
            trained = train(held)
            data = b"" if trained is None else trained.as_bytes()
            out = [DICTIONARY_MAGIC + struct.pack("<I", len(data)) + data, *packed(held, trained)]
            written, held, ready = len(out), [], True
            return out

        place = 0
        for batch in batches:
            out = []
            for page, url, html, revisit, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "revisit", "first"))):
                payload = html.encode()
                place += 1
                record = make_record(page, url, payload, revisit, first, date, f"{task}.{place}" if revisit or len(payload) < least else "")
                if ready:
                    out += packed([record], trained)
                    written += 1
                else:
                    held.append(record)
                    size += len(record)
                    if size >= SAMPLE_BYTES or len(held) == file_rows - 1:
                        out += begin()
                if ready and written == file_rows:
                    size, ready = 0, False
                if len(out) >= 256:
                    yield made(out)
                    out = []
            if out:
                yield made(out)
        if held:
            yield made(begin())

    return rows.mapInArrow(run, "frame binary")


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = DATE, file_rows: int = FILE_ROWS) -> None:
    """Archive every row of ``pages`` under ``path``."""
    made = frames(with_types(pages, least), least, date, file_rows).select(F.col("frame").cast("string").alias("value"))
    made.write.option("lineSep", EMPTY_FRAME.decode()).option("maxRecordsPerFile", file_rows).text(path)


def frame_end(data: bytes, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends: behind its last block and its checksum."""
    import zstandard

    head = data[at : at + 18]
    checksum, at, last = 4 * zstandard.get_frame_parameters(head).has_checksum, at + zstandard.frame_header_size(head), 0
    while not last and at < len(data):
        block = int.from_bytes(data[at : at + 3], "little")
        last, at = block & 1, at + 3 + (1 if block >> 1 & 3 == 1 else block >> 3)  # a run of one byte holds that byte alone
    if not last or at + checksum > len(data):
        raise ValueError("damaged archive: it ends within a record")
    return at + checksum


def split_frames(data: bytes):
    """The records of an archive in order."""
    import zstandard

    if not data:
        return
    if data[:4] != DICTIONARY_MAGIC:
        raise ValueError("not an archive: no dictionary leads it")
    at = 8 + struct.unpack_from("<I", data, 4)[0]
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:at])) if at > 8 else zstandard.ZstdDecompressor()
    while at < len(data):
        if data[at : at + 4] == FRAME_MAGIC:
            end = frame_end(data, at)
            yield reader.decompress(data[at:end])
            at = end
        elif data[at : at + 8] == EMPTY_FRAME:
            at += 8
        else:
            raise ValueError("damaged archive: no frame where one should begin")


def read_archives(spark, path: str, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives under ``path``; its payload only if asked for."""
    names = [f.split(" ")[0] for f in READ.split(", ")][: None if payloads else -1]
    schema = pa.schema(list(zip(names, (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))))

    def run(batches):
        for batch in batches:
            for data in batch.column("content"):
                out = []
                for record in split_frames(data.as_buffer().to_pybytes()):
                    out.append(parse_record(record))
                    if len(out) == 512:
                        yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in out], schema)
                        out = []
                yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in out], schema)

    files = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format("binaryFile").load(path)
    return files.select("content").mapInArrow(run, ", ".join(READ.split(", ")[: len(names)]))


def archived(pages: DataFrame, least: int = 0) -> DataFrame:
    """What archives of ``pages`` in the shared folder say of every page."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    return read_archives(pages.sparkSession, path).drop("url")


def query(spark, sf_dir: str) -> DataFrame:
    return archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SQL = f"""
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS bytes, sha1(coalesce(html, '')) AS hex FROM pages),
r AS (SELECT *, row_number() OVER w AS k, first(page_id) OVER w AS head, count(*) OVER (PARTITION BY hex) AS n FROM p WINDOW w AS (PARTITION BY hex ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, bytes::BIGINT AS payload_bytes, CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN k > 1 THEN head END AS refers_to,
list_aggregate(list_transform(range(32), lambda i: substr('{_LETTERS}', ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest FROM r"""
