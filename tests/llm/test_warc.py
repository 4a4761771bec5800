"""Archives written and read back, against Python's own reading of the files and of the pages."""

import glob
import hashlib
import base64
import os
import random
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from ambrel.llm import warc
from tests.llm.test_corpus import ODD, prose

PAGES = "page_id long, url string, html string"


def pages_of(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def brute(rows, least=0):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is None, rows[i][1] or ""))
    first, out = {}, Counter()
    for i in order:
        page, _, html = rows[i]
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        again = len(data) >= least and digest in first
        out[(page, len(data), digest, "revisit" if again else "response", first[digest] if again else None)] += 1
        if len(data) >= least:
            first.setdefault(digest, page)
    return out


def found(df):
    return Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect())


def some_rows():
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<html><title>{i}</title>" + t + "</html>") for i, t in enumerate(prose(120, 5))]
    rows += [(1000 + i, f"http://o.example/ a\r\n{i}", t) for i, t in enumerate(ODD)] + [(2000 - i, None, rows[i % 9][2]) for i in range(60)]
    return rows + [(None, None, None), (None, "http://n", ""), (None, None, None), (7, "http://h0.example/7", rows[7][2]), (7, "http://h0.example/7", rows[7][2]), (3000, "u", "long " * 300_000)]


@pytest.mark.parametrize("least,file_rows", [(0, warc.FILE_ROWS), (0, 20), (50, 7)])
def test_round_trip(spark, tmp_path, least, file_rows):
    rows = some_rows()
    random.Random(3).shuffle(rows)
    warc.write_archives(pages_of(spark, rows).repartition(3), f"{tmp_path}/a", least, file_rows=file_rows)
    got = warc.read_archives(spark, f"{tmp_path}/a", payloads=True)
    assert found(got) == brute(rows, least)
    held = Counter(bytes(r["payload"]) for r in got.where("record_type = 'response'").collect())
    assert set(held) == {(html or "").encode() for _, _, html in rows}
    sizes = [sum(1 for _ in warc.split_frames(open(f, "rb").read())) for f in glob.glob(f"{tmp_path}/a/part-*")]
    assert sum(sizes) == len(rows) and max(sizes) < file_rows


def test_digests_beyond_the_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 2)
    monkeypatch.setattr(warc, "HOT", 8)
    rows = some_rows() + [(5000 + i, "hot", "the same") for i in range(300)]
    warc.write_archives(pages_of(spark, rows), f"{tmp_path}/a")
    assert found(warc.read_archives(spark, f"{tmp_path}/a")) == brute(rows)


def test_files_are_plain_frames_with_their_dictionary_first(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<html><body class='page'><h1>{i}</h1>" + t) for i, t in enumerate(prose(3000, 9, 80))]
    warc.write_archives(pages_of(spark, rows).coalesce(1), f"{tmp_path}/a")
    (file,) = glob.glob(f"{tmp_path}/a/part-*")
    data = open(file, "rb").read()
    assert data[:4] == warc.DICTIONARY_MAGIC and int.from_bytes(data[4:8], "little") > 1000
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + int.from_bytes(data[4:8], "little")])
    # the library's own streaming reader passes over skippable frames
    with zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data, read_across_frames=True) as stream:
        whole = stream.read()
    records = [*warc.split_frames(data)]
    assert whole == b"".join(records) and len(records) == 3000
    alone = sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(r)) for r in records)
    assert len(data) < 0.8 * alone


@pytest.mark.parametrize("spoil", ["cut", "flip", "head"])
def test_damage_is_found(spark, tmp_path, spoil):
    warc.write_archives(pages_of(spark, some_rows()).coalesce(1), f"{tmp_path}/a")
    (file,) = glob.glob(f"{tmp_path}/a/part-*")
    data = bytearray(open(file, "rb").read())
    worse = {"cut": data[:-20], "flip": data[:-30] + bytes([data[-30] ^ 1]) + data[-29:], "head": b"\0" + data[1:]}[spoil]
    os.makedirs(f"{tmp_path}/b")
    open(f"{tmp_path}/b/part-0", "wb").write(worse)
    with pytest.raises(Exception, match="damaged|not an archive|ZstdError"):
        warc.read_archives(spark, f"{tmp_path}/b").collect()


def test_record_fields():
    record = warc.make_record(4, "http://a/\r\nb c", b"body\r\n\r\nmore", False, None)
    got = warc.parse_record(record)
    assert got["url"] == "http://a/%0D%0Ab%20c" and got["payload"] == b"body\r\n\r\nmore" and got["refers_to"] is None
    again = warc.parse_record(warc.make_record(5, None, b"body", True, 4))
    assert (again["record_type"], again["refers_to"], again["payload_bytes"], again["payload"], again["url"]) == ("revisit", 4, 4, None, None)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record.replace(b"more", b"less"))


def test_empty_and_clashing_columns(spark):
    assert warc.archived(pages_of(spark, [])).count() == 0
    more = pages_of(spark, some_rows()).withColumns({c: F.lit(1) for c in ("digest", "first", "revisit", "k", "n", "frame", "value", "payload_bytes")})
    assert found(warc.archived(more)) == brute(some_rows())
