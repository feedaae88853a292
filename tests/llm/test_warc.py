"""Archives written and read back."""

import base64
import hashlib
import io
import os

import pyarrow.fs as pafs
import zstandard

from seriesforge.llm import warc as W
from seriesforge.llm.common import shared_folder

SF = "/root/testdata/sf0.01"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 5) for r in rows], "page_id bigint, url string, html string, frame int")


def brute(rows, least=0):
    first = {}
    for p, _, h in rows:
        if p is not None:
            first[h or ""] = min(first.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        revisit = p is not None and len(data) >= least and first[h or ""] != p
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first[h or ""] if revisit else None))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_sql(spark):
    from oracle_harness import compare
    assert compare(spark, "op7", W.op7_warc_bundles, W.ORACLE_SQL, SF) == []


HARD = [(3, "http://a/\r\nX: y%41", "same"), (2, None, "same"), (9, "u", "same"), (5, "u", None), (4, "u", ""), (6, "u", "WARC/1.1\r\n\r\nContent-Length: 3"),
        (7, "é", "ü" * 400_000), (None, "n", "same"), (None, None, None), (8, "u", "x"), (8, "u", "x"), (10, "u", "x"), (11, "u", "y"), (11, "u", "same")]


def test_round_trip_and_random_access(spark):
    folder = shared_folder(spark, "warc-test")
    index = W.write_bundles(pages(spark, HARD), folder, frame_bytes=300, bundle_bytes=1000)
    back = W.read_bundles(index, folder)
    assert result(back) == brute(HARD)
    found = {(r.page_id, r.record_type): r for r in back.collect()}
    assert found[3, "revisit"].url == HARD[0][1] and found[2, "response"].url is None and bytes(found[7, "response"].payload).decode() == HARD[6][2]
    for r in index.collect():  # one record by one frame
        one = W.read_record(f"{folder}/{r.bundle}", r.frame, r.at)
        assert one["page_id"] == r.page_id
    assert {r.page_id for r in index.collect()} == {r[0] for r in HARD}


def test_bundles_are_plain_zstandard_files(spark):
    folder = shared_folder(spark, "warc-test")
    index = W.write_bundles(pages(spark, HARD), folder, frame_bytes=300).collect()
    store, root = W.open_store(folder)
    names = [f.path for f in store.get_file_info(pafs.FileSelector(root))]
    assert sorted(os.path.basename(n) for n in names) == sorted({r.bundle for r in index})
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(store.open_input_file(n).read()), read_across_frames=True).read() for n in names)
    assert whole.count(b"WARC-Record-ID") == len(HARD)


def test_smallest_payload_for_revisits(spark):
    folder = shared_folder(spark, "warc-test")
    assert result(W.read_bundles(W.write_bundles(pages(spark, HARD), folder, min_revisit=3), folder)) == brute(HARD, 3)


def test_empty_table(spark):
    folder = shared_folder(spark, "warc-test")
    assert W.read_bundles(W.write_bundles(pages(spark, []), folder), folder).collect() == []
