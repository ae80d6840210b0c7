"""WARC archives: read-back, dictionary frame, revisits."""

import hashlib

from ebbflow.llm import warc
from ebbflow.llm.common import read_files, scratch


def expected(rows):
    """Rows (page_id, url, html) by the rule, repeated rows of the smallest id all responses."""
    first = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        original = first.get(data)
        revisit = original is not None and original != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", original if revisit else None))
    return sorted(out, key=str)


def test_edge_rows(spark):
    big, text = "é" * 200_000, "same payload " * 20
    rows = [(3, "u\r\nx", text), (1, None, text), (1, "u", text), (None, "n", text), (2, "u", None), (4, "v", "short"), (5, "v", "short"), (6, "", ""), (7, "w", big), (8, "w", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    got = [tuple(r) for r in warc.warc_report(pages).collect()]
    assert sorted(got, key=str) == expected(rows)
    assert warc.warc_report(pages.limit(0)).count() == 0


def test_records_can_be_read_alone_and_files_lead_with_a_dictionary(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    uri = "file://" + scratch(spark, "warc-test").removeprefix("file://")
    index = warc.write_archives(pages, uri).collect()
    files = {r["path"].rsplit("/", 1)[1]: bytes(r["content"]) for r in read_files(spark, uri, warc.SUFFIX).collect()}
    html = {r["page_id"]: r["html"].encode() for r in pages.collect()}
    assert len(index) == len(html)
    for r in index:
        data = files[r["file"]]
        assert data[:4] == bytes.fromhex("5d2a4d18")
        fields, block = warc.read_record(data, r["offset"], r["length"])
        size, payload = warc.payload_of(fields, block)
        assert size == len(html[r["page_id"]]) and payload in (None, html[r["page_id"]])
    assert sum(map(len, files.values())) < sum(map(len, html.values())) / 2
