import hashlib
import random

import pytest

from ratecraft.llm import warc
from ratecraft.session import new_path

SCHEMA = "page_id long, url string, html string, block string, type string"


def html(rng, n):
    return "".join(rng.choice("abé<>\r\n\r\n WARC/1.1 ") for _ in range(n))


def test_round_trip(spark):
    rng = random.Random(8)
    texts = [html(rng, n) for n in (0, 1, 999, 1000, 5000, 40_000, 120_000)]
    rows = [(i, f"http://a/{i}\r\nx: y", t, "b", "t") for i, t in enumerate(texts + texts + texts[3:])]
    rows += [(100, None, None, "", ""), (101, None, None, "", ""), (None, "u", texts[4], "", ""), (None, "u", "tiny", "", ""), rows[-1], rows[-1]]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    path = new_path(spark, "warc")
    warc.write_archives(df, path)
    found = sorted(map(tuple, warc.pages_of(warc.read_archives(spark, path)).collect()), key=str)
    want = []
    for page, _, text, *_ in rows:
        payload = (text or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (text or "") and r[0] is not None]
        first = max(same, default=None)
        revisit = len(payload) >= 1000 and first is not None and page != first
        want.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert found == sorted(want, key=str)
    kinds = {r.type for r in spark.read.format("binaryFile").load(path).select("content").mapInArrow(warc._read, warc._RECORD).collect()}
    assert kinds == {"response", "revisit", "continuation"}


@pytest.mark.parametrize("n", [0, 1, 7, 8192, 20_000])
def test_chunks(n):
    payload = random.Random(n).randbytes(n)
    body = warc.framed(payload, 4096)
    assert warc.unframed(body) == payload
    assert warc.unframed(body[:-6]) != payload or n == 0
    assert warc.unframed(b"zz\r\n") is None and warc.unframed(b"5\r\nabc") is None and warc.unframed(b"") is None


def test_broken_segments_give_no_payload(spark):
    payload = b"x" * 90_000
    parts = list(warc.records_of("1", "1:0:0", "u", payload, None))
    assert len(parts) > 2

    def read(data):
        import gzip

        df = spark.createDataFrame([(gzip.compress(data),)], "content binary")
        records = df.mapInArrow(warc._read, warc._RECORD)
        path = new_path(spark, "broken")
        records.write.parquet(path)
        return path

    for chosen, whole in ((parts[::-1], True), (parts[:1] + parts[2:], False), (parts[:-1], False), (parts + parts[1:2], False)):
        path = read(b"\r\n\r\n".join([*chosen, b""]))
        found = warc.pages_of(warc.put_together(spark.read.parquet(path))).collect()
        assert [(r.page_id, r.payload_bytes) for r in found] == [(1, 90_000 if whole else None)]


def test_empty_table(spark):
    path = new_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert warc.pages_of(warc.read_archives(spark, path)).collect() == []
