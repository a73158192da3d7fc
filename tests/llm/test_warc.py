import base64
import hashlib

import pytest

from hestia.llm import warc as W
from hestia.llm.common import fresh_path


def expected(rows, least=0):
    last = {}
    for i, _, x in rows:
        last[x or ""] = max(last.get(x or "", -1), -1 if i is None else i)
    out = []
    for i, _, x in rows:
        data = (x or "").encode()
        to = last[x or ""]
        revisit = to >= 0 and i != to and len(data) >= least
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", to if revisit else None, None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/é\r\nX: y", "<p>é😀</p>\r\n\r\nWARC/1.1\r\n"),
    (2, None, "same"), (3, "u", "same"), (9, "u", "same"), (9, "u", "same"), (4, "u", None), (5, "u", ""),
    (6, "u", "long ü \r\n" * 5000), (7, "u", "long ü \r\n" * 5000), (8, "u", "x" * 8192), (10, "u", "y" * 8193), (None, "u", "same"), (None, "u", "alone"),
]


@pytest.mark.parametrize("least,per_file,segment", [(0, 4000, 4), (5, 1, 1)])
def test_round_trip(spark, monkeypatch, least, per_file, segment):
    monkeypatch.setattr(W, "PER_FILE", per_file)
    monkeypatch.setattr(W, "SEGMENT", segment)
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS id", "3 AS last")
    got = sorted((tuple(r) for r in W.archive_and_read(df, least=least).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem").collect()), key=repr)
    assert got == expected(ROWS, least)
    assert W.archive_and_read(df.limit(0)).count() == 0


def test_damage_is_told(spark):
    p = W.with_revisits(spark.createDataFrame([(6, "u", "z" * 50000), (7, "u", "z" * 50000)], "page_id long, url string, payload string"))
    values = [r.value for r in W.records(p).collect()]
    assert sum("WARC-Segment-Number" in v for v in values) > 2
    for kept in ([v for v in values if "Segment-Number: 2" not in v], [v for v in values if "Total-Length" not in v], [v.replace("zz", "zy", 1) for v in values]):
        path = fresh_path(spark, "damaged")
        spark.createDataFrame([(v,) for v in kept], "value string").write.option("lineSep", "\r\n\r\n").text(path)
        rows = W.read_archives(spark, path).collect()
        assert len(rows) == 2 and all(r.problem for r in rows)


def test_framing():
    assert W.unchunked(b"5\r\nhello\r\n1;x=y\r\n!\r\n0\r\n\r\n") == b"hello!"
    with pytest.raises(ValueError):
        W.unchunked(b"5\r\nhel")
