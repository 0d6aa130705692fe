import base64
import hashlib

import pytest

from martloom.llm import warc

SCHEMA = "page_id long, url string, html string, size string, content string"


def test_archive_round_trip():
    records = [warc.record(i, f"http://h/{i}", (f"<p>{i} common body of a page</p>" * (i + 1)).encode(), None, False) for i in range(60)]
    records.append(warc.record(99, "u", b"", None, False))
    data = warc.write_archive(records)
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    assert list(warc.read_archive(data + b"\n")) == records
    assert list(warc.read_archive(warc.write_archive([]) + b"\n")) == []
    assert list(warc.read_archive(warc.write_archive(records[:1]) + b"\n")) == records[:1]
    with pytest.raises(ValueError):
        list(warc.read_archive(data[: len(data) // 2]))


def test_every_truncation_is_found():
    records = [warc.record(i, f"http://h/{i}", f"<p>{i} common body of a page</p>".encode() * 9, None, False) for i in range(12)]
    for some in ([], records[:1], records):
        data = warc.write_archive(some) + b"\n"
        assert list(warc.read_archive(data)) == some
        for cut in range(len(data)):
            with pytest.raises(ValueError):
                list(warc.read_archive(data[:cut]))
        with pytest.raises(ValueError):
            list(warc.read_archive(data + b"\n"))


def test_dictionary_is_drawn_from_all_of_all_records(monkeypatch):
    drawn = []
    monkeypatch.setattr(warc.zstandard, "train_dictionary", lambda size, sample: drawn.extend(sample) or 1 / 0)
    records = [bytes([i % 256]) * 9000 for i in range(1200)] + [b"a" * 3_000_000 + b"end" * 5000]
    with pytest.raises(ZeroDivisionError):
        warc.dictionary_of(records)
    assert len({p[:1] for p in drawn[:-200]}) > 150 and any(b"endend" in p for p in drawn)
    assert sum(map(len, drawn)) <= warc.SAMPLE_BYTES


def test_dictionary_helps():
    records = [warc.record(i, f"http://host/{i}", f"<html><nav>the same navigation everywhere</nav><p>{i * 7919}</p></html>".encode(),
                           None, False) for i in range(300)]
    import zstandard

    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(r)) for r in records)
    assert len(warc.write_archive(records)) < plain


def test_pages(spark, tmp_path):
    big = "é\r\n\r\n<x>" * 40_000
    rows = [(1, "u", "same"), (5, "u", "same"), (3, None, "same"), (2, "u", None), (4, "u\r\nX: y", ""), (6, "u", big), (7, "u", "one"),
            (7, "u", "one"), (None, "u", "same")]
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    path = str(tmp_path / "w")
    warc.write_warc(pages, path, file_bytes=1000)
    out = warc.read_warc(spark, path).collect()
    assert len(out) == len(rows)
    by = {r.page_id: r for r in out}
    top = {"same": 5, "": 4, big: 6, "one": 7}
    for i, _, html in rows:
        payload = (html or "").encode()
        r, first = by[i], top[html or ""]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if i == first else ("revisit", first))


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "ab", "", ""), (2, "u", "ab", "", ""), (3, "u", "abc", "", ""), (4, "u", "abc", "", "")], SCHEMA)
    warc.write_warc(pages, str(tmp_path / "w"), least_bytes=3)
    assert sorted((r.page_id, r.record_type) for r in warc.read_warc(spark, str(tmp_path / "w")).collect()) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_empty(spark, tmp_path):
    warc.write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


def test_a_frequent_payload_is_spread(spark, tmp_path, monkeypatch):
    """Payloads of more than a quarter of the pages come from the broadcast, with the same plan as the rest."""
    rows = [(i, "u", "" if i % 2 else f"page {i % 14}", "", "") for i in range(60)] + [(None, "u", "", "", "")]
    pages = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(str, warc.plan_records(pages).collect()))
    monkeypatch.setattr(warc, "FREQUENT", 4)
    assert sorted(map(str, warc.plan_records(pages).collect())) == want
    top = {}
    for i, _, html, _, _ in rows:
        top[html] = max(top.get(html, -1), -1 if i is None else i)
    by = {i: h for i, _, h, _, _ in rows}
    for r in warc.plan_records(pages).collect():
        assert (r.revisit, r.refers_to) == ((False, None) if r.page_id == top[by[r.page_id]] else (True, top[by[r.page_id]]))
