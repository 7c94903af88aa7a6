"""WARC bundles: roles against brute force, exact round trips, frames read one by one."""

import base64
import glob
import hashlib
import io

import pytest
import zstandard

from corpusloom.llm import warc

SCHEMA = "page_id long, url string, html string, d string, n int, f_id long"


def rows():
    long_text = "".join(chr(32 + (k * 7) % 90) for k in range(30_000))
    out = [(k, f"http://h/{k}", t) for k, t in enumerate(
        [None, "", "", "a", "b", "a", "<p>Été 日本</p>", "\r\n\r\n", long_text, long_text, "WARC/1.1\r\n\r\nx"])]
    out += [(5, "http://h/5", "a"), (5, "http://h/5", "a"), (1, "http://h/0", "again"), (1, "http://h/1", "again"), (1, None, "again"),
            (None, "http://n", "a"), (None, "http://n", "only null"), (None, "http://n", "only null"), (None, None, None),
            (90, "http://h/a b\r\nX: y", "odd url"), (91, "", "empty url")]
    return out


def want(pages, least):
    first, out = {}, []
    for i, u, h in sorted(pages, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or "")):
        raw = (h or "").encode()
        key = raw if len(raw) >= least else object()
        code = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        if key in first:
            out.append((i, len(raw), code, "revisit", first[key]))
        else:
            first[key] = i
            out.append((i, len(raw), code, "response", None))
    return sorted(out, key=repr)


def report(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("least", [0, 2])
def test_roles_equal_brute_force(spark, tmp_path, least):
    df = spark.createDataFrame([(*r, "clash", 7, 1) for r in rows()], SCHEMA).repartition(4)
    folder = f"{tmp_path}/w"
    index = warc.write_archives(df, folder, least_bytes=least, frame_bytes=2000, file_bytes=3000)
    found = warc.read_archives(spark, folder)
    assert report(found) == want(rows(), least)
    payloads = {r["record_id"]: r for r in found.collect()}
    assert len(payloads) == len(rows())
    texts = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in rows()}
    for r in payloads.values():
        digest = base64.b32decode(r["payload_digest"]).hex()
        assert r["payload"] == (texts[digest] if r["record_type"] == "response" else None)
    assert {r["url"] for r in payloads.values()} >= {"http://h/a%20b%0D%0AX:%20y", "", None}
    # a plain reader of the files alone sees every record, in order, at the offsets of the index
    files = {f.rsplit("/", 1)[1]: open(f, "rb").read() for f in glob.glob(f"{folder}/archives/*")}
    assert len(files) > 4
    for row in index.collect():
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(files[row["archive"]]), read_across_frames=True).read()
        table = warc.read_seek_table(_Bytes(files[row["archive"]]))
        start = sum(x[2] for x in table[:row["frame"]])
        for spot in row["records"]:
            at = start + spot["offset"]
            fields, _ = warc.parse_record(plain[at:at + spot["length"]])
            assert fields["warc-record-id"] == spot["record_id"] and plain[at + spot["length"] - 4:at + spot["length"]] == b"\r\n\r\n"
            if fields["warc-type"] == "revisit":
                assert payloads[fields["warc-refers-to"]]["record_type"] == "response"


class _Bytes(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_records_are_fetched_by_identifier(spark, tmp_path):
    df = spark.createDataFrame([(k, "u", f"page {k} " * 50) for k in range(300)], "page_id long, url string, html string").repartition(3)
    folder = f"{tmp_path}/w"
    index = warc.write_archives(df, folder, frame_bytes=4000)
    spots = [s for r in index.collect() for s in r["records"]]
    some = [s["record_id"] for s in spots if s["page_id"] in (7, 8, 250)]
    wanted = spark.createDataFrame([(x,) for x in some + some + ["<urn:uuid:none>"]], "record_id string")
    got = warc.read_archives(spark, folder, wanted).collect()
    assert sorted((r["page_id"], r["payload"].decode()) for r in got) == [(k, f"page {k} " * 50) for k in (7, 8, 250)]


def test_damage_is_found_and_strangers_are_not_read(spark, tmp_path):
    df = spark.createDataFrame([(k, "u", f"page {k} " * 50) for k in range(40)], "page_id long, url string, html string").coalesce(1)
    folder = f"{tmp_path}/w"
    warc.write_archives(df, folder)
    name = glob.glob(f"{folder}/archives/*")[0]
    raw = open(name, "rb").read()
    open(f"{folder}/archives/part-00000-lost-0000.warc.zst", "wb").write(raw[:100])      # left by a lost attempt
    assert warc.read_archives(spark, folder).count() == 40
    table = warc.read_seek_table(_Bytes(raw))
    at = table[0][0] + table[0][1] // 2
    open(name, "wb").write(raw[:at] + bytes([raw[at] ^ 255]) + raw[at + 1:])
    with pytest.raises(Exception, match="damaged|decompress|corrupt|Corrupt|checksum"):
        warc.read_archives(spark, folder).collect()


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, f"{tmp_path}/w")
    assert warc.read_archives(spark, f"{tmp_path}/w").count() == 0
    assert warc.archive_report(none).columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_many_equal_rows_are_expanded_in_runs(spark, monkeypatch):
    monkeypatch.setattr(warc, "RUN", 7)
    df = spark.createDataFrame([(3, "u", "same")] * 50, "page_id long, url string, html string").repartition(5)
    got = warc.archive_report(df).collect()
    assert len(got) == 50 and sum(r["record_type"] == "response" for r in got) == 1
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {3}
