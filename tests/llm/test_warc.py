import base64
import hashlib
from pathlib import Path

import pytest
import zstandard as zstd

from pairloom.llm import warc
from pairloom.staging import new_stage

PAGES = [
    (1, "http://a.example/x?q=1&r=%20", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (0, "http://a.example/\r\nWARC-Type: x", None),
    (5, "http://é.example/ä b", ""),
    (None, "http://n.example", "<p>one</p>"),
    (None, "http://n.example", "only here"),
    (7, "u", "x" * 300_000 + "\r\n\r\nWARC/1.1\r\n"),
    (8, "u", "漢字\U0001f600"),
] + [(k, f"http://b.example/{k}", f"<html><body>page {k} of a site with much in common</body></html>") for k in range(20, 620)]


def pages(spark, rows=PAGES):
    more = [(*r, "x", b"y") for r in rows]
    return spark.createDataFrame(more, "page_id bigint, url string, html string, digest string, payload binary").repartition(2)


def by_rule(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, url, html in rows:
        data = (html or "").encode()
        other = first.get(html or "") if len(data) >= least else None
        other = None if other == i else other
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, url, "response" if other is None else "revisit", len(data), digest, other, data if other is None else None))
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    path = new_stage(spark, "warc")
    warc.write_archives(pages(spark), path, least_revisit_bytes=least)
    rows = [(*r[:6], None if r[6] is None else bytes(r[6])) for r in warc.read_archives(spark, path).collect()]
    assert sorted(rows, key=str) == sorted(by_rule(PAGES, least), key=str)


def test_archives_are_plain_zstandard(spark):
    path = new_stage(spark, "warc")
    warc.write_archives(pages(spark).coalesce(1), path)
    (file,) = (p for p in Path(path).iterdir() if p.name.startswith("part-"))
    content = file.read_bytes()
    assert content[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(content[4:8], "little")
    data = zstd.ZstdCompressionDict(content[8 : 8 + size])
    whole = zstd.ZstdDecompressor(dict_data=data).stream_reader(content[8 + size :], read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(PAGES)
    assert sum(1 for _ in warc.frames_of(content)) == len(PAGES)


def test_a_dictionary_may_be_compressed():
    samples = [b"<html>page %d with much in common</html>" % k * 3 for k in range(500)]
    held = zstd.train_dictionary(4096, samples).as_bytes()
    packed = zstd.ZstdCompressor().compress(held)
    frame = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(held)).compress(samples[0])
    for lead in (held, packed):
        content = warc.struct.pack("<II", warc.DICTIONARY_MAGIC, len(lead)) + lead + frame + warc.EMPTY_FRAME.encode()
        assert [d for _, d in warc.frames_of(content)] == [samples[0]]


@pytest.mark.parametrize(
    "spoil",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"),
        lambda r: r.replace(b"WARC-Date", b"WARC-Dote"),
        lambda r: r[:-1],
        lambda r: r + b"x",
        lambda r: r.replace(b"payload", b"pAyload"),
        lambda r: r.replace(b"response\r\nWARC-R", b"metadata\r\nWARC-R"),
        lambda r: r.replace(b"Content-Length: 7\r\n", b"Content-Length: 8\r\n"),
        lambda r: r.replace(b"urn:x-page:4", b"urn:x-page:z"),
    ],
)
def test_damage_is_found(spoil):
    whole = warc.record(4, "u", b"payload", warc.base32(hashlib.sha1(b"payload").hexdigest()), None)
    assert warc.parse(whole)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(spoil(whole))


def test_a_cut_archive_is_found():
    frame = zstd.ZstdCompressor().compress(b"x" * 1000)
    for content in (frame[:-3], frame + b"P*", frame + b"P*M\x18\x09\0\0\0", b"nonsense"):
        with pytest.raises(ValueError):
            list(warc.frames_of(content))


def test_no_pages(spark):
    path = new_stage(spark, "warc")
    warc.write_archives(pages(spark, PAGES[:0]), path)
    assert warc.read_archives(spark, path).count() == 0
