import base64
import gzip
import hashlib
import json

import pytest
from cohortlens.llm import warc
from cohortlens.session import shared_folder

SCHEMA = "page_id long, url string, html string, size int"


def brute(rows, least_bytes=0):
    heads = {}
    for i, _, h in rows:
        if i is not None:
            heads[h or ""] = min(i, heads.get(h or "", i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        head = heads.get(h or "")
        again = len(data) >= least_bytes and head is not None and i != head
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if again else "response", head if again else None))
    return sorted(out, key=str)


ROWS = [
    (5, "http://a/\r\nX: y", "<p>é\r\n\r\nWARC/1.1\r\n"),
    (3, None, "<p>é\r\n\r\nWARC/1.1\r\n"),
    (1, "u", None),
    (2, "u", ""),
    (7, "u", "z" * 3_000_000),
    (8, "u", "z" * 3_000_000),
    (8, "u", "z" * 3_000_000),
    (None, "u", "z" * 3_000_000),
    (9, "u", "\x00 binary ￿\n"),
]


def test_cases_against_brute_force(frame):
    pages = frame([(*r, 1) for r in ROWS], SCHEMA)
    assert sorted(map(tuple, warc.store_and_read(pages).collect()), key=str) == brute(ROWS)
    assert sorted(map(tuple, warc.store_and_read(pages, 1, 2).collect()), key=str) == brute(ROWS, 1)
    assert warc.store_and_read(pages.limit(0)).count() == 0


def test_members_stand_alone_and_make_up_the_stream(spark, frame):
    from pathlib import Path

    pages = frame([(*r, 1) for r in ROWS], SCHEMA)
    folder = shared_folder(spark)
    warc.write_archives(warc.records(pages), folder + "/a")
    index = warc.normalise(spark, folder + "/a", folder + "/b").collect()
    assert len(index) == len(ROWS)
    before = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(folder, "a").glob("*.gz")))
    members = [Path(r.archive).read_bytes()[r.offset : r.offset + r.length] for r in sorted(index, key=lambda r: (r.archive, r.offset))]
    plain = [gzip.decompress(m) for m in members]
    assert all(p.startswith(b"WARC/1.1\r\n") and p.endswith(b"\r\n\r\n") for p in plain)
    assert b"".join(plain) == before
    assert sum(map(len, members)) == sum(p.stat().st_size for p in Path(folder, "b").glob("*.warc.gz"))


def record(version, fields, block):
    head = [version, *fields, f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def test_fields_of_other_writers_keep_their_bytes(tmp_path):
    given = [
        record("WARC/1.0", ["WARC-Type: warcinfo", "warc-record-ID:<urn:a>", "X-Note: one", "X-Note: Two"], b"software: x\r\n"),
        record("WARC/1.1", ["WARC-Record-ID:  <urn:b> ", "X-Long: begins", "\tgoes on: here", "no colon", "X-Umlaut: \u00e9"], b""),
        record("WARC/1.1", ["WARC-Record-ID: <urn:c>", "WARC-Type: resource"], b"\r\n\r\nWARC/1.0\r\n" * 1000),
    ]
    source, target = tmp_path / "whole.gz", tmp_path / "single.warc.gz"
    source.write_bytes(gzip.compress(b"".join(given)))
    count, size = warc.normalise_one(f"file://{source}", f"file://{target}")
    index = [json.loads(line) for line in (tmp_path / "single.warc.gz.idx.json").read_text().splitlines()]
    data = target.read_bytes()
    assert (count, size) == (3, len(data))
    assert [gzip.decompress(data[i["offset"] : i["offset"] + i["length"]]) for i in index] == given
    assert [i["record"] for i in index] == ["<urn:a>", "<urn:b>", "<urn:c>"]


@pytest.mark.parametrize("broken", [b"HTTP/1.1\r\n", b"WARC/1.1\r\nWARC-Type: x\r\n", record("WARC/1.1", ["WARC-Record-ID: x"], b"abc")[:-6]])
def test_broken_archives_are_refused(tmp_path, broken):
    (tmp_path / "broken.gz").write_bytes(gzip.compress(broken))
    with pytest.raises(ValueError):
        warc.normalise_one(f"file://{tmp_path}/broken.gz", f"file://{tmp_path}/out.warc.gz")
