import base64
import hashlib
import random

import zstandard
from pyarrow import fs

from terminus.llm import warc


def brute(rows):
    first = {}
    for p, _, h in rows:
        first[h or ""] = min(first.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        raw = (h or "").encode()
        f = first[h or ""]
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if f == p else "revisit", None if f == p else f))
    return sorted(out)


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 2000)
    rng = random.Random(1)
    rows = [(i, f"http://a/{i}\r\nX: y", "".join(rng.choice("ab é\r\n\0") for _ in range(rng.randint(0, 900)))) for i in range(150)]
    rows += [(200, None, None), (201, "u", ""), (202, "u", None), (203, "u", rows[7][2]), (3000, "u", rows[7][2]), (204, "u", "long " * 5000)]
    rng.shuffle(rows)
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    folder, index = warc.write(pages)
    assert sorted(map(tuple, warc.read(folder, index).collect())) == brute(rows)
    found = {r.page_id: r.asDict() for r in index.collect()}
    html = {p: (h or "").encode() for p, _, h in rows}
    refers = {r[0]: r[4] for r in brute(rows)}
    for p, where in found.items():
        head, block = warc.fetch(folder, where)
        assert head["WARC-Record-ID"] == where["record_id"]
        assert block.split(b"\r\n\r\n", 1)[1] == (html[p] if refers[p] is None else b"")
    there, root = fs.FileSystem.from_uri(folder)
    whole = [f for f in there.get_file_info(fs.FileSelector(root)) if not f.base_name.endswith(".crc")]
    assert {f.base_name for f in whole} == {r["bundle"] for r in found.values()}
    raw = there.open_input_file(whole[0].path).read()
    plain = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1\r\n")


def test_edges(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (1, "u", "x"), (None, "u", "x"), (None, None, None)], "page_id long, url string, html string")
    got = sorted(map(tuple, warc.archive(pages).collect()), key=str)
    assert len(got) == 4 and sorted((r[3], r[4]) for r in got if r[0] == 1) == [("response", None), ("revisit", 1)]
    assert [r[3] for r in got if r[0] is None and r[1] == 0] == ["response"]
    assert warc.archive(pages.limit(0)).count() == 0
