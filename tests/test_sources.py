"""The file inventory and the readers, on folders made here."""

import json

import pytest

from sessionloom.plans import sessions as P
from sessionloom.sources import documents as D
from sessionloom.sources import inventory as I


def box(kind, body=b""):
    return (8 + len(body)).to_bytes(4, "big") + kind + body


@pytest.fixture
def disk(tmp_path):
    top = tmp_path / "disk" / "day"
    for name in ("session_20240102_030405", "session_20240102_040506", ".session_20240102_050607", "other"):
        for sub in ("cameras", "sensors"):
            (top / name / sub).mkdir(parents=True)
    full = top / "session_20240102_030405"
    for p in P.REQUIRED:
        p = full / p
        if p.suffix == ".mp4":
            p.write_bytes(box(b"ftyp", b"isom") + box(b"mdat", b"x" * 50) + box(b"moov"))
        elif p.suffix == ".jsonl":
            p.write_text("".join(json.dumps({"frame_index": k, "capture_timestamp_sec": 100 + k / 30}) + "\n" for k in range(5)))
        else:
            p.write_text('{"a": 1}')
    part = top / "session_20240102_040506"
    (part / "cameras/wall.mp4").write_bytes(b"")
    (part / "cameras/left.jsonl").write_text('{"capture_time": 1000}\n{"capture_time": 1033}\nnot json\n{"capture_time": 1100}\n')
    (part / "notes.txt").write_text("x")
    return tmp_path / "disk"


def test_inventory_lists_empty_files_and_skips_hidden(spark, disk):
    files = I.inventory(spark, [str(disk)])
    got = {(r["session"], r["subdir"], r["name"]): r["size"] for r in files.where("not is_dir").collect()}
    assert {k[0] for k in got} == {"session_20240102_030405", "session_20240102_040506"}
    assert got["session_20240102_040506", "cameras", "wall.mp4"] == 0
    s = {r["session"]: r for r in I.emptiness(I.sessions(files)).collect()}
    assert s["session_20240102_040506"]["empty_files"] == 1 and not s["session_20240102_030405"]["empty"]
    assert I.inventory(spark, [str(disk)], depth=0).count() == 0
    # six levels of folders are searched, so a session is found on the seventh; system and reserved names count in any case
    deep = disk / "1/2/3/4/5/6"
    for path in (deep / "session_20240105_000000", deep / "7/session_20240106_000000", disk / "LOST+FOUND/session_20240107_000000", disk / "Sessions_Quarantine/session_20240108_000000"):
        path.mkdir(parents=True)
        (path / "x").write_text("x")
    found = {r["session"] for r in I.inventory(spark, [str(disk)]).select("session").distinct().collect()}
    assert {"session_20240105_000000", "session_20240108_000000"} <= found and not found & {"session_20240106_000000", "session_20240107_000000"}
    assert I.inventory(spark, [str(disk / "nothing")]).count() == 0


def test_exact_set(spark, disk):
    got = {r["session"]: r for r in P.exact_set(D.file_checks(I.inventory(spark, [str(disk)]).where("not is_dir"))).collect()}
    assert got["session_20240102_030405"]["ok"]
    bad = got["session_20240102_040506"]
    assert "config.json" in bad["missing"] and "cameras/head.mp4" not in bad["missing"]
    assert bad["extra"] == ["notes.txt"] and bad["corrupt"] == ["cameras/head.mp4"] + ([] if "cameras/left.jsonl" not in bad["corrupt"] else ["cameras/left.jsonl"])


def test_streams_until_error(spark, disk):
    path = str(disk / "day/session_20240102_040506/cameras/left.jsonl")
    rows = D.lines(spark, [path])
    assert [r["ts_ms"] for r in D.timestamps_ms(rows).orderBy("lineno").collect()] == [1000.0, 1033.0]
    assert D.timestamps_ms(rows, until_error=False).count() == 0
    good = str(disk / "day/session_20240102_030405/cameras/left.jsonl")
    r = D.first_last(D.timestamps_ms(D.lines(spark, [good]))).first()
    assert r["n"] == 5 and abs(r["t_end"] - r["t_start"] - 4000 / 30) < 1e-6


def test_tolerant_documents(spark):
    rows = spark.createDataFrame([("a", '{"m": {"x": {"v": 1.5}, "y": null, "z": "bad"}}'), ("b", "nope")], "path string, text string")
    got = {r["path"]: r["m"] for r in D.parsed(rows).select("path", D.map_entries_of(D.F.col("doc"), "$.m").alias("m")).collect()}
    assert got["b"] is None and json.loads(got["a"]["x"]) == {"v": 1.5} and got["a"]["z"] == "bad"


def test_video_and_stream_edges(tmp_path):
    ok, cut = tmp_path / "a.mp4", tmp_path / "b.mp4"
    ok.write_bytes(box(b"ftyp") + (1).to_bytes(4, "big") + b"moov" + (16).to_bytes(8, "big"))
    cut.write_bytes(box(b"ftyp") + (99).to_bytes(4, "big") + b"moov")
    # a box that leaves the file ends the walk, which has seen what it needs; without moov, or with a box shorter than its header, it fails
    assert D.mp4_boxes_ok(str(ok)) and D.mp4_boxes_ok(str(cut)) and D.mp4_edges_ok(str(cut))
    assert D.mp4_boxes_ok(ok.as_uri()) and D.mp4_edges_ok(cut.as_uri()) and not D.mp4_boxes_ok((tmp_path / "none.mp4").as_uri())
    for k, data in enumerate((box(b"ftyp") + (99).to_bytes(4, "big") + b"mdat", box(b"ftyp") + box(b"moov") + (7).to_bytes(4, "big") + b"mdat", b"")):
        bad = tmp_path / f"c{k}.mp4"
        bad.write_bytes(data)
        assert not D.mp4_boxes_ok(str(bad))
    for k, (data, want) in enumerate(((b"\n{}\n", False), (b'{"a": "' + b"x" * (1 << 21) + b'"}\n{}\n', True), (b"{}\n{", False), (b"{}", True))):
        lines = tmp_path / f"l{k}.jsonl"
        lines.write_bytes(data)
        assert D.jsonl_edges_ok(str(lines)) == want == D.jsonl_edges_ok(lines.as_uri())
    long = tmp_path / "l.jsonl"
    long.write_text('{"a": 1}\n{"b": "' + "x" * 9000 + '"}\n')
    assert not D.jsonl_edges_ok(str(long))
    assert not D.mp4_boxes_ok(str(tmp_path / "none.mp4"))


def test_disks_and_manifest(spark, tmp_path):
    got = I.disks_of("/a:ssd:one:u1;/b:HDD:two:u2;/c:tape:x:u3;/d:ssd:y;:ssd:z:u4", spark).collect()
    assert [(r["mount"], r["kind"], r["uuid"]) for r in got] == [("/a", "ssd", "u1"), ("/b", "hdd", "u2")]
    p = tmp_path / "names.txt"
    p.write_text("# list\n\n s1 \ns2\ns1\n")
    assert sorted(r["name"] for r in I.manifest(spark, str(p)).collect()) == ["s1", "s2"]
