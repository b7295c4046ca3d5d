"""Sources that open files in tasks: CSV by name, archives by member, checksums by block."""

import gzip
import hashlib
import io
import os
import re
import tarfile
import zipfile

import pytest

from weir.operators import archive as A
from weir.sources import archives as R
from weir.sources import csv_by_name as N


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "sub dir").mkdir()
    (tmp_path / "a.csv").write_text("id,name,price\n1,one,1.5\n2,\"t,wo\",2.5\n")
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbfprice,ID,name\r\n3.5,3,three\r\n")
    (tmp_path / "c.csv").write_bytes("id,name,note\n4,café,latin\n".encode("latin-1"))
    (tmp_path / "sub dir" / "d [1].csv").write_bytes("name;x\n".encode())  # another separator: one column of its own
    (tmp_path / "e.csv").write_bytes(gzip.compress(b"nothing"))
    (tmp_path / "e.csv").unlink()
    (tmp_path / "e.csv.gz").write_bytes(gzip.compress(b"\n\nname,id\nf\xc3\xbcnf,5\n"))
    (tmp_path / "f.csv").write_bytes("name,id\nsechs,6\n".encode("utf-16"))
    (tmp_path / "g.csv").write_bytes(b"")
    (tmp_path / "h.csv").write_text("id,name\nseven,bad\n8,short,long\n9\n10,good\n")
    df = N.read_csv_by_name(spark, str(tmp_path), "id long, name string, price double, absent date")
    assert df.columns == ["id", "name", "price", "absent", "note", "name;x", "_corrupt_record"]
    good = df.where("_corrupt_record is null")
    assert rows(good.select("id", "name", "price", "note")) == sorted([(1, "one", 1.5, None), (2, "t,wo", 2.5, None), (3, "three", 3.5, None), (4, "café", None, "latin"), (5, "fünf", None, None), (6, "sechs", None, None), (10, "good", None, None)], key=str)
    assert rows(df.where("_corrupt_record is not null").select("_corrupt_record")) == [("8,short,long",), ("9",), ("seven,bad",)]
    assert df.where("_corrupt_record is not null").count() == 3  # whatever columns are asked for
    index = {r.path.rpartition("/")[2]: (r.encoding, r.bom) for r in N.header_index(spark, str(tmp_path)).collect()}
    assert index["b.csv"] == ("UTF-8", True) and index["c.csv"] == ("ISO-8859-1", False) and index["f.csv"] == ("UTF-16LE", True) and index["a.csv"] == ("UTF-8", False) and "g.csv" not in index
    assert N.read_csv_by_name(spark, str(tmp_path), "id long", extra=False).columns == ["id", "_corrupt_record"]
    assert dict(N.read_csv_by_name(spark, str(tmp_path / "a.csv")).dtypes)["id"] == "string"


def test_csv_headers_with_empty_repeated_and_long_names(spark, tmp_path):
    wide = [f"column_{k}_{'x' * 100}" for k in range(1200)]  # over one chunk
    (tmp_path / "a.csv").write_text(",".join(["a", "", "A", *wide]) + "\n" + ",".join(["1", "2", "3", *["w"] * 1200]) + "\n")
    df = N.read_csv_by_name(spark, str(tmp_path))
    assert df.columns[:3] == ["a0", "_c1", "A2"] and len(df.columns) == 1204 and df.where("_corrupt_record is null").count() == 1


def test_csv_is_repaired(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(b"\xef\xbb\xbfid,name\n1,\xc3\xa9\nx,bad\n")
    (tmp_path / "in" / "b.csv").write_bytes(b"name,id\n\xe9,2\n")
    N.repair_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), "id long, name string", bad=str(tmp_path / "bad"))
    text = b"".join(p.read_bytes() for p in (tmp_path / "out").glob("*.csv"))
    assert b"\xef\xbb\xbf" not in text and rows(spark.read.csv(str(tmp_path / "out"), header=True)) == [("1", "é"), ("2", "é")]
    assert rows(spark.read.text(str(tmp_path / "bad"))) == [("x,bad",)]


def index_of(spark, path, pattern="*"):
    return R.archive_index(spark, str(path), pattern)


def test_members_are_read_by_their_own_ranges(spark, tmp_path):
    long = b"".join(b"%d,\xc3\xa9\r\n" % k for k in range(300_000))
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("d/", b"")
        z.writestr("d/long.csv", b"\xef\xbb\xbfid,v\n" + long, zipfile.ZIP_DEFLATED)
        z.writestr("d/stored.csv", b"id,v\n1,x", zipfile.ZIP_STORED)
        z.writestr("d/bz.csv", b"id,v\n2,y\n", zipfile.ZIP_BZIP2)
        z.writestr("d/empty.csv", b"")
        z.writestr("note.md", b"no")
    for name, mode in (("b.tar", "w"), ("c.tgz", "w:gz"), ("d.tar.xz", "w:xz")):
        with tarfile.open(tmp_path / name, mode) as t:
            for member, data in (("d/1.csv", b"id,v\n3,z\n"), ("d/2.csv", long), ("note.md", b"no")):
                info = tarfile.TarInfo(member)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    index = index_of(spark, tmp_path, "d/*.csv")
    assert sorted((r.kind, r.member) for r in index.collect() if r.kind != "stream") == [("tar", "d/1.csv"), ("tar", "d/2.csv"), *(("zip", f"d/{n}.csv") for n in ("bz", "empty", "long", "stored"))]
    parts = {}
    for r in R.member_parts(index, "d/*.csv", part=1 << 20).orderBy("archive", "member", "part").collect():
        at = (r.archive.rpartition("/")[2], r.member)
        assert len(r.content) <= 1 << 20 and r.part == len(parts.setdefault(at, []))
        parts[at].append(bytes(r.content))
    whole = {k: b"".join(v) for k, v in parts.items()}
    assert whole["a.zip", "d/long.csv"] == b"\xef\xbb\xbfid,v\n" + long and whole["a.zip", "d/empty.csv"] == b"" and len(whole) == 10
    assert all(whole[n, "d/2.csv"] == long and whole[n, "d/1.csv"] == b"id,v\n3,z\n" for n in ("b.tar", "c.tgz", "d.tar.xz"))
    lines = R.member_lines(index, "d/*.csv")
    assert rows(R.member_rows(lines.where("member rlike 'stored|bz|1'"), "id long, v string").select("id", "v")) == [(1, "x"), (2, "y"), (3, "z"), (3, "z"), (3, "z")]
    assert R.member_rows(lines.where("member = 'd/long.csv'"), "id long, v string").where("v = 'é'").count() == 300_000


def test_one_member_of_an_archive_of_more_than_two_gigabytes(spark, tmp_path):
    with (tmp_path / "large.zip").open("wb") as f:
        f.seek(5 << 29)  # a hole, which takes no disk
        with zipfile.ZipFile(f, "w") as z:
            z.writestr("x.csv", "id\n7\n")
    with (tmp_path / "large.tar").open("wb") as f:
        info = tarfile.TarInfo("hole.bin")
        info.size = 5 << 29
        f.write(info.tobuf())
        f.seek(info.size, 1)
        with tarfile.open(fileobj=f, mode="w|") as t:
            info = tarfile.TarInfo("x.csv")
            info.size = 5
            t.addfile(info, io.BytesIO(b"id\n8\n"))
    index = index_of(spark, tmp_path)
    assert index.where("size > 2000000000").count() == 1
    assert rows(R.member_rows(R.member_lines(index.where("member = 'x.csv'")), "id long").select("id")) == [(7,), (8,)]


def test_damaged_and_locked_members_are_errors(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x", b"content")
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[data.index(b"content")] ^= 1
    (tmp_path / "a.zip").write_bytes(data)
    with pytest.raises(Exception, match="check sum"):
        R.member_parts(index_of(spark, tmp_path)).collect()


def test_checksums_by_file_and_by_block(spark, tmp_path):
    data = bytes(range(256)) * 40
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a b.bin").write_bytes(data)
    (tmp_path / "in" / "c.bin").write_bytes(data[:1000])
    got = {r.path.rpartition("/")[2]: (r.size, r.md5) for r in A.file_checksums(spark, str(tmp_path / "in"), "*.bin").collect()}
    assert got == {"a b.bin": (len(data), hashlib.md5(data).hexdigest()), "c.bin": (1000, hashlib.md5(data[:1000]).hexdigest())}
    tree = lambda d: hashlib.md5(b"".join(hashlib.md5(d[k : k + 1000]).digest() for k in range(0, len(d), 1000))).hexdigest()
    got = {r.path.rpartition("/")[2]: (r.blocks, r.checksum) for r in A.block_checksums(spark, str(tmp_path / "in"), block=1000).collect()}
    assert got == {"a b.bin": (11, f"{tree(data)}-11"), "c.bin": (1, f"{tree(data[:1000])}-1")}


def test_small_blocks_share_tasks(spark, tmp_path):
    data = {"a": os.urandom(100_001), "b": b"x" * 10, "c": b""}
    (tmp_path / "in").mkdir()
    for name, content in data.items():
        (tmp_path / "in" / name).write_bytes(content)
    df = A.block_checksums(spark, str(tmp_path / "in"), block=10)
    assert all(int(n) <= 8 for n in re.findall(r"hashpartitioning\(path[^)]*, ([0-9]+)\)", df._jdf.queryExecution().toString()))
    md5 = lambda x: hashlib.md5(x).digest()
    want = {n: f"{md5(b''.join(md5(x[k : k + 10]) for k in range(0, len(x), 10))).hex()}-{-(-len(x) // 10)}" for n, x in data.items() if x}
    assert {r.path.rpartition("/")[2]: r.checksum for r in df.collect()} == want
