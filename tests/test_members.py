import io
import random
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from tableworks.sources import archives, members


def zipped(content, method=zipfile.ZIP_DEFLATED, streamed=False):
    """``streamed`` writes as to a pipe: sizes follow the data."""
    packed = io.BytesIO()

    class Pipe(io.RawIOBase):
        def writable(self):
            return True

        def write(self, data):
            return packed.write(data)

    with zipfile.ZipFile(Pipe() if streamed else packed, "w", method) as bundle:
        for name, data in content.items():
            bundle.writestr(name, data)
    return packed.getvalue()


def body(number, lines=50):
    dice = random.Random(number)
    return "\n".join(["a|b", *(f"{k}|{dice.random()}é" for k in range(lines))])


def outer(tmp_path, name="2025Q1.zip", count=40, lines=50, **how):
    tables = {}
    for k in range(count):
        inner = zipped({"data.txt": body(k, lines).encode(), "notes.txt": b"not read"}, **how)
        tables[f"plan {k} file PPUF_2025Q1.zip"] = inner
    content = {"readme.txt": b"no archive", "sample x PPUF.zip": b"no archive", **tables}
    (tmp_path / name).write_bytes(zipped(content))
    return tables


@pytest.mark.parametrize("streamed", [False, True])
@pytest.mark.parametrize("method", [zipfile.ZIP_DEFLATED, zipfile.ZIP_STORED])
def test_nested_members(spark, tmp_path, method, streamed):
    if streamed and method == zipfile.ZIP_STORED:
        pytest.skip("a stored member of unknown size has no end to read to")
    outer(tmp_path, method=method, streamed=streamed)
    lines = members.scan_zip_members(spark, str(tmp_path), nested=True, tables=[])
    assert lines.rdd.getNumPartitions() == 40
    found = {}
    for r in lines.orderBy("member", "line_no").collect():
        assert r["header"] == "a|b"
        found.setdefault(r["member"], []).append(r["line"])
    assert found == {f"plan {k} file PPUF_2025Q1.zip": body(k).split("\n") for k in range(40)}


def test_same_lines_as_whole_archives(spark, tmp_path):
    for name in ("2025Q1.zip", "2025Q2.zip"):
        outer(tmp_path, name, 5)
    for nested in (True, False):
        whole = archives.scan_zip_text(spark, str(tmp_path), nested=nested, tables=[] if nested else None)
        own = members.scan_zip_members(spark, str(tmp_path), nested=nested, first=True, tables=[] if nested else None)
        # The first plain member is the text file.
        assert whole.count() == own.count() > 0
        assert whole.drop("archive").exceptAll(own.drop("archive")).isEmpty()
        paths = [{r[0].removeprefix("file:") for r in t.select("archive").distinct().collect()} for t in (whole, own)]
        assert paths[0] == paths[1]


def test_filters_leave_partitions_out(spark, tmp_path):
    outer(tmp_path, "2025Q1.zip", 6)
    outer(tmp_path, "2025Q2.zip", 6)
    chosen = (F.col("member") == "plan 3 file PPUF_2025Q1.zip") & F.col("archive").isin(
        f"{tmp_path}/2025Q1.zip", "other"
    )
    rows = members.scan_zip_members(spark, str(tmp_path), nested=True, tables=[]).where(chosen)
    assert rows.rdd.getNumPartitions() == 12 and rows.count() == 51
    spark.conf.set(members.PUSHDOWN, "true")
    try:
        pushed = members.scan_zip_members(spark, str(tmp_path), nested=True, tables=[]).where(chosen)
        assert pushed.rdd.getNumPartitions() == 1
        assert sorted(map(tuple, pushed.collect())) == sorted(map(tuple, rows.collect()))
    finally:
        spark.conf.unset(members.PUSHDOWN)


class Counted(io.FileIO):
    total = 0

    def readinto(self, buffer):
        size = super().readinto(buffer)
        Counted.total += size
        return size

    def read(self, size=-1):
        data = super().read(size)
        Counted.total += len(data)
        return data


def test_a_task_reads_its_own_bytes(tmp_path, monkeypatch):
    monkeypatch.setattr(members, "_CHUNK", 4096)
    monkeypatch.setattr(archives, "BLOCK", 4096)
    tables = outer(tmp_path, count=20, lines=20_000)
    path = str(tmp_path / "2025Q1.zip")
    whole = (tmp_path / "2025Q1.zip").stat().st_size
    Counted.total = 0
    found = [m for m in members.members_of(path, Counted) if m.name in tables]
    assert len(found) == 20 and Counted.total < 0.05 * whole
    for headers_only, most in ((False, 2 * found[7].packed), (True, 40_000)):
        Counted.total = 0
        with Counted(path) as file:
            stream = members.unpacked(found[7], file, True)
            reading = archives.Reading(True, headers_only=headers_only)
            batches = list(archives.member_batches(path, found[7].name, stream, reading))
        assert sum(b.num_rows for b in batches) == (1 if headers_only else 20_001)
        assert Counted.total <= most and Counted.total < 0.11 * whole


def test_tables_and_headers(spark, tmp_path):
    outer(tmp_path, count=4)
    one = members.scan_zip_members(spark, str(tmp_path / "2025Q1.zip"), nested=True, tables=["plan_2"])
    assert [r["member"] for r in one.select("member").distinct().collect()] == ["plan 2 file PPUF_2025Q1.zip"]
    heads = members.scan_zip_members(spark, str(tmp_path), nested=True, tables=[], headers_only=True)
    assert [r["line"] for r in heads.collect()] == ["a|b"] * 4


def test_every_plain_member(spark, tmp_path):
    content = {"a.csv": "x\n1\n", "folder/": "", "folder/b.csv": "y\r\n\r\n2", "empty.csv": ""}
    (tmp_path / "z.zip").write_bytes(zipped(content))
    lines = members.scan_zip_members(spark, f"file:{tmp_path}")
    assert sorted((r["member"], r["line_no"], r["line"]) for r in lines.collect()) == [
        ("a.csv", 0, "x"), ("a.csv", 1, "1"), ("folder/b.csv", 0, "y"), ("folder/b.csv", 1, "2"),
    ]


def test_folder_without_archives(spark, tmp_path):
    assert members.scan_zip_members(spark, str(tmp_path)).collect() == []


def test_damage_is_an_error(tmp_path):
    tables = outer(tmp_path, count=1, lines=3000)
    (name, inner) = next(iter(tables.items()))
    start = struct.unpack("<2H", inner[26:30])
    broken = bytearray(inner)
    broken[30 + sum(start) + 400] ^= 0xFF
    for bad in (bytes(broken), inner[:900], b"no archive at all, but long enough to hold a header"):
        (tmp_path / "bad.zip").write_bytes(zipped({name: bad}))
        (member,) = members.members_of(str(tmp_path / "bad.zip"))
        with open(tmp_path / "bad.zip", "rb") as file, pytest.raises((zipfile.BadZipFile, members.zlib.error)):
            members.unpacked(member, file, True).read()
