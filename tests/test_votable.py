import base64
import struct

import pytest
from conftest import settings
from pyspark.sql import functions as F

import __spark_entry__
from __spark_entry__ import _QUERIES, view
from skyloom.sources import votable
from skyloom.storage import scratch_path

HEAD = """<?xml version="1.0"?><VOTABLE xmlns="http://www.ivoa.net/xml/VOTable/v1.3"><RESOURCE><TABLE>
<FIELD name="id" datatype="long"><VALUES null="-99"/></FIELD>
<FIELD name="mass" datatype="double" unit="earthMass" ucd="phys.mass"><DESCRIPTION> Planet mass </DESCRIPTION></FIELD>
<FIELD name="flag" datatype="boolean"/>
<FIELD name="note" datatype="char" arraysize="*"/>
<FIELD name="wide" datatype="unicodeChar" arraysize="4"/>
<FIELD name="pos" datatype="float" arraysize="2"/>
<FIELD name="many" datatype="short" arraysize="*"/>
<FIELD name="byte" datatype="unsignedByte"/>
<DATA>"""
TAIL = "</DATA></TABLE></RESOURCE></VOTABLE>"
ROWS = [
    (2**62 + 1, 1.5, True, "a & b", "日本", [1.5, -2.0], [1, 2, 3], 255),
    (None, None, None, None, None, None, None, None),
    (-7, float("inf"), False, "x", "éü", [0.0, 0.25], [], 0),
]


def text_row(row):
    def cell(value):
        if value is None:
            return ""
        if isinstance(value, list):
            return " ".join(map(str, value))
        return {True: "T", False: "false"}.get(value, str(value)) if isinstance(value, bool) else str(value)

    cells = [cell(v).replace("&", "&amp;").replace("inf", "+Inf") for v in row]
    return "<TR>" + "".join(f"<TD>{c}</TD>" if c else "<TD/>" for c in cells) + "</TR>"


def packed_row(row, flags):
    i, mass, flag, note, wide, pos, many, byte = row
    note, many = (note or "").encode(), many or []
    data = struct.pack(">qd", -99 if i is None else i, float("nan") if mass is None else mass)
    data += {True: b"T", False: b"F", None: b"?"}[flag] + struct.pack(">i", len(note)) + note
    data += (wide or "").encode("utf-16-be").ljust(8, b"\0") + struct.pack(">2f", *(pos or [0, 0]))
    data += struct.pack(f">i{len(many)}h", len(many), *many) + bytes([byte or 0])
    bits = sum(1 << 7 - k for k, v in enumerate(row) if v is None)
    return (bytes([bits]) if flags else b"") + data


def land(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEAD + content + TAIL, encoding="utf8")
    return str(folder)


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_text_and_streams_give_the_same_rows(spark, tmp_path):
    text = "<TABLEDATA>" + "\n".join(map(text_row, ROWS)) + "</TABLEDATA>"
    typed = votable.read_votable(spark, land(tmp_path / "t", "a.xml", text))
    assert dict(typed.dtypes) == {
        "id": "bigint", "mass": "double", "flag": "boolean", "note": "string", "wide": "string",
        "pos": "array<float>", "many": "array<smallint>", "byte": "smallint",
    }
    assert typed.schema["mass"].metadata == {
        "unit": "earthMass", "description": "Planet mass", "ucd": "phys.mass"
    }
    wanted = [ROWS[0], ROWS[1], (*ROWS[2][:6], None, 0)]  # an empty cell is no empty array
    assert rows(typed) == sorted(map(str, wanted))
    data = base64.encodebytes(b"".join(packed_row(r, True) for r in ROWS)).decode()
    path = land(tmp_path / "b", "a.xml", f'<BINARY2><STREAM encoding="base64">{data}</STREAM></BINARY2>')
    streamed = votable.read_votable(spark, path, "binary2")
    assert streamed.dtypes == typed.dtypes
    assert streamed.schema["mass"].metadata == typed.schema["mass"].metadata
    assert rows(streamed) == sorted(map(str, ROWS))


def test_streams_without_flags(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(votable, "STREAM_ROWS", 2)
    data = base64.b64encode(b"".join(packed_row(r, False) for r in ROWS)).decode()
    path = land(tmp_path / "b", "a.xml", f"<BINARY><STREAM encoding='base64'>{data}</STREAM></BINARY>")
    land(tmp_path / "b", "b.xml", "<BINARY><STREAM encoding='base64'></STREAM></BINARY>")
    found = {r["byte"]: r for r in votable.read_votable(spark, path, "binary").where("id IS NOT NULL").collect()}
    assert tuple(found[255]) == ROWS[0] and tuple(found[0]) == ROWS[2]
    missing = votable.read_votable(spark, path, "binary").where("id IS NULL").collect()
    assert len(missing) == 1 and missing[0]["flag"] is None and missing[0]["note"] is None


def test_what_does_not_fit_fails(spark, tmp_path):
    cells_of = "<TD>x</TD>" + "<TD/>" * 7
    path = land(tmp_path / "t", "a.xml", f"<TABLEDATA><TR>{cells_of}</TR></TABLEDATA>")
    with pytest.raises(Exception, match="field id holds no long: x"):
        votable.read_votable(spark, path).collect()
    cells_of = "<TD/>" * 5 + "<TD>1 y</TD>" + "<TD/>" * 2
    path = land(tmp_path / "u", "a.xml", f"<TABLEDATA><TR>{cells_of}</TR></TABLEDATA>")
    with pytest.raises(Exception, match="field pos holds no float: 1 y"):
        votable.read_votable(spark, path).collect()
    short = base64.b64encode(packed_row(ROWS[0], True)[:-3]).decode()
    path = land(tmp_path / "s", "a.xml", f'<BINARY2><STREAM encoding="base64">{short}</STREAM></BINARY2>')
    with pytest.raises(Exception, match="the stream ends within"):
        votable.read_votable(spark, path, "binary2").collect()


def test_fields_must_agree(spark, tmp_path):
    path = land(tmp_path / "t", "a.xml", "<TABLEDATA></TABLEDATA>")
    assert votable.read_votable(spark, path).count() == 0
    other = HEAD.replace("earthMass", "solMass")
    (tmp_path / "t" / "b.xml").write_text(other + "<TABLEDATA></TABLEDATA>" + TAIL, encoding="utf8")
    with pytest.raises(ValueError, match="different fields"):
        votable.read_votable(spark, path)
    with pytest.raises(ValueError, match="unknown serialization"):
        votable.read_votable(spark, str(tmp_path / "t" / "a.xml"), "fits")
    (tmp_path / "none.xml").write_text("<VOTABLE></VOTABLE>")
    with pytest.raises(ValueError, match="no fields"):
        votable.read_votable(spark, str(tmp_path / "none.xml"))


def test_sizes_of_cells():
    field = lambda size, kind="int": votable._field("f", kind, size, None, "", "", "")
    assert (field(None).size, field(None).type) == (1, "int")
    assert (field("2x3").size, field("2x3").type) == (6, "array<int>")
    assert field("2x*").size is None and field("7*").size is None
    assert field("2x*", "char").type == "string"
    assert field(None, "doubleComplex").type == "array<double>"
    with pytest.raises(ValueError, match="bit"):
        field(None, "bit")


@pytest.mark.parametrize("name", ["read_votable", "read_votable_binary"])
def test_query_over_several_shuffle_partitions(spark, tmp_path, name):
    """The files of several tasks: one document each, else the fields of two run together."""
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    part.repartition(3).write.parquet(str(tmp_path / "part.parquet"))
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        found = _QUERIES[name](spark, str(tmp_path))
        wanted = view(spark, str(tmp_path), "v_cumulative")
        assert found.count() == part.count()
        kept = wanted.selectExpr("kepid", "kepoi_name", "koi_score", "koi_teq", "koi_period", "koi_prad")
        assert found.exceptAll(kept).isEmpty()


@pytest.mark.parametrize("name", ["read_votable_rows", "read_votable", "read_votable_binary"])
def test_landed_files_do_not_grow_with_the_table(spark, monkeypatch, name):
    monkeypatch.setattr(__spark_entry__, "LANDED_ROWS", 50)
    folders = []
    path = lambda *args: folders.append(scratch_path(*args)) or folders[-1]
    monkeypatch.setattr(__spark_entry__, "scratch_path", path)
    found = _QUERIES[name](spark, "/root/testdata/sf0.001").count()
    files = spark.read.text(folders[0], wholetext=True)
    sizes = [r[0] for r in files.select(F.length("value")).collect()]
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()
    assert found == part and len(sizes) >= part / 50 and max(sizes) < 50 * 400
