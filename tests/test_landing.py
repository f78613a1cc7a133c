import json

import pytest
from pyspark.sql import functions as F

from skyloom.sources import landing

SCHEMA = "pl_name string, pl_masse double"


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        (folder / name.replace("__", ".")).write_text(content, encoding="utf8")
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_json_arrays(spark, tmp_path):
    pretty = '[\n {"pl_name": "a",\n "pl_masse": 1.0},\n {"pl_name": "b", "pl_masse": null}\n]\n'
    path = land(tmp_path / "whole", one__json=pretty, two__json='[{"pl_name": "c"}]')
    expected = [("a", 1.0), ("b", None), ("c", None)]
    assert rows(landing.read_json(spark, path, SCHEMA, whole_file=True)) == expected
    lines = '[{"pl_name":"a","pl_masse":1.0},{"pl_name":"b","pl_masse":null}]\n{"pl_name":"c"}\n'
    assert rows(landing.read_json(spark, land(tmp_path / "l", x__json=lines), SCHEMA)) == expected


def test_bad_json_fails_the_plain_reader(spark, tmp_path):
    path = land(tmp_path / "bad", x__json='ERROR no such table\n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        landing.read_json(spark, path, SCHEMA).collect()


BODIES = [
    '[{"pl_name":"a","pl_masse":1.5},{"pl_name":"b","pl_masse":"heavy"}]',
    ' [{"pl_name":"ERROR bars","pl_masse":2}]',
    "[]",
    '[{"pl_name":"a","pl_masse":1.5},{"pl_na',
    "ERROR no such table",
    "<VOTABLE>wrong</VOTABLE>",
    '{"pl_name":"a"}',
    "17",
    "hello",
    '[null, {"pl_name":"z"}]',
    "[1, 2]",
    None,
]


@pytest.fixture
def parsed(spark):
    df = spark.createDataFrame(list(enumerate(BODIES)), "page int, body string")
    return landing.parse_bodies(df, SCHEMA)


def test_good_and_rejected_bodies(parsed):
    assert parsed.columns == ["page", "pl_name", "pl_masse", landing.REASON, landing.REJECTED]
    good = landing.accepted(parsed)
    assert rows(good) == [(0, "a", 1.5), (1, "ERROR bars", 2.0), (9, "z", None)]
    reasons = {(r.page, r[landing.REASON], r[landing.REJECTED]) for r in landing.rejected(parsed).collect()}
    assert reasons == {
        (0, "bad_value", '{"pl_name":"b","pl_masse":"heavy"}'),
        (3, "not_json", BODIES[3]),
        (4, "service_error", BODIES[4]),
        (5, "service_error", BODIES[5]),
        (6, "not_a_list", BODIES[6]),
        (7, "not_a_list", BODIES[7]),
        (8, "not_json", BODIES[8]),
        (9, "bad_value", "null"),
        (10, "not_a_list", "[1, 2]"),
        (11, "not_json", ""),
    }


def test_nothing_usable_is_an_error(spark, parsed):
    assert landing.require_accepted(parsed).count() == 3
    with pytest.raises(ValueError, match="10 rejected"):
        landing.require_accepted(parsed.where("page between 2 and 8 or _reject_reason is not null"))
    empty = spark.createDataFrame([("[]",)], "body string")
    assert landing.require_accepted(landing.parse_bodies(empty, SCHEMA)).count() == 0


def test_bodies_from_files(spark, tmp_path):
    path = land(tmp_path / "b", one__json='[\n{"pl_name":"a"}]', two__json="ERROR\nmore")
    done = landing.parse_bodies(landing.read_bodies(spark, path, whole_file=True), SCHEMA)
    assert rows(landing.accepted(done)) == [("a", None)]
    assert landing.rejected(done).first()[landing.REJECTED] == "ERROR\nmore"


@pytest.mark.parametrize("reader,sep", [(landing.read_csv, ","), (landing.read_tsv, "\t")])
def test_delimited(spark, tmp_path, reader, sep):
    lines = [
        "name,note,mass",
        '"a, b","say ""hi""",1.50',
        '"two\nlines",,007',
        "short,x",
        "long,x,1,2",
        "back\\slash, blank ,",
    ]
    content = "\n".join(lines).replace(",", sep).replace(f"a{sep} b", f"a{sep} b") + "\n"
    path = land(tmp_path / "d", x__csv=content)
    df = reader(spark, path, multi_line=True)
    assert df.columns == ["name", "note", "mass", landing.CORRUPT]
    assert rows(reader(spark, path, df.columns[:3], multi_line=True)) == rows(df)
    with pytest.raises(Exception, match="(?i)header"):
        reader(spark, path, ["note", "name", "mass"], multi_line=True).collect()
    cells = {r.name: (r.note, r.mass) for r in df.collect()}
    assert cells == {
        f"a{sep} b": ('say "hi"', "1.50"),
        "two\nlines": (None, "007"),
        "short": ("x", None),
        "long": ("x", "1"),
        "back\\slash": (" blank ", None),
    }
    corrupt = {r.name: r[landing.CORRUPT] for r in df.collect() if r[landing.CORRUPT]}
    assert set(corrupt) == {"short", "long"} and corrupt["long"].endswith("2")


VOTABLE = """<?xml version="1.0" encoding="UTF-8"?>
<VOTABLE xmlns="http://www.ivoa.net/xml/VOTable/v1.3"><RESOURCE><TABLE>
<FIELD name="mass" datatype="double" unit="earthMass"><DESCRIPTION> Planet
mass </DESCRIPTION></FIELD>
<FIELD name="note" datatype="char" arraysize="*"/>
<DATA><TABLEDATA>
<TR><TD>1.5</TD><TD>a &amp; b</TD></TR>
<TR><TD/><TD>x</TD></TR>
<TR><TD>2</TD></TR>
</TABLEDATA></DATA></TABLE></RESOURCE></VOTABLE>
"""


def test_votable(spark, tmp_path):
    path = land(tmp_path / "v", x__xml=VOTABLE)
    df = landing.read_votable_rows(spark, path, ["mass", "note"])
    assert rows(df) == sorted([("1.5", "a & b"), (None, "x"), ("2", None)], key=str)
    assert rows(landing.votable_fields(spark, path)) == [
        ("mass", "double", "earthMass", "Planet\nmass"),
        ("note", "char", "", ""),
    ]


def test_one_column_votable(spark, tmp_path):
    path = land(tmp_path / "w", x__xml="<TABLEDATA><TR><TD>7</TD></TR><TR><TD>8</TD></TR></TABLEDATA>")
    assert rows(landing.read_votable_rows(spark, path, ["n"])) == [("7",), ("8",)]


REST_BODIES = [
    '[{"a": "1", "x": "abc", "y": {"z": [1, 2]}, "b.c": null}, {"a": 2}, {"a": 3, "x": 5, "x": 12345678901234567890123}]',
    '[{"a": "no", "x": 1}, null, {"x": "01"}]',
    "[]", "broken", '{"a": 9, "w": true}',
]


def _rest(row):
    return None if row["_rest"] is None else json.loads(row["text"])


def test_keys_outside_the_schema_are_kept(spark):
    df = spark.createDataFrame([(i, body) for i, body in enumerate(REST_BODIES)], "body_id int, body string")
    parsed = landing.parse_bodies(df, "a bigint", rest="_rest").withColumn("text", F.to_json("_rest"))
    good = [r for r in parsed.collect() if r[landing.REASON] is None]
    assert [(r["a"], _rest(r)) for r in good if r["body_id"] == 0] == [
        (1, {"x": "abc", "y": {"z": [1, 2]}, "b.c": None}), (2, None), (3, {"x": 12345678901234567890123}),
    ]
    assert [(r["a"], _rest(r)) for r in good if r["body_id"] == 1] == [(None, {"x": "01"})]
    bad = {(r[landing.REASON], r[landing.REJECTED]) for r in parsed.collect() if r[landing.REASON]}
    assert bad == {("bad_value", '{"a":"no","x":1}'), ("bad_value", "null"), ("not_json", "broken"),
                   ("not_a_list", REST_BODIES[4])}
    plain = landing.parse_bodies(df, "a bigint")
    assert sorted(map(str, plain.select("a", landing.REASON).collect())) == sorted(
        map(str, parsed.select("a", landing.REASON).collect()))


def test_json_with_rest(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": {"c": "d"}}, {"a": 2}]\n\n{"a": 3, "e": [1.5]}\n')
    read = landing.read_json(spark, str(tmp_path / "a.json"), "a int", rest="more")
    assert dict(read.dtypes) == {"a": "int", "more": "variant"}
    read.write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    rows = stored.select("a", F.expr("variant_get(more, '$.b.c', 'string')"), F.to_json("more")).collect()
    assert sorted(map(tuple, rows)) == [(1, "d", '{"b":{"c":"d"}}'), (2, None, None), (3, None, '{"e":[1.5]}')]
    (tmp_path / "b.json").write_text('[{"a": 1,\n "b": 2}, {"a": 4}]')
    whole = landing.read_json(spark, str(tmp_path / "b.json"), "a int", whole_file=True, rest="more")
    assert sorted((r[0], r[1]) for r in whole.select("a", F.to_json("more")).collect()) == [(1, '{"b":2}'), (4, None)]
    (tmp_path / "c.json").write_text('[{"a": "x"}]')
    with pytest.raises(Exception, match="cannot be read: bad_value"):
        landing.read_json(spark, str(tmp_path / "c.json"), "a int", rest="more").collect()
