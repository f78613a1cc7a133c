import math

import __spark_entry__
import numpy as np
import pytest
from conftest import plan_text, settings
from pyspark.sql import functions as F

from skyloom import Catalog
from skyloom.functions import sky
from skyloom.operators import near
from skyloom.operators.near import near_targets
from skyloom.sinks.writers import write_files


def units(ra, dec):
    ra, dec = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(dec) * np.cos(ra), np.cos(dec) * np.sin(ra), np.sin(dec)], -1)


def random_sky(count, seed):
    random = np.random.default_rng(seed)
    ra = random.uniform(0, 360, count)
    dec = np.degrees(np.arcsin(random.uniform(-1, 1, count)))
    # Crowd some points around the poles and the right-ascension origin.
    dec[: count // 8] = random.uniform(88, 90, count // 8)
    dec[count // 8 : count // 4] = random.uniform(-90, -88, count // 8)
    ra[count // 4 : count // 2] = random.uniform(-1.5, 1.5, count // 4) % 360
    return ra, dec


@pytest.fixture(scope="module")
def points():
    return random_sky(8000, 1)


@pytest.fixture(scope="module")
def stars(spark, points):
    ra, dec = points
    rows = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))]
    return spark.createDataFrame(rows, "id int, ra double, dec double").cache()


def found(stars, region):
    return {row.id for row in stars.where(region).select("id").collect()}


@pytest.mark.parametrize(
    "ra0,dec0,radius",
    [(40, 5, 10), (0.2, 0, 3), (359.9, 45, 8), (12, 89.5, 2), (200, -89, 4), (180, 0, 100), (7, 7, 0)],
)
def test_circle(stars, points, ra0, dec0, radius):
    cosine = units(*points) @ units(ra0, dec0)
    expected = set(np.flatnonzero(np.degrees(np.arccos(np.clip(cosine, -1, 1))) <= radius))
    assert found(stars, sky.circle(ra0, dec0, radius)) == expected


def test_circle_edges(spark):
    rows = spark.createDataFrame(
        [(1, 359.95, 0.0), (2, 0.05, 0.0), (3, 180.0, 0.0), (4, None, 0.0), (5, -0.05, 0.0),
         (6, 360.02, 0.0), (7, 0.0, None)],
        "id int, ra double, dec double",
    )
    assert found(rows, sky.circle(0.05, 0, 0.1000001)) == {1, 2, 5, 6}
    assert found(rows, sky.circle(359.99, 0, 0.1)) == {1, 2, 5, 6}
    assert found(rows, sky.circle(0, 0, 180)) == {1, 2, 3, 5, 6}
    assert found(rows, sky.near_object(180, 0)) == {3}
    assert found(rows, sky.circle(720.0, 0, 0.1)) == {1, 2, 5, 6}
    for wrong in ((0, 91, 1), (0, 0, -1), (0, 0, 181), (math.nan, 0, 1)):
        with pytest.raises(ValueError):
            sky.circle(*wrong)


@pytest.mark.parametrize(
    "ra0,dec0,width,height",
    [(40, 5, 20, 20), (0, 0, 10, 4), (358, -60, 30, 12), (77, 89, 6, 6), (10, -90, 5, 9), (90, 0, 150, 20)],
)
def test_box(stars, points, ra0, dec0, width, height):
    """Inside the four great circles through the box sides."""
    a, d = math.radians(ra0), math.radians(dec0)
    ahead = units(ra0, dec0)
    east = np.array([-math.sin(a), math.cos(a), 0])
    north = np.array([-math.sin(d) * math.cos(a), -math.sin(d) * math.sin(a), math.cos(d)])
    inside = np.ones(len(points[0]), bool)
    for axis, size in ((east, width), (north, height)):
        half = math.radians(size) / 2
        for sign in (1, -1):
            normal = math.sin(half) * ahead + sign * math.cos(half) * axis
            inside &= units(*points) @ normal >= 0
    assert found(stars, sky.box(ra0, dec0, width, height)) == set(np.flatnonzero(inside))


def test_box_checks():
    for wrong in ((0, 0, 180, 1), (0, 0, 1, -1), (0, 95, 1, 1)):
        with pytest.raises(ValueError):
            sky.box(*wrong)


CONVEX = [
    [(30, -20), (75, -25), (80, 15), (50, 40), (25, 10)],
    [(350, -10), (15, -12), (8, 20)],
    [(0, 85), (90, 84), (180, 86), (270, 85)],
    [(217, -62), (218, -62), (218, -63), (217, -63)][::-1],
]


@pytest.mark.parametrize("vertices", CONVEX)
@pytest.mark.parametrize("turn", [1, -1])
def test_convex_polygon(stars, points, vertices, turn):
    corners = [units(*v) for v in vertices]
    inside = np.ones(len(points[0]), bool)
    for one, two in zip(corners, corners[1:] + corners[:1]):
        inside &= units(*points) @ np.cross(one, two) > 0
    assert found(stars, sky.polygon(vertices[::turn])) == set(np.flatnonzero(inside))


def test_concave_polygon(stars, points):
    """An L is the union of two convex parts."""
    outline = [(10, 0), (50, 0), (50, 10), (20, 10), (20, 40), (10, 40)]
    parts = [[(10, 0), (50, 0), (50, 10), (20, 10)], [(10, 0), (20, 10), (20, 40), (10, 40)]]
    expected = set()
    for part in parts:
        corners = [units(*v) for v in part]
        inside = np.ones(len(points[0]), bool)
        for one, two in zip(corners, corners[1:] + corners[:1]):
            inside &= units(*points) @ np.cross(one, two) > 0
        expected |= set(np.flatnonzero(inside))
    assert found(stars, sky.polygon(outline)) == expected


def test_polygon_checks():
    with pytest.raises(ValueError):
        sky.polygon([(217, -62), (218, -62)])
    with pytest.raises(ValueError):
        sky.polygon([(0, 0), (120, 0), (240, 0)])
    with pytest.raises(ValueError):
        sky.polygon([(0, -20), (170, -20), (85, 60), (180, 80), (270, -60)])


def test_ranges_reach_the_scan(spark, stars, tmp_path):
    path = str(tmp_path / "stars")
    write_files(stars, path, sky_zone=5)
    stored = spark.read.parquet(path)
    assert stored.count() == stars.count()
    regions = [
        (sky.circle, (40, 5, 2), True),
        (sky.near_object, (0.1, 89.9, 3), False),
        (sky.box, (358, -60, 30, 12), True),
        (sky.polygon, (CONVEX[0],), True),
        (sky.circle, (0, 0, 180), False),
    ]
    for region, arguments, ra_is_bounded in regions:
        plain, zoned = region(*arguments), region(*arguments, zone_height=5)
        plan = plan_text(stored.where(plain))
        assert "GreaterThanOrEqual(dec," in plan
        assert ("GreaterThanOrEqual(ra," in plan) == ra_is_bounded
        pruned = plan_text(stored.where(zoned))
        assert "PartitionFilters: [isnotnull(sky_zone" in pruned
        assert found(stored, zoned) == found(stars, plain)


def test_sql_functions(spark, stars, tmp_path):
    path = str(tmp_path / "stars")
    stars.write.parquet(path)
    catalog = Catalog(spark, {"stars": spark.read.parquet(path)})
    circle = catalog.sql("SELECT id, ra, dec FROM stars WHERE sky_circle(ra, dec, 40D, 20D, 15D)")
    assert "GreaterThanOrEqual(dec,4.99" in plan_text(circle)
    assert {r.id for r in circle.collect()} == found(stars, sky.circle(40, 20, 15))
    box = catalog.sql("SELECT id FROM stars WHERE sky_box(ra, dec, 358D, -60D, 30D, 12D)")
    assert {r.id for r in box.collect()} == found(stars, sky.box(358, -60, 30, 12))
    apart = catalog.sql("SELECT sky_separation(359.95D, 0D, 0.05D, 0D) AS d").first().d
    assert abs(apart - 0.1) < 1e-9


def _corners(vertices):
    return "array(" + ", ".join(f"struct({ra}D, {dec}D)" for ra, dec in vertices) + ")"


def test_sql_functions_push_their_ranges(spark, stars, tmp_path):
    path = str(tmp_path / "stars")
    write_files(stars, path, sky_zone=5)
    catalog = Catalog(spark, {"stars": spark.read.parquet(path)})
    regions = [
        ("sky_circle(ra, dec, 40, 5, 2{})", sky.circle(40, 5, 2), True),
        ("sky_circle(ra, dec, -320.0, 5, 2{})", sky.circle(40, 5, 2), True),
        ("sky_circle(ra, dec, 0.1D, 89.9D, 3D{})", sky.circle(0.1, 89.9, 3), False),
        ("sky_circle(ra, dec, 359, 0, 5{})", sky.circle(359, 0, 5), True),
        ("sky_circle(ra, dec, 1, 0, 5{})", sky.circle(1, 0, 5), True),
        ("sky_circle(ra, dec, 1, 0, 180{})", sky.circle(1, 0, 180), False),
        ("sky_box(ra, dec, 358D, -60D, 30D, 12D{})", sky.box(358, -60, 30, 12), True),
        *((f"sky_polygon(ra, dec, {_corners(v)}{{}})", sky.polygon(v), k != 2) for k, v in enumerate(CONVEX)),
    ]
    for text, region, ra_is_bounded in regions:
        plain = catalog.sql(f"SELECT id FROM stars WHERE {text.format('')}")
        zoned = text.format(", zone => sky_zone_5, zone_height => 5")
        zoned = catalog.sql(f"SELECT id FROM stars WHERE {zoned}")
        plan = plan_text(plain)
        assert "Than" in plan.split("PushedFilters")[1].split("\n")[0]
        assert ("OrEqual(ra," in plan) == ra_is_bounded, text
        assert "sky_zone_5#" in plan_text(zoned).split("PartitionFilters")[1].split("\n")[0]
        expected = found(stars, region)
        assert {r.id for r in plain.collect()} == {r.id for r in zoned.collect()} == expected, text


def test_sql_functions_of_columns(spark, stars):
    catalog = Catalog(spark, {"stars": stars})
    rows = catalog.sql(
        "SELECT id, ra0, sky_circle(ra, dec, ra0, 20D, 15D) AS c, sky_box(ra, dec, ra0, 20D, 9D, 7D) AS b,"
        " sky_polygon(ra, dec, array(named_struct('ra', ra0, 'dec', 10D),"
        " named_struct('ra', ra0 + 9, 'dec', 12D), named_struct('ra', ra0, 'dec', 30D))) AS p"
        " FROM stars CROSS JOIN VALUES (40D), (357D) AS v(ra0)"
    ).collect()
    for ra0 in (40, 357):
        regions = {
            "c": sky.circle(ra0, 20, 15),
            "b": sky.box(ra0, 20, 9, 7),
            "p": sky.polygon([(ra0, 10), (ra0 + 9, 12), (ra0, 30)]),
        }
        for name, region in regions.items():
            assert {r.id for r in rows if r.ra0 == ra0 and r[name]} == found(stars, region)


def test_many_and_concave_corners(spark, stars):
    catalog = Catalog(spark, {"stars": stars})
    outline = [(10, 0), (50, 0), (50, 10), (20, 10), (20, 40), (10, 40)]
    star = [(200 + (30 if k % 2 else 12) * math.cos(k * math.pi / 20), 20 * math.sin(k * math.pi / 20)) for k in range(40)]
    for corners in (outline, star):
        rows = catalog.sql(f"SELECT id FROM stars WHERE sky_polygon(ra, dec, {_corners(corners)})")
        assert {r.id for r in rows.collect()} == found(stars, sky.polygon(corners))
    with pytest.raises(Exception, match="hemisphere"):
        wide = _corners([(0, -20), (170, -20), (85, 60), (180, 80), (270, -60)])
        catalog.sql(f"SELECT id FROM stars WHERE sky_polygon(ra, dec, {wide})").collect()


def test_a_wrong_zone_height_is_an_error(spark, stars, tmp_path):
    path = str(tmp_path / "stars")
    write_files(stars, path, sky_zone=7.5)
    stored = spark.read.parquet(path)
    assert sky.zone_height(stored.columns) == 7.5
    assert sky.zone_height(stars.columns) is None
    right = sky.circle(40, 20, 15, zone_height=sky.zone_height(stored.columns))
    assert found(stored, right) == found(stars, sky.circle(40, 20, 15))
    with pytest.raises(Exception, match="sky_zone_5"):
        stored.where(sky.circle(40, 20, 15, zone_height=5)).count()
    for height in (1e-5, 1 / 3, 5, 1e20):
        assert sky.zone_height([sky.zone_column(height)]) == height
    with pytest.raises(ValueError):
        sky.zone_column(0)


def test_queries_use_the_zones_of_their_table(spark, stars, tmp_path):
    path = str(tmp_path / "stars")
    write_files(stars, path, sky_zone=5)
    catalog = Catalog(spark, {"stars": spark.read.parquet(path)})
    query = catalog.query().select("id").from_table("stars")
    for extend in (
        lambda q: q.where_spatial_circle(40, 20, 15),
        lambda q: q.where_spatial_box(40, 20, 9, 5),
    ):
        df = extend(query).to_df()
        assert "PartitionFilters: [isnotnull(sky_zone_5" in plan_text(df)


def test_zones_are_pruned_and_crowded_positions_spread(spark, tmp_path):
    rows = spark.range(0, 30000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.col("id") % 360).alias("ra"),
        F.when(F.col("id") % 3 == 0, 10.0).otherwise(F.col("id") % 150 - 75).alias("dec"),
    )
    path = str(tmp_path / "rows")
    small = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    with settings(spark, small):
        write_files(rows, path, sky_zone=10)
    stored = spark.read.parquet(path)
    assert stored.count() == 30000
    crowded = stored.where("sky_zone_10 = 10").groupBy("_metadata.file_path").count().collect()
    assert len(crowded) > 1 and max(r["count"] for r in crowded) < 6000


@pytest.mark.parametrize("radius", [0.05, 0.7, 5.0, 33.3, 120.0])
@pytest.mark.parametrize("broadcast_bytes", [10**9, 0])
def test_near_targets(spark, stars, points, radius, broadcast_bytes):
    ra, dec = random_sky(160, 2)
    rows = [(f"t{i}", float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))]
    rows += [("pole", 0.0, 90.0), ("south", 33.0, -90.0), ("none", None, 1.0)]
    targets = spark.createDataFrame(rows, "target_id string, ra double, dec double")
    pairs = near_targets(stars, targets, radius, broadcast_bytes=broadcast_bytes)
    mine = sorted((r.target_id, r.id) for r in pairs.select("target_id", "id").collect())
    expected = []
    for name, a, d in rows:
        if a is not None:
            half_chord = np.linalg.norm(units(*points) - units(a, d), axis=1) / 2
            near = half_chord <= math.sin(math.radians(radius) / 2)
            expected += [(name, int(i)) for i in np.flatnonzero(near)]
    assert mine == sorted(expected)


def test_near_targets_separation_and_columns(spark):
    rows = spark.createDataFrame([(1, 359.95, 0.0), (2, 10.0, 0.0)], "id int, ra double, dec double")
    targets = spark.createDataFrame([(7, 0.05, 0.0)], "t int, ra double, dec double")
    pairs = near_targets(rows, targets, 0.2, target_id="t")
    assert pairs.columns == ["target_id", "id", "ra", "dec", "separation"]
    (pair,) = pairs.collect()
    assert (pair.target_id, pair.id) == (7, 1) and abs(pair.separation - 0.1) < 1e-9
    with pytest.raises(ValueError):
        near_targets(rows, targets, 0, target_id="t")


def test_near_targets_of_a_catalogue_with_the_same_names(spark):
    rows = spark.createDataFrame(
        [(1, "own", 0.5, 10.0, 0.0)], "id int, target_id string, Separation double, ra double, dec double"
    )
    targets = spark.createDataFrame([(7, 10.05, 0.0)], "target_id int, ra double, dec double")
    pairs = near_targets(rows, targets, 0.2)
    assert pairs.columns == ["target_id", "id", "ra", "dec", "separation"]
    assert [p.target_id for p in pairs.collect()] == [7]


@pytest.mark.parametrize("radius", [0.05, 5.0, 33.3, 120.0])
def test_join_rows_are_counted_without_listing_them(spark, radius):
    ra, dec = random_sky(80, 5)
    rows = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))] + [(99, 0.0, 90.0)]
    wanted = spark.createDataFrame(rows, "_target string, _ra0 double, _dec0 double")
    listed = near._in_touched_cells(wanted, radius, radius)
    size = listed.agg(F.sum(F.octet_length("_target") + near.ROW_BYTES)).first()[0]
    assert near._join_bytes(wanted, radius, radius) == size


def test_tiny_radius(spark):
    rows = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.0000004, 20.0)], "id int, ra double, dec double")
    targets = spark.createDataFrame([(7, 10.0, 20.0)], "target_id int, ra double, dec double")
    assert [p.id for p in near_targets(rows, targets, 1e-7).collect()] == [1]
    assert near_targets(rows, targets, 1e-6).count() == 2


def _joins(plan: str) -> set[str]:
    kinds = ("BroadcastHashJoin", "SortMergeJoin", "CartesianProduct", "BroadcastNestedLoopJoin")
    return {kind for kind in kinds if kind in plan}


def test_join_strategies(spark, stars):
    targets = stars.limit(50).withColumnRenamed("id", "target_id")
    assert _joins(plan_text(near_targets(stars, targets, 1.0))) == {"BroadcastHashJoin"}
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_text(near_targets(stars, targets, 1.0, broadcast_bytes=0))
    assert _joins(plan) == {"SortMergeJoin"}


def test_a_crowded_cell_is_split(spark):
    """A third of the rows at one position: same pairs by salts and by the skew join."""
    rows = spark.range(0, 30000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.col("id") % 360).alias("ra"),
        F.when(F.col("id") % 3 == 0, 10.0).otherwise(F.col("id") % 150 - 75).alias("dec"),
    )
    targets = spark.createDataFrame(
        [(1, 50.0, 10.0), (2, 49.9, 10.1), (3, 100.0, -20.0)], "target_id int, ra double, dec double"
    )
    expected = near_targets(rows, targets, 2.0).groupBy("target_id").count().collect()
    assert max(r["count"] for r in expected) >= 10000
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    with settings(spark, small):
        salted = near_targets(rows, targets, 2.0, broadcast_bytes=0, salts=4)
        assert "_salt" in plan_text(salted)
        assert sorted(salted.groupBy("target_id").count().collect()) == sorted(expected)
        adaptive = near_targets(rows, targets, 2.0, broadcast_bytes=0)
        counts = adaptive.groupBy(F.spark_partition_id().alias("p"), "target_id").count().collect()
    totals = {}
    for row in counts:
        totals[row.target_id] = totals.get(row.target_id, 0) + row["count"]
    assert totals == {r.target_id: r["count"] for r in expected}
    assert max(r["count"] for r in counts) < 6000


def test_rounded_angles(spark):
    rng = np.random.default_rng(7)
    angles = [0.0, 180.0, 4.9999995001, 4.9999994999, 1e-7, 5e-324, *rng.uniform(0, 5, 20_000), *rng.uniform(0, 180, 20_000)]
    rows = spark.createDataFrame([(float(a),) for a in angles], "a double")
    found = rows.selectExpr(f"{sky.rounded('a', 6)} AS mine", "round(a, 6) AS theirs").collect()
    assert all(r.mine == r.theirs for r in found)


def test_near_targets_query_rounds_in_doubles(spark):
    plan = plan_text(__spark_entry__.queries()["sky_near_targets"](spark, "/root/testdata/sf0.01"))
    assert "floor(" in plan.lower() and " round(" not in plan.lower()


def test_crowded_targets_are_met_cell_by_cell(spark, stars):
    """Many targets for every row: both sides are dealt out by small cells, however small the targets' table."""
    ra, dec = random_sky(16_000, 3)
    rows = [(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))]
    targets = spark.createDataFrame(rows, "target_id int, ra double, dec double")
    with settings(spark, {"spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        pairs = near_targets(stars, targets, 4.0)
        assert _joins(plan_text(pairs)) == {"SortMergeJoin"}
        few = near_targets(stars, targets.where("target_id < 200"), 4.0)
        assert _joins(plan_text(few)) == {"BroadcastHashJoin"}
        places = stars.where("ra IS NOT NULL AND dec IS NOT NULL").select("id", "ra", "dec").toPandas()
        sky_rows = units(places.ra.to_numpy(), places.dec.to_numpy())
        wanted = np.zeros(16_000, dtype=int)
        for i, place in enumerate(units(np.array(ra), np.array(dec))):
            wanted[i] = (np.linalg.norm(sky_rows - place, axis=1) / 2 <= math.sin(math.radians(4) / 2)).sum()
        found = {r.target_id: r["count"] for r in pairs.groupBy("target_id").count().collect()}
    assert found == {i: n for i, n in enumerate(wanted.tolist()) if n}


@pytest.mark.parametrize("crowd", [0, 1e9])
def test_rows_at_the_radius_are_decided_by_the_region(spark, monkeypatch, crowd):
    """A grid on which many pairs are as far apart as the radius, also with other turns of right ascension."""
    monkeypatch.setattr(near, "CROWD", crowd)
    grid = spark.range(19 * 37).selectExpr(
        "int(id) AS id", "double(id % 37 * 10 - 180) AS ra", "double(id div 37 * 10 - 90) AS dec"
    )
    targets = grid.selectExpr("id AS target_id", "ra + 360 AS ra", "dec")
    for radius in (1e-7, 10.0):
        pairs = near_targets(grid, targets, radius).select("target_id", "id", "separation")
        close = sky.within("g.ra", "g.dec", "t.ra", "t.dec", radius)
        wanted = grid.alias("g").crossJoin(targets.alias("t")).where(close).select(
            "target_id", "id", F.expr(sky.separation("g.ra", "g.dec", "t.ra", "t.dec")).alias("separation")
        )
        key = lambda r: (r.target_id, r.id)
        mine, theirs = sorted(pairs.collect(), key=key), sorted(wanted.collect(), key=key)
        assert list(map(key, mine)) == list(map(key, theirs)) and len(mine) >= 19 * 37
        assert max(abs(a.separation - b.separation) for a, b in zip(mine, theirs)) < 1e-11
