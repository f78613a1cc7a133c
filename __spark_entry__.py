"""The registered queries, each with the SQL that gives the same result in DuckDB."""

from __future__ import annotations

import importlib
import struct
import sys
import uuid
from collections.abc import Callable
from functools import partial
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sample_views import VIEWS
from skyloom import Catalog, run_spec, vocab
from skyloom.functions import cells, sky
from skyloom.operators import clean
from skyloom.operators.limits import counted_limit
from skyloom.operators.near import near_targets
from skyloom.operators.profile import (
    column_profile, column_sketches, merged_profile, table_profile,
)
from skyloom.operators.query import all_of, open_range
from skyloom.operators.regions import within_polygons
from skyloom.plans import datasets, discoveries
from skyloom.plans.load import Loader
from skyloom.sinks import writers
from skyloom.sinks.versions import VersionedTarget
from skyloom.sources import landing, votable
from skyloom.storage import scratch_path

CATALOG_VIEWS = {"ps": "v_ps", "toi": "v_toi", "cumulative": "v_cumulative", "ml": "v_ml"}

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, text = VIEWS[name]
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return spark.sql(text.replace(f"FROM {table}", "FROM {src}"), src=source)


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, {t: partial(view, spark, sf_dir, v) for t, v in CATALOG_VIEWS.items()})


def with_views(text: str, *names: str) -> str:
    parts = ", ".join(f"{name} AS ({VIEWS[name][1]})" for name in names)
    return f"WITH {parts} {text}"


def register(name: str, oracle: str, *views: str) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        _QUERIES[name] = query
        _ORACLE[name] = with_views(oracle, *views) if views else oracle
        return query

    return keep


def on_catalog(name: str, oracle: str, *views: str):
    """Registers a function of a Catalog."""

    def keep(build: Callable[[Catalog], DataFrame]):
        register(name, oracle, *views)(lambda spark, sf_dir: build(catalog(spark, sf_dir)))
        return build

    return keep


def on_view(name: str, source: str, oracle: str):
    """Registers a function of one view's DataFrame."""

    def keep(build: Callable[[DataFrame], DataFrame]):
        register(name, oracle, source)(lambda spark, sf_dir: build(view(spark, sf_dir, source)))
        return build

    return keep


def entry(spark: SparkSession) -> DataFrame:
    return discoveries.recent_discoveries(catalog(spark, "/root/testdata/sf0.001")).to_df()


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """The queries of the training-corpus subpackage and their SQL; none where it is not installed."""
    try:
        module = importlib.import_module("skyloom.llm.queries")
    except ModuleNotFoundError as error:
        if error.name not in ("skyloom.llm", "skyloom.llm.queries", "corpus_pipeline"):
            raise
        return {}, {}
    return module.QUERIES, module.ORACLE_SQL


def catalogue_queries() -> dict[str, Query]:
    """The queries over the catalogue views; each has its SQL."""
    return dict(_QUERIES)


def queries() -> dict[str, Query]:
    return _QUERIES | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    return _ORACLE | _corpus()[1]


def _list(columns) -> str:
    return ", ".join(columns)


CONFIRMED = "upper(soltype) LIKE '%CONF%'"
CANDIDATE = "upper(soltype) LIKE '%CAND%'"

# ---- scans and projections


@on_catalog("scan_catalog", "SELECT * FROM v_cumulative", "v_cumulative")
def _(c):
    return c.table(vocab.KOI)


@on_catalog("select_columns", "SELECT pl_name, pl_masse FROM v_ps", "v_ps")
def _(c):
    return c.query().select(["pl_name", "pl_masse"]).from_table("ps").to_df()


@on_catalog(
    "qualified_columns",
    "SELECT ps.pl_name, ps.pl_masse FROM v_ps AS ps WHERE ps.pl_masse > 300",
    "v_ps",
)
def _(c):
    query = c.query().select(["ps.pl_name", "ps.pl_masse"]).from_table("ps")
    return query.where("ps.pl_masse > 300").to_df()


@on_catalog(
    "select_expr",
    "SELECT pl_name, pl_masse / CAST(317.8 AS DOUBLE) AS jupiter_masses,"
    " upper(hostname) AS host FROM v_ps",
    "v_ps",
)
def _(c):
    items = ["pl_name", "pl_masse / 317.8D AS jupiter_masses", "upper(hostname) AS host"]
    return c.query().select(items).from_table("ps").to_df()


@on_catalog("select_all", "SELECT * FROM v_toi", "v_toi")
def _(c):
    return c.query().select("*").from_table("toi").to_df()


@on_catalog(
    "distinct_columns", "SELECT DISTINCT discoverymethod, disc_year, soltype FROM v_ps", "v_ps"
)
def _(c):
    return c.query().distinct(["discoverymethod", "disc_year", "soltype"]).from_table("ps").to_df()


# ---- filters


def _planet_filter(name: str, condition: str, build) -> None:
    columns = "pl_name, soltype, default_flag, pl_masse, pl_rade"
    on_catalog(name, f"SELECT {columns} FROM v_ps WHERE {condition}", "v_ps")(
        lambda c: build(c.query().select(columns.split(", ")).from_table("ps")).to_df()
    )


_planet_filter("filter_where", "pl_masse > 200", lambda q: q.where("pl_masse > 200"))
_planet_filter(
    "filter_and",
    "pl_masse > 200 AND pl_masse < 400",
    lambda q: q.where("pl_masse > 200").and_where("pl_masse < 400"),
)
_planet_filter(
    "filter_or",
    "pl_masse > 500 OR (pl_rade < 1 AND default_flag = 1)",
    lambda q: q.where("pl_masse > 500").or_where("pl_rade < 1").and_where("default_flag = 1"),
)
_planet_filter(
    "filter_between",
    "pl_masse >= 200 AND pl_masse <= 400",
    lambda q: q.where_between("pl_masse", 200, 400),
)
_planet_filter(
    "filter_in", "pl_rade IN (1, 2, 3.5)", lambda q: q.where_in("pl_rade", [1.0, 2.0, 3.5])
)
_planet_filter(
    "filter_ilike",
    "soltype ILIKE '%publ%conf%'",
    lambda q: q.where_like("soltype", "%publ%conf%"),
)
_planet_filter(
    "filter_like",
    "soltype LIKE 'Published C%d'",
    lambda q: q.where_like("soltype", "Published C%d", case_insensitive=False),
)
_planet_filter("where_confirmed", CONFIRMED, lambda q: q.where_confirmed())
_planet_filter("where_candidates", CANDIDATE, lambda q: q.where_candidates())
_planet_filter(
    "where_discovery_method",
    "discoverymethod = 'Transit'",
    lambda q: q.where_discovery_method("Transit"),
)
_planet_filter("where_default_flag", "default_flag = 1", lambda q: q.where_default_flag())
_planet_filter("where_has_mass", "pl_masse > 0", lambda q: q.where_has_mass())
_planet_filter("where_has_radius", "pl_rade > 0", lambda q: q.where_has_radius())
_planet_filter("where_earth_sized", "pl_rade <= 1.8", lambda q: q.where_earth_sized())
_planet_filter(
    "filter_dict",
    "discoverymethod IN ('Transit', 'Imaging') AND disc_year = 2018",
    lambda q: q.where_filters({"discoverymethod": ["Transit", "Imaging"], "disc_year": 2018}),
)
_planet_filter(
    "filter_all_of",
    "pl_eqt > 200 AND default_flag = 1",
    lambda q: q.where(all_of("pl_eqt > 200", None, " ", " default_flag = 1")),
)
_planet_filter(
    "filter_open_range",
    "pl_masse >= 300 AND pl_rade <= 2.5",
    lambda q: q.where(open_range("pl_masse", lo=300)).and_where(open_range("pl_rade", hi=2.5)),
)

# ---- sky regions; the SQL side works with unit vectors


def _unit_sql(ra, dec) -> str:
    """x, y, z of a position as SQL."""
    return (
        f"cos(radians({dec})) * cos(radians({ra})) AS x,"
        f" cos(radians({dec})) * sin(radians({ra})) AS y, sin(radians({dec})) AS z"
    )


def _cone_sql(table: str, ra0: float, dec0: float, radius: float) -> str:
    return (
        f"SELECT key, ra, dec FROM {table},"
        f" (SELECT x AS x0, y AS y0, z AS z0 FROM (SELECT {_unit_sql(ra0, dec0)}))"
        " WHERE power(x - x0, 2) + power(y - y0, 2) + power(z - z0, 2)"
        f" <= 4 * power(sin(radians(CAST({radius} AS DOUBLE) / 2)), 2)"
    )


def _vectors_sql(view_name: str, key: str) -> str:
    return f"(SELECT {key} AS key, ra, dec, {_unit_sql('ra', 'dec')} FROM {view_name})"


def _box_sql(table: str, ra0: float, dec0: float, width: float, height: float) -> str:
    a, d = f"radians(CAST({ra0} AS DOUBLE))", f"radians(CAST({dec0} AS DOUBLE))"
    return (
        f"SELECT key, ra, dec FROM (SELECT key, ra, dec,"
        f" x * cos({d}) * cos({a}) + y * cos({d}) * sin({a}) + z * sin({d}) AS ahead,"
        f" y * cos({a}) - x * sin({a}) AS east,"
        f" z * cos({d}) - x * sin({d}) * cos({a}) - y * sin({d}) * sin({a}) AS north"
        f" FROM {table}) WHERE ahead > 0"
        f" AND abs(east / ahead) <= tan(radians(CAST({width} AS DOUBLE) / 2))"
        f" AND abs(north / ahead) <= tan(radians(CAST({height} AS DOUBLE) / 2))"
    )


def _convex_sql(table: str, vertices) -> str:
    """Inside a convex polygon: on the same side of the planes through all its sides."""
    sides = []
    for i, (ra1, dec1) in enumerate(vertices):
        ra2, dec2 = vertices[(i + 1) % len(vertices)]
        (x1, y1, z1), (x2, y2, z2) = (
            (
                f"cos(radians({d})) * cos(radians({r}))",
                f"cos(radians({d})) * sin(radians({r}))",
                f"sin(radians({d}))",
            )
            for r, d in ((ra1, dec1), (ra2, dec2))
        )
        sides.append(
            f"x * ({y1} * {z2} - {z1} * {y2}) + y * ({z1} * {x2} - {x1} * {z2})"
            f" + z * ({x1} * {y2} - {y1} * {x2}) > 0"
        )
    return f"SELECT key, ra, dec FROM {table} WHERE {' AND '.join(sides)}"


PS_VECTORS = _vectors_sql("v_ps", "pl_name")
TOI_VECTORS = _vectors_sql("v_toi", "toi")
# Anticlockwise as seen from inside the sphere's centre looking out: east is to the left.
FIELD = ((30.0, -20.0), (75.0, -25.0), (80.0, 15.0), (50.0, 40.0), (25.0, 10.0))


@on_view("sky_circle", "v_ps", _cone_sql(PS_VECTORS, 217.42896, -62.67947, 12))
def _(df):
    region = sky.circle(217.42896, -62.67947, 12)
    return df.where(region).select(F.col("pl_name").alias("key"), "ra", "dec")


def _stored_zones(df: DataFrame, height: float) -> DataFrame:
    """The rows written by declination zone and read again."""
    path = scratch_path(df.sparkSession, "zones")
    writers.write_files(df, path, sky_zone=height)
    return df.sparkSession.read.parquet(path)


@on_view("sky_circle_stored", "v_ps", _cone_sql(PS_VECTORS, 217.42896, -62.67947, 12))
def _(df):
    stored = _stored_zones(df.select("pl_name", "ra", "dec"), 10)
    region = sky.circle(217.42896, -62.67947, 12, zone_height=sky.zone_height(stored.columns))
    return stored.where(region).select(F.col("pl_name").alias("key"), "ra", "dec")


@on_view("sky_box_stored", "v_toi", _box_sql(TOI_VECTORS, 40, 5, 20, 20))
def _(df):
    stored = Catalog(df.sparkSession, {"toi": _stored_zones(df.select("toi", "ra", "dec"), 7.5)})
    query = stored.query().select(["toi AS key", "ra", "dec"]).from_table("toi")
    return query.where_spatial_box(40, 5, 20, 20).to_df()


@on_catalog("sky_circle_sql", _cone_sql(PS_VECTORS, 217.42896, -62.67947, 12), "v_ps")
def _(c):
    return c.sql(
        "SELECT pl_name AS key, ra, dec FROM ps"
        " WHERE sky_circle(ra, dec, 217.42896D, -62.67947D, 12D)"
    )


@on_catalog("sky_box_sql", _box_sql(TOI_VECTORS, 40, 5, 20, 20), "v_toi")
def _(c):
    return c.sql("SELECT toi AS key, ra, dec FROM toi WHERE sky_box(ra, dec, 40D, 5D, 20D, 20D)")


@on_catalog("sky_polygon_sql", _convex_sql(PS_VECTORS, FIELD), "v_ps")
def _(c):
    corners = ", ".join(f"named_struct('ra', {ra}D, 'dec', {dec}D)" for ra, dec in FIELD)
    return c.sql(
        f"SELECT pl_name AS key, ra, dec FROM ps WHERE sky_polygon(ra, dec, array({corners}))"
    )


@on_view("sky_box", "v_toi", _box_sql(TOI_VECTORS, 40, 5, 20, 20))
def _(df):
    return df.where(sky.box(40, 5, 20, 20)).select(F.col("toi").alias("key"), "ra", "dec")


@on_view("sky_polygon", "v_ps", _convex_sql(PS_VECTORS, FIELD))
def _(df):
    return df.where(sky.polygon(FIELD)).select(F.col("pl_name").alias("key"), "ra", "dec")


POLYGON_SQL = """
    , corners AS (
        SELECT target_id, k, (ra + dra + 360) % 360 AS ra, dec + ddec AS dec
        FROM v_targets, (VALUES (0, -9, -7), (1, 11, -6), (2, 8, 9), (3, -6, 8)) AS o(k, dra, ddec)
        WHERE abs(dec) < 70
    ),
    places AS (
        SELECT *, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y,
            sin(radians(dec)) AS z FROM corners
    ),
    sides AS (
        SELECT a.target_id, a.k, a.y * b.z - a.z * b.y AS nx, a.z * b.x - a.x * b.z AS ny,
            a.x * b.y - a.y * b.x AS nz
        FROM places a JOIN places b ON a.target_id = b.target_id AND b.k = (a.k + 1) % 4
    )
    SELECT CAST(target_id AS BIGINT) AS region_id, key, ra, dec
    FROM (SELECT * FROM {vectors}) v JOIN sides s ON x * nx + y * ny + z * nz > 0
    GROUP BY target_id, key, ra, dec HAVING count(*) = 4
"""


@register("sky_polygon_table", POLYGON_SQL.format(vectors=TOI_VECTORS), "v_targets", "v_toi")
def _(spark, sf_dir):
    """Convex fields around all targets but those near the poles, against all objects of interest."""
    targets = view(spark, sf_dir, "v_targets").where("abs(dec) < 70")
    corners = ", ".join(
        f"struct((ra + {dra} + 360) % 360 AS ra, dec + {ddec} AS dec)"
        for dra, ddec in ((-9, -7), (11, -6), (8, 9), (-6, 8))
    )
    fields = targets.selectExpr("CAST(target_id AS BIGINT) AS region_id", f"array({corners}) AS vertices")
    found = within_polygons(view(spark, sf_dir, "v_toi").select("toi", "ra", "dec"), fields)
    return found.select("region_id", F.col("toi").alias("key"), "ra", "dec")


@on_view("sky_near_object", "v_ps", _cone_sql(PS_VECTORS, 137.50776405, -28.196601125, 0.1))
def _(df):
    region = sky.near_object(137.50776405, -28.196601125)
    return df.where(region).select(F.col("pl_name").alias("key"), "ra", "dec")


@register(
    "sky_near_targets",
    "SELECT target_id, key AS toi,"
    " round(2 * degrees(asin(least(1, sqrt(chord2) / 2))), 6) AS separation"
    " FROM (SELECT target_id, c.key, power(c.x - t.x, 2) + power(c.y - t.y, 2)"
    f" + power(c.z - t.z, 2) AS chord2 FROM {TOI_VECTORS} c,"
    f" (SELECT target_id, {_unit_sql('ra', 'dec')} FROM v_targets) t)"
    " WHERE chord2 <= 4 * power(sin(radians(CAST(2.5 AS DOUBLE))), 2)",
    "v_toi",
    "v_targets",
)
def _(spark, sf_dir):
    rows = view(spark, sf_dir, "v_toi").select("toi", "ra", "dec")
    pairs = near_targets(rows, view(spark, sf_dir, "v_targets"), radius=5)
    return pairs.select("target_id", "toi", F.expr(sky.rounded("separation", 6)).alias("separation"))


@on_catalog("where_sky_circle", _cone_sql(PS_VECTORS, 0.5, 80, 15), "v_ps")
def _(c):
    query = c.query().select(["pl_name AS key", "ra", "dec"]).from_table("ps")
    return query.where_spatial_circle(0.5, 80, 15).to_df()


@on_catalog(
    "where_sky_box",
    _box_sql(_vectors_sql("(SELECT * FROM v_toi WHERE pl_rade > 5)", "toi"), 359, -30, 30, 40),
    "v_toi",
)
def _(c):
    query = c.query().select(["toi AS key", "ra", "dec"]).from_table("toi")
    return query.where_has_radius().and_where("pl_rade > 5").where_spatial_box(
        359, -30, 30, 40
    ).to_df()


# ---- aggregates, order, top-k


@on_catalog("count_all", "SELECT count(*) AS count FROM v_ps", "v_ps")
def _(c):
    return c.query().count().from_table("ps").to_df()


@on_catalog(
    "count_column", "SELECT count(pl_masse) AS count FROM v_ps WHERE default_flag = 1", "v_ps"
)
def _(c):
    return c.query().count("pl_masse").from_table("ps").where("default_flag = 1").to_df()


GROUP_ITEMS = [
    "discoverymethod",
    "disc_year",
    "count(*) AS planets",
    "count(pl_masse) AS with_mass",
    "min(pl_masse) AS least_mass",
    "max(pl_rade) AS largest_radius",
]


@on_catalog(
    "group_agg",
    f"SELECT {_list(GROUP_ITEMS)}, round(avg(sy_dist), 3) AS mean_distance"
    " FROM v_ps GROUP BY discoverymethod, disc_year",
    "v_ps",
)
def _(c):
    items = [*GROUP_ITEMS, "round(avg(sy_dist), 3) AS mean_distance"]
    return c.query().select(items).from_table("ps").group_by(
        ["discoverymethod", "disc_year"]
    ).to_df()


@on_catalog(
    "group_having",
    "SELECT hostname, count(*) AS planets FROM v_ps GROUP BY hostname HAVING count(*) >= 5",
    "v_ps",
)
def _(c):
    query = c.query().select(["hostname", "count(*) AS planets"]).from_table("ps")
    return query.group_by("hostname").having("count(*) >= 5").to_df()


@on_catalog(
    "global_having",
    "SELECT count(*) AS rows, max(disc_year) AS latest FROM v_ps HAVING count(*) > 100",
    "v_ps",
)
def _(c):
    query = c.query().select(["count(*) AS rows", "max(disc_year) AS latest"])
    return query.from_table("ps").having("count(*) > 100").to_df()


@on_catalog(
    "count_records", "SELECT count(*) AS records FROM v_toi WHERE tfopwg_disp = 'PC'", "v_toi"
)
def _(c):
    number = c.count_records("toi", "tfopwg_disp = 'PC'")
    return c.spark.range(1).select(F.lit(number).cast("bigint").alias("records"))


@on_catalog(
    "order_by",
    "SELECT pl_name, pl_masse, disc_year FROM v_ps WHERE default_flag = 1"
    " ORDER BY pl_masse DESC NULLS LAST",
    "v_ps",
)
def _(c):
    query = c.query().select(["pl_name", "pl_masse", "disc_year"]).from_table("ps")
    return query.where("default_flag = 1").order_by("pl_masse", ascending=False).to_df()


@on_catalog(
    "top_k",
    "SELECT kepid, kepoi_name, koi_prad FROM v_cumulative"
    " ORDER BY koi_prad DESC NULLS LAST, kepid, kepoi_name LIMIT 25",
    "v_cumulative",
)
def _(c):
    query = c.query().select(["kepid", "kepoi_name", "koi_prad"]).from_table("cumulative")
    return query.order_by("koi_prad", ascending=False).limit(25).to_df()


@on_catalog(
    "run_spec",
    "SELECT toi, pl_name, pl_rade FROM v_toi WHERE tfopwg_disp IN ('PC', 'CP') AND st_tmag = 5"
    " ORDER BY toi",
    "v_toi",
)
def _(c):
    spec = {
        "table_name": "toi",
        "columns": ["toi", "pl_name", "pl_rade"],
        "filters": {"tfopwg_disp": ["PC", "CP"], "st_tmag": 5.0},
        "order_by": "toi",
    }
    return run_spec(c, spec)


# ---- datasets and composite queries

PLANETS_SQL = f"SELECT {_list(vocab.PLANET_COLUMNS)} FROM v_ps"
SYSTEMS_SQL = f"SELECT DISTINCT {_list(vocab.SYSTEM_COLUMNS)} FROM v_ps WHERE default_flag = 1"
TESS_SQL = f"SELECT {_list(vocab.TESS_COLUMNS)} FROM v_toi"
KEPLER_SQL = f"SELECT {_list(vocab.KEPLER_COLUMNS)} FROM v_cumulative"
ML_SQL = f"SELECT {_list(vocab.MICROLENSING_COLUMNS)} FROM v_ml"
MASS_SQL = f"{PLANETS_SQL} WHERE pl_masse > 0 AND default_flag = 1"
CONFIRMED_SQL = f"{PLANETS_SQL} WHERE {CONFIRMED} AND default_flag = 1"
CANDIDATES_SQL = f"{PLANETS_SQL} WHERE {CANDIDATE}"

on_catalog("confirmed_planets", CONFIRMED_SQL, "v_ps")(datasets.confirmed_planets)
on_catalog(
    "candidate_planets", f"{CANDIDATES_SQL} AND discoverymethod IN ('Transit', 'Imaging')", "v_ps"
)(lambda c: datasets.candidate_planets(c, filters={"discoverymethod": ["Transit", "Imaging"]}))
on_catalog("planets_with_mass", f"{MASS_SQL} AND pl_masse BETWEEN 50 AND 400", "v_ps")(
    lambda c: datasets.planets_with_mass(c, min_mass=50, max_mass=400)
)
on_catalog("systems_overview", SYSTEMS_SQL, "v_ps")(datasets.systems_overview)
on_catalog("tess_candidates", f"{TESS_SQL} WHERE tfopwg_disp = 'FP'", "v_toi")(
    lambda c: datasets.tess_candidates(c, "FP")
)
on_catalog("kepler_objects", f"{KEPLER_SQL} WHERE koi_disposition = 'CONFIRMED'", "v_cumulative")(
    lambda c: datasets.kepler_objects(c, "CONFIRMED")
)
on_catalog("microlensing_events", ML_SQL, "v_ml")(datasets.microlensing_events)


@on_catalog(
    "dataset_groups",
    " UNION ALL ".join(
        f"SELECT '{group}' AS group_name, '{name}' AS dataset, count(*) AS rows FROM ({text})"
        for group, name, text in (
            ("exoplanets", "confirmed_planets", CONFIRMED_SQL),
            ("exoplanets", "candidate_planets", CANDIDATES_SQL),
            ("exoplanets", "planets_with_mass", MASS_SQL),
            ("planetary_systems", "systems_overview", SYSTEMS_SQL),
            ("tess_data", "tess_candidates", TESS_SQL),
            ("kepler_data", "kepler_objects", KEPLER_SQL),
            ("microlensing_data", "microlensing_events", ML_SQL),
        )
    ),
    "v_ps",
    "v_toi",
    "v_cumulative",
    "v_ml",
)
def _(c):
    counts = None
    for group in datasets.GROUPS:
        profile = table_profile(c.spark, datasets.dataset_group(c, group)).select(
            F.lit(group).alias("group_name"), F.col("table_name").alias("dataset"), "rows"
        )
        counts = profile if counts is None else counts.unionByName(profile)
    return counts


on_catalog(
    "recent_discoveries",
    "SELECT pl_name, hostname, discoverymethod, disc_year, sy_dist FROM v_ps"
    f" WHERE {CONFIRMED} ORDER BY disc_year DESC NULLS LAST, pl_name, hostname,"
    " discoverymethod, sy_dist LIMIT 10",
    "v_ps",
)(lambda c: discoveries.recent_discoveries(c).to_df())
on_catalog(
    "nearby_confirmed",
    "SELECT pl_name, hostname, sy_dist, pl_masse, pl_rade FROM v_ps"
    f" WHERE {CONFIRMED} AND sy_dist < 50 AND default_flag = 1 ORDER BY sy_dist",
    "v_ps",
)(lambda c: discoveries.nearby_confirmed(c).to_df())
on_catalog(
    "earth_sized_habitable",
    "SELECT pl_name, hostname, pl_eqt, pl_rade, discoverymethod FROM v_ps"
    f" WHERE {CONFIRMED} AND pl_rade <= 1.5 AND pl_eqt > 200 AND pl_eqt < 400"
    " AND default_flag = 1 ORDER BY pl_eqt",
    "v_ps",
)(lambda c: discoveries.earth_sized_habitable(c).to_df())
on_catalog(
    "recent_transits",
    "SELECT pl_name, hostname, disc_year, pl_orbper FROM v_ps"
    f" WHERE {CONFIRMED} AND discoverymethod = 'Transit' AND disc_year >= 2020"
    " AND default_flag = 1 ORDER BY disc_year DESC",
    "v_ps",
)(lambda c: discoveries.recent_transits(c).to_df())
on_catalog(
    "tess_pc",
    "SELECT toi, pl_name, hostname, pl_rade, tfopwg_disp FROM v_toi"
    " WHERE tfopwg_disp = 'PC' ORDER BY toi",
    "v_toi",
)(lambda c: discoveries.tess_planet_candidates(c).to_df())

# ---- cleaning

NULLS_SQL = (
    "CASE WHEN trim({0}) IN ('', 'null', 'NULL', 'nan', 'NaN', 'N/A', 'n/a', '-', '--')"
    " THEN NULL ELSE {0} END"
)
NUMBER_SQL = r"regexp_full_match(trim({0}), '[+-]?(\d+[.]?\d*|[.]\d+)([eE][+-]?\d+)?')"
METHOD_SQL = (
    "CASE lower({0}) WHEN 'transit' THEN 'transit' WHEN 'radial velocity' THEN 'radial_velocity'"
    " WHEN 'imaging' THEN 'direct_imaging' WHEN 'microlensing' THEN 'microlensing'"
    " WHEN 'eclipse timing variations' THEN 'eclipse_timing'"
    " WHEN 'orbital brightness modulation' THEN 'orbital_brightness' ELSE {0} END"
)
JUPITER = {
    "pl_masse": "pl_masse * (CAST(1 AS DOUBLE) / CAST(317.8 AS DOUBLE)) AS pl_masse",
    "pl_rade": "pl_rade * (CAST(1 AS DOUBLE) / CAST(11.2 AS DOUBLE)) AS pl_rade",
    "discoverymethod": f"{METHOD_SQL.format('discoverymethod')} AS discoverymethod",
    "toi": "CAST(toi AS DOUBLE) AS toi",
}


def _cleaned_sql(columns, source: str) -> str:
    return f"SELECT {_list(JUPITER.get(c, c) for c in columns)} FROM ({source})"


@on_view(
    "normalize_names", "v_toi", "SELECT toi AS toi_id, pl_name AS planet_name, st_tmag FROM v_toi"
)
def _(df):
    messy = {"toi": "TOI  (Id)", "pl_name": "Planet-Name", "st_tmag": "_st__Tmag_"}
    return clean.normalize_names(df.select(*(F.col(c).alias(n) for c, n in messy.items())))


@on_view(
    "slug_values",
    "v_raw",
    r"SELECT event_id, trim(regexp_replace(lower(name_text), '[^\p{L}\p{N}]+', '_', 'g'), '_')"
    r" AS name_slug, trim(regexp_replace(lower(num_text), '[^\p{L}\p{N}]+', '_', 'g'), '_')"
    " AS num_slug FROM v_raw",
)
def _(df):
    return df.select(
        "event_id",
        cells.slug(F.col("name_text")).alias("name_slug"),
        cells.slug(F.col("num_text")).alias("num_slug"),
    )


@on_view(
    "standardize_nulls",
    "v_raw",
    f"SELECT event_id, {NULLS_SQL.format('num_text')} AS num_text, method_text, date_text,"
    " coord_text, name_text FROM v_raw",
)
def _(df):
    return clean.standardize_nulls(df)


@on_view(
    "is_numeric",
    "v_raw",
    f"SELECT event_id, {NUMBER_SQL.format('num_text')} AS num_is_number,"
    f" {NUMBER_SQL.format('coord_text')} AS coord_is_number FROM v_raw",
)
def _(df):
    return df.select(
        "event_id",
        cells.is_number(F.col("num_text")).alias("num_is_number"),
        cells.is_number(F.col("coord_text")).alias("coord_is_number"),
    )


CLEAN_NUMBER_SQL = f"CAST(trim({NULLS_SQL.format('num_text')}) AS DOUBLE)"


@on_view(
    "convert_numeric",
    "v_raw",
    f"SELECT event_id, {CLEAN_NUMBER_SQL} AS num_text, coord_text,"
    " CAST(event_id AS BIGINT) AS id_text FROM v_raw",
)
def _(df):
    text = df.select(
        "event_id", "num_text", "coord_text", F.format_string(" %d ", "event_id").alias("id_text")
    )
    return clean.convert_numeric(clean.standardize_nulls(text))


@on_view(
    "convert_numeric_exact",
    "v_long",
    "SELECT o_orderkey, CAST(source_id AS DECIMAL(20, 0)) AS source_id,"
    " CAST(short_id AS BIGINT) AS short_id, CAST(mixed AS DECIMAL(18, 2)) AS mixed,"
    " CAST(measure AS DOUBLE) AS measure, CAST(fine AS DECIMAL(21, 21)) AS fine, endless FROM v_long",
)
def _(df):
    return clean.convert_numeric(df)


@on_view(
    "convert_numeric_declared",
    "v_long",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(mixed AS DECIMAL(17, 1)) END AS mixed,"
    " CASE WHEN o_orderkey % 3 = 2 THEN mixed END AS mixed_unparsed FROM v_long",
)
def _(df):
    return clean.convert_numeric(df.select("o_orderkey", "mixed"), types={"mixed": "decimal(17,1)"})


@on_view(
    "convert_units",
    "v_ps",
    f"SELECT pl_name, {JUPITER['pl_masse']}, {JUPITER['pl_rade']} FROM v_ps",
)
def _(df):
    df = df.select("pl_name", "pl_masse", "pl_rade")
    for unit in vocab.PLANET_UNITS:
        df = clean.convert_units(df, *unit)
    return df


@on_view(
    "parse_dates",
    "v_raw",
    "SELECT event_id, CASE event_id % 4 WHEN 0 THEN '2015-03-01 00:00:00'"
    " WHEN 1 THEN '2015-03-02 00:00:00' WHEN 2 THEN '2015-03-04 00:00:00' END AS parsed,"
    " CASE WHEN event_id % 4 = 3 THEN date_text END AS date_text_unparsed FROM v_raw",
)
def _(df):
    dates = clean.parse_dates(df.select("event_id", "date_text"), "date_text")
    parsed = F.date_format("date_text", "yyyy-MM-dd HH:mm:ss").alias("parsed")
    return dates.select("event_id", parsed, "date_text_unparsed")


@on_view(
    "parse_dates_full",
    "v_raw",
    "SELECT event_id, CASE WHEN event_id % 5 < 4 THEN make_timestamp(2015, 3, 1 + event_id % 28, 4 + event_id % 20,"
    " 30, 7 + (event_id % 1000) / 1000.0) - to_hours(event_id % 3) END AS stamp,"
    " CASE WHEN event_id % 5 = 4 THEN concat('late ', event_id) END AS stamp_unparsed FROM v_raw",
)
def _(df):
    """Weekdays, fractions of one to six digits and offsets."""
    day = F.lpad((F.lit(1) + F.col("event_id") % 28).cast("string"), 2, "0")
    hour = F.lpad((F.lit(4) + F.col("event_id") % 20).cast("string"), 2, "0")
    thousandths = F.lpad((F.col("event_id") % 1000).cast("string"), 3, "0")
    zeros = F.repeat(F.lit("0"), (F.col("event_id") % 4).cast("int"))
    offset = F.concat(F.lit("+0"), (F.col("event_id") % 3).cast("string"), F.lit(":00"))
    weekday = F.date_format(F.to_date(F.concat(F.lit("2015-03-"), day)), "EEEE")
    text = F.concat(
        weekday, F.lit(", "), day, F.lit(" Mar 2015 "), hour, F.lit(":30:07."), thousandths, zeros,
        F.lit(" "), offset,
    )
    late = F.concat(F.lit("late "), "event_id")
    stamps = df.select("event_id", F.when(F.col("event_id") % 5 < 4, text).otherwise(late).alias("stamp"))
    return clean.parse_dates(stamps, "stamp", "%A, %d %b %Y %H:%M:%S.%f %z")


@on_view(
    "map_categories",
    "v_raw",
    f"SELECT event_id, {METHOD_SQL.format('method_text')} AS method_text FROM v_raw",
)
def _(df):
    df = df.select("event_id", "method_text")
    return clean.map_categories(df, "method_text", vocab.METHOD_SPELLINGS)


@on_view(
    "numeric_coords",
    "v_raw",
    "SELECT event_id, TRY_CAST(coord_text AS DOUBLE) AS ra, CASE WHEN event_id % 3 = 2"
    " THEN coord_text END AS ra_unparsed FROM v_raw",
)
def _(df):
    return clean.numeric_coordinates(df.select("event_id", F.col("coord_text").alias("ra")))


@on_view(
    "format_coords",
    "v_ps",
    "SELECT pl_name, format('{:.6f}', ra) AS ra_text, format('{:.3f}', dec) AS dec_text,"
    " format('{:.4f}', ra * 1000003.7e0) AS wide_text FROM v_ps",
)
def _(df):
    return df.select(
        "pl_name",
        cells.format_coordinate(F.col("ra")).alias("ra_text"),
        cells.format_coordinate(F.col("dec"), 3).alias("dec_text"),
        cells.format_coordinate(F.col("ra") * F.lit(1000003.7), 4).alias("wide_text"),
    )


@on_view(
    "parse_coords",
    "v_raw",
    "SELECT event_id, TRY_CAST(coord_text AS DOUBLE) AS degrees, round(CASE WHEN event_id % 3 = 2"
    " THEN (14 + 29 / 60.0 + 42.95 / 3600.0) * 15 ELSE CAST(coord_text AS DOUBLE) END, 6)"
    " AS any_notation FROM v_raw",
)
def _(df):
    text = F.col("coord_text")
    return df.select(
        "event_id",
        cells.parse_coordinate(text).alias("degrees"),
        F.round(cells.parse_coordinate(text, sexagesimal=True), 6).alias("any_notation"),
    )


@on_view(
    "apply_rules",
    "v_raw",
    "SELECT event_id, trim(num_text) AS num_text, upper(method_text) AS method_text,"
    " CASE WHEN date_text LIKE '%/%' THEN replace(date_text, '/', '.') ELSE date_text END"
    " AS date_text, coord_text, name_text FROM v_raw",
)
def _(df):
    return clean.apply_rules(
        df,
        [
            clean.Rule("*", cells.strip, types=("string",)),
            clean.Rule("method_text", F.upper),
            clean.Rule(
                "date_text",
                lambda c: F.replace(c, F.lit("/"), F.lit(".")),
                condition=lambda c: c.contains("/"),
            ),
        ],
    )


@on_view(
    "apply_batch_rule",
    "v_raw",
    "SELECT event_id, CASE WHEN event_id % 9 = 5 THEN CAST(event_id AS BIGINT) END AS num_text,"
    " CASE WHEN event_id % 9 <> 5 THEN num_text END AS num_text_unparsed,"
    " CASE WHEN event_id % 9 <> 5 THEN 1 ELSE 0 END AS errors FROM v_raw",
)
def _(df):
    """Most cells are no whole numbers; each of them is found by halving its batch."""

    def whole(batch: pa.Array) -> pa.Array:
        return pc.cast(pc.utf8_trim_whitespace(batch), "int64")

    done = clean.apply_rules(df.select("event_id", "num_text"), [clean.batch_rule("num_text", whole, "bigint")])
    return done.select("event_id", "num_text", "num_text_unparsed", F.size("_rule_errors").alias("errors"))


@on_view(
    "apply_python_rule",
    "v_raw",
    "SELECT event_id, upper(replace(name_text, ' ', '_')) AS name_text, 0 AS errors FROM v_raw",
)
def _(df):
    rule = clean.python_rule("name_text", lambda s: s.replace(" ", "_").upper(), "string")
    done = clean.apply_rules(df.select("event_id", "name_text"), [rule])
    return done.select("event_id", "name_text", F.size("_rule_errors").alias("errors"))


@on_view(
    "rule_errors",
    "v_raw",
    "SELECT event_id, CASE WHEN event_id % 9 = 5 THEN CAST(event_id + 1 AS VARCHAR)"
    " ELSE num_text END AS num_text, CASE WHEN event_id % 9 = 5 THEN 0 ELSE 1 END AS errors"
    " FROM v_raw",
)
def _(df):
    rule = clean.python_rule("num_text", lambda s: str(int(s) + 1), "string")
    done = clean.apply_rules(df.select("event_id", "num_text"), [rule])
    return done.select("event_id", "num_text", F.size("_rule_errors").alias("errors"))


@on_view(
    "rule_errors_kept",
    "v_raw",
    "SELECT event_id, CASE WHEN event_id % 9 = 5 THEN CAST(event_id + 1 AS BIGINT)"
    " ELSE NULL END AS num_text, CASE WHEN event_id % 9 = 5 THEN NULL ELSE num_text END"
    " AS num_text_unparsed, CASE WHEN event_id % 9 IN (5, 7) THEN 0 ELSE 1 END"
    " + CASE WHEN event_id % 9 = 5 THEN 0 ELSE 1 END AS errors FROM v_raw",
)
def _(df):
    """Cells that the rule's type cannot hold, cells its condition leaves out, a second pass."""
    number = clean.python_rule(
        "num_text", lambda s: int(s) + 1, "bigint", condition=lambda s: s != "1e3"
    )
    once = clean.apply_rules(df.select("event_id", "num_text"), [number])
    done = clean.apply_rules(once, [clean.python_rule("num_text", lambda n: n + 0, "bigint")])
    return done.select(
        "event_id", "num_text", "num_text_unparsed", F.size("_rule_errors").alias("errors")
    )


@on_view(
    "map_categories_none",
    "v_raw",
    "SELECT event_id, CASE WHEN lower(method_text) = 'transit' THEN NULL"
    " WHEN lower(method_text) = 'imaging' THEN 'direct' ELSE method_text END AS method_text"
    " FROM v_raw",
)
def _(df):
    mapping = {"Transit": None, "Imaging": "direct"}
    return clean.map_categories(df.select("event_id", "method_text"), "method_text", mapping)


@on_view(
    "clean_table",
    "v_raw",
    f"SELECT event_id, {CLEAN_NUMBER_SQL} AS num_text, method_text, date_text, coord_text,"
    " name_text AS planet_name FROM v_raw",
)
def _(df):
    return clean.clean_table(df.withColumnRenamed("name_text", "Planet  NAME"))


@on_view("clean_planets", "v_ps", _cleaned_sql(vocab.PLANET_COLUMNS, "SELECT * FROM v_ps"))
def _(df):
    return clean.clean_planets(df.select(*vocab.PLANET_COLUMNS))


# ---- landed responses: written by Spark from the views, then read


@register("read_json", TESS_SQL, "v_toi")
def _(spark, sf_dir):
    df = view(spark, sf_dir, "v_toi").select(*vocab.TESS_COLUMNS)
    path = scratch_path(spark, "json")
    _pages(df, F.floor(F.col("toipfx") / 500)).select("body").write.text(path)
    return landing.read_json(spark, path, df.schema)


def _pages(df: DataFrame, page) -> DataFrame:
    """Response bodies of a bounded number of rows each, as a service would send them."""
    rows = df.select(page.alias("page"), F.to_json(F.struct("*")).alias("row"))
    body = F.concat(F.lit("["), F.array_join(F.collect_list("row"), ","), F.lit("]"))
    return rows.groupBy("page").agg(body.alias("body"), F.count("*").alias("rows"))


def _delimited(reader, sep: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = view(spark, sf_dir, "v_ml").select(*vocab.MICROLENSING_COLUMNS)
        path = scratch_path(spark, "delimited")
        df.write.option("header", True).option("escape", '"').option("sep", sep).csv(path)
        text = reader(spark, path, df.columns)
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields]
        return text.select(*typed)

    return query


register("read_csv", ML_SQL, "v_ml")(_delimited(landing.read_csv, ","))
register("read_tsv", ML_SQL, "v_ml")(_delimited(landing.read_tsv, "\t"))


@register(
    "read_json_rest",
    "SELECT toi, pl_rade, tic_id % 5 < 3 AS has_rest,"
    " CASE WHEN tic_id % 5 < 3 THEN CAST(tic_id AS BIGINT) END AS tic,"
    " CASE WHEN tic_id % 5 < 3 THEN st_tmag END AS bright,"
    " CASE WHEN tic_id % 5 < 3 AND tic_id % 2 = 0 THEN tfopwg_disp END AS note FROM v_toi",
    "v_toi",
)
def _(spark, sf_dir):
    """Fields outside the schema, some nested and some not there, come back from one VARIANT column."""
    df = view(spark, sf_dir, "v_toi")
    some = F.col("tic_id") % 5 < 3
    star = F.struct(F.col("tic_id").alias("tic"), F.array("st_tmag").alias("bright"))
    note = F.when(some & (F.col("tic_id") % 2 == 0), F.col("tfopwg_disp"))
    path = scratch_path(spark, "rest")
    df.select("toi", "pl_rade", F.when(some, star).alias("star"), note.alias("note")).write.json(path)
    read = landing.read_json(spark, path, "toi string, pl_rade double", rest="_rest")
    return read.select(
        "toi",
        "pl_rade",
        F.col("_rest").isNotNull().alias("has_rest"),
        F.expr("variant_get(_rest, '$.star.tic', 'bigint')").alias("tic"),
        F.expr("variant_get(_rest, '$.star.bright[0]', 'double')").alias("bright"),
        F.expr("variant_get(_rest, '$.note', 'string')").alias("note"),
    )


#: Rows of a landed VOTable file at most, as one task reads a file.
LANDED_ROWS = 50_000


@register("read_votable_rows", KEPLER_SQL, "v_cumulative")
def _(spark, sf_dir):
    df = view(spark, sf_dir, "v_cumulative").select(*vocab.KEPLER_COLUMNS)
    path = scratch_path(spark, "votable")
    cell_texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    rows = df.select(F.array(*cell_texts).alias("TD"))
    landed = rows.write.format("xml").option("rowTag", "TR").option("rootTag", "TABLEDATA")
    landed.option("maxRecordsPerFile", LANDED_ROWS).save(path)
    text = landing.read_votable_rows(spark, path, df.columns)
    return text.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema.fields))


#: Columns of the typed VOTable queries: FIELD attributes, and how a row is packed into a stream.
VOTABLE_FIELDS = (
    ("kepid", 'datatype="long"', "q"),
    ("kepoi_name", 'datatype="char" arraysize="*"', None),
    ("koi_score", 'datatype="double" unit="1"', "d"),
    ("koi_teq", 'datatype="int" unit="K"', "i"),
    ("pair", 'datatype="double" arraysize="2"', "2d"),
)
TYPED_SQL = (
    "SELECT CAST(kepid AS BIGINT) AS kepid, kepoi_name, koi_score, koi_teq,"
    " koi_period AS first, koi_prad AS second FROM v_cumulative"
)


def _votable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Five files for each ``LANDED_ROWS`` rows of an input partition, so none grows with the table.
    stretch = F.floor(F.monotonically_increasing_id() / LANDED_ROWS)
    return view(spark, sf_dir, "v_cumulative").select(
        F.col("kepid").cast("bigint").alias("kepid"), "kepoi_name", "koi_score", "koi_teq",
        F.array("koi_period", F.col("koi_prad").cast("double")).alias("pair"),
        F.concat_ws("-", stretch, F.pmod("kepid", F.lit(5))).alias("file"),
    )


def _typed_votable(rows: DataFrame, data: str, serialization: str) -> DataFrame:
    """Rows with their ``text`` landed as VOTable files and read again by what their fields say."""
    fields = "".join(f'<FIELD name="{name}" {facts}/>' for name, facts, _ in VOTABLE_FIELDS)
    head = f'<VOTABLE xmlns="http://www.ivoa.net/xml/VOTable/v1.3"><RESOURCE><TABLE>{fields}<DATA>'
    body = rows.groupBy("file").agg(F.expr(data).alias("body"))
    path = scratch_path(rows.sparkSession, "votable")
    text = F.concat(F.lit(head), "body", F.lit("</DATA></TABLE></RESOURCE></VOTABLE>"))
    # A file holds one document, however the groups are dealt to the tasks.
    body.select(text).write.option("maxRecordsPerFile", 1).text(path)
    found = votable.read_votable(rows.sparkSession, path, serialization)
    second = F.col("pair")[1]
    return found.select(
        "kepid", "kepoi_name", "koi_score", "koi_teq", F.col("pair")[0].alias("first"), second.alias("second")
    )


@register("read_votable", TYPED_SQL, "v_cumulative")
def _(spark, sf_dir):
    rows = _votable_rows(spark, sf_dir)
    cells_of = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name, _, _ in VOTABLE_FIELDS[:-1]]
    cells_of.append(F.array_join(F.col("pair").cast("array<string>"), " "))
    tds = [F.concat(F.lit("<TD>"), cell, F.lit("</TD>")) for cell in cells_of]
    rows = rows.select("file", F.concat(F.lit("<TR>"), *tds, F.lit("</TR>")).alias("text"))
    data = "concat('<TABLEDATA>', array_join(collect_list(text), ''), '</TABLEDATA>')"
    return _typed_votable(rows, data, "tabledata")


@register("read_votable_binary", TYPED_SQL, "v_cumulative")
def _(spark, sf_dir):
    def packed(batches):
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                flags = sum(1 << 7 - i for i, (name, _, _) in enumerate(VOTABLE_FIELDS) if row[name] is None)
                parts = [bytes([flags])]
                for name, _, code in VOTABLE_FIELDS:
                    if code is None:
                        text = row[name].encode()
                        parts.append(struct.pack(">i", len(text)) + text)
                    else:
                        cell = row[name] if isinstance(row[name], list) else [row[name] or 0]
                        parts.append(struct.pack(f">{code}", *cell))
                rows.append(b"".join(parts).hex())
            yield pa.record_batch([batch["file"], pa.array(rows)], ["file", "text"])

    rows = _votable_rows(spark, sf_dir)
    kind = rows.schema["file"].dataType.simpleString()
    rows = rows.mapInArrow(packed, f"file {kind}, text string")
    stream = "base64(unhex(array_join(collect_list(text), '')))"
    data = f"concat('<BINARY2><STREAM encoding=\"base64\">', {stream}, '</STREAM></BINARY2>')"
    return _typed_votable(rows, data, "binary2")


@register(
    "votable_fields",
    "SELECT concat('c', p_partkey) AS name, p_type AS datatype,"
    " CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '' END AS unit,"
    " CASE WHEN p_size % 3 = 0 THEN '' ELSE p_name END AS description FROM part",
)
def _(spark, sf_dir):
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    fields = part.selectExpr(
        "concat('c', p_partkey) AS _name",
        "p_type AS _datatype",
        "IF(p_size % 2 = 0, p_brand, NULL) AS _unit",
        "IF(p_size % 3 = 0, NULL, p_name) AS DESCRIPTION",
    )
    path = scratch_path(spark, "fields")
    fields.write.format("xml").option("rowTag", "FIELD").option("rootTag", "TABLE").save(path)
    return landing.votable_fields(spark, path)


@register(
    "quarantine_bad",
    "SELECT reason, count(*) AS rows FROM (SELECT CASE WHEN page % 5 = 1 THEN 'service_error'"
    " WHEN page % 5 = 2 THEN 'not_json' WHEN page % 5 = 3 THEN 'not_a_list' ELSE 'good' END"
    " AS reason, page, CASE WHEN page % 5 IN (1, 2, 3) THEN 0 ELSE o_orderkey END AS row_key"
    " FROM (SELECT o_orderkey, o_orderkey // 500 AS page FROM orders)"
    " GROUP BY reason, page, row_key) GROUP BY reason",
)
def _(spark, sf_dir):
    df = view(spark, sf_dir, "v_toi").select("toi", "toipfx", "pl_rade")
    pages = _pages(df, F.floor(F.col("toipfx") / 500))
    kind = F.col("page") % 5
    body = (
        F.when(kind == 1, F.concat(F.lit("ERROR: bad query "), "page"))
        .when(kind == 2, F.col("body").substr(F.lit(1), F.length("body") - 1))
        .when(kind == 3, F.concat(F.lit('{"page": '), "page", F.lit("}")))
        .otherwise(F.col("body"))
    )
    path = scratch_path(spark, "bodies")
    pages.select(body.alias("body")).write.text(path)
    parsed = landing.parse_bodies(landing.read_bodies(spark, path), df.schema)
    reason = F.coalesce(landing.REASON, F.lit("good")).alias("reason")
    return parsed.groupBy(reason).agg(F.count("*").alias("rows"))


# ---- sinks


def _file_sink(file_format: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = view(spark, sf_dir, "v_toi")
        path = scratch_path(spark, file_format)
        writers.write_files(df, path, file_format)
        return writers.read_files(spark, path, df.schema, file_format)

    return query


for _format in writers.FORMATS:
    register(f"sink_{_format}", "SELECT * FROM v_toi", "v_toi")(_file_sink(_format))


def _table_target(spark: SparkSession) -> writers.TableTarget:
    return writers.TableTarget(f"sky_{uuid.uuid4().hex[:12]}", scratch_path(spark, "tables"))


@register("sink_table", "SELECT * FROM v_cumulative", "v_cumulative")
def _(spark, sf_dir):
    target = _table_target(spark)
    target.write(view(spark, sf_dir, "v_cumulative"), "kepler")
    return spark.table(target.location("kepler"))


@register("sink_replace", "SELECT * FROM v_cumulative", "v_cumulative")
def _(spark, sf_dir):
    df = view(spark, sf_dir, "v_cumulative")
    path = scratch_path(spark, "replace")
    writers.write_files(df.unionByName(df), path)
    writers.write_files(df, path)
    return writers.read_files(spark, path, df.schema)


@register("sink_versioned", "SELECT * FROM v_cumulative WHERE koi_prad > 1", "v_cumulative")
def _(spark, sf_dir):
    """A table that is replaced by rows read from itself."""
    target = VersionedTarget(spark, scratch_path(spark, "versions"))
    target.write(view(spark, sf_dir, "v_cumulative"), "koi")
    target.write(target.read("koi").where("koi_prad > 1"), "koi")
    return Catalog(spark, base_path=target.folder).table("koi")


@register(
    "sink_batched", "SELECT count(*) AS rows, true AS within_batch FROM v_toi", "v_toi"
)
def _(spark, sf_dir):
    df = view(spark, sf_dir, "v_toi")
    path = scratch_path(spark, "batched")
    writers.write_files(df, path, batch_size=1000)
    files = (
        writers.read_files(spark, path, df.schema)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.count("*").alias("rows"))
    )
    return files.agg(
        F.sum("rows").alias("rows"), (F.max("rows") <= 1000).alias("within_batch")
    )


@on_view(
    "rows_to_json",
    "v_ps",
    "SELECT CAST(json_object('pl_name', pl_name, 'disc_year', disc_year, 'soltype', soltype)"
    " AS VARCHAR) AS json FROM v_ps",
)
def _(df):
    return writers.rows_to_json(df.select("pl_name", "disc_year", "soltype"))


@on_view(
    "rows_to_csv",
    "v_ps",
    "SELECT concat(pl_name, ',', disc_year, ',', coalesce(soltype, ''), ',\"', hostname, ', \"\"',"
    " discoverymethod, '\"\"\"') AS csv FROM v_ps",
)
def _(df):
    note = F.concat("hostname", F.lit(', "'), "discoverymethod", F.lit('"'))
    return writers.rows_to_csv(df.select("pl_name", "disc_year", "soltype", note.alias("note")))


# ---- loads


def _loader(spark: SparkSession, sf_dir: str) -> Loader:
    return Loader(catalog(spark, sf_dir), writers.FileTarget(scratch_path(spark, "load")))


def _load(name: str, oracle: str, views: tuple[str, ...], run) -> None:
    """Registers a load that returns the rows of its tables."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = None
        for loaded in run(_loader(spark, sf_dir)):
            rows = spark.read.parquet(loaded.location)
            rows = rows.withColumn("loaded_into", F.lit(loaded.table))
            result = rows if result is None else result.unionByName(rows)
        return result

    register(name, oracle, *views)(query)


def _loaded_sql(table: str, columns, source: str) -> str:
    return f"SELECT *, '{table}' AS loaded_into FROM ({_cleaned_sql(columns, source)})"


_load(
    "load_exoplanets",
    _loaded_sql("confirmed_planets", vocab.PLANET_COLUMNS, CONFIRMED_SQL)
    + " UNION ALL "
    + _loaded_sql("candidate_planets", vocab.PLANET_COLUMNS, CANDIDATES_SQL),
    ("v_ps",),
    lambda loader: loader.load_exoplanets(include_candidates=True),
)
_load(
    "load_systems",
    _loaded_sql("systems_overview", vocab.SYSTEM_COLUMNS, SYSTEMS_SQL),
    ("v_ps",),
    lambda loader: loader.load_planetary_systems(),
)
_load(
    "load_tess",
    "SELECT *, CAST(NULL AS VARCHAR) AS toi_unparsed FROM ("
    + _loaded_sql("tess_candidates", vocab.TESS_COLUMNS, TESS_SQL)
    + ")",
    ("v_toi",),
    lambda loader: loader.load_tess_data(),
)
_load(
    "load_kepler",
    _loaded_sql("kepler_objects", vocab.KEPLER_COLUMNS, KEPLER_SQL),
    ("v_cumulative",),
    lambda loader: loader.load_kepler_data(),
)
_load(
    "load_microlensing",
    _loaded_sql("microlensing_events", vocab.MICROLENSING_COLUMNS, ML_SQL),
    ("v_ml",),
    lambda loader: loader.load_microlensing_data(),
)
_load(
    "load_custom",
    _loaded_sql(
        "nearby",
        ("pl_name", "hostname", "sy_dist", "pl_masse", "pl_rade"),
        "SELECT pl_name, hostname, sy_dist, pl_masse, pl_rade FROM v_ps"
        f" WHERE {CONFIRMED} AND sy_dist < 50 AND default_flag = 1"
        " ORDER BY sy_dist, pl_name, hostname, pl_masse NULLS LAST, pl_rade NULLS LAST LIMIT 100",
    ),
    ("v_ps",),
    lambda loader: loader.load_custom_query(
        discoveries.nearby_confirmed(loader.catalog), "nearby", limit=100
    ),
)


@register(
    "load_custom_counted",
    "SELECT least(count(*), 12345) AS rows, least(count(*), 12345) AS known FROM v_ps WHERE pl_rade > 1",
    "v_ps",
)
def _(spark, sf_dir):
    """A limit taken file by file: so many rows come back, and all of them are rows of the table."""
    path = scratch_path(spark, "counted")
    df = view(spark, sf_dir, "v_ps").select("pl_name", "hostname", "pl_rade")
    df.repartition(16, "hostname").write.parquet(path)
    wanted = spark.read.parquet(path).where("pl_rade > 1")
    some = counted_limit(wanted, 12345, gathered=0)
    known = df.where("pl_rade > 1").select("pl_name").distinct().withColumn("known", F.lit(1))
    counts = some.join(known, "pl_name", "left")
    return counts.agg(F.count("*").alias("rows"), F.count("known").alias("known"))


_LOADED_SQL = (
    " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS \"table\", count(*) AS rows FROM ({text})"
        for dataset, name, text in (
            ("exoplanets", "confirmed_planets", CONFIRMED_SQL),
            ("exoplanets", "candidate_planets", CANDIDATES_SQL),
            ("planetary_systems", "systems_overview", SYSTEMS_SQL),
            ("tess", "tess_candidates", TESS_SQL),
            ("kepler", "kepler_objects", KEPLER_SQL),
            ("microlensing", "microlensing_events", ML_SQL),
        )
    )
)


@register("load_all", _LOADED_SQL, *CATALOG_VIEWS.values())
def _(spark, sf_dir):
    summary = _loader(spark, sf_dir).load_all_datasets(include_candidates=True)
    return summary.drop("location")


@register("load_all_versioned", _LOADED_SQL, *CATALOG_VIEWS.values())
def _(spark, sf_dir):
    """All tables replaced at once; their rows are counted as a reader finds them."""
    target = VersionedTarget(spark, scratch_path(spark, "versions"))
    loader = Loader(catalog(spark, sf_dir), target)
    summary = loader.load_all_datasets(include_candidates=True)
    stored = Catalog(spark, base_path=target.folder).list_tables()
    counts = stored.select(F.col("table_name").alias("table"), "rows")
    return summary.select("dataset", "table").join(counts, "table")


@register(
    "load_all_capped",
    " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS \"table\", least(count(*), 700) AS rows"
        f" FROM ({text})"
        for dataset, name, text in (
            ("exoplanets", "confirmed_planets", CONFIRMED_SQL),
            ("exoplanets", "candidate_planets", CANDIDATES_SQL),
            ("planetary_systems", "systems_overview", SYSTEMS_SQL),
            ("tess", "tess_candidates", TESS_SQL),
            ("kepler", "kepler_objects", KEPLER_SQL),
            ("microlensing", "microlensing_events", ML_SQL),
        )
    ),
    "v_ps",
    "v_toi",
    "v_cumulative",
    "v_ml",
)
def _(spark, sf_dir):
    """What was stored under a cap on each dataset, counted in the stored tables."""
    loader = _loader(spark, sf_dir)
    summary = Loader(loader.catalog, loader.target, max_records=700).load_all_datasets(True)
    counts = None
    for row in summary.collect():
        stored = spark.read.parquet(row.location).agg(F.count("*").alias("rows"))
        stored = stored.select(
            F.lit(row.dataset).alias("dataset"), F.lit(row["table"]).alias("table"), "rows"
        )
        counts = stored if counts is None else counts.unionByName(stored)
    return counts


_load(
    "load_custom_sql",
    "SELECT *, 'heavy' AS loaded_into FROM (SELECT pl_name,"
    " pl_masse * (CAST(1 AS DOUBLE) / CAST(317.8 AS DOUBLE)) AS pl_masse FROM v_ps"
    " WHERE pl_masse > 300)",
    ("v_ps",),
    lambda loader: loader.load_custom_query(
        "SELECT pl_name, pl_masse FROM ps WHERE pl_masse > 300", "heavy"
    ),
)

# ---- profiles

PS_TYPES = {
    "pl_name": "string", "hostname": "string", "discoverymethod": "string", "disc_year": "int",
    "soltype": "string", "default_flag": "int", "pl_orbper": "double", "pl_orbsmax": "double",
    "pl_masse": "double", "pl_rade": "double", "pl_eqt": "int", "st_teff": "int",
    "st_rad": "double", "st_mass": "double", "st_met": "double", "sy_dist": "double",
    "sy_snum": "int", "sy_pnum": "int", "sy_mnum": "int", "ra": "double", "dec": "double",
}


@on_view(
    "column_profile",
    "v_ps",
    " UNION ALL ".join(
        f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type,"
        f" count(*) AS rows, count(*) - count({name}) AS nulls FROM v_ps"
        for i, (name, kind) in enumerate(PS_TYPES.items())
    ),
)
def _(df):
    return column_profile(df)


_EXACT_DISTINCT = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, true AS near FROM v_ps HAVING count(*) > 0"
    for name in ("pl_name", "hostname", "discoverymethod", "disc_year", "sy_dist")
)


@on_view(
    "profile_merged",
    "v_ps",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) AS rows, count(*) - count({name}) AS nulls,"
        " true AS near FROM v_ps"
        for name in ("pl_name", "hostname", "pl_masse", "disc_year")
    ),
)
def _(df):
    """Profiles of two loads, stored apart, as one; ``near`` compares with exact numbers."""
    df = df.select("pl_name", "hostname", "pl_masse", "disc_year")
    path = scratch_path(df.sparkSession, "profiles")
    early = F.col("disc_year") < 2018
    for i, load in enumerate((df.where(early), df.where(~early | early.isNull()))):
        column_sketches(load).write.parquet(f"{path}/load={i}")
    merged = merged_profile(df.sparkSession.read.parquet(path), [0.5])
    exact = df.agg(
        *(F.count_distinct(name).alias(f"d_{name}") for name in df.columns),
        F.percentile("pl_masse", [0.45, 0.55]).alias("b_pl_masse"),
        F.percentile("disc_year", [0.45, 0.55]).alias("b_disc_year"),
    ).select(
        F.inline(F.array(*(
            F.struct(
                F.lit(name).alias("column_name"), F.col(f"d_{name}").alias("exact"),
                (F.col(f"b_{name}") if name in ("pl_masse", "disc_year") else F.lit(None).cast("array<double>")).alias("about"),
            )
            for name in df.columns
        )))
    )
    distinct = F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.08 * F.col("exact") + 1
    middle = F.col("quantiles")[0].between(F.col("about")[0], F.col("about")[1])
    near = distinct & F.coalesce(middle, F.col("quantiles").isNull())
    return merged.join(exact, "column_name").select("column_name", "rows", "nulls", near.alias("near"))


@on_view("approx_distinct", "v_ps", _EXACT_DISTINCT)
def _(df):
    """Whether the approximate numbers of distinct values are within a tenth of the exact ones."""
    df = df.select("pl_name", "hostname", "discoverymethod", "disc_year", "sy_dist")
    exact = df.agg(*(F.count_distinct(name).alias(name) for name in df.columns))
    exact = exact.unpivot([], df.columns, "column_name", "exact")
    off = F.abs(F.col("approx_distinct") - F.col("exact"))
    return (
        column_profile(df, approx_distinct=True)
        .join(exact, "column_name")
        .select("column_name", (off <= 1 + F.col("exact") * 0.1).alias("near"))
    )


@register(
    "table_profile_stored",
    "SELECT 'cumulative' AS table_name, 10 AS columns, count(*) AS rows FROM v_cumulative"
    " UNION ALL SELECT 'ml', 10, count(*) FROM v_ml",
    "v_cumulative",
    "v_ml",
)
def _(spark, sf_dir):
    base = scratch_path(spark, "stored")
    for name in ("cumulative", "ml"):
        writers.write_files(view(spark, sf_dir, CATALOG_VIEWS[name]), f"{base}/{name}")
    return Catalog(spark, base_path=base).list_tables()


@register(
    "table_profile",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {columns} AS columns, count(*) AS rows FROM {v}"
        for name, v, columns in (
            ("ps", "v_ps", 21),
            ("toi", "v_toi", 12),
            ("cumulative", "v_cumulative", 10),
            ("ml", "v_ml", 10),
        )
    ),
    "v_ps",
    "v_toi",
    "v_cumulative",
    "v_ml",
)
def _(spark, sf_dir):
    return catalog(spark, sf_dir).list_tables()
