"""Sky regions as Spark SQL predicates.

Every function returns the text of a boolean (or double) SQL expression over angles in
degrees, so the same region goes into ``df.where``, ``F.expr``, ``spark.sql`` and
``CatalogQuery.where``. Only built-in functions are used.

Trigonometry cannot be pushed to a file scan. Each region therefore starts with plain
ranges on the stored ``dec`` and ``ra`` columns which enclose it: Parquet skips row groups
by them and most rows never reach the exact test. The ranges never decide a row.

Tables written with ``sky_zone`` are partitioned by declination zone, in a column whose name holds
the zones' height. Given that height as ``zone_height`` (``zone_height(df.columns)`` reads it off),
a region also names the zones it touches, and Spark opens their folders only. With another height
the column is not there, which is an error instead of missing rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession

# The partition column of tables that are laid out by declination zone is named after this and
# the height, with letters for the signs of a number.
ZONE = "sky_zone_"
SIGNS = str.maketrans({".": "p", "-": "m", "+": "t"})
LETTERS = str.maketrans({"p": ".", "m": "-", "t": "+"})

# Widens the enclosing ranges, so that rounding cannot cut off a point on the border.
PAD = 1e-9


def number(value: float) -> str:
    """A finite number as a DOUBLE literal."""
    value = float(value)
    if not math.isfinite(value):
        raise ValueError(f"not a finite number: {value}")
    return f"({value!r}D)"


def zone_column(height: float) -> str:
    """The partition column of declination zones so many degrees high."""
    height = float(height)
    if not (math.isfinite(height) and height > 0):
        raise ValueError(f"zones need a positive height: {height}")
    return ZONE + repr(height).removesuffix(".0").translate(SIGNS)


def zone_height(columns: Iterable[str]) -> float | None:
    """The height of the declination zones a table was written with; None without zones."""
    for name in columns:
        if name.startswith(ZONE):
            try:
                return float(name.removeprefix(ZONE).translate(LETTERS))
            except ValueError:
                continue
    return None


def _check_centre(ra0: float, dec0: float) -> None:
    number(ra0)
    if not -90 <= dec0 <= 90:
        raise ValueError(f"declination out of range: {dec0}")


def _haversine(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    return (
        f"(pow(sin(radians(({dec1}) - ({dec2})) / 2), 2)"
        f" + cos(radians({dec1})) * cos(radians({dec2}))"
        f" * pow(sin(radians(({ra1}) - ({ra2})) / 2), 2))"
    )


def separation(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """Angle between two positions, in degrees."""
    return f"(2 * degrees(asin(least(1D, sqrt({_haversine(ra1, dec1, ra2, dec2)})))))"


def rounded(angle: str, places: int) -> str:
    """An angle from 0 on to so many decimal places, half up, in doubles: SQL's ``round`` writes every
    number out as a decimal, which costs more than the separation itself. The angle is no NaN."""
    return f"(floor(({angle}) * {number(10**places)} + 0.5D) / {number(10**places)})"


def within(ra1: str, dec1: str, ra2: str, dec2: str, radius: float) -> str:
    """Whether two positions are at most ``radius`` degrees apart."""
    limit = 1.0 if radius >= 180 else math.sin(math.radians(radius) / 2) ** 2
    return f"{_haversine(ra1, dec1, ra2, dec2)} <= {number(limit)}"


def ra_reach(dec0: float, radius: float) -> float:
    """How far in right ascension a circle reaches; 180 means all the way round."""
    if abs(dec0) + radius >= 90:
        return 180.0
    return math.degrees(math.asin(math.sin(math.radians(radius)) / math.cos(math.radians(dec0))))


def _enclosing_ranges(
    ra0: float, dec0: float, radius: float, ra: str, dec: str, zone_height: float | None
) -> str:
    south, north = dec0 - radius - PAD, dec0 + radius + PAD
    ranges = f"{dec} BETWEEN {number(south)} AND {number(north)}"
    if zone_height:
        first, last = (math.floor((edge + 90.0) / zone_height) for edge in (south, north))
        ranges = f"{zone_column(zone_height)} BETWEEN {first} AND {last} AND {ranges}"
    reach = ra_reach(dec0, radius) + PAD
    if reach >= 180:
        return ranges
    west, east = ra0 % 360 - reach, ra0 % 360 + reach
    if west < 0:
        return f"{ranges} AND ({ra} <= {number(east)} OR {ra} >= {number(west + 360)})"
    if east >= 360:
        return f"{ranges} AND ({ra} <= {number(east - 360)} OR {ra} >= {number(west)})"
    # Right ascensions outside [0, 360) are left to the exact test.
    return (
        f"{ranges} AND ({ra} BETWEEN {number(west)} AND {number(east)}"
        f" OR {ra} < 0D OR {ra} >= 360D)"
    )


def circle(
    ra0: float,
    dec0: float,
    radius: float,
    ra: str = "ra",
    dec: str = "dec",
    zone_height: float | None = None,
) -> str:
    """Rows at most ``radius`` degrees from a position."""
    _check_centre(ra0, dec0)
    if not 0 <= radius <= 180:
        raise ValueError(f"radius out of range: {radius}")
    ranges = _enclosing_ranges(ra0, dec0, radius, ra, dec, zone_height)
    return f"({ranges} AND {within(ra, dec, number(ra0), number(dec0), radius)})"


#: Vertices of a polygon that the enclosing ranges of the SQL function look at; polygons with more
#: are tested without ranges.
RANGED_VERTICES = 24


def _function_ranges(reach: str) -> str:
    """Ranges for SQL functions, around ``ra0`` and ``dec0`` (``reach`` degrees).

    The conditions hold constants only when a function is called with constants, so Spark works
    them out while it plans, and what is left are plain comparisons of ``dec``, ``ra`` and ``zone``.
    """
    reach, pad = f"({reach})", number(PAD)
    south, north = f"(dec0 - {reach} - {pad})", f"(dec0 + {reach} + {pad})"
    turn = f"(degrees(asin(sin(radians({reach})) / cos(radians(dec0)))) + {pad})"
    middle = "(ra0 - 360 * floor(ra0 / 360))"
    west, east = f"({middle} - {turn})", f"({middle} + {turn})"
    zones = " AND ".join(
        f"zone {sign} CAST(floor(({edge} + 90) / zone_height) AS INT)"
        for sign, edge in ((">=", south), ("<=", north))
    )
    return (
        f"CASE WHEN zone_height IS NULL THEN true ELSE {zones} END"
        f" AND dec >= {south} AND dec <= {north}"
        f" AND CASE WHEN abs(dec0) + {reach} >= 90 THEN true"
        f" WHEN {west} < 0 THEN ra <= {east} OR ra >= {west} + 360"
        f" WHEN {east} >= 360 THEN ra <= {east} - 360 OR ra >= {west}"
        f" ELSE (ra >= {west} AND ra <= {east}) OR ra < 0 OR ra >= 360 END"
    )


#: Where a SQL function's table keeps its zones; ``zone => sky_zone_10, zone_height => 10``.
_ZONE_ARGUMENTS = "zone INT DEFAULT NULL, zone_height DOUBLE DEFAULT NULL"

_BOX_AHEAD = (
    "(cos(radians(dec)) * cos(radians(ra - ra0)) * cos(radians(dec0))"
    " + sin(radians(dec)) * sin(radians(dec0)))"
)


def _polygon_function() -> str:
    """The text of ``sky_polygon``: the vertices are projected on the plane that touches the sphere
    at the first one's side of the polygon, their middle, as ``polygon`` does."""
    corners = "transform(vertices, v -> named_struct(" + ", ".join(
        f"'{axis}', {text}"
        for axis, text in (
            ("x", "cos(radians(v.dec)) * cos(radians(v.ra))"),
            ("y", "cos(radians(v.dec)) * sin(radians(v.ra))"),
            ("z", "sin(radians(v.dec))"),
        )
    ) + "))"
    total = (
        f"aggregate({corners}, named_struct('x', 0D, 'y', 0D, 'z', 0D), (t, v) ->"
        " named_struct('x', t.x + v.x, 'y', t.y + v.y, 'z', t.z + v.z))"
    )
    # Unit vectors of the middle, east and north; the middle's own are bound once for each row.
    frame = (
        f"transform(array({total}), t -> named_struct("
        "'ra0', degrees(atan2(t.y, t.x)), 'dec0', degrees(atan2(t.z, sqrt(t.x * t.x + t.y * t.y)))))"
    )

    def flat(ra: str, dec: str) -> str:
        turn = f"radians({ra} - m.ra0)"
        ahead = (
            f"(cos(radians({dec})) * cos({turn}) * cos(radians(m.dec0))"
            f" + sin(radians({dec})) * sin(radians(m.dec0)))"
        )
        north = (
            f"(sin(radians({dec})) * cos(radians(m.dec0))"
            f" - cos(radians({dec})) * cos({turn}) * sin(radians(m.dec0)))"
        )
        return (
            f"named_struct('h', {ahead}, 'x', cos(radians({dec})) * sin({turn}) / {ahead},"
            f" 'y', {north} / {ahead})"
        )

    outline = f"transform(vertices, v -> {flat('v.ra', 'v.dec')})"
    crossed = (
        "aggregate(sequence(0, size(o) - 1), 0, (n, i) -> n +"
        " IF((o[i].y > p.y) <> (o[(i + 1) % size(o)].y > p.y) AND"
        " p.x < o[i].x + (p.y - o[i].y) * (o[(i + 1) % size(o)].x - o[i].x)"
        " / (o[(i + 1) % size(o)].y - o[i].y), 1, 0)) % 2 = 1"
    )
    return (
        f"exists({frame}, m -> exists(array({flat('ra', 'dec')}), p -> p.h > 0 AND"
        f" exists(array({outline}), o -> size(o) >= 3 AND"
        f" IF(exists(o, v -> v.h < 1e-6), raise_error('the polygon does not fit in a hemisphere'),"
        f" {crossed}))))"
    )


def _polygon_ranges() -> str:
    """A cap around the first vertex that reaches all others holds the polygon, if it is no wider
    than a hemisphere."""
    ra0, dec0 = "get(vertices, 0).ra", "get(vertices, 0).dec"
    spans = [
        _haversine(f"get(vertices, {i}).ra", f"get(vertices, {i}).dec", ra0, dec0)
        for i in range(RANGED_VERTICES)
    ]
    reach = f"2 * degrees(asin(least(1D, sqrt(greatest({', '.join(spans)})))))"
    ranges = _function_ranges("REACH").replace("ra0", f"({ra0})").replace("dec0", f"({dec0})")
    return (
        f"CASE WHEN size(vertices) > {RANGED_VERTICES} OR {reach} >= 89 THEN true"
        f" ELSE {ranges.replace('REACH', reach)} END"
    )


#: Regions as SQL functions. Spark puts their text in place of a call, so constant arguments are
#: folded and the ranges reach the scan.
FUNCTIONS = {
    "sky_separation": (
        "ra1 DOUBLE, dec1 DOUBLE, ra2 DOUBLE, dec2 DOUBLE",
        "DOUBLE",
        separation("ra1", "dec1", "ra2", "dec2"),
    ),
    "sky_circle": (
        f"ra DOUBLE, dec DOUBLE, ra0 DOUBLE, dec0 DOUBLE, radius DOUBLE, {_ZONE_ARGUMENTS}",
        "BOOLEAN",
        f"{_function_ranges('radius')}"
        f" AND {_haversine('ra', 'dec', 'ra0', 'dec0')}"
        " <= pow(sin(radians(least(radius, 180D)) / 2), 2)",
    ),
    "sky_box": (
        "ra DOUBLE, dec DOUBLE, ra0 DOUBLE, dec0 DOUBLE, width DOUBLE, height DOUBLE,"
        f" {_ZONE_ARGUMENTS}",
        "BOOLEAN",
        _function_ranges("degrees(atan(hypot(tan(radians(width) / 2), tan(radians(height) / 2))))")
        + f" AND {_BOX_AHEAD} > 0"
        " AND abs(cos(radians(dec)) * sin(radians(ra - ra0)))"
        f" <= tan(radians(width) / 2) * {_BOX_AHEAD}"
        " AND abs(sin(radians(dec)) * cos(radians(dec0))"
        " - cos(radians(dec)) * cos(radians(ra - ra0)) * sin(radians(dec0)))"
        f" <= tan(radians(height) / 2) * {_BOX_AHEAD}",
    ),
    "sky_polygon": (
        "ra DOUBLE, dec DOUBLE, vertices ARRAY<STRUCT<ra: DOUBLE, dec: DOUBLE>>,"
        f" {_ZONE_ARGUMENTS}",
        "BOOLEAN",
        f"{_polygon_ranges()} AND {_polygon_function()}",
    ),
}


def register_functions(spark: SparkSession) -> None:
    """Makes ``sky_separation``, ``sky_circle``, ``sky_box`` and ``sky_polygon`` known to the session's
    SQL; functions of these names that are there already stay.

    On tables with declination zones, ``zone => sky_zone_10, zone_height => 10`` as last arguments let
    a region open the folders of its zones only."""
    for name, (arguments, kind, text) in FUNCTIONS.items():
        if not spark.catalog.functionExists(name):
            spark.sql(f"CREATE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {text}")


def near_object(
    ra0: float,
    dec0: float,
    radius: float = 0.1,
    ra: str = "ra",
    dec: str = "dec",
    zone_height: float | None = None,
) -> str:
    """Rows near an object: a circle with a small default radius."""
    return circle(ra0, dec0, radius, ra, dec, zone_height)


def _tangent_parts(ra0: float, dec0: float, ra: str, dec: str) -> tuple[str, str, str]:
    """Components of a row's unit vector along the centre, east and north directions."""
    sin0, cos0 = (number(f(math.radians(dec0))) for f in (math.sin, math.cos))
    sin_dec, cos_dec = f"sin(radians({dec}))", f"cos(radians({dec}))"
    turn = f"radians({ra} - {number(ra0)})"
    ahead = f"({cos_dec} * cos({turn}) * {cos0} + {sin_dec} * {sin0})"
    east = f"({cos_dec} * sin({turn}))"
    north = f"({sin_dec} * {cos0} - {cos_dec} * cos({turn}) * {sin0})"
    return ahead, east, north


def box(
    ra0: float,
    dec0: float,
    width: float,
    height: float,
    ra: str = "ra",
    dec: str = "dec",
    zone_height: float | None = None,
) -> str:
    """Rows in a box around a position whose sides are great circles.

    ``width`` and ``height`` are true angles below 180 degrees, not a right-ascension range.
    """
    _check_centre(ra0, dec0)
    for side in (width, height):
        if not 0 <= side < 180:
            raise ValueError(f"box side out of range: {side}")
    half_width, half_height = (math.tan(math.radians(side) / 2) for side in (width, height))
    reach = math.degrees(math.atan(math.hypot(half_width, half_height)))
    ahead, east, north = _tangent_parts(ra0, dec0, ra, dec)
    return (
        f"({_enclosing_ranges(ra0, dec0, reach, ra, dec, zone_height)} AND {ahead} > 0"
        f" AND abs({east}) <= {number(half_width)} * {ahead}"
        f" AND abs({north}) <= {number(half_height)} * {ahead})"
    )


def _unit(ra0: float, dec0: float) -> tuple[float, float, float]:
    a, d = math.radians(ra0), math.radians(dec0)
    return math.cos(d) * math.cos(a), math.cos(d) * math.sin(a), math.sin(d)


def flattened(
    vertices: Sequence[tuple[float, float]],
) -> tuple[float, float, list[tuple[float, float]], float]:
    """The middle of a polygon, its vertices on the plane that touches the sphere there, and how far
    the polygon reaches from it."""
    if len(vertices) < 3:
        raise ValueError("a polygon needs at least 3 vertices")
    for vertex in vertices:
        _check_centre(*vertex)
    x, y, z = (sum(axis) for axis in zip(*(_unit(*vertex) for vertex in vertices)))
    length = math.hypot(x, y, z)
    if length < 1e-9:
        raise ValueError("the polygon does not fit in a hemisphere")
    ra0, dec0 = math.degrees(math.atan2(y, x)), math.degrees(math.asin(z / length))

    flat = []
    reach = 0.0
    sin0, cos0 = math.sin(math.radians(dec0)), math.cos(math.radians(dec0))
    for vertex_ra, vertex_dec in vertices:
        turn, d = math.radians(vertex_ra - ra0), math.radians(vertex_dec)
        ahead = math.cos(d) * math.cos(turn) * cos0 + math.sin(d) * sin0
        if ahead < 1e-6:
            raise ValueError("the polygon does not fit in a hemisphere")
        east = math.cos(d) * math.sin(turn)
        north = math.sin(d) * cos0 - math.cos(d) * math.cos(turn) * sin0
        flat.append((east / ahead, north / ahead))
        reach = max(reach, math.degrees(math.atan(math.hypot(*flat[-1]))))
    return ra0, dec0, flat, reach


def crossing_lines(
    flat: Sequence[tuple[float, float]],
) -> list[tuple[float, float, float, float, float]]:
    """Lowest and highest y, a point and the slope (x by y) of the sides that a level ray can cross."""
    lines = []
    for (x1, y1), (x2, y2) in zip(flat, [*flat[1:], flat[0]]):
        if y1 != y2:
            lines.append((min(y1, y2), max(y1, y2), x1, y1, (x2 - x1) / (y2 - y1)))
    return lines


def polygon(
    vertices: Sequence[tuple[float, float]],
    ra: str = "ra",
    dec: str = "dec",
    zone_height: float | None = None,
) -> str:
    """Rows inside a simple polygon with great-circle sides that fits in a hemisphere.

    Points are projected on the plane that touches the sphere at the polygon's middle, where
    great circles are straight lines; a point is inside if a ray from it crosses the outline
    an odd number of times. Points exactly on the outline may fall on either side.
    """
    ra0, dec0, flat, reach = flattened(vertices)
    crossings = [
        f"IF(p.y >= {number(low)} AND p.y < {number(high)}"
        f" AND p.x < {number(x1)} + (p.y - {number(y1)}) * {number(slope)}, 1, 0)"
        for low, high, x1, y1, slope in crossing_lines(flat)
    ]
    if not crossings:
        return "false"
    ahead, east, north = _tangent_parts(ra0, dec0, ra, dec)
    # The one-element array binds the projected point, so that it is computed once per row.
    point = f"array(named_struct('x', {east} / {ahead}, 'y', {north} / {ahead}))"
    return (
        f"({_enclosing_ranges(ra0, dec0, reach, ra, dec, zone_height)} AND {ahead} > 0"
        f" AND exists({point}, p -> {_total(crossings)} % 2 = 1))"
    )


def _total(terms: Sequence[str]) -> str:
    """A sum by halves: a chain of hundreds of terms is too deep for the parser's stack."""
    if len(terms) == 1:
        return terms[0]
    half = len(terms) // 2
    return f"({_total(terms[:half])} + {_total(terms[half:])})"
