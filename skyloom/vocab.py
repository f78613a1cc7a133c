"""Names, column lists, markers and factors that results depend on."""

# The archive's table names.
TABLE_NAMES = (
    "ps",
    "pscomppars",
    "toi",
    "ml",
    "stellarhosts",
    "keplernames",
    "keplerstellar",
    "keplertimeseries",
    "k2names",
    "k2pandc",
    "k2targets",
    "ukirttimeseries",
    "kelttimeseries",
    "superwasptimeseries",
    "spectra",
    "di_stars_exep",
    "TD",
    "cumulative",
    "q1_q6_koi",
    "q1_q8_koi",
    "q1_q12_koi",
    "q1_q16_koi",
    "q1_q17_dr24_koi",
    "q1_q17_dr25_koi",
    "q1_q17_dr25_sup_koi",
    "q1_q12_tce",
    "q1_q16_tce",
    "q1_q17_dr24_tce",
    "q1_q17_dr25_tce",
    "q1_q12_ks",
    "q1_q16_ks",
    "q1_q17_dr24_ks",
    "q1_q17_dr25_ks",
    "q1_q17_dr25_sup_ks",
)

# The tables the named datasets read.
PLANETS, TOI, KOI, MICROLENSING = "ps", "toi", "cumulative", "ml"

# Columns of the named datasets.
PLANET_COLUMNS = (
    "pl_name", "hostname", "discoverymethod", "disc_year",
    "pl_orbper", "pl_orbsmax", "pl_masse", "pl_rade",
    "pl_eqt", "st_teff", "st_rad", "st_mass",
    "ra", "dec", "sy_dist", "default_flag",
)
SYSTEM_COLUMNS = (
    "hostname", "sy_snum", "sy_pnum", "sy_mnum",
    "st_teff", "st_rad", "st_mass", "st_met",
    "sy_dist", "ra", "dec", "default_flag",
)
TESS_COLUMNS = (
    "toi", "tic_id", "toipfx", "pl_name", "hostname",
    "pl_orbper", "pl_rade", "pl_eqt", "st_tmag",
    "ra", "dec", "tfopwg_disp",
)
KEPLER_COLUMNS = (
    "kepid", "kepoi_name", "koi_disposition", "koi_score",
    "koi_period", "koi_prad", "koi_teq", "koi_slogg",
    "ra", "dec",
)
MICROLENSING_COLUMNS = (
    "pl_name", "hostname", "discoverymethod", "disc_year",
    "pl_orbsmax", "pl_masse", "st_mass", "sy_dist",
    "ra", "dec",
)

# The types of these columns where a source delivers them as text.
COLUMN_TYPES = dict.fromkeys(
    ("pl_name", "hostname", "discoverymethod", "soltype", "tfopwg_disp", "kepoi_name",
     "koi_disposition"),
    "string",
) | dict.fromkeys(
    ("disc_year", "default_flag", "sy_snum", "sy_pnum", "sy_mnum", "tic_id", "toipfx", "kepid"),
    "bigint",
) | dict.fromkeys(
    ("toi", "pl_orbper", "pl_orbsmax", "pl_masse", "pl_rade", "pl_eqt", "st_teff", "st_rad",
     "st_mass", "st_met", "st_tmag", "sy_dist", "koi_score", "koi_period", "koi_prad", "koi_teq",
     "koi_slogg"),
    "double",
)

# Text that stands for a missing cell, after trimming.
NULL_TOKENS = ("", "null", "NULL", "nan", "NaN", "N/A", "n/a", "-", "--")

# Unit factors of the planet cleaning rules, (column, from, to, factor).
PLANET_UNITS = (
    ("pl_masse", "Earth masses", "Jupiter masses", 1 / 317.8),
    ("pl_rade", "Earth radii", "Jupiter radii", 1 / 11.2),
)

# Standard spellings of discovery methods.
METHOD_SPELLINGS = {
    "Transit": "transit",
    "Radial Velocity": "radial_velocity",
    "Imaging": "direct_imaging",
    "Microlensing": "microlensing",
    "Eclipse Timing Variations": "eclipse_timing",
    "Orbital Brightness Modulation": "orbital_brightness",
}

# Columns that hold angles in degrees.
COORDINATE_COLUMNS = ("ra", "dec", "glon", "glat")

# Date layouts tried in turn, as Spark patterns.
DATE_LAYOUTS = (
    "yyyy-M-d",
    "yyyy/M/d",
    "M/d/yyyy",
    "yyyy-M-d H:m:s",
    "yyyy-M-d'T'H:m:s",
)

# Strptime directives and the Spark pattern letters that read the same text.
STRPTIME_PATTERNS = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "M",
    "%d": "d",
    "%H": "H",
    "%I": "h",
    "%M": "m",
    "%S": "s",
    "%p": "a",
    "%b": "MMM",
    "%B": "MMMM",
    "%j": "D",
}

# The names that dates may hold, and what strptime reads for each directive.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
STRPTIME_EXPRESSIONS = {
    "%Y": "[0-9]{4}",
    "%y": "[0-9]{2}",
    "%m": "1[0-2]|0[1-9]|[1-9]",
    "%d": "3[01]|[12][0-9]|0[1-9]|[1-9]",
    "%H": "2[0-3]|[01][0-9]|[0-9]",
    "%I": "1[0-2]|0[1-9]|[1-9]",
    "%M": "[0-5][0-9]|[0-9]",
    "%S": "[0-5][0-9]|[0-9]",
    "%p": "AM|PM",
    "%f": "[0-9]{1,6}",
    "%j": "36[0-6]|3[0-5][0-9]|[12][0-9]{2}|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9]",
    "%z": "[+-](?:[01][0-9]|2[0-3])(?::[0-5][0-9](?::[0-5][0-9](?:[.][0-9]{1,6})?)?"
    "|[0-5][0-9](?:[0-5][0-9](?:[.][0-9]{1,6})?)?)|(?-i:Z)",
    "%Z": "UTC|GMT",
    "%a": "|".join(name[:3] for name in WEEKDAYS),
    "%A": "|".join(WEEKDAYS),
    "%b": "|".join(name[:3] for name in MONTHS),
    "%B": "|".join(MONTHS),
}

# The white space that Python's str.strip removes.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
