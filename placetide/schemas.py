"""Column lists, table schemas and fixed reference values."""

from __future__ import annotations

from pyspark.sql import types as T

LEVELS = ("states", "counties", "tracts")

# Fixed value: buckets of every bucketed mart.
BUCKET_COUNT = 32

# Survey variable code -> column name, in source order.
SURVEY_VARIABLES = {
    "B01001_001E": "total_population",
    "B01002_001E": "median_age",
    "B03002_003E": "white_alone_not_hispanic",
    "B03002_004E": "black_alone_not_hispanic",
    "B03002_006E": "asian_alone_not_hispanic",
    "B03002_012E": "hispanic_or_latino",
    "B19013_001E": "median_household_income",
    "B17001_001E": "poverty_total",
    "B17001_002E": "below_poverty_level",
    "B15003_001E": "education_total_25y_plus",
    "B15003_022E": "bachelors_degree",
    "B15003_023E": "masters_degree",
    "B15003_024E": "professional_degree",
    "B15003_025E": "doctorate_degree",
    "B15003_017E": "high_school_diploma",
    "B15003_002E": "no_high_school_diploma",
    "B25077_001E": "median_home_value",
    "B25003_001E": "total_occupied",
    "B25003_002E": "owner_occupied",
    "B25003_003E": "renter_occupied",
    "B25064_001E": "median_gross_rent",
    "B07001_001E": "migration_total",
    "B08301_001E": "commute_total_workers_16_plus",
    "B08301_003E": "drove_alone_to_work",
    "B08301_019E": "walked_to_work",
    "B08301_021E": "worked_from_home",
}

# The 50 states and DC, as two-digit codes.
STATE_FIPS_CODES = (
    "01", "02", "04", "05", "06", "08", "09", "10", "11", "12",
    "13", "15", "16", "17", "18", "19", "20", "21", "22", "23",
    "24", "25", "26", "27", "28", "29", "30", "31", "32", "33",
    "34", "35", "36", "37", "38", "39", "40", "41", "42", "44",
    "45", "46", "47", "48", "49", "50", "51", "53", "54", "55", "56",
)

# Destination codes that hold totals, not places
# (57 foreign, 58 same state, 59 territory flows, 96-98 grand totals).
AGGREGATE_CODES = (57, 58, 59, 96, 97, 98)

# Text marking a flow withheld for privacy, and its typed form.
SUPPRESSED_TEXT = "-1"
SUPPRESSED_COUNT = -1

# First year of data, and last year the flow source was published.
FIRST_YEAR = 2012
LAST_FLOW_YEAR = 2023

MEASURES = tuple(SURVEY_VARIABLES.values())
REAL_MEASURES = ("median_age",)


def _measure_type(name: str) -> T.DataType:
    return T.DoubleType() if name in REAL_MEASURES else T.LongType()


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType()}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name type, ...``; unlike ``fromDDL`` it needs no running session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


def _fields(names, dtype) -> list[T.StructField]:
    return [T.StructField(n, dtype) for n in names]


SURVEY_BRONZE = T.StructType(
    _fields(("NAME", *MEASURES, "state", "county", "tract"), T.StringType())
    + [T.StructField("survey_year", T.LongType()), T.StructField("ingest_date", T.StringType())]
)

BOUNDARY_BRONZE = _schema(
    "STATEFP string, COUNTYFP string, TRACTCE string, GEOID string, NAME string, "
    "NAMELSAD string, MTFCC string, FUNCSTAT string, ALAND bigint, AWATER bigint, "
    "INTPTLAT string, INTPTLON string, geometry_wkt string, survey_year bigint, ingest_date string"
)

STATE_FLOW_BRONZE = _schema(
    "y1_statefips string, y2_statefips string, y2_state string, y2_state_name string, "
    "n1 string, n2 string, AGI string, survey_year bigint, ingest_date string"
)

COUNTY_FLOW_BRONZE = _schema(
    "y1_statefips string, y1_countyfips string, y2_statefips string, y2_countyfips string, "
    "y2_state string, y2_countyname string, n1 string, n2 string, agi string, "
    "survey_year bigint, ingest_date string"
)

PLACE_KEYS = ("geography_name", "state_fips", "county_fips", "tract_fips", "geography_id")

SURVEY_SILVER = T.StructType(
    _fields(PLACE_KEYS, T.StringType())
    + [T.StructField("survey_year", T.IntegerType())]
    + [T.StructField(m, _measure_type(m)) for m in MEASURES]
)

# What stored boundary and place tables keep of an outline, parsed once.
_OUTLINE = [
    *_fields(("min_lon", "min_lat", "max_lon", "max_lat", "centroid_lon", "centroid_lat"), T.DoubleType()),
    T.StructField("geometry_sound", T.BooleanType()),
]

BOUNDARY_SILVER = T.StructType(_schema(
    "geography_id string, survey_year int, geography_name string, state_fips string, "
    "county_fips string, tract_fips string, namelsad string, mtfcc string, funcstat string, "
    "ALAND bigint, AWATER bigint, intptlat string, intptlon string, geometry_wkt string"
).fields + _OUTLINE)

FLOW_SILVER = _schema(
    "origin_geography_id string, dest_geography_id string, dest_state string, dest_name string, "
    "households bigint, individuals bigint, agi bigint, survey_year int"
)

PLACE_GOLD = T.StructType(
    [
        T.StructField("geography_id", T.StringType()),
        T.StructField("survey_year", T.IntegerType()),
    ]
    + _fields(("geography_name", "state_fips", "county_fips", "tract_fips"), T.StringType())
    + [T.StructField(m, _measure_type(m)) for m in MEASURES]
    + [
        T.StructField("ALAND", T.LongType()),
        T.StructField("AWATER", T.LongType()),
        T.StructField("geometry_wkt", T.StringType()),
    ]
    + _OUTLINE
)

FLOW_GOLD = T.StructType(FLOW_SILVER.fields + [T.StructField("is_non_migrant", T.BooleanType())])

# Place columns that exist at each level, widest code last.
LEVEL_CODES = {
    "states": ("state_fips",),
    "counties": ("state_fips", "county_fips"),
    "tracts": ("state_fips", "county_fips", "tract_fips"),
}

# Rates of the wide marts: name -> (numerator columns, denominator column).
RATES = {
    "pct_white_alone": (("white_alone_not_hispanic",), "total_population"),
    "pct_black_alone": (("black_alone_not_hispanic",), "total_population"),
    "pct_asian_alone": (("asian_alone_not_hispanic",), "total_population"),
    "pct_hispanic_or_latino": (("hispanic_or_latino",), "total_population"),
    "poverty_rate": (("below_poverty_level",), "poverty_total"),
    "bachelors_plus_rate": (
        ("bachelors_degree", "masters_degree", "professional_degree", "doctorate_degree"),
        "education_total_25y_plus",
    ),
    "high_school_rate": (("high_school_diploma",), "education_total_25y_plus"),
    "owner_occupancy_rate": (("owner_occupied",), "total_occupied"),
    "renter_rate": (("renter_occupied",), "total_occupied"),
    "drove_alone_rate": (("drove_alone_to_work",), "commute_total_workers_16_plus"),
    "walked_to_work_rate": (("walked_to_work",), "commute_total_workers_16_plus"),
    "remote_work_rate": (("worked_from_home",), "commute_total_workers_16_plus"),
}

BASE_MEASURES = (
    "total_population", "median_age", "median_household_income", "median_home_value",
    "median_gross_rent",
)

# Sequential map palettes (nine public cartographic colours each), low to
# high, used as anchors of the fill ramps.
PALETTES = {
    "YlOrRd": ("ffffcc", "ffeda0", "fed976", "feb24c", "fd8d3c", "fc4e2a", "e31a1c", "bd0026", "800026"),
    "YlGnBu": ("ffffd9", "edf8b1", "c7e9b4", "7fcdbb", "41b6c4", "1d91c0", "225ea8", "253494", "081d58"),
    "PuRd": ("f7f4f9", "e7e1ef", "d4b9da", "c994c7", "df65b0", "e7298a", "ce1256", "980043", "67001f"),
    "BuPu": ("f7fcfd", "e0ecf4", "bfd3e6", "9ebcda", "8c96c6", "8c6bb1", "88419d", "810f7c", "4d004b"),
}

# The metrics a layer may be coloured by; any other name is refused.
METRICS = {
    "median_household_income": {
        "label": "Median Household Income",
        "description": "Middle income among all households. Half earn more, half earn less.",
        "format": "currency",
        "palette": "YlOrRd",
    },
    "poverty_rate": {
        "label": "Poverty Rate",
        "description": "% of population living below the federal poverty line.",
        "format": "percent",
        "palette": "YlOrRd",
    },
    "bachelors_plus_rate": {
        "label": "Bachelor's+ Rate",
        "description": "% of adults 25+ with a bachelor's degree or higher.",
        "format": "percent",
        "palette": "YlGnBu",
    },
    "renter_rate": {
        "label": "Renter Rate",
        "description": "% of occupied housing units that are renter-occupied.",
        "format": "percent",
        "palette": "PuRd",
    },
    "remote_work_rate": {
        "label": "Remote Work Rate",
        "description": "% of workers who worked from home in the past week.",
        "format": "percent",
        "palette": "BuPu",
    },
}
