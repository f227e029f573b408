"""The standing rules of every layer, by table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from placetide.operators import checks as C
from placetide.schemas import AGGREGATE_CODES, LEVELS, SUPPRESSED_COUNT

YEAR = ("survey_year",)


# Row counts and year counts each layer must show.
@dataclass(frozen=True)
class Expectations:
    survey_rows: dict = field(default_factory=lambda: {"states": 52, "counties": 3212, "tracts": 73000})
    boundary_rows: dict = field(default_factory=lambda: {"states": 56, "counties": 3225, "tracts": 73000})
    gold_rows: dict = field(default_factory=lambda: {"states": 50, "counties": 3200, "tracts": 73000})
    place_years: int = 13
    flow_years: tuple = tuple(range(2012, 2024))
    spot_state: str = "06"
    spot_from_year: int = 2022
    spot_low: int = 35_000_000
    spot_high: int = 45_000_000


DEFAULTS = Expectations()


def bronze_rules() -> dict:
    return {
        f"bronze_tiger_{level}": [C.fully_covered("geometry_wkt", name="geometry_present", by=YEAR)] for level in LEVELS
    }


def _place_silver_rules(rows: dict, years: int, level: str) -> list:
    return [
        C.rows_per_year(rows[level], exact=level == "states"),
        C.not_null("geography_id", name="no_null_geography_id", by=YEAR),
        C.unique_key("geography_id", "survey_year"),
        C.year_count(years),
    ]


def silver_rules(e: Expectations = DEFAULTS) -> dict:
    rules = {}
    for level in LEVELS:
        rules[f"silver_acs5_{level}"] = _place_silver_rules(e.survey_rows, e.place_years, level)
        rules[f"silver_tiger_{level}"] = _place_silver_rules(e.boundary_rows, e.place_years, level)
    for table, code in (
        ("silver_irs_state_outflows", F.col("dest_geography_id")),
        ("silver_irs_county_outflows", F.substring("dest_geography_id", 1, 2)),
    ):
        rules[table] = [
            C.codes_absent(code.try_cast("int"), AGGREGATE_CODES, by=YEAR),
            C.sentinel_absent(("households", "individuals"), SUPPRESSED_COUNT, by=YEAR),
            C.not_null("origin_geography_id", "dest_geography_id", by=YEAR),
        ]
    rules["silver_irs_state_outflows"].append(C.year_count(len(e.flow_years), name="all_years"))
    return rules


# Metrics that must be complete in gold, by level.
COMPLETE = {
    "states": ("total_population", "median_household_income", "bachelors_degree"),
    "counties": ("total_population", "median_household_income"),
    "tracts": ("total_population", "median_household_income"),
}


def gold_rules(e: Expectations = DEFAULTS) -> dict:
    rules = {}
    for level in LEVELS:
        rules[f"gold_{level}"] = [
            C.rows_per_year(e.gold_rows[level], exact=False),
            C.unique_key("geography_id", "survey_year"),
            C.fully_covered("geometry_wkt", name="geometry_present", by=YEAR),
            C.fully_covered(*COMPLETE[level], by=YEAR),
        ]
    recent = (F.col("state_fips") == e.spot_state) & (F.col("survey_year") >= e.spot_from_year)
    rules["gold_states"].append(
        C.range_spot("population_sanity", F.col("total_population"), recent, e.spot_low, e.spot_high, by=YEAR)
    )
    for table in ("gold_irs_state_outflows", "gold_irs_county_outflows"):
        rules[table] = [
            C.rows_in_years(e.flow_years),
            C.not_null("origin_geography_id", "dest_geography_id", by=YEAR),
            C.both_flags("is_non_migrant", by=YEAR),
        ]
    return rules


def source_rules() -> dict:
    """Key tests on the gold tables the marts read. County flows have no unique key: total
    rows (county 000) share one."""
    rules = {}
    for level in LEVELS:
        keys = ("geography_id", "survey_year")
        rules[f"gold_{level}"] = [
            *(C.not_null(k, name=f"not_null_{k}", by=YEAR) for k in keys),
            C.unique_key(*keys, name="unique_combination"),
        ]
    flow_keys = ("origin_geography_id", "dest_geography_id", "survey_year")
    for table in ("gold_irs_state_outflows", "gold_irs_county_outflows"):
        rules[table] = [C.not_null(k, name=f"not_null_{k}", by=YEAR) for k in flow_keys]
    rules["gold_irs_state_outflows"].append(C.unique_key(*flow_keys, name="unique_combination"))
    return rules
