"""Binding for the housing table: schema, ratios, interactions, default selection."""

from __future__ import annotations

from plumbline.operators.findings import Wording
from plumbline.operators.governance import DISTANCE, GROUPING, INDEX, Interaction, planned
from plumbline.schema import ColumnRule, CrossRule, Ratio, SemanticSchema

# Column names, limits, categories and wording of the housing table.
INCOME_EDGES = (0.0, 1.5, 3.0, 4.5, 6.0, float("inf"))
CATEGORIES = ("<1H OCEAN", "INLAND", "ISLAND", "NEAR BAY", "NEAR OCEAN")
TARGET = "median_house_value"
MEDIAN_AFTER_SPLIT = "median_imputation_after_split"
SPLINE_COLUMNS = ("longitude", "latitude", "median_income")
RECOMMENDED = (
    "median_income", "housing_median_age", "total_rooms", "total_bedrooms", "population",
    "households", "ocean_proximity", "rooms_per_household", "population_per_household",
    "bedrooms_per_household",
)

RATIOS = (
    Ratio("rooms_per_household", "total_rooms", "households", "Rooms that a household has on average."),
    Ratio("bedrooms_per_room", "total_bedrooms", "total_rooms", "Share of rooms that are bedrooms."),
    Ratio("population_per_household", "population", "households", "People in a household on average."),
    Ratio("bedrooms_per_household", "total_bedrooms", "households", "Bedrooms that a household has on average."),
    Ratio("rooms_per_person", "total_rooms", "population", "Rooms that a person has on average."),
    Ratio("bedrooms_per_person", "total_bedrooms", "population", "Bedrooms that a person has on average."),
)
MODEL_RATIOS = tuple(r for r in RATIOS if r.name in RECOMMENDED)

INTERACTIONS = (
    Interaction(
        "longitude_latitude_interaction", ("longitude", "latitude"), "longitude × latitude",
        "Location as one effect of both coordinates.",
    ),
    Interaction(
        "income_ocean_proximity_interaction", ("median_income", "ocean_proximity"),
        "median_income × indicators of ocean_proximity", "Income may count differently near the coast.",
    ),
    Interaction(
        "income_age_interaction", ("median_income", "housing_median_age"), "median_income × housing_median_age",
        "Income may count differently for old houses.", recommended=False,
    ),
)

DOMAIN_ASSETS = (
    planned(
        GROUPING, "coastal_access_group", ("ocean_proximity",), "approved mapping of categories to groups",
        "Coarser location segment.", "No grouping is approved yet.",
    ),
    planned(
        DISTANCE, "distance_to_business_centre", ("longitude", "latitude", "external_cbd_coordinates"),
        "shortest great-circle distance to the given centres", "How far a block lies from work and trade.",
        "The centres must be supplied.",
    ),
    planned(
        INDEX, "local_amenity_index", ("external_amenity_data",), "weighted sum of standardised columns",
        "Access to schools, services and transport.", "The amenity table must be supplied.", risk="MEDIUM",
    ),
)

WORDING = Wording(
    rationales={
        "spatial_coordinate": "Places near each other tend to have similar prices.",
        "count": "Says how large a block is; ratios of counts say more.",
        "nominal_categorical": "Price levels may differ between categories.",
        "discrete_numeric": "Price may change in steps rather than evenly.",
    },
    expected={
        "longitude": "Varies by region, not along a line.",
        "latitude": "Varies by region, not along a line.",
        "housing_median_age": "A threshold or a curve is possible.",
        "total_rooms": "Unclear as a raw count.",
        "total_bedrooms": "Unclear as a raw count.",
        "population": "Crowding may lower prices.",
        "households": "Follows the size of the block.",
        "median_income": "Prices rise with income.",
        "ocean_proximity": "Levels differ between categories.",
    },
)


def _counted(name: str, **more) -> ColumnRule:
    return ColumnRule(name, "count", minimum=0.0, whole_number=True, **more)


def housing_schema() -> SemanticSchema:
    """The approved schema of the housing table."""
    return SemanticSchema(
        (
            ColumnRule("longitude", "spatial_coordinate", minimum=-180.0, maximum=180.0),
            ColumnRule("latitude", "spatial_coordinate", minimum=-90.0, maximum=90.0),
            ColumnRule("housing_median_age", "discrete_numeric", minimum=0.0, whole_number=True),
            _counted("total_rooms"),
            _counted("total_bedrooms", nullable=True, missing_treatment=MEDIAN_AFTER_SPLIT),
            _counted("population"),
            _counted("households"),
            ColumnRule("median_income", "continuous_numeric", minimum=0.0),
            ColumnRule(TARGET, "continuous_numeric", role="target", minimum=0.0, group="target"),
            ColumnRule(
                "ocean_proximity", "nominal_categorical", storage="string",
                allowed_values=CATEGORIES, group="categorical",
            ),
        ),
        (
            CrossRule(
                "households_above_population", "households > population",
                "Household count should not normally exceed population.", ("households", "population"),
            ),
            CrossRule(
                "bedrooms_above_rooms", "total_bedrooms > total_rooms",
                "Bedrooms should not normally exceed total rooms.", ("total_bedrooms", "total_rooms"),
            ),
        ),
    )
