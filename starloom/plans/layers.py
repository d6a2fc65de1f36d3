"""Layered arrivals job: raw -> mapping -> processed -> presentation tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from starloom.functions import (
    after_comma,
    after_dash,
    before_comma,
    day_number_to_date,
    parse_compact_date,
    signed_coordinate,
    strip_letters,
    text_to_date,
    text_to_double,
)
from starloom.operators import (
    Band,
    band_join,
    full_outer,
    group_mean,
    lookup,
    loose_band_join,
    pivot_back,
)

# Raw column names and the names they get.
ARRIVAL_NAMES = {
    "cicid": "cic_id",
    "i94yr": "year",
    "i94mon": "month",
    "i94port": "city_code",
    "i94addr": "state_code",
    "i94mode": "transport_code",
    "i94visa": "visa_code",
    "i94res": "residence_country_code",
    "i94cit": "citizen_country_code",
    "i94bir": "age",
    "biryear": "birth_year",
    "fltno": "flight_number",
    "admnum": "admin_num",
}
# The five mappings by the name they have in the label document.
MAPPINGS = {
    "country": "i94cntyl",
    "port": "i94prtl",
    "mode": "i94model",
    "state": "i94addrl",
    "visa": "I94VISA",
}
# Pivoted categories of the city statistics and their column names.
RACES = {
    "American Indian and Alaska Native": "american_indian_alaska_native",
    "Asian": "asian",
    "Black or African-American": "black_afroamerican",
    "Hispanic or Latino": "hispanic_latino",
    "White": "white",
}
# Names of the city statistics.
DEMOGRAPHIC_NAMES = {
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Median Age": "median_age",
    "Total Population": "total_population",
    "Number of Veterans": "num_of_veterans",
    "Foreign-born": "foreign_born",
    "Average Household Size": "avg_household_size",
    "State Code": "state_code",
}
DEGREES = 4.0  # Fixed value: tolerance between a city and its station.


# --- processed layer ----------------------------------------------------------
def clean_arrivals(raw: DataFrame, mappings: Mapping[str, DataFrame]) -> DataFrame:
    """Dates from day numbers and text, speaking names for codes.

    ``mappings`` holds (code, label) frames for country, port, mode, state and visa.
    Codes of mode and visa are replaced; the others stay beside their label.
    """
    dated = raw.withColumns({
        "arrival_date": day_number_to_date("arrdate"),
        "departure_date": day_number_to_date("depdate"),
        "last_departure": parse_compact_date("dtaddto"),
    }).drop("arrdate", "depdate", "dtaddto").withColumnsRenamed(ARRIVAL_NAMES)
    cities = mappings["port"].withColumn("label", before_comma("label"))
    named = lookup(dated, mappings["mode"], "transport_code", "transport", keep_code=False)
    named = lookup(named, mappings["state"], "state_code", "state")
    named = lookup(named, mappings["country"], "citizen_country_code", "citizen_country")
    named = lookup(named, mappings["visa"], "visa_code", "visa", keep_code=False)
    named = lookup(named, mappings["country"], "residence_country_code", "residence_country")
    return lookup(named, cities, "city_code", "city")


def clean_readings(
    raw: DataFrame, country: str = "United States", signed: bool = False
) -> DataFrame:
    """Readings of one country with numeric coordinates.

    Letters are stripped, so west and south are positive; ``signed`` makes them negative.
    """
    def number(c: str):
        return signed_coordinate(c) if signed else text_to_double(strip_letters(c))

    rows = raw.filter(F.col("Country") == country)
    return rows.withColumns({c: number(c) for c in ("Latitude", "Longitude")}).drop("Country")


def clean_demographics(raw: DataFrame, races: Mapping[str, str] = RACES) -> DataFrame:
    """One row per city: its statistics once, the count of each category in a column."""
    typed = raw.withColumn("Count", F.col("Count").try_cast("bigint"))
    wide = pivot_back(typed, ["City", "State"], "Race", "Count", list(races))
    wide = wide.withColumnsRenamed({**DEMOGRAPHIC_NAMES, **races})
    return wide.withColumn("median_age", F.col("median_age").try_cast("float")).select(
        "City", "State", *DEMOGRAPHIC_NAMES.values(), *races.values()
    )


def clean_sites(raw: DataFrame, country: str = "US") -> DataFrame:
    """Sites of one country: coordinates from ``lon, lat`` text, state from the region."""
    rows = raw.filter(F.col("iso_country") == country).withColumnRenamed("ident", "id_local_code")
    return rows.withColumns({
        "latitude": text_to_double(after_comma("coordinates")),
        "longitude": text_to_double(before_comma("coordinates")),
        "state_code": after_dash("iso_region"),
    }).drop("continent", "iso_country", "local_code", "gps_code", "coordinates")


# --- presentation layer --------------------------------------------------------
def mart_cities(demographics: DataFrame, sites: DataFrame) -> DataFrame:
    """Cities with the mean position of their sites; null without a site."""
    centres = group_mean(
        sites, ["municipality", "state_code"], {"latitude": "latitude", "longitude": "longitude"}
    ).withColumnRenamed("state_code", "site_state")
    same = (F.col("City") == F.col("municipality")) & (F.col("state_code") == F.col("site_state"))
    cities = demographics.select("City", "State", "state_code")
    return cities.join(centres, same, "left").select("City", "State", "latitude", "longitude")


def mart_sites(demographics: DataFrame, sites: DataFrame) -> DataFrame:
    """Sites and cities, each kept when the other is missing."""
    cities = demographics.select("City", "State", F.col("state_code").alias("city_state"))
    joined = full_outer(sites, cities, {"state_code": "city_state", "municipality": "City"})
    return joined.select(
        "State", "City", "name", "type", "id_local_code", "iata_code", "elevation_ft",
        "iso_region", "latitude", "longitude",
    )


def mart_readings(
    readings: DataFrame,
    cities: DataFrame,
    literal_bounds: bool = False,
    west_positive: bool = True,
) -> DataFrame:
    """Readings of the city with the same name within the tolerance of its position.

    Positions are compared in whole degrees. Cities count west as negative, readings
    as positive unless ``west_positive`` is off. ``literal_bounds`` joins the bounds by OR, which keeps every same-named city with
    a known position.
    """
    measured = readings.select(
        "dt", "AverageTemperature", "AverageTemperatureUncertainty",
        F.col("City").alias("station"),
        F.round("Latitude").alias("station_lat"),
        F.round("Longitude").alias("station_lon"),
    )
    longitude = F.round("longitude")
    placed = cities.select(
        "City", "State",
        F.round("latitude").alias("city_lat"),
        (-longitude if west_positive else longitude).alias("city_lon"),
    )
    bands = [
        Band("station_lat", "city_lat", DEGREES, DEGREES),
        Band("station_lon", "city_lon", DEGREES, DEGREES),
    ]
    if literal_bounds:
        joined = loose_band_join(measured, placed, {"station": "City"}, bands)
    else:
        joined = band_join(measured, placed, {"station": "City"}, bands, binned=True)
    dated = joined.withColumn("date", text_to_date("dt"))
    return dated.withColumns({"year": F.year("date"), "month": F.month("date")}).select(
        "City", "State", "date", "year", "month",
        "AverageTemperature", "AverageTemperatureUncertainty",
    )


def mart_demographics(demographics: DataFrame) -> DataFrame:
    return demographics


def mart_arrival_facts(arrivals: DataFrame) -> DataFrame:
    return arrivals.select(
        "cic_id", "year", "month", "city", "state", "airline", "flight_number", "arrival_date",
        "departure_date", "last_departure", "transport",
        F.col("citizen_country").alias("coming_from"),
        F.col("visa").alias("reason"),
    )


def mart_person_facts(arrivals: DataFrame) -> DataFrame:
    return arrivals.select(
        "cic_id", "year", "month", "citizen_country", "residence_country",
        F.col("city").alias("city_of_arrival"),
        F.col("state").alias("state_of_arrival"),
        "age", "birth_year", "gender",
        F.col("visa").alias("reason"),
    )


def mart_destinations(
    arrivals: DataFrame,
    demographics: DataFrame,
    keys: Sequence[str] = ("city",),
    races: Mapping[str, str] = RACES,
) -> DataFrame:
    """Arrivals with the statistics of the city they go to; unknown cities are left out.

    By default cities are matched by name only, so a name in several states matches
    each of them. ``keys=("city", "state")`` matches both.
    """
    going = arrivals.select(
        F.initcap("city").alias("to_city"), F.initcap("state").alias("to_state"),
        "arrival_date", "year", "cic_id", "citizen_country", "residence_country", "visa", "age",
    )
    cities = demographics.select(
        "City", "State", "total_population", "median_age", "avg_household_size", *races.values()
    )
    same = F.col("to_city") == F.col("City")
    if "state" in [k.lower() for k in keys]:
        same = same & (F.col("to_state") == F.col("State"))
    return going.join(cities, same, "inner").drop("to_city", "to_state")


# Presentation tables and the columns they are stored by.
PARTITIONS = {
    "cities": ["State"],
    "airports": ["State", "City"],
    "temperatures": ["year", "State"],
    "city_demographics": ["State", "City"],
    "immigration_info": ["state", "year"],
    "immigrants_info": ["state_of_arrival", "residence_country"],
    "destinations_info": ["residence_country", "City"],
}
