"""Processed and presentation tables of the layered job."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.catalog import views
from starloom.catalog.registry import query
from starloom.plans import layers, runs
from starloom.session import scratch_path
from starloom.sinks import write_csv, write_parquet, write_text

DEMOGRAPHIC_COLUMNS = (
    '"City", "State", male_population, female_population, median_age, total_population, '
    "num_of_veterans, foreign_born, avg_household_size, state_code, "
    + ", ".join(views.SEGMENTS.values())
)


def arrivals(spark, sf):
    return layers.clean_arrivals(views.raw_arrivals(spark, sf), views.mappings(spark, sf))


def readings(spark, sf):
    return layers.clean_readings(views.raw_readings(spark, sf))


def demographics(spark, sf):
    return layers.clean_demographics(views.raw_demographics(spark, sf), views.SEGMENTS)


def sites(spark, sf):
    return layers.clean_sites(views.raw_sites(spark, sf))


def _shown(df):
    """The 32-bit age in 64 bits, so that both sides print the same digits."""
    return df.withColumn("median_age", F.col("median_age").cast("double"))


@query("clean_arrivals", views.ARRIVALS_SQL)
def clean_arrivals(spark, sf):
    return arrivals(spark, sf)


@query("clean_readings", views.READINGS_SQL)
def clean_readings(spark, sf):
    return readings(spark, sf)


@query("clean_demographics", f"SELECT {DEMOGRAPHIC_COLUMNS} FROM ({views.DEMOGRAPHICS_SQL})")
def clean_demographics(spark, sf):
    return _shown(demographics(spark, sf))


@query("clean_sites", views.SITES_SQL)
def clean_sites(spark, sf):
    return sites(spark, sf)


CITIES_SQL = f"""
SELECT "City", "State", avg(latitude) AS latitude, avg(longitude) AS longitude
FROM ({views.DEMOGRAPHICS_SQL}) d LEFT JOIN ({views.SITES_SQL}) s
  ON d."City" = s.municipality AND d.state_code = s.state_code
GROUP BY "City", "State"
"""


@query("mart_cities", f"""
SELECT "City", "State", round(latitude, 8) AS latitude, round(longitude, 8) AS longitude
FROM ({CITIES_SQL})
""")
def mart_cities(spark, sf):
    cities = layers.mart_cities(demographics(spark, sf), sites(spark, sf))
    return cities.withColumns({c: F.round(c, 8) for c in ("latitude", "longitude")})


@query("mart_sites", f"""
SELECT "State", "City", name, type, id_local_code, iata_code, elevation_ft, iso_region, latitude,
       longitude
FROM ({views.SITES_SQL}) s FULL JOIN ({views.DEMOGRAPHICS_SQL}) d
  ON d."City" = s.municipality AND d.state_code = s.state_code
""")
def mart_sites(spark, sf):
    return layers.mart_sites(demographics(spark, sf), sites(spark, sf))


def _readings_sql(condition: str) -> str:
    return f"""
SELECT c."City", c."State", CAST(dt AS DATE) AS date, CAST(year(CAST(dt AS DATE)) AS INTEGER)
         AS year, CAST(month(CAST(dt AS DATE)) AS INTEGER) AS month,
       AverageTemperature AS "AverageTemperature",
       AverageTemperatureUncertainty AS "AverageTemperatureUncertainty"
FROM (SELECT *, round(Latitude) AS r_lat, round(Longitude) AS r_lon
      FROM ({views.READINGS_SQL})) r
JOIN (SELECT *, round(latitude) AS c_lat, -round(longitude) AS c_lon FROM ({CITIES_SQL})) c
  ON r.City = c."City" AND {condition}
"""


@query("mart_readings", _readings_sql(
    "r_lat BETWEEN c_lat - 4 AND c_lat + 4 AND r_lon BETWEEN c_lon - 4 AND c_lon + 4"
))
def mart_readings(spark, sf):
    cities = layers.mart_cities(demographics(spark, sf), sites(spark, sf))
    return layers.mart_readings(readings(spark, sf), cities)


@query("mart_readings_literal", _readings_sql("c_lat IS NOT NULL AND c_lon IS NOT NULL"))
def mart_readings_literal(spark, sf):
    """Bounds joined by OR: position matters only in that it must be known."""
    cities = layers.mart_cities(demographics(spark, sf), sites(spark, sf))
    return layers.mart_readings(readings(spark, sf), cities, literal_bounds=True)


@query("mart_demographics", f"SELECT {DEMOGRAPHIC_COLUMNS} FROM ({views.DEMOGRAPHICS_SQL})")
def mart_demographics(spark, sf):
    """Stored by state and city, read back."""
    root = scratch_path(spark, "mart-demographics")
    rows = layers.mart_demographics(demographics(spark, sf))
    write_parquet(rows, root, layers.PARTITIONS["city_demographics"])
    return _shown(spark.read.schema(rows.schema).parquet(root))


@query("mart_arrival_facts", f"""
SELECT cic_id, year, month, city, state, airline, flight_number, arrival_date, departure_date,
       last_departure, transport, citizen_country AS coming_from, visa AS reason
FROM ({views.ARRIVALS_SQL})
""")
def mart_arrival_facts(spark, sf):
    return layers.mart_arrival_facts(arrivals(spark, sf))


@query("mart_person_facts", f"""
SELECT cic_id, year, month, citizen_country, residence_country, city AS city_of_arrival,
       state AS state_of_arrival, age, birth_year, gender, visa AS reason
FROM ({views.ARRIVALS_SQL})
""")
def mart_person_facts(spark, sf):
    return layers.mart_person_facts(arrivals(spark, sf))


DESTINATIONS_SQL = f"""
SELECT a.arrival_date, a.year, a.cic_id, a.citizen_country, a.residence_country, a.visa, a.age,
       d."City", d."State", d.total_population, d.median_age, d.avg_household_size,
       {", ".join("d." + s for s in views.SEGMENTS.values())}
FROM ({views.ARRIVALS_SQL}) a JOIN ({views.DEMOGRAPHICS_SQL}) d
  ON {views.initcap_sql("a.city")} = d."City"
"""


@query("mart_destinations", DESTINATIONS_SQL)
def mart_destinations(spark, sf):
    """Matched by city name only."""
    return _shown(layers.mart_destinations(
        arrivals(spark, sf), demographics(spark, sf), races=views.SEGMENTS
    ))


@query("mart_destinations_by_state", DESTINATIONS_SQL + f"""
  AND {views.initcap_sql("a.state")} = d."State"
""")
def mart_destinations_by_state(spark, sf):
    return _shown(layers.mart_destinations(
        arrivals(spark, sf), demographics(spark, sf), ("city", "state"), views.SEGMENTS
    ))


def _label_document(spark, sf):
    """The label document of the job: one paragraph per nation, region and fixed list."""
    mappings = views.mappings(spark, sf)
    quoted = {"port": "i94prtl", "state": "i94addrl", "country": "i94cntyl"}
    bare = {"mode": "i94model", "visa": "I94VISA"}
    texts = None
    for roles, mark in ((quoted, "'"), (bare, "")):
        for role, name in roles.items():
            lines = mappings[role].select(F.concat(
                F.lit(f"/* codes of {role} */\nvalue {name}\n   {mark}"), F.col("code"),
                F.lit(f"{mark} = '"), F.col("label"), F.lit("'\n;"),
            ).alias("value"))
            texts = lines if texts is None else texts.unionByName(lines)
    return texts


@query("run_layers", f"""
WITH a AS ({views.ARRIVALS_SQL}), d AS ({views.DEMOGRAPHICS_SQL}), s AS ({views.SITES_SQL}),
     t AS ({_readings_sql(
    "r_lat BETWEEN c_lat - 4 AND c_lat + 4 AND r_lon BETWEEN c_lon - 4 AND c_lon + 4")}),
     p AS (SELECT 1 FROM s FULL JOIN d ON d."City" = s.municipality AND d.state_code = s.state_code)
SELECT 'cities' AS table_name, count(*) AS row_count, true AS passed FROM d
UNION ALL SELECT 'airports', count(*), true FROM p
UNION ALL SELECT 'temperatures', count(*), true FROM t
UNION ALL SELECT 'city_demographics', count(*), true FROM d
UNION ALL SELECT 'immigration_info', count(*), true FROM a
UNION ALL SELECT 'immigrants_info', count(*), true FROM a
UNION ALL SELECT 'destinations_info', count(*), true FROM ({DESTINATIONS_SQL})
""")
def run_layers(spark, sf):
    """Raw files of all five kinds, then every layer; one row per presentation table."""
    root = scratch_path(spark, "layers")
    raw = f"{root}/raw"
    write_parquet(views.raw_arrivals(spark, sf), f"{raw}/arrivals")
    write_text(_label_document(spark, sf), f"{raw}/labels")
    write_csv(views.raw_readings(spark, sf), f"{raw}/temperatures")
    write_csv(views.raw_demographics(spark, sf), f"{raw}/demographics", sep=";")
    write_csv(views.raw_sites(spark, sf), f"{raw}/airports")
    return runs.run_layers(
        spark, root, f"{raw}/arrivals", f"{raw}/labels", f"{raw}/temperatures",
        f"{raw}/demographics", f"{raw}/airports", races=views.SEGMENTS,
    )
