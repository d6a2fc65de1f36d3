import datetime as dt

import pytest

from starloom.plans import layers
from starloom.sources import inline_mapping


@pytest.fixture(scope="module")
def mappings(spark):
    return {
        "country": inline_mapping(spark, {"101": "ALBANIA", "582": "MEXICO", "bad": "NONE"}),
        "port": inline_mapping(spark, {"ATL": "ATLANTA, GA", "WAS": "WASHINGTON DC"}),
        "mode": inline_mapping(spark, {"1": "Air"}),
        "state": inline_mapping(spark, {"GA": "GEORGIA"}),
        "visa": inline_mapping(spark, {"2": "Pleasure"}),
    }


@pytest.fixture(scope="module")
def arrivals(spark, mappings):
    raw = spark.createDataFrame(
        [
            (1.0, 2016.0, 4.0, "ATL", "GA", 1.0, 2.0, 582.0, 101.0, 25.0, 1991.0, "LH1", 7.0, "LH", "F",
             20573.0, 20583.0, "10282016"),
            (2.0, 2016.0, 4.0, "XXX", None, 9.0, None, 999.0, 582.0, None, None, None, None, None, None,
             20573.0, None, "D/S"),
        ],
        "cicid double, i94yr double, i94mon double, i94port string, i94addr string, i94mode double, "
        "i94visa double, i94res double, i94cit double, i94bir double, biryear double, fltno string, "
        "admnum double, airline string, gender string, arrdate double, depdate double, dtaddto string",
    )
    return layers.clean_arrivals(raw, mappings)


def test_arrivals(arrivals):
    one, two = arrivals.orderBy("cic_id").collect()
    assert one["arrival_date"] == dt.date(2016, 4, 29)
    assert one["departure_date"] == dt.date(2016, 5, 9)
    assert one["last_departure"] == dt.date(2016, 10, 28)
    assert (one["transport"], one["visa"], one["state"]) == ("Air", "Pleasure", "GEORGIA")
    assert (one["citizen_country"], one["residence_country"]) == ("ALBANIA", "MEXICO")
    assert (one["city_code"], one["city"]) == ("ATL", "ATLANTA")
    # Unknown codes, missing days and bad dates give null and lose no row.
    for name in ("transport", "visa", "state", "residence_country", "city", "departure_date",
                 "last_departure"):
        assert two[name] is None
    assert two["residence_country_code"] == 999.0
    assert "transport_code" not in arrivals.columns and "visa_code" not in arrivals.columns


@pytest.fixture(scope="module")
def demographics(spark):
    names = ["City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
             "Number of Veterans", "Foreign-born", "Average Household Size", "State Code", "Race", "Count"]
    raw = spark.createDataFrame(
        [
            ("Atlanta", "Georgia", "33.8", "1", "2", "3", "4", "5", "2.2", "GA", "White", "100"),
            ("Atlanta", "Georgia", "33.8", "1", "2", "3", "4", "5", "2.2", "GA", "Asian", "20"),
            ("Springfield", "Ohio", "40", "1", "2", "3", "4", "5", "2.2", "OH", "White", "7"),
            ("Springfield", "Illinois", "41", "1", "2", "3", "4", "5", "2.2", "IL", "White", "8"),
        ],
        ", ".join(f"`{n}` string" for n in names),
    )
    return layers.clean_demographics(raw)


def test_demographics(demographics, rows):
    got = rows(demographics, "City", "State", "median_age", "white", "asian", "hispanic_latino")
    assert [(r[0], r[1], round(r[2], 1), *r[3:]) for r in got] == [
        ("Atlanta", "Georgia", 33.8, 100, 20, None),
        ("Springfield", "Illinois", 41.0, 8, None, None),
        ("Springfield", "Ohio", 40.0, 7, None, None),
    ]


@pytest.fixture(scope="module")
def sites(spark):
    raw = spark.createDataFrame(
        [
            ("00A", "heliport", "One", "11", "NA", "US", "US-GA", "Atlanta", None, None, "x", "-84.0, 33.0"),
            ("00B", "heliport", "Two", "11", "NA", "US", "US-GA", "Atlanta", None, "I", "x", "-85.0, 34.0"),
            ("00C", "heliport", "Lost", "11", "NA", "US", "US-TX", "Nowhere", None, None, "x", "bad"),
            ("CA1", "heliport", "Far", "11", "NA", "CA", "CA-ON", "Atlanta", None, None, "x", "1, 2"),
        ],
        "ident string, type string, name string, elevation_ft string, continent string, iso_country string, "
        "iso_region string, municipality string, gps_code string, iata_code string, local_code string, "
        "coordinates string",
    )
    return layers.clean_sites(raw)


def test_sites_and_cities(demographics, sites, rows):
    assert rows(sites, "id_local_code", "latitude", "longitude", "state_code") == [
        ("00A", 33.0, -84.0, "GA"), ("00B", 34.0, -85.0, "GA"), ("00C", None, None, "TX")
    ]
    cities = layers.mart_cities(demographics, sites)
    assert rows(cities) == [
        ("Atlanta", "Georgia", 33.5, -84.5),
        ("Springfield", "Illinois", None, None),
        ("Springfield", "Ohio", None, None),
    ]
    both = layers.mart_sites(demographics, sites)
    assert rows(both, "City", "State", "id_local_code") == [
        ("Atlanta", "Georgia", "00A"), ("Atlanta", "Georgia", "00B"),
        ("Springfield", "Illinois", None), ("Springfield", "Ohio", None), (None, None, "00C"),
    ]


def test_readings(spark, demographics, sites, rows):
    raw = spark.createDataFrame(
        [
            ("2000-01-01", "1.5", "0.1", "Atlanta", "United States", "33.60N", "84.20W"),
            ("2000-02-01", "2.5", "0.1", "Atlanta", "United States", "38.00N", "84.20W"),
            ("2000-03-01", "3.5", "0.1", "Atlanta", "United States", "38.60N", "84.20W"),
            ("bad", "4.5", "0.1", "Atlanta", "United States", "33.60N", "88.90W"),
            ("2000-05-01", "5.5", "0.1", "Springfield", "United States", "39.00N", "84.00W"),
            ("2000-06-01", "6.5", "0.1", "Atlanta", "Greece", "33.60N", "84.20W"),
        ],
        "dt string, AverageTemperature string, AverageTemperatureUncertainty string, City string, "
        "Country string, Latitude string, Longitude string",
    )
    readings = layers.clean_readings(raw)
    assert readings.count() == 5 and "Country" not in readings.columns
    cities = layers.mart_cities(demographics, sites)
    # The city is at (34, 85) in whole degrees: 38 is exactly four away, 39 is not.
    near = layers.mart_readings(readings, cities)
    assert rows(near, "date", "year", "month", "AverageTemperature") == [
        (None, None, None, "4.5"),
        (dt.date(2000, 1, 1), 2000, 1, "1.5"), (dt.date(2000, 2, 1), 2000, 2, "2.5"),
    ]
    literal = layers.mart_readings(readings, cities, literal_bounds=True)
    assert rows(literal, "AverageTemperature") == [("1.5",), ("2.5",), ("3.5",), ("4.5",)]
    # With west negative on both sides the same rows are near.
    signed = layers.clean_readings(raw, signed=True)
    assert rows(signed, "Longitude")[0] == (-84.0,)
    assert rows(layers.mart_readings(signed, cities, west_positive=False)) == rows(near)


def test_destinations(spark, arrivals, demographics, rows):
    got = layers.mart_destinations(arrivals, demographics)
    assert rows(got, "City", "State", "cic_id", "asian") == [("Atlanta", "Georgia", 1.0, 20)]
    # A name in two states matches both, unless the state counts too.
    going = spark.createDataFrame(
        [("SPRINGFIELD", "OHIO", None, 2016.0, 1.0, "c", "r", "v", 1.0)],
        "city string, state string, arrival_date date, year double, cic_id double, "
        "citizen_country string, residence_country string, visa string, age double",
    )
    assert rows(layers.mart_destinations(going, demographics), "State") == [("Illinois",), ("Ohio",)]
    exact = layers.mart_destinations(going, demographics, ("city", "state"))
    assert rows(exact, "State") == [("Ohio",)]


def test_facts(arrivals):
    facts = layers.mart_arrival_facts(arrivals)
    assert facts.columns[-2:] == ["coming_from", "reason"]
    people = layers.mart_person_facts(arrivals)
    assert {"city_of_arrival", "state_of_arrival", "residence_country"} <= set(people.columns)
