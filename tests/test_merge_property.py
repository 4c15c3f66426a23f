"""Properties of MERGE, the pre-merge sample and the airport dimension."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flightlens.operators.dims import airport_dimension
from flightlens.operators.enrich import with_countries
from flightlens.operators.store import merge_matched

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.lists(st.integers(0, 40), min_size=1, max_size=25, unique=True)
values = st.one_of(st.none(), st.integers(-5, 5))


@SETTINGS
@given(target_keys=keys, source_keys=keys, data=st.data())
def test_merge_keeps_unmatched_rows_and_takes_source_values(spark, target_keys, source_keys, data):
    target_rows = [(f"k{k:03d}", data.draw(values), data.draw(values)) for k in target_keys]
    source_rows = [(f"k{k:03d}", data.draw(values)) for k in source_keys]
    target = spark.createDataFrame(target_rows, "id string, keep int, v int")
    source = spark.createDataFrame(source_rows, "id string, v int")
    merged = {r.id: (r.keep, r.v) for r in merge_matched(target, source, "id", ["v"]).collect()}
    src = dict(source_rows)
    expected = {i: (keep, src[i] if i in src else v) for i, keep, v in target_rows}
    assert merged == expected  # no row added or dropped; NULL source values overwrite


countries = st.sampled_from(["", None, "A", "B", "C"])


@SETTINGS
@given(airports=st.lists(st.tuples(st.integers(0, 15), countries), min_size=1, max_size=20),
       repeat=st.lists(st.integers(0, 19), max_size=10),
       flights=st.lists(st.tuples(st.integers(0, 17), st.integers(0, 17)), min_size=1, max_size=20))
def test_repeated_airport_rows_change_nothing(spark, airports, repeat, flights):
    rows = [(f"A{i}", f"name{i}", c) for i, c in airports]
    repeated = rows + [rows[j % len(rows)] for j in repeat]
    schema = "id string, airport_name string, country_name string"
    once = airport_dimension(spark.createDataFrame(rows, schema))
    again = airport_dimension(spark.createDataFrame(repeated, schema))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    fl = spark.createDataFrame([(f"f{n}", f"A{d}", f"A{a}") for n, (d, a) in enumerate(flights)],
                               "fid string, dep_icao string, arr_icao string")
    cols = ["fid", "departure_country", "arrival_country"]
    a = with_countries(fl, once).select(*cols).collect()
    b = with_countries(fl, again).select(*cols).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
