import pytest

from tarn.functions import compat
from tarn.session import LakehouseSession

CASES = {
    "gcd(12, 18)": 6, "lcm(4, 6)": 12, "lcm(0, 6)": 0, "iszero(0D)": True, "starts_with('abc', 'a')": True, "ends_with('abc', 'c')": True, "strpos('abc', 'b')": 2, "substr_index('a.b.c', '.', 2)": "a.b", "to_hex(255L)": "ff",
    "regexp_match('a1b2', '[0-9]')": ["1", "2"], "regexp_match('ab', '[0-9]')": None, "date_bin(interval 15 minutes, timestamp'2020-01-01 00:17:00', timestamp'2020-01-01 00:05:00') = timestamp'2020-01-01 00:05:00'": True,
    "datetrunc('hour', timestamp'2020-01-01 05:17:00') = timestamp'2020-01-01 05:00:00'": True, "today() = current_date()": True, "to_unixtime(timestamp'1970-01-01 00:01:00')": 60, "to_timestamp_seconds(60L) = timestamp'1970-01-01 00:01:00'": True,
    "to_timestamp_millis(60000L) = timestamp'1970-01-01 00:01:00'": True, "to_timestamp_micros(60000000L) = timestamp'1970-01-01 00:01:00'": True, "to_timestamp_nanos(60000000000L) = timestamp'1970-01-01 00:01:00'": True,
    "array_length(array('a', 'b'))": 2, "array_empty(array())": True, "array_has(array('a'), 'a')": True, "array_has_all(array('a', 'b'), array('a'))": True, "array_has_any(array('a'), array('b'))": False, "array_indexof(array('a', 'b'), 'b')": 2,
    "array_indexof(array('a'), 'z')": None, "array_positions(array('a', 'b', 'a'), 'a')": [1, 3], "array_push_back(array('a'), 'b')": ["a", "b"], "array_push_front('b', array('a'))": ["b", "a"], "array_pop_back(array('a', 'b'))": ["a"],
    "array_pop_front(array('a', 'b'))": ["b"], "array_element(array('a', 'b'), 2)": "b", "array_remove_all(array('a', 'b', 'a'), 'a')": ["b"], "array_replace_all(array('a', 'b'), 'a', 'c')": ["c", "b"], "array_reverse(array('a', 'b'))": ["b", "a"],
    "array_any_value(array(cast(null as string), 'x'))": "x", "array_distance(array(0D, 0D), array(3D, 4D))": 5.0, "array_to_string(array('a', 'b'), '-')": "a-b", "string_to_array('a.b', '.')": ["a", "b"], "map_extract(map('a', 'b'), 'a')": ["b"],
    "generate_series(1L, 3L)": [1, 2, 3], "sha224('a') = sha2('a', 224)": True, "sha384('a') = sha2('a', 384)": True, "sha512('a') = sha2('a', 512)": True, "digest('a', 'md5') = md5('a')": True, "arrow_typeof('a')": "string", "trunc_number(-1.5D)": -1.0,
    "log_10(100D)": 2.0,
}


@pytest.mark.parametrize("text", list(CASES))
def test_function(spark, text):
    got = LakehouseSession(spark, compatibility=True).sql(f"SELECT {text}").first()[0]
    assert got == CASES[text]


def test_registering_twice_is_harmless(spark):
    compat.register(spark)
    assert compat.register(spark, ["gcd"]) in ([], ["gcd"])


def test_configuration(spark):
    lake = LakehouseSession(spark)
    key = "delta.retention_duration_check.enabled"
    assert lake.conf(key) == "true" and lake.conf("delta.enable_caching") == "false" and lake.conf("unity.uri") is None
    for name in (key, "delta.retentionDurationCheck.enabled"):
        spark.conf.set(f"spark.lakehouse.{name}", "false")
        assert lake.conf(key) == "false"
        spark.conf.unset(f"spark.lakehouse.{name}")


def test_any_type(spark):
    from tarn.session import LakehouseSession

    lake = LakehouseSession(spark, compatibility=True)
    one = lambda text: lake.sql(f"SELECT {text} AS x").first().x
    for text, want in {
        "array_length(array(1, 2))": 2, "array_has(make_array(1, 2), 2)": True, "array_positions(array(1, 2, 1), 1)": [1, 3], "array_slice(array(1, 2, 3, 4), 2, 3)": [2, 3], "array_resize(array(1, 2), 4, 9)": [1, 2, 9, 9],
        "array_resize(array(1, 2), 1, 9)": [1], "array_ndims(array(array(1)))": 2, "array_dims(array(1, 2))": [2], "array_concat(array(1), array(2.5D))": [1.0, 2.5], "array_replace(array(1, 2, 1), 1, 7)": [7, 2, 1],
        "array_replace_n(array(1, 1, 1), 1, 7, 2)": [7, 7, 1], "array_remove_n(array(1, 2, 1, 1), 1, 2)": [2, 1], "array_push_front(0, array(1))": [0, 1], "array_pop_front(array(1, 2))": [2], "array_pop_back(array(1, 2))": [1], "array_empty(array())": True,
        "array_has_all(array(1, 2, 3), array(1, 3))": True, "array_any_value(array(null, 2))": 2, "arrow_cast('12', 'Int64')": 12, "get_field(named_struct('a,b', 1, 'c', 2), 'c')": 2, "make_map('k', 1)": {"k": 1}, "map_extract(map('k', 5), 'k')": [5],
        "array_indexof(array('a', 'b'), 'b')": 2, "array_replace_all(array_slice(array(1, 1, 2), 1, 2), 1, 3)": [3, 3], "'array_empty(x)'": "array_empty(x)", "array_reverse(array(1, 2))": [2, 1], "arrow_typeof(1)": "int",
    }.items():
        assert one(text) == want, text
    rows = lake.sql("SELECT var(x) AS a, var_sample(x) AS b, var_population(x) AS c, approx_distinct(x) AS d, approx_median(x) AS e, approx_percentile_cont(x, 0.5) AS f, quantile_cont(x, 0.5) AS g FROM VALUES (1), (2), (3), (6) AS t(x)").first()
    assert (round(rows.a, 6), round(rows.b, 6), rows.c, rows.d, rows.e, rows.f, rows.g) == (4.666667, 4.666667, 3.5, 4, 2, 2, 2.5)
    assert [r.x for r in lake.sql("SELECT unnest(array(4, 5)) AS x").collect()] == [4, 5]
