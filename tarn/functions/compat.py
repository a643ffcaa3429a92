"""Functions of the reference's host SQL that Spark lacks. Catalyst works on all of them, no Python runs.

ALIASES are other names of Spark's own functions, of any type. FUNCTIONS are SQL functions; their parameters have one type.
MACROS stand for expressions of any type; `expanded` puts these in a statement's place, as sessions do for each statement.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

#: name: Spark's name
ALIASES = {
    "var": "var_samp", "var_sample": "var_samp", "var_population": "var_pop", "stddev_sample": "stddev_samp", "stddev_population": "stddev_pop", "approx_distinct": "approx_count_distinct", "approx_percentile_cont": "percentile_approx",
    "quantile_cont": "percentile", "make_array": "array", "make_list": "array", "make_map": "map", "array_concat": "concat", "array_cat": "concat", "list_concat": "concat", "unnest": "explode", "array_length": "size", "list_length": "size",
    "array_has": "array_contains", "list_has": "array_contains", "array_has_any": "arrays_overlap", "list_has_any": "arrays_overlap", "array_push_back": "array_append", "list_append": "array_append", "array_reverse": "reverse",
    "list_sort": "array_sort", "list_distinct": "array_distinct", "list_union": "array_union", "list_intersect": "array_intersect", "list_except": "array_except", "array_to_string": "array_join", "list_to_string": "array_join",
    "arrow_typeof": "typeof", "array_element": "try_element_at", "list_element": "try_element_at", "starts_with": "startswith", "ends_with": "endswith", "strpos": "instr", "datetrunc": "date_trunc", "to_unixtime": "unix_seconds",
    "generate_series": "sequence", "substr_index": "substring_index",
}

#: name: how many arguments, expression with {0}, {1} ... for them
MACROS = {
    "approx_median": (1, "percentile_approx({0}, 0.5)"),
    "get_field": (2, "({0})[{1}]"),
    "array_empty": (1, "(size({0}) = 0)"),
    "empty": (1, "(size({0}) = 0)"),
    "array_has_all": (2, "(size(array_except({1}, {0})) = 0)"),
    "list_has_all": (2, "(size(array_except({1}, {0})) = 0)"),
    "array_indexof": (2, "nullif(array_position({0}, {1}), 0L)"),
    "list_indexof": (2, "nullif(array_position({0}, {1}), 0L)"),
    "array_positions": (2, "filter(transform({0}, (e, i) -> if(e <=> {1}, i + 1, null)), i -> i is not null)"),
    "list_positions": (2, "filter(transform({0}, (e, i) -> if(e <=> {1}, i + 1, null)), i -> i is not null)"),
    "array_push_front": (2, "array_prepend({1}, {0})"),
    "list_prepend": (2, "array_prepend({1}, {0})"),
    "array_pop_back": (1, "slice({0}, 1, greatest(size({0}) - 1, 0))"),
    "array_pop_front": (1, "slice({0}, 2, greatest(size({0}) - 1, 0))"),
    "array_slice": (3, "slice({0}, {1}, greatest({2} - {1} + 1, 0))"),
    "list_slice": (3, "slice({0}, {1}, greatest({2} - {1} + 1, 0))"),
    "array_resize": (3, "slice(concat({0}, array_repeat({2}, greatest({1} - size({0}), 0))), 1, {1})"),
    "list_resize": (3, "slice(concat({0}, array_repeat({2}, greatest({1} - size({0}), 0))), 1, {1})"),
    "array_ndims": (1, "regexp_count(regexp_extract(typeof({0}), '^(array<)+', 0), 'array<')"),
    "list_ndims": (1, "regexp_count(regexp_extract(typeof({0}), '^(array<)+', 0), 'array<')"),
    "array_dims": (1, "array(size({0}))"),
    "list_dims": (1, "array(size({0}))"),
    "array_replace": (3, "transform({0}, (e, i) -> if(i + 1 = array_position({0}, {1}), {2}, e))"),
    "list_replace": (3, "transform({0}, (e, i) -> if(i + 1 = array_position({0}, {1}), {2}, e))"),
    "array_replace_n": (4, "transform({0}, (e, i) -> if(e <=> {1} and size(filter(slice({0}, 1, i), x -> x <=> {1})) < {3}, {2}, e))"),
    "array_replace_all": (3, "transform({0}, e -> if(e <=> {1}, {2}, e))"),
    "array_remove_n": (3, "filter({0}, (e, i) -> not (e <=> {1} and size(filter(slice({0}, 1, i), x -> x <=> {1})) < {2}))"),
    "array_remove_all": (2, "filter({0}, e -> not (e <=> {1}))"),
    "array_any_value": (1, "get(filter({0}, e -> e is not null), 0)"),
    "array_max_value": (1, "array_max({0})"),
    "map_extract": (2, "array(try_element_at({0}, {1}))"),
    "arrow_cast": (2, None),
}
# Names of Arrow types.
ARROW = {
    "boolean": "BOOLEAN", "int8": "TINYINT", "int16": "SMALLINT", "int32": "INT", "int64": "BIGINT", "uint8": "SMALLINT", "uint16": "INT", "uint32": "BIGINT", "uint64": "DECIMAL(20,0)", "float16": "FLOAT", "float32": "FLOAT",
    "float64": "DOUBLE", "utf8": "STRING", "largeutf8": "STRING", "utf8view": "STRING", "binary": "BINARY", "largebinary": "BINARY", "date32": "DATE", "date64": "DATE",
}

#: name: (parameters, result type, expression)
FUNCTIONS = {
    "gcd": ("a BIGINT, b BIGINT", "BIGINT", "abs(aggregate(sequence(1, 96), named_struct('x', a, 'y', b), (s, i) -> named_struct('x', if(s.y = 0, s.x, s.y), 'y', if(s.y = 0, 0L, s.x % s.y)), s -> s.x))"),
    "lcm": ("a BIGINT, b BIGINT", "BIGINT", "if(a = 0 or b = 0, 0L, abs(a div abs(aggregate(sequence(1, 96), named_struct('x', a, 'y', b), (s, i) -> named_struct('x', if(s.y = 0, s.x, s.y), 'y', if(s.y = 0, 0L, s.x % s.y)), s -> s.x)) * b))"),
    "iszero": ("x DOUBLE", "BOOLEAN", "x = 0"),
    "to_hex": ("n BIGINT", "STRING", "lower(hex(n))"),
    "regexp_match": ("s STRING, p STRING", "ARRAY<STRING>", "nullif(regexp_extract_all(s, p, 0), array())"),
    "date_bin": ("step INTERVAL DAY TO SECOND, ts TIMESTAMP, origin TIMESTAMP", "TIMESTAMP", "timestamp_micros(unix_micros(ts) - pmod(unix_micros(ts) - unix_micros(origin), unix_micros(timestamp'1970-01-01 00:00:00Z' + step)))"),
    "today": ("", "DATE", "current_date()"),
    "to_local_time": ("ts TIMESTAMP", "TIMESTAMP_NTZ", "cast(ts as timestamp_ntz)"),
    "to_timestamp_seconds": ("n BIGINT", "TIMESTAMP", "timestamp_seconds(n)"),
    "to_timestamp_millis": ("n BIGINT", "TIMESTAMP", "timestamp_millis(n)"),
    "to_timestamp_micros": ("n BIGINT", "TIMESTAMP", "timestamp_micros(n)"),
    "to_timestamp_nanos": ("n BIGINT", "TIMESTAMP", "timestamp_micros(floor(n / 1000))"),
    "array_distance": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE", "sqrt(aggregate(zip_with(a, b, (x, y) -> (x - y) * (x - y)), 0D, (s, v) -> s + v))"),
    "string_to_array": ("s STRING, d STRING", "ARRAY<STRING>", "split(s, '\\\\Q' || d || '\\\\E')"),
    "sha224": ("s STRING", "STRING", "sha2(s, 224)"),
    "sha256": ("s STRING", "STRING", "sha2(s, 256)"),
    "sha384": ("s STRING", "STRING", "sha2(s, 384)"),
    "sha512": ("s STRING", "STRING", "sha2(s, 512)"),
    "digest": ("s STRING, kind STRING", "STRING", "case lower(kind) when 'md5' then md5(s) when 'sha224' then sha2(s, 224) when 'sha256' then sha2(s, 256) when 'sha384' then sha2(s, 384) when 'sha512' then sha2(s, 512) end"),
    "trunc_number": ("x DOUBLE", "DOUBLE", "if(x < 0, ceil(x), floor(x))"),
    "log_10": ("x DOUBLE", "DOUBLE", "log10(x)"),
}


def register(spark: SparkSession, names=None) -> list[str]:
    """Temporary functions of the session; one that exists already under a name is left as it is."""
    have = {r[0].rsplit(".", 1)[-1].lower() for r in spark.sql("SHOW FUNCTIONS").collect()}
    done = []
    known = spark._jsparkSession.sessionState().functionRegistry()
    named = spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier
    for name, own in ALIASES.items():
        if (names is None or name in names) and name not in have:
            known.createOrReplaceTempFunction(name, known.lookupFunctionBuilder(named(own)).get(), "built-in")
            done.append(name)
    for name, (parameters, result, body) in FUNCTIONS.items():
        if (names is None or name in names) and name not in have:
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
            done.append(name)
    return done


_CALL = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|\b(" + "|".join(MACROS) + r")\s*\(", re.S | re.I)
_PART = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|[(\[]|[)\]]|,", re.S)


def _arguments(text: str, at: int) -> tuple[list[str], int] | None:
    """The arguments of a call whose bracket opens before `at`, and where it ends."""
    depth, begin, out = 1, at, []
    for m in _PART.finditer(text, at):
        if m[0] in "([":
            depth += 1
        elif m[0] in ")]":
            depth -= 1
            if not depth:
                return [*out, text[begin : m.start()].strip()], m.end()
        elif m[0] == "," and depth == 1:
            out.append(text[begin : m.start()].strip())
            begin = m.end()
    return None


def expanded(text: str) -> str:
    """The statement with each macro's expression in its place. A call with another number of arguments stays as it is."""
    out, at = [], 0
    for m in _CALL.finditer(text):
        if m.start() < at or not m[1]:
            continue
        found = _arguments(text, m.end())
        count, body = MACROS[m[1].lower()]
        if found is None or len(found[0]) != count:
            continue
        given = [expanded(x) for x in found[0]]
        if body is None:
            kind = ARROW.get(given[1].strip("'\"").lower())
            if kind is None:
                continue
            new = f"cast({given[0]} AS {kind})"
        else:
            new = body.format(*given)
        out += (text[at : m.start()], new)
        at = found[1]
    return "".join((*out, text[at:]))
