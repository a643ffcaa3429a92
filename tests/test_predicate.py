from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarn.operators import evaluate
from tarn.operators import schema as schemas
from tarn.plans import predicate as p


def test_junctions_flatten():
    a, b, c, d = (p.eq(p.col(x), p.lit(1)) for x in "abcd")
    assert len(p.conjunction([a, b & c, d]).of) == 4
    e = p.flatten((a & b) | (b & (c & d)))
    assert e.op == "or" and [len(x.of) for x in e.of] == [2, 3]
    assert p.conjunction([]) == p.Lit(True, T.BooleanType())
    assert p.flatten(p.Junction("or", ())) == p.Lit(False, T.BooleanType())
    assert p.conjunction([a]) == a


def test_not_is_pushed_to_leaves():
    a, b = p.eq(p.col("a"), p.lit(1)), p.lt(p.col("b"), p.lit(2))
    assert p.push_not(~(a & ~b)) == p.Junction("or", (p.Not(a), b))


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a = 1 and b < 'x'", p.eq(p.col("a"), p.lit(1, T.IntegerType())) & p.lt(p.col("b"), p.lit("x", T.StringType()))),
        ("a.b >= 2", p.ge(p.col("a.b"), p.lit(2, T.IntegerType()))),
        ("a is not null", p.Not(p.IsNull(p.col("a")))),
        ("not a <=> b", p.distinct(p.col("a"), p.col("b"))),
        ("a in (1, 2)", p.In(p.col("a"), (p.lit(1, T.IntegerType()), p.lit(2, T.IntegerType())))),
        ("a != 1", p.ne(p.col("a"), p.lit(1, T.IntegerType()))),
    ],
)
def test_from_sql(spark, text, want):
    got = p.parse(spark, text)
    assert got == want or got == p.flatten(want) or (text.startswith("not") and got == p.Not(p.Not(want)))


def test_unknown_parts_stay_text(spark):
    e = p.parse(spark, "a like 'x%' and b = 1")
    assert isinstance(e.of[0], p.Unknown)
    df = spark.createDataFrame([("xy", 1), ("z", 1)], "a string, b int")
    assert df.where(p.to_column(e)).count() == 1


@pytest.mark.parametrize(
    ("value", "kind"),
    [
        (True, T.BooleanType()), ("s", T.StringType()), (1, T.ByteType()), (2, T.ShortType()), (3, T.IntegerType()), (4, T.LongType()), (1.5, T.FloatType()), (2.5, T.DoubleType()), (datetime(2020, 1, 2), T.TimestampNTZType()),
        (date(2020, 1, 2), T.DateType()), (b"x", T.BinaryType()), (Decimal("1.25"), T.DecimalType(10, 2)), (None, T.LongType()), ([1, 2], T.ArrayType(T.IntegerType())), ({"a": 1}, T.MapType(T.StringType(), T.IntegerType())),
    ],
)
def test_literals(spark, value, kind):
    df = spark.range(1).select(p.to_column(p.lit(value, kind)).alias("x"))
    assert df.schema["x"].dataType.simpleString() == kind.simpleString()
    got = df.first().x
    assert (bytes(got) if isinstance(value, bytes) else got) == value


def test_struct_literal(spark):
    kind = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    assert spark.range(1).select(p.to_column(p.lit((1, "x"), kind)).alias("s")).first().s.asDict() == {"a": 1, "b": "x"}


SCHEMA = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], SCHEMA)


def test_evaluators(rows, spark):
    run = lambda e, t: [r[0] for r in evaluate.ExpressionEvaluator(SCHEMA, e, t).evaluate(rows).collect()]
    assert run(p.Arith("+", p.col("a"), p.lit(1)), T.IntegerType()) == [2, 3, None]
    assert run(p.lit(42), T.IntegerType()) == [42, 42, 42]
    assert run(p.Arith("/", p.col("a"), p.lit(2)), T.IntegerType()) == [0, 1, None]
    out = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.StringType())])
    assert evaluate.ExpressionEvaluator(SCHEMA, p.Struct((p.col("a"), p.col("b"))), out).evaluate(rows).columns == ["x", "y"]
    late = evaluate.ExpressionEvaluator(SCHEMA, p.col("nowhere"), T.IntegerType())
    with pytest.raises(Exception, match="nowhere"):
        late.evaluate(rows).collect()
    assert [r[0] for r in evaluate.PredicateEvaluator(SCHEMA, p.gt(p.col("a"), p.lit(1))).evaluate(rows).collect()] == [False, True, None]
    assert list(evaluate.null_row(spark, SCHEMA).first()) == [None, None]


def test_empty_column_name():
    with pytest.raises(ValueError, match="empty"):
        p.Col(())


leaf = st.builds(lambda op, v: p.Cmp(op, p.col("x"), p.lit(v)), st.sampled_from("=<>"), st.integers(-2, 6)) | st.just(p.IsNull(p.col("x"))) | st.builds(lambda v: p.In(p.col("x"), tuple(map(p.lit, v))), st.lists(st.integers(-2, 6), min_size=1, max_size=3))
trees = st.recursive(leaf, lambda t: st.builds(p.Not, t) | st.builds(lambda a, b: a & b, t, t) | st.builds(lambda a, b: a | b, t, t), max_leaves=5)


@settings(max_examples=40, deadline=None)
@given(trees, st.lists(st.one_of(st.none(), st.integers(0, 4)), min_size=1, max_size=5))
def test_a_skipped_file_holds_no_match(spark, tree, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    held = [v for v in values if v is not None]
    low, high = (F.lit(min(held)), F.lit(max(held))) if held else (F.lit(None).cast("int"), F.lit(None).cast("int"))
    bounds = lambda path: (low, high, F.lit(len(values) - len(held)), F.lit(len(values)))
    may = spark.range(1).select(p.may_match(tree, bounds).alias("m")).first().m
    assert may or df.where(p.to_column(tree)).count() == 0


def test_apply_schema(spark):
    df = spark.createDataFrame([(1, (2, "3"), [(4,)], {"k": (5,)}, None)], "a int, s struct<x: int, y: string>, l array<struct<u: int>>, m map<string, struct<v: int>>, extra string")
    want = T.StructType(
        [
            T.StructField("m", T.MapType(T.StringType(), T.StructType([T.StructField("v", T.LongType()), T.StructField("w", T.LongType())]))),
            T.StructField("s", T.StructType([T.StructField("y", T.IntegerType()), T.StructField("z", T.DoubleType())])),
            T.StructField("l", T.ArrayType(T.StructType([T.StructField("t", T.StringType()), T.StructField("u", T.LongType())]))),
            T.StructField("a", T.LongType()),
            T.StructField("new", T.StringType()),
        ]
    )
    got = schemas.apply_schema(df, want)
    assert got.columns == ["m", "s", "l", "a", "new"]
    assert got.first().asDict(True) == {"m": {"k": {"v": 5, "w": None}}, "s": {"y": 3, "z": None}, "l": [{"t": None, "u": 4}], "a": 1, "new": None}


def test_apply_schema_errors(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(schemas.SchemaMismatch, match="missing"):
        schemas.apply_schema(df, T.StructType([T.StructField("c", T.ArrayType(T.LongType()), False)]))
    with pytest.raises(schemas.SchemaMismatch):
        schemas.apply_schema(df, T.StructType([T.StructField("a", T.StructType())]))
    assert schemas.apply_schema(spark.createDataFrame([("x",)], "a string"), T.StructType([T.StructField("a", T.IntegerType())])).first().a is None


def test_nested_field():
    level = T.StructType([T.StructField("level2", T.StructType([T.StructField("level3", T.StructType([T.StructField("leaf", T.IntegerType())]))]))])
    assert schemas.nested_field(level, "level2.level3.leaf") == T.IntegerType()
    for wrong in ("", "level2.other", "level2.level3.leaf.x"):
        with pytest.raises(schemas.SchemaMismatch):
            schemas.nested_field(level, wrong)
