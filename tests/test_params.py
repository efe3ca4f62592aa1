import pytest
from pyspark.sql import functions as F

from touchline.functions.params import (
    float_param,
    int_param,
    register_param_functions,
    string_or_int_param,
    string_param,
)
from touchline.schema import EVENT_PARAMS

from helpers import param


@pytest.fixture(scope="module")
def params_df(spark):
    rows = [
        (1, [param("a", s="x"), param("n", i=5)]),
        (2, None),  # NULL array -> NULL
        (3, []),  # empty array -> NULL
        (4, [param("a", s="first"), param("a", s="second")]),  # duplicate key
        (5, [param("score", f=1.5)]),  # float only
        (6, [param("score", d=2.5)]),  # double only
        (7, [param("score", f=1.0, d=9.0)]),  # float wins
        (8, [param("engaged", s="1")]),
        (9, [param("engaged", i=0)]),
        (10, [param(None, s="nokey"), param("a", s="after-null-key")]),
    ]
    return spark.createDataFrame(rows, f"id int, event_params {EVENT_PARAMS.simpleString()}")


def _by_id(df, col):
    return {r[0]: r[1] for r in df.select("id", col.alias("v")).collect()}


def test_missing_null_and_empty(params_df):
    got = _by_id(params_df, string_param("a"))
    assert got[1] == "x"
    assert got[2] is None and got[3] is None
    assert _by_id(params_df, string_param("zzz"))[1] is None
    assert _by_id(params_df, int_param("n"))[1] == 5
    # a string param read as int gives NULL (typed field of the matched element)
    assert _by_id(params_df, int_param("a"))[1] is None


def test_duplicate_key_first_match_and_strict(params_df):
    assert _by_id(params_df, string_param("a"))[4] == "first"
    assert _by_id(params_df, string_param("a"))[10] == "after-null-key"
    strict = params_df.where(F.col("id") == 4).select(string_param("a", strict=True))
    with pytest.raises(Exception) as err:
        strict.collect()
    assert "more than once" in str(err.value)
    ok = params_df.where(F.col("id") == 1).select(string_param("a", strict=True).alias("v")).collect()
    assert ok[0].v == "x"


def test_float_falls_back_to_double(params_df):
    got = _by_id(params_df, float_param("score"))
    assert got[5] == 1.5 and got[6] == 2.5 and got[7] == 1.0 and got[1] is None


def test_string_or_int(params_df):
    got = _by_id(params_df, string_or_int_param("engaged"))
    assert got[8] == "1" and got[9] == "0" and got[1] is None


def test_sql_functions_match_column_helpers(spark, params_df):
    register_param_functions(spark)
    params_df.createOrReplaceTempView("params_t")
    sql = spark.sql("""SELECT id, extract_string_value(event_params, 'a') AS s,
                              extract_int_value(event_params, 'n') AS i,
                              extract_float_value(event_params, 'score') AS f FROM params_t""")
    api = params_df.select("id", string_param("a").alias("s"), int_param("n").alias("i"),
                           float_param("score").alias("f"))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, api.collect()))
    # SQL functions are inlined: no Python evaluation in the plan
    plan = sql._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_lookup_stays_in_codegen_without_lambda(params_df):
    plan = params_df.select(string_param("a"), int_param("n"))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan.lower()


from hypothesis import HealthCheck, given, settings, strategies as st

_keys = st.sampled_from(["a", "b", "c", None])
_entry = st.tuples(_keys, st.one_of(st.none(), st.text(max_size=3)), st.one_of(st.none(), st.integers(-5, 5)),
                   st.one_of(st.none(), st.floats(-1, 1)), st.one_of(st.none(), st.floats(-1, 1)))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.lists(_entry, max_size=5)), min_size=1, max_size=8))
def test_lookups_match_first_match_semantics(spark, arrays):
    rows = [(i, None if arr is None else [param(k, s=s, i=n, f=f, d=d) for k, s, n, f, d in arr])
            for i, arr in enumerate(arrays)]
    df = spark.createDataFrame(rows, f"id int, event_params {EVENT_PARAMS.simpleString()}")
    got = {r.id: (r.s, r.n, r.f) for r in
           df.select("id", string_param("a").alias("s"), int_param("b").alias("n"), float_param("c").alias("f")).collect()}

    def first(arr, key):
        for e in arr or []:
            if e[0] == key:
                return e
        return None

    for i, arr in enumerate(arrays):
        a, b, c = first(arr, "a"), first(arr, "b"), first(arr, "c")
        want = (a[1] if a else None, b[2] if b else None,
                (c[3] if c[3] is not None else c[4]) if c else None)
        assert got[i] == want, (arr, got[i], want)


def test_strict_lookup_is_lambda_free_and_flags_only_repeats(spark, params_df):
    ok = params_df.where(F.col("id") != 4).select("id", string_param("a", strict=True).alias("v"),
                                                   int_param("n", strict=True).alias("n"))
    assert {r.id: r.v for r in ok.collect()}[10] == "after-null-key"
    plan = ok._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan.lower()
