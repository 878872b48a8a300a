"""Property tests: operators against plain-Python models on random inputs."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starload.functions import expr as X
from starload.operators import loads as L
from starload.operators.dedupe import dedupe
from starload.operators.keys import assign_surrogate_keys

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


WHOLE = r"\s*[+-]?\d+\s*"


def toi_model(value):
    clock = re.fullmatch(rf"({WHOLE}):({WHOLE})", value or "")
    return sum(unit * int(part) for unit, part in zip((60, 1), clock.groups())) if clock else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789:x ", max_size=7)), min_size=1, max_size=30))
def test_toi_to_seconds_matches_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = {r.i: r.s for r in df.select("i", X.toi_to_seconds("t").alias("s")).collect()}
    for i, v in enumerate(values):
        assert got[i] == toi_model(v), (v, got[i])


names = st.one_of(st.none(), st.sampled_from(["", "a", "b", "a "]))


@SETTINGS
@given(st.lists(st.tuples(names, names, names, names, st.booleans()), min_size=1, max_size=25))
def test_change_predicate_matches_model(spark, rows):
    data = [(i, tn, tc, sn, sc, act) for i, (tn, tc, sn, sc, act) in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, __t_team_name string, __t_conference string, __s_team_name string, "
                                     "__s_conference string, __t_is_active boolean")
    pred = L.change_predicate({"team_name": "", "conference": ""})
    got = {r.i: bool(r.c) for r in df.select("i", F.coalesce(pred, F.lit(False)).alias("c")).collect()}
    for i, tn, tc, sn, sc, act in data:
        want = (tn or "") != (sn or "") or (tc or "") != (sc or "") or not act
        assert got[i] == want


@SETTINGS
@given(st.sets(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=200),
       st.integers(min_value=0, max_value=10**6), st.integers(min_value=1, max_value=6))
def test_surrogate_keys_are_dense_and_ordered(spark, keys, base, parts):
    df = spark.createDataFrame([(k,) for k in keys], "nk long").repartition(parts)
    got = sorted((r.k, r.nk) for r in assign_surrogate_keys(df, "k", ["nk"], base=base).collect())
    assert got == list(zip(range(base + 1, base + len(keys) + 1), sorted(keys)))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50), st.integers(0, 9)), min_size=1, max_size=60,
                unique_by=lambda t: (t[0], t[1])),
       st.sampled_from(["first", "last"]))
def test_dedupe_matches_model(spark, rows, keep):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    got = sorted(tuple(r) for r in dedupe(df, ["k"], ["o"], keep=keep).collect())
    best = {}
    for k, o, v in rows:
        if k not in best or (o > best[k][0] if keep == "last" else o < best[k][0]):
            best[k] = (o, v)
    assert got == sorted((k, o, v) for k, (o, v) in best.items())
