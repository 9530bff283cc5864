"""Declared data checks against the one-by-one checks."""

import pytest
from pyspark.sql import functions as F

from checks import bindings as b
from inkmeter.operators import declared as d
from inkmeter.operators import quality
from inkmeter.plans import star
from inkmeter.plans.declared_checks import DECLARED

ROWS = [
    (1, "a", 0.5, 10), (1, "b", 2.0, 11), (2, None, -1.0, 10), (None, "a", None, None),
    (None, "a", 0.1, 12), (3, "z", 1.0, 10), (2, "q", 0.0, 99),
]
CHECKS = [
    *d.key("k"), d.unique("v"), d.unique_together("k", "v"), d.in_range("x", 0, 1), d.in_range("x", low=0),
    d.accepted("v", ["a", "b"]), *d.related("p", "parents", "id"),
]


def tables(spark):
    rows = spark.createDataFrame(ROWS, "k int, v string, x double, p int")
    # The parent keys have another type and repeat
    parents = spark.createDataFrame([(10,), (11,), (11,), (None,)], "id bigint")
    return {"rows": rows, "parents": parents}


def test_compiled_checks_equal_single_ones(spark):
    given = tables(spark)
    rows, parents = given["rows"], given["parents"]
    got = {r.check_name: r.violations for r in d.run_declared(given, {"rows": CHECKS}).collect()}
    assert got == {
        "unique k": quality.not_unique(rows, "k").count(),
        "not_null k": quality.is_null(rows, "k").count(),
        "unique v": quality.not_unique(rows, "v").count(),
        "unique_together k, v": quality.unique_combination(rows, "k", "v").count(),
        "range x": quality.out_of_range(rows, "x", 0).count(),
        "accepted v": rows.where("v NOT IN ('a', 'b')").count(),
        "not_null p": quality.is_null(rows, "p").count(),
        "related p": quality.unrelated(rows, "p", parents, "id").count(),
    }
    assert got["unique k"] == 2 and got["related p"] == 2 and got["unique_together k, v"] == 1


def test_every_check_reports_even_without_rows(spark):
    given = {n: t.limit(0) for n, t in tables(spark).items()}
    result = d.run_declared(given, {"rows": CHECKS, "parents": d.key("id")}).collect()
    assert len(result) == len(CHECKS) + 2 and {r.status for r in result} == {"pass"}


def test_a_table_is_scanned_at_most_three_times(spark, tmp_path):
    given = {}
    for name, table in tables(spark).items():
        table.write.parquet(str(tmp_path / name))
        given[name] = spark.read.parquet(str(tmp_path / name))
    plan = d.run_declared(given, {"rows": CHECKS * 5})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [k#") <= 3


def test_keys_stay_numbers_and_meet_their_parents_without_a_join(spark):
    """A related column that is unique too is counted once, beside its parent's keys."""
    parents = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint")
    # 2 is held twice, 7 and 9 have no parent, 9 twice; a null is no key but in a whole row
    held = [(1, 1, 1), (2, 2, 1), (2, 2, 7), (7, 7, None), (9, 9, 1), (9, None, 1), (None, None, 1), (None, None, 1)]
    rows = spark.createDataFrame(held, "p bigint, q int, up bigint")
    given = {"rows": rows, "parents": parents}
    checks = {
        "rows": [
            *d.related("p", "parents", "id"), d.unique("p"), d.unique_together("p", "q"), d.unique("q"),
            *d.related("up", "rows", "p"), d.unique_together("q"),
        ],
        "parents": [d.unique("id")],
    }
    result = d.run_declared(given, checks)
    got = {(r.table_name, r.check_name): r.violations for r in result.collect()}
    assert got == {
        ("rows", "not_null p"): 2, ("rows", "related p"): 3, ("rows", "unique p"): 2,
        ("rows", "unique_together p, q"): 2, ("rows", "unique q"): 1, ("rows", "not_null up"): 1,
        ("rows", "related up"): 0, ("rows", "unique_together q"): 2, ("parents", "unique id"): 1,
    }
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "cast(p#" not in plan


def test_a_hot_key_is_combined_before_it_moves(spark):
    hot = spark.range(100_000, numPartitions=4).select(F.lit(1).alias("k"))
    result = d.run_declared({"hot": hot}, {"hot": [d.unique("k")]})
    assert result.first().violations == 1
    assert "partial_count" in result._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    sf = "/root/testdata/sf0.001"
    return declared_tables(spark, sf)


def declared_tables(spark, sf):
    from checks.measure_checks import declared_tables as given

    return given(spark, sf)


def test_the_build_passes_all_declared_checks(spark, built):
    result = d.run_declared(built, DECLARED).collect()
    assert len(result) == sum(map(len, DECLARED.values())) > 70
    assert [r for r in result if r.violations] == []


def test_a_second_self_author_is_reported(spark, built):
    authors = built["dim_author"]
    two = authors.withColumn("is_self", F.when(F.col("is_self") == 1, 1).otherwise(F.lit(0)))
    other = two.where("is_self = 0").orderBy("author_key").limit(1).select("author_key").first()[0]
    two = two.withColumn("is_self", F.when(F.col("author_key") == other, 1).otherwise(F.col("is_self")))
    overlap = star.fact_vocab_overlap(built["int_vocab_jaccard"], two)
    result = d.run_declared(
        {**built, "fact_vocab_overlap": overlap}, {"fact_vocab_overlap": DECLARED["fact_vocab_overlap"]}
    )
    failing = {r.check_name for r in result.collect() if r.violations}
    assert failing == {"unique author_key_b"}
    assert b.fixed is not None
