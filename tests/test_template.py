import pytest

from rowferry.functions.keys import after
from rowferry.sources.template import QueryError, check_query, extract, query_schema, render


@pytest.fixture
def t(spark):
    spark.createDataFrame(
        [(i, i % 3, "x" * i) for i in range(1, 11)], "id long, whereabouts int, s string"
    ).createOrReplaceTempView("src_t")
    return "src_t"


def test_render():
    assert render("SELECT * FROM {{table}} a JOIN {{table}} b;", "t") == "SELECT * FROM t a JOIN t b"


@pytest.mark.parametrize(
    "query, expected",
    [
        ("SELECT * FROM {{table}}", [8, 9, 10]),
        ("SELECT * FROM {{table}} WHERE id < 10", [8, 9]),
        ("SELECT * FROM {{table}} WHERE id = 1 OR id = 9", [9]),
        ("SELECT id, whereabouts FROM {{table}};", [8, 9, 10]),
        ("SELECT max(id) AS id FROM {{table}} GROUP BY whereabouts", [8, 9, 10]),
        ("SELECT id FROM {{table}} ORDER BY id LIMIT 8", [8]),
        ("SELECT id, row_number() OVER (ORDER BY id DESC) AS n FROM {{table}}", [8, 9, 10]),
        ("SELECT id FROM {{table}} WHERE id IN (SELECT id FROM {{table}} WHERE id > 8)", [9, 10]),
        ("WITH c AS (SELECT id FROM {{table}}) SELECT id FROM c", [8, 9, 10]),
    ],
)
def test_predicate_applies_to_the_result(spark, t, query, expected):
    rows = extract(spark, query, t).where(after("id", [7])).collect()
    assert sorted(r.id for r in rows) == expected


def test_alias_predicate_is_pushed(spark):
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").createOrReplaceTempView("o_t")
    df = extract(spark, "SELECT o_orderkey AS id FROM {{table}} WHERE o_custkey > 3", "o_t").where(after("id", [7]))
    assert "GreaterThan(o_orderkey,7)" in df._jdf.queryExecution().executedPlan().toString()


def test_check_query(spark, t):
    assert check_query(spark, "SELECT * FROM {{table}}", t) == (True, None)
    assert check_query(spark, "SELECT * FROM {{table}} WHERE 1=1 WHERE 2=2", t)[0] is False
    assert check_query(spark, "SELECT nope FROM {{table}}", t)[1].startswith("UNRESOLVED_COLUMN")
    assert check_query(spark, "SELECT * FROM {{table}}", "no_table")[1] == "TABLE_OR_VIEW_NOT_FOUND"
    assert check_query(spark, "SELECT id, id FROM {{table}}", t) == (False, "DUPLICATE_COLUMN")


def test_duplicate_names_are_refused(spark, t):
    with pytest.raises(QueryError):
        extract(spark, "SELECT a.id, b.id FROM {{table}} a JOIN {{table}} b ON a.id = b.id", t)


def test_query_schema(spark, t):
    rows = query_schema(extract(spark, "SELECT id, nullif(s, 'x') AS s FROM {{table}}", t)).collect()
    assert [tuple(r) for r in rows] == [(1, "id", "bigint", 10, 0), (2, "s", "string", 10, 1)]
