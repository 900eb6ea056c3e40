"""Every catalog query against its SQL oracle on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from citeweave.plans.catalog import QUERIES
from citeweave.plans.oracle import statements
from compare import compare, duck

SF = "/root/testdata/sf0.001"
SQL = statements()


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF, keys=list(QUERIES), con=duck(SF), verbose=False)


def test_every_query_has_sql_or_is_rows_only(results):
    assert sorted(set(QUERIES) - set(SQL)) == ["sample_bernoulli"]
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_oracle(results, key):
    ok, spark_side, oracle_side = results[key]
    assert ok, (key, spark_side, oracle_side)


def test_goldens_sf0001(spark):
    q = entry.queries()
    s = q["publication_summary"](spark, SF).first()
    assert (s.n_vertices, s.n_edges, s.n_with_in, s.n_with_out) == (210, 9654, 192, 205)
    assert (s.max_pr, s.min_pr) == (7.49228, 0.297068)
    top = [r.id for r in q["top_publications"](spark, SF).orderBy("position").collect()]
    assert top == ["s9", "s5", "s2", "s1", "s6"]
    js = q["journal_summary"](spark, SF).first()
    assert (js.n_vertices, js.n_edges) == (180, 4434)
    assert q["journal_edges"](spark, SF).agg({"n": "sum"}).first()[0] == 7745
    assert q["top_journals"](spark, SF).orderBy("position").first().id == "Nation/3"
    report = q["influence_report_publications"](spark, SF)
    best = report.where("seed_position = 1 and rank = 1").first()
    assert (best.seed_id, best.neighbor_id, best.pr) == ("s9", "2", 6.800012)
    assert q["sample_by_hash"](spark, SF).count() == 1848


def test_the_corpus_reaches_every_rule(spark):
    """Nothing of the tables is left out, and no rule is checked in vain."""
    q = entry.queries()
    tables = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("part", "supplier", "lineitem")}
    vertices = q["publication_vertices"](spark, SF)
    assert vertices.count() == tables["part"].count() + tables["supplier"].count()
    exploded = q["citations_exploded"](spark, SF)
    assert exploded.where("cited like 's%'").count() > 0.9 * tables["lineitem"].count()  # equal records are one
    assert q["distinct_citation_lists"](spark, SF).count() < q["corpus_count"](spark, SF).first()[0]
    assert q["unresolved_citations"](spark, SF).count() > 0
    pubs = q["scan_publications"](spark, SF)
    assert pubs.where("journalName is null").count() > 0 and pubs.where("journalName = ''").count() > 0
    assert vertices.groupBy("name").count().where("count > 1").count() > 0
    assert q["neighbors_out"](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["seed_position", "seed_id", "seed_name", "rank", "neighbor_id", "name",
                          "in_deg", "out_deg", "pr", "via"]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def test_column_types_match_oracle(spark):
    con = duck(SF)
    sql = entry.oracle_sql()
    for key, fn in QUERIES.items():
        if key not in sql:
            continue
        df = fn(spark, SF)
        ours = {n: SPARK_TO_DUCK.get(t, t) for n, t in df.dtypes}
        rel = con.sql(sql[key])
        theirs = {n: str(t) for n, t in zip(rel.columns, rel.types)}
        assert ours == theirs, key
