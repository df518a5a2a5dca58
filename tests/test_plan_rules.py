"""Every registered query's physical plan: no Cartesian or nested-loop
join (no all-pairs work) and no Python operator (all row work in the JVM),
but for the Arrow functions of the queries named below."""

import pytest

import __spark_entry__ as E
from tessera.plans import registry

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "PythonUDF"]
# K2 compares rows with blocks of centroids; S1 puts the lines of a byte range together.
ARROW = {"merge_document", "cluster_assign", "cluster_report", "cluster_kmeans", "cluster_kmeans_check", "cluster_numeric",
         "read_declared", "read_declared_text", "write_csv_pair", "write_csv_pair_rows"}
QUERIES = {k: v for k, v in E.queries().items() if k in registry.QUERIES}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairs_and_no_python(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [op for op in FORBIDDEN if op in plan and not (op == "MapInArrow" and name in ARROW)]
    assert not bad, (name, bad)


@pytest.mark.parametrize("name", ["classify_best", "classify_extended", "verify_types", "artifact_catalog"])
def test_classification_shuffles_no_text(spark, sf_dir, name, monkeypatch):
    """Only counts and digests cross an exchange on the way to a type."""
    from tessera.operators import classify as C
    plans = []

    def spy(stats):
        def run(*a, **k):
            df = stats(*a, **k)
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return df
        return run
    monkeypatch.setattr(C, "column_stats", spy(C.column_stats))
    monkeypatch.setattr(C, "distinct_of", spy(C.distinct_of))
    QUERIES[name](spark, sf_dir)
    lines = [ln for p in plans for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    assert plans and lines
    for ln in lines:
        keys = ln.split("hashpartitioning(")[1].split(")")[0].rsplit(",", 1)[0]
        assert not {k.strip().split("#")[0] for k in keys.split(",")} & {"v", "text", "html", "url", "contact", "name"}, ln


def test_audit_reads_the_fact_table_once(spark, sf_dir):
    """Once its combinations of keys are stored, the plan has no fact column."""
    df = QUERIES["merge_audit"](spark, sf_dir)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" in plan and "l_partkey" not in plan
    assert not any("Relation" in ln and "l_linenumber" in ln for ln in plan.splitlines())


def test_text_terms_plan_is_lazy(spark, sf_dir):
    """The document count and the top-k ranking are scalar subqueries and
    windows inside one plan: building it starts no Spark job."""
    from tessera.operators import summary as Y
    from tessera.sources.tables import table
    sc = spark.sparkContext
    docs = table(spark, sf_dir, "documents")
    sc.setJobGroup("tessera-lazy-probe", "plan construction only")
    try:
        df = Y.text_terms(docs, "doc_id", "lang", "text", k=3)
        started = sc.statusTracker().getJobIdsForGroup("tessera-lazy-probe")
    finally:
        sc.setJobGroup("", "")
    assert started == [], started
    assert "scalar-subquery" in df._jdf.queryExecution().optimizedPlan().toString()
