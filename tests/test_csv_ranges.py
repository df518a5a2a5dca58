"""CSV read by byte ranges against the reader that reads files whole."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tessera.sources import csv_ranges
from tessera.sources import files as S

SCHEMA = StructType([StructField("a", StringType()), StructField("b.c", IntegerType()), StructField("d", StringType())])
FIELDS = ["x", "", '""', '"a,b"', '"one\ntwo"', '"q ""q"" q"', '"\n"', '"""', 'in"side', '"l1\n""l2"",\nl3"', "é", "\r", '"",""', '","', '"\n\n,"']


def whole(spark, path, header):
    full = StructType([*SCHEMA.fields, StructField(S.CORRUPT_COL, StringType())])
    return spark.read.schema(full).options(**S._CSV_READ, lineSep="\n").option("header", str(header).lower()).csv(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture()
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", range(6))
def test_any_fields_over_many_ranges(spark, tmp_path, small_ranges, seed):
    """Records over several ranges, doubled quotes, quotes inside unquoted
    fields, empty lines, several files."""
    rng = random.Random(seed)
    odd = [f for f in FIELDS if f != '"""']  # a field that is never closed is below
    for name in "xyz":
        lines = ["a,b.c,d"]
        for i in range(rng.randrange(0, 60)):
            lines.append(",".join([rng.choice(odd), str(i) if rng.random() < .9 else "no", rng.choice(odd)][:3 if rng.random() < .95 else 2]))
            if rng.random() < .05:
                lines.append("")
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + ("\n" if seed % 2 else ""), newline="")
    for header in (True, False):
        assert rows(S.read_declared(spark, str(tmp_path), SCHEMA, header)) == rows(whole(spark, str(tmp_path), header))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "one.csv").write_text("".join(f'"{i}\n{i}",{i},z\n' for i in range(500)))
    got = S.read_declared(spark, str(tmp_path), SCHEMA, header=False)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50
    assert rows(got) == sorted(((f"{i}\n{i}", i, "z", None) for i in range(500)), key=str)


def test_a_quote_that_is_never_closed(spark, tmp_path, small_ranges):
    """Up to the limit it is one malformed record; beyond, each line is."""
    (tmp_path / "x.csv").write_text("1,1,x\n" + '"' + "y,2,y\n" * 100)
    got = S.read_declared(spark, str(tmp_path), SCHEMA, header=False)
    assert got.count() == 2 and got.where(f"{S.CORRUPT_COL} is not null").count() == 1
    lines = csv_ranges.records(spark, str(tmp_path), max_bytes=200)
    assert [tuple(r) for r in lines.groupBy("whole").agg(F.count("*")).orderBy("whole").collect()] == [(False, 100), (True, 1)]


def test_empty_file_and_header_alone(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert S.read_declared(spark, str(tmp_path / "a.csv"), SCHEMA).collect() == []
    (tmp_path / "b.csv").write_text('a,"b\n.c",d\n')
    assert S.read_declared(spark, str(tmp_path / "b.csv"), SCHEMA).collect() == []
    assert len(S.read_declared(spark, str(tmp_path / "b.csv"), SCHEMA, header=False).collect()) == 1


def test_only_files_shuffle_no_single_partition(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2,3\n")
    plan = S.read_declared(spark, str(tmp_path / "a.csv"), SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Cartesian" not in plan
