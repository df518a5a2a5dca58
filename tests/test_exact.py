"""Typing and profiles that keep every value, against Python's decimals."""

import random
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from tessera.functions import exact as E
from tessera.operators import classify as C
from tessera.operators import profile_state as PS
from tessera.operators import summary as Y
from tessera.plans.workflow import chosen_types, collected, is_remote_sensing
from tessera.sources import snapshot


def test_needs_and_doubles_against_decimals(spark):
    """Digits that a decimal needs, and whether a double gives a value back."""
    getcontext().prec = 100
    rng = random.Random(4)
    texts = ["0", "-0", "0.0", "00", "007", "+5", ".5", "5.", "1e3", "1E-3", "1e999", "1e-999", "100", "0.10", "9007199254740993", "12345678901234567.89",
             "99999999999999999999999999999999999999", "0.1", "123456789012345", "1e400", "00.5", "-0012", "1e99999999999"]
    for _ in range(200):
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randrange(1, 20)))
        dot = rng.randrange(len(digits) + 1)
        texts.append(rng.choice(["", "-", "+"]) + digits[:dot] + ("." + digits[dot:] if dot < len(digits) else "") + rng.choice(["", "", f"e{rng.randrange(-9, 9)}"]))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", E.needs(F.col("t")).alias("need"), E.kept_by_double(F.col("t")).alias("double")).collect():
        plain = r["t"].lstrip("+-").lower().split("e")[0].split(".")[0]
        padded = len(plain) > 1 and plain.startswith("0")
        assert (r["need"] is None) == padded, r
        if padded:
            assert not r["double"]
            continue
        if r["t"] == "1e99999999999":
            assert not r["double"]
            continue
        value = Decimal(r["t"])
        _, digits, exp = value.normalize().as_tuple() if value else (0, (0,), 0)
        assert (r["need"]["whole"], r["need"]["scale"]) == (max(1, len(digits) + exp if value else 1), max(0, -exp)), r
        if r["double"]:
            assert Decimal(repr(float(r["t"]))) == value, r
        elif len(digits) <= 15:
            assert abs(value.adjusted()) >= 290, r


@pytest.mark.parametrize("name,values,storage,kept", [
    ("zero padded", ["007", "8", "9"], "bigint", False), ("overflow", ["1e999", "1"], "double", False),
    ("long decimals", ["12345678901234567.89", "0.05"], "decimal(19,2)", True), ("beyond bigint", ["99999999999999999999", "3"], "decimal(20,0)", True),
    ("too long", ["1" * 39, "2"], "bigint", False), ("powers", ["1e3", "2.5"], "double", True), ("signs", ["+5", "-0"], "bigint", True),
    ("one bad", ["1", "2", "3", "4", "5", "x"], "bigint", False)])
def test_types_keep_every_value(spark, name, values, storage, kept):
    """With a column of bands beside it too, which skips the verification's rows only."""
    for more in ("y", "band"):
        df = spark.createDataFrame([(v, "b", "f") for v in values], f"x string, {more} string, image_file string")
        assert is_remote_sensing(df) == (more == "band")
        rows, _ = collected(spark, C.classify_verified(df, categorical=False))
        got = {r["col"]: r for r in rows}["x"]
        assert (got["storage"], got["accepted"]) == (storage, kept)
        typed = C.apply_types(df, chosen_types(df, rows)).select(F.col("x").cast("string")).collect()
        if not kept:
            assert sorted(r["x"] for r in typed) == sorted(values)
        else:
            assert sorted(Decimal(r["x"]) for r in typed) == sorted(map(Decimal, values))


def test_profile_and_extrema_in_the_columns_types(spark):
    df = spark.sql("""select * from values (9007199254740992L, 10000000000000000.01BD, 1.5D), (9007199254740993L, 10000000000000000.02BD, 1.5D),
        (9007199254740993L, null, null) as t(big, money, d)""")
    df = df.withColumn("money", F.col("money").cast("decimal(38,2)"))
    got = {r["col"]: r for r in Y.profile(df).collect()}
    assert (got["big"]["n_distinct"], got["big"]["min_text"], got["big"]["max_text"]) == (2, "9007199254740992", "9007199254740993")
    assert (got["money"]["n_distinct"], got["money"]["n_null"], got["money"]["min_text"], got["money"]["max_text"]) == \
        (2, 1, "10000000000000000.01", "10000000000000000.02")
    assert (got["d"]["n_distinct"], got["d"]["min_text"], got["d"]["mean"]) == (1, None, 1.5)
    ends = {r["col"]: r for r in Y.extrema(df, df.columns).collect()}
    assert ends["money"]["min_text"] == "10000000000000000.01" and ends["big"]["max_text"] == "9007199254740993" and ends["d"]["max_value"] == 1.5


def test_mean_of_sums_without_room(spark):
    """Beyond 10^20 the mean is a decimal quotient, not an overflow."""
    df = spark.range(100).select((F.col("id") + 9_000_000_000_000_000_000).alias("x"))
    assert Y.profile(df).first()["mean"] == float(Decimal(9_000_000_000_000_000_000) + Decimal("49.5"))


def test_states_merge_to_the_state_of_all_rows(spark, tmp_path):
    df = spark.range(3000).selectExpr("id", "case when id % 7 = 0 then null else id * 0.25 end as x", "concat('k', id % 50) as s",
                                      "double('NaN') as nan", "cast(null as double) as none")
    parts = [df.where(f"id % 3 = {k}") for k in range(3)] + [df.where("false")]
    states = PS.state(parts[0])
    for p in parts[1:]:
        states = states.unionByName(PS.state(p))
    got = {r["col"]: r for r in PS.finish(PS.merge(states)).collect()}
    want = {r["col"]: r for r in Y.profile(df).collect()}
    for c in df.columns:
        for k in ("n", "n_null", "mean", "stddev", "min", "max"):
            assert got[c][k] == want[c][k], (c, k)
        assert abs(got[c]["n_distinct"] - want[c]["n_distinct"]) <= 0.03 * want[c]["n_distinct"] + 0.5
    assert abs(got["x"]["p50"] - want["x"]["p50"]) <= 0.02 * 750 and (got["s"]["min_text"], got["s"]["max_text"]) == ("k0", "k9")
    root = str(tmp_path)
    for p in parts[:3]:
        last = {r["col"]: r for r in PS.grow(spark, root, "d", p).collect()}
    assert {c: last[c]["mean"] for c in df.columns} == {c: want[c]["mean"] for c in df.columns} and last["id"]["n"] == 3000
    slow = snapshot.Run(spark, root)
    PS.grow(spark, root, "d", parts[0])
    slow.put(PS.stored(spark, root, "d"), PS.TABLE, "d")
    with pytest.raises(snapshot.Conflict):
        slow.commit()
