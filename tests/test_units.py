import pytest
from pyspark.sql import functions as F

from mattercat.functions import units as U

K, M, H, B = U.FACTORS["kcal"], U.FACTORS["mol"], U.HARTREE, U.BOHR


def test_published_constants():
    assert abs(U.HARTREE - 27.21138602) < 1e-7
    assert abs(U.BOHR - 0.52917721067) < 1e-9
    assert abs(K / M - 0.0433641) < 1e-6
    assert abs(U.FACTORS["GPa"] - 0.0062415091) < 1e-9


@pytest.mark.parametrize("unit,expected", [
    ("eV", 2.0), ("hartree", 2.0 * H), ("kcal/mol", 2.0 * K / M), ("kJ/mol", 2.0 * U.KILOJOULE / M),
    # not among the common ones: read in the plan
    ("hartree/bohr/bohr", 2.0 * H / B / B), ("eV*nm", 20.0), ("eV/bohr^3", 2.0 / B**3), ("hartree*bohr^-1", 2.0 * H * B**-1),
])
def test_scalar_units(one, unit, expected):
    assert one(U.to_standard("v", "u"), v=2.0, u=unit) == pytest.approx(expected, rel=1e-15)


def test_exponent_belongs_to_its_unit(one):
    # Not (2 * hartree / bohr) ** 3.
    assert one(U.to_standard("v", "u"), v=2.0, u="hartree/bohr^3") == pytest.approx(2.0 * H / B**3)


def test_unknown_units(one, spark):
    for bad in ("parsec", "eV//angstrom", "eV angstrom", ""):
        with pytest.raises(Exception, match="unknown unit"):
            one(U.to_standard("v", "u"), v=1.0, u=bad)
        assert one(U.to_standard("v", "u", on_error="null"), v=1.0, u=bad) is None
    nothing = spark.createDataFrame([(None, "parsec")], "v double, u string")
    assert nothing.select(U.to_standard("v", "u")).first()[0] is None


def test_there_and_back(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 50)], "v double")
    df = df.withColumn("u", F.lit("kcal/mol"))
    back = df.select("v", (U.to_standard("v", "u") / F.lit(K / M)).alias("b")).collect()
    assert all(r["b"] == pytest.approx(r["v"], rel=1e-14) for r in back)


def test_arrays(spark):
    df = spark.createDataFrame(
        [("[[1.0, 2.0, 3.0]]", "hartree/bohr"), ("[[1.0, 2.0, nan]]", "eV/angstrom"), ("[]", None), (None, None),
         ("[[1.0, 2.0, 3.0]]", "eV*nm/angstrom")],
        "f string, u string",
    )
    found = [r["f"] for r in U.convert_array(df, "f", "u", U.FORCE_STANDARD).collect()]
    assert found[0] == [[pytest.approx(x * H / B) for x in (1.0, 2.0, 3.0)]]
    assert str(found[1]) == "[[1.0, 2.0, nan]]"
    assert found[2:4] == [[], []]
    assert found[4] == [[10.0, 20.0, 30.0]]


def test_reference_energies(spark):
    df = spark.createDataFrame(
        [("DS_a", 1.0, "hartree", 0.5), ("DS_b", 1.0, "eV", 0.5), (None, 1.0, "eV", None)],
        "dataset_id string, r double, r_unit string, e double",
    )
    out = U.add_reference(U.convert_reference_energy(df, ["r"], ["DS_b"]), {"e": "r"}).collect()
    assert [(r["r"], r["e"]) for r in out] == [(H, 0.5 + H), (None, 0.5), (1.0, None)]
    flat = spark.createDataFrame([(2.0, True, 3), (2.0, False, 3), (2.0, None, 3)], "e double, p boolean, nsites int")
    assert [r["e"] for r in U.per_atom_to_total(flat, {"e": "p"}).collect()] == [6.0, 2.0, 2.0]
