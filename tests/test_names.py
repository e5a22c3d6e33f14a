import pytest
from pyspark.sql import functions as F

from mattercat.functions import names as N
from mattercat.functions import structures as S
from mattercat.functions.lists import ensure_list


@pytest.mark.parametrize("path,expected", [
    ("/mnt/blobs/MD/a.json", "data/MD/a.json"), ("/mnt/blobs/data/MD/a.json", "data/MD/a.json"),
    ("/other/MD/a.json", "/other/MD/a.json"), (None, None),
])
def test_trim_path(one, path, expected):
    assert one(N.trim_path("p", "/mnt/blobs"), p=path) == expected


@pytest.mark.parametrize("stored,shown", [
    ("CC0", "cc0-1.0"), ("NIST-PD", "unknown"), ("GPL-3.0-only", "gpl-3.0"), ("CC-BY-4.0", "cc-by-4.0"), (None, None),
])
def test_normalize_license(one, stored, shown):
    assert one(N.normalize_license("c"), c=stored) == shown


@pytest.mark.parametrize("authors,expected", [
    ("['Ludwig van der Berg']", "Berg, L. _A b_. Site, 2024. https://doi.org/10.1/x"),
    ("['Ann Mary Bee', 'Cy de Dee', 'Élan Eff']",
     "Bee, A. M., Dee, C., and Eff, É. _A b_. Site, 2024. https://doi.org/10.1/x"),
    ("Plato", "Plato,  _A b_. Site, 2024. https://doi.org/10.1/x"),
])
def test_citation(one, authors, expected):
    cited = N.citation(ensure_list("a"), F.lit("A_b"), F.lit("2024"), F.lit("10.1/x"), "Site")
    assert one(cited, a=authors) == expected


def test_names(one):
    assert one(N.normalize_name("n"), n="a(b)@c/d+e f") == "a_b__c_d_e f"
    assert one(N.display_name("n"), n="a_b_c") == "a b c"
    assert one(N.id_prefix("n"), n="PO_123456") == "PO_123"


def test_number_from_name(spark):
    df = spark.createDataFrame(
        [(["x__file_9__config_1", "train__file_12__config_4", "train__file_13__config_4"],), (["other"],), (None,),
         (["train__file_x__config_4"],)], "names array<string>",
    )
    number = N.number_from_name("names", "train", "train__file_", "__config")
    assert [r[0] for r in df.select(number).collect()] == [12, None, None, None]


def test_present_properties_and_info(spark):
    df = spark.createDataFrame(
        [(3, 0, None, "x", [], [1.5])],
        "energy_count int, atomic_forces_count int, formation_energy_count int, account string, e array<int>, f array<double>",
    )
    assert df.select(N.present_properties(df)).first()[0] == "energy"
    info = df.select(N.info_fields(df, ["energy_count", "formation_energy_count", "e", "f", "absent"])).first()[0]
    assert info == '{"energy_count":3,"f":[1.5]}'
    assert N.fill_int_null(df, "formation_energy_count", 0).first()["formation_energy_count"] == 0
    assert N.fill_int_null(df, "formation_energy_count").first()["formation_energy_count"] is None


def test_periodicity(spark):
    cells = [
        ([[0.0, 0.0, 0.0]] * 3, [False] * 3, [False] * 3),
        ([[5.0, 0.0, 0.0], [0.0] * 3, [0.0] * 3], [True] * 3, [True, False, False]),
        ([[0.0] * 3, [0.0] * 3, [0.0, 1e-9, 0.0]], [True] * 3, [False, False, True]),
        (None, None, None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cells], "cell array<array<double>>")
    dims = S.dimension_types(S.pbc_from_cell("cell", mode="axis"))
    rows = df.select(S.pbc_from_cell("cell"), S.pbc_from_cell("cell", mode="axis"), S.nperiodic_dimensions(dims)).collect()
    for row, (_, whole, axis) in zip(rows, cells):
        assert (row[0], row[1]) == (whole, axis)
        assert row[2] == (None if axis is None else sum(axis))


def test_force_norms(spark):
    schema = "f array<array<double>>"
    df = spark.createDataFrame([([[3.0, 4.0, 0.0], [0.0, 0.0, 1.0]],), ([],), (None,)], schema)
    found = [(r["mean_force_norm"], r["max_force_norm"]) for r in S.force_norms(df, "f").collect()]
    assert found == [(3.0, 5.0), (None, None), (None, None)]
    with pytest.raises(Exception, match="three numbers wide"):
        S.force_norms(spark.createDataFrame([([[1.0, 2.0]],)], schema), "f").collect()
