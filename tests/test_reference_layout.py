"""The raw glass layout (FIXTURES F1/F3): 108 typed CSV columns in, 120 out."""

import pytest
from pyspark.ml import Pipeline

from mixlens.ml.transformers import CompositionStats
from mixlens.operators.properties import electron_shells
from mixlens.sources.elements import element_table
from mixlens.sources.files import read_typed_csv, schema_from_json

# The raw layout (names in file order).
OXIDES = ["SIO2", "AL2O3", "B2O3", "CAO", "K2O", "NA2O", "PBO", "Li2O", "MgO", "SRO", "BAO", "ZNO",
          "P2O5", "GEO2", "ZRO2", "TIO2", "TEO2", "FemOn"]
TARGETS = ["RO20", "RO100", "RO150", "RO300"]
# Elements up to 92 that have no column.
MISSING_ELEMENTS = {2, 10, 18, 36, 43, 54, 85, 86, 87, 88, 89, 91}
ELEMENTS = [str(z) for z in range(1, 93) if z not in MISSING_ELEMENTS]


def _schema():
    def f(name, typ):
        return {"name": name, "type": typ, "nullable": True, "metadata": {}}
    fields = [f("GLASNO", "integer"), f("A_WT", "float")] + [f(o, "float") for o in OXIDES] \
        + [f(t, "float") for t in TARGETS] + [f("Year", "integer"), f("Refer_Id", "integer"),
                                              f("Patent", "boolean"), f("SLeg", "float")] \
        + [f(e, "float") for e in ELEMENTS]
    return schema_from_json({"type": "struct", "fields": fields})


def test_layout_has_108_columns():
    assert len(ELEMENTS) == 80 and len(_schema().fields) == 108


def test_raw_csv_to_features(spark, tmp_path):
    header = ",".join(f.name for f in _schema().fields)
    row1 = ["1", "60.5"] + ["1.0"] * 18 + ["2.0", "3.0", "4.0", "5.5"] + ["1999", "7", "true", "0.5"]
    el1 = ["0"] * 80
    el1[ELEMENTS.index("8")], el1[ELEMENTS.index("14")], el1[ELEMENTS.index("11")] = "60", "30", "10"
    row2 = list(row1)
    row2[0], row2[1] = "2", "bad"          # one bad field -> NULL
    el2 = ["0"] * 80
    el2[ELEMENTS.index("14")] = "100"
    p = tmp_path / "raw.csv"
    p.write_text("\n".join([header, ",".join(row1 + el1), ",".join(row2 + el2)]) + "\n")
    df = read_typed_csv(spark, str(p), _schema())
    assert df.where("GLASNO = 2").collect()[0]["A_WT"] is None

    props = electron_shells(element_table(spark)).select("component", "s_filled", "p_filled")
    stages = [CompositionStats.from_table(props, [c], ELEMENTS) for c in ("s_filled", "p_filled")]
    out = Pipeline(stages=stages).fit(df).transform(df)
    assert len(out.columns) == 120
    r = {x["GLASNO"]: x for x in out.collect()}
    # glass 1: O (s2 p4) 60 %, Si (s2 p2) 30 %, Na (s1 p0) 10 %
    assert r[1]["s_filled_mean"] == pytest.approx(0.6 * 2 + 0.3 * 2 + 0.1 * 1)
    assert r[1]["p_filled_max"] == 4 and r[1]["p_filled_min"] == 0
    assert r[1]["p_filled_mode1"] == 4 and r[1]["p_filled_mode2"] == 2
    # glass 2: pure Si -> mode2 is the property of the first absent element (H: p 0)
    assert r[2]["p_filled_mode1"] == 2 and r[2]["p_filled_mode2"] == 0
    # features chosen by name: 18 oxides + 12 derived
    feats = OXIDES + [c for c in out.columns if c.startswith(("s_filled_", "p_filled_"))]
    assert len(feats) == 30
