"""Both forms against a plain-Python brute force of the definition on random rows."""

import math
import random

import pytest

from mixlens.operators.composition import composition_stats_long, composition_stats_wide, wide_to_long

N_COMP = 7
COLS = [str(c) for c in range(1, N_COMP + 1)]
PROPS = [3.0, None, 1.5, 9.0, 3.0, -2.0, 4.0]   # a NULL property and a tie in values


def brute(ws, props):
    w = [0.0 if (x is None or (isinstance(x, float) and math.isnan(x))) else x for x in ws]
    present = [p for x, p in zip(w, props) if x > 0 and p is not None]
    null_hit = any(x != 0 and p is None for x, p in zip(w, props))
    mean = None if null_hit else sum(x / 100 * p for x, p in zip(w, props) if x != 0)
    std = None if null_hit else sum(x / 100 * abs(p - mean) for x, p in zip(w, props) if x != 0)
    order = sorted(w, reverse=True)
    mode1 = props[w.index(order[0])]
    mode2 = props[w.index(order[1])]
    return {"max": max(present) if present else None, "min": min(present) if present else None,
            "std": std, "mean": mean, "mode1": mode1, "mode2": mode2}


def _rows(n=300, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = rng.randint(0, N_COMP)
        ws = [0.0] * N_COMP
        for j in rng.sample(range(N_COMP), k):
            ws[j] = float(rng.choice([5, 10, 10, 20, 25, 40, 50]))   # repeated values: ties
        if rng.random() < 0.1:
            ws[rng.randrange(N_COMP)] = None
        if rng.random() < 0.05:
            ws[rng.randrange(N_COMP)] = float("nan")
        rows.append((i, *ws))
    return rows


@pytest.mark.parametrize("form", ["wide", "long"])
def test_random_rows_match_brute_force(spark, form):
    rows = _rows()
    wide = spark.createDataFrame(rows, "entity_id long, " + ", ".join(f"`{c}` double" for c in COLS))
    props = spark.createDataFrame([(i + 1, p) for i, p in enumerate(PROPS)], "component int, prop double")
    if form == "wide":
        out = composition_stats_wide(wide, COLS, props, ["prop"])
    else:
        out = composition_stats_long(wide_to_long(wide, COLS, keep_zero=True), props, ["prop"])
    got = {r["entity_id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for row in rows:
        exp = brute(list(row[1:]), PROPS)
        for s, v in exp.items():
            g = got[row[0]][f"prop_{s}"]
            if v is None:
                assert g is None, (row, s, g)
            else:
                assert g == pytest.approx(v, abs=1e-9), (row, s, g, v)
