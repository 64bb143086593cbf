"""Element dimension: ground-state electron configurations for Z = 1..118.

The strings are generated from the Madelung (n + l, n) filling rule, with the
ground-state exceptions listed below, and written with the previous noble gas
as core, e.g. ``[Ar] 3d10 4s2 4p2``. This is public chemistry; the table has
one row per component (atomic number) and is a small, bounded dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MAX_Z = 118
SUBSHELL_LETTERS = "spdf"

# Ground-state configurations that differ from the filling rule,
# given as the valence subshells written after the noble-gas core.
CONFIGURATION_EXCEPTIONS = {
    24: "3d5 4s1",          # Cr
    29: "3d10 4s1",         # Cu
    41: "4d4 5s1",          # Nb
    42: "4d5 5s1",          # Mo
    44: "4d7 5s1",          # Ru
    45: "4d8 5s1",          # Rh
    46: "4d10",             # Pd
    47: "4d10 5s1",         # Ag
    57: "5d1 6s2",          # La
    58: "4f1 5d1 6s2",      # Ce
    64: "4f7 5d1 6s2",      # Gd
    78: "4f14 5d9 6s1",     # Pt
    79: "4f14 5d10 6s1",    # Au
    89: "6d1 7s2",          # Ac
    90: "6d2 7s2",          # Th
    91: "5f2 6d1 7s2",      # Pa
    92: "5f3 6d1 7s2",      # U
    93: "5f4 6d1 7s2",      # Np
    96: "5f7 6d1 7s2",      # Cm
    110: "5f14 6d9 7s1",    # Ds
    111: "5f14 6d10 7s1",   # Rg
}

# Noble-gas cores used as prefixes.
NOBLE_GAS_CORES = [(2, "He"), (10, "Ne"), (18, "Ar"), (36, "Kr"), (54, "Xe"), (86, "Rn")]


def _filling_order() -> list[tuple[int, int]]:
    shells = [(n, l) for n in range(1, 8) for l in range(0, min(n, 4))]
    return sorted(shells, key=lambda nl: (nl[0] + nl[1], nl[0]))


def _rule_occupancy(z: int) -> dict[tuple[int, int], int]:
    occ: dict[tuple[int, int], int] = {}
    left = z
    for n, l in _filling_order():
        if left <= 0:
            break
        k = min(left, 4 * l + 2)
        occ[(n, l)] = k
        left -= k
    return occ


def electron_configuration(z: int) -> str:
    """Configuration string with the previous noble gas as core."""
    if not 1 <= z <= MAX_Z:
        raise ValueError(f"atomic number out of range: {z}")
    core_z, core = 0, ""
    for cz, sym in NOBLE_GAS_CORES:
        if cz < z:
            core_z, core = cz, f"[{sym}]"
    if z in CONFIGURATION_EXCEPTIONS:
        valence = CONFIGURATION_EXCEPTIONS[z]
    else:
        core_occ = _rule_occupancy(core_z)
        occ = _rule_occupancy(z)
        parts = []
        for (n, l) in sorted(occ):
            k = occ[(n, l)] - core_occ.get((n, l), 0)
            if k > 0:
                parts.append(f"{n}{SUBSHELL_LETTERS[l]}{k}")
        valence = " ".join(parts)
    return f"{core} {valence}".strip()


ELEMENT_SCHEMA = T.StructType([
    T.StructField("component", T.IntegerType(), False),
    T.StructField("electronic_configuration", T.StringType(), False),
])


def element_rows(max_z: int = MAX_Z) -> list[tuple[int, str]]:
    return [(z, electron_configuration(z)) for z in range(1, max_z + 1)]


def element_table(spark: SparkSession, max_z: int = MAX_Z) -> DataFrame:
    """The element dimension as a DataFrame(component, electronic_configuration)."""
    return spark.createDataFrame(element_rows(max_z), ELEMENT_SCHEMA)
