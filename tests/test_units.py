import math
import random

import pytest
from pyspark.sql import functions as F

from assaylake.operators.units import GUESSED, assign_units, convert_conditions, converted_cases
from assaylake.plans import problems

DOSES = {
    ("1500", "nM"): 1.5e6, ("1,500", "nM"): 1.5e6, ("0,001", "uM"): 1e3, ("1,5", "µM"): 1.5e6, ("1,000,000", "pM"): 1e6, (
        "3 x 10^-4", "mmol/L"
    ): 3e5, ("3*10^7", "pM"): 3e7,
    ("3E+06", "pM"): 3e6, ("-7", "log10(M)"): 1e5, ("-9", "log M"): 1e3, ("@100000pM", "nM"): 1e5, ("ca. 0.1 umol/L", "nM"): 1e5, ("dose=0.03mmol/L", ""): 3e7, (
        "0.3µM (nominal)", "nM"
    ): 3e5,
    ("30 nmol/L final", None): 3e4,
    ("1", "um"): 1e6,
    ("2", "nmol/mL"): 2e6,
    ("2", "fmol/uL"): 2e3,
    ("1", "mol/m3"): 1e9,
    ("286.5", "nmol l-1"): 286500.0,
    ("0.5 ug/mL", None): 1e6,
    ("7", None): 7e6,
    ("7", "NA"): 7e6,
    ("1-10", "nM"): None, ("<5", "uM"): None, ("high", "nM"): None, ("5", "mg/kg"): None, (
        "1:1000", "dilution"
    ): None, ("", "nM"): None, (None, "nM"): None, ("5", "MOI"): None, ("2 m", None): None,
}
TIMES = {
    ("24", "h"): 86400,
    ("24H", ""): 86400,
    ("2880 mins", "d"): 172800,
    ("PT30M", None): 1800,
    ("P1DT12H", None): 129600,
    ("12:30", "h:mm"): 45000,
    ("12h 30 min", ""): 45000,
    ("1d 6h", None): 108000,
    ("T36h", ""): 129600,
    ("t=2.5 h", ""): 9000, ("day 3", None): 259200, ("D2", None): 172800, ("~12h", ""): 43200, (
        "1.5 h post", ""
    ): 5400, ("86,400", "s"): 86400, ("12,5", "H"): 45000, ("2", "wk"): 1209600, ("90 Min.", "h"): 5400, ("4", ""): 240,
    (">72", "h"): None, ("overnight", None): None, ("2 passages", ""): None, ("6-8", "h"): None, ("n/a", "h"): None, ("12:30", "h"): None,
}


def converted(spark, dose=None, unit=None, time=None, time_unit=None, dataset="with"):
    rows = spark.createDataFrame(
        [("c", dataset, "Cmpd", dose, unit, time, time_unit, 1)],
        "condition_id string, dataset_id string, perturbation_id string, dose string, dose_unit string, time string, time_unit string, number int"
    )
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    ref = spark.createDataFrame(
        [
            (
                "with",
                "Stocks are kept at 10 mM in the freezer. Where a dose stands alone, read it as micromolar. Harvest times without a unit are minutes."
            ),
            ("without", None)
        ],
        "dataset_id string, protocol_note string"
    )
    compounds = spark.createDataFrame([("Cmpd", 500.0)], "entry_name string, molar_mass double")
    return ref, compounds


def test_doses_and_times(spark, tables):
    rows = [(f"d{i}", "with", "Cmpd", v, u, None, None) for i, (v, u) in enumerate(DOSES)] + [
        (f"t{i}", "with", "Cmpd", None, None, v, u) for i, (v, u) in enumerate(TIMES)
    ]
    df = spark.createDataFrame(
        rows, "condition_id string, dataset_id string, perturbation_id string, dose string, dose_unit string, time string, time_unit string"
    )
    got = {(r.condition_id, r.quantity): r.common for r in convert_conditions(df, *tables).collect()}
    for i, (case, want) in enumerate(DOSES.items()):
        assert got[f"d{i}", "dose"] == (pytest.approx(want, rel=1e-9) if want is not None else None), case
    for i, (case, want) in enumerate(TIMES.items()):
        assert got[f"t{i}", "time"] == (pytest.approx(want, rel=1e-9) if want is not None else None), case


def test_cases_leave_out_plain_numbers_and_unknown_units(spark, tables):
    rows = [
        ("a", "without", "Cmpd", "5", "nM", "3", "h"),
        ("b", "without", "Cmpd", "5", None, "3", ""),
        ("c", "without", "Other", "5", "ug/mL", "3", "d"),
        ("d", "with", None, "5 nM", None, None, None)
    ]
    df = spark.createDataFrame(
        rows, "condition_id string, dataset_id string, perturbation_id string, dose string, dose_unit string, time string, time_unit string"
    )
    assert {tuple(r) for r in converted_cases(convert_conditions(df, *tables)).collect()} == {("c", "time", 259200), ("d", "dose", 5000)}
    assert converted_cases(convert_conditions(df.limit(0), *tables)).count() == 0


def test_silent_doses_and_times_are_guessed(spark, tables, tmp_path):
    known = [(f"k{i}", "without", "Cmpd", str(10 + i % 5), "uM", str(20 + i % 9), "h") for i in range(60)]
    silent = [("d", "without", "Cmpd", "12", None, None, None), ("t", "without", None, None, None, "24", "NA"), ("n", "with", "Cmpd", "12", None, "24", "")]
    rows = known + silent + silent[:2]
    df = spark.createDataFrame(
        rows, "condition_id string, dataset_id string, perturbation_id string, dose string, dose_unit string, time string, time_unit string"
    )
    masses = tables[1].withColumn("entry_field", F.lit("perturbation_id"))
    for name, table in {"conditions": df, "dataset_ref": tables[0], "canonical_values": masses}.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r.condition_id, r.quantity): r for r in problems.p5_guessed(spark, str(tmp_path)).collect()}
    assert set(got) == {("d", "dose"), ("t", "time")}
    assert got["d", "dose"].guessed_unit == "uM" and got["d", "dose"].guessed_common == 12e6
    assert got["t", "time"].guessed_unit == "h" and got["t", "time"].guessed_common == 86400
    assert all(r.posterior > 0.9 and not r.uncertain for r in got.values())


def test_mixture_finds_the_scale_of_values_without_units(spark):
    known = [(float(10 ** (6 + (i % 7 - 3) / 4)), float(i), "um") for i in range(200)]
    silent = [(None, float(10 ** ((i % 7 - 3) / 4)), None) for i in range(50)]
    df = spark.createDataFrame(known + silent, "common double, number double, unit string")
    got = assign_units(df, "number", "common", ["pM", "nM", "uM"], [1.0, 1e3, 1e6]).where("unit is null").collect()
    assert {r.guessed_unit for r in got} == {"uM"} and all(r.posterior > 0.9 and not r.uncertain for r in got)
    assert assign_units(df.limit(0), "number", "common", ["pM"], [1.0]).count() == 0


def test_hidden_units_are_told_with_honest_posteriors(spark):
    """Groups of their own scale, units hidden at random: accuracy, and posteriors that mean what they say."""
    rng = random.Random(3)
    units, factors = ["pM", "nM", "uM", "mM"], [1.0, 1e3, 1e6, 1e9]
    rows = []
    for g in range(30):
        mean, spread = rng.uniform(3, 9), rng.uniform(0.3, 1.2)
        for _ in range(120):
            x, u = rng.gauss(mean, spread), rng.choices(range(4), [1, 4, 4, 1])[0]
            hidden = rng.random() < 0.3
            rows.append((f"g{g}", 10 ** (x - math.log10(factors[u])), None if hidden else 10**x, None if hidden else units[u], units[u]))
    df = spark.createDataFrame(rows, "source string, number double, common double, unit string, truth string")
    own = assign_units(df, "number", "common", units, factors, group="source").where("guessed_unit is not null").collect()
    assert len(own) == sum(r[2] is None for r in rows)
    right = [r.guessed_unit == r.truth for r in own]
    everyone = assign_units(df, "number", "common", units, factors).where("guessed_unit is not null").collect()
    assert sum(right) / len(own) > max(0.85, sum(r.guessed_unit == r.truth for r in everyone) / len(own))
    sure = [ok for ok, r in zip(right, own) if not r.uncertain]
    assert sum(sure) / len(sure) > 0.93 and len(sure) > 0.5 * len(own)
    for low, high in ((0.3, 0.7), (0.7, 0.9), (0.9, 0.99), (0.99, 1.01)):
        some = [(ok, r.posterior) for ok, r in zip(right, own) if low <= r.posterior < high]
        if len(some) > 40:
            assert abs(sum(ok for ok, _ in some) / len(some) - sum(p for _, p in some) / len(some)) < 0.12


def test_units_hidden_in_the_conditions_are_recovered(spark):
    """Times and doses of the project's own table whose unit column is blanked: how many are told, and how surely."""
    d = "/root/testdata/sf0.01"
    known = problems._converted(spark, d).where("common > 0 and number > 0 and unit_source = 'column'")
    for quantity, least in (("time", 0.8), ("dose", 0.5)):
        factors = GUESSED[quantity]
        truth = F.element_at(F.create_map(*[F.lit(v) for u, f in factors.items() for v in (f, u)]), F.round(F.col("common") / F.col("number"), 6))
        rows = known.where(F.col("quantity") == quantity).withColumn("truth", truth).where("truth is not null")
        hide = F.xxhash64("condition_id") % 5 == 0
        asked = rows.withColumns({"unit": F.when(~hide, F.col("unit")), "common": F.when(~hide, F.col("common"))})
        got = assign_units(asked, "number", "common", list(factors), list(factors.values()), group="source").where("guessed_unit is not null").collect()
        right = [r.guessed_unit == r.truth for r in got]
        sure = [ok for ok, r in zip(right, got) if not r.uncertain]
        print(quantity, len(got), sum(right) / len(got), len(sure), sum(sure) / max(1, len(sure)))
        assert len(got) > 30 and sum(right) / len(got) >= least and sum(sure) >= 0.85 * len(sure)
