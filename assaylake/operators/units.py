"""Quantities recorded in different units, converted to one number in a common unit.

The unit is taken from the value itself, else from the unit column, else from the default
that the source's note states. Where all are silent, a mixture on the log scale is fitted: its
components lie apart by the known conversion factors and share one mean and spread. Mean,
spread and the weights of the units are fitted by expectation maximisation, over the values of
known and of silent unit together, for all rows and then for each group (the compound of a
dose, the data set of a time), where the fit over all rows counts as some prior values. The
unit of the largest posterior is assigned, and marked as uncertain if the posterior is low.

Common units: picomolar for concentrations, seconds for durations.

Defined results: null and empty values, ranges, limits, and values without a number or
without a concentration or duration have a null result; a unit that is none of the quantity
(`mg/kg`, `dilution`) gives null and is never guessed; mass per volume without a molar mass
gives null; a comma groups thousands if the whole part is not 0 and each group after it has
three digits, else it is a decimal comma; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.text import is_missing_qc, strip
from assaylake.session import cut

# Picomolar in one of each unit, written in lower case and with u for micro.
MOLAR = {
    "pm": 1.0, "picomolar": 1.0, "pmol/l": 1.0, "pmol l-1": 1.0, "pmol per litre": 1.0,
    "nm": 1e3, "nanomolar": 1e3, "nmol/l": 1e3, "nmol l-1": 1e3, "nmol per litre": 1e3, "pmol/ml": 1e3, "fmol/ul": 1e3,
    "um": 1e6, "micromolar": 1e6, "umol/l": 1e6, "umol l-1": 1e6, "umol per litre": 1e6, "nmol/ml": 1e6, "pmol/ul": 1e6,
    "mm": 1e9, "millimolar": 1e9, "mmol/l": 1e9, "mmol l-1": 1e9, "mmol per litre": 1e9, "umol/ml": 1e9, "mol/m3": 1e9,
    "m": 1e12, "molar": 1e12, "mol/l": 1e12, "mol l-1": 1e12, "mol per litre": 1e12,
}
# Grams per litre in one of each unit.
MASS = {"g/l": 1.0, "mg/ml": 1.0, "mg/l": 1e-3, "ug/ml": 1e-3, "ug/l": 1e-6, "ng/ml": 1e-6, "ng/l": 1e-9, "pg/ml": 1e-9}
# Decimal logarithms of molar.
LOG_MOLAR = ["log m", "log10 m", "log(m)", "log10(m)"]
# Seconds in one of each unit.
SECONDS = {
    "s": 1.0, "sec": 1.0, "secs": 1.0, "second": 1.0, "seconds": 1.0,
    "min": 60.0, "mins": 60.0, "min.": 60.0, "minute": 60.0, "minutes": 60.0,
    "h": 3600.0, "hr": 3600.0, "hrs": 3600.0, "hour": 3600.0, "hours": 3600.0,
    "d": 86400.0, "day": 86400.0, "days": 86400.0, "whole days": 86400.0,
    "w": 604800.0, "wk": 604800.0, "wks": 604800.0, "week": 604800.0, "weeks": 604800.0,
}
CLOCK = ["h:mm", "hh:mm"]
# Units that a value without any may have, with their factors to the common unit.
GUESSED = {
    "dose": {u: MOLAR[u.lower()] for u in ("pM", "nM", "uM", "mM", "M")},
    "time": {u: SECONDS[u] for u in ("s", "min", "h", "d", "wk")},
}
_NUMBER = r"[+-]?[0-9][0-9,]*(?:\.[0-9]+)?"
_POWER = r"(?:\s*[x*×]\s*10\s*\^\s*([+-]?[0-9]+)|[eE]([+-]?[0-9]+))?"
# Words that change nothing, before and after a value.
_BEFORE = r"(?i)^(?:(?:about|approx\.?|approximately|around|circa|ca\.?|roughly|nominal(?:ly)?|dose|time|t)\s*[=:]?\s+|(?:dose|time|t)\s*[=:]\s*|[~≈@=]\s*)+"
_AFTER = r"(?i)\s*(?:\((?:nominal|final|approx\.?|about|target)\)|\b(?:nominal|final|approx\.?|post|about|total))\s*$"


def unit_text(c: Column) -> Column:
    """Lower case, u for micro, single blanks; null where the unit is silent."""
    t = F.lower(F.regexp_replace(F.regexp_replace(strip(c), "[µμ]", "u"), r"\s+", " "))
    return F.when(~is_missing_qc(c), t)


def number(text: Column, power: Column) -> Column:
    """Value of a written number, with the comma rule, times ten to the power."""
    whole = F.regexp_extract(text, r"^[+-]?([0-9]+)", 1)
    grouped = text.rlike(r"^[+-]?[0-9]+(?:,[0-9]{3})+(?:\.[0-9]+)?$") & ~whole.rlike("^0+$")
    decimal = text.rlike(r"^[+-]?[0-9]+,[0-9]+$")
    plain = F.when(grouped, F.replace(text, F.lit(","), F.lit(""))).when(
        decimal, F.replace(text, F.lit(","), F.lit("."))
    ).when(~text.contains(","), text)
    # read in one piece, so that 3 x 10^-7 is the number nearest to it
    return F.concat(plain, F.lit("e"), F.coalesce(F.nullif(power, F.lit("")), F.lit("0"))).try_cast("double")


def _lookup(c: Column, table: dict[str, float]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c)


def note_unit(note: Column, subject: str) -> Column:
    """The unit that a note names as default for its subject (a pattern)."""
    said = F.filter(F.split(note, r"(?<=\.)\s+"), lambda s: s.rlike(rf"(?i)\b(?:{subject})\b"))
    units = sorted({*MOLAR, *SECONDS}, key=lambda u: (-len(u), u))
    names = "|".join(u.replace(".", r"\.") for u in units if u != "w")
    found = F.transform(
        said,
        lambda s: F.regexp_extract(
            F.lower(F.regexp_replace(s, "[µμ]", "u")),
            rf"(?:\b(?:is|are|in|as|means)|:)\s+(?:counted in\s+|in\s+)?({names})(?=[\s.,;]|$)",
            1
        )
    )
    return F.get(F.filter(found, lambda u: u != ""), F.lit(0))


def _iso_seconds(t: Column) -> Column:
    """ISO 8601 durations such as P1DT12H and PT30M."""
    form = r"(?i)^P(?:([0-9.]+)W)?(?:([0-9.]+)D)?(?:T(?:([0-9.]+)H)?(?:([0-9.]+)M)?(?:([0-9.]+)S)?)?$"
    part = lambda i: F.coalesce(F.regexp_extract(t, form, i).try_cast("double"), F.lit(0.0))
    total = part(1) * 604800 + part(2) * 86400 + part(3) * 3600 + part(4) * 60 + part(5)
    return F.when(t.rlike(form) & t.rlike(r"[0-9]"), total)


def _compound_seconds(t: Column) -> Column:
    """Two or more counts with their units: 12h 30 min, 1d 6h."""
    form = r"^(?:[0-9]+(?:[.,][0-9]+)?\s*\p{L}+\.?[\s,]*){2,}$"
    each = F.transform(
        F.regexp_extract_all(t, F.lit(r"([0-9]+(?:[.,][0-9]+)?\s*\p{L}+\.?)"), F.lit(1)),
        lambda p: F.replace(F.regexp_extract(p, r"^([0-9.,]+)", 1), F.lit(","), F.lit(".")).try_cast("double") * _lookup(
            F.lower(F.regexp_extract(p, r"(\p{L}+\.?)$", 1)), SECONDS
        )
    )
    return F.when(t.rlike(form), F.aggregate(each, F.lit(0.0), lambda a, x: a + x))


_CLOCK = r"^([0-9]{1,3}):([0-5][0-9])(?::([0-5][0-9]))?$"
_DAY = r"(?i)^d(?:ay)?\s*([0-9]+(?:[.,][0-9]+)?)$"


def read_values(rows: DataFrame) -> DataFrame:
    """Adds number, inside (the unit in the value) and text to quantity and written.

    Later steps use each of these several times, so they are columns of their own.
    """
    bare = F.regexp_replace(F.regexp_replace(strip(F.col("written")), _BEFORE, ""), _AFTER, "")
    # day 3 and T36h name the unit or the quantity before the number
    timed = F.regexp_replace(bare, r"^[Tt](?=[0-9])", "")
    timed = F.when(timed.rlike(_DAY), F.concat(F.regexp_extract(timed, _DAY, 1), F.lit(" d"))).otherwise(timed)
    whole = rf"^({_NUMBER}){_POWER}\s*(\p{{L}}[^0-9]*(?:\s*l-1|/m3)?|)$"
    out = rows.withColumn("text", F.when(F.col("quantity") == "time", timed).otherwise(bare))
    part = lambda i: F.regexp_extract("text", whole, i)
    out = out.withColumn(
        "__p", F.when(F.col("text").rlike(whole), F.struct(part(1).alias("n"), F.concat(part(2), part(3)).alias("p"), part(4).alias("u")))
    )
    out = out.withColumns({"number": number(F.col("__p.n"), F.col("__p.p")), "inside_raw": strip(F.col("__p.u"))})
    return out.withColumn("inside", unit_text(F.col("inside_raw"))).drop("__p")


def to_common(rows: DataFrame) -> DataFrame:
    """Adds unit, unit_source and common: picomolar of a dose, seconds of a time.

    rows: quantity, text, number, inside, inside_raw, unit_written, default_unit, molar_mass.
    """
    dose = F.col("quantity") == "dose"
    n, text = F.col("number"), F.col("text")
    out = rows.withColumn("beside", unit_text(F.col("unit_written"))).withColumn("unit", F.coalesce("inside", "beside", "default_unit"))
    out = out.withColumn("told", F.when(~dose, F.coalesce(_iso_seconds(text), _compound_seconds(text))))
    part = lambda i: F.coalesce(F.regexp_extract(text, _CLOCK, i).try_cast("double"), F.lit(0.0))
    clock = F.when(text.rlike(_CLOCK) & F.col("beside").isin(CLOCK), part(1) * 3600 + part(2) * 60 + part(3))
    # a single m could be metre or milli; only the capital letter is molar
    written = F.when(F.col("inside").isNotNull(), F.col("inside_raw")).when(F.col("beside").isNotNull(), strip(F.col("unit_written"))).otherwise("M")
    molar = (F.col("unit") != "m") | (written == "M")
    factor = F.coalesce(F.when(molar, _lookup(F.col("unit"), MOLAR)), _lookup(F.col("unit"), MASS) * 1e12 / F.nullif(F.col("molar_mass"), F.lit(0.0)))
    logged = F.when(F.col("unit").isin(LOG_MOLAR), F.pow(F.lit(10.0), n + 12))
    as_dose = F.coalesce(F.when(n >= 0, n * factor), logged)
    as_time = F.coalesce(F.col("told"), clock, F.when(n >= 0, n * _lookup(F.col("unit"), SECONDS)))
    source = F.when(F.col("told").isNotNull() | F.col("inside").isNotNull(), "value").when(F.col("beside").isNotNull(), "column").when(
        F.col("default_unit").isNotNull(), "note"
    )
    return out.withColumns({"unit_source": source, "common": F.when(dose, as_dose).otherwise(as_time)}).drop("beside", "told")


@dataclass(frozen=True)
class Mixture:
    """Weights of the units of silent values, and the mean and spread of all on the common log scale."""

    weights: np.ndarray
    mean: float
    spread: float


LEAST_SPREAD = 0.1  # decades
PRIOR_VALUES = 5.0  # values for which the fit over all rows counts in a group


def fit_mixture(bins: pd.DataFrame, shifts: np.ndarray, prior: Mixture | None, rounds: int = 100) -> Mixture:
    """Expectation maximisation over bins (x, n, unit, silent); unit is the number of a known unit, or -1.

    x: logarithm of the common value of known ones, of the bare number of silent ones.
    """
    known, silent = bins[~bins["silent"]], bins[bins["silent"]]
    n, x = known["n"].to_numpy(float), known["x"].to_numpy(float)
    m, y = silent["n"].to_numpy(float), silent["x"].to_numpy(float)
    if prior is None:
        # without a known value nothing tells the units apart: a spread as wide as their factors
        seen = np.array([float(n[known["unit"].to_numpy() == u].sum()) for u in range(len(shifts))]) + 1
        mean = float((n * x).sum() / n.sum()) if len(n) else float((m * y).sum() / m.sum() + shifts.mean())
        spread = math.sqrt(float((n * (x - mean) ** 2).sum() / n.sum())) if len(n) else float(np.ptp(shifts)) + 1
        prior = Mixture(seen / seen.sum(), mean, max(spread, LEAST_SPREAD))
    weights, mean, spread, k = prior.weights, prior.mean, prior.spread, PRIOR_VALUES
    for _ in range(rounds if len(n) or prior is None else 0):
        p = weights * np.exp(-0.5 * ((y[:, None] + shifts - mean) / spread) ** 2) + 1e-300
        p *= m[:, None] / p.sum(axis=1, keepdims=True)
        z = y[:, None] + shifts
        total = k + n.sum() + p.sum()
        new = float((k * prior.mean + (n * x).sum() + (p * z).sum()) / total)
        off = k * (prior.spread**2 + (prior.mean - new) ** 2) + (n * (x - new) ** 2).sum() + (p * (z - new) ** 2).sum()
        step = abs(new - mean)
        weights, mean, spread = (k * prior.weights + p.sum(axis=0)) / (k + m.sum()), new, max(math.sqrt(float(off / total)), LEAST_SPREAD)
        if step < 1e-9:
            break
    return Mixture(weights, mean, spread)


def _bins(rows: DataFrame, factors: list[float], width: float) -> DataFrame:
    """Counts and means in bins of the logarithm: some thousand rows of a group at most."""
    silent = F.col("unit").isNull() & F.col("common").isNull()
    x = F.log10(F.when(silent, F.col("number")).otherwise(F.col("common")))
    ratio = F.log10(F.col("common") / F.when(F.col("number") > 0, F.col("number")))
    unit = F.coalesce(*[F.when(~silent & (F.abs(ratio - math.log10(f)) < 1e-6), i) for i, f in enumerate(factors)], F.lit(-1))
    held = rows.where((silent & (F.col("number") > 0)) | (F.col("common") > 0))
    return held.select("grp", silent.alias("silent"), unit.alias("unit"), F.round(x / width).cast("int").alias("bin"), x.alias("x")).groupBy(
        "grp", "silent", "unit", "bin"
    ).agg(F.count("*").cast("double").alias("n"), F.avg("x").alias("x"))


def assign_units(
    df: DataFrame,
    number_col: str,
    common: str,
    units: list[str],
    factors: list[float],
    sure: float = 0.9,
    group: str | None = None,
    width: float = 0.05
) -> DataFrame:
    """Adds guessed_unit, guessed_common, posterior and uncertain where no unit is known.

    group: column whose values have a mean and spread of their own. Values are counted into
    bins of ``width`` decades before they are gathered, so a fit takes some thousand bins
    whatever the number of rows of a group.
    """
    spark = df.sparkSession
    grp = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    shifts = np.log10(np.array(factors))
    bins = cut(_bins(df.select(grp.alias("grp"), F.col(number_col).alias("number"), F.col(common).alias("common"), "unit"), factors, width))
    over_all = bins.groupBy("silent", "unit", "bin").agg((F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("x"), F.sum("n").alias("n")).toPandas()
    if over_all.empty:
        over_all = pd.DataFrame({"silent": [False], "unit": [-1], "x": [0.0], "n": [0.5]})
    prior = fit_mixture(over_all, shifts, None)

    def fit(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        m = fit_mixture(own, shifts, prior)
        return pd.DataFrame({"grp": [key[0]], "mean": [m.mean], "spread": [m.spread], "weights": [m.weights.tolist()]})

    asked = bins.where("silent").select("grp").distinct()
    fits = bins.join(asked, "grp", "left_semi").groupBy("grp").applyInPandas(fit, "grp string, mean double, spread double, weights array<double>")
    silent = F.col(number_col).isNotNull() & F.col("unit").isNull() & F.col(common).isNull() & (F.col(number_col) > 0)
    x = F.log10(F.col(number_col))
    dens = [
        F.get("__fit.weights", F.lit(i)) * F.exp(-0.5 * F.pow((x + math.log10(f) - F.col("__fit.mean")) / F.col("__fit.spread"), F.lit(2.0))) + 1e-300
        for i, f in enumerate(factors)
    ]
    total = reduce(lambda a, b: a + b, dens)
    options = F.array_sort(
        F.array(*[F.struct((-d / total).alias("p"), F.lit(u).alias("unit"), F.lit(f).alias("factor")) for d, u, f in zip(dens, units, factors)])
    )
    out = df.withColumn("__grp", grp).join(fits.select(F.col("grp").alias("__grp"), F.struct("mean", "spread", "weights").alias("__fit")), "__grp", "left")
    out = out.withColumn("__best", F.when(silent, F.get(options, F.lit(0))))
    return out.withColumns(
        {
            "guessed_unit": F.col("__best.unit"),
            "guessed_common": F.col(number_col) * F.col("__best.factor"),
            "posterior": -F.col("__best.p"),
            "uncertain": F.when(silent, -F.col("__best.p") < sure)
        }
    ).drop("__best", "__grp", "__fit")


def guess_units(converted: DataFrame) -> DataFrame:
    """The rows of convert_conditions without any known unit, each quantity with a mixture of its own."""
    parts = []
    for quantity, factors in GUESSED.items():
        rows = converted.where(F.col("quantity") == quantity)
        parts.append(assign_units(rows, "number", "common", list(factors), list(factors.values()), group="source"))
    return reduce(DataFrame.unionByName, parts).where("guessed_unit is not null")


def convert_conditions(conditions: DataFrame, sources: DataFrame, compounds: DataFrame) -> DataFrame:
    """(condition_id, quantity, source, written, unit_written, number, unit, unit_source, common).

    source: the compound of a dose, the data set of a time. ``sources`` has a note for each data set, ``compounds`` a molar mass for each name; both
    are joined by key.
    """
    said = sources.groupBy("dataset_id").agg(F.min("protocol_note").alias("note"))
    notes = said.select(
        "dataset_id",
        note_unit(F.col("note"), "doses?|concentrations?").alias("dose_default"),
        note_unit(F.col("note"), "times?|time points?|harvest times?").alias("time_default")
    )
    masses = compounds.where("molar_mass is not null").groupBy(F.col("entry_name").alias("perturbation_id")).agg(
        F.min("molar_mass").alias("molar_mass")
    )
    rows = conditions.select(
        "condition_id", "dataset_id", "perturbation_id", "dose", "dose_unit", "time", "time_unit"
    ).join(notes, "dataset_id", "left").join(masses, "perturbation_id", "left")
    one = lambda q: F.struct(
        F.lit(q).alias("quantity"),
        F.col("perturbation_id" if q == "dose" else "dataset_id").alias("source"),
        F.col(q).alias("written"),
        F.col(f"{q}_unit").alias("unit_written"),
        F.col(f"{q}_default").alias("default_unit")
    )
    long = rows.select("condition_id", "molar_mass", F.explode(F.array(one("dose"), one("time"))).alias("q")).select(
        "condition_id", "molar_mass", "q.*"
    )
    return to_common(read_values(long)).select(
        "condition_id", "quantity", "source", "written", "unit_written", "number", "unit", "unit_source", "common"
    )


def converted_cases(converted: DataFrame) -> DataFrame:
    """(condition_id, quantity, common_value) of values that had to be converted, each once.

    The distinct values of a row are gathered by an aggregation, not by a filter and distinct:
    a filter on the result would be pushed below the steps that make it and repeat them.
    """
    plain = F.coalesce(
        F.col("written").rlike(r"^[0-9]+(?:\.[0-9]+)?\z") & (
            F.col("unit_written") == F.when(F.col("quantity") == "dose", "nM").otherwise("h")
        ),
        F.lit(False)
    )
    value = F.when(~plain, F.round(F.round("common", 6)).cast("bigint"))
    return converted.groupBy("condition_id", "quantity").agg(F.collect_set(value).alias("v")).select(
        "condition_id", "quantity", F.explode("v").alias("common_value")
    )
