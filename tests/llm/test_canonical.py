import random
import string

import pytest

from assaylake.llm.canonical import edits, fold, map_typed, map_values

ENTRIES = [
    (1, "p", "EQMB24"),
    (2, "p", "VQTBW47"),
    (3, "p", "Temquiraxamine"),
    (4, "p", "Karvelin-4,6"),
    (5, "p", "Sibberal & Co-drug"),
    (6, "p", "vehicle only"),
    (7, "p", "control"),
    (11, "s", "control"),
    (12, "s", "negative_control"),
    (13, "s", "non_targeting"),
    (14, "s", "targeting")
]
CASES = {
    ("p", "eqmb24"): 1, ("p", "sgEQMB24"): 1, ("p", "EQMB24-KO"): 1, ("p", "EQM​B24"): 1, ("p", "ＥＱＭＢ２４"): 1, ("p", "ЕQМВ24"): 1, (
        "p", "EQMMB24 guide 2"
    ): 1, ("p", "[EQBM24]"): 1, ("p", "  VQTBW47\xa0"): 2, ("p", "VQTBW-47"): 2,
    ("p", "Temq uiraxamine"): 3, ("p", "Tèmqüiraxamïne"): 3, ("p", "Temquirax."): 3, (
        "p", "cpd. temquirxamnie lot 12"
    ): 3, ("p", "karvelin-4,6 in DMSO"): 4, ("p", "sibberall & co-drug"): 5, ("p", "VEHICLE ONYL?"): 6, ("p", "drug=EQMB24"): 1,
    ("p", "tube 52"): -1, ("p", "WBDD17"): -1, ("p", "???"): -1, ("p", "Xaminetemqui"): -1, ("p", "x" * 5000): -1,
    ("s", "Negative control"): 12, ("s", "NEAGTIVE CONTROL"): 12, ("s", "Negativecontrol"): 12, ("s", "= control"): 11, ("s", "non target."): 13, ("s", "targetting"): 14, (
        "s", "nontargeting wells"
    ): 13, ("s", "2"): -1,
}


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame(ENTRIES, "entry_id long, entry_field string, entry_name string")


def test_typed_values(spark, reference):
    rows = [(f"c{i}", v if f == "p" else None, v if f == "s" else None, "clash", 1) for i, (f, v) in enumerate(CASES)] + [
        ("n1", "EQMB24", "control", "", 0), ("n2", "nan", " ", "", 0), ("n3", None, "NA", "", 0), ("c0", "eqmb24", None, "", 0)
    ]
    df = spark.createDataFrame(rows, "id string, p string, s string, value string, field int")
    got = {(r.id, r.field_name): r.entry_id for r in map_typed(df, "id", ["p", "s"], reference).collect()}
    assert got == {(f"c{i}", f): want for i, ((f, _), want) in enumerate(CASES.items())}


def test_empty_tables(spark, reference):
    df = spark.createDataFrame([("a", "eqmb24")], "id string, p string")
    assert map_typed(df.limit(0), "id", ["p"], reference).count() == 0
    assert [r.entry_id for r in map_typed(df, "id", ["p"], reference.limit(0)).collect()] == [-1]


def test_edits_and_folding():
    assert edits("abcd", "abdc") == 1 and edits("abc", "") == 3 and edits("kitten", "sitting") == 3
    assert fold("Ｗénl­öth") == "wenloth"


def scores(spark, pairs, names):
    ref = spark.createDataFrame([(i, "f", n) for i, n in enumerate(names, 1)], "entry_id long, entry_field string, entry_name string")
    df = spark.createDataFrame([("f", v) for v in pairs], "field string, value string")
    return {r.value: (r.entry_id, r.score) for r in map_values(df, ref).collect()}


def test_words_without_match_weigh(spark):
    names = ["dmso", "Homo sapiens liver", "Homo sapiens kidney", "Mus musculus liver", "B R C A 1"]
    got = scores(spark, ["not dmso at all, something completely different", "Homo liver", "dmso 10%", "liver", "brca1", "b-r-c-a 1"], names)
    assert got["not dmso at all, something completely different"][0] == -1
    assert got["Homo liver"][0] == 2 and 0.6 < got["Homo liver"][1] < 1
    assert got["dmso 10%"][0] == 1 and got["liver"][0] == -1 and got["brca1"][0] == 5 and got["b-r-c-a 1"][0] == 5


def test_held_out_noise(spark):
    """Slips and additions over made-up names: nearly all are found, and names of no entry are not."""
    rng = random.Random(12)
    name = lambda: "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(4, 6)))
    names = sorted({name().capitalize() + rng.choice(["", "", " " + rng.choice(["prime", "beta", "sodium", "acetate"])]) for _ in range(300)})

    def typed(n):
        t = list(n)
        i = rng.randrange(len(t) - 1)
        kind = rng.choice("dist")
        t[i : i + 2] = {"d": t[i + 1 : i + 2], "i": [t[i], rng.choice(string.ascii_lowercase), t[i + 1]], "s": ["q", t[i + 1]], "t": [t[i + 1], t[i]]}[kind]
        return rng.choice(["{}", "{} lot 12", "cpd. {}", "{} (plate edge)", "  {}?"]).format("".join(t))

    want = {typed(n): i for i, n in enumerate(names, 1)} | {f"{name()}{name()}": -1 for _ in range(100)}
    got = scores(spark, list(want), names)
    assert sum(got[v][0] == i for v, i in want.items() if i > 0) >= 0.97 * sum(i > 0 for i in want.values())
    assert sum(got[v][0] == -1 for v, i in want.items() if i < 0) >= 99


def test_a_word_that_all_entries_share(spark):
    names = [f"{w}on protein" for w in ("alph", "bet", "gamm", "delt", "epsil", "zet", "iot", "kapp", "lambd", "omeg")] * 1
    got = scores(spark, ["protein", "gammon protien", "omegon", "proteins x"], names)
    assert [got[v][0] for v in ("protein", "gammon protien", "omegon", "proteins x")] == [-1, 3, 10, -1]
