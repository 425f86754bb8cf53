from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from assaylake.operators import packed
from assaylake.operators.packed import protected, protected_names, unpack

NAMES = ["alpha", "b2", "pike;rerun", "arden, second pass", "O'Vane-3", "two words", "under_score", "Fex (rac)", "a/b", "x|y"]


def split(spark, texts, least=1):
    ref = spark.createDataFrame([(n,) for n in NAMES], "name string")
    rows = spark.createDataFrame([(str(i), t, "extra") for i, t in enumerate(texts)], "id string, field string, item string")
    out = {}
    for r in unpack(rows, "id", "field", protected_names(ref, "name"), least).collect():
        out.setdefault(int(r.row_key), []).append((r.item_no, r.item))
    return [sorted(out.get(i, [])) for i in range(len(texts))]


def test_forms(spark):
    cases = {
        "alpha;b2": [(1, "alpha"), (2, "b2")],
        " alpha ; ; b2 ; ": [(1, "alpha"), (3, "b2")],
        '"pike;rerun"|alpha': [(1, "pike;rerun"), (2, "alpha")],
        "pike;rerun;alpha": [(1, "pike;rerun"), (2, "alpha")],
        "['arden, second pass', 'b2']": [(1, "arden, second pass"), (2, "b2")],
        '["O\'Vane-3", "b2"]': [(1, "O'Vane-3"), (2, "b2")],
        "'O\\'Vane-3', 'b2'": [(1, "O'Vane-3"), (2, "b2")],
        "O'Vane-3&alpha": [(1, "O'Vane-3"), (2, "alpha")],
        "under_score_b2": [(1, "under_score"), (2, "b2")],
        "(alpha ; Fex (rac))": [(1, "alpha"), (2, "Fex (rac)")],
        "alpha\n  b2": [(1, "alpha"), (2, "b2")],
        "b2+b2": [(1, "b2"), (2, "b2")],
        "two words\tx|y": [(1, "two words"), (2, "x|y")],
    }
    assert split(spark, list(cases)) == list(cases.values())


def test_apostrophes_and_quotes_without_partner(spark):
    cases = {
        "O'Brien;Smith;Jones": [(1, "O'Brien"), (2, "Smith"), (3, "Jones")],
        "Smith;O'Brien": [(1, "Smith"), (2, "O'Brien")],
        "it's; 'a;b' ;'c'": [(1, "it's"), (2, "a;b"), (3, "c")],
        '"a;b;alpha': [(1, "a"), (2, "b"), (3, "alpha")],
        "alpha;'b;c": [(1, "alpha"), (2, "b"), (3, "c")],
        '"a ""b;c"" d";e': [(1, 'a "b;c" d'), (2, "e")],
        '"it\'s;x";e': [(1, "it's;x"), (2, "e")],
        "a\ue001b\ue000;c": [(1, "a\ue001b\ue000"), (2, "c")],
        '"see pike;rerun here";alpha': [(1, "see pike;rerun here"), (2, "alpha")],
        '""': [], "'": [], '"': [], '";"': [(1, ";")],
    }
    assert split(spark, list(cases)) == list(cases.values())


def test_long_name_lists_are_joined(spark, monkeypatch):
    rows = spark.createDataFrame(
        [("1", "pike;rerun;alpha"), ("2", "O'Vane-3&x|y"), ("3", "O\\'Vane-3&two words"), ("4", None), ("5", "xpike;rerun"), ("6", "a/b_under_score/b2")] * 2,
        "id string, field string"
    )
    ref = protected(spark.createDataFrame([(n,) for n in [*NAMES, None, ";;", *(f"n;{i}" for i in range(50))]], "name string"), "name")
    short = sorted(unpack(rows, "id", "field", ref).collect())
    monkeypatch.setattr(packed, "IN_ONE_PATTERN", 3)
    assert sorted(unpack(rows, "id", "field", ref).collect()) == short and len(short) == 22


def test_nothing_to_split(spark):
    assert split(spark, [None, "", "nan", "alpha", "a/b", "alpha;", ";;"], 2) == [[]] * 7


def test_long_field(spark):
    assert len(split(spark, [";".join(["alpha"] * 20_000)])[0]) == 20_000


def test_empty_table(spark):
    rows = spark.createDataFrame([], "id string, field string")
    assert unpack(rows, "id", "field", []).count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(
            st.lists(st.sampled_from([*NAMES, ""]), min_size=2, max_size=6),
            st.sampled_from([";", "|", ",", "+", "&", "/", "\t", "\n"]),
            st.sampled_from(["", '"', "'"]),
            st.sampled_from(["", " "])
        ),
        min_size=1,
        max_size=20
    )
)
def test_round_trip(spark, data):
    texts, want = [], []
    for values, delimiter, quote, gap in data:
        q = quote if quote != "'" else "'"
        texts.append(delimiter.join(f"{gap}{q}{v}{q}{gap}" if v and not (q == "'" and "'" in v) else f"{gap}{v}{gap}" for v in values))
        want.append([(i, v) for i, v in enumerate(values, 1) if v])
    assert split(spark, texts) == want
