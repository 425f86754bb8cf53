import hashlib
import random

import pytest

from assaylake.llm import encoding as E

LINES = [
    "Prüft, ob die Größe gültig ist, und überspringt übrige Schlüssel.",
    "Esta función añade la línea más pequeña al índice según el tamaño.",
    "Vérifie que la tâche est déjà créée après la première requête.",
    "Každý soubor má svůj vlastní klíč, viz řádková část a zásobník.",
    "Здесь строка пересчитывается после каждой записи, возвращаем ошибку.",
    "Потім зменшуємо розмір, якщо черга порожня, і закриваємо файл.",
    "Don’t reuse the slot — it isn’t “safe” after a flush…",
    "如果缓存为空,则返回默认值。",
    "この配列は読み込み後に削除される。",
    "Atenção: a posição só é válida após a correção da função.",
]
MIXED = [
    (0, "utf-8", "cp1252"), (1, "utf-8", "latin-1"), (2, "utf-8", "cp437"), (0, "cp1252", "cp437"), (
        1, "mac_roman", "cp1252"
    ), (2, "cp1252", "mac_roman"), (3, "cp1250", "cp1252"), (4, "utf-8", "cp1251"),
    (4, "cp1251", "latin-1"), (4, "koi8-r", "cp1251"), (5, "cp1251", "koi8-u"), (6, "utf-8", "cp1252"), (7, "gbk", "latin-1"), (
        8, "shift_jis", "latin-1"
    ), (7, "utf-8", "latin-1"), (9, "utf-8", "cp850"), (9, "utf-8", "mac_roman"),
]


def misread(text: str, written: str, read: str) -> str:
    raw = text.encode(written)
    return "".join(bytes([b]).decode(read, "ignore") or chr(b) for b in raw)


@pytest.fixture(scope="module")
def result(spark):
    rng = random.Random(6)
    clean = [(i, "\n".join(f"// {rng.choice(LINES)}" for _ in range(4)) + "\nreturn x;") for i in range(400)]
    docs, want = [
        *clean,
        (500, None),
        (501, ""),
        (502, "│ ├── └── ░▒▓ ╔═╗"),
        (503, "Ã Â Ð Þ ß ð (accent table)"),
        (504, "x = '�' ; y = 1"),
        (505, "plain ascii")
    ], {}
    key = 1000
    for line, written, read in MIXED:
        bad = misread(LINES[line], written, read)
        for whole in (True, False):
            other = LINES[(line + 1) % len(LINES)]
            text = f"{bad}\ncode();\n{bad}" if whole else f"# {other}\r\n\tx = 1;\r\n# {bad}"
            docs.append((key, text))
            want[key] = text.replace(bad, LINES[line])
            key += 1
    twice = misread(misread(LINES[0], "utf-8", "cp1252"), "utf-8", "cp1252")
    docs.append((key, twice))
    want[key] = LINES[0]
    lost = LINES[1].replace("ó", "��").replace("ñ", "��")
    docs.append((key + 1, lost))
    want[key + 1] = None
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, body string, text string, token int")
    return {r.doc_id: r for r in E.restore_garbled(df, "doc_id", "body").collect()}, want, key + 1


def test_every_garbled_text_is_restored(result):
    got, want, _ = result
    for key, text in want.items():
        assert got[key].restored_md5 == ("" if text is None else hashlib.md5(text.encode()).hexdigest()), (key, got[key].restored, text)


def test_right_texts_stay(result):
    got, want, _ = result
    assert set(got) == set(want)


def test_lost_characters_are_guessed_but_not_claimed(result):
    got, _, lost = result
    assert got[lost].restored is None and got[lost].guess == LINES[1]


def test_empty_table(spark):
    assert E.restore_garbled(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0
    nulls = spark.createDataFrame([(None, "Prüft"), (1, None)], "doc_id long, text string")
    assert E.restore_garbled(nulls, "doc_id", "text").count() == 0


@pytest.mark.parametrize("alike", [True, False])
def test_text_on_a_third_of_the_rows(spark, alike):
    rng = random.Random(7)
    bad = misread(LINES[0], "utf-8", "cp1252")
    clean = [(i, "\n".join(f"// {LINES[(i + k) % len(LINES)]}" for k in range(3))) for i in range(200)]
    copies = [(1000 + i, f"// {bad}" if alike else f"// {bad}\n# copy {rng.random()}") for i in range(100)]
    df = spark.createDataFrame(clean + copies, "doc_id long, text string")
    got = {r.doc_id: r.restored_md5 for r in E.restore_garbled(df, "doc_id", "text").collect()}
    assert got == {i: hashlib.md5(t.replace(bad, LINES[0]).encode()).hexdigest() for i, t in copies}


def test_weak_evidence_adds_up_over_the_places_of_a_word(spark):
    bad = misread("řádek", "cp1250", "cp1252")
    docs = [(i, f"// řádek {i}") for i in range(10)] + [(20, f"{bad} a\n{bad} b\n{bad} c"), (21, f"{bad} d")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.restored for r in E.restore_garbled(df, "doc_id", "text").collect()}
    assert got == {20: "řádek a\nřádek b\nřádek c"}


def test_wildcards():
    assert E.skeleton("funció") == "funci��" and E.fits("funci��n", "función") and not E.fits("funci�n", "función")
    assert E.lattice("caf\u00c3\ufffd", "cp1252") == [99, 97, 102, 0xC3, -1] and E.lattice("\u4e2d", "cp1252") is None
    assert E.lost("a�") and E.lost("��") and not E.lost("'�'")


OUTSIDE = [
    (0, "utf-8", "gbk"), (2, "utf-8", "cp1253"), (3, "utf-8", "iso8859-2"), (4, "cp866", "cp437"), (9, "utf-8", "cp1257"), (0, "cp850", "mac_roman"),
    (4, "utf-8", "gbk"), (5, "cp866", "koi8-r"), (3, "iso8859-2", "cp1252"), (9, "cp850", "cp437"),
]


def strictly(line, written, read):
    """The words of a line that can be read in the wrong encoding without loss."""
    kept = []
    for w in line.split():
        try:
            bad = w.encode(written).decode(read)
        except UnicodeError:
            continue
        if bad.encode(read) == w.encode(written) and not any(c.isspace() or c < " " or "\x7f" <= c < "\xa0" for c in bad):
            kept.append((bad, w))
    return kept


def test_channels_beyond_the_usual_ones(spark):
    """Other readings of UTF-8, also in encodings of several bytes, and other pairs of one script."""
    docs, want = [(i, "\n".join(f"// {LINES[(i + k) % len(LINES)]}" for k in range(4))) for i in range(300)], {}
    for key, (line, written, read) in enumerate(OUTSIDE, 1000):
        pairs = strictly(LINES[line], written, read)
        assert any(a != b for a, b in pairs), (line, written, read)
        docs.append((key, "# " + " ".join(a for a, _ in pairs)))
        want[key] = "# " + " ".join(b for _, b in pairs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.restored for r in E.restore_garbled(df, "doc_id", "text").collect()}
    assert got == want


def test_wildcards_in_misread_text_are_filled(spark):
    """UTF-8 read as another encoding and then damaged: the lattice keeps the bytes that are known."""
    docs = [(i, f"// café {LINES[2]} {LINES[0]}") for i in range(20)] + [(50, "x cafÃ\ufffd y"), (51, "z GrÃ\ufffdÃ\u0178e"), (52, "w gr\ufffd\ufffd")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in E.restore_garbled(df, "doc_id", "text").collect()}
    assert got[50].guess == "x café y" and got[51].guess == "z Größe" and got[52].guess == "w gr\ufffd\ufffd"
    assert all(got[k].restored is None and got[k].restored_md5 == "" for k in (50, 51, 52))
