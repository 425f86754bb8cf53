import random

from assaylake.llm.leaks import find_leaks, lcs, words

VOCAB = [f"w{i}" for i in range(60)]


def brute(docs, items, n=12):
    grams = {}
    for item, *parts in items:
        for p in parts:
            w = words(p)
            for i in range(len(w) - n + 1):
                grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = set()
    for key, text in docs:
        w = words(text)
        for i in range(len(w) - n + 1):
            out |= {(key, item) for item in grams.get(tuple(w[i : i + n]), ())}
    return out


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, "clash", 1) for r in docs], "doc_id long, body string, text string, item_id int")
    i = spark.createDataFrame(items, "item_id long, prompt string, solution string")
    return find_leaks(d, "doc_id", "body", i, "item_id", ["prompt", "solution"], **kw)


def test_every_run_is_found(spark):
    rng = random.Random(8)
    items = [
        (
            100 + k, " ".join(rng.choices(VOCAB, k=rng.randint(5, 80))), None if k % 5 == 0 else " ".join(rng.choices(VOCAB, k=40))
        ) for k in range(25)
    ]
    docs = [(0, None), (1, ""), (2, "Ünï " * 50)]
    for k in range(150):
        w = rng.choices([f"x{i}" for i in range(300)] + VOCAB, k=rng.randint(0, 120))
        source = words(rng.choice(items)[rng.choice([1, 2])] or "")
        length, at = rng.choice([11, 12, 13, 30]), rng.randint(0, max(0, len(w) - 1) if w else 0)
        start = rng.randint(0, max(0, len(source) - length))
        cut = [x.decode() for x in source[start : start + length]]
        docs.append((10 + k, rng.choice([" ", "\n// ", "-"]).join([*w[:at], *(x.upper() if rng.random() < 0.3 else x for x in cut), *w[at:]])))
    docs += docs[5:9]
    got = {(r.doc_id, r.item_id) for r in run(spark, docs, items).where("exact").collect()}
    want = brute(docs, items)
    assert got == want and len(want) > 30
    again = {(r.doc_id, r.item_id) for r in run(spark, docs, items, block=7).where("exact").collect()}
    assert again == want


def test_paraphrases_are_told_apart(spark):
    prompt = " ".join(VOCAB[:40])
    changed = " ".join(w if i % 9 else "other" for i, w in enumerate(VOCAB[:40]))
    r = run(spark, [(1, prompt), (2, changed)], [(7, prompt, "")]).orderBy("doc_id").collect()
    assert [(x.doc_id, x.exact) for x in r] == [(1, True), (2, False)] and r[1].lcs_share >= 0.8


def test_a_run_between_rare_item_words_is_found(spark):
    """A run of common words, with rare words of other items all around, is a link like any other."""
    rng = random.Random(4)
    common, rare = [f"c{i}" for i in range(20)], [f"rare{i}" for i in range(400)]
    items = [(k, " ".join(rng.choices(common, k=14)), " ".join(rng.sample(rare, 60))) for k in range(12)]
    docs = [(i, " ".join(rng.choices(common, k=60))) for i in range(200)]
    for k, (item, prompt, _) in enumerate(items):
        others = [w for j, _, s in items if j != item for w in rng.sample(s.split(), 6)]
        rng.shuffle(others)
        docs.append((1000 + k, " ".join([*others[:12], *prompt.split()[1:13], *others[12:24]])))
    got = {(r.doc_id, r.item_id) for r in run(spark, docs, items, near=None).where("exact").collect()}
    assert got == brute(docs, items) and {(1000 + k, k) for k in range(12)} <= got


def test_items_in_several_blocks(spark):
    rng = random.Random(5)
    items = [(k, " ".join(rng.choices(VOCAB, k=30)), " ".join(rng.choices(VOCAB, k=30))) for k in range(20)]
    docs = [(k, "x " * k + " ".join(items[k][1 + k % 2].split()[3:20])) for k in range(20)]
    for near in (None, 0.7):
        got = {(r.doc_id, r.item_id) for r in run(spark, docs, items, near=near, block_chars=600).where("exact").collect()}
        assert got == brute(docs, items)


def test_planted_paraphrases_and_answers(spark):
    """Every eighth word changed, so that no run of twelve is left: found, and the answer is told from the rest."""
    rng = random.Random(6)
    vocab = [f"v{i}" for i in range(900)]
    items = [(k, " ".join(rng.sample(vocab, 48)), " ".join(rng.sample(vocab, 48))) for k in range(20)]
    change = lambda t: " ".join(w if i % 8 else "zzz" for i, w in enumerate(t.split()))
    docs, want = [(i, " ".join(rng.choices(vocab, k=100))) for i in range(100)], {}
    for k, (item, prompt, solution) in enumerate(items):
        docs.append((1000 + k, change(solution if k % 2 else prompt)))
        want[1000 + k] = (item, bool(k % 2))
    rows = run(spark, docs, items).collect()
    assert not any(r.exact for r in rows)
    found = {r.doc_id: (r.item_id, r.answer_share >= 0.5) for r in rows if r.lcs_share >= 0.8}
    assert found == want


def test_long_text_and_empty_tables(spark):
    item = [(7, " ".join(VOCAB[:30]), "")]
    far = "noise " * 200_000 + " ".join(VOCAB[5:17])
    assert {(r.doc_id, r.item_id) for r in run(spark, [(1, far)], item).where("exact").collect()} == {(1, 7)}
    assert run(spark, [(1, far)], item).where("exact").count() == 1
    empty = spark.createDataFrame([], "doc_id long, body string")
    items = spark.createDataFrame(item, "item_id long, prompt string, solution string")
    assert find_leaks(empty, "doc_id", "body", items, "item_id", ["prompt", "solution"]).count() == 0
    assert find_leaks(empty, "doc_id", "body", items.limit(0), "item_id", ["prompt", "solution"]).count() == 0


def test_lcs():
    rng = random.Random(2)
    for _ in range(200):
        a, b = rng.choices(range(5), k=rng.randint(0, 12)), rng.choices(range(5), k=rng.randint(0, 12))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert lcs(a, b) == t[-1][-1]
