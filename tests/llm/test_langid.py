import itertools
import random
import tracemalloc

import numpy as np

from regionflow.llm import langid

RNG = random.Random(8)
PARTS = {"xx": ["ka", "to", "mi", "ra"], "yy": ["sch", "ung", "ein", "ber"], "ru": ["да", "ни", "то", "ко"]}


def text(lang, n=25):
    return " ".join("".join(RNG.choice(PARTS[lang]) for _ in range(RNG.randint(1, 3))) for _ in range(n))


def slow(scores, penalty):
    n, k = scores.shape
    value = lambda p: sum(scores[i, s] for i, s in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:]))
    return max(value(p) for p in itertools.product(range(k), repeat=n))


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    counts = np.array([3, 0, 6, 1, 5])
    scores = rng.normal(0, 3, (counts.sum(), 3))
    label = langid.viterbi(scores, counts, 2.0)
    at = 0
    for n in counts:
        p, s = label[at : at + n], scores[at : at + n]
        if n:
            got = sum(s[i, v] for i, v in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
            assert abs(got - slow(s, 2.0)) < 1e-9
        at += n


def test_learns_and_labels_spans(spark):
    pairs = [(text(k), k) for k in PARTS for _ in range(40)]
    model = langid.train([t for t, _ in pairs], [k for _, k in pairs])
    a, b = text("xx", 12), text("yy", 30)
    rows = [(1, None), (2, ""), (3, "123 ..."), (4, text("xx")), (4, text("xx")), (5, f"{a}, {b}"), (6, text("ru")), (7, "日本"), (None, text("yy", 30_000))]
    df = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = langid.identify(df, model).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert [r.lang_pred for r in got[3:7]] == ["xx", "xx", "yy", "ru"] and got[7].lang_pred in PARTS and got[8].lang_pred == "yy"
    assert [(s.start, s.end, s.lang) for s in got[5].spans] == [(0, len(a), "xx"), (len(a) + 2, len(a) + 2 + len(b), "yy")]
    assert langid.identify(df.limit(0), model).count() == 0
    empty = langid.train([], [])
    assert {r.lang_pred for r in langid.identify(df, empty).collect()} == {"und"}


def test_held_out_accuracy():
    pairs = [(text(k, 8), k) for k in PARTS for _ in range(80)]
    model = langid.train([t for t, _ in pairs[::2]], [k for _, k in pairs[::2]])
    w, label = model.label([t for t, _ in pairs[1::2]], model.rows())
    right = [model.languages[label[w["text"] == i][0]] == k for i, (_, k) in enumerate(pairs[1::2])]
    assert np.mean(right) > 0.99


def test_every_language_is_learned(spark):
    """Thirty languages, the last ones with the fewest texts, each of three letters of its own order."""
    names = [f"l{i:02}" for i in range(30)]
    words_of = {n: ["".join(p) for p in itertools.product("abcdefghijklmnoprstuvwyzäöüßéè"[i] + "xq", repeat=3)] for i, n in enumerate(names)}
    rng = random.Random(3)
    said = lambda n: " ".join(rng.choice([w for w in words_of[n] if w[0] not in "xq"]) for _ in range(20))
    rows = [(1000 * i + k, said(n), n) for i, n in enumerate(names) for k in range(40 - i)] + [(None, "no language", None)]
    model = langid.train_from(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == names
    asked = spark.createDataFrame([(n, said(n)) for n in names], "want string, text string")
    assert langid.identify(asked, model).where("want <> lang_pred").count() == 0


def test_viterbi_over_many_labels():
    scores = np.zeros((4, 300))
    scores[:2, 299], scores[2:, 280] = 9.0, 9.0
    assert langid.viterbi(scores, np.array([4]), 1.0).tolist() == [299, 299, 280, 280]


def test_long_texts_equal_short_ones(monkeypatch):
    pairs = [(text(k), k) for k in PARTS for _ in range(40)]
    model = langid.train([t for t, _ in pairs], [k for _, k in pairs])
    mixed = "! ".join(text(k, 40) for k in ("xx", "yy", "ru", "yy", "xx")) + " " + "".join(PARTS["ru"]) * 400 + " ..."
    w, want = model.label([mixed], model.rows())
    for size in (50, 333, 10_000):
        v, got = model.label_long(mixed, model.rows(), size)
        assert (got == want).all() and (v["place"] == w["place"]).all() and (v["size"] == w["size"]).all()
    whole = model.scores(w, model.rows())
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert np.allclose(model.scores(w, model.rows()), whole, atol=1e-3)


def test_a_long_text_takes_bounded_memory():
    names = [f"l{i}" for i in range(24)]
    model = langid.train([text("xx", 5)] * 24, names)
    long = text("xx", 5000) * 60  # 1.7 million code points
    model.label_long(long, model.rows())
    tracemalloc.start()
    try:
        model.label_long(long, model.rows(), 100_000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 30 * len(long)


def test_letters_of_a_large_script_count_as_themselves():
    rng = random.Random(2)
    signs = {k: [chr(0x4E00 + 2000 * i + rng.randrange(1500)) for _ in range(300)] for i, k in enumerate(("a", "b", "c"))}
    said = lambda k, n: "，".join("".join(rng.choice(signs[k]) for _ in range(8)) for _ in range(n))
    model = langid.train([said(k, 60) for k in signs for _ in range(20)], [k for k in signs for _ in range(20)])
    for k in signs:
        _, label = model.label([said(k, 5)], model.rows())
        assert {model.languages[x] for x in label} == {k}


def test_letters_of_the_last_planes_are_letters():
    own = langid.words(["\U00030000\U00030001 \U000323af", "\U00040000 \U000e0041 1"])
    assert list(own["text"]) == [0, 0] and list(own["size"]) == [2, 1]
    assert {langid.NAMES[s] for s in own["script"]} == {"Han"}
    assert not any(chr(cp).isalpha() for cp in range(langid._POINTS, 0x110000))
