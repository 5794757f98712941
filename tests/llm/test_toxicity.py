import random

import numpy as np

from regionflow.llm import toxicity as x

RNG = random.Random(6)
BAD = ["grumbold", "snarvik", "plotzer"]


def sentence(n=30):
    return " ".join("".join(RNG.choice("abdeilmnorstu") for _ in range(RNG.randint(2, 8))) for _ in range(n))


def corpus(n):
    texts, labels = [], []
    for i in range(n):
        words = sentence().split()
        if i % 3 == 0:
            words[RNG.randrange(len(words))] = RNG.choice(BAD)
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def kernel(s, t):
    """The kernel of two short strings by definition: shared subsequences of three, weighted by their spans."""
    def table(u):
        out = {}
        for i in range(min(len(u), x.WINDOW)):
            for j in range(i + 1, len(u)):
                for k in range(j + 1, min(len(u), i + x.SPAN)):
                    out[u[i], u[j], u[k]] = out.get((u[i], u[j], u[k]), 0) + x.DECAY ** (k - i + 1)
        return out
    a, b = table(s), table(t)
    return sum(v * b[k] for k, v in a.items() if k in b)


def test_folded_weights_give_the_kernel():
    symbols, _ = x.stream(["idiot", "idxiot", "clown", "the idea"])
    at = np.flatnonzero((symbols == x.BORDER) & (np.append(symbols[1:], 0) > 1))[:4]
    codes, decay = x.features(symbols, at)
    cut = [symbols[a : a + x.WINDOW + x.SPAN] for a in at]
    cut = [c[: list(c).index(0)] if 0 in c else c for c in cut]
    for i in range(4):
        weights = np.zeros(x.CODES, np.float32)
        np.add.at(weights, codes[i], decay)
        weights[0] = 0
        got = x.windows(symbols, weights)[at]
        for j in range(4):
            assert abs(got[j] - kernel(cut[j].tolist(), cut[i].tolist())) < 1e-3


def test_learns_gapped_and_inserted_words(spark):
    texts, labels = corpus(900)
    model = x.train(texts, labels)
    new, want = corpus(150)
    got = model.scores(new) >= x.THRESHOLD
    assert (got == np.array(want, bool)).mean() > 0.97
    forms = ["grum-bold", "g r u m b o l d", "grumxbold", "GRUMBOLD!!", "snar.vik", "plotzzer"]
    assert (model.scores([f"{sentence(10)} {f} {sentence(10)}" for f in forms]) >= x.THRESHOLD).all()
    assert (model.scores(["", None, " ", "...", "one"]) < x.THRESHOLD).all()
    df = spark.createDataFrame([(1, None, 1.0), (1, texts[0], 2.0), (1, texts[0], 2.0), (None, "", 3.0), (2, sentence(60_000), 4.0)], "doc_id long, text string, score double")
    rows = x.score(df, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert x.score(df.limit(0), model).count() == 0


def test_styled_letters_and_other_scripts():
    same = lambda a, b: x.stream([a])[0].tolist() == x.stream([b])[0].tolist()
    assert same("\U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d", "idiot") and same("ＩＤＩＯＴ", "idiot") and same("1d10t", "idiot") and same("Иди", "иди")
    for alphabet in ("абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", "אבגדהוזחטיכלמנסעפצקרשת"):
        assert len(set(x.TABLE[[ord(c) for c in alphabet]])) == len(alphabet)
    rng = random.Random(9)
    say = lambda n: " ".join("".join(rng.choice("абвгдеиклмнопрст") for _ in range(rng.randint(2, 8))) for _ in range(n))
    texts = [f"{say(15)} {'грымболд' if i % 3 == 0 else say(1)} {say(15)}" for i in range(600)]
    model = x.train(texts[:500], [int(i % 3 == 0) for i in range(500)])
    got = model.scores(texts[500:]) >= x.THRESHOLD
    assert (got == [i % 3 == 0 for i in range(500, 600)]).mean() > 0.95


def test_strides_do_not_matter(monkeypatch):
    texts = [sentence(RNG.randint(1, 40)) for _ in range(20)] + ["", "g r u m b o l d"]
    weights = np.random.default_rng(3).normal(size=x.CODES).astype(np.float32)
    symbols, begins = x.stream(texts)
    want = np.maximum.reduceat(x.windows(symbols, weights), begins)
    for stride in (17, 64, 1000):
        monkeypatch.setattr(x, "STRIDE", stride)
        again = x.stream(texts)
        assert (again[0] == symbols).all() and (again[1] == begins).all()
        assert np.allclose(x.margins(symbols, begins, weights), want, atol=1e-3)


def test_one_label_or_none(spark):
    assert set(x.train(["a", "b"], [0, 0]).scores(["c"]) < 0.01) == {True}
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert x.train_from(docs, labels, learnable=x.learnable()).scores(["a"])[0] < 0.01
