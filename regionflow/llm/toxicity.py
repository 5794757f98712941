"""Toxicity by a support vector machine over a subsequence string kernel with Nystroem landmarks.

A text becomes a stream of symbols: case goes, punctuation is dropped, digits, full-width and styled letters stand for
the letters they imitate, white space is one border symbol, and single letters in a row are joined. Latin letters have
a symbol each; the letters of other scripts share the symbols from OTHERS on by their place, so that those of an
alphabet have one each and the thousands of Han signs are told apart by three symbols in a row. The kernel of two windows counts the subsequences of three symbols that they share,
each weighted by DECAY to the power of the span it takes (SPAN at most), so a gapped or inserted-character insult still
shares most of its subsequences with the plain one, at lower weights. Windows are mapped by their kernel with a set of
landmark windows, a linear machine with squared hinge loss is trained on that map, and because the map is linear in
the subsequence counts, the machine folds into one table of weights over three-symbol subsequences. Scoring a text is
then a few table look-ups for each letter; the text's margin is that of its worst window.

Labels are of whole texts. A labelled toxic text stands for the window that gives it away: first the one whose
letters are most particular to toxic texts, then, in rounds, the one that the machine itself ranks first; windows of
clean texts that it ranks high come in as further negatives. Each positive window also counts with a letter inserted,
so that the machine trusts the gapped subsequences. The sample is dealt into FOLDS parts; a machine is trained without
each of them, their mean is the machine, and the margins of the texts that each did not see turn margins into
probabilities.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionflow.llm.common import bounded_sample, remainder, slices

DECAY, SPAN, WINDOW = 0.6, 6, 10
#: Bound of the sample that the machine is fitted on: texts of each label, and code points of a text.
PER_LABEL, LONGEST = 1500, 20_000
LANDMARKS, ROUNDS, FOLDS = 256, 5, 3
#: Code points and texts that are scored at once, and symbols whose windows are.
POINTS, SLICE, STRIDE = 1_000_000, 256, 1 << 19
#: Texts that training works through at a time.
BLOCK = 250
THRESHOLD = 0.7
SEP, BORDER, SKIP = 0, 1, 255
#: Bits of a symbol, and the first symbol of letters that are not Latin.
BITS, OTHERS = 7, 59
ACCENTED = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
#: Digits and signs by the letters they imitate.
IMITATED = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}
STEPS = [(i, j) for i in range(1, SPAN - 1) for j in range(1, SPAN - i)]


def _table() -> np.ndarray:
    """The symbol of each code point of the planes that hold letters in use."""
    out = np.full(0x40000, SKIP, np.uint8)
    letters = "abcdefghijklmnopqrstuvwxyz" + ACCENTED
    symbol = {c: 2 + min(i, OTHERS - 3) for i, c in enumerate(letters)}
    symbol |= {c: symbol[x] for c, x in IMITATED.items()}
    for cp in range(128, len(out)):
        c = chr(cp)
        if c.isspace():
            out[cp] = BORDER
        elif c.isalnum():
            plain = unicodedata.normalize("NFKC", c)[0].lower()[0]
            if plain in symbol:
                out[cp] = symbol[plain]
            elif plain.isalpha():
                out[cp] = OTHERS + ord(plain) % ((1 << BITS) - OTHERS)
    for c in letters[:26]:
        out[ord(c)] = out[ord(c.upper())] = symbol[c]
    for c in " \t\n\x0b\x0c\r":
        out[ord(c)] = BORDER
    for c in IMITATED:
        out[ord(c)] = symbol[c]
    out[0] = SEP
    return out


TABLE = _table()
CODES = 1 << (3 * BITS)
_PAD = "\0" * (WINDOW + SPAN + 2)


def stream(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of texts one after another, apart by more separators than a window spans, and where each begins."""
    texts = [(t or "").replace("\0", " ") for t in texts]
    joined = "".join(f"{_PAD} {t} " for t in texts) + _PAD
    parts = []
    for k in range(0, len(joined), STRIDE):
        points = np.frombuffer(joined[k : k + STRIDE].encode("utf-32-le", "surrogatepass"), np.uint32)
        parts.append(TABLE[np.where(points < len(TABLE), points, 0x2E)])
    symbols = np.concatenate(parts)
    keep = symbols != SKIP
    keep[1:] &= ~((symbols[1:] == BORDER) & (symbols[:-1] == BORDER))
    at = np.cumsum([0] + [len(t) + len(_PAD) + 2 for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
    places = np.flatnonzero(~keep)
    symbols, begins = symbols[keep], at - np.searchsorted(places, at)
    # A border between two single letters is a gap within a spelt-out word.
    border, glue = symbols == BORDER, np.zeros(len(symbols), bool)
    glue[2:-2] = border[2:-2] & border[:-4] & border[4:]
    return symbols[~glue], begins - np.searchsorted(np.flatnonzero(glue), begins)


def starts(symbols: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each place the weighted sum over subsequences that begin there."""
    s = np.concatenate([symbols, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    n = len(symbols)
    out, first = np.zeros(n, np.float32), s[:n] << (2 * BITS)
    for i in range(1, SPAN - 1):
        two = first | (s[i : i + n] << BITS)
        for j in range(1, SPAN - i):
            out += np.float32(DECAY ** (i + j + 1)) * weights[two | s[i + j : i + j + n]]
    return out


def windows(symbols: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The margin, without bias, of the window that begins at each place."""
    total = np.concatenate([[0.0], np.cumsum(starts(symbols, weights), dtype=np.float64), np.zeros(WINDOW)])
    total[len(symbols) + 1 :] = total[len(symbols)]
    return total[WINDOW : WINDOW + len(symbols)] - total[: len(symbols)]


def margins(symbols: np.ndarray, begins: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The margin of the worst window of each text, STRIDE symbols at a time."""
    out = np.full(len(begins), -np.inf)
    for a in range(0, len(symbols), STRIDE):
        b = min(a + STRIDE, len(symbols))
        value = windows(symbols[a : b + WINDOW + SPAN], weights)[: b - a]
        i, j = max(int(np.searchsorted(begins, a, "right")) - 1, 0), int(np.searchsorted(begins, b))
        cuts = np.maximum(begins[i:j] - a, 0)
        out[i:j] = np.maximum(out[i:j], np.maximum.reduceat(value, cuts))
    return out


def features(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences (n x k codes) of the windows that begin at the given places, and the k weights. Codes that
    contain a separator are 0."""
    around = np.take(symbols, at[:, None] + np.arange(WINDOW + SPAN), mode="clip").astype(np.int32)  # ends in a separator
    codes = []
    for i, j in STEPS:
        a, b, c = around[:, :WINDOW], around[:, i : i + WINDOW], around[:, i + j : i + j + WINDOW]
        codes.append(np.where((a > 0) & (b > 0) & (c > 0), a << 2 * BITS | b << BITS | c, 0))
    return np.concatenate(codes, 1), np.repeat([DECAY ** (i + j + 1) for i, j in STEPS], WINDOW).astype(np.float32)


@dataclass
class Model:
    """weights: over subsequences; a score is 1 / (1 + exp(-(slope * margin + bias)))."""

    weights: np.ndarray
    slope: float
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        symbols, begins = stream(texts)
        margin = margins(symbols, begins, self.weights)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.bias, -40, 40)))


def inserted(symbols: np.ndarray, at: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The windows at the given places with a random letter inserted, as a stream of their own, and their places."""
    size = WINDOW + 1
    s = np.concatenate([symbols, np.zeros(size, np.uint8)])
    rows = s[at[:, None] + np.arange(size)]
    place = rng.integers(2, 6, len(at))
    k = np.arange(size + 1)
    rows = np.where(k < place[:, None], np.pad(rows, ((0, 0), (0, 1))), np.pad(rows, ((0, 0), (1, 0))))
    rows[np.arange(len(at)), place] = rng.integers(2, 28, len(at))
    rows = np.pad(rows, ((0, 0), (0, SPAN)))
    return rows.ravel(), np.arange(len(at)) * rows.shape[1]


def _machine(x: np.ndarray, y: np.ndarray, cost: float = 30.0) -> np.ndarray:
    """Weights, the last for the constant, of a linear machine with squared hinge loss, by Newton's method."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    each = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)) * len(y)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        on = y * (x @ w) < 1
        if not on.any():
            break
        xo = x[on] * each[on, None]
        new = np.linalg.solve(np.eye(x.shape[1]) / cost + x[on].T @ xo, xo.T @ y[on])
        done = np.allclose(new, w, atol=1e-6)
        w = new
        if done:
            break
    return w


def _platt(margin: np.ndarray, y: np.ndarray, each: np.ndarray) -> tuple[float, float]:
    """Slope and bias of the logistic curve through smoothed labels."""
    pos, neg = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(margin.std(), 1e-6)
    x, w = np.stack([(margin - margin.mean()) / scale, np.ones(len(margin))], 1), np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        h = (x * (each * p * (1 - p) + 1e-6)[:, None]).T @ x + np.eye(2) * 1e-6
        step = np.linalg.solve(h, x.T @ (each * (target - p)))
        w += np.clip(step, -2, 2)
    return float(w[0] / scale), float(w[1] - w[0] * margin.mean() / scale)


def _fit(symbols: np.ndarray, begins: np.ndarray, ends: np.ndarray, y: np.ndarray, fit: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Weights over subsequences and the constant of the machine of the texts that fit names."""

    def grams(a: int, b: int) -> np.ndarray:
        """The five symbols at each place as a number, -1 where they reach into a separator."""
        s = np.concatenate([symbols[a : b + 4], np.zeros(4, np.uint8)]).astype(np.int64)
        n = b - a
        inside = np.all([s[k : k + n] > 0 for k in range(5)], axis=0)
        return np.where(inside, sum(s[k : k + n] << (BITS * k) for k in range(5)), -1)

    # How particular the five symbols at a place are to toxic texts, in numbers of texts.
    bad, clean = np.flatnonzero(fit & (y == 1)), np.flatnonzero(fit & (y == 0))
    tallies = []
    for which in (bad, clean):
        names, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for k in range(0, len(which), BLOCK):
            own = [np.unique(grams(begins[d], ends[d])) for d in which[k : k + BLOCK]]
            names, of = np.unique(np.concatenate([names, *own]), return_inverse=True)
            counts = np.bincount(of, np.concatenate([counts, np.ones(sum(map(len, own)))]))
        tallies.append((names, counts))
    (names, with_t), (others, counts) = tallies
    names, with_t = names[with_t >= 3], with_t[with_t >= 3]
    where = np.minimum(np.searchsorted(others, names), len(others) - 1)
    with_c = np.where(others[where] == names, counts[where], 0)
    odds = np.log((with_t + 0.5) / (len(bad) + 1)) - np.log((with_c + 0.5) / (len(clean) + 1))
    odds[names < 0] = -9.0

    def rank(a: int, b: int) -> np.ndarray:
        g = grams(a, b)
        where = np.minimum(np.searchsorted(names, g), len(names) - 1)
        return np.where(names[where] == g, odds[where], -9.0) if len(names) else np.full(b - a, -9.0)

    def ranked(a: int, b: int) -> np.ndarray:
        value = windows(symbols[a:b], weights)
        value[symbols[a:b] == SEP] = -np.inf
        return value

    def worst(value, which: np.ndarray, k: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """The places of the k windows that value ranks first, apart from each other, of each of the texts, and ranks."""
        out, ranks = [], []
        for d in which:
            v = value(begins[d], ends[d])
            for _ in range(k):
                at = int(v.argmax())
                if not np.isfinite(v[at]):
                    break
                out.append(begins[d] + at)
                ranks.append(v[at])
                v[max(0, at - WINDOW) : at + WINDOW] = -np.inf
        return np.array(out, np.int64), np.array(ranks)

    places, ranks = worst(rank, bad)
    positive = places[ranks > 0.5] if (ranks > 0.5).any() else places
    tried = rng.integers(0, len(symbols), 24_000)
    of = np.searchsorted(begins, tried, "right") - 1
    negative = tried[(of >= 0) & (fit & (y == 0))[of] & (symbols[tried] > 0)][:8000]
    weights, place = np.zeros(CODES, np.float32), np.zeros(CODES, np.int32)
    for turn in range(ROUNDS):
        # Landmarks: positive windows of as many beginnings as there are, and negative ones.
        firsts, kind = np.unique([int(grams(a, a + 1)[0]) for a in positive], return_inverse=True)
        order = rng.permutation(len(positive))
        nth = np.zeros(len(positive), np.int64)
        seen = np.zeros(len(firsts), np.int64)
        for i in order:
            nth[i] = seen[kind[i]]
            seen[kind[i]] += 1
        chosen = positive[np.argsort(nth, kind="stable")[: LANDMARKS * 5 // 8]]
        marks = np.concatenate([chosen, negative[-(LANDMARKS - len(chosen)) :]])
        codes, decay = features(symbols, marks)
        used = np.unique(codes)
        phi = np.zeros((len(marks), len(used)), np.float32)
        column = np.searchsorted(used, codes)
        for k in range(len(marks)):
            np.add.at(phi[k], column[k], decay * (codes[k] > 0))
        phi /= np.maximum(np.linalg.norm(phi, axis=1, keepdims=True), 1e-6)
        value, vector = np.linalg.eigh((phi @ phi.T).astype(np.float64))
        good = value > 1e-4
        whiten = vector[:, good] / np.sqrt(value[good])
        to = (phi.T.astype(np.float64) @ whiten).astype(np.float32)

        place[used] = np.arange(1, len(used) + 1)
        place[0] = 0
        rows = np.concatenate([np.zeros((1, to.shape[1]), np.float32), to])

        def mapped(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
            out = []
            for k in range(0, len(at), 256):
                c, d = features(symbols, at[k : k + 256])
                out.append(np.matmul(d[None, None, :], rows[place[c]])[:, 0, :])
            return np.concatenate(out).astype(np.float64)

        x = np.concatenate([mapped(symbols, positive), mapped(*inserted(symbols, positive, rng)), mapped(symbols, negative)])
        w = _machine(x, np.concatenate([np.ones(2 * len(positive)), -np.ones(len(negative))]))
        weights = np.zeros(CODES, np.float32)
        weights[used] = (to @ w[:-1]).astype(np.float32)
        weights[0], place[used] = 0, 0
        if turn < ROUNDS - 1:
            # A toxic text without anything telling is no example: leave out those that look clean.
            places, ranks = worst(ranked, bad)
            sure = ranks + w[-1] > -0.5
            positive = places[sure] if sure.sum() >= 10 else places
            hard, ranks = worst(ranked, clean, 2)
            negative = np.concatenate([negative[:8000], hard[np.argsort(ranks)]])
    return weights, float(w[-1])


def train(texts: list[str], labels: list[int], seed: int = 7, toxic_share: float | None = None) -> Model:
    """Fits the machine. With only one label, or none, all texts get the share of toxic ones (0 without any)."""
    y = np.array(labels)
    share = toxic_share if toxic_share is not None else float((y == 1).mean()) if len(y) else 0.0
    rng = np.random.default_rng(seed)
    fold = np.zeros(len(y), np.int64)
    for kind in (0, 1):
        which = rng.permutation(np.flatnonzero(y == kind))
        fold[which] = np.arange(len(which)) % FOLDS
    if min((y == 1).sum(), (y == 0).sum()) < FOLDS:
        p = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(CODES, np.float32), 0.0, float(np.log(p / (1 - p))))
    # The sample is worked through in blocks of texts: whole arrays exist only of its symbols.
    made = [stream(texts[k : k + BLOCK]) for k in range(0, len(texts), BLOCK)]
    offset = np.cumsum([0] + [len(m[0]) for m in made])
    symbols = np.concatenate([m[0] for m in made])
    begins = np.concatenate([m[1] + o for m, o in zip(made, offset)])
    ends = np.append(begins[1:], len(symbols))

    margin, total, constant = np.zeros(len(y)), np.zeros(CODES, np.float32), 0.0
    for k in range(FOLDS):
        weights, const = _fit(symbols, begins, ends, y, fold != k, np.random.default_rng([seed, k]))
        for d in np.flatnonzero(fold == k):
            margin[d] = windows(symbols[begins[d] : ends[d]], weights).max() + const
        total, constant = total + weights / FOLDS, constant + const / FOLDS
    each = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())  # both labels weigh the same
    slope, bias = _platt(margin, y, each)
    return Model(total, slope, bias + slope * constant)


def train_from(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", learnable=None) -> Model:
    """Fits on about PER_LABEL texts of each label, at most LONGEST code points each, among rows of labels for which
    learnable (a condition on the id) holds. Labels other than 0 and 1 and null ids and texts are left out; of several
    labels of an id the largest counts, of several texts that with the least hash."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    if learnable is not None:
        known = known.where(learnable)
    known = known.groupBy(F.col(id_col).alias("l_id")).agg(F.max(label_col).alias("label"))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    ids = bounded_sample(known, "label", ["l_id"], PER_LABEL)
    texts = docs.where(F.col(text_col).isNotNull() & (F.length(text_col) <= LONGEST)).select(F.col(id_col).alias("l_id"), F.col(text_col).alias("t"))
    one = texts.join(F.broadcast(ids), "l_id").groupBy("l_id", "label").agg(F.min_by("t", F.struct(F.xxhash64("t"), "t")).alias("t"))
    rows = one.collect()
    rows.sort(key=lambda r: (r.l_id, r.t))
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    return train([r.t for r in rows], [r.label for r in rows], toxic_share=share)


def score(df: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """df with text_col replaced by out_col, the probability (0 to 1) that a text is toxic. Null and empty texts have
    no telling window and get the score of a margin of 0. All rows stay; whole texts count, however long. A column of
    df that bears the new name is replaced."""
    keep = [c for c in df.columns if c not in (text_col, out_col)]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text_col))
    schema = T.StructType([f for f in rows.schema.fields if f.name != text_col] + [T.StructField(out_col, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            lengths = pc.fill_null(pc.utf8_length(whole.column(len(keep))), 0).to_pylist()
            for i, j in slices(lengths, POINTS, SLICE):
                b = whole.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(model.scores(b.column(len(keep)).to_pylist()))], [*keep, out_col])

    return rows.mapInArrow(run, schema)


def learnable(id_col: str = "doc_id"):
    return remainder(id_col, 3) != 1
