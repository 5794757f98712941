"""Language identification: script ranges narrow the candidates, then Viterbi over per-word scores.

A word is a run of letters. Its script, that of its first letter, leaves as candidates the languages that were learned
with that script (all, if none was); its score for each is the log probability of its three-letter sequences, borders
included. Sequences are of code points, in lower case, and are counted by a hash of BUCKET_BITS bits, so the letters of
every script count as themselves; in a sequence that no language has the letter alone counts. Viterbi with a penalty for each switch labels the words of a text, and runs of one
label are its spans, so mixed texts come apart. The language of most letters is the text's. Texts of a batch are worked
in step, word by word, so many code points at a time; a longer text is worked in pieces that hand on the state of the
search, and keeps of each word its place and one bit for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionflow.llm.common import bounded_sample, remainder, slices

PENALTY = 12.0
#: Bound of the sample that scores are learned from: texts of a language, code points of a text.
PER_LANGUAGE, LONGEST = 1000, 20_000
BUCKET_BITS = 20
#: Code points and texts that are worked at once with up to so many languages, fewer with more; letters scored at once.
POINTS, SLICE, SLICE_LANGUAGES, BLOCK = 2_000_000, 1024, 24, 1 << 16
NO_CANDIDATE = -1e4
#: Unicode ranges of scripts, first and last code point.
SCRIPTS = [
    ("Latin", 0x0041, 0x024F), ("Greek", 0x0370, 0x03FF), ("Cyrillic", 0x0400, 0x052F), ("Armenian", 0x0530, 0x058F),
    ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x077F), ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF),
    ("Tamil", 0x0B80, 0x0BFF), ("Thai", 0x0E00, 0x0E7F), ("Georgian", 0x10A0, 0x10FF), ("Hangul Jamo", 0x1100, 0x11FF),
    ("Latin", 0x1E00, 0x1EFF), ("Greek", 0x1F00, 0x1FFF), ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF), ("Han", 0x20000, 0x3FFFF),
]
NAMES = sorted({s[0] for s in SCRIPTS}) + ["Other"]
#: The planes that hold letters.
_POINTS = 0x40000


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: whether it is a letter, its lower case if that is one letter, its script."""
    letter, script = np.zeros(_POINTS, bool), np.full(_POINTS, len(NAMES) - 1, np.uint8)
    lower = np.arange(_POINTS, dtype=np.uint32)
    for cp in range(_POINTS):
        c = chr(cp)
        letter[cp] = c.isalpha()
        if letter[cp] and len(c.lower()) == 1:
            lower[cp] = ord(c.lower()) % _POINTS
    for name, a, b in SCRIPTS:
        script[a : b + 1] = NAMES.index(name)
    return letter, lower, script


_CACHE: list = []


def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not _CACHE:
        _CACHE.append(_tables())
    return _CACHE[0]


def words(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The words of texts: letters (lower-case code points, words parted by 0), where each word begins and ends in
    them, its text, its place in the text, and the script of its first letter."""
    letter, lower, script = tables()
    texts = [t or "" for t in texts]
    points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < _POINTS, points, 0)
    is_letter = letter[points]
    edge = np.diff(np.concatenate([[0], is_letter.view(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])[: len(texts)]
    text = np.searchsorted(begins, first, "right") - 1
    keep = is_letter.copy()
    keep[end] = True  # one border after each word
    letters = np.where(is_letter, lower[points], 0)[keep]
    size = end - first
    at = np.cumsum(size + 1) - size - 1
    return {"letters": letters, "at": at, "size": size, "text": text, "place": first - begins[text], "script": script[points[first]]}


def sequences(letters: np.ndarray) -> np.ndarray:
    """The bucket of the three letters around each place."""
    s = np.concatenate([[0], letters, [0]]).astype(np.uint32)
    mixed = s[:-2] * np.uint32(0x9E3779B1) + s[1:-1] * np.uint32(0x85EBCA77) + s[2:] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BUCKET_BITS)


def alone(letters: np.ndarray) -> np.ndarray:
    """The bucket of each letter by itself, for sequences that were not learned."""
    return (letters.astype(np.uint32) * np.uint32(0x165667B1) + np.uint32(0x3C6EF372)) >> np.uint32(32 - BUCKET_BITS)


def rows_of(letters: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The row of each place: that of its sequence or, if no language has it, of its letter."""
    row = rows[sequences(letters)]
    new = np.flatnonzero(row == 0)
    row[new] = rows[alone(letters[new])]
    return row


@dataclass
class Model:
    """languages; the buckets that were seen, in order, and their log probabilities, from row 1 on (row 0: all other
    buckets), rows x languages; candidates, scripts x languages."""

    languages: list[str]
    seen: np.ndarray
    logs: np.ndarray
    candidates: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of each bucket in logs."""
        out = np.zeros(1 << BUCKET_BITS, np.int32)
        out[self.seen] = np.arange(1, len(self.seen) + 1)
        return out

    def scores(self, w: dict, rows: np.ndarray) -> np.ndarray:
        """Words x languages, BLOCK letters at a time."""
        out = np.where(self.candidates[w["script"]], 0.0, NO_CANDIDATE)
        row = rows_of(w["letters"], rows)
        for a in range(0, len(row), BLOCK):
            b = min(a + BLOCK, len(row))
            i, j = np.searchsorted(w["at"], (a, b))
            cuts = np.append(a, w["at"][i:j]) - a
            first = i - 1 if cuts.size < 2 or cuts[1] else i  # a word that goes on from the block before
            cuts = cuts if first < i else cuts[1:]
            block = self.logs[row[a:b]] * (w["letters"][a:b] > 0)[:, None]
            out[first : first + len(cuts)] += np.add.reduceat(block, cuts, axis=0)
        return out

    def label(self, texts: list[str | None], rows: np.ndarray) -> tuple[dict, np.ndarray]:
        """The words of texts, without their letters, and their labels."""
        if len(texts) == 1 and texts[0] and len(texts[0]) > POINTS:
            return self.label_long(texts[0], rows)
        w = words(texts)
        if not len(w["at"]):
            return w, np.zeros(0, np.int64)
        return w, viterbi(self.scores(w, rows), np.bincount(w["text"], minlength=len(texts)))

    def label_long(self, text: str, rows: np.ndarray, size: int = POINTS // 4) -> tuple[dict, np.ndarray]:
        """The same for one text, in pieces that end between words."""
        kept, steps, state, a = [], [], None, 0
        while a < len(text):
            b = min(a + size, len(text))
            while b < len(text) and text[b - 1].isalpha() and text[b].isalpha():
                b += 1
            w = words([text[a:b]])
            if len(w["at"]):
                state, best, stays = forward(self.scores(w, rows), state)
                steps.append((best, np.packbits(stays, axis=1)))
                kept.append({"size": w["size"], "place": w["place"] + a})
            a = b
        n = sum(len(k["size"]) for k in kept)
        whole = {c: np.concatenate([k[c] for k in kept]) if kept else np.zeros(0, np.int64) for c in ("size", "place")}
        label, at = np.zeros(n, np.int64), n
        here = int(state.argmax()) if n else 0
        for best, stays in reversed(steps):
            stays = np.unpackbits(stays, axis=1, count=len(self.languages))
            for t in range(len(best) - 1, -1, -1):
                at -= 1
                label[at] = here
                here = here if stays[t, here] else int(best[t])
        return whole | {"text": np.zeros(n, np.int64)}, label


def forward(scores: np.ndarray, state: np.ndarray | None, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Viterbi over the words of one text on from state (None at its start): the new state, and for each word the best
    label before it and which labels rather stay than come from that one."""
    best, stays = np.zeros(len(scores), np.int32), np.ones(scores.shape, bool)
    for t, x in enumerate(scores):
        if state is None:
            state = x.copy()
            continue
        best[t] = state.argmax()
        switched = state[best[t]] - penalty
        np.greater_equal(state, switched, out=stays[t])
        state = np.maximum(state, switched) + x
    return state, best, stays


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best labels of the words of texts with so many words each: scores less penalty for each switch."""
    n, k = scores.shape
    begins = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    order = order[counts[order] > 0]
    at, size = begins[order], counts[order]
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right") if len(size) else []
    back, label, every = np.empty((n, k), np.min_scalar_type(max(k - 1, 0))), np.empty(n, np.int64), np.arange(k)
    v = scores[at].copy()
    for t in range(1, len(active)):
        a = active[t]
        now = v[:a]
        best = now.argmax(1)
        switched = now[np.arange(a), best] - penalty
        stay = now >= switched[:, None]
        back[at[:a] + t] = np.where(stay, every, best[:, None])
        v[:a] = np.where(stay, now, switched[:, None]) + scores[at[:a] + t]
    label[at + size - 1] = v.argmax(1)
    for t in range(len(active) - 1, 0, -1):
        here = at[: active[t]] + t
        label[here - 1] = back[here, label[here]]
    return label


def train(texts: list[str], languages: list[str]) -> Model:
    """Learns from texts and their languages. Languages are in order of name."""
    names = sorted(set(languages))
    w = words(texts)
    letter = w["letters"] > 0
    code, single = sequences(w["letters"]), alone(w["letters"])
    number = {x: i for i, x in enumerate(names)}
    of = np.array([number[x] for x in languages])[w["text"]] if len(w["text"]) else np.zeros(0, np.int64)
    by_letter = np.repeat(of, w["size"] + 1)
    seen = np.union1d(code[letter], single[letter])
    model = Model(names, seen, np.zeros((len(seen) + 1, len(names)), np.float32), np.zeros((len(NAMES), len(names)), bool))
    row, own = model.rows()[code], model.rows()[single]
    letter_only = np.setdiff1d(own[letter], row[letter])
    for k in range(len(names)):
        here = (by_letter == k) & letter
        counts, letters = (np.bincount(x[here], minlength=len(seen) + 1) for x in (row, own))
        model.logs[:, k] = np.log((counts + 0.05) / (counts.sum() + 0.05 * 20_000))
        # A letter out of an unknown sequence: as rare as any unknown one, and by how often the language has the letter.
        model.logs[letter_only, k] += np.log((letters[letter_only] + 0.5) / (letters.sum() + 0.5 * 1000))
        script = np.bincount(w["script"][of == k], minlength=len(NAMES))
        model.candidates[:, k] = script >= max(1, 0.01 * script.sum())
    model.candidates[~model.candidates.any(1)] = True
    return model


def train_from(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learnable=None) -> Model:
    """Learns from about PER_LANGUAGE different texts of every language, LONGEST code points each at most, among rows of
    docs for which learnable (a condition on the id) holds. Null languages and texts are left out."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) <= LONGEST))
    if learnable is not None:
        known = known.where(learnable)
    known = known.select(F.col(id_col).alias("l_id"), F.col(lang_col).cast("string").alias("l"), F.col(text_col).alias("t"))
    rows = bounded_sample(known, "l", ["l_id", "t"], PER_LANGUAGE).collect()
    rows.sort(key=lambda r: (r.l, r.l_id is None, r.l_id, r.t))
    return train([r.t for r in rows], [r.l for r in rows])


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with text_col replaced by lang_pred, score and spans (start, end: code points, end exclusive; lang).

    score is the share of letters in spans of the predicted language (the first by name of equals). Texts that are
    null or have no letter are `und` with score 0 and no spans; if no language was learned, all are. All rows stay;
    columns of df with these names are replaced."""
    new = ["lang_pred", "score", "spans"]
    keep = [c for c in df.columns if c not in (text_col, *new)]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text_col))
    schema = T.StructType(
        [f for f in rows.schema.fields if f.name != text_col]
        + list(T.StructType.fromDDL("lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"))
    )
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, names, k = model.rows(), np.array([*model.languages, "und"], object), len(model.languages)
        bounds = [max(1, x * SLICE_LANGUAGES // max(SLICE_LANGUAGES, k)) for x in (POINTS, SLICE)]
        for whole in batches:
            lengths = pc.fill_null(pc.utf8_length(whole.column(len(keep))), 0).to_pylist()
            for i, j in slices(lengths, *bounds):
                b = whole.slice(i, j - i)
                n = b.num_rows
                if k:
                    w, label = model.label(b.column(len(keep)).to_pylist(), table)
                else:
                    w, label = words([None] * n), np.zeros(0, np.int64)
                letters = np.bincount(w["text"] * k + label, w["size"], n * k).reshape(n, k) if k else np.zeros((n, 1))
                best, total = letters.argmax(1), letters.sum(1)
                share = np.where(total > 0, letters.max(1) / np.maximum(total, 1), 0.0)
                new_span = np.ones(len(label), bool)
                new_span[1:] = (label[1:] != label[:-1]) | (w["text"][1:] != w["text"][:-1])
                first = np.flatnonzero(new_span)
                last = np.append(first[1:], len(label))[: len(first)] - 1
                offsets = np.concatenate([[0], np.cumsum(np.bincount(w["text"][first], minlength=n))]).astype(np.int32)
                parts = pa.StructArray.from_arrays(
                    [pa.array(w["place"][first].astype(np.int32)), pa.array((w["place"] + w["size"])[last].astype(np.int32)), pa.array(names[label[first]], pa.string())],
                    fields=list(span),
                )
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[: len(keep)], pa.array(names[np.where(total > 0, best, k)], pa.string()), pa.array(share), pa.ListArray.from_arrays(pa.array(offsets), parts)],
                    [*keep, *new],
                )

    return rows.mapInArrow(run, schema)


def learnable(id_col: str = "doc_id"):
    return remainder(id_col, 4) != 2
