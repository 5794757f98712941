"""SentencePiece (merge type) encoding by a prefix table, and decoding.

In a merge-type model the encoding of a prefix is a prefix of the encoding up to its last token, so each prefix of a
text has one last token. An automaton finds the pieces that end at each position; the one that fits the last token of
the prefix before it is stored, and the ids are read off backwards. Two tokens fit if merging their joined text
leaves the border between them alone; that test replays the two tokens' own merges side by side and is remembered.
White space only begins pieces, so a text is cut before each run of spaces and the table is built for chunks, whose
ids are remembered too, in a store of bounded size.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionflow.llm.common import Store

SPACE = "▁"
DEFAULT_MODEL = "piece_bpe_32k.model"
#: Chunks that a worker remembers, twice this at most.
REMEMBERED = 280_000
#: Code points of the longest chunk that is remembered.
LONGEST = 64
#: Rows that are encoded at a time.
SLICE = 512
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_MODEL)


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protobuf message: number, and int or bytes."""
    i = 0

    def varint() -> int:
        nonlocal i
        out = shift = 0
        while True:
            out |= (b[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if b[i - 1] < 128:
                return out

    while i < len(b):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = varint() if key & 7 == 2 else 8 if key & 7 == 1 else 4
            yield key >> 3, b[i : i + n]
            i += n


class Codec:
    """A model's vocabulary with encode() and decode(). Models with a normalisation table, user-defined pieces or
    without byte fallback are refused."""

    def __init__(self, model_path: str, remembered: int = REMEMBERED):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        message = list(_fields(sp.serialized_model_proto()))
        kinds = [dict(_fields(v)).get(3, NORMAL) for f, v in message if f == 1]
        trainer = next(dict(_fields(v)) for f, v in message if f == 2)
        norm = next(dict(_fields(v)) for f, v in message if f == 3)
        if trainer.get(3, 1) != 2 or not trainer.get(35) or USER_DEFINED in kinds or norm.get(2):
            raise ValueError("only merge-type models with byte fallback, without user-defined pieces or normalisation")
        if not norm.get(3, 1) or norm.get(4, 1) or not norm.get(5, 1) or trainer.get(24):
            raise ValueError("only models that add a space in front, keep all spaces and escape them")
        if len(kinds) > 65535:
            raise ValueError("only models of at most 65,535 pieces")
        self.surface, self.score, self.id, self.byte = [], {}, {}, {}
        self.piece = [sp.id_to_piece(i) for i in range(len(kinds))]
        self.control = {i for i, kind in enumerate(kinds) if kind == CONTROL}
        for i, kind in enumerate(kinds):
            piece = self.piece[i]
            self.surface.append(piece.replace(SPACE, " ") if kind == NORMAL else " ⁇ " if kind == UNKNOWN else "")
            if kind == NORMAL:
                self.id[piece], self.score[piece] = i, sp.get_score(i)
            elif kind == BYTE:
                self.byte[int(piece[3:5], 16)] = i
        self.raw = {i: b for b, i in self.byte.items()}
        for b, i in self.byte.items():
            if b < 128:
                self.surface[i] = chr(b)
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece has a space inside")
        self.high = {i for b, i in self.byte.items() if b >= 128}
        self.automaton = ahocorasick.Automaton()
        for piece in self.id:
            self.automaton.add_word(piece, (self.id[piece], len(piece)))
        self.automaton.make_automaton()
        alone = "".join(c for c in "\n" if not any(c in p for p in self.id))
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" + f"|[{alone}]" * bool(alone))
        self.replayed: dict[str, tuple | None] = {}
        self.fits: dict[int, bool] = {}
        self.known = Store(self.encode_chunk, remembered, LONGEST)

    def replay(self, piece: str) -> tuple | None:
        """How the merges of a piece's own text go: scores in order, and the last and first symbol before each and at
        the end. None if they do not end in the piece."""
        if piece in self.replayed:
            return self.replayed[piece]
        parts, scores, lasts, firsts = list(piece), [], [piece[-1]], [piece[0]]
        while len(parts) > 1:
            found = [(self.score[m], -k) for k in range(len(parts) - 1) if (m := parts[k] + parts[k + 1]) in self.score]
            if not found:
                break
            score, k = max(found)
            parts[-k : 2 - k] = [parts[-k] + parts[1 - k]]
            scores.append(score)
            lasts.append(parts[-1])
            firsts.append(parts[0])
        out = self.replayed[piece] = (scores, lasts, firsts) if len(parts) == 1 else None
        return out

    def fit(self, left: str, right: str) -> bool:
        """Whether the border between two pieces stays when their joined text is merged (best score first, leftmost
        of equals)."""
        a, b = self.replay(left), self.replay(right)
        if a is None or b is None:
            return False
        (sa, lasts, _), (sb, _, firsts) = a, b
        i = j = 0
        while True:
            na, nb = sa[i] if i < len(sa) else None, sb[j] if j < len(sb) else None
            across = self.score.get(lasts[i] + firsts[j])
            if across is not None and (na is None or across > na) and (nb is None or across >= nb):
                return False
            if na is None and nb is None:
                return True
            if nb is None or na is not None and na >= nb:
                i += 1
            else:
                j += 1

    def border(self, key: int) -> bool:
        """Whether the token key & 65535 can follow the token (key >> 16) - 1; 0 stands for a symbol that is no piece,
        or the beginning, where only the token's own merges count."""
        left, right = key >> 16, self.piece[key & 65535]
        ok = self.fit(self.piece[left - 1], right) if left else self.replay(right) is not None
        if len(self.fits) > 1_000_000:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def encode_chunk(self, s: str) -> bytes:
        """The ids of a chunk as 32-bit integers."""
        n, done, known, border = len(s), -1, self.fits.get, self.border
        last = [0] * (n + 1)  # a prefix's last token plus 1, or 0: a symbol that is no piece
        for end, (token, size) in self.automaton.iter(s):
            if end != done:
                key = last[end + 1 - size] << 16 | token
                ok = known(key)
                if ok or ok is None and border(key):
                    last[end + 1], done = token + 1, end
        out, j = [], n
        while j:
            if token := last[j]:
                out.append(token - 1)
                j -= len(self.piece[token - 1])
            else:
                j -= 1
                out.extend(self.byte[x] for x in reversed(s[j].encode()))
        out.reverse()
        return array("i", out).tobytes()

    def split(self, text: str | None) -> list[str]:
        return self.chunks.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str | None) -> array:
        ids = array("i")
        ids.frombytes(b"".join(map(self.known.__getitem__, self.split(text))))
        return ids

    def join(self, ids: list[int]) -> str:
        """The text of ids, with the space in front. Bytes that are no UTF-8 become U+FFFD one by one."""
        if self.high.isdisjoint(ids):
            return "".join(map(self.surface.__getitem__, ids))
        out, run = [], bytearray()

        def flush() -> None:
            i = 0
            while i < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[i : i + size].decode())
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    out.append("�")
                    size = 1
                i += size
            run.clear()

        for i in ids:
            if i in self.raw:
                run.append(self.raw[i])
            else:
                flush()
                out.append(self.surface[i])
        flush()
        return "".join(out)

    def decode(self, ids) -> str:
        """The text of ids. The space in front goes if a piece, not the unknown mark, brings it."""
        ids = list(ids)
        first = next((self.surface[i] for i in ids if i not in self.control), "")
        return self.join(ids)[first.startswith(" ") and first != " ⁇ " :]


_CODECS: dict[tuple[str, int], Codec] = {}


def codec(model_path: str, remembered: int = REMEMBERED) -> Codec:
    if (model_path, remembered) not in _CODECS:
        _CODECS[model_path, remembered] = Codec(model_path, remembered)
    return _CODECS[model_path, remembered]


def _schema(df: DataFrame, text_col: str, new: list[T.StructField]) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != text_col] + new)


def encode(
    df: DataFrame, model_path: str | None = None, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None, remembered: int = REMEMBERED
) -> DataFrame:
    """df with text_col replaced by ids_col (array of int, without begin and end ids) and, if named, decoded_col, the
    text that the ids give back. Null and empty texts have no ids and decode to the empty text. All rows stay, in
    whole; texts are cut into chunks only at borders that no merge crosses. A column of df that bears a new name is
    replaced. remembered bounds the chunks that a worker keeps with their ids; it changes its memory, not the result."""
    path = model_path or default_model()
    keep = [c for c in df.columns if c not in (text_col, ids_col, decoded_col)]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text_col))
    new = [T.StructField(ids_col, T.ArrayType(T.IntegerType(), False), False)]
    new += [T.StructField(decoded_col, T.StringType(), False)] if decoded_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, remembered)
        for whole in batches:
            for k in range(0, whole.num_rows, SLICE):
                b = whole.slice(k, SLICE)
                every = list(map(c.encode, b.column(len(keep)).to_pylist()))
                ends = np.cumsum([0, *map(len, every)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(every), np.int32)))
                more = [pa.array(map(c.decode, every), pa.string())] if decoded_col else []
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], ids, *more], [*keep, *(f.name for f in new)])

    return rows.mapInArrow(run, _schema(rows, text_col, new))


def decode(df: DataFrame, model_path: str | None = None, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """df with ids_col replaced by its text. Null ids and no ids give the empty text; null among the ids is skipped;
    control ids give nothing and the unknown id a mark, as in the sentencepiece library."""
    path = model_path or default_model()
    keep = [c for c in df.columns if c not in (ids_col, text_col)]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.array_compact(F.col(f"`{ids_col}`").cast("array<int>")).alias(ids_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for k in range(0, whole.num_rows, SLICE):
                b = whole.slice(k, SLICE)
                texts = [c.decode(x.as_py()) if x.is_valid else "" for x in b.column(len(keep))]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, text_col])

    return rows.mapInArrow(run, _schema(rows, ids_col, [T.StructField(text_col, T.StringType(), False)]))
