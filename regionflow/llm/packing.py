"""Token ids as binary files: documents packed into rows of one length.

Each task encodes its documents by byte-level BPE and cuts them, without loss, into segments of at most `length`
tokens. Segments of a block of bounded size are packed best-fit decreasing: longest first, each into the row with the
least room that holds it, which a segment tree over capacities finds in log(length) steps. A block is written as npy
files: ids (rows x length, padded), cu_seqlens (cumulative segment lengths of each row, from 0) with row_ptr (where
each row's begin), and resets (places in the flat matrix at which positions start again at 0). The manifest, one row
per segment, names the blocks that count; files of a task that was lost and run again are in no manifest.
"""

from __future__ import annotations

import base64
import io
import re
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionflow.llm.common import Store, cut

LENGTH = 2048
#: Tokens of a block.
BLOCK_TOKENS = 4_000_000
REMEMBERED = 300_000
#: Code points of the longest chunk that is remembered.
LONGEST = 64
SLICE = 512
#: Fixed value: what the tokenizer's pattern takes for white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_ENCODERS: dict[str, Store] = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str) -> tuple[Store, int]:
    """Ids by chunk, and the number of ids. The pattern never joins a character to white space that follows it, so
    chunks that begin at white space are encoded apart and remembered."""
    if path not in _ENCODERS:
        import public_tokenizers

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _ENCODERS[path] = Store(lambda s: array("i", own.encode_ordinary(s)).tobytes(), REMEMBERED, LONGEST), max(ranks.values()) + 1
    return _ENCODERS[path]


class Capacities:
    """Rows by the room they have left, in a segment tree: leaf c counts the rows with room c."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room of at least need, taken out, and its room."""
        count, i = self.count, need + self.size
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i == 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        self._change(room, -1)
        return self.rows[room].pop(), room

    def _change(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1


def best_fit_decreasing(sizes: list[int], length: int) -> tuple[list[tuple[int, int]], int]:
    """(row, offset) of each size (1 to length), and the number of rows."""
    places: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    tree, rows = Capacities(length), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found, rows = (rows, length), rows + 1
        row, room = found
        places[i] = (row, length - room)
        if room > sizes[i]:
            tree.add(row, room - sizes[i])
    return places, rows


def _save(store: fs.FileSystem, path: str, x: np.ndarray) -> None:
    held = io.BytesIO()
    np.save(held, x)
    with store.open_output_stream(path) as f:
        f.write(held.getbuffer())


def write_block(folder: str, segments: list[np.ndarray], length: int, pad: int, kind: type) -> tuple[str, list[tuple[int, int]]]:
    """Packs and writes segments; the block's path and each segment's place."""
    places, rows = best_fit_decreasing([len(s) for s in segments], length)
    ids = np.full((rows, length), pad, kind)
    for (row, at), s in zip(places, segments):
        ids[row, at : at + len(s)] = s
    order = sorted(range(len(segments)), key=lambda i: places[i])
    row = np.array([places[i][0] for i in order])
    begin = np.array([places[i][1] for i in order])
    end = begin + np.array([len(segments[i]) for i in order])
    n = np.bincount(row, minlength=rows)
    row_ptr = np.concatenate([[0], np.cumsum(n + 1)])
    cu = np.zeros(row_ptr[-1], np.int32)
    cu[np.arange(len(order)) + row + 1] = end
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path)
    block = f"block-{uuid.uuid4().hex}"
    for name, x in (("ids", ids), ("cu_seqlens", cu), ("row_ptr", row_ptr), ("resets", row * length + begin)):
        _save(store, f"{path}/{block}.{name}.npy", x)
    return f"{folder}/{block}", places


def pack(
    df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    ranks: str | None = None, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Writes blocks below folder (a URI that all executors reach) and returns the manifest, cut: k_id, segment (from
    0), n_tokens, block, row, offset. Null and empty texts have one segment without tokens and without a place. Rows
    that repeat an id are packed each; null ids stay null; an empty table writes nothing. Ids are 16 bits wide where
    they fit, padding is the id after the last."""
    path = ranks or default_ranks()
    rows = df.select(F.col(f"`{id_col}`").alias("k_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["k_id"], *T.StructType.fromDDL("segment int, n_tokens int, block string, row int, offset int")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_ids = encoder(path)
        kind = np.uint16 if n_ids < 1 << 16 else np.uint32
        held: list[tuple] = []
        tokens, kind_of_id = 0, pa.null()

        def flush() -> pa.RecordBatch:
            full = [x for x in held if len(x[2])]
            block, places = write_block(folder, [x[2] for x in full], length, n_ids, kind) if full else (None, [])
            at = iter(places)
            lines = [(i, k, len(s), block, *next(at)) if len(s) else (i, k, 0, None, None, None) for i, k, s in held]
            cols = list(zip(*lines))
            types = [kind_of_id, pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], schema.names)

        for whole in batches:
            kind_of_id = whole.schema.field(0).type
            for k in range(0, whole.num_rows, SLICE):
                b = whole.slice(k, SLICE)
                for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = np.frombuffer(b"".join(map(known.__getitem__, _CHUNK.findall(text or ""))), np.int32).astype(kind)
                    held.extend((i, n, ids[a : a + length]) for n, a in enumerate(range(0, max(len(ids), 1), length)))
                    tokens += len(ids)
                    if tokens >= block_tokens:
                        yield flush()
                        held, tokens = [], 0
        if held:
            yield flush()

    return cut(rows.mapInArrow(run, schema))


def unpack(manifest: DataFrame) -> DataFrame:
    """The segments of a manifest with their ids, read from the blocks."""
    schema = T.StructType([manifest.schema["k_id"], *T.StructType.fromDDL("segment int, ids array<int>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids = None, None
        for whole in batches:
            for k in range(0, whole.num_rows, SLICE):
                b = whole.slice(k, SLICE)
                out = []
                for name, n, row, at in zip(*(b.column(c).to_pylist() for c in ("block", "n_tokens", "row", "offset"))):
                    if name is not None and name != block:
                        store, path = fs.FileSystem.from_uri(f"{name}.ids.npy")
                        with store.open_input_file(path) as f:
                            block, ids = name, np.load(io.BytesIO(f.read()))
                    out.append(ids[row, at : at + n].astype(np.int32) if name is not None else np.zeros(0, np.int32))
                yield pa.RecordBatch.from_arrays([b.column("k_id"), b.column("segment"), pa.array(out, pa.list_(pa.int32()))], ["k_id", "segment", "ids"])

    return manifest.repartition("block").sortWithinPartitions("block", "row", "offset").mapInArrow(run, schema)
