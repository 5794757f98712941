import random

import numpy as np
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from regionflow.llm import packing
from regionflow.llm.common import shared_path

STORE, N_IDS = packing.encoder(packing.default_ranks())


def whole(text):
    import base64

    import public_tokenizers as P

    with open(packing.default_ranks(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


ENCODE = whole("")


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab \n\t\x1c\x85 é'1!.", max_size=60))
def test_chunks_encode_as_the_whole(text):
    ids = np.frombuffer(b"".join(map(STORE.__getitem__, packing._CHUNK.findall(text))), np.int32)
    assert ids.tolist() == ENCODE(text)


def test_packing_is_best_fit_decreasing():
    rng = random.Random(10)
    for _ in range(40):
        length = rng.randint(1, 30)
        sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 60))]
        room, want = [], [None] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fit = [r for r in room if r >= sizes[i]]
            if fit:
                k = min(fit)
                room.remove(k)
                room.append(k - sizes[i])
            else:
                room.append(length - sizes[i])
            want[i] = sorted(room)
        places, rows = packing.best_fit_decreasing(sizes, length)
        assert rows == len(room)
        used = {}
        for (row, at), n in zip(places, sizes):
            for x in range(at, at + n):
                assert 0 <= x < length and used.setdefault((row, x), n) == n
        assert len(used) == sum(sizes)


def test_round_trip(spark):
    rng = random.Random(11)
    texts = [None, "", "short", "word " * 5000] + [" ".join("w%d" % rng.randrange(999) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id", "x"), (2, "short", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    manifest = packing.pack(df, shared_path(spark, "test"), length=256, block_tokens=20_000)
    back = {}
    for r in packing.unpack(manifest).collect():
        back.setdefault(r.k_id, []).append((r.segment, r.ids))
    for i, t in enumerate(texts):
        if i != 2:
            assert sum((x for _, x in sorted(back[i])), []) == ENCODE(t or "")
    assert back[2] == [(0, ENCODE("short"))] * 2 and back[None] == [(0, ENCODE("no id"))]
    one = next(r.block for r in manifest.collect() if r.block)
    load = lambda n: np.load(one.removeprefix("file://") + f".{n}.npy")
    ids, cu, ptr, resets = load("ids"), load("cu_seqlens"), load("row_ptr"), load("resets")
    mine = [r for r in manifest.collect() if r.block == one]
    assert ids.dtype == np.uint16 and len(ptr) == len(ids) + 1 and len(resets) == len(mine)
    for k in range(len(ids)):
        c = cu[ptr[k] : ptr[k + 1]]
        assert c[0] == 0 and (np.diff(c) > 0).all() and (ids[k, c[-1] :] == N_IDS).all()
        assert resets[(resets // 256) == k].tolist() == [k * 256 + x for x in c[:-1]]
    assert packing.pack(df.limit(0), shared_path(spark, "test")).count() == 0
