import bisect
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardframe.llm.packing import cut, op1_best_fit_packing, pack, pieces_of, plan, sequences
from wardframe.llm.tokens import encoder, vocabulary

FILES = ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")


def test_ids_are_the_tokenizers_own():
    own = encoder(*map(vocabulary, FILES))
    rng = random.Random(4)
    alphabet = "ab cZ\n\t.'ß é²½ª́ \x1c​中😀<|>0123's're'LL  "
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a <|endoftext|>b", "I'll we've 'tis  x", "   ", "\n\n a", "x_y__z --> ### $$$"]
    for text in texts:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == own.whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_cut():
    assert cut(5, 4) == [(0, 1), (1, 4)] and cut(8, 4) == [(0, 4), (4, 4)] and cut(3, 4) == [(0, 3)]


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_everything_once(seed):
    rng = random.Random(seed)
    size = rng.choice([16, 64, 2048])
    counts = {}
    for _ in range(rng.randrange(1, 400)):
        n = rng.randrange(1, size + 1) if rng.random() < 0.5 else rng.randrange(1, size // 4 + 2)
        counts[n] = counts.get(n, 0) + rng.choice([1, 1, 5, 300])
    used = {}
    placed = {n: [] for n in counts}
    for length, start, stop, first, each, offset in plan(counts, size).tolist():
        placed[length] += range(start, stop)
        for k in range(stop - start):
            used.setdefault(first + k // each, []).append((offset + k % each * length, length))
    assert all(sorted(v) == list(range(counts[n])) for n, v in placed.items())
    for parts in used.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= size
    assert sorted(used) == list(range(len(used))) == list(range(best_fit_decreasing(counts, size)))


def best_fit_decreasing(counts, size):
    """How many sequences plain best-fit decreasing opens, one piece at a time."""
    gaps, opened = [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                opened, left = opened + 1, size - length
            else:
                left = gaps.pop(at) - length
            bisect.insort(gaps, left)
    return opened


def test_query_rows(documents, stored, spark):
    texts = [(1, None), (2, ""), (3, "word " * 3000), (4, "a short one"), (4, "a short one"), (None, "no id")]
    out = op1_best_fit_packing(spark, stored(documents=documents(texts))).collect()
    own = encoder(*map(vocabulary, FILES))
    ids = np.append(np.frombuffer(own.ids("word " * 3000), "<u4"), 0).astype("<u4")
    long = sorted((r for r in out if r.doc_id == 3), key=lambda r: r.piece)
    assert [r.length for r in long[1:]] == [2048] * (len(long) - 1) and sum(r.length for r in long) == len(ids)
    assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in long)
    assert [(r.length, r.start) for r in out if r.doc_id in (1, 2)] == [(1, 0)] * 2
    assert len(out) == len(long) + 5


def test_sequences_round_trip(documents, spark):
    docs = documents([(k, f"some text {k} " * (k % 40)) for k in range(200)], {"offset": F.lit(1), "length": F.lit("x")})
    pieces = pieces_of(docs, ["doc_id"], *map(vocabulary, FILES), size=64, with_ids=True)
    packed = pack(pieces, 64)
    joined = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in sequences(packed).collect()}
    assert max(map(len, joined.values())) <= 64
    for r in packed.collect():
        part = joined[r.sequence_id][r.offset : r.offset + r.length]
        assert part.tobytes() == bytes(r.ids) and zlib.crc32(part.tobytes()) == r.ids_crc32


def test_empty_table(documents, stored, spark):
    assert op1_best_fit_packing(spark, stored(documents=documents([]))).collect() == []
