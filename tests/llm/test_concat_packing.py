import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardframe.llm import concat_packing
from wardframe.llm.concat_packing import boundaries, op11_concat_packing, pack, places, sequences, word_encoder
from wardframe.llm.tokens import vocabulary

FILE = vocabulary("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(FILE)


def plain(text):
    ids = WHOLE.encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 2], dtype="<u4")


def test_ids_are_the_tokenizers_own():
    own = word_encoder(FILE)
    rng = random.Random(7)
    alphabet = "ab cZÉßſŉǅ\n\t.'\"²½ª́ \x1c​中😀İΣς<|>0123's're'LL 'Ve  "
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(3000)]
    plainer = "ab cZÉßž\n\t.'\"0123's're'LL 'Ve  -–…«»×"
    texts += ["".join(rng.choices(plainer, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a <|startoftext|>b", "I'll we've 'tis  X", "   ", "\n\n a", "x_y__z --> ### $$$", "''s 'RE"]
    names = [t.removesuffix("</w>") for t in own.whole.get_vocab()]
    texts += [" ".join("".join(rng.choices(names, k=rng.randrange(1, 4))) for _ in range(20)) for _ in range(1000)]
    for part in (texts[:500], texts[500:]):
        for text, ids in zip(part, own.ids(part), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == own.whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_are_merged_like_the_tokenizer_does(monkeypatch):
    monkeypatch.setattr(concat_packing, "MOST_WORDS", 2000)  # forgotten now and then
    own, rng = word_encoder(FILE), random.Random(3)
    assert own.merged is not None
    names = [t.removesuffix("</w>") for t in own.whole.get_vocab() if re.fullmatch("[a-z]+(</w>)?", t)]
    for _ in range(30):
        texts = [" ".join("".join(rng.choices(names, k=rng.randrange(1, 4))) for _ in range(100)) for _ in range(10)]
        for text, ids in zip(texts, own.ids(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == own.whole.encode(text, add_special_tokens=False).ids


def test_every_id_lies_in_one_piece(documents, stored, spark):
    texts = [(1, None), (2, ""), (3, "A word " * 5000), (4, "a short one"), (4, "a short one"), (None, "no id"), (5, "ünïcode ² İ")]
    out = op11_concat_packing(spark, stored(documents=documents(texts))).collect()
    long = sorted((r for r in out if r.doc_id == 3), key=lambda r: r.start)
    ids = plain("A word " * 5000)
    assert [r.start for r in long] == [0, *np.cumsum([r.length for r in long])[:-1]] and sum(r.length for r in long) == len(ids)
    assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids) for r in long)
    assert [(r.length, r.start, r.doc_tokens, r.ids_crc32) for r in out if r.doc_id in (1, 2)] == [(1, 0, 1, zlib.crc32(plain("").tobytes()))] * 2
    spans = sorted((r.sequence_id, r.offset, r.length) for r in out)
    stream = [(s * 4096 + o, s * 4096 + o + n) for s, o, n in spans]
    assert all(a[1] == b[0] for a, b in zip(stream, stream[1:])) and stream[0][0] == 0  # gapless: only the end is padded
    assert stream[-1][1] == sum(len(plain(t)) for _, t in texts) and all(o + n <= 4096 for _, o, n in spans)
    assert len([r for r in out if r.doc_id == 4]) == 2


def test_sequences_round_trip(documents, spark, monkeypatch):
    monkeypatch.setattr(concat_packing, "BROADCAST_ROWS", 0)  # the way without a broadcast
    texts = [(k, f"some text {k} " * (k % 40)) for k in range(200)]
    docs = documents(texts, {"offset": F.lit(1), "part": F.lit("x"), "ids": F.lit(None).cast("string")}).repartition(7)
    pieces = pack(docs, ["doc_id", "part", "ids"], FILE, end=2, size=64, with_ids=True)
    joined = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in sequences(pieces, 64).collect()}
    assert sorted(joined) == list(range(len(joined))) and {len(v) for k, v in joined.items() if k < max(joined)} == {64}
    stream, at = np.concatenate([joined[k] for k in sorted(joined)]), {}
    for r in pieces.collect():
        part = joined[r.sequence_id][r.offset : r.offset + r.length]
        assert part.tobytes() == bytes(r.ids) and zlib.crc32(part.tobytes()) == r.ids_crc32
        at.setdefault(r.record.doc_id, []).append((r.start, r.sequence_id * 64 + r.offset, r.length))
    for k, text in texts:
        own = sorted(at[k])
        assert np.concatenate([stream[g : g + n] for _, g, n in own]).tolist() == plain(text).tolist()
    starts = {r.sequence_id: (r.record.doc_id, r.start) for r in boundaries(pieces).collect()}
    assert sorted(starts) == sorted(joined)
    padded = {r.sequence_id: len(r.ids) for r in sequences(pieces, 64, pad=9).collect()}
    assert set(padded.values()) == {4 * 64}


def test_long_texts_travel_in_chunks(documents, spark, monkeypatch):
    monkeypatch.setattr(concat_packing, "CHUNK", 100)
    text = "many words of one text " * 300
    out = sorted(pack(documents([(1, text), (2, "x")]).coalesce(1), ["doc_id"], FILE, end=2, size=64, with_ids=True).collect(), key=lambda r: (r.sequence_id, r.offset))
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in out if r.record.doc_id == 1])
    assert ids.tolist() == plain(text).tolist() and {r.doc_tokens for r in out if r.record.doc_id == 1} == {len(ids)}


def test_places_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(concat_packing, "BLOCK", 4)
    rng = random.Random(1)
    totals = [(p, rng.randrange(1, 50)) for p in range(23) if p != 6]
    rows = spark.createDataFrame([(p, n) for p, total in totals for n in (total, 3)], "part long, n long")
    want, base = {}, 0
    for p, total in totals:
        want[p] = base
        base += total + 3
    assert {r.part: r.base for r in places(rows).collect()} == want


def test_empty_table(documents, stored, spark):
    assert op11_concat_packing(spark, stored(documents=documents([]))).collect() == []
