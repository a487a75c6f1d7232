import hashlib
import random
from collections import Counter

import numpy as np
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wardframe.llm import token_alignment
from wardframe.llm.token_alignment import ByteEncoder, Files, align, aligner, group_numbers, groups, op12_token_alignment
from wardframe.llm.tokens import vocabulary

FILES = Files(vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
A = Tokenizer.from_file(FILES.a)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=FILES.b)
MADE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in MADE} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in MADE)}


def plain_groups(text):
    """[(ids of A, ids of B)] per group, by walking over both lists; [] without tokens."""
    if not text:
        return []
    whole = (" " + text).encode()
    a = [(k, bytes(BYTE[c] for c in A.id_to_token(k))) for k in A.encode(" " + text, add_special_tokens=False).ids]
    pieces = [(k, B.id_to_piece(k)) for k in B.encode(text)]
    b = [(k, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()) for k, p in pieces]
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    ends = [{int(x) for x in np.cumsum([len(t) for _, t in side])} for side in (a, b)]
    common = sorted(ends[0] & ends[1])

    def split(side):
        out, at, own = [[]], 0, iter(common)
        end = next(own)
        for k, t in side:
            at += len(t)
            out[-1].append(k)
            if at == end:
                out.append([])
                end = next(own, None)
        return out[:-1]

    return list(zip(split(a), split(b), strict=True))


def plain_rows(texts):
    per_doc = [plain_groups(t) for _, t in texts]
    links = [Counter((a, b) for ga, gb in doc for a in ga for b in gb) for doc in per_doc]
    docs = Counter(pair for c in links for pair in c)
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for (doc_id, _), doc, c in zip(texts, per_doc, links, strict=True):
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in doc)
        out.append((
            doc_id, sum(len(a) for a, _ in doc), sum(len(b) for _, b in doc), len(doc), sum(c.values()),
            sum(n for (a, b), n in c.items() if docs[a, b] == top[a]), sum(n * docs[p] for p, n in c.items()),
            hashlib.sha256(written.encode()).hexdigest() if doc else "",
        ))
    return sorted(out, key=repr)


def made_texts(seed, n):
    rng = random.Random(seed)
    alphabet = "ab cZÉßﬁ\n\t.'²½ª́ 　​中😀<s>|0123's're'LL   é"
    words = ["token", "alignment", " ", "  ", "naïve", "北京大学", "....", "Internationalisation", "\n\n", "<|endoftext|>", "</s>", "<0x41>", "aaaaaaaa", "１２３"]
    return ["".join(rng.choices(alphabet, k=rng.randrange(40))) + " ".join(rng.choices(words, k=rng.randrange(9))) for _ in range(n)]


def test_ids_are_the_tokenizers_own():
    own = ByteEncoder(FILES.a, FILES.a_ranks)
    rng = random.Random(4)
    plainer = "ab cZÉßž\n\t.'\"0123's're'LL 'Ve  -–…«»×"
    for text in [*made_texts(3, 3000), *("".join(rng.choices(plainer, k=rng.randrange(60))) for _ in range(2000)), "", " ", "a  ", "<|endoftext|>x"]:
        assert own.ids(" " + text).tolist() == A.encode(" " + text, add_special_tokens=False).ids, repr(text)


def test_pointer_jumping_finds_common_ends():
    rng = np.random.default_rng(5)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        cuts = [np.append(np.flatnonzero(rng.random(size - 1) < p) + 1, size) for p in rng.random(2)]
        common = np.intersect1d(*cuts)
        group_a, group_b, ends = group_numbers(*[np.diff(c, prepend=0) for c in cuts])
        assert ends.tolist() == common.tolist()
        assert all(np.searchsorted(common, c).tolist() == g.tolist() for c, g in zip(cuts, (group_a, group_b)))
    # one long group: the number of rounds follows the logarithm
    group_a, group_b, ends = group_numbers(np.append(np.full(50_000, 2), 1), np.append(1, np.full(50_000, 2)))
    assert ends.tolist() == [100_001] and not group_a.any() and not group_b.any()


def test_rows_against_brute_force(documents, stored, spark):
    texts = [*enumerate(made_texts(1, 250)), (300, None), (301, ""), (302, "▁ is not a space"), (303, "same text"), (303, "same text"), (None, "same text"), (304, " ")]
    out = op12_token_alignment(spark, stored(documents=documents(texts)))
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == plain_rows(texts)


def test_small_blocks_agree(documents, spark, monkeypatch):
    monkeypatch.setattr(token_alignment, "BLOCK_PAIRS", 40)
    texts = [*enumerate(made_texts(2, 120)), (500, " ".join(made_texts(4, 40)))]
    docs = documents(texts, {"block": F.lit(1), "pairs": F.lit("x"), "n_a": F.lit(None).cast("string")}).repartition(5)
    done, counts = align(docs, ["doc_id", "block", "n_a"], FILES)
    want = plain_rows(texts)
    got = done.select("record.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "record.block").collect()
    assert sorted((tuple(r)[:-1] for r in got), key=repr) == want and {r.block for r in got} == {1}
    assert not {(r.a, r.b) for r in counts.collect() if r.docs < 1 or not r.a < 50_257}


def test_groups_hold_the_ids(documents, spark):
    texts = [*enumerate(made_texts(6, 60)), (70, None)]
    found = {}
    for r in groups(documents(texts), ["doc_id"], FILES).collect():
        found.setdefault(r.record.doc_id, []).append((r.number, r.start, r.end, r.a, r.b))
    for k, text in texts:
        own = sorted(found.get(k, []))
        assert [(a, b) for *_, a, b in own] == plain_groups(text)
        assert not own or (own[0][1] == 0 and own[-1][2] == len((" " + text).encode()) and all(x[2] == y[1] for x, y in zip(own, own[1:])))


def test_segments_and_large_groups_agree(monkeypatch):
    monkeypatch.setattr(token_alignment, "SEGMENT", 50)
    monkeypatch.setattr(token_alignment, "MOST_LINKS", 3)
    texts = [*made_texts(8, 60), " ".join(made_texts(9, 50)), None, "a" * 500, "\U0001f600" * 90, "ends in one space "]
    texts += ["word " * 40 + k for k in ("", " ", "▁", "\n", "<0x41>", "last ")]
    for text, digest in zip(texts, token_alignment.digests_of(texts, aligner(FILES)), strict=True):
        doc = plain_groups(text)
        links = Counter(a * 32_000 + b for ga, gb in doc for a in ga for b in gb)
        assert (digest.n_a, digest.n_groups, digest.n_links) == (sum(len(a) for a, _ in doc), len(doc), sum(links.values()))
        assert dict(zip(*(x.tolist() for x in digest.pair_counts()))) == links
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in doc)
        assert (digest.sha.hexdigest() if digest.sha else "") == (hashlib.sha256(written.encode()).hexdigest() if doc else "")


def test_wide_counts_keep():
    big = (np.array([5, 2**31 + 7]), np.array([1, 2]))
    assert [x.tolist() for x in token_alignment._unpacked(token_alignment._packed(*big, bytes), True, bytes)] == [x.tolist() for x in big]
    assert aligner(FILES).width == B.get_piece_size()


def test_empty_table(documents, stored, spark):
    assert op12_token_alignment(spark, stored(documents=documents([]))).collect() == []
