"""Alignment of two tokenizers by pointer jumping over overlapping tokens.

Both tokenizers cut the same bytes. Every token points to the farthest-right token it overlaps (to
itself, if none reaches farther; of two that end together, to that of tokenizer B), and the pointers of all
tokens of many texts are doubled at once, ``to = to[to]``, until nothing changes. All tokens between two common ends
then point to the same terminal token, which names their group. Rounds follow the logarithm of the longest group.

Pair counts need the whole corpus. Documents are written in blocks of ``BLOCK_PAIRS`` linked pairs, and
only the distinct pairs of a block travel: they are counted per pair, joined with the counts and each A id's highest, and
come back to their block. So a pair that every document holds costs one row per block, and no task holds more than
a block (or one document, if that is larger).

A text that is null or empty, or that the tokens of one side don't spell, has no tokens: zeros and an empty digest.
Repeated rows and null ids count row by row, as documents of their own. Very long texts are worked on in segments, cut
before spaces that follow a character, where both tokenizers cut anyway. An empty table gives no rows. Other columns, whatever
their names, stay in ``record``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardframe.llm.byte_level import spelled
from wardframe.llm.common import Stages, per_row, table
from wardframe.llm.tokens import OTHER, vocabulary

SEGMENT = 1 << 20  # characters worked on at once, and more only without a place to cut
BLOCK_PAIRS = 2_000_000  # linked pairs of the documents of a block
MOST_LINKS = 1 << 16  # links of a group that are listed one by one

CUT = re.compile(r"(?<=\S)(?= )")


class Files(NamedTuple):
    """Vocabulary files: tokenizer A and, if it has one, its rank file; sentencepiece model B."""

    a: str
    a_ranks: str | None
    b: str


class ByteEncoder:
    """Byte-level ids of a text in which the strings of special tokens are plain text.

    ``tiktoken`` merges by the rank file of the same vocabulary; a text with characters that it may split in
    another way, and any text where there is no rank file, goes through the tokenizer itself.
    """

    def __init__(self, tokenizer_file: str, ranks_file: str | None):
        self.file, self.ranked = tokenizer_file, None
        if ranks_file:
            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.ranked = own.encode_to_numpy

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.file)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes of each id."""
        with open(self.file, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        out = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            out[k] = spelled(token)
        return out

    def ids(self, text: str) -> np.ndarray:
        if self.ranked and not OTHER.search(text):
            return self.ranked(text, disallowed_special=()).astype(np.int64)
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.int64)


class PieceEncoder:
    """Ids of sentencepiece for space+text; the model adds the space by itself, to any text but the empty one."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.token_bytes = [bytes([int(p[3:-1], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        # Without a piece that goes on after a space, texts can be cut before spaces that follow a character.
        self.cuttable = all(re.fullmatch("▁*[^▁]*", p, re.DOTALL) for p in pieces)
        self.space = self.model.piece_to_id("▁")

    def ids(self, spaced: str) -> np.ndarray:
        return np.array(self.model.encode(spaced[1:]) if len(spaced) > 1 else [self.space], np.int64)


class Aligner:
    """Both tokenizers of a worker process and the tables that describe their ids."""

    def __init__(self, files: Files):
        self.a, self.b = ByteEncoder(files.a, files.a_ranks), PieceEncoder(files.b)
        self.bytes_a, self.bytes_b = (np.array(x.token_bytes, dtype=object) for x in (self.a, self.b))
        self.length_a, self.length_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.width = len(self.bytes_b)  # pair = a * width + b
        written = [f"{k}{end}".encode() for n, ends in ((len(self.bytes_a), ",|"), (self.width, ",;")) for end in ends for k in range(n)]
        self.written = np.array(written, dtype=object)

    def segments(self, text: str | None) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of A and B of each segment of space+text; None if the text has no tokens."""
        if not text:
            return None
        spaced, out, at = " " + text, [], 0
        while at < len(spaced):
            end = len(spaced)
            if self.b.cuttable and end - at > SEGMENT and (m := CUT.search(spaced, at + SEGMENT)):
                end = m.start()
            part, at = spaced[at:end], end
            a, b, whole = self.a.ids(part), self.b.ids(part), part.encode()
            if any(b"".join(table[ids].tolist()) != whole for table, ids in ((self.bytes_a, a), (self.bytes_b, b))):
                return None
            out.append((a, b))
        return out


_ALIGNERS: dict[Files, Aligner] = {}


def aligner(files: Files) -> Aligner:
    """One per worker process and pair of vocabularies."""
    if files not in _ALIGNERS:
        _ALIGNERS[files] = Aligner(files)
    return _ALIGNERS[files]


def group_numbers(length_a: np.ndarray, length_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of every A and B token, numbered in order, and each group's end.

    The lengths are of tokens that cut the same bytes. Pointer jumping: a node is a token, A's first.
    """
    end_a, end_b, n = np.cumsum(length_a), np.cumsum(length_b), len(length_a)
    last_b = np.searchsorted(end_b - length_b, end_a, "left") - 1  # the last that starts before the end
    last_a = np.searchsorted(end_a - length_a, end_b, "left") - 1
    to = np.concatenate([n + last_b, np.where(end_a[last_a] > end_b, last_a, n + np.arange(len(length_b)))])
    while True:
        farther = to[to]
        if np.array_equal(farther, to):
            break
        to = farther
    terminal = to[n:] == n + np.arange(len(length_b))
    number = np.cumsum(terminal) - 1
    return number[to[:n] - n], number[to[n:] - n], end_b[terminal]


class Digest:
    """What the segments of one document add up to."""

    def __init__(self):
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.sha = None
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def update(self, written: bytes) -> None:
        if self.sha is None:
            self.sha = hashlib.sha256(written)
        else:
            self.sha.update(b";" + written)

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) == 1:
            return self.pairs[0]
        if not self.pairs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return _summed(np.concatenate([p for p, _ in self.pairs]), np.concatenate([t for _, t in self.pairs]))


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def _pairs(a, b, group_a, group_b, in_a, in_b, owner, own: Aligner):
    """``(owner, pair, links)`` of all groups: how often each document links each id pair."""
    most = len(own.length_a) * own.width
    large = np.flatnonzero(in_a * in_b > MOST_LINKS)
    small_a = ~np.isin(group_a, large) if len(large) else np.ones(len(a), bool)
    at, of = np.flatnonzero(small_a), group_a[small_a]
    reps = in_b[of]
    first_b = np.cumsum(in_b) - in_b
    left = np.repeat(at, reps)
    inside = np.arange(len(left)) - np.repeat(np.cumsum(reps) - reps, reps)
    right = np.repeat(first_b[of], reps) + inside
    keys, times = np.unique(owner[group_a[left]] * most + a[left] * own.width + b[right], return_counts=True)
    more = [(keys, times)]
    first_a = np.cumsum(in_a) - in_a
    for g in large.tolist():
        ua, ca = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
        ub, cb = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
        more.append(((owner[g] * most + ua[:, None] * own.width + ub).ravel(), (ca[:, None] * cb).ravel()))
    if len(more) > 1:
        keys, times = _summed(np.concatenate([k for k, _ in more]), np.concatenate([t for _, t in more]))
    return keys // most, keys % most, times


def _add(own: Aligner, parts: list[tuple[int, np.ndarray, np.ndarray]], digests: list[Digest]) -> None:
    """Align segments (document, ids of A, ids of B), a document's own in a row, and add what they give."""
    a, b = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
    group_a, group_b, _ = group_numbers(own.length_a[a], own.length_b[b])
    in_a, in_b = np.bincount(group_a), np.bincount(group_b)
    docs = sorted({p[0] for p in parts})
    place = {d: k for k, d in enumerate(docs)}
    local = np.array([place[p[0]] for p in parts])
    owner = np.empty(len(in_b), np.int64)
    owner[group_b] = np.repeat(local, [len(p[2]) for p in parts])
    groups = np.bincount(owner, minlength=len(docs))
    links = np.bincount(owner, in_a.astype(np.int64) * in_b, minlength=len(docs))
    if links.sum() >= 2**53:  # bincount adds in doubles
        links = np.zeros(len(docs), np.int64)
        np.add.at(links, owner, in_a.astype(np.int64) * in_b)
    n_a, n_b = (np.bincount(local, [len(p[k]) for p in parts], minlength=len(docs)).astype(np.int64) for k in (1, 2))

    # Tokens in written order: the A tokens of a group, then its B tokens.
    last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + last_a * len(own.length_a)
    order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = 2 * len(own.length_a) + b + last_b * own.width
    written = own.written[order].tolist()

    of, pair, times = _pairs(a, b, group_a, group_b, in_a, in_b, owner, own)
    bounds = np.searchsorted(of, np.arange(len(docs) + 1))
    at = 0
    for k, d in enumerate(docs):
        digest, n = digests[d], int(n_a[k] + n_b[k])
        digest.n_a += int(n_a[k])
        digest.n_b += int(n_b[k])
        digest.n_groups += int(groups[k])
        digest.n_links += int(links[k])
        digest.update(b"".join(written[at : at + n])[:-1])
        digest.pairs.append((pair[bounds[k] : bounds[k + 1]], times[bounds[k] : bounds[k + 1]]))
        at += n


def digests_of(texts: Sequence[str | None], own: Aligner) -> list[Digest]:
    """One digest per text, in order."""
    digests, parts, size = [Digest() for _ in texts], [], 0
    for d, text in enumerate(texts):
        for a, b in own.segments(text) or ():
            parts.append((d, a, b))
            size += len(a) + len(b)
            if size > SEGMENT // 2:
                _add(own, parts, digests)
                parts, size = [], 0
    if parts:
        _add(own, parts, digests)
    return digests


def _packed(pairs: np.ndarray, times: np.ndarray, squeeze) -> bytes:
    """Sorted pairs as differences, then their links; small numbers throughout, so they squeeze well."""
    return squeeze(np.concatenate([np.diff(pairs, prepend=0), times]).astype("<i8" if times.max(initial=0) >= 2**31 or pairs.max(initial=0) >= 2**31 else "<i4").tobytes())


def _unpacked(packed: bytes, wide: bool, open_) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(open_(packed), "<i8" if wide else "<i4").astype(np.int64)
    return np.cumsum(both[: len(both) // 2]), both[len(both) // 2 :]


def aligned(docs: DataFrame, keep: Sequence[str], files: Files) -> DataFrame:
    """A row per document: ``record``, its ``block``, n_a, n_b, n_groups, n_links, groups_sha256, and its
    linked pairs with their links (``wide``, ``pairs``)."""
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text")
    names = ["block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "wide", "pairs"]

    def run(batches):
        own, squeeze = aligner(files), zstandard.ZstdCompressor(1).compress
        block, held = TaskContext.get().partitionId() << 32, 0

        def rows(texts: pd.DataFrame) -> pd.DataFrame:
            nonlocal block, held
            out = []
            for digest in digests_of(texts["text"].tolist(), own):
                pairs, times = digest.pair_counts()
                if held and held + len(pairs) > BLOCK_PAIRS:
                    block, held = block + 1, 0
                held += len(pairs)
                wide = bool(times.max(initial=0) >= 2**31 or pairs.max(initial=0) >= 2**31)
                out.append((block, digest.n_a, digest.n_b, digest.n_groups, digest.n_links, digest.sha.hexdigest() if digest.sha else "", wide, _packed(pairs, times, squeeze)))
            result = pd.DataFrame(out, columns=names)
            result.insert(0, "record", texts["record"].array)
            return result

        return per_row(batches, rows, SEGMENT)

    schema = f"record {slim.schema['record'].dataType.simpleString()}, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, wide boolean, pairs binary"
    return slim.mapInPandas(run, schema)


def _block_pairs(rows: DataFrame) -> DataFrame:
    """``block, pair, docs``: the distinct pairs of each block and how many of its documents link them."""

    def run(batches) -> Iterator[pd.DataFrame]:
        open_ = zstandard.ZstdDecompressor().decompress
        block, found, size = None, [], 0

        def done() -> pd.DataFrame:
            pairs, docs = np.unique(np.concatenate(found), return_counts=True)
            return pd.DataFrame({"block": block, "pair": pairs, "docs": docs})

        for batch in batches:
            for b, wide, packed in zip(batch["block"].tolist(), batch["wide"].tolist(), batch["pairs"], strict=True):
                if size and (b != block or size > 2 * BLOCK_PAIRS):
                    yield done()
                    found, size = [], 0
                block = b
                pairs, _ = _unpacked(packed, wide, open_)
                if len(pairs):
                    found.append(pairs)
                    size += len(pairs)
        if size:
            yield done()

    return rows.select("block", "wide", "pairs").mapInPandas(run, "block long, pair long, docs long")


def pair_counts(block_pairs: DataFrame, width: int) -> DataFrame:
    """``pair, a, b, docs, best``: how many documents link an id pair, and whether that is its A id's highest."""
    counts = block_pairs.groupBy("pair").agg(F.sum("docs").alias("docs"))
    counts = counts.withColumns({"a": F.floor(F.col("pair") / width), "b": F.col("pair") % width})
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))  # a row per id of tokenizer A at most
    return counts.join(top, "a").select("pair", "a", "b", "docs", (F.col("docs") == F.col("top")).alias("best"))


def align(docs: DataFrame, keep: Sequence[str], files: Files) -> tuple[DataFrame, DataFrame]:
    """Documents (``record``, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum), and the corpus's
    linked id pairs (``a, b, docs, best``)."""
    stages = Stages(docs.sparkSession, "alignment")
    rows = stages.write(aligned(docs, keep, files), "rows")
    held = stages.write(_block_pairs(rows), "pairs")
    counts = stages.write(pair_counts(held, PieceEncoder(files.b).model.get_piece_size()), "counts")
    looked_up = held.select("block", "pair").join(counts.select("pair", "docs", "best"), "pair")
    names = ["record", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def total(block: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        open_ = zstandard.ZstdDecompressor().decompress
        known = known.sort_values("pair")
        pair, docs, best = (known[c].to_numpy() for c in ("pair", "docs", "best"))
        n_best, count_sum = [], []
        for wide, packed in zip(block["wide"].tolist(), block["pairs"], strict=True):
            pairs, times = _unpacked(packed, wide, open_)
            at = np.searchsorted(pair, pairs)
            n_best.append(int(times[best[at]].sum()) if len(at) else 0)
            count_sum.append(int((times * docs[at]).sum()) if len(at) else 0)
        return block[names].assign(n_best=np.array(n_best, np.int64), count_sum=np.array(count_sum, np.int64))

    schema = f"record {rows.schema['record'].dataType.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    done = rows.groupBy("block").cogroup(looked_up.groupBy("block")).applyInPandas(total, schema)
    return done, counts.select("a", "b", "docs", "best")


def groups(docs: DataFrame, keep: Sequence[str], files: Files) -> DataFrame:
    """A row per group: ``record``, number, the span of bytes of space+text, and the ids of both sides."""
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text")
    names = ["number", "start", "end", "a", "b"]

    def run(batches):
        own = aligner(files)

        def rows(texts: pd.DataFrame) -> pd.DataFrame:
            out, of = [], []
            for i, text in enumerate(texts["text"]):
                number = offset = 0
                for a, b in own.segments(text) or ():
                    group_a, group_b, ends = group_numbers(own.length_a[a], own.length_b[b])
                    cut_a, cut_b = (np.searchsorted(g, np.arange(1, len(ends))) for g in (group_a, group_b))
                    starts = offset + np.append(0, ends[:-1])
                    out += zip(range(number, number + len(ends)), starts.tolist(), (offset + ends).tolist(), np.split(a, cut_a), np.split(b, cut_b), strict=True)
                    of += [i] * len(ends)
                    number, offset = number + len(ends), offset + int(ends[-1])
            result = pd.DataFrame(out, columns=names)
            result.insert(0, "record", texts["record"].iloc[of].array)
            return result

        return per_row(batches, rows, SEGMENT)

    return slim.mapInPandas(run, f"record {slim.schema['record'].dataType.simpleString()}, number long, start long, end long, a array<long>, b array<long>")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Files(vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), vocabulary("piece_bpe_32k.model"))
    done, _ = align(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], files)
    return done.select("record.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
