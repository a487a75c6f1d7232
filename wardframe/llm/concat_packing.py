"""Concatenate and cut: all documents are one stream of ids, which fixed windows cut into sequences.

Two passes of prefix sums give every document its place in that stream. In the first, each task writes its
documents' ids with the running total of its own ids; the totals of the partitions, one row each, then
become the partitions' places, by running sums in blocks of partitions and over the blocks. In the second, a document at
place g fills ``[g, g + n)``: it is cut wherever that passes a multiple of the sequence length.
All sequences are full but the last, so padding is less than one sequence however large the corpus is.
The pieces at offset 0 are the boundary records: they say with which document, and where in it, a sequence starts
(``boundaries``), so that any sequence can be read by itself.

Ids are written once, so a lost executor repeats at most its own tasks, and the order of documents is that of the
written rows: no attempt of a task can disagree with another.

Null texts are empty; an empty text is the end id alone. Repeated rows and null ids are packed row by row. A very long
text is cut like any other; its ids travel in rows of ``CHUNK`` ids, and a piece ends there too. An
empty table gives no rows. Other columns of the documents, whatever their names, stay in ``record``.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardframe.llm.byte_level import BYTE_OF, spelled
from wardframe.llm.common import Stages, per_row, table
from wardframe.llm.tokens import LETTERS, OTHER, SPACES, vocabulary

SEQUENCE = 4096
CHUNK = 1 << 20  # ids in a written row
MOST_WORDS = 300_000  # kept per worker: some 60 MB, and what one slice of texts adds
BLOCK = 1024  # partitions whose places one window sums
BROADCAST_ROWS = 200_000  # partitions whose places are sent to all executors, 16 bytes each

WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[0-9]|[^{SPACES}{LETTERS}0-9]+")


class WordEncoder(dict):
    """Ids of texts as little-endian 32-bit numbers; maps a lower-case word, digit or run of marks to its own.

    Words are kept once met, and those that many texts bring are merged in one call by ``tiktoken``, from the
    tokenizer's own vocabulary: the mark of a word's end is a zero byte after it, which joins the last character first, as those
    pairs rank before all merges. A text with a character that may be normalised, or classed, in another way than
    here, or with the text of a special token, goes through the tokenizer itself, and so does every text if the vocabulary's
    numbers don't follow its merges. Both ways give the same ids.
    """

    def __init__(self, tokenizer_file: str):
        import tiktoken

        self.file, self.merged = tokenizer_file, None
        with open(tokenizer_file, encoding="utf-8") as f:
            found = json.load(f)
        self.special = [t["content"] for t in found["added_tokens"]]
        end, vocab = found["model"]["end_of_word_suffix"], found["model"]["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in found["model"]["merges"]]
        # tiktoken merges by the number of the result, lowest first.
        numbers = [vocab[a + b] for a, b in merges]
        if numbers == sorted(numbers) and numbers[0] > max(vocab[c + e] for c in BYTE_OF for e in ("", end)):
            ranks = {spelled(t.removesuffix(end)) + b"\0" * t.endswith(end): k for t, k in vocab.items()}
            own = tiktoken.Encoding("words", pat_str="[^\0]*\0", mergeable_ranks=ranks, special_tokens={})
            self.merged = own.encode_to_numpy
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a word
        self.last[[k for t, k in vocab.items() if t.endswith(end)]] = True

    @cached_property
    def whole(self):
        """The tokenizer itself, loaded by the first text that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.file)

    def learn(self, words: list[str]) -> None:
        """Merge words that are not known yet."""
        ids = self.merged("\0".join([*words, ""]), disallowed_special=()).astype("<u4")
        packed, ends = ids.tobytes(), (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
        self.update(zip(words, (packed[lo:hi] for lo, hi in zip([0, *ends], ends)), strict=True))

    def ids(self, texts: Sequence[str | None]) -> list[bytes]:
        found: list = []
        for text in texts:
            if not text:
                found.append([])
            elif self.merged is None or OTHER.search(text) or "İ" in text or any(s in text for s in self.special):
                found.append(np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                found.append(WORDS.findall(text.lower()))
        if len(self) > MOST_WORDS:
            self.clear()
        new = dict.fromkeys(w for words in found if isinstance(words, list) for w in words if w not in self)
        if new:
            self.learn(list(new))
        return [b"".join(map(self.__getitem__, x)) if isinstance(x, list) else x for x in found]


_ENCODERS: dict[str, WordEncoder] = {}


def word_encoder(tokenizer_file: str) -> WordEncoder:
    """One per worker process and vocabulary."""
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


def id_rows(docs: DataFrame, keep: Sequence[str], tokenizer_file: str, end: int) -> DataFrame:
    """A row per document (or ``CHUNK`` of it): ``record`` (the ``keep`` columns), the ids, and ``part`` and
    ``before``: the task's number and how many ids it has had so far."""
    slim = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("record"), "text")

    def run(batches):
        own, last, part, before = word_encoder(tokenizer_file), end.to_bytes(4, "little"), TaskContext.get().partitionId(), 0

        def rows(texts: pd.DataFrame) -> pd.DataFrame:
            nonlocal before
            out, of = [], []
            for i, ids in enumerate(own.ids(texts["text"].tolist())):
                ids += last
                n = len(ids) // 4
                for start in range(0, n, CHUNK):
                    chunk = ids[4 * start : 4 * (start + CHUNK)]
                    out.append((part, before, start, n, len(chunk) // 4, chunk))
                    of.append(i)
                    before += len(chunk) // 4
            result = pd.DataFrame(out, columns=["part", "before", "start", "doc_tokens", "n", "ids"])
            result.insert(0, "record", texts["record"].iloc[of].array)
            return result

        return per_row(batches, rows)

    schema = f"record {slim.schema['record'].dataType.simpleString()}, part long, before long, start long, doc_tokens long, n long, ids binary"
    return slim.mapInPandas(run, schema)


def places(rows: DataFrame) -> DataFrame:
    """``part, base``: how many ids all earlier partitions hold, by running sums of two levels."""
    block = F.floor(F.col("part") / BLOCK)
    totals = rows.groupBy("part").agg(F.sum("n").alias("n")).withColumn("block", block)
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per BLOCK partitions
    blocks = totals.groupBy("block").agg(F.sum("n").alias("n")).select("block", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("first"))
    placed = totals.select("part", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("later"))
    return placed.join(blocks, "block").select("part", (F.col("first") + F.col("later")).alias("base"))


def pack(docs: DataFrame, keep: Sequence[str], tokenizer_file: str, end: int, size: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """A row per piece: ``record``, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    stages = Stages(docs.sparkSession, "concat")
    rows = stages.write(id_rows(docs, keep, tokenizer_file, end), "ids")
    bases = stages.write(places(rows), "places")
    if bases.count() <= BROADCAST_ROWS:
        bases = F.broadcast(bases)
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def run(batches):
        for batch in batches:
            out, of = [], []
            at = (batch["base"] + batch["before"]).to_numpy()
            for i, (g, start, tokens, ids) in enumerate(zip(at.tolist(), batch["start"].tolist(), batch["doc_tokens"].tolist(), batch["ids"], strict=True)):
                n = len(ids) // 4
                cuts = [0, *range(size - g % size, n, size), n]
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    own = ids[4 * lo : 4 * hi]
                    out.append((start + lo, hi - lo, zlib.crc32(own), tokens, (g + lo) // size, (g + lo) % size, *[own] * with_ids))
                    of.append(i)
            result = pd.DataFrame(out, columns=names)
            result.insert(0, "record", batch["record"].iloc[of].array)
            yield result

    schema = f"record {rows.schema['record'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return rows.join(bases, "part").select("record", "base", "before", "start", "doc_tokens", "ids").mapInPandas(run, schema)


def boundaries(pieces: DataFrame) -> DataFrame:
    """``sequence_id, record, start``: the document and the place in it with which each sequence starts."""
    return pieces.where("offset = 0").select("sequence_id", "record", "start")


def sequences(pieces: DataFrame, size: int = SEQUENCE, pad: int | None = None) -> DataFrame:
    """``sequence_id, ids, length``: the ids of each sequence in order, filled up with ``pad`` if given."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    if pad is not None:
        fill = F.lit(np.full(size, pad, "<u4").tobytes())
        joined = F.substring(F.concat(joined, fill), 1, 4 * size)
    return pieces.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))


def op11_concat_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = pack(docs, ["doc_id"], vocabulary("word_bpe_49k.json"), end=2)
    return pieces.select("record.doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
