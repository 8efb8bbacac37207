"""Harmonic packing of tokenised documents into sequences of fixed length.

A document's tokens are cut into whole sequences, powers of two down to SMALLEST, and one
rest below SMALLEST. Piece lengths are reciprocal-capacity classes: a bin of the class of
length s holds exactly capacity // s pieces. Tasks number their pieces within each class; a
count per task and class gives every task the number it starts at, so that each piece knows
its bin and its place in it by arithmetic alone. The last, partly filled bin of a class of
powers of two is cut into bins that are powers of two as well and need no padding.

Tokens come from a public tokenizer. Its words never cross ASCII white space, so the ids
of a text are those of its blank-separated words, and each distinct word is tokenised once
per task slice.

Defined cases: null text is empty, and an empty document is its end token alone; repeated
documents are packed one by one; a null doc_id stays null; no documents, no pieces; extra
columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillforge.llm.store import keep
from tillforge.llm.words import slices

CAPACITY = 2048
SMALLEST = 8
END = 1
#: Words whose ids a Python worker remembers; beyond it the memory starts anew.
REMEMBERED = 250_000
#: Words that the tokenizer gets at once, and bytes of text whose ids a worker holds.
TOGETHER, TEXT_BYTES = 2048, 4 << 20

_PLAIN_WORD = re.compile("[a-z]+")
_TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokens:
    """Ids of lower-cased words by the tokenizer, remembered up to a bound."""

    def __init__(self, path: str):
        # Threads of a library inside a task would take cores and memory of other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str | None, tuple[int, ...]] = {"": (), None: ()}

    def _ids(self, parts: list[str]) -> list[tuple[int, ...]]:
        """Ids of each part; those not remembered go to the tokenizer together."""
        known = self.known
        new = [p for p in parts if p not in known]
        plain = [p for p in new if _PLAIN_WORD.fullmatch(p)]  # normaliser and splitter leave these as they are
        for p in plain:
            known[p] = tuple([t.id for t in self.model.tokenize(p)])
        others = [p for p in new if p not in known]
        for at in range(0, len(others), TOGETHER):
            some = others[at : at + TOGETHER]
            for p, got in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                known[p] = tuple(got.ids)
        return [known[p] for p in parts]

    def _parts(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Of distinct words the part before the last ASCII signs, and these signs or null.

        ASCII signs after an ASCII letter are always a run of their own, but for an
        apostrophe; special tokens are looked for before words are split."""
        special = pc.match_substring(words, "<|")
        low = pc.if_else(special, words, pc.ascii_lower(words))
        head = pc.ascii_rtrim(low, characters=_TAIL)
        split = pc.and_(pc.match_substring_regex(head, "[a-z]$"), pc.less(pc.binary_length(head), pc.binary_length(low)))
        split = pc.and_not(split, special)
        tail = pc.replace_substring_regex(low, r"(?s)^.*[^!-/:-@\[-`{-~]", "")
        return pc.if_else(split, head, low), pc.if_else(split, tail, pa.scalar(None, pa.large_string()))

    def of_texts(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows and the n + 1 row borders, without end tokens."""
        if len(self.known) > REMEMBERED:
            self.known = {"": (), None: ()}
        split = pc.ascii_split_whitespace(pc.fill_null(text, "").cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        heads, tails = self._parts(words.dictionary.cast(pa.large_string()))
        parts = pa.concat_arrays([heads, tails]).dictionary_encode()
        of_part = self._ids(parts.dictionary.to_pylist())
        sizes = np.fromiter(map(len, of_part), np.int64, len(of_part))
        table = np.fromiter(chain.from_iterable(of_part), np.uint16, int(sizes.sum()))
        starts = np.cumsum(sizes) - sizes
        # A word without signs has no second part: the same as one without ids.
        sizes, starts = np.append(sizes, 0), np.append(starts, 0)
        first, second = pc.fill_null(parts.indices, len(of_part)).to_numpy().reshape(2, -1)
        at = words.indices.to_numpy()
        both = np.stack([first[at], second[at]], axis=1).ravel()
        counts = sizes[both]
        ends = np.cumsum(counts)
        spots = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[both] - (ends - counts), counts)
        word_borders = split.offsets.to_numpy()
        row_borders = np.concatenate([[0], ends])[2 * (word_borders - word_borders[0])]
        return table[spots].astype(np.uint32), row_borders


def pieces(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document, in order."""
    out = [capacity] * (tokens // capacity)
    rest, size = tokens % capacity, capacity // 2
    while size >= SMALLEST:
        if rest >= size:
            out.append(size)
            rest -= size
        size //= 2
    return out + [rest] * (rest > 0)


CUT = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task bigint, place bigint"
_tokens: dict[str, WordTokens] = {}


def _cut(path: str, capacity: int):
    def run(batches):
        if path not in _tokens:
            _tokens[path] = WordTokens(path)
        task, placed = TaskContext.get().partitionId(), {}
        for batch in batches:
            text = batch.column("text")
            docs = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for lo, hi in slices(text, TEXT_BYTES):
                ids, borders = _tokens[path].of_texts(text.slice(lo, hi - lo))
                rows = []
                for k in range(hi - lo):
                    own = np.append(ids[borders[k] : borders[k + 1]], np.uint32(END)).astype("<u4")
                    raw, start = own.tobytes(), 0
                    for size in pieces(len(own), capacity):
                        place = placed.get(size, 0)
                        placed[size] = place + 1
                        crc = zlib.crc32(raw[4 * start : 4 * (start + size)])
                        rows.append((docs[lo + k], start, size, crc, len(own), task, place))
                        start += size
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=[c.split()[0] for c in CUT.split(", ")])
                del ids, borders, rows
                pa.default_memory_pool().release_unused()

    return run


def _shift_right(n, by):
    """n // 2 ** by for whole numbers."""
    return F.floor(n / F.pow(F.lit(2.0), by)).cast("bigint")


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row a piece: its document, its place there, its sequence and its place in that."""
    cut = keep(documents.select("doc_id", "text").mapInArrow(_cut(tokenizer_path, capacity), CUT), "packing-pieces")
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    # A row per task and class, whatever the number of documents.
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    counts = keep(counts.select("length", "task", "n", earlier.alias("before")), "packing-counts")
    per_bin = F.floor(F.lit(capacity) / F.col("length")).cast("bigint")
    power = F.bit_count("length") == 1
    classes = counts.groupBy("length").agg(F.sum("n").alias("total")).withColumn("per_bin", per_bin)
    left = F.col("total") % F.col("per_bin")
    bins = F.floor(F.col("total") / F.col("per_bin")).cast("bigint") + F.when(power, F.bit_count(left)).otherwise((left > 0).cast("int"))
    # At most SMALLEST + log2(capacity) rows.
    first = F.sum(bins).over(Window.orderBy("length")) - bins
    classes = classes.select("length", "total", "per_bin", first.cast("bigint").alias("first"))
    begins = counts.drop("n").join(classes, "length")
    number = F.col("before") + F.col("place")
    full = F.floor(F.col("total") / F.col("per_bin")).cast("bigint")
    over = F.greatest(number - full * F.col("per_bin"), F.lit(0))
    left = F.col("total") % F.col("per_bin")
    # Left-over pieces of a power: bins of the powers of two in their count, largest first.
    # The bin of piece `over` is set by the highest bit in which `left` and `over` differ.
    bit = F.length(F.bin(left.bitwiseXOR(over))) - 1
    above = _shift_right(left, bit + 1)
    in_last = F.when(power, F.bit_count(above)).otherwise(F.lit(0))
    last_offset = F.when(power, over - above * F.pow(F.lit(2.0), bit + 1).cast("bigint")).otherwise(over)
    is_full = number < full * F.col("per_bin")
    sequence = F.col("first") + F.when(is_full, F.floor(number / F.col("per_bin")).cast("bigint")).otherwise(full + in_last)
    offset = F.col("length") * F.when(is_full, number % F.col("per_bin")).otherwise(last_offset)
    return cut.join(begins, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", sequence.alias("sequence_id"), offset.cast("bigint").alias("offset")
    )
