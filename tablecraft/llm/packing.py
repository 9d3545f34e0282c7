"""Documents as tokens in as few fixed-length sequences as best fit finds, by partitions and then up a tree."""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.textual import octets
from tablecraft.plans.lineage import materialize

#: Token that ends every document.
END = 0
#: Distinct runs of characters whose tokens a task remembers.
REMEMBERED = 500_000
#: Fixed value: marks behind a word that are cut off; none begins a contraction or a special token.
MARKS = b".,;:!?)#$%&*"
#: Documents whose tokens a task holds at a time.
DOCS_AT_ONCE = 256
#: A best-fit run takes two to this power of items at most in the first round, and half as many on average later.
GROUP_BITS = 15
#: A bin with at most this many free places counts as nearly full.
SLACK = 8


class ChunkTokenizer:
    """Tokens of whole texts, worked out once for each run of characters between ASCII blanks.

    The tokenizer drops white space and never joins characters across it, so a text's tokens are
    those of its runs in order. It also cuts letters from marks, so a run of letters with marks behind it is
    one word and one run of marks; plain lower-case words then go to its merge model directly, and
    all else through the whole tokenizer. Words recur; a bounded memory saves encoding them again.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives a task one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.runs: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def encode(self, text: bytes) -> bytes:
        """The tokens as little-endian unsigned 32-bit numbers."""
        runs = text.split()
        new = {r for r in runs if r not in self.runs}
        if len(self.runs) + len(new) > REMEMBERED:
            self.runs, self.parts, new = {}, {}, set(runs)
        if new:
            self._learn(new)
        return b"".join(map(self.runs.__getitem__, runs))

    def _learn(self, runs: set[bytes]) -> None:
        cut = {r: _word_and_marks(r) for r in runs}
        missing = {p for pair in cut.values() for p in pair if p not in self.parts}
        plain = {p for p in missing if p.isascii() and p.isalpha() and p.islower()}
        model, rest = self.tokenizer.model, list(missing - plain)
        for p in plain:
            self.parts[p] = np.array([t.id for t in model.tokenize(p.decode())], dtype="<u4").tobytes()
        for at in range(0, len(rest), 4096):
            some = rest[at:at + 4096]
            encoded = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in some], add_special_tokens=False)
            self.parts.update(zip(some, (np.array(e.ids, dtype="<u4").tobytes() for e in encoded)))
        for r, pair in cut.items():
            self.runs[r] = b"".join(self.parts[p] for p in pair)


def _word_and_marks(run: bytes) -> tuple[bytes, ...]:
    """A run of letters with ASCII marks behind it as two parts, plain letters in lower case; any other run whole."""
    word = run.rstrip(MARKS)
    if not _only_letters(word.decode("utf-8", "replace")):
        return (run,)
    word, marks = word.lower() if word.isascii() else word, run[len(word):]
    return (word, marks) if marks else (word,)


def _only_letters(word: str) -> bool:
    """True if the word has letters only, also as the tokenizer sees it: composed, then lower-cased letter by letter.

    Both can make a letter end in a combining mark, which the tokenizer joins with the marks behind it.
    """
    return word.isalpha() and (word.isascii() or "".join(map(str.lower, unicodedata.normalize("NFC", word))).isalpha())


def pieces(docs: DataFrame, tokenizer: str, size: int, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32 [, ids]): each document's tokens and its end, cut only beyond ``size``.

    A missing or empty text is the end token alone. With ``ids`` the tokens themselves are given as
    little-endian unsigned 32-bit numbers. Rows are treated one by one, so repeated rows repeat.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids binary" if ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunked, end = ChunkTokenizer(tokenizer), np.array([END], dtype="<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                some, rows = batch.slice(at, DOCS_AT_ONCE), []
                for i, text_value in enumerate(some.column(1)):
                    tokens = chunked.encode(text_value.as_py()) + end
                    for n, p in enumerate(range(0, len(tokens), 4 * size)):
                        part = tokens[p:p + 4 * size]
                        rows.append((i, n, p // 4, len(part) // 4, zlib.crc32(part), part))
                of, piece, start, length, crc, part = (list(c) for c in zip(*rows))
                columns = [some.column(0).take(pa.array(of)), pa.array(piece, "int32"), *(pa.array(c, "int64") for c in (start, length, crc))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(part, "binary")] * ids,
                                                 ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids)

    return docs.select(F.col(key).alias("id"), octets(text).alias("text")).mapInArrow(cut, schema).withColumnRenamed("id", key)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, each into the fullest bin that still has room.

    Bins are kept by their free places, and a bit for each number of free places that occurs finds the
    fullest fitting bin at once, so an item costs the same however many bins are open.
    """
    bins, offsets = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    free, open_bits, made = [[] for _ in range(size + 1)], 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fitting = open_bits >> length
        if fitting:
            room = length + ((fitting & -fitting).bit_length() - 1)
            at = free[room].pop()
            if not free[room]:
                open_bits &= ~(1 << room)
        else:
            room, at, made = size, made, made + 1
        bins[i], offsets[i] = at, size - room
        free[room - length].append(at)
        open_bits |= 1 << (room - length)
    return bins, offsets


def _round(items: DataFrame, size: int) -> DataFrame:
    """(item, bin, offset, fill) for (grp, item, length): best fit inside each group of a partition.

    A bin is named after the item that it was opened for, so names stay unique from round to round
    and a task that runs again names its bins alike.
    """

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _groups(batches):
            item, length = rows["item"].to_numpy(), rows["length"].to_numpy()
            bins, offsets = best_fit(length, size)
            name, fill = np.empty(bins.max() + 1, dtype=np.int64), np.zeros(bins.max() + 1, dtype=np.int64)
            name[bins[offsets == 0]] = item[offsets == 0]
            np.add.at(fill, bins, length)
            yield pd.DataFrame({"item": item, "bin": name[bins], "offset": offsets, "fill": fill[bins]})

    return items.sortWithinPartitions("grp", "item").mapInPandas(fit, "item bigint, bin bigint, offset bigint, fill bigint")


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sorted rows of a partition, a frame for each group."""
    held = None
    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        cuts = np.flatnonzero(np.diff(rows["grp"].to_numpy())) + 1
        for a, b in zip(np.r_[0, cuts], cuts):
            yield rows.iloc[a:b]
        held = rows.iloc[(cuts[-1] if len(cuts) else 0):]
    if held is not None and len(held):
        yield held


def pack(cut: DataFrame, size: int, bits: int = GROUP_BITS, slack: int = SLACK) -> DataFrame:
    """The pieces with sequence_id and offset: few sequences of at most ``size`` tokens, without gaps.

    First every partition packs its own pieces. Bins that are nearly full are done. The others become
    items of the next round, as wholes, in groups that each take in bins of many partitions; there
    are fewer groups from round to round, until one is left or a round joins hardly any bins (no two of
    which fit together then). The number of items in a group is bounded, and pieces themselves are not
    moved after the first round: a last join tells each where its bin has gone. An empty table stays empty.
    """
    cut = materialize(cut).withColumn("item", F.monotonically_increasing_id())
    placed = materialize(_round(cut.select(F.shiftright("item", bits).alias("grp"), "item", "length"), size))
    loose = placed.where(F.col("fill") < size - slack).groupBy("bin").agg(F.first("fill").alias("length"))
    moved = materialize(loose.select("bin", F.col("bin").alias("last"), F.lit(0).cast("long").alias("shift"), "length"))
    count, level, groups = moved.count(), 0, 2
    while count > 1 and groups > 1:
        groups, level = max(1, -(-count >> (bits - 1))), level + 1
        items = moved.where("shift = 0 and bin = last").select(
            F.pmod(F.xxhash64("last", F.lit(level)), F.lit(groups)).alias("grp"), F.col("last").alias("item"), "length")
        joined = _round(items.repartition(groups, "grp"), size).withColumnRenamed("bin", "into")
        moved = materialize(moved.join(joined, moved.last == joined.item).select(
            "bin", F.col("into").alias("last"), (F.col("shift") + F.col("offset")).alias("shift"), F.col("fill").alias("length")))
        after = moved.where("shift = 0 and bin = last").count()
        if after > 0.98 * count:
            break
        count = after
    gone = moved.select("bin", "last", "shift")
    where = placed.select("item", "bin", "offset").join(gone, "bin", "left")
    return cut.join(where.select("item", F.coalesce("last", "bin").alias("sequence_id"),
                                 (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset")), "item").drop("item")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, key: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """All documents as pieces in sequences: key, piece, start, length, ids_crc32 [, ids], sequence_id, offset."""
    return pack(pieces(docs, tokenizer, size, key, text, ids), size)
