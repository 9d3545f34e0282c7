"""Sampled segmentations into sentence pieces, reproducible by row, and their lossless decoding."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.textual import octets

#: The sign for a blank, and what stands for that sign where the text itself has it (it cannot occur in UTF-8).
BLANK, OWN_SIGN = "▁", "\udc81"
#: Power to which the pieces' probabilities are raised: the lower, the more varied the segmentations.
ALPHA = 0.5
#: Words sampled side by side, and distinct words whose lattices a task remembers.
WORDS, REMEMBERED = 200_000, 150_000
#: Units that are filtered side by side.
UNITS = 50_000
#: Characters below this, and the blank, are looked up in a square of neighbours; all others are searched for.
NEAR = 1_024


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)


class PieceTable:
    """The pieces of a model with a weight each.

    A merge model's scores are ranks, not probabilities; rank r weighs 1 / (r + 10), as words of rank r do in
    prose. Runs of blanks are no pieces here, so a word's lattice ends where its blank begins the next.
    """

    def __init__(self, path: str, alpha: float = ALPHA):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.weights = {p: (i, (10 - model.get_score(i)) ** -alpha) for i, p in enumerate(self.pieces)
                        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) and set(p) != {BLANK} or p == BLANK}
        self.octets = [p.replace(BLANK, " ").encode() for p in self.pieces]
        for byte, i in self.bytes.items():
            self.octets[i] = bytes([byte])
        self.longest = max(map(len, self.weights))
        self.byte_share = len(self.pieces) ** -alpha
        #: Every beginning of a piece: the piece itself if it is one, else nothing.
        self.known = {p[:n]: None for p in self.weights for n in range(1, len(p))} | self.weights
        self._grow()
        pairs = {p[i:i + 2] for p in self.weights for i in range(len(p) - 1)}
        #: Neighbours inside of some piece. Between any others every segmentation has a cut.
        self.pairs = np.array(sorted(ord(a) << 21 | ord(b) for a, b in pairs), dtype=np.int64)
        self.near = np.zeros((NEAR + 1, NEAR + 1), dtype=bool)
        left, right = self._places(self.pairs >> 21), self._places(self.pairs & (1 << 21) - 1)
        self.near[left[(left >= 0) & (right >= 0)], right[(left >= 0) & (right >= 0)]] = True

    @staticmethod
    def _places(chars: np.ndarray) -> np.ndarray:
        """Places in the square of neighbours, below zero for characters outside of it."""
        return np.where(chars == ord(BLANK), NEAR, np.where(chars < NEAR, chars, -1))

    def joined(self, chars: np.ndarray) -> np.ndarray:
        """Whether some piece spans each character and the next."""
        at = self._places(chars)
        left, right = at[:-1], at[1:]
        found = self.near[left, right]
        far = np.flatnonzero((left < 0) | (right < 0))
        keys = chars[far] << 21 | chars[far + 1]
        found[far] = self.pairs[np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)] == keys
        return found

    def _grow(self) -> None:
        """The beginnings as a tree in sorted arrays: a state for each, keyed by the state before and the next character."""
        state = {"": 0} | {p: i + 1 for i, p in enumerate(self.known)}
        keys = np.array([state[p[:-1]] << 21 | ord(p[-1]) for p in self.known], dtype=np.int64)
        order = np.argsort(keys)
        self.steps, self.next_state = keys[order], np.arange(1, len(keys) + 1)[order]
        found = [(0, 0.0), *((-1, 0.0) if v is None else v for v in self.known.values())]
        self.piece_at = np.array([i for i, _ in found], dtype=np.int32)
        self.piece_at[0] = -1
        self.weight_at = np.array([w for _, w in found])

    def spans(self, chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece, weight) of all pieces in a row of characters; ``left``: characters up to each unit's end."""
        at, state, out = np.arange(len(chars)), np.zeros(len(chars), dtype=np.int64), []
        for n in range(self.longest):
            fits = left[at] > n
            at, state = at[fits], state[fits]
            key = state << 21 | chars[at + n]
            where = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            hit = self.steps[where] == key
            at, state = at[hit], self.next_state[where[hit]]
            if not len(at):
                break
            whole = self.piece_at[state] >= 0
            out.append((at[whole], np.full(int(whole.sum()), n + 1), self.piece_at[state[whole]], self.weight_at[state[whole]]))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int32, float))

    def decode(self, ids) -> str:
        """The text of a segmentation: bytes are joined, blanks restored, and the blank before the text dropped."""
        return b"".join(map(self.octets.__getitem__, ids))[1:].decode("utf-8")


class Lattices:
    """Lattices of many words in flat arrays, each filtered forward once.

    A word falls into units wherever no piece spans two neighbours. A node is a place in a unit; its
    incoming edges are pieces that end there, with the probability that a segmentation drawn from the
    weights comes through each. Drawing walks from the end to the beginning: at every node one random
    number picks the edge. A character without a piece is an edge of its bytes.
    """

    def __init__(self, table: PieceTable):
        self.table = table
        #: The number of each word; its units' end nodes lie one after another.
        self.words: dict[str, int] = {}
        self.ends, self.first = np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.units: dict[str, int] = {}
        self.nodes, self.parts, self.more = 0, [], {}
        self.frozen = None

    def learn(self, words: list[str]) -> None:
        """Cut new words, given without the blank before them, into units, and filter the new units."""
        if not words:
            return
        text = BLANK + BLANK.join(words)
        chars = code_points(text)
        begins = chars == ord(BLANK)  # of words, since none has this sign itself
        cuts = np.flatnonzero(np.r_[True, begins[1:] | ~self.table.joined(chars)])
        stops = cuts.tolist() + [len(text)]
        units = [text[i:j] for i, j in zip(stops[:-1], stops[1:])]
        ordered = sorted(dict.fromkeys(u for u in units if u not in self.units), key=len)
        for at in range(0, len(ordered), UNITS):
            self._filter(ordered[at:at + UNITS])
        self.words.update(zip(words, range(len(self.words), len(self.words) + len(words))))
        self.first = np.r_[self.first[:-1], len(self.ends) + np.flatnonzero(begins[cuts]), len(self.ends) + len(units)]
        self.ends = np.r_[self.ends, np.fromiter(map(self.units.__getitem__, units), dtype=np.int64, count=len(units))]

    def units_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """End nodes of the units of words in order, and how many each word has."""
        many = self.first[numbers + 1] - self.first[numbers]
        behind = np.cumsum(many)
        at = np.repeat(self.first[numbers] - behind + many, many) + np.arange(int(behind[-1]) if len(many) else 0)
        return self.ends[at], many

    def _filter(self, units: list[str]) -> None:
        """Forward filtering, all units a place at a time: the weight of all segmentations up to there, and each last piece's share.

        Weights are kept in proportion only: a unit's are divided by their sum as the filter passes, so none gets too small.
        """
        table = self.table
        sizes = np.array([len(u) for u in units])
        ends = np.cumsum(sizes)
        chars = code_points("".join(units))
        left = np.repeat(ends, sizes) - np.arange(len(chars))
        start, length, piece, weight = table.spans(chars, left)
        bare = np.ones(len(chars), dtype=bool)
        bare[start[length == 1]] = False
        alone = np.flatnonzero(bare)
        raw = [tuple(table.bytes[b] for b in (BLANK if chars[i] == ord(OWN_SIGN) else chr(chars[i])).encode()) for i in alone]
        start, length = np.r_[start, alone], np.r_[length, np.ones(len(alone), np.int64)]
        piece = np.r_[piece, np.array([ids[0] if len(ids) == 1 else -self._bytes(ids) for ids in raw], dtype=np.int32)].astype(np.int32)
        weight = np.r_[weight, np.array([table.byte_share ** len(ids) for ids in raw])]
        # a unit of n characters has n + 1 nodes; the node before character i of unit u is i + u
        unit = np.repeat(np.arange(len(units)), sizes)
        before = start + unit[start]
        after = before + length
        order = np.lexsort((before, after))
        before, after, piece, weight = before[order], after[order], piece[order], weight[order]
        place = after - (ends - sizes + np.arange(len(units)))[unit[start[order]]]
        by_place = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[by_place], np.arange(1, int(sizes.max()) + 2))
        total, share = np.zeros(len(chars) + len(units)), np.empty(len(after))
        total[ends - sizes + np.arange(len(units))] = 1.0
        for p in range(len(cuts) - 1):
            some = by_place[cuts[p]:cuts[p + 1]]
            flow = total[before[some]] * weight[some]
            heads = np.flatnonzero(np.r_[True, np.diff(after[some]) != 0])
            sums = np.add.reduceat(flow, heads)
            share[some] = flow / np.repeat(sums, np.diff(np.r_[heads, len(some)]))
            nodes = after[some][heads]
            total[nodes] = sums
            small = sums < 1e-100
            if small.any():  # raise all nodes that later pieces of these units can begin at
                for k in range(int(min(p + 2, table.longest))):
                    total[nodes[small] - k] *= 1e100
        run = np.cumsum(share)
        last = np.r_[np.diff(after) != 0, True]
        heads = np.r_[0, np.flatnonzero(last)[:-1] + 1]
        base = np.repeat(run[heads] - share[heads], np.diff(np.r_[heads, len(after)]))
        rank = self.nodes + after + np.where(last, 1.0, np.clip(run - base, 0.0, 1.0))
        begins = np.zeros(len(total), dtype=bool)
        begins[ends - sizes + np.arange(len(units))] = True
        self.parts.append((rank, self.nodes + before, piece, begins))
        self.units.update(zip(units, (self.nodes + ends + np.arange(len(units))).tolist()))
        self.nodes += len(total)
        self.frozen = None

    def _bytes(self, ids: tuple) -> int:
        return self.more.setdefault(ids, len(self.more) + 1)

    def draw(self, ends: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward sampling from each end node to its unit's begin: the ids of all units in order, and how many each has.

        Units are walked in the order of their nodes, so that neighbours look up edges that lie side by side.
        """
        if not len(ends):
            return np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int64)
        if self.frozen is None:
            wide = [(), *self.more]
            table = np.full((len(wide), 4), -1, dtype=np.int32)
            for i, ids in enumerate(wide):
                table[i, :len(ids)] = ids
            merged = [np.concatenate(c) for c in zip(*self.parts)]
            self.parts = [tuple(merged)]
            self.frozen = (*merged[:3], table, merged[3])
        rank, before, piece, wide, begins = self.frozen
        order = np.argsort(ends, kind="stable")
        live, node, seeds, steps = np.arange(len(ends)), ends[order], seeds[order], []
        count, step = np.zeros(len(ends), dtype=np.int64), 0
        while len(live):
            edge = np.searchsorted(rank, node[live] + uniform(seeds[live], step), side="right")
            ids = piece[edge]
            taken = np.where(ids < 0, (wide[np.maximum(-ids, 0)] >= 0).sum(axis=1), 1)
            count[live] += taken
            steps.append((live, ids, count[live]))
            node[live] = before[edge]
            live = live[~begins[node[live]]]
            step += 1
        sizes = np.empty_like(count)
        sizes[order] = count
        stops = np.cumsum(sizes)
        out = np.empty(int(stops[-1]) if len(stops) else 0, dtype=np.int32)
        stops = stops[order]
        for where, ids, behind in steps:
            at, single = stops[where] - behind, ids >= 0
            out[at[single]] = ids[single]
            for k in range(4):
                some = ~single & (wide[np.maximum(-ids, 0), k] >= 0)
                out[at[some] + k] = wide[-ids[some], k]
        return out, sizes


def uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on seed and step alone."""
    x = seeds + np.uint64((step + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) / 2.0**52


class Sampler:
    """Segmentations of whole texts; a text's draw depends on its seed, not on the texts beside it."""

    def __init__(self, path: str, alpha: float = ALPHA):
        self.table = PieceTable(path, alpha)
        self.lattices = Lattices(self.table)

    def encode(self, texts: list[bytes], seeds: list[int]) -> Iterator[np.ndarray]:
        """The ids of each text; it begins with a blank that decoding drops."""
        block, words = [], 0
        for i, (text, seed) in enumerate(zip(texts, seeds)):
            parts = text.decode("utf-8", "replace").replace(BLANK, OWN_SIGN).split(" ") if text else []
            block.append((parts, seed))
            words += len(parts)
            if words >= WORDS or i + 1 == len(texts):
                yield from self._block(block)
                block, words = [], 0

    def _block(self, block: list[tuple[list[str], int]]) -> Iterator[np.ndarray]:
        if len(self.lattices.words) > REMEMBERED:
            self.lattices = Lattices(self.table)
        known = self.lattices.words
        self.lattices.learn([w for w in dict.fromkeys(chain.from_iterable(parts for parts, _ in block)) if w not in known])
        words = [len(parts) for parts, _ in block]
        numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(parts for parts, _ in block)), dtype=np.int64, count=sum(words))
        ends, many = self.lattices.units_of(numbers)
        sizes = np.diff(np.r_[0, np.cumsum(many)][np.r_[0, np.cumsum(words)]])
        place = np.arange(len(ends)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        seeds = np.repeat(np.array([s % (1 << 64) for _, s in block], dtype=np.uint64), sizes) ^ (place.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        ids, count = self.lattices.draw(ends, seeds)
        cuts = np.r_[0, np.cumsum(count)][np.cumsum(sizes)]
        yield from np.split(ids, cuts[:-1])


def _seed(key: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key).cast("string"))


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 1, alpha: float = ALPHA) -> DataFrame:
    """Per row: key, ids: a segmentation drawn from all that the text has, seeded by the row's key.

    A missing or empty text has no ids. Rows with equal key and text draw alike, wherever they are; rows without
    key share a seed. Decoding gives back every text byte by byte: what has no piece is kept as bytes.
    """

    @F.pandas_udf("array<int>")
    def sampled(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        sampler = Sampler(model, alpha)
        for texts, seeds in batches:
            yield pd.Series(list(sampler.encode(texts.tolist(), seeds.tolist())), dtype=object)

    return docs.select(F.col(key), sampled(octets(text), _seed(key, seed)).alias("ids"))


def decode(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: key, text. Missing ids give an empty text."""

    @F.pandas_udf("string")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = PieceTable(model)
        for batch in batches:
            yield batch.map(lambda x: "" if x is None else table.decode(x))

    return encoded.select(F.col(key), joined(F.col(ids)).alias("text"))


def digest(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", seed: int = 1, alpha: float = ALPHA) -> DataFrame:
    """Per row: key, n_pieces, ids_crc32 (of little-endian 32-bit ids), lossless (decoding gives the text back)."""
    kind = docs.schema[key].dataType.simpleString()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(model, alpha)
        for batch in batches:
            texts, n, crc, same = [v.as_py() for v in batch.column(1)], [], [], []
            for whole, ids in zip(texts, sampler.encode(texts, batch.column(2).to_pylist())):
                n.append(len(ids))
                crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                same.append(sampler.table.decode(ids.tolist()).encode() == whole)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, "int64"), pa.array(crc, "int64"), pa.array(same, "bool")], ["key", "n", "crc", "same"])

    found = docs.select(F.col(key).alias("key"), octets(text), _seed(key, seed)).mapInArrow(summed, f"key {kind}, n long, crc long, same boolean")
    return found.select(F.col("key").alias(key), F.col("n").alias("n_pieces"), F.col("crc").alias("ids_crc32"), F.col("same").alias("lossless"))
