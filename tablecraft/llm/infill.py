"""Fill-in-the-middle documents, cut by counts of content-defined chunks that are worked out once."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.textual import octets

#: Bytes that decide whether a chunk ends behind them.
WINDOW = 16
#: A chunk ends where this many bits of the mixed rolling hash are zero: 512 bytes on average.
CHUNK_BITS = 9
#: Longest chunk; longer runs without an end are cut in steps of this many bytes from the last one.
LONGEST = 1 << 13
#: Bytes of chunk content that a task remembers before it starts anew.
REMEMBERED = 1 << 26
#: Bytes hashed at a time, however long a text is.
SEGMENT = 1 << 22

#: The marks of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_GEAR = np.random.default_rng(12).integers(0, 1 << 32, 256, dtype=np.uint32)
_MIX = np.uint32(0x9E3779B1)  # odd, so that the high bits of the product depend on the whole window


def chunk_ends(text: bytes, bits: int = CHUNK_BITS, longest: int = LONGEST) -> list[int]:
    """Ends of the chunks of a text. An end depends on the ``WINDOW`` bytes before it only, so equal passages have equal chunks."""
    found = []
    for at in range(0, len(text), SEGMENT):
        low = max(at - WINDOW, 0)
        rolling = _GEAR[np.frombuffer(text, dtype=np.uint8, count=min(at + SEGMENT, len(text)) - low, offset=low)]
        for step in (1, 2, 4, 8):  # sums over 2, 4, 8 and then 16 bytes, the older ones shifted
            rolling[step:] += rolling[:-step] << np.uint32(step)
        ends = np.flatnonzero(rolling * _MIX >> np.uint32(32 - bits) == 0) + low + 1
        found.extend(ends[ends > max(at, WINDOW - 1)].tolist())
    out, last = [], 0
    for end in [*found, len(text)]:
        while end - last > longest:
            last += longest
            out.append(last)
        if end > last:
            out.append(end)
            last = end
    return out


class Chunk:
    """What a chunk tells about any text that holds it: where units start inside, its code points, and its two borders."""

    __slots__ = ("starts", "points", "opens_blank", "ends_blank")

    def __init__(self, content: bytes):
        values = np.frombuffer(content, dtype=np.uint8)
        blank = _BLANK[values]
        self.starts = np.flatnonzero(blank[1:] > blank[:-1]) + 1  # a unit starts at the blanks behind a word
        self.points = code_points(content)
        self.opens_blank, self.ends_blank = bool(blank[0]), bool(blank[-1])


def code_points(content: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(content, dtype=np.uint8) & 0xC0 != 0x80))


class ChunkMemory:
    """Chunk facts by content. Look-ups compare the whole content, so two chunks of one hash are never confused."""

    def __init__(self, limit: int = REMEMBERED):
        self.known: dict[bytes, Chunk] = {}
        self.held, self.limit = 0, limit

    def chunk(self, content: bytes) -> Chunk:
        found = self.known.get(content)
        if found is None:
            if self.held + len(content) > self.limit:
                self.known, self.held = {}, 0
            found = self.known[content] = Chunk(content)
            self.held += len(content)
        return found


class CutText:
    """A text as chunks with running counts, from which any cut between units is found without reading the rest again."""

    def __init__(self, text: bytes, memory: ChunkMemory):
        self.text, self.ends = text, chunk_ends(text)
        self.chunks, self.before, self.points = [], [], [0]
        units, at, blank = 0, 0, True
        for end in self.ends:
            chunk = memory.chunk(text[at:end])
            self.chunks.append(chunk)
            self.before.append(units)
            # the first unit starts with the text; a border between a word and blanks starts another
            opens = at == 0 or (chunk.opens_blank and not blank)
            units += len(chunk.starts) + opens
            self.points.append(self.points[-1] + chunk.points)
            at, blank = end, chunk.ends_blank
        self.units = units

    def behind(self, units: int) -> tuple[int, int]:
        """Position behind the first ``units`` units: in bytes and in code points."""
        if units == 0:
            return 0, 0
        if units >= self.units:
            return len(self.text), self.points[-1]
        at = bisect_right(self.before, units) - 1
        low, chunk = (self.ends[at - 1] if at else 0), self.chunks[at]
        inside = units - self.before[at]
        total = (self.before[at + 1] if at + 1 < len(self.before) else self.units) - self.before[at]
        starts = chunk.starts if total == len(chunk.starts) else np.r_[0, chunk.starts]
        place = int(starts[inside])
        return low + place, self.points[at] + (code_points(self.text[low:low + place]) if place else 0)


def infill(text: bytes, key: str, memory: ChunkMemory, seed: int, moved: int, suffix_first: int) -> tuple:
    """(units, form, prefix code points, middle code points, output) of one text."""
    cut = CutText(text, memory)
    digest = sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    marked = any(mark.encode() in text for mark in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or h3 % 100 >= moved:
        return cut.units, "plain", None, None, text
    low, high = sorted((h1 % (cut.units + 1), h2 % (cut.units + 1)))
    (a, a_points), (b, b_points) = cut.behind(low), cut.behind(high)
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    first, form = (s + text[b:] + p + text[:a], "spm") if h4 % 100 < suffix_first else (p + text[:a] + s + text[b:], "psm")
    return cut.units, form, a_points, b_points - a_points, first + m + text[a:b]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 42, moved: int = 50,
              suffix_first: int = 80) -> DataFrame:
    """Per row: key, n (units), form, prefix_chars, middle_chars, output (the text, or its three parts with marks).

    A unit is a run of blanks with the word behind it; blanks at the end are one. ``moved`` of 100 texts get a form with
    marks, ``suffix_first`` of 100 of these the suffix before the prefix; the choice and both cuts come from a hash of seed and
    key, so a task that runs again gives the same rows. A missing or empty text is plain and empty; a text with one of the marks
    is plain. A missing key counts as an empty one. Rows are treated one by one: repeated rows repeat, ties cannot occur, other columns do
    not matter, and an empty table gives an empty one. A text is held whole, with some bytes for each chunk of it.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = ChunkMemory()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows = [infill(t.as_py(), k.as_py() or "", memory, seed, moved, suffix_first) for k, t in zip(some.column(1), some.column(2))]
                n, form, prefix, middle, output = (list(c) for c in zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(n, "int64"), pa.array(form, "string"), pa.array(prefix, "int64"), pa.array(middle, "int64"),
                     pa.array(output, "binary").cast("string")], ["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    narrow = docs.select(F.col(key).alias("id"), F.col(key).cast("string").alias("name"), octets(text).alias("text"))
    return narrow.mapInArrow(cut, schema).withColumnRenamed("id", key)


def restored(output: str = "output", form: str = "form") -> Column:
    """The original text from output and form. Parts hold no mark, and no mark can begin in a part and end in a mark."""
    parts = F.split(F.col(output), "<[PSM]>", -1)
    prefix, suffix = F.when(F.col(form) == "psm", parts[1]).otherwise(parts[2]), F.when(F.col(form) == "psm", parts[2]).otherwise(parts[1])
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(prefix, parts[3], suffix))


def digest(docs: DataFrame) -> DataFrame:
    """The cuts of every document, with hashes of the output and of the text rebuilt from it."""
    done = transform(docs)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))


SQL = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents
), numbers AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM units
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix
  FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE WHEN form = 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
