"""Fill-in-the-middle texts against a plain regular expression."""

import random
import re
from hashlib import sha256

from tablecraft.llm.infill import ChunkMemory, CutText, chunk_ends, infill, restored, transform

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, output string, n string, id int, name map<string,int>, `a.b` int"


def texts(seed=4):
    pick = random.Random(seed)
    alphabet = [" ", "\n", "\t", "\x0b", "\x1c", " ", "a", "bc", "é", "漢", "🙂", "<", ">", "P", "é"]
    shared = "".join(pick.choices(alphabet, k=6000))
    out = [None, "", " ", "a", " a", "a ", " \n ", "a b ", "x <P> y", "<S>", "<M", "no blanks" * 4000, " " * 20_000, "é" * 9_000]
    for n in (3, 20, 200, 5_000, 40_000):
        for _ in range(12):
            text = "".join(pick.choices(alphabet, k=n))
            at = pick.randrange(len(text) + 1)
            out.append(text[:at] + shared + text[at:] if n > 100 else text)
    return out


def plain(key, text):
    text = text or ""
    units, h = UNIT.findall(text), sha256(f"42:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h4 % 100 < 80 else "psm"
    return len(units), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_every_cut_equals_the_regular_expression():
    memory = ChunkMemory(1 << 14)  # small, so that it is emptied on the way
    for text in texts():
        text = (text or "")[:12_000]
        units, cut = UNIT.findall(text), CutText(text.encode(), memory)
        assert cut.units == len(units)
        for k in range(0, len(units) + 1, max(1, len(units) // 300)):
            before = "".join(units[:k])
            assert cut.behind(k) == (len(before.encode()), len(before))


def test_shared_passages_share_chunks_and_no_chunk_is_long():
    pick = random.Random(1)
    shared = bytes(pick.choices(b"abcdef ghij", k=60_000))
    one, two = b"x" * 777 + shared, b"other " * 50 + shared + b" end"
    contents = [{t[a:b] for a, b in zip([0, *chunk_ends(t)], chunk_ends(t))} for t in (one, two)]
    assert sum(map(len, contents[0] & contents[1])) > 0.95 * len(shared)
    for text in (one, b"a" * 100_000, b""):
        ends = chunk_ends(text)
        assert b"".join(text[a:b] for a, b in zip([0, *ends], ends)) == text
        assert all(0 < b - a <= 1 << 13 for a, b in zip([0, *ends], ends))
    memory = ChunkMemory()
    infill(one, "1", memory, 42, 50, 80)
    known = len(memory.known)
    infill(one, "2", memory, 42, 50, 80)
    assert len(memory.known) == known


def test_ends_do_not_depend_on_the_segments_hashed_at_a_time(monkeypatch):
    text = bytes(random.Random(2).choices(range(256), k=50_000))
    whole = chunk_ends(text)
    for size in (17, 1000, 4099):
        monkeypatch.setattr("tablecraft.llm.infill.SEGMENT", size)
        assert chunk_ends(text) == whole


def test_rows_equal_the_definition_and_restore(spark):
    rows = [(i, t, "clash", "x", 1, {"a": 1}, 2) for i, t in enumerate(texts())]
    rows += [(3, "a b c d e f", None, None, None, None, None)] * 2 + [(None, "one two three", "", "", 0, {}, 0)]
    done = transform(spark.createDataFrame(rows, SCHEMA)).withColumn("back", restored())
    assert done.columns[:6] == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in done.collect()), key=repr)
    want = sorted(((k, *plain("" if k is None else k, t), t or "") for k, t, *_ in rows), key=repr)
    assert got == want
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_empty_table(spark):
    assert transform(spark.createDataFrame([], SCHEMA)).count() == 0
