"""Personal data against brute force in Python."""

import hashlib
import math
import random
import re

from tablecraft.llm.pii import CONTEXT, GENERALISE, KINDS, SUPPORT, base_spans, digest, redact

from pyspark.sql import functions as F

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = [int(c) for c in value if c.isdigit() and c.isascii()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end(), m.group()) for k in KINDS for m in re.finditer(PLAIN[k], text or "") if good(k, m.group())]


def texts():
    pick = random.Random(4)
    pieces = ["a@b.c", "a@b.c_x@d.e", "x+y%z@q-r.co.uk.", "@", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.255", "000256.1.1.1", "1.2.3",
              "4111 1111 1111 1111", "4111-1111-1111-1111 4", "4111111111111111", "5500 0000 0000 0004", "+1 (555) 123-4567", "+49 30 ", "+1",
              "+12345678901234567", "é", "😀", "\n", " ", "word", "1", "-", ".", "1 2 3 4", "++1 23-45678", "a.b@c", "..@a.b", "٣٤"]
    out = [None, "", " "] + pieces
    out += ["".join(pick.choices(pieces, k=pick.randint(2, 9))) for _ in range(300)]
    out += [" ".join(pick.choices(pieces, k=40)) for _ in range(40)]
    return out


def test_base_spans_equal_the_plain_patterns(spark):
    rows = spark.createDataFrame(list(enumerate(texts())), "id long, t string")
    found = rows.select("id", base_spans(F.coalesce("t", F.lit(""))).alias("s")).collect()
    for r in found:
        assert [tuple(s) for s in r.s] == plain(texts()[r.id]), texts()[r.id]


def test_very_long_runs_do_not_cost_squares(spark):
    long = ["a" * 300_000, "1" * 300_000, "1 " * 150_000, "+1" + "(" * 300_000, "1." * 150_000, "a@" + "b." * 100_000 + "c", "a b " * 100_000]
    found = spark.createDataFrame([(t,) for t in long], "t string").select(base_spans(F.col("t")).alias("s")).collect()
    assert [len(r.s) for r in found][:4] == [0, 0, 0, 0] and len(found[5].s) == 1


def company():
    """Three documents name Zorro beside one address; the rest of the words are common."""
    common = ["the plain word is here"] * 40
    near = [f"the plain word zorro writes to z@z.org from here {i}" for i in range(3)]
    far = ["zorro " + "the " * 60 + "z@z.org"]
    return common + near + far + [None, "", "mail to q@q.org once"]


def want_terms(docs):
    word = re.compile(r"[^\W\d_](?:[^\W\d_]|['-])*")
    whole = [t or "" for t in docs]
    total = len(whole)
    with_term, met = {}, []
    for t in whole:
        for w in {m.group().lower() for m in word.finditer(t)}:
            with_term[w] = with_term.get(w, 0) + 1
    for i, t in enumerate(whole):
        spans = plain(t)
        for k, s, e, v in spans:
            for m in word.finditer(t):
                inside = max(0, s - CONTEXT) <= m.start() and m.end() <= s or e <= m.start() and m.end() <= min(len(t), e + CONTEXT)
                if inside and not any(m.start() < b and m.end() > a for _, a, b, _ in spans):
                    met.append((i, f"{k}:{v.lower()}", m.group().lower(), m.start(), m.end()))
    out = {}
    for i, c, w, a, b in met:
        n_c, n_b = len({r for r, x, *_ in met if x == c}), len({r for r, x, y, *_ in met if (x, y) == (c, w)})
        if n_b >= SUPPORT and n_c >= SUPPORT and math.log2(n_b * total / (n_c * with_term[w])) / math.log2(total / n_c) > GENERALISE:
            out.setdefault(i, set()).add((a, b))
    return out


def test_digest_equals_brute_force_with_terms(spark):
    docs = company()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, base string")
    terms = want_terms(docs)
    assert terms
    for r in digest(df).collect():
        base = [f"{k}:{s}:{e}" for k, s, e, _ in plain(docs[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r.n_email == len(base)
        assert r.spans == ",".join(base + [f"term:{a}:{b}" for a, b in sorted(terms.get(r.doc_id, ()))])


def test_redact_keeps_columns_and_clean_rows(spark):
    docs = company()
    rows = [(i, t, len(t or ""), "x") for i, t in enumerate(docs)] + [(None, "call +1 555 123 4567 or 4111 1111 1111 1111", 5, None)] * 2
    out = redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long, row string"))
    assert out.columns == ["doc_id", "text", "n_chars", "row"]
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[0].text == docs[0] and by[44].text is None and by[46].text == "mail to [EMAIL] once"
    assert by[40].text == "the plain word z…  t… [EMAIL]  here 0" and by[40].n_chars == len(by[40].text)
    assert by[43].text == docs[43].replace("z@z.org", "[EMAIL]")
    assert [r.text for r in got if r.doc_id is None] == ["call [PHONE] or [CARD]"] * 2


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert digest(none).count() == 0 and redact(none).count() == 0
