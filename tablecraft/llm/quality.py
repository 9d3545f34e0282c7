"""Quality rules on documents and on their hosts, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.textual import BLANKS, whole
from tablecraft.plans.lineage import materialize

#: Fixed value: the characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
#: Fixed value: what separates words, as characters.
BLANK_CHARS = " \t\n\x0b\x0c\r"
WINDOW = 5
#: Bytes of host names up to which the rejected hosts are broadcast; beyond, the join is shuffled.
BROADCAST_BYTES = 8_000_000
RULES = ("short", "repeats", "symbols", "lines", "lengths")


def let(value: Column, use) -> Column:
    """``use`` applied to a value that is computed once, however often the expression names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeats(words: Column, n: Column) -> Column:
    """Words inside windows that occur twice or more.

    A window is compared by its 64-bit hash, and only with windows of the same text. Where any
    hash recurs, the hashes are sorted beside their places, so that equal ones are neighbours.
    """
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def covered(s: Column) -> Column:
        twin = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
        found = F.transform(F.filter(s, twin), lambda x: x["i"])
        return let(F.sort_array(found), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda a, b: a + b))

    placed = lambda h: F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    return F.when(n < WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), let(placed(h), covered)).otherwise(F.lit(0).cast("long"))))


def measures(text: str) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a whole text, in one struct.

    A missing text counts as empty: all are zero. Words are runs without the six ASCII blanks.
    Lines are cut at newlines; only those with a word count.
    """
    whole_text = whole(text)
    trimmed = F.btrim(whole_text, F.lit(BLANK_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS, -1))
    lines = F.filter(F.split(whole_text, "\n", -1), lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != "")

    def of(w: Column) -> Column:
        n = F.size(w)
        return let(lines, lambda x: F.struct(
            n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole_text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeats(w, n).alias("n_repeat_words"), F.size(x).cast("long").alias("n_lines")))

    return let(words, of)


def failures(m) -> dict[str, Column]:
    """The rules on one document, from its measures: the first two reject it, the rest speak about its host.

    ``m`` gives a measure's column by name.
    """
    return {
        "short": m("n_words") < 10,
        "repeats": 100 * m("n_repeat_words") > 20 * m("n_words"),
        "symbols": 10 * m("n_symbols") > m("n_words"),
        "lines": 100 * m("n_dup_lines") > 30 * m("n_lines"),
        "lengths": (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 12 * m("n_words")),
    }


def host_rates(judged: DataFrame, host: str = "host") -> DataFrame:
    """(host, n, rate_<rule> ...): the share of a host's documents that fail a rule, shrunk by a beta prior.

    The prior of a rule is fitted to all hosts by moments: its mean is the overall rate, and its
    strength follows from how much more the hosts differ than chance alone explains. A host with few
    documents stays near the mean. Documents without host form one host of their own.
    """
    counted = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    counted = materialize(counted)
    sums = counted.agg(F.count("*").alias("hosts"), F.sum("n").alias("n"), *[F.sum(r).alias(r) for r in RULES],
                       *[F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"{r}_sq") for r in RULES]).first()
    rates = []
    for r in RULES:
        a, b = beta_prior(sums["hosts"], sums["n"] or 0, sums[r] or 0, sums[f"{r}_sq"] or 0.0)
        rates.append(((F.col(r) + a) / (F.col("n") + a + b)).alias(f"rate_{r}"))
    return counted.select("host", "n", *rates)


def beta_prior(hosts: int, n: int, failed: int, squares: float) -> tuple[float, float]:
    """Beta parameters from the hosts' totals; squares is the sum of failed * failed / n over the hosts.

    Without any document, or if all or none fail, it is the flat prior. Its strength lies between 1 and 1,000.
    """
    if not n or not 0 < failed < n:
        return 1.0, 1.0
    mean = failed / n
    spread = squares / n - mean * mean - mean * (1 - mean) * hosts / n
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1000.0) if spread > 0 else 1000.0
    return mean * strength, (1 - mean) * strength


def _bad(limit: float) -> Column:
    return F.greatest(*[F.col(f"rate_{r}") for r in RULES]) > limit


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", limit: float = 0.5) -> DataFrame:
    """Per row: key, host, the measures, base_failed, host_rate (the worst shrunk rate of its host), kept.

    base_failed: under ten words, or over 20 % of the words in repeated five-word windows. A host is
    rejected if the shrunk rate of any rule exceeds the limit; then none of its documents is kept.
    Missing texts are empty and fail; a missing host is a host; repeated rows are judged one by one.
    """
    m = lambda name: F.col("m")[name]
    judged = docs.select(F.col(key).alias("id"), F.col(host).alias("host"), measures(text).alias("m"))
    judged = materialize(judged.select("id", "host", "m.*"))
    flags = failures(F.col)
    marked = judged.select("*", *[c.alias(r) for r, c in flags.items()])
    rates = host_rates(marked).select(F.col("host").alias("judged_host"), "n", _bad(limit).alias("bad"),
                                      F.greatest(*[F.col(f"rate_{r}") for r in RULES]).alias("host_rate"))
    both = marked.join(rates.drop("n"), marked.host.eqNullSafe(rates.judged_host))
    return both.select(
        F.col("id").alias(key), "host", *judged.columns[2:], (F.col("short") | F.col("repeats")).alias("base_failed"),
        "host_rate", (~(F.col("short") | F.col("repeats") | F.col("bad"))).alias("kept"))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source", limit: float = 0.5) -> DataFrame:
    """The documents that ``judge`` keeps, whole and with all their columns.

    Texts are measured twice instead of being written: once for the hosts' rates, once for each
    document. The rejected hosts are broadcast if their names are few; else the join is shuffled.
    """
    m = lambda name: F.col("m")[name]
    flags = failures(m)
    rates = host_rates(docs.select(F.col(host).alias("host"), measures(text).alias("m"))
                       .select("host", *[c.alias(r) for r, c in flags.items()]))
    bad = materialize(rates.where(_bad(limit)).select(F.struct(F.col("host").alias("name")).alias("bad_host")))
    wide = bad.agg(F.sum(F.coalesce(F.octet_length("bad_host.name"), F.lit(0)) + 40)).first()[0] or 0
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), measures(text).alias("m"),
                       F.struct(F.col(host).alias("name")).alias("own_host"))
    good = rows.where(~(flags["short"] | flags["repeats"]))
    if wide:
        good = good.join(F.broadcast(bad) if wide <= BROADCAST_BYTES else bad,
                         F.col("own_host").eqNullSafe(F.col("bad_host")), "left_anti")
    return good.select("row.*")


SQL = r"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, string_split(t, chr(10)) as s from d),
l as (select r, unnest(s) as line from w),
dup as (select r, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from l
        where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
g as (select r, i, w[i:i + 4] as g from (select r, w, unnest(range(1, len(w) - 3)) as i from w)),
twice as (select r, g from g group by r, g having count(*) > 1),
cover as (select r, count(distinct p) as n_repeat_words
          from (select g.r, unnest(range(g.i, g.i + 5)) as p from g join twice using (r, g)) group by r),
m as (select r, doc_id, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
             coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines
      from w left join dup using (r) left join cover using (r)),
f as (select *, n_words < 10 as short, 100 * n_repeat_words > 20 * n_words as repeats, 10 * n_symbols > n_words as symbols,
             100 * n_dup_lines > 30 * n_lines as lines, word_chars < 2 * n_words or word_chars > 12 * n_words as lengths from m),
u as (unpivot (select source, short::int as short, repeats::int as repeats, symbols::int as symbols, lines::int as lines,
                      lengths::int as lengths from f) on short, repeats, symbols, lines, lengths into name rule value failed),
c as (select source, rule, count(*) as n, sum(failed) as failed from u group by all),
p as (select rule, count(*) as hosts, sum(n) as n, sum(failed) as failed, sum(failed * failed / n) as sq from c group by rule),
q as (select rule, failed / n as mean, sq / n - (failed / n) * (failed / n) - (failed / n) * (1 - failed / n) * hosts / n as spread,
             failed > 0 and failed < n as mixed from p),
s as (select rule, mean, mixed, case when spread > 0 then least(greatest(mean * (1 - mean) / spread - 1, 1), 1000) else 1000 end as s from q),
h as (select source, max((failed + case when mixed then mean * s else 1 end) / (n + case when mixed then s else 2 end)) > 0.5 as bad
      from c join s using (rule) group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short or repeats as base_failed,
       not (short or repeats or bad) as kept
from f join h on f.source is not distinct from h.source
"""
