"""Address rules as wildcard patterns, all of them followed at once by one bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.textual import whole

#: Addresses followed side by side.
SIDE_BY_SIDE = 4096


@dataclass(frozen=True)
class Rule:
    """A verdict for the addresses of a host and its subdomains whose path begins with ``path``.

    Or, with ``glob``, for the canonical addresses that the pattern matches as a whole: ``*`` is any
    run of bytes, within the host if it stands before the pattern's first slash; ``?`` is any one byte.
    """

    verdict: str
    host: str = ""
    path: str = ""
    glob: str = ""

    @property
    def name(self) -> str:
        return self.glob or self.host + self.path

    @property
    def pattern(self) -> bytes:
        """Over the canonical address, which is a dot, the host and the path."""
        return (self.glob or f"*.{_plain(self.host)}{_plain(self.path)}*").encode()


def _plain(text: str) -> str:
    """The text with its own wildcards and escapes escaped."""
    return "".join("\\" + c if c in "*?\\" else c for c in text)


class Automaton:
    """Shift-And over many patterns: a bit for each place in each pattern, packed into 64-bit words.

    A pattern's first bit stands for nothing read yet; the bit after it for its first symbol, and so
    on. Reading a byte moves every bit one place on if the next symbol takes that byte, and keeps it
    where a star follows that takes it. Two table rows for the byte do this for all patterns at once.
    """

    def __init__(self, patterns: list[bytes]):
        places = [_symbols(p) for p in patterns]
        total = sum(len(s) + 1 for s, _ in places)
        words = max(1, -(-total // 64))
        self.step = np.zeros((256, words), dtype=np.uint64)
        self.stay = np.zeros((256, words), dtype=np.uint64)
        self.start = np.zeros(words, dtype=np.uint64)
        self.ends = np.zeros(len(patterns), dtype=np.int64)
        at = 0
        for k, (symbols, stars) in enumerate(places):
            self.start[at // 64] |= np.uint64(1 << at % 64)
            for i in range(len(symbols) + 1):
                word, bit = (at + i) // 64, np.uint64(1 << (at + i) % 64)
                if i and symbols[i - 1] is None:
                    self.step[:, word] |= bit
                elif i:
                    self.step[symbols[i - 1], word] |= bit
                if i in stars:
                    self.stay[:, word] |= bit
                    if stars[i] == "host":
                        self.stay[ord("/"), word] &= ~bit
            at += len(symbols) + 1
            self.ends[k] = at - 1

    def matches(self, addresses: list[bytes]) -> np.ndarray:
        """For each address and pattern whether the pattern matches the whole address."""
        out = np.zeros((len(addresses), len(self.ends)), dtype=bool)
        order = np.argsort([-len(a) for a in addresses], kind="stable")
        for i in range(0, len(order), SIDE_BY_SIDE):
            some = order[i:i + SIDE_BY_SIDE]
            out[some] = self._run([addresses[k] for k in some])
        return out

    def _run(self, addresses: list[bytes]) -> np.ndarray:
        """The addresses come longest first, so those still being read are the first ones."""
        sizes = np.array([len(a) for a in addresses])
        text = np.frombuffer(b"".join(addresses), dtype=np.uint8)
        begins = np.cumsum(sizes) - sizes
        state = np.tile(self.start, (len(addresses), 1))
        for t in range(int(sizes.max(initial=0))):
            live = int(np.searchsorted(-sizes, -t, side="left"))
            now, byte = state[:live], text[begins[:live] + t]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:live] = (moved & self.step[byte]) | (now & self.stay[byte])
        return (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & np.uint64(1) == 1


def _symbols(pattern: bytes) -> tuple[list[int | None], dict[int, str]]:
    """The pattern's symbols (None: any byte), and before which of them a star stands, and whether it stays in the host."""
    symbols, stars, part, i = [], {}, "host", 0
    while i < len(pattern):
        c = pattern[i]
        if c == ord("\\") and i + 1 < len(pattern):
            i += 1
            symbols.append(pattern[i])
        elif c == ord("*"):
            stars[len(symbols)] = "any" if stars.get(len(symbols)) == "any" else part
        else:
            symbols.append(None if c == ord("?") else c)
        if c == ord("/"):
            part = "any"
        i += 1
    return symbols, stars


def host_and_path(url: str) -> tuple[Column, Column]:
    """Both empty if the address is missing or has no ``://``; only A to Z are lower-cased."""
    text = whole(url)
    found = F.locate("://", text)
    rest = F.regexp_extract(F.substring(text, found + 3, F.length(text)), r"(?s)\A([^?#]*)", 1)
    host = F.regexp_extract(rest, r"(?s)\A([^/]*)", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(found > 0, lower).otherwise(""), F.when(found > 0, path).otherwise("")


def judge_urls(pages: DataFrame, rules: list[Rule], otherwise: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: key, host, path, rule, verdict.

    Of the rules that fit, those for a host come before globs, then the longest name wins, then the
    first in the alphabet. Without any, the rule is null and the verdict ``otherwise``; a glob is the method's own
    opinion, so it gives the verdict but no rule. A missing address, or one without ``://``, is empty and fits
    globs only if they match the lone dot. Repeated rows are judged one by one.
    """
    ranked = sorted(rules, key=lambda r: (bool(r.glob), -len(r.name), r.name))
    automaton = Automaton([r.pattern for r in ranked])
    last = len(ranked)

    @F.pandas_udf("int")
    def first_fit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            fits = automaton.matches(batch.tolist())
            yield pd.Series(np.where(fits.any(axis=1), fits.argmax(axis=1), last) if last else np.zeros(len(batch)), dtype="int32")

    host, path = host_and_path(url)
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    fit = parts.withColumn("fit", first_fit(F.concat(F.lit("."), F.col("host"), F.col("path")).cast("binary")))
    names = F.array(*[F.lit(None if r.glob else r.name).cast("string") for r in ranked], F.lit(None).cast("string"))
    verdicts = F.array(*[F.lit(r.verdict) for r in ranked], F.lit(otherwise))
    return fit.select(key, "host", "path", F.get(names, F.col("fit")).alias("rule"), F.get(verdicts, F.col("fit")).alias("verdict"))


#: The rules of the registered query: by host and path, then the method's own patterns.
RULES = [
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
    Rule("block", glob="*/*login*"), Rule("block", glob="*/*.exe"), Rule("block", glob=".ads.*"), Rule("block", glob="*/wp-admin/*"),
    Rule("block", glob=".*.example.net/en/??"),
]

SQL = r"""
with p as (select page_id, coalesce(url, '') as u, strpos(coalesce(url, ''), '://') as pos from pages),
s as (select page_id, case when pos > 0 then regexp_extract(substr(u, pos + 3), '^([^?#]*)', 1) else '' end as rest from p),
h as (select page_id, rest, regexp_extract(rest, '^([^/]*)', 1) as raw from s),
c as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, substr(rest, length(raw) + 1) as path from h),
f as (select *, '.' || host as dotted from c),
r as (select *, case
    when suffix(dotted, '.example.org') and prefix(path, '/en/1') then 'example.org/en/1'
    when suffix(dotted, '.example.org') and prefix(path, '/es/') then 'example.org/es/'
    when suffix(dotted, '.com') and prefix(path, '/de/') then 'com/de/'
    when suffix(dotted, '.com') and prefix(path, '/fr/') then 'com/fr/'
    when suffix(dotted, '.org') and prefix(path, '/') then 'org/' end as rule from f)
select page_id, host, path, rule, case
    when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
    when path like '/%login%' or path like '/%.exe' or path like '/wp-admin/%' or path like '/%/wp-admin/%' or prefix(dotted, '.ads.')
      or (regexp_matches(dotted, '^\..*\.example\.net$') and regexp_matches(path, '^/en/..$')) then 'block'
    else 'allow' end as verdict
from r
"""
