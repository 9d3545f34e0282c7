"""Personal data in texts, and the words beside it that give it away; in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.quality import let
from tablecraft.llm.textual import whole
from tablecraft.plans.lineage import materialize

#: The kinds in their order, and what each looks like. Every run of characters is
#: entered once, at its start or where the match before ended, and never given back, so that a long run
#: costs one pass; the matches are those of the plain patterns. A card is a whole run of digits.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Cheap signs without which a kind cannot occur.
SIGNS = {"email": "@", "ip": ".", "phone": "+"}
TERM = r"\p{L}[\p{L}\p{M}'-]*+"
#: Code points on each side of a span in which words count as its company.
CONTEXT = 80
#: Documents in which an entity, and an entity with a term, must occur before they count as evidence.
SUPPORT = 3
#: Share of an entity's information that a term may give away: beyond the first it is generalised, beyond the second removed.
GENERALISE, REMOVE = 0.8, 0.95


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the pattern's leftmost matches, in code points, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("spans"))

    def places(m: Column) -> Column:
        gaps = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m)), m, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("v")))
        step = lambda a, x: F.struct(
            (a["at"] + x["gap"] + F.length(x["v"])).alias("at"),
            F.array_append(a["spans"], F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + F.length(x["v"])).alias("end"),
                                                x["v"].alias("value"))).alias("spans"))
        return F.aggregate(gaps, state, step, lambda a: a["spans"])

    return let(found, lambda m: F.when(F.size(m) == 0, state["spans"]).otherwise(places(m)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def weigh(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), weigh) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda s: (F.length(s) < 3) | (
            (F.length(s) == 3) & (F.rpad(s, 3, "0") <= "255"))))
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value), by kind as listed, then start. Kinds may overlap each other."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def of(kind: str) -> Column:
        good = F.filter(located(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        named = F.transform(good, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(F.contains(text, F.lit(SIGNS[kind])), named).otherwise(none) if kind in SIGNS else named

    return F.concat(*[of(kind) for kind in KINDS])


def _company(text: Column, spans: Column) -> Column:
    """Array of (entity, term, start, end): words near each span, each whole, in lower case, outside of all spans."""

    def near(s: Column) -> Column:
        low, high = F.greatest(F.lit(0), s["start"] - CONTEXT), F.least(F.length(text), s["end"] + CONTEXT)

        def side(begin: Column, end: Column) -> Column:
            return F.transform(located(F.substring(text, begin + 1, end - begin), TERM), lambda w: F.struct(
                F.concat(s["kind"], F.lit(":"), F.lower(s["value"])).alias("entity"), F.lower(w["value"]).alias("term"),
                (begin + w["start"]).alias("start"), (begin + w["end"]).alias("end")))

        cut = lambda w: ((w["start"] == low) & (low > 0)) | ((w["end"] == high) & (high < F.length(text)))
        return F.filter(F.concat(side(low, s["start"]), side(s["end"], high)), lambda w: ~cut(w) & ~F.exists(spans, lambda b: (w["start"] < b["end"]) & (w["end"] > b["start"])))

    return F.flatten(F.transform(spans, near))


def _terms_of(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def disclosures(docs: DataFrame, met: DataFrame, text: str = "text") -> DataFrame:
    """(entity, term, share) of the terms that give away too much of an entity.

    ``met`` has (row, entity, term) of words in the company of entities. Over documents, the
    pointwise mutual information of entity and term is divided by the information of the entity itself:
    1 means that whoever reads the term knows the entity. Counts cover all documents, and are
    aggregated before every shuffle.
    """
    total = docs.count()
    entities = met.select("entity", "row").distinct().groupBy("entity").agg(F.count("*").alias("with_entity"))
    pairs = met.select("entity", "term", "row").distinct().groupBy("entity", "term").agg(F.count("*").alias("with_both"))
    terms = docs.select(F.explode(_terms_of(whole(text))).alias("term")).groupBy("term").agg(F.count("*").alias("with_term"))
    share = (F.log2(F.col("with_both") * F.lit(float(total)) / (F.col("with_entity") * F.col("with_term")))
             / F.log2(F.lit(float(total)) / F.col("with_entity")))
    return (pairs.where(F.col("with_both") >= SUPPORT).join(terms, "term")
            .join(entities.where((F.col("with_entity") >= SUPPORT) & (F.col("with_entity") < total)), "entity")
            .select("entity", "term", share.alias("share")).where(F.col("share") > GENERALISE))


def _term_spans(docs: DataFrame, narrow: DataFrame, text: str) -> DataFrame:
    """(row, found): the terms to change in each row, as (kind, start, end, value, share), by start."""
    met = narrow.select("row", F.explode("company").alias("c")).select("row", "c.*")
    flagged = disclosures(docs, met, text)
    spans = met.join(flagged, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("share").alias("share"))
    return spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("found"))


def find_personal(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, base (the spans of the four kinds, with values), found (terms that give them away).

    A missing text is empty and has no spans; so has a text without personal data. Repeated rows are
    separate documents in all counts. A term is changed only near the entity that it gives away,
    never inside a base span; base spans do not depend on the terms.
    """
    found = docs.select(F.col(key).alias("id"), whole(text).alias("text")).select("id", "text", base_spans(F.col("text")).alias("base"))
    found = found.select("id", "base", F.when(F.size("base") > 0, _company(F.col("text"), F.col("base"))).alias("company"))
    narrow = materialize(found).withColumn("row", F.monotonically_increasing_id())
    terms = _term_spans(docs, narrow, text)
    return narrow.join(terms, "row", "left").select(
        F.col("id").alias(key), "base", F.coalesce("found", F.array().cast("array<struct<start:int,end:int,share:double>>")).alias("found"))


def span_text(kind: Column, start: Column, end: Column) -> Column:
    return F.concat_ws(":", kind, start.cast("string"), end.cast("string"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents with personal data replaced by the name of its kind, and with revealing terms changed.

    A term beyond the first threshold is generalised to its first letter and an ellipsis, which stands for all
    words of that initial; beyond the second it is removed. Overlapping spans are replaced as one, by
    the kind that starts first. ``length`` names a column to hold the new number of characters, if
    present. A missing text stays missing. Only rows with personal data are shuffled.
    """
    hashed = lambda: F.xxhash64(*[F.col(c) for c in docs.columns])
    named = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).alias("id"), whole(text).alias("text"),
                        hashed().alias("hash"))
    based = named.withColumn("base", base_spans(F.col("text")))
    clean = based.where(F.size("base") == 0).select("row.*")
    dirty = based.where(F.size("base") > 0)
    narrow = materialize(dirty.select("id", "hash", _company(F.col("text"), F.col("base")).alias("company"))).withColumn(
        "row", F.monotonically_increasing_id())
    terms = _term_spans(docs, narrow, text).join(narrow.select("row", "id", "hash"), "row").groupBy("id", "hash").agg(F.first("found").alias("found"))
    terms = terms.select(F.col("id").alias("term_id"), F.col("hash").alias("term_hash"), "found")
    both = dirty.join(terms, F.col("id").eqNullSafe(F.col("term_id")) & (F.col("hash") == F.col("term_hash")), "left")
    changed = both.select("row", _rewritten(F.col("text"), F.col("base"), F.col("found")).alias("new_text"))
    columns = [F.col("new_text").alias(c) if c == text else F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == length
               else F.col("row")[c].alias(c) for c in docs.columns]
    return clean.unionByName(changed.select(*columns))


def _rewritten(text: Column, base: Column, found: Column) -> Column:
    """The text with every span replaced, built from left to right."""
    marks = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by")))
    loose = F.transform(F.coalesce(found, F.array().cast("array<struct<start:int,end:int,share:double>>")), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.when(s["share"] > REMOVE, F.lit("")).otherwise(F.concat(F.substring(text, s["start"] + 1, F.lit(1)), F.lit("…"))).alias("by")))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        fresh_span = s["start"] >= a["at"]
        piece = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(fresh_span, F.concat(a["out"], F.array(piece, s["by"]))).otherwise(a["out"]).alias("out"))

    return F.aggregate(F.sort_array(F.concat(marks, loose)), state, step,
                       lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, a["at"] + 1, F.length(text))))


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the counts by kind, a hash of the base spans, and all spans as text."""
    found = find_personal(docs, key, text)
    base = F.transform("base", lambda s: span_text(s["kind"], s["start"], s["end"]))
    terms = F.transform("found", lambda s: span_text(F.lit("term"), s["start"], s["end"]))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(key, *[count(k) for k in KINDS], F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(base, terms), ",").alias("spans"))


#: The kinds as they are defined, for SQL.
_PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_GOOD = {
    "email": "true",
    "ip": "list_max(list_transform(string_split(v, '.'), lambda x: case when length(ltrim(x, '0')) > 3 then 999 else coalesce(try_cast(nullif(ltrim(x, '0'), '') as int), 0) end)) <= 255",
    "card": """length(n) between 16 and 19 and list_sum(list_transform(range(1, length(n) + 1), lambda i: case when i % 2 = 1 then substr(reverse(n), i, 1)::int
        when substr(reverse(n), i, 1)::int > 4 then 2 * substr(reverse(n), i, 1)::int - 9 else 2 * substr(reverse(n), i, 1)::int end)) % 10 = 0""",
    "phone": "length(n) between 8 and 15",
}


def _sql_places(source: str, text: str, pattern: str) -> str:
    """Rows of the source with each match v of the pattern and its start s, end e in the text."""
    return f"""select * exclude (vs, gs, i), s + length(v) as e from (select *, vs[i] as v,
        (list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(vs[1:i - 1], lambda x: length(x))), 0))::bigint as s
        from (select *, unnest(range(1, len(vs) + 1)) as i from (select *, regexp_extract_all({text}, '{pattern}') as vs, string_split_regex({text}, '{pattern}') as gs from {source})))"""


_WORD = r"\p{L}[\p{L}\p{M}''-]*"
SQL = "with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),\nb as (" + " union all ".join(
    f"select r, {o} as o, '{k}' as kind, v, s, e from (select *, regexp_replace(v, '[^0-9]', '', 'g') as n from ({_sql_places('d', 't', _PLAIN[k])})) where {_GOOD[k]}"
    for o, k in enumerate(KINDS)) + f"""),
c as (select r, kind || ':' || lower(v) as entity, greatest(0, s - {CONTEXT}) as low, s as s0, e as e0, least(length(t), e + {CONTEXT}) as high, length(t) as size, t from b join d using (r)),
n as (select r, entity, low as base, low, high, size, substr(t, low + 1, s0 - low) as side from c
      union all select r, entity, e0, low, high, size, substr(t, e0 + 1, high - e0) from c),
w as (select r, entity, lower(v) as term, base + s as s, base + e as e, low, high, size from ({_sql_places('n', 'side', _WORD)})),
m as (select distinct r, entity, term, s, e from w where not (s = low and low > 0) and not (e = high and high < size)
      and not exists (select 1 from b where b.r = w.r and w.s < b.e and w.e > b.s)),
ne as (select entity, count(distinct r) as n_e from m group by 1),
nb as (select entity, term, count(distinct r) as n_b from m group by 1, 2),
nt as (select term, count(*) as n_t from (select r, unnest(list_distinct(list_transform(regexp_extract_all(t, '{_WORD}'), lambda x: lower(x)))) as term from d) group by 1),
k as (select count(*)::double as n from d),
f as (select entity, term from nb join ne using (entity) join nt using (term), k where n_b >= {SUPPORT} and n_e >= {SUPPORT} and n_e < n
      and log2(n_b * n / (n_e * n_t)) / log2(n / n_e) > {GENERALISE}),
x as (select r, string_agg('term:' || s || ':' || e, ',' order by s, e) as terms from (select distinct r, s, e from m join f using (entity, term)) group by r),
y as (select r, string_agg(kind || ':' || s || ':' || e, ',' order by o, s) as base, count(*) filter (kind = 'email') as n_email, count(*) filter (kind = 'ip') as n_ip,
             count(*) filter (kind = 'card') as n_card, count(*) filter (kind = 'phone') as n_phone from b group by r)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone,
       sha256(coalesce(base, '')) as base_sha256, concat_ws(',', base, terms) as spans
from d left join y using (r) left join x using (r)
"""
