"""Elementwise math, arrays, strings and dates."""

import unicodedata

from pyspark.sql import functions as F

from tablecraft.catalog.registry import query
from tablecraft.functions import arrays as ar
from tablecraft.functions import dates as dt
from tablecraft.functions import mathx as mx
from tablecraft.functions import strings as st

c = F.col


def r(x, digits=6):
    return F.round(x, digits)


@query("""SELECT p_partkey, p_size + 2 AS plus, p_size - 20 AS minus, p_size * p_retailprice AS times,
CASE WHEN p_size <> 10 THEN p_retailprice / (p_size - 10) END AS divided, CASE WHEN p_size <> 10 THEN floor(20 - p_size::DOUBLE / 1) END AS whole,
CASE WHEN p_size <> 10 THEN CAST(floor((25 - p_size)::DOUBLE / (p_size - 10)) AS BIGINT) END AS floored,
CASE WHEN p_size <> 10 THEN CAST((25 - p_size) - (p_size - 10) * floor((25 - p_size)::DOUBLE / (p_size - 10)) AS BIGINT) END AS rest,
-p_size AS negative, p_size::DOUBLE ** 3 AS cubed, abs(20 - p_size) AS magnitude, 1.0::DOUBLE / p_size AS inverse, round_even(p_retailprice / 10, 1) AS rounded FROM part""")
def math_arith(t):
    size, d = c("p_size"), c("p_size") - 10
    return t.part.select(
        "p_partkey", (size + 2).alias("plus"), (size - 20).alias("minus"), (size * c("p_retailprice")).alias("times"),
        F.try_divide("p_retailprice", d.cast("double")).alias("divided"),
        F.when(d != 0, F.floor(20 - size.cast("double")).cast("double")).alias("whole"),
        mx.floor_div(25 - size, d).alias("floored"), mx.floor_mod(25 - size, d).alias("rest"), (-size).alias("negative"),
        F.pow(size.cast("double"), F.lit(3)).alias("cubed"), F.abs(20 - size).alias("magnitude"),
        mx.reciprocal(size.cast("double")).alias("inverse"), F.bround(c("p_retailprice") / 10, 1).alias("rounded"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, round(sin(l_quantity), 6) AS s, round(cos(l_quantity), 6) AS k, round(tan(l_discount), 6) AS t,
round(asin(l_discount), 6) AS asin, round(acos(l_discount), 6) AS acos, round(atan(l_quantity), 6) AS atan, round(sinh(l_discount), 6) AS sinh,
round(cosh(l_discount), 6) AS cosh, round(tanh(l_quantity / 50), 6) AS tanh, round(degrees(l_discount), 6) AS deg, round(radians(l_quantity), 6) AS rad FROM lineitem""")
def math_trig(t):
    q, d = c("l_quantity"), c("l_discount")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", r(F.sin(q)).alias("s"), r(F.cos(q)).alias("k"), r(F.tan(d)).alias("t"),
        r(F.asin(d)).alias("asin"), r(F.acos(d)).alias("acos"), r(F.atan(q)).alias("atan"), r(F.sinh(d)).alias("sinh"),
        r(F.cosh(d)).alias("cosh"), r(F.tanh(q / 50)).alias("tanh"), r(F.degrees(d)).alias("deg"), r(F.radians(q)).alias("rad"))


@query("""SELECT o_orderkey, round(exp(x), 6) AS e, round(2 ** x, 6) AS e2, round(3 ** x, 6) AS e3, round(ln(o_totalprice), 6) AS ln,
round(log2(o_totalprice), 6) AS l2, round(log10(o_totalprice), 6) AS l10, round(exp(x / 1000) - 1, 9) AS em1, round(ln(1 + x / 1000), 9) AS l1p,
round(sqrt(o_totalprice), 6) AS root, round(x * x, 6) AS square, round(1 / (1 + exp(-x)), 6) AS sig,
CASE WHEN x > 2 THEN round(ln(x - 2), 6) END AS part_log FROM (SELECT *, o_totalprice / 100000 AS x FROM orders)""")
def math_explog(t):
    p, x = c("o_totalprice"), c("o_totalprice") / 100000
    return t.orders.select(
        "o_orderkey", r(F.exp(x)).alias("e"), r(mx.exp2(x)).alias("e2"), r(F.pow(F.lit(3.0), x)).alias("e3"),
        r(F.log(p)).alias("ln"), r(F.log2(p)).alias("l2"), r(F.log10(p)).alias("l10"), r(F.expm1(x / 1000), 9).alias("em1"),
        r(F.log1p(x / 1000), 9).alias("l1p"), r(F.sqrt(p)).alias("root"), r(x * x).alias("square"),
        r(mx.sigmoid(x)).alias("sig"), r(mx.safe_log(x - 2)).alias("part_log"))


@query("""SELECT c_custkey, c_nationkey < 10 AS lt, c_nationkey <= 10 AS le, c_nationkey > 10 AS gt, c_nationkey >= 10 AS ge,
c_nationkey = 10 AS eq, c_nationkey <> 10 AS ne, 2 * c_nationkey = c_nationkey * c_nationkey AS same FROM customer""")
def math_compare(t):
    n = c("c_nationkey")
    return t.customer.select("c_custkey", (n < 10).alias("lt"), (n <= 10).alias("le"), (n > 10).alias("gt"),
                             (n >= 10).alias("ge"), (n == 10).alias("eq"), (n != 10).alias("ne"),
                             (2 * n == n * n).alias("same"))


@query("""SELECT c_custkey, a AND b AS both, a OR b AS either, a <> b AS one, NOT a AS neither, (k & 6) AS band, (k | 1) AS bor, xor(k, 5) AS bxor,
~k AS bnot, k << 2 AS up, k >> 1 AS down FROM (SELECT c_custkey, c_acctbal > 0 AS a, c_mktsegment = 'BUILDING' AS b, c_nationkey AS k FROM customer)""")
def bool_ops(t):
    a, b, k = c("c_acctbal") > 0, c("c_mktsegment") == "BUILDING", c("c_nationkey")
    return t.customer.select(
        "c_custkey", (a & b).alias("both"), (a | b).alias("either"), (a != b).alias("one"), (~a).alias("neither"),
        k.bitwiseAND(6).alias("band"), k.bitwiseOR(1).alias("bor"), k.bitwiseXOR(5).alias("bxor"),
        F.bitwise_not(k).alias("bnot"), F.shiftleft(k, 2).alias("up"), F.shiftright(k, 1).alias("down"))


# arrays: results are listed one element per row

def _long(df, **columns):
    """(vec_id, part, pos, value) rows of several array expressions."""
    parts = F.array(*[F.struct(F.lit(n).alias("part"), F.transform(x, lambda v: v.cast("double")).alias("x"))
                      for n, x in columns.items()])
    rows = df.select("vec_id", F.explode(parts).alias("p"))
    return rows.select("vec_id", "p.part", F.posexplode("p.x").alias("pos", "value"))


def _long_sql(**columns):
    return " UNION ALL ".join(
        f"""SELECT vec_id, '{n}' AS part, (generate_subscripts(x, 1) - 1)::INTEGER AS pos, unnest(x)::DOUBLE AS value
FROM (SELECT vec_id, {sql} AS x FROM embeddings)""" for n, sql in columns.items())


def emb():
    return c("embedding")


@query(_long_sql(step="embedding[3:8:2]", tail="embedding[-3:]", back="list_reverse(embedding)", head="embedding[:5]"))
def array_slice(t):
    return _long(t.embeddings, step=ar.take_slice(emb(), 2, 8, 2), tail=ar.take_slice(emb(), -3), back=F.reverse(emb()),
                 head=ar.take_slice(emb(), 0, 5))


@query(_long_sql(picked="[embedding[3], embedding[4], embedding[6], embedding[-1]]"))
def array_pick(t):
    return _long(t.embeddings, picked=ar.pick(emb(), [2, 3, 5, -1]))


@query(_long_sql(both="list_concat(embedding[:3], embedding[-2:])", a="embedding[:3]", b="embedding[4:5]", c="embedding[6:]"))
def array_concat_split(t):
    a, b, rest = ar.split_at(emb(), [3, 5])
    return _long(t.embeddings, both=F.concat(ar.take_slice(emb(), 0, 3), ar.take_slice(emb(), -2)), a=a, b=b, c=rest)


@query(_long_sql(sorted="list_sort(embedding)", places="list_transform(list_grade_up(embedding), lambda i: i - 1)"))
def array_sort_argsort(t):
    return _long(t.embeddings, sorted=F.array_sort(emb()), places=ar.argsort(emb()))


@query("""SELECT vec_id, round(list_sum(embedding::DOUBLE[]), 6) AS total, list_min(embedding)::DOUBLE AS low, list_max(embedding)::DOUBLE AS high,
round(list_avg(embedding::DOUBLE[]), 6) AS mean, (list_position(embedding, list_max(embedding)) - 1)::BIGINT AS at_high,
(list_position(embedding, list_min(embedding)) - 1)::BIGINT AS at_low FROM embeddings""")
def array_reduce(t):
    return t.embeddings.select(
        "vec_id", r(ar.total(emb())).alias("total"), F.array_min(emb()).cast("double").alias("low"),
        F.array_max(emb()).cast("double").alias("high"), r(ar.mean(emb())).alias("mean"), ar.argmax(emb()).alias("at_high"),
        ar.argmin(emb()).alias("at_low"))


@query("SELECT vec_id, len(list_filter(embedding, lambda v: v > 0.1))::INTEGER AS many FROM embeddings")
def array_mask_count(t):
    return t.embeddings.select("vec_id", F.size(F.filter(emb(), lambda v: v > F.lit(0.1).cast("float"))).alias("many"))


@query("""SELECT vec_id, round(list_dot_product(x, y), 6) AS dot, round(sqrt(list_dot_product(x, x)), 6) AS norm,
round(list_dot_product(x, y) / sqrt(list_dot_product(x, x) * list_dot_product(y, y)), 6) AS cosine
FROM (SELECT vec_id, embedding::DOUBLE[] AS x, list_reverse(embedding)::DOUBLE[] AS y FROM embeddings)""")
def array_dot_norm(t):
    back = F.reverse(emb())
    return t.embeddings.select("vec_id", r(ar.dot(emb(), back)).alias("dot"), r(ar.norm(emb())).alias("norm"),
                               r(ar.cosine(emb(), back)).alias("cosine"))


@query("""SELECT vec_id, part, pos, round(value, 6) AS value FROM (""" + _long_sql(
    shifted="list_transform(embedding::DOUBLE[], lambda v, i: v + i - 1)") + ")")
def array_add_row(t):
    row = F.array(*[F.lit(float(i)) for i in range(64)])
    out = _long(t.embeddings, shifted=ar.add(F.transform(emb(), lambda v: v.cast("double")), row))
    return out.withColumn("value", r("value"))


# strings

@query("""SELECT p_partkey, lower(p_type) AS low, upper(p_name) AS up, upper(left(p_name, 1)) || lower(substr(p_name, 2)) AS cap,
upper(left(p_name, 1)) || upper(substr(p_name, 2)) AS swap_name, 'b' || upper(substr(lower(p_brand), 2)) AS swap_brand FROM part""")
def str_case(t):
    return t.part.select("p_partkey", F.lower("p_type").alias("low"), F.upper("p_name").alias("up"),
                         st.capitalize(c("p_name")).alias("cap"), st.swapcase(c("p_name")).alias("swap_name"),
                         st.swapcase(c("p_brand")).alias("swap_brand"))


@query("SELECT doc_id, length(text)::INTEGER AS n, length(CASE WHEN doc_id % 7 > 0 THEN lang END)::INTEGER AS n_lang FROM documents")
def str_len(t):
    return t.documents.select("doc_id", F.length("text").alias("n"),
                              F.length(F.when(c("doc_id") % 7 > 0, c("lang"))).alias("n_lang"))


@query("""SELECT p_partkey, rpad(p_name, greatest(12, length(p_name))::INTEGER, '.') AS lj, lpad(p_name, greatest(12, length(p_name))::INTEGER, '.') AS rj,
CASE WHEN length(p_name) < 15 THEN repeat('*', ((15 - length(p_name)) // 2 + (15 - length(p_name)) % 2)) || p_name || repeat('*', ((15 - length(p_name)) - (15 - length(p_name)) // 2 - (15 - length(p_name)) % 2)) ELSE p_name END AS ce,
CASE WHEN p_size > 20 THEN lpad(p_size::VARCHAR, 6, '0') ELSE '-' || lpad(p_size::VARCHAR, 5, '0') END AS zf FROM part""")
def str_pad(t):
    n = c("p_name")
    signed = F.when(c("p_size") > 20, c("p_size").cast("string")).otherwise(F.concat(F.lit("-"), c("p_size").cast("string")))
    return t.part.select("p_partkey", st.ljust(n, 12, ".").alias("lj"), st.rjust(n, 12, ".").alias("rj"),
                         st.center(n, 15, "*").alias("ce"), st.zfill(signed, 6).alias("zf"))


@query("""SELECT s_suppkey, s_name AS both, s_name || '  ' || chr(10) AS l, ' ' || chr(9) || s_name AS r FROM supplier""")
def str_strip(t):
    x = F.concat(F.lit(" \t"), "s_name", F.lit("  \n"))
    return t.supplier.select("s_suppkey", st.strip(x).alias("both"), st.lstrip(x).alias("l"), st.rstrip(x).alias("r"))


@query("""SELECT p_partkey, (strpos(p_name, 'r') - 1)::INTEGER AS f, (CASE WHEN strpos(p_name, 'r') = 0 THEN -1 ELSE length(p_name) - strpos(reverse(p_name), 'r') END)::INTEGER AS rf,
(strpos(p_name, ' ') - 1)::INTEGER AS i, (length(p_name) - strpos(reverse(p_name), ' '))::INTEGER AS ri, starts_with(p_name, 're') AS sw, ends_with(p_name, 'et') AS ew FROM part""")
def str_find(t):
    n = c("p_name")
    return t.part.select("p_partkey", st.find(n, "r").alias("f"), st.rfind(n, "r").alias("rf"), st.index(n, " ").alias("i"),
                         st.rindex(n, " ").alias("ri"), F.startswith(n, F.lit("re")).alias("sw"),
                         F.endswith(n, F.lit("et")).alias("ew"))


_CHECKS = """doc_id, regexp_matches(w, '\\p{Ll}') AND NOT regexp_matches(w, '[\\p{Lu}\\p{Lt}]') AS islower, regexp_matches(w, '\\p{Lu}') AND NOT regexp_matches(w, '[\\p{Ll}\\p{Lt}]') AS isupper,
regexp_full_match(w, '\\p{L}+') AS isalpha, regexp_full_match(w, '[\\p{L}\\p{N}]+') AS isalnum, regexp_full_match(w, '\\p{N}+') AS isnumeric, regexp_full_match(w, '\\p{Nd}+') AS isdecimal,
regexp_full_match(w, '\\p{Nd}+') AS isdigit, regexp_full_match(w, '\\s+') AS isspace,
regexp_matches(w, '\\p{Lu}') AND NOT regexp_matches(w, '(^|[^\\p{Lu}\\p{Ll}\\p{Lt}])\\p{Ll}') AND NOT regexp_matches(w, '[\\p{Lu}\\p{Ll}\\p{Lt}]\\p{Lu}') AS istitle"""


@query(f"""SELECT 'first' AS what, {_CHECKS} FROM (SELECT doc_id, split_part(text, ' ', 1) AS w FROM documents)
UNION ALL SELECT 'chars', {_CHECKS} FROM (SELECT doc_id, n_chars::VARCHAR AS w FROM documents)
UNION ALL SELECT 'text', {_CHECKS} FROM (SELECT doc_id, text AS w FROM documents)
UNION ALL SELECT 'space', {_CHECKS} FROM (SELECT doc_id, ' ' || chr(9) AS w FROM documents)""")
def str_predicates(t):
    words = {"first": F.split_part("text", F.lit(" "), F.lit(1)), "chars": c("n_chars").cast("string"),
             "text": c("text"), "space": F.lit(" \t")}
    pairs = F.array(*[F.struct(F.lit(k).alias("what"), v.alias("w")) for k, v in words.items()])
    long = t.documents.select("doc_id", F.explode(pairs).alias("p"))
    return long.select("doc_id", "p.what", *[st.predicate(c("p.w"), k).alias(k) for k in (
        "islower", "isupper", "isalpha", "isalnum", "isnumeric", "isdecimal", "isdigit", "isspace", "istitle")])


@query("""SELECT p_partkey, len(string_split(p_name, ' '))::INTEGER AS n, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[-1] AS last,
left(p_brand, strpos(p_brand, '#') - 1) AS before, '#' AS sep, substr(p_brand, strpos(p_brand, '#') + 1) AS after,
CASE WHEN strpos(p_name, 'i') = 0 THEN '' ELSE left(p_name, length(p_name) - strpos(reverse(p_name), 'i')) END AS rbefore,
CASE WHEN strpos(p_name, 'i') = 0 THEN p_name ELSE right(p_name, strpos(reverse(p_name), 'i') - 1) END AS rafter FROM part""")
def str_split(t):
    words = F.split("p_name", " ")
    before, sep, after = st.partition(c("p_brand"), "#")
    rbefore, _, rafter = st.rpartition(c("p_name"), "i")
    return t.part.select("p_partkey", F.size(words).alias("n"), F.get(words, F.lit(0)).alias("first"),
                         F.element_at(words, -1).alias("last"), before.alias("before"), sep.alias("sep"),
                         after.alias("after"), rbefore.alias("rbefore"), rafter.alias("rafter"))


@query("""SELECT c_custkey, right(c_name, 1) AS last, left(c_name, 2) AS head, left(c_name, 3) || '--' || substr(c_name, 9) AS replaced,
string_split(c_name, '#')[-1] AS number FROM customer""")
def str_get_slice(t):
    n = c("c_name")
    return t.customer.select("c_custkey", F.substring(n, -1, 1).alias("last"), F.substring(n, 1, 2).alias("head"),
                             st.slice_replace(n, 3, 8, "--").alias("replaced"),
                             F.element_at(F.split(n, "#"), -1).alias("number"))


@query("""SELECT doc_id, regexp_matches(text, '^[A-Z][a-z]+ ') AS starts, CASE WHEN regexp_matches(text, '([A-Za-z]+)ing') THEN regexp_extract(text, '([A-Za-z]+)ing', 1) END AS stem,
len(regexp_extract_all(text, '[0-9]+'))::INTEGER AS numbers, array_to_string(regexp_extract_all(text, '[0-9]+'), ' ') AS found,
length(regexp_replace(text, '[aeiou]', '', 'g'))::INTEGER AS consonants, regexp_matches(text, 'the') AS has_the FROM documents""")
def str_regex(t):
    x = c("text")
    return t.documents.select(
        "doc_id", st.match(x, "[A-Z][a-z]+ ").alias("starts"), st.extract(x, "([A-Za-z]+)ing").alias("stem"),
        F.regexp_count(x, F.lit("[0-9]+")).alias("numbers"), F.array_join(st.findall(x, "[0-9]+"), " ").alias("found"),
        F.length(F.regexp_replace(x, "[aeiou]", "")).alias("consonants"), x.contains("the").alias("has_the"))


@query("""SELECT p_partkey, p_brand || '/' || p_type AS cat, repeat(p_type, 2) AS rep, array_to_string(string_split(p_name, ''), '-') AS spaced FROM part""")
def str_join_repeat(t):
    return t.part.select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("cat"), F.repeat("p_type", 2).alias("rep"),
                         st.join_chars(c("p_name"), "-").alias("spaced"))


@query("SELECT doc_id, translate(text, 'abcé', 'xyz') AS text FROM documents")
def str_translate(t):
    return t.documents.select("doc_id", F.translate("text", "abcé", "xyz").alias("text"))


#: Letters that fall apart into a letter and a mark, as far as the texts have them.
_MARKED = [chr(n) for n in range(0xC0, 0x100) if len(unicodedata.normalize("NFKD", chr(n))) == 2]
_PLAIN = "text"
for _letter in _MARKED:
    _PLAIN = f"replace({_PLAIN}, '{_letter}', '{unicodedata.normalize('NFKD', _letter)}')"


@query(f"""WITH d AS (SELECT doc_id, text, {_PLAIN} AS plain,
  string_split(regexp_replace(regexp_replace(text, '(\\p{{L}}{{2}}-)(\\p{{L}}{{2}})', '\\1 ' || chr(1) || '\\2', 'g'), '[ \\t-\\r]+', ' ', 'g'), ' ') AS words FROM documents),
w AS (SELECT doc_id, plain, list_transform(words, lambda x: {{'t': ltrim(x, chr(1)), 'n': length(ltrim(x, chr(1))), 'g': CASE WHEN x[1] = chr(1) THEN '' ELSE ' ' END}}) AS words FROM d),
f AS (SELECT doc_id, plain, list_reduce(words, lambda a, x: CASE
  WHEN a.n + length(x.g) + x.n <= 40 THEN {{'t': a.t || x.g || x.t, 'n': a.n + length(x.g) + x.n, 'g': ''}}
  WHEN x.n <= 40 THEN {{'t': a.t || chr(10) || x.t, 'n': x.n, 'g': ''}}
  WHEN a.n + length(x.g) >= 40 THEN {{'t': a.t || CASE WHEN a.n + length(x.g) = 40 THEN x.g ELSE '' END || chr(10) || x.t[:40] || chr(10) || x.t[41:], 'n': x.n - 40, 'g': ''}}
  WHEN x.n - (40 - a.n - length(x.g)) <= 40 THEN {{'t': a.t || x.g || x.t[:40 - a.n - length(x.g)] || chr(10) || x.t[41 - a.n - length(x.g):], 'n': x.n - (40 - a.n - length(x.g)), 'g': ''}}
  ELSE {{'t': a.t || x.g || x.t[:40 - a.n - length(x.g)] || chr(10) || x.t[41 - a.n - length(x.g):80 - a.n - length(x.g)] || chr(10) || x.t[81 - a.n - length(x.g):], 'n': x.n - (80 - a.n - length(x.g)), 'g': ''}} END,
  {{'t': '', 'n': -1, 'g': ''}}) AS r FROM w)
SELECT doc_id, plain, ltrim(r.t) AS wrapped FROM f""")
def str_normalize_wrap(t):
    return t.documents.select("doc_id", st.normalize_nfkd("text").alias("plain"), st.wrap(c("text"), 40).alias("wrapped"))


@query("""SELECT o_orderkey, o_orderpriority = '1-URGENT' AS a, o_orderstatus = 'F' AS b FROM orders""".replace(
    "o_orderpriority = '1-URGENT' AS a, o_orderstatus = 'F' AS b",
    ", ".join(f"""(o_orderpriority LIKE '%{w}%' AND (length('{w}') > 1 OR o_orderpriority LIKE '{w}-%'))::INTEGER AS "{w}" """
              for w in ("1", "2", "3", "4", "5", "HIGH", "LOW", "MEDIUM", "NOT SPECIFIED", "URGENT"))))
def str_get_dummies(t):
    return st.get_dummies(t.orders, "o_orderpriority", "-", ["o_orderkey"])


# dates

@query("SELECT o_orderkey, o_orderdate::DATE AS day FROM orders")
def date_parse_mixed(t):
    d, n = c("o_orderdate"), F.dayofmonth("o_orderdate")
    suffix = (F.when(n.isin(11, 12, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd")
              .when(n % 10 == 3, "rd").otherwise("th"))
    texts = [F.concat(n.cast("string"), suffix, F.lit(" of "), F.date_format(d, "MMMM, yyyy")),
             F.date_format(d, "yyyy-MMM-d"), F.date_format(d, "MM-dd-yyyy"), F.date_format(d, "yyyyMMdd"),
             F.concat(n.cast("string"), suffix, F.date_format(d, " MMMM, yyyy"))]
    mixed = F.element_at(F.array(*texts), (c("o_orderkey") % 5 + 1).cast("int"))
    return t.orders.select("o_orderkey", dt.parse_mixed(mixed).alias("day"))


@query("SELECT event_id, dayname(ts) AS weekday FROM events")
def date_weekday_name(t):
    return t.events.select("event_id", dt.weekday_name(c("ts")).alias("weekday"))


@query("""SELECT o_orderkey, (o_orderdate::DATE + (o_orderkey % 30)::INTEGER)::DATE AS due, o_orderdate + to_days((o_orderkey % 30)::INTEGER) AS due_ts FROM orders""")
def date_add_days(t):
    n = (c("o_orderkey") % 30).cast("int")
    return t.orders.select("o_orderkey", F.date_add(c("o_orderdate").cast("date"), n).alias("due"),
                           (c("o_orderdate") + F.make_dt_interval(n)).alias("due_ts"))


@query("SELECT o_orderkey, date_diff('day', (SELECT min(o_orderdate) FROM orders)::DATE, o_orderdate::DATE)::INTEGER AS days FROM orders")
def date_diff(t):
    first = t.orders.agg(F.min("o_orderdate")).scalar()
    return t.orders.select("o_orderkey", F.datediff("o_orderdate", first).alias("days"))


@query("SELECT o_orderkey, o_orderdate - INTERVAL 2 YEAR AS earlier FROM orders")
def date_offset_years(t):
    return t.orders.select("o_orderkey", (c("o_orderdate") - F.make_interval(years=F.lit(2))).alias("earlier"))


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08'")
def date_range_slice(t):
    return t.events.filter(dt.in_days(c("ts"), "2024-01-05", "2024-01-07")).select("event_id", "ts")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997")
def date_partial_key(t):
    return t.orders.filter(dt.in_year(c("o_orderdate"), 1997)).select("o_orderkey", "o_orderdate")


@query("""SELECT o_orderkey, date_diff('day', DATE '1992-01-01', o_orderdate::DATE)::INTEGER AS since, year(o_orderdate)::INTEGER AS y,
month(o_orderdate)::INTEGER AS m, day(o_orderdate)::INTEGER AS d FROM orders""")
def date_parts(t):
    d = c("o_orderdate")
    return t.orders.select("o_orderkey", F.datediff(d, F.lit("1992-01-01").cast("date")).alias("since"),
                           F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"))


@query("""SELECT o_orderkey, round(sin(2 * pi() * month(o_orderdate) / 12), 6) AS month_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 6) AS month_cos,
round(sin(2 * pi() * dayofweek(o_orderdate) / 7), 6) AS day_sin, round(cos(2 * pi() * dayofweek(o_orderdate) / 7), 6) AS day_cos FROM orders""")
def cyclic_encode(t):
    ms, mc = dt.cyclic(F.month("o_orderdate"), 12)
    ds, dc = dt.cyclic(F.dayofweek("o_orderdate") - 1, 7)
    # adding 0.0 turns a rounded -0.0 into 0.0
    return t.orders.select("o_orderkey", *[(r(x) + 0.0).alias(n) for n, x in (
        ("month_sin", ms), ("month_cos", mc), ("day_sin", ds), ("day_cos", dc))])
