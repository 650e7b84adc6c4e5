"""Queries on pages, cards, readings and lines over the driver's tables, with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import script
from ..operators import cards, gates, layout, sequence
from ..sources import readers
from .relational import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) WHERE l_linenumber = 1 OR l_linenumber = m""")
def first_and_last_page(s, d):
    p = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    n = p.groupBy("l_orderkey").agg(F.max("l_linenumber").alias("n_pages"))
    return gates.first_and_last(p.join(n, "l_orderkey"), "l_linenumber", "n_pages").drop("n_pages")


@query("""SELECT l_orderkey, count(*) >= 2 AND max(l_linenumber) <= 2 AS valid FROM lineitem GROUP BY 1""")
def valid_excerpts(s, d):
    p = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("length"), F.max("l_linenumber").alias("n_pages"))
    p = p.withColumn("head", F.lit(b"%PDF-"))
    return p.select("l_orderkey", gates.is_valid_excerpt(readers.is_valid_file(least=2), "n_pages").alias("valid"))


def _cards(s, d):
    i = F.col("event_id")
    return table(s, d, "events").select(
        "event_id", F.col("user_id").alias("page"), (i % 20).alias("ink"), F.col("value").alias("stamp"), F.when(F.col("user_id") % 10 == 0, "addition").otherwise("main").alias("list_type"),
        F.concat(F.when(i % 6 == 0, " r ").otherwise(""), (i % 100000).cast("string")).alias("serial_text"), "event_type",
    )


@query("SELECT event_id, event_type FROM events WHERE event_id % 20 > 8 OR value > 60 OR user_id % 10 = 0 OR event_id % 6 = 0")
def reading_candidates(s, d):
    """The reading jobs, one a card and type, of the cards that can be deleted ones."""
    c = _cards(s, d)
    return gates.candidates_only(c.select("event_id", "event_type"), c, ["event_id"], gates.worth_reading("ink", "stamp", "list_type", "serial_text"))


@query("SELECT event_id, user_id AS page FROM events WHERE user_id % 10 = 0")
def addition_cards(s, d):
    return gates.additions(_cards(s, d)).select("event_id", "page")


@query("""WITH h AS (SELECT user_id, arg_min(event_type, event_id) AS a, arg_min(props, event_id) AS b FROM events WHERE event_type <> 'click' GROUP BY 1)
SELECT event_id, CASE WHEN user_id % 10 = 0 THEN coalesce(a, '') ELSE '' END AS start, CASE WHEN user_id % 10 = 0 THEN coalesce(b, '') ELSE '' END AS end FROM events LEFT JOIN h USING (user_id)""")
def page_period(s, d):
    """The heading of a page is its user's first event that is no click."""
    h = table(s, d, "events").where("event_type <> 'click'").select(F.col("user_id").alias("page"), "event_id", F.col("event_type").alias("start"), F.col("props").alias("end"))
    return gates.with_period(_cards(s, d), h.withColumnRenamed("event_id", "at"), ["page"], "at").select("event_id", "start", "end")


@query("""SELECT p_partkey, p_partkey % 4 < 2 OR p_partkey % 4 = 3 OR (p_size % 2 = 0 AND p_partkey % 8 = 2) AS accepted FROM part""")
def row_acceptance(s, d):
    k = F.col("p_partkey")
    first = F.when(k % 4 == 0, F.col("p_size").cast("string")).when(k % 4 == 1, "१२").when(k % 4 == 2, "x").otherwise(" 7 ")
    ident = F.when(k % 8 == 2, F.concat(F.lit("ABC"), F.lpad((k % 10000000).cast("string"), 7, "0"))).otherwise(F.col("p_name"))
    p = table(s, d, "part").select("p_partkey", first.alias("a"), ident.alias("b"), (F.col("p_size") % 2 == 0).alias("seen"))
    return p.select("p_partkey", gates.accepted_row("a", "b", "seen").alias("accepted"))


@query("SELECT * EXCLUDE (l_extendedprice, l_discount, l_tax) FROM lineitem")
def slim_columns(s, d):
    """All columns but those that the slim table leaves out, in their order."""
    return table(s, d, "lineitem").drop("l_extendedprice", "l_discount", "l_tax")


@query("""SELECT event_id, coalesce(list_extract(['shifted (स्थानांतरित)', 'dead (मृतक)', 'repeated (पुनरावृत्ति)', 'missing (लापता)', 'ineligible (अयोग्य)', '# (not in legend)'], (event_id % 7 + 1)::INT), '') AS status FROM events""")
def status_meaning(s, d):
    code = F.get(F.array(*map(F.lit, (*gates.STATUS, "x"))), (F.col("event_id") % 7).cast("int"))
    return table(s, d, "events").select("event_id", code.alias("code")).select("event_id", gates.meaning("code", gates.STATUS).alias("status"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '?' ELSE event_type END AS value, NOT (event_id % 5 > 0 AND coalesce(value / 97 >= 0.63 AND (event_id % 15) / 100.0 >= 0.07, false)) AS unsure FROM events""")
def judged_labels(s, d):
    i = F.col("event_id")
    e = table(s, d, "events").select("event_id", F.when(i % 5 > 0, F.col("event_type")).alias("label"), (F.col("value") / 97).alias("score"), ((i % 15) / 100.0).alias("margin"))
    return e.select("event_id", gates.judged("status", "label", "score", "margin").alias("j")).select("event_id", "j.value", "j.unsure")


_CLASSES = ["mool", "add", "del", "diff", "net"]


@query("""WITH RECURSIVE e AS (SELECT user_id, event_id, CASE WHEN (event_id * 7) % 11 < 4 THEN list_extract(['mool', 'add', 'del', 'diff'], (event_id * 7) % 11 + 1) END AS label, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
b AS (SELECT user_id, coalesce(min(i) FILTER (label = 'mool'), least(4, max(i))) AS begin FROM e GROUP BY 1),
r AS (SELECT e.user_id, event_id, i, coalesce(list_position(['mool', 'add', 'del', 'diff', 'net'], label), 1) AS k FROM e JOIN b ON e.user_id = b.user_id AND i = begin
UNION ALL SELECT e.user_id, e.event_id, e.i, coalesce(list_position(['mool', 'add', 'del', 'diff', 'net'], label), least(r.k + 1, 5)) FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1 WHERE r.k < 5)
SELECT user_id, event_id, list_extract(['mool', 'add', 'del', 'diff', 'net'], k) AS class FROM r""")
def classes_in_order(s, d):
    h = F.col("event_id") * 7 % 11
    e = table(s, d, "events").select("user_id", "event_id", F.when(h < 4, F.get(F.array(*map(F.lit, _CLASSES)), h.cast("int"))).alias("label"))
    return sequence.classes_in_order(e, ["user_id"], ["event_id"], "label", _CLASSES, "mool").select("user_id", "event_id", "class")


_RUNS = """SELECT {u}, min(x) AS lo, max(x) AS hi, floor(avg(x))::BIGINT AS middle FROM (SELECT *, sum(n) OVER (PARTITION BY {u} ORDER BY x) AS g FROM (SELECT *, coalesce((x - lag(x) OVER (PARTITION BY {u} ORDER BY x) > {gap})::INT, 1) AS n FROM {t})) GROUP BY {u}, g"""


@query(f"""WITH p AS (SELECT DISTINCT user_id, event_id % 500 AS x FROM events), r AS ({_RUNS.format(u="user_id", gap=3, t="p")})
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY lo) AS word, lo AS x0, hi + 1 AS x1 FROM r""")
def words_of_line(s, d):
    ink = table(s, d, "events").select("user_id", (F.col("event_id") % 500).alias("x"))
    return layout.words_of_line(ink, ["user_id"], "x").select("user_id", F.col("word").cast("bigint").alias("word"), "x0", "x1")


@query(f"""WITH p AS (SELECT l_suppkey // 10 AS page, l_partkey % 40 AS x, count(*) AS n FROM lineitem GROUP BY 1, 2), q AS (SELECT page, x FROM p WHERE n >= 0.85 * 7), r AS ({_RUNS.format(u="page", gap=1, t="q")})
SELECT page, lo, hi, middle FROM r""")
def ruled_lines(s, d):
    px = table(s, d, "lineitem").select(F.floor(F.col("l_suppkey") / 10).alias("page"), (F.col("l_partkey") % 40).alias("x"))
    return layout.ruled_lines(px, ["page"], "x", 7, 0.85).select("page", "lo", "hi", "middle")


@query("""WITH s AS (SELECT o_custkey, o_orderkey AS x0, o_orderkey + CASE WHEN o_orderkey % 3 = 0 THEN 5000 ELSE 1 END AS x1, o_orderstatus AS text FROM orders),
g AS (SELECT *, CASE WHEN coalesce(x0 - lag(x1) OVER w < 1.0, true) THEN '' ELSE ' ' END || text AS t FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY x0, x1, text))
SELECT o_custkey, string_agg(t, '' ORDER BY x0, x1, text) AS text FROM g GROUP BY 1""")
def spans_joined(s, d):
    k = F.col("o_orderkey")
    o = table(s, d, "orders").select("o_custkey", k.alias("x0"), (k + F.when(k % 3 == 0, 5000).otherwise(1)).alias("x1"), F.col("o_orderstatus").alias("text"))
    return layout.joined(o, ["o_custkey"])


@query("""WITH t AS (SELECT l_orderkey AS page, l_linenumber AS table_id, count(*) AS n_rows, max(l_suppkey % 2) AS odd FROM lineitem GROUP BY 1, 2)
SELECT page, max({'n': n_rows, 'o': -table_id}).n AS n_rows, (-max({'n': n_rows, 'o': -table_id}).o)::INT AS table_id FROM t WHERE odd = 1 GROUP BY 1""")
def largest_table(s, d):
    t = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("table_id")).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.col("l_suppkey") % 2).alias("odd"))
    t = t.withColumn("n_columns", F.when(F.col("odd") == 1, 10).otherwise(7))
    return layout.largest_table(t, "page", "n_columns", "n_rows").select("page", "n_rows", "table_id")


@query("""SELECT page_id // 10 AS file, bool_and(page_id % 13 > 0) AS same FROM pages GROUP BY 1""")
def same_images(s, d):
    p = table(s, d, "pages").select(F.floor(F.col("page_id") / 10).alias("file"), "page_id", F.col("html").cast("binary").alias("px"), F.length("html").alias("w"))
    q = p.withColumn("px", F.when(F.col("page_id") % 13 == 0, F.concat(F.col("px"), F.lit(b"x"))).otherwise(F.col("px")))
    return layout.same_images(p, q, "file", "page_id", "px", ["w"])


@query("""WITH e AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.003) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(greatest(0.0, least(255.0, (l_extendedprice - lo) * 255.0 / greatest(hi - lo, 1e-9))), 4) AS stretched FROM lineitem JOIN e USING (l_returnflag)""")
def percentile_stretch(s, d):
    li = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return layout.stretch(li, ["l_returnflag"], "l_extendedprice").select("l_orderkey", "l_linenumber", F.round("stretched", 4).alias("stretched"))


@query("""SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY f) AS seen FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS f FROM orders GROUP BY 1, 2) GROUP BY 1""")
def distinct_in_order(s, d):
    return gates.distinct_in_order(table(s, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey").select("o_custkey", F.array_join("values", ",").alias("seen"))


@query("SELECT l_orderkey, l_linenumber, l_orderkey || '/2026-ROLL-' || l_orderkey || '-' || l_linenumber || '.pdf' AS path FROM lineitem")
def file_paths(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", gates.file_of("l_orderkey", "l_linenumber", "%1$s/2026-ROLL-%1$s-%2$s.pdf").alias("path"))


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'लखनऊ मध्य' WHEN 1 THEN 'लखनऊ' WHEN 2 THEN 'लखनऊ मध्य पूर्व' WHEN 3 THEN '' ELSE 'अ ब' END AS name, CASE c_custkey % 5 WHEN 0 THEN 'सामान्य' WHEN 1 THEN 'अ. जा.' WHEN 4 THEN 'सामान्य' ELSE '' END AS reserved FROM customer""")
def reservation_split(s, d):
    given = ["- लखनऊ मध्य (सामान्य)", "लखनऊ (अ. जा.)", "लखनऊ मध्य पूर्व", "", "अ ब सामान्य"]
    line = F.get(F.array(*map(F.lit, given)), (F.col("c_custkey") % 5).cast("int"))
    t = F.filter(F.split(line, " "), lambda x: x != "")
    return table(s, d, "customer").select("c_custkey", t.alias("t")).select("c_custkey", gates.reservation("t").alias("r")).select("c_custkey", "r.name", "r.reserved")


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'शहरवानो देवी' WHEN 1 THEN 'बानो' ELSE 'लोंग' END AS name FROM customer""")
def final_vowel(s, d):
    given = F.get(F.array(*map(F.lit, ["शहरवानों देवी", "बानों", "लोंग"])), (F.col("c_custkey") % 3).cast("int"))
    return table(s, d, "customer").select("c_custkey", script.end_vowel(given).alias("name"))


def _reads(s, d):
    i = F.col("event_id")
    e = table(s, d, "events")
    return e.select("user_id", (i % 7).alias("field"), (i % 3).cast("int").alias("model"), F.when(i % 5 > 0, F.concat(F.lit("n "), i.cast("string"))).otherwise("").alias("text"), (F.col("value") / 97).alias("score"))


_READS = "r AS (SELECT user_id, event_id % 7 AS field, (event_id % 3)::INT AS model, CASE WHEN event_id % 5 > 0 THEN 'n ' || event_id ELSE '' END AS text, value / 97 AS score FROM events)"


@query(f"WITH {_READS}, m AS (SELECT user_id, field, min(model) FILTER (text <> '') AS model FROM r GROUP BY 1, 2) SELECT user_id, field, model, text FROM r JOIN m USING (user_id, field, model)")
def first_available_reader(s, d):
    return gates.first_available(_reads(s, d), ["user_id", "field"], "model").select("user_id", "field", "model", "text")


@query(f"""WITH {_READS}, v AS (SELECT *, try_cast(regexp_replace(text, '[^0-9]', '', 'g') AS BIGINT) AS value FROM r), ok AS (SELECT DISTINCT user_id, field FROM v WHERE model = 0 AND value IS NOT NULL AND score >= 0.9)
SELECT user_id, field, model, value FROM v WHERE value IS NOT NULL AND (model = 0 OR (user_id, field) NOT IN (SELECT (user_id, field) FROM ok))""")
def numeric_second_reads(s, d):
    r = _reads(s, d)
    return gates.second_reads(r.select("user_id", "field").distinct(), r, ["user_id", "field"]).select("user_id", "field", "model", "value")


@query("""WITH p AS (SELECT page_id, [{'w': 'vilage', 's': 0.5}, {'w': 'x' || page_id, 's': 0.9}] AS n FROM pages)
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'village' ELSE 'vilage' END || ' x' || page_id AS voted FROM p""")
def words_voted(s, d):
    """Each word of a name, or the better read word of the address that is nearly the same."""
    pair = lambda w, x: F.struct(w.alias("word"), F.lit(x).alias("score"))
    even = F.col("page_id") % 2 == 0
    p = table(s, d, "pages").select(
        "page_id", F.array(pair(F.lit("vilage"), 0.5), pair(F.concat(F.lit("x"), F.col("page_id").cast("string")), 0.95)).alias("name"),
        F.array(pair(F.when(even, "village").otherwise("somewhere"), 0.9)).alias("address"),
    )
    return p.select("page_id", F.array_join(script.over_rows(script.vote_words, "array<string>", "name", "address"), " ").alias("voted"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'word' ELSE 'a word' END AS text FROM pages""")
def edges_trimmed(s, d):
    pair = lambda w, x: F.struct(F.lit(w).alias("word"), x.cast("double").alias("score"))
    p = table(s, d, "pages").select("page_id", F.array(pair("a", F.when(F.col("page_id") % 3 == 0, 0.2).otherwise(0.8)), pair("word", F.lit(0.9)), pair("z", F.lit(0.1))).alias("w"))
    return p.select("page_id", script.over_rows(lambda w: script.trim_edges(w)[0], "string", "w").alias("text"))


@query("""SELECT l_orderkey, list_first(list_filter([a, b, c], lambda z: len(z) BETWEEN 4 AND 5)) IS NOT NULL AS fits, len(coalesce(list_first(list_filter([a, b, c], lambda z: len(z) BETWEEN 4 AND 5)), a)) AS n
FROM (SELECT l_orderkey, range(count(*)) AS a, range(count(*) // 2) AS b, range(count(*) + 2) AS c FROM lineitem GROUP BY 1)""")
def progressive_passes(s, d):
    up_to = lambda n: F.slice(F.sequence(F.lit(0), F.greatest(n, F.lit(1))), 1, n.cast("int"))
    n = F.col("n")
    p = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).select("l_orderkey", F.array(up_to(n), up_to(F.floor(n / 2)), up_to(n + 2)).alias("passes"))
    best = cards.first_pass("passes")
    return p.select("l_orderkey", F.size(best).between(4, 5).alias("fits"), F.size(best).cast("bigint").alias("n"))
