"""Vocabulary, grouping and reporting queries over the driver's tables, with SQL for the same rows where SQL has them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import script, text
from ..operators import audit, grouping, reporting, restore, vocab
from .relational import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


_TOKENS = """t AS (SELECT unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS token FROM documents SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id)),
v AS (SELECT token, count(*) AS n FROM t WHERE length(token) >= 2 GROUP BY 1)"""


def _vocabulary(s, d):
    rows = table(s, d, "documents").select("doc_id", "text").join(table(s, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return vocab.build_vocabulary(rows, ["text"], F.col("quality") == 1)


@query(f"WITH {_TOKENS} SELECT token, n FROM v")
def token_vocab(s, d):
    return _vocabulary(s, d)


_FIXES = _TOKENS + """, s AS (SELECT token AS target, n AS m FROM v WHERE n >= 8), tot AS (SELECT sum(n) AS total FROM v),
k AS (SELECT DISTINCT target, m, substr(target, 1, i - 1) || substr(target, i + 1) AS key FROM (SELECT *, unnest(range(1, length(target))) AS i FROM s)),
p AS (SELECT DISTINCT v.token, v.n, k.target, k.m FROM v JOIN k ON k.key = v.token, tot WHERE total >= 4000 AND v.n <= 4 AND length(v.token) >= 3 AND k.target <> v.token AND k.m >= 6 * greatest(v.n, 1)),
r AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY m DESC, target DESC) AS q, lead(m) OVER (PARTITION BY token ORDER BY m DESC, target DESC) AS nx FROM p),
fx AS (SELECT token, target AS fixed FROM r WHERE q = 1 AND (nx IS NULL OR m >= 2 * nx))"""


@query(f"WITH {_FIXES} SELECT token, fixed FROM fx")
def vocab_repair(s, d):
    return vocab.corrections(_vocabulary(s, d))


@query(f"""WITH {_FIXES}, d AS (SELECT doc_id, text, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM documents),
x AS (SELECT doc_id, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM d),
y AS (SELECT doc_id, string_agg(coalesce(fixed, token), ' ' ORDER BY pos) AS ft, coalesce(string_agg(token || '>' || fixed, '; ' ORDER BY pos) FILTER (fixed <> token), '') AS changes FROM x LEFT JOIN fx USING (token) GROUP BY 1)
SELECT doc_id, sha256(CASE WHEN coalesce(changes, '') <> '' THEN ft ELSE text END) AS text_sha256, coalesce(changes, '') AS changes, coalesce(changes, '') <> '' AS vocab_fixed FROM d LEFT JOIN y USING (doc_id)""")
def vocab_apply(s, d):
    rows = table(s, d, "documents").select("doc_id", "text")
    return vocab.apply_corrections(rows, "doc_id", "text", vocab.corrections(_vocabulary(s, d))).select("doc_id", F.sha2("text", 256).alias("text_sha256"), "changes", "vocab_fixed")


@query("""WITH w AS (SELECT lang, unnest(list_distinct(list_slice(list_filter(string_split(text, ' '), lambda x: x <> ''), 1, 3))) AS word FROM documents), t AS (SELECT lang, count(*) AS total FROM documents GROUP BY 1)
SELECT lang, word, count(*) AS n FROM w JOIN t USING (lang) GROUP BY lang, word, total HAVING count(*) >= greatest(8, floor(total * 0.02))""")
def common_leading_words(s, d):
    return grouping.common_leading_words(table(s, d, "documents").select("lang", "text"), "lang", "text")


@query("""WITH n AS (SELECT c_nationkey AS k, c_mktsegment AS v, count(*) AS n, min(c_custkey) AS o FROM customer WHERE c_custkey % 7 <> 0 GROUP BY 1, 2), m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, o) AS q FROM n) WHERE q = 1 AND n >= 3)
SELECT c_custkey, coalesce(m.v, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END) AS segment, m.v IS NOT NULL AND m.v IS DISTINCT FROM CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS replaced FROM customer LEFT JOIN m ON k = c_nationkey""")
def majority_with_floor(s, d):
    c = table(s, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("segment"))
    return reporting.majority(c, "c_nationkey", "segment", "c_custkey").select("c_custkey", "segment", "replaced")


@query("""WITH x AS (SELECT o_custkey, l_quantity::BIGINT AS q FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey)
SELECT o_custkey, sum(q)::BIGINT AS q, CASE WHEN count(q) < count(*) THEN 'verify' ELSE '' END AS match_check FROM x GROUP BY 1""")
def group_sum_incomplete(s, d):
    x = table(s, d, "orders").join(table(s, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_custkey", F.col("l_quantity").cast("bigint").alias("q"))
    return reporting.sum_with_gaps(x, ["o_custkey"], ["q"])


@query("SELECT l_orderkey, l_linenumber, sum(l_quantity::BIGINT)::BIGINT AS q, count(*) > 1 AS multiple_summed FROM lineitem GROUP BY 1, 2")
def supplements_summed(s, d):
    x = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q"))
    return reporting.sum_supplements(x, ["l_orderkey", "l_linenumber"], "q")


@query("""SELECT p_brand, p_name FROM (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, length(p_name) DESC, p_name) AS q FROM part GROUP BY 1, 2) WHERE q = 1""")
def usual_name(s, d):
    return reporting.usual_name(table(s, d, "part"), "p_brand", "p_name")


@query("""SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ', ' ORDER BY o_orderkey) AS parts, count(*)::INT AS n_parts, coalesce(string_agg(o_orderkey::VARCHAR, ', ' ORDER BY o_orderkey) FILTER (o_orderstatus = 'P'), '') AS parts_to_check FROM orders GROUP BY 1""")
def part_list(s, d):
    return reporting.part_list(table(s, d, "orders"), "o_custkey", "o_orderkey", F.col("o_orderstatus") == "P")


_BLOCK = ", ".join(f"sum(l_quantity::BIGINT) FILTER (l_returnflag = '{g}'{f})::BIGINT AS {g}_{m}" for g in "ANR" for m, f in (("O", " AND l_linestatus = 'O'"), ("F", " AND l_linestatus = 'F'"), ("total", "")))


@query(f"SELECT l_suppkey, {_BLOCK} FROM lineitem GROUP BY 1")
def count_blocks_pivot(s, d):
    x = table(s, d, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("q"))
    return reporting.count_blocks(x, "l_suppkey", "l_returnflag", ["A", "N", "R"], "l_linestatus", ["O", "F"], "q")


@query("""SELECT old, new, count(*) AS n FROM (SELECT o_orderpriority AS old, CASE WHEN o_orderkey % 3 = 0 THEN '1-URGENT' ELSE o_orderstatus END AS new FROM orders) WHERE old IS DISTINCT FROM new GROUP BY 1, 2 ORDER BY n DESC, old, new LIMIT 40""")
def change_tally(s, d):
    c = table(s, d, "orders").select(F.col("o_orderpriority").alias("old"), F.when(F.col("o_orderkey") % 3 == 0, "1-URGENT").otherwise(F.col("o_orderstatus")).alias("new"))
    return reporting.change_tally(c, "old", "new")


@query("""WITH p AS (SELECT o_orderpriority AS u, o_custkey % 10 AS part, count(*) AS rows, count(*) FILTER (o_orderstatus = 'P') AS flagged FROM orders GROUP BY 1, 2)
SELECT u, sum(rows)::BIGINT AS rows, sum(flagged)::BIGINT AS flagged, string_agg(part || ':' || rows || ':' || flagged, ',' ORDER BY part) AS per_part FROM p GROUP BY 1""")
def run_info_json(s, d):
    o = table(s, d, "orders").select(F.col("o_orderpriority").alias("u"), (F.col("o_custkey") % 10).alias("part"), "o_orderstatus")
    info = reporting.run_info(o, "u", "part", F.col("o_orderstatus") == "P")
    j = F.from_json("info", "rows bigint, flagged bigint, per_part array<struct<part: bigint, rows: bigint, flagged: bigint>>")
    per = F.array_join(F.transform("j.per_part", lambda x: F.concat_ws(":", x["part"].cast("string"), x["rows"].cast("string"), x["flagged"].cast("string"))), ",")
    return info.select("u", j.alias("j")).select("u", "j.rows", "j.flagged", per.alias("per_part"))


def _titles(s, d):
    """Page titles' first words as place names, forty pages a unit, of which one in four lost a letter and one in three its spaces."""
    t = F.array_join(F.slice(F.filter(F.split(F.regexp_extract("html", "<title>([^<]*)", 1), r"[ ,.]+"), lambda x: x != ""), 1, 3), " ")
    p = table(s, d, "pages").select("page_id", F.floor(F.col("page_id") / 40).alias("unit"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("copy"), t.alias("name"))
    hurt = F.when(F.col("copy") == 6, F.concat(F.substring("name", 1, 4), F.substring("name", 6, 99))).when(F.col("copy") == 7, F.replace("name", F.lit(" "), F.lit(""))).otherwise(F.col("name"))
    return p.withColumn("name", hurt)


@query()
def canonical_spelling(s, d):
    return vocab.canonical_spellings(_titles(s, d), "name")


@query()
def booth_grouping(s, d):
    p = _titles(s, d).where("copy in (0, 6)").withColumn("part", (F.col("page_id") * 3 + F.col("copy")).cast("int"))
    return grouping.group_buildings(p, "unit", "part", "name")


#: Names as readers give them, and as they were written.
DAMAGED = {
    "धमेन्द्र": "धर्मेन्द्र", "मता देवी": "ममता देवी", "नाम मः राम": "राम", "सपनाे": "सपना", ": सुरेनत्र": "सुरेन्द्र", "हरेद्र": "हरेन्द्र",
    "लक्मी": "लक्ष्मी", "पुष्षा": "पुष्पा", "मुन्री": "मुन्नी", "राम DELETED": "राम", "उ्मिला": "उर्मिला", "महन्री": "महेन्द्री", "सीता": "सीता",
}


def _pairs_sql(pairs: dict[str, str]) -> str:
    return "(VALUES " + ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(pairs.items())) + ")"


def _given(s, d, pairs: dict[str, str]):
    """Customers with one of the given words each."""
    word = F.element_at(F.array(*map(F.lit, pairs)), (F.col("c_custkey") % len(pairs) + 1).cast("int"))
    return table(s, d, "customer").select("c_custkey", word.alias("word"))


@query(f"SELECT c_custkey, b AS cleaned FROM customer JOIN {_pairs_sql(DAMAGED)} v(i, a, b) ON i = c_custkey % {len(DAMAGED)}")
def name_rules_distinct(s, d):
    """Cleaning rules run once per distinct value."""
    return script.per_value(_given(s, d, DAMAGED), "word", "cleaned", script.clean_name).select("c_custkey", "cleaned")


#: Labels of summary rows, and their kinds.
LABELS = {"नेट इलेक्टर": "net", "लिंग अनुपात": "diff", "परिवर्धन सूची": "add", "वि लोपन": "del", "मूल निर्वाचक": "mool", "नामावली": "mool", "नामावली का प्रकार": "", "योग": ""}


@query(f"SELECT c_custkey, b AS kind FROM customer JOIN {_pairs_sql(LABELS)} v(i, a, b) ON i = c_custkey % {len(LABELS)}")
def row_labels(s, d):
    return _given(s, d, LABELS).select("c_custkey", F.coalesce(text.classify("word", text.ROW_LABELS), F.lit("")).alias("kind"))


@query("SELECT c_custkey, 'ab' || right(c_name, 2) AS repaired FROM customer")
def glyphs_repaired(s, d):
    """Characters with their widths, the first two of which stand there twice, once without a width."""
    glyph = lambda c, w: F.struct(c.alias("c"), F.lit(w).alias("w"))
    tail = [F.substr(F.right("c_name", F.lit(2)), F.lit(i), F.lit(1)) for i in (1, 2)]
    g = F.array(*[glyph(F.lit(c), w) for c, w in (("a", 0.0), ("b", 0.0), ("a", 5.0), ("b", 5.0))], *[glyph(t, 4.0) for t in tail])
    return table(s, d, "customer").select("c_custkey", g.alias("g")).select("c_custkey", script.over_rows(script.drop_doubled_glyphs, "string", "g").alias("repaired"))


#: Words of a lexicon, and tokens that lost letters with the word that they were (or stay).
LEXICON = "त्यागी माध्यमिक गोवर्धन नम्बर इण्टर इन्टर विद्यालय".split()
LOST = {"यागी": "त्यागी", "माधिमक": "माध्यमिक", "गोवधन": "गोवर्धन", "नबर": "नम्बर", "इटर": "इटर", "योगी": "योगी", "नम्बर": "नम्बर", "विदयालय": "विद्यालय", "न१र": "न१र"}


@query(f"SELECT c_custkey, a AS word, b AS restored FROM customer JOIN {_pairs_sql(LOST)} v(i, a, b) ON i = c_custkey % {len(LOST)}")
def restored_words(s, d):
    t = _given(s, d, LOST).withColumn("unit", F.col("c_custkey") % 5)
    known = s.createDataFrame([(w, i) for i, w in enumerate(LEXICON)], "word string, place int")
    fixes = restore.restore(t.select("unit", F.col("word").alias("token")), known).withColumnRenamed("token", "word")
    return t.join(fixes, ["unit", "word"], "left").select("c_custkey", "word", F.coalesce("fixed", "word").alias("restored"))


@query("SELECT user_id, event_type AS status, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def stream_latest_status(s, d):
    """The streaming latest-status operator, run over the table as one available-now batch."""
    from ..streaming import events

    return events.latest_status_of(s, f"{d}/events.parquet")


@query("SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(s, d):
    from ..streaming import events

    return events.daily_counts_of(s, f"{d}/events.parquet")


@query("""SELECT c_custkey, l_orderkey AS k, n FROM customer JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON c_custkey = l_orderkey""")
def external_key_match(s, d):
    """Two registers matched by their identifiers."""
    n = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return table(s, d, "customer").join(n, F.col("c_custkey") == F.col("k")).select("c_custkey", "k", "n")


@query("""SELECT o_orderkey, line.l_linenumber AS first_line FROM orders JOIN (SELECT l_orderkey, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1) line ON l_orderkey = o_orderkey WHERE o_orderstatus IN ('F', 'P') AND line.l_linenumber >= 3""")
def body_and_status_filter(s, d):
    line = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("first_line")).where("first_line >= 3")
    return table(s, d, "orders").where(F.col("o_orderstatus").isin("F", "P")).join(line, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", "first_line")


@query("""SELECT count(*) AS rows, count(DISTINCT doc_id) AS docs, count(*) FILTER (n_chars >= 1000) AS long_docs, round(avg((n_chars >= 1000)::INT), 6) AS rate, median(n_chars) AS mid FROM documents""")
def folder_totals(s, d):
    t = table(s, d, "documents")
    by_size = t.groupBy("n_chars").agg(F.count(F.lit(1)).alias("n"))  # the median of sizes with counts: no task holds all rows
    long = F.sum(F.when(F.col("n_chars") >= 1000, F.col("n")).otherwise(0))
    sizes = by_size.agg(F.lit(1).alias("one"), F.sum("n").alias("rows"), long.alias("long_docs"), F.round(long / F.sum("n"), 6).alias("rate"), F.percentile("n_chars", 0.5, F.col("n")).alias("mid"))
    return sizes.join(t.agg(F.lit(1).alias("one"), F.count_distinct("doc_id").alias("docs")), "one").drop("one")


@query("SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 49 INTERSECT SELECT p_partkey FROM part WHERE p_size < 25")
def set_intersection(s, d):
    return table(s, d, "lineitem").where("l_quantity > 49").select("l_partkey").intersect(table(s, d, "part").where("p_size < 25").select("p_partkey"))


@query("""SELECT a.o_orderkey, a.o_custkey FROM orders a ANTI JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') b ON a.o_custkey = b.o_custkey""")
def incremental_backfill(s, d):
    o = table(s, d, "orders")
    return audit.todo(o.select("o_orderkey", "o_custkey"), o.where("o_orderstatus = 'P'").select("o_custkey").distinct(), ["o_custkey"])
