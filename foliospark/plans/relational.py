"""Audit, state, sequence, constraint and reading queries over the driver's tables, with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as X
from ..operators import audit, constraints, layout, readings, sequence

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(s, d):
    return table(s, d, "lineitem").select(F.col("l_orderkey").alias("ac"), F.col("l_linenumber").alias("part"))


def _manifest(s, d):
    return _lines(s, d).groupBy("ac").agg(F.max("part").alias("n"))


@query("""WITH m AS (SELECT l_orderkey ac, max(l_linenumber) n FROM lineitem GROUP BY 1), e AS (SELECT ac, unnest(range(1, n + 1))::INT part FROM m)
SELECT ac, part, 'missing' AS reason FROM e ANTI JOIN (SELECT DISTINCT l_orderkey ac, l_linenumber part FROM lineitem) USING (ac, part)""")
def manifest_missing_parts(s, d):
    return audit.missing_parts(audit.expand_manifest(_manifest(s, d), "ac", "n"), _lines(s, d), ["ac", "part"])


@query("""WITH p AS (SELECT l_orderkey ac, l_linenumber part, max((l_quantity >= 10)::INT) ok FROM lineitem GROUP BY 1, 2), m AS (SELECT l_orderkey ac, max(l_linenumber) n FROM lineitem GROUP BY 1), e AS (SELECT ac, unnest(range(1, n + 1))::INT part FROM m)
SELECT ac, part, CASE WHEN ok IS NULL THEN 'missing' ELSE 'invalid_or_corrupt' END AS reason FROM e LEFT JOIN p USING (ac, part) WHERE ok IS NULL OR ok = 0""")
def manifest_invalid_parts(s, d):
    inv = table(s, d, "lineitem").select(F.col("l_orderkey").alias("ac"), F.col("l_linenumber").alias("part"), (F.col("l_quantity") >= 10).alias("ok"))
    return audit.missing_parts(audit.expand_manifest(_manifest(s, d), "ac", "n"), inv, ["ac", "part"], "ok")


@query("""WITH m AS (SELECT l_orderkey ac, count(DISTINCT l_linenumber) n FROM lineitem GROUP BY 1)
SELECT DISTINCT l_orderkey ac, l_linenumber part, n FROM lineitem JOIN m ON l_orderkey = ac WHERE l_linenumber > n""")
def manifest_extra_parts(s, d):
    m = _lines(s, d).groupBy("ac").agg(F.count_distinct("part").alias("n"))
    return audit.extra_parts(_lines(s, d), m, "ac", "part", "n")


@query("""WITH m AS (SELECT l_orderkey ac, max(l_linenumber) n FROM lineitem GROUP BY 1), e AS (SELECT ac, unnest(range(1, n + 1)) part FROM m),
x AS (SELECT e.*, c_mktsegment segment, f.ac IS NOT NULL f FROM e JOIN orders ON ac = o_orderkey JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT DISTINCT l_orderkey ac, l_linenumber part FROM lineitem) f USING (ac, part)),
u AS (SELECT segment, ac, count(*) expected, sum(f::INT) found FROM x GROUP BY 1, 2)
SELECT segment, sum(expected)::BIGINT expected, sum(found)::BIGINT found, sum(expected - found)::BIGINT missing, count(*) FILTER (expected = found) complete_units, count(*) FILTER (expected > found) incomplete_units, grouping(segment)::INT is_total FROM u GROUP BY ROLLUP (segment)""")
def completeness_rollup(s, d):
    e = audit.expand_manifest(_manifest(s, d), "ac", "n")
    who = table(s, d, "orders").join(table(s, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderkey").alias("ac"), F.col("c_mktsegment").alias("segment"))
    return audit.completeness(e.join(who, "ac"), _lines(s, d), "ac", ["ac", "part"], "segment")


@query("""WITH c AS (SELECT c_nationkey k, CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE count(*) END n FROM customer WHERE c_nationkey < 20 GROUP BY 1), o AS (SELECT n_nationkey k, n_regionkey * 10 n FROM nation WHERE n_nationkey % 2 = 0)
SELECT coalesce(c.k, o.k) AS k, coalesce(c.n, o.n)::BIGINT AS n, c.n IS NULL AND o.n IS NOT NULL AS filled FROM c FULL JOIN o ON c.k = o.k""")
def override_fill(s, d):
    c = table(s, d, "customer").where("c_nationkey < 20").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    c = c.withColumn("n", F.when(F.col("k") % 3 != 0, F.col("n")))
    o = table(s, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("k"), (F.col("n_regionkey") * 10).cast("bigint").alias("n"))
    return audit.fill_counts(c, o, "k", "n")


def _run(s, d):
    return table(s, d, "events").select("user_id", F.col("event_type").alias("status"), "event_id", "ts", "value")


@query("""SELECT user_id, status, event_id, value FROM (SELECT user_id, event_type status, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r = 1 AND status = 'error'""")
def failure_current_state(s, d):
    return audit.latest(_run(s, d), ["user_id"], ["ts", "event_id"]).where("status = 'error'").drop("ts")


@query("""WITH l AS (SELECT user_id, event_type status, event_id, ts < TIMESTAMP '2024-01-15' b, row_number() OVER (PARTITION BY user_id, ts < TIMESTAMP '2024-01-15' ORDER BY ts DESC, event_id DESC) r FROM events),
a AS (SELECT * FROM l WHERE b AND r = 1 AND status IN ('error', 'view')), z AS (SELECT * FROM l WHERE NOT b AND r = 1)
SELECT coalesce(z.user_id, a.user_id) user_id, coalesce(z.status, a.status) status, coalesce(z.event_id, a.event_id) event_id, CASE WHEN z.user_id IS NULL THEN 'unchanged' WHEN a.user_id IS NULL THEN 'new' ELSE 'updated' END AS change
FROM a FULL JOIN z ON a.user_id = z.user_id WHERE z.user_id IS NULL OR z.status IN ('error', 'view')""")
def failure_upsert_two_runs(s, d):
    cut = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    bad = ("error", "view")
    before = audit.latest(_run(s, d).where(cut), ["user_id"], ["ts", "event_id"]).where(F.col("status").isin(*bad))
    run = audit.latest(_run(s, d).where(~cut), ["user_id"], ["ts", "event_id"])
    return audit.upsert_state(before, run, ["user_id"], bad, ["status", "event_id"])


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY 1")
def run_counters(s, d):
    return audit.run_summary(_run(s, d))


@query("SELECT doc_id, source FROM documents ANTI JOIN labels USING (doc_id)")
def resume_todo(s, d):
    return audit.todo(table(s, d, "documents").select("doc_id", "source"), table(s, d, "labels"), ["doc_id"])


@query("SELECT p_partkey FROM part WHERE p_size <= 3 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 40")
def subset_not_found(s, d):
    have = table(s, d, "lineitem").where("l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return audit.todo(table(s, d, "part").where("p_size <= 3").select("p_partkey").distinct(), have.distinct(), ["p_partkey"])


@query("""WITH n AS (SELECT o_custkey, count(*) n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey, count(*) n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT o_custkey, sum(n)::BIGINT n FROM (SELECT * FROM n UNION ALL SELECT * FROM b) GROUP BY 1""")
def counter_bag_union(s, d):
    o = table(s, d, "orders")
    n = lambda st: o.where(F.col("o_orderstatus") == st).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return audit.bag_union(n("F"), n("O"), "o_custkey", "n")


@query("""SELECT o_orderkey, 'old' AS src FROM orders WHERE o_orderkey % 5 <> 0 AND o_custkey % 2 = 0 UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderkey % 5 = 0""")
def key_upsert_append(s, d):
    o = table(s, d, "orders")
    old = o.where("o_custkey % 2 = 0").select("o_orderkey", F.lit("old").alias("src"))
    return audit.replace_keys(old, o.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("new").alias("src")), ["o_orderkey"])


_ID = """CASE WHEN length(t) = 10 THEN translate(substr(t, 1, 3), '0158264', 'OISBZGA') || translate(substr(t, 4, 7), 'OILSBZGDQ', '011582600') ELSE t END"""


@query(f"""WITH r AS (SELECT c_custkey, 'a5z' || CASE WHEN c_custkey % 2 = 0 THEN '-' ELSE '' END || replace(right(c_name, 7), '1', CASE WHEN c_custkey % 3 = 0 THEN 'I' ELSE '1' END) AS raw FROM customer),
u AS (SELECT *, regexp_replace(upper(raw), '[^A-Z0-9]', '', 'g') t FROM r)
SELECT c_custkey, raw, {_ID} AS fixed, coalesce(regexp_matches({_ID}, '^[A-Z]{{3}}[0-9]{{7}}$'), false) AS valid FROM u""")
def id_repair_and_format(s, d):
    raw = F.concat(F.lit("a5z"), F.when(F.col("c_custkey") % 2 == 0, "-").otherwise(""), F.replace(F.right("c_name", F.lit(7)), F.lit("1"), F.when(F.col("c_custkey") % 3 == 0, "I").otherwise("1")))
    return table(s, d, "customer").select("c_custkey", raw.alias("raw")).withColumn("fixed", X.repair_id("raw")).withColumn("valid", X.is_id("fixed"))


@query("""SELECT page_id, try_cast(regexp_extract(url, '([0-9]+)', 1) AS BIGINT) AS number, regexp_extract(url, '/([a-z]{2})/', 1) AS lang FROM pages""")
def key_from_name(s, d):
    return table(s, d, "pages").select("page_id", X.key_number("url").alias("number"), F.regexp_extract("url", "/([a-z]{2})/", 1).alias("lang"))


def _serials(s, d):
    """Turns, with one in seven unread and one in eleven read as another number."""
    c = table(s, d, "conversations").select("conv_id", "turn", "role")
    h = (F.col("conv_id") * 7 + F.col("turn") * 13) % 77
    return c.withColumn("read", F.when(h % 7 == 0, F.lit(None)).when(h % 11 == 0, F.col("turn") + 5).otherwise(F.col("turn") + 1))


_SERIALS = """s AS (SELECT conv_id, turn, role, CASE WHEN ((conv_id * 7 + turn * 13) % 77) % 7 = 0 THEN NULL WHEN ((conv_id * 7 + turn * 13) % 77) % 11 = 0 THEN turn + 5 ELSE turn + 1 END AS read FROM conversations)"""


@query(f"""WITH {_SERIALS} SELECT conv_id, turn, read, coalesce(read <> last_value(read IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, false) AS gap FROM s""")
def serial_gap_carry(s, d):
    return _serials(s, d).select("conv_id", "turn", "read", sequence.gap_after_last_known("read", ["conv_id"], ["turn"]).alias("gap"))


@query(f"""WITH {_SERIALS} SELECT conv_id, turn, read, coalesce(lag(role) OVER w = role AND read <> lag(read) OVER w + 1, false) AS gap FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def serial_gap_strict(s, d):
    return _serials(s, d).select("conv_id", "turn", "read", sequence.gap_after_previous("read", "role", ["conv_id"], ["turn"]).alias("gap"))


_EVENT_SERIALS = """s AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k, count(*) OVER (PARTITION BY user_id) AS m FROM events),
r AS (SELECT *, CASE WHEN (event_id * 31 % 97) % 8 = 0 THEN NULL WHEN (event_id * 31 % 97) % 6 = 0 THEN k % 10 WHEN k > 40 THEN k + 101 ELSE k + 1 END AS read FROM s), o AS (SELECT *, read - k AS o FROM r)"""


def _repair_sql(source: str, out: str) -> str:
    """``out`` is ``source`` (``user_id, k, m, o, read``) with ``corrected`` and ``fixed``."""
    return f"""{out}_n AS (SELECT a.user_id, a.k, b.k AS bk, b.o FROM {source} a JOIN {source} b ON a.user_id = b.user_id AND b.k BETWEEN a.k - 6 AND a.k + 6 AND b.k <> a.k AND b.o IS NOT NULL),
{out}_c AS (SELECT user_id, k, o, count(*) AS n, min(bk) AS p, count(*) FILTER (bk BETWEEN k - 4 AND k - 1) AS l, count(*) FILTER (bk BETWEEN k + 1 AND k + 4) AS r FROM {out}_n GROUP BY 1, 2, 3),
{out}_t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY n DESC, p) AS q FROM {out}_c) WHERE q = 1),
{out}_f AS (SELECT o.*, t.o + o.k AS better, coalesce(t.n >= 3 AND o.o IS DISTINCT FROM t.o AND t.l >= least(2, o.k) AND t.r >= least(2, o.m - 1 - o.k) AND t.l + t.r >= 3 AND t.o + o.k >= 1, false) AS corrected FROM {source} o LEFT JOIN {out}_t t USING (user_id, k)),
{out} AS (SELECT *, CASE WHEN corrected THEN better ELSE read END AS fixed FROM {out}_f)"""


@query(f"WITH {_EVENT_SERIALS}, {_repair_sql('o', 'f')} SELECT user_id, event_id, read, corrected, fixed FROM f")
def serial_repair(s, d):
    return sequence.repair_serials(_event_serials(s, d), "read", ["user_id"], ["k"]).select("user_id", "event_id", "read", "corrected", "fixed")


def _event_serials(s, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(s, d, "events").select("user_id", "event_id", "ts", (F.row_number().over(w) - 1).cast("bigint").alias("k"))
    h = F.col("event_id") * 31 % 97
    return e.withColumn("read", F.when(h % 8 == 0, F.lit(None)).when(h % 6 == 0, F.col("k") % 10).when(F.col("k") > 40, F.col("k") + 101).otherwise(F.col("k") + 1))


@query(f"""WITH {_EVENT_SERIALS}, {_repair_sql('o', 'f')},
a AS (SELECT user_id, event_id, k, m, coalesce(fixed IS DISTINCT FROM read AND fixed IS NOT NULL AND event_id % 4 > 0 AND k + 1 = fixed AND (event_id % 10) / 10.0 >= 0.5, false) AS reread, fixed, read FROM f),
b AS (SELECT user_id, event_id, k, m, reread, CASE WHEN reread THEN fixed ELSE read END AS read FROM a), c AS (SELECT *, read - k AS o FROM b), {_repair_sql('c', 'g')}
SELECT user_id, event_id, read, reread, corrected, fixed FROM g""")
def serial_reread(s, d):
    """A second reading of three in four cards says the place in the list."""
    e = _event_serials(s, d)
    again = e.where("event_id % 4 > 0").select("event_id", F.lit(1).alias("ord"), (F.col("k") + 1).alias("read"), ((F.col("event_id") % 10) / 10.0).alias("score"))
    return sequence.reread_serials(e, again, "event_id", "read", ["user_id"], ["k"]).select("user_id", "event_id", "read", "reread", "corrected", "fixed")


@query("""WITH v AS (SELECT DISTINCT l_orderkey ac, l_linenumber p FROM lineitem), g AS (SELECT *, p - row_number() OVER (PARTITION BY ac ORDER BY p) r FROM v)
SELECT ac, min(p) lo, max(p) hi, count(*) n, floor(avg(p))::BIGINT middle FROM g GROUP BY ac, r HAVING count(*) >= 2""")
def run_islands(s, d):
    return sequence.islands(_lines(s, d).distinct(), "part", ["ac"], 1, 2)


@query("""WITH e AS (SELECT user_id, event_id, ts, event_type IN ('error', 'view') AS miss FROM events), f AS (SELECT *, (sum(miss::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 3)::INT AS full_ FROM e)
SELECT user_id, event_id, miss FROM (SELECT *, coalesce(sum(full_) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM f) WHERE b = 0""")
def probe_cutoff(s, d):
    e = table(s, d, "events").select("user_id", "event_id", "ts", F.col("event_type").isin("error", "view").alias("miss"))
    return sequence.miss_cutoff(e, "miss", ["user_id"], ["ts", "event_id"]).drop("ts")


@query("SELECT source, doc_id, rank::INT AS rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 5")
def limit_n_per_group(s, d):
    return sequence.first_n(table(s, d, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 5)


@query("""SELECT p_partkey, name, (row_number() OVER (PARTITION BY p_size ORDER BY regexp_extract(name, '^[a-z]+ '), (p_partkey % 130), p_partkey))::INT AS place FROM (SELECT *, split_part(p_name, ' ', 1) || ' ' || (p_partkey % 130) AS name FROM part)""")
def natural_sort(s, d):
    p = table(s, d, "part").withColumn("name", F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(1)), (F.col("p_partkey") % 130).cast("string")))
    p = sequence.numbered(p.select("p_partkey", "p_size", "name", X.natural_key("name").alias("k")), ["p_size"], ["k", "p_partkey"], "place")
    return p.select("p_partkey", "name", (F.col("place") + 1).alias("place"))


@query("SELECT doc_id, lang, n_same FROM (SELECT doc_id, lang, count(*) OVER (PARTITION BY text) AS n_same FROM documents) WHERE n_same > 1")
def duplicates_keep_all(s, d):
    k = table(s, d, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("k"))
    return audit.duplicates(k, ["k"]).select("doc_id", "lang", "n_same")


@query("""WITH m AS (SELECT o_custkey, o_orderkey FROM orders), g AS (SELECT *, o_orderkey - lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS g FROM m)
SELECT o_custkey, max(g) AS largest_gap, CASE WHEN max(g) > 5000 THEN 'verify' ELSE '' END AS match_check FROM g GROUP BY 1""")
def largest_gap_check(s, d):
    return sequence.largest_gap(table(s, d, "orders"), "o_orderkey", ["o_custkey"], 5000)


@query("""WITH o AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '' END AS p FROM orders), f AS (SELECT o_custkey, arg_min(p, o_orderkey) AS p_carried FROM o WHERE p <> '' GROUP BY 1)
SELECT o_custkey, o_orderkey, p_carried FROM o LEFT JOIN f USING (o_custkey)""")
def carry_header(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise("").alias("p"))
    return sequence.carry_first(o, "p", ["o_custkey"], ["o_orderkey"]).drop("p")


@query("SELECT o_orderkey, ((row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1) // 1000 + 1)::INT AS chunk FROM orders")
def chunk_split_fixed(s, d):
    return sequence.chunk_fixed(table(s, d, "orders"), ["o_orderstatus"], ["o_orderkey"], 1000).select("o_orderkey", "chunk")


@query("""WITH RECURSIVE p AS (SELECT o_custkey u, o_orderkey part, count(*) n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2), q AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY part) i FROM p),
r AS (SELECT u, part, n, i, 1 AS chunk, CASE WHEN n >= 10 THEN 0 ELSE n END AS held, n >= 10 AS closed FROM q WHERE i = 1
UNION ALL SELECT q.u, q.part, q.n, q.i, r.chunk + r.closed::INT, CASE WHEN r.held + q.n >= 10 THEN 0 ELSE r.held + q.n END, r.held + q.n >= 10 FROM r JOIN q ON q.u = r.u AND q.i = r.i + 1)
SELECT u, part, n, chunk::INT AS chunk FROM r""")
def chunk_split_resetting(s, d):
    """A customer's orders, with their lines, as the parts of a unit."""
    n = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    p = table(s, d, "orders").select(F.col("o_custkey").alias("u"), F.col("o_orderkey").alias("part")).join(n, "part")
    return sequence.chunk_at_boundaries(p, ["u"], "part", "n", 10)


@query("""WITH RECURSIVE q AS (SELECT p_partkey // 200 u, p_partkey y, row_number() OVER (PARTITION BY p_partkey // 200 ORDER BY p_partkey) i FROM part),
r AS (SELECT u, y, i, y AS f, 1 AS row FROM q WHERE i = 1 UNION ALL SELECT q.u, q.y, q.i, CASE WHEN q.y - r.f > 7 THEN q.y ELSE r.f END, CASE WHEN q.y - r.f > 7 THEN r.row + 1 ELSE r.row END FROM r JOIN q ON q.u = r.u AND q.i = r.i + 1)
SELECT u, y, row::INT AS row, (row_number() OVER (PARTITION BY u ORDER BY row, y % 7, y))::INT AS place FROM r""")
def reading_order_rows(s, d):
    p = table(s, d, "part").select(F.floor(F.col("p_partkey") / 200).alias("u"), F.col("p_partkey").alias("y"), (F.col("p_partkey") % 7).alias("x"))
    return sequence.row_clusters(p, ["u"], "y", "x", 14).drop("x")


_CELLS = """c AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, (l_quantity)::INT m, (l_suppkey % 40)::INT f, (l_partkey % 3)::INT t, row_number() OVER () AS rid FROM lineitem),
k AS (SELECT *, m + f + t AS tot FROM c), a AS (SELECT *, CASE WHEN l_partkey % 5 = 0 THEN [m + 30, m] ELSE [m] END AS am, CASE WHEN l_suppkey % 7 = 0 THEN [f + 1, f] WHEN l_suppkey % 11 = 0 THEN []::INT[] ELSE [f] END AS af, [t] AS at_,
  CASE WHEN l_partkey % 13 = 0 THEN [tot - 1, tot] WHEN l_partkey % 17 = 0 THEN [tot + 2] ELSE [tot] END AS ao FROM k)"""


@query(f"""WITH {_CELLS}, x AS (SELECT rid, p, q, r, z FROM a, unnest(am) AS u1(p), unnest(af) AS u2(q), unnest(at_) AS u3(r), unnest(ao) AS u4(z) WHERE p + q + r = z), y AS (SELECT rid, count(*) n, min(p) p, min(q) q, min(r) r, min(z) z FROM x GROUP BY 1),
v AS (SELECT a.*, y.n, y.p, y.q, y.z, CASE WHEN len(af) = 0 THEN 'unreadable' WHEN am[1] + af[1] + at_[1] = ao[1] THEN 'ok' WHEN y.n = 1 THEN 'repaired' ELSE 'mismatch' END AS verdict FROM a LEFT JOIN y USING (rid))
SELECT l_orderkey, l_linenumber, l_partkey, verdict, CASE WHEN verdict = 'repaired' THEN p ELSE am[1] END AS m_value, CASE WHEN verdict = 'repaired' THEN q ELSE af[1] END AS f_value, CASE WHEN verdict = 'repaired' THEN z ELSE ao[1] END AS total_value FROM v""")
def sum_constraint_solver(s, d):
    p, q = F.col("l_partkey"), F.col("l_suppkey")
    c = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("m0"), (q % 40).cast("int").alias("f0"), (p % 3).cast("int").alias("t0"))
    c = c.withColumn("o0", F.col("m0") + F.col("f0") + F.col("t0"))
    c = c.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(p % 5 == 0, F.array(F.col("m0") + 30, "m0")).otherwise(F.array("m0")).alias("m"),
        F.when(q % 7 == 0, F.array(F.col("f0") + 1, "f0")).when(q % 11 == 0, F.array().cast("array<int>")).otherwise(F.array("f0")).alias("f"),
        F.array("t0").alias("t"),
        F.when(p % 13 == 0, F.array(F.col("o0") - 1, "o0")).when(p % 17 == 0, F.array(F.col("o0") + 2)).otherwise(F.array("o0")).alias("total"),
    )
    return constraints.solve_sum(c, ["m", "f", "t"], "total").select("l_orderkey", "l_linenumber", "l_partkey", "verdict", "m_value", "f_value", "total_value")


@query("""WITH b AS (SELECT l_orderkey k, count(*) FILTER (l_returnflag = 'A') a, count(*) FILTER (l_returnflag = 'N') n, nullif(count(*) FILTER (l_returnflag = 'R'), 0) r, count(*) FILTER (l_linestatus = 'O') net FROM lineitem GROUP BY 1)
SELECT k, a + n - coalesce(r, 0) <> net AS net_formula_mismatch FROM b""")
def balance_check(s, d):
    n = lambda c, v: F.count_if(F.col(c) == v)
    b = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(n("l_returnflag", "A").alias("a"), n("l_returnflag", "N").alias("n"), F.nullif(n("l_returnflag", "R"), F.lit(0)).alias("r"), n("l_linestatus", "O").alias("net"))
    return b.select("k", constraints.balance(b, ["a", "n"], ["r"], "net").alias("net_formula_mismatch"))


def _readings(s, d):
    """Events as readings: a card per user and day, a field per event type, score from the value."""
    e = table(s, d, "events")
    return e.select(
        F.concat_ws("_", "user_id", F.dayofmonth("ts")).alias("card"), "event_id", F.col("event_id").alias("ord"), F.col("event_type").alias("text"),
        F.when(F.col("value") > 2, F.least(F.lit(1.0), F.col("value") / 97)).alias("score"), (F.col("event_id") % 2).cast("int").alias("model"),
    )


_READ = "r AS (SELECT user_id || '_' || day(ts) AS card, event_id AS ord, event_type AS text, CASE WHEN value > 2 THEN least(1.0, value / 97) END AS score, (event_id % 2)::INT AS model FROM events)"


@query(f"WITH {_READ} SELECT card, text, score, ord FROM (SELECT card, text, coalesce(score, 0.0) AS score, ord, row_number() OVER (PARTITION BY card ORDER BY coalesce(score, 0.0) DESC, ord) AS q FROM r) WHERE q = 1")
def best_reading(s, d):
    return readings.best(_readings(s, d), ["card"])


@query(f"WITH {_READ} SELECT card, round_even(min(coalesce(score, 0.0)), 3) AS confidence FROM r GROUP BY 1")
def row_confidence(s, d):
    return readings.row_confidence(_readings(s, d), ["card"])


_PLAIN = "FILTER (score >= 0.3 AND text <> '' AND ord % 4 > 0)"


@query(f"WITH {_READ} SELECT card, count(DISTINCT text) {_PLAIN} AS n_texts, count(DISTINCT text) {_PLAIN} > 1 AS disagree FROM r GROUP BY 1")
def reading_disagreement(s, d):
    """One reading in four is of another cut, and does not count."""
    variant = F.get(F.array(F.lit("~2"), F.lit(""), F.lit("#1"), F.lit(None)), (F.col("event_id") % 4).cast("int"))
    return readings.disagreement(_readings(s, d).withColumn("variant", variant), ["card"], 0.3, "variant")


@query(f"WITH {_READ}, v AS (SELECT card, text, max(coalesce(score, 0.0) + CASE WHEN model = 0 THEN 0.001 ELSE 0 END) AS sc FROM r GROUP BY 1, 2) SELECT card, string_agg(text, ',' ORDER BY sc DESC, text) AS candidates FROM v GROUP BY 1")
def cell_candidates(s, d):
    return readings.candidates(_readings(s, d).withColumn("first", F.col("model") == 0), ["card"], "first").select("card", F.array_join("candidates", ",").alias("candidates"))


@query(f"""WITH {_READ}, b AS (SELECT card, model, arg_max({{'t': text, 's': coalesce(score, 0.0)}}, (coalesce(score, 0.0), -ord)) FILTER (score > 0) AS x FROM r GROUP BY 1, 2),
p AS (SELECT card, max(x.s) FILTER (model = 0) ps, max(x.t) FILTER (model = 0) pt, max(x.s) FILTER (model = 1) ss, max(x.t) FILTER (model = 1) st FROM b GROUP BY 1),
a AS (SELECT card, arg_max({{'t': text, 's': score}}, (score, CASE WHEN model = 0 THEN 1 ELSE 0 END, -ord)) FILTER (score > 0) AS x FROM r GROUP BY 1),
c AS (SELECT p.*, a.x, CASE WHEN coalesce(ps, 0) >= 0.5 THEN CASE WHEN coalesce(ss, 0) >= ps + 0.15 THEN 's' ELSE 'p' END WHEN coalesce(ps, 0) > 0 AND coalesce(ss, 0) < ps + 0.15 THEN 'p' ELSE 'x' END AS source FROM p JOIN a USING (card))
SELECT card, source, coalesce(CASE source WHEN 'p' THEN ps WHEN 's' THEN ss ELSE x.s END, 0.0) AS score FROM c""")
def primary_secondary_margin(s, d):
    return readings.pick(_readings(s, d), ["card"]).select("card", "source", "score")


@query(f"WITH {_READ}, b AS (SELECT card, text, coalesce(score, 0.0) AS score, row_number() OVER (PARTITION BY card ORDER BY coalesce(score, 0.0) DESC, ord) AS q FROM r) SELECT r.card, r.ord FROM r SEMI JOIN (SELECT card FROM b WHERE q = 1 AND score < 0.9) w ON w.card = r.card WHERE model = 1")
def second_opinion_gating(s, d):
    r = _readings(s, d)
    b = readings.best(r, ["card"])
    weak = b.where(readings.needs_second_opinion(F.col("text"), F.col("score"))).select("card")
    return r.where("model = 1").join(weak, "card", "left_semi").select("card", "ord")


@query("""WITH b AS (SELECT o_orderkey, 'from ' || strftime(o_orderdate + INTERVAL (o_orderkey % 400) DAY - INTERVAL 0 DAY, '%d-%m-') || '20' || lpad((o_orderkey % 25)::VARCHAR, 2, '0') || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ' to 31/' || lpad((o_orderkey % 14)::VARCHAR, 2, '0') || '/2024 or 01.02.2024' END AS t FROM orders),
x AS (SELECT o_orderkey, t, list_filter(list_transform(regexp_extract_all(t, '[0-9]{2}[^0-9]{0,2}[0-9]{2}[^0-9]{0,2}20[0-9]{2}'), lambda m: try_strptime(regexp_replace(m, '[^0-9]', '', 'g'), '%d%m%Y')), lambda z: z IS NOT NULL) AS ds FROM b)
SELECT o_orderkey, t, CASE WHEN len(ds) >= 2 THEN strftime(ds[1], '%d-%m-%Y') ELSE '' END AS start_date, CASE WHEN len(ds) >= 2 THEN strftime(ds[2], '%d-%m-%Y') ELSE '' END AS end_date FROM x""")
def period_dates(s, d):
    k = F.col("o_orderkey")
    when = F.date_format(F.timestamp_add("DAY", (k % 400).cast("int"), F.col("o_orderdate")), "dd-MM-")
    two = lambda n: F.lpad((k % n).cast("string"), 2, "0")
    t = F.concat(F.lit("from "), when, F.lit("20"), two(25), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit(" to 31/"), two(14), F.lit("/2024 or 01.02.2024"))))
    o = table(s, d, "orders").select("o_orderkey", t.alias("t")).withColumn("p", X.period("t"))
    return o.select("o_orderkey", "t", F.col("p.start").alias("start_date"), F.col("p.end").alias("end_date"))


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'XX1' ELSE 'ABC' || right(c_name, 7) END AS id, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey + (c_custkey % 13 = 0)::INT END AS serial, c_nationkey,
  CASE WHEN c_custkey % 8 = 0 THEN 'uncle' ELSE 'father' END AS relation, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'male' END AS gender, (c_custkey % 130)::VARCHAR AS age, CASE WHEN c_custkey % 5 = 0 THEN 'x' ELSE '12' END AS op, '7' AS os, CASE WHEN c_custkey % 14 = 0 THEN NULL WHEN c_custkey % 15 = 0 THEN c_name || '!' ELSE c_name END AS name, c_acctbal < 0 AS low FROM customer),
g AS (SELECT *, coalesce(serial <> last_value(serial IGNORE NULLS) OVER (PARTITION BY c_nationkey % 1, c_custkey // 100 ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, false) AS gap FROM c)
SELECT c_custkey, array_to_string(list_filter([CASE WHEN gap THEN 'serial_gap' END, CASE WHEN NOT regexp_matches(id, '^[A-Z]{3}[0-9]{7}$') THEN 'epic_format' END, CASE WHEN relation = 'uncle' THEN 'relation_type' END, CASE WHEN gender = '' THEN 'gender' END,
  CASE WHEN NOT age::INT BETWEEN 15 AND 120 THEN 'age' END, CASE WHEN op = 'x' THEN 'old_part_no' END, CASE WHEN name IS NULL THEN 'name_missing' END, CASE WHEN name LIKE '%!' THEN 'name_chars' END, CASE WHEN low THEN 'ocr_low_conf' END], lambda x: x IS NOT NULL), '|') AS review FROM g""")
def validation_flags(s, d):
    k = F.col("c_custkey")
    c = table(s, d, "customer").select(
        "c_custkey", F.when(k % 9 == 0, "XX1").otherwise(F.concat(F.lit("ABC"), F.right("c_name", F.lit(7)))).alias("id"), F.when(k % 10 != 0, k + (k % 13 == 0).cast("int")).alias("serial"), F.floor(k / 100).alias("unit"),
        F.when(k % 8 == 0, "uncle").otherwise("father").alias("relation"), F.when(k % 6 == 0, "").otherwise("male").alias("gender"), (k % 130).cast("string").alias("age"), F.when(k % 5 == 0, "x").otherwise("12").alias("op"), F.lit("7").alias("os"),
        F.when(k % 14 == 0, F.lit(None)).when(k % 15 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")).alias("name"), (F.col("c_acctbal") < 0).alias("low"),
    ).withColumn("gap", sequence.gap_after_last_known("serial", ["unit"], ["c_custkey"]))
    return c.select("c_custkey", F.array_join(constraints.row_checks("id", F.col("gap"), "relation", "gender", "age", "op", "os", "name", F.col("low")), "|").alias("review"))


@query("""WITH l AS (SELECT DISTINCT p_size, floor(p_retailprice / 50) * 50 AS x FROM part)
SELECT p_partkey, min({'d': abs(x - p_retailprice), 'x': x}) FILTER (abs(x - p_retailprice) <= 15).x AS snapped FROM part JOIN l USING (p_size) GROUP BY 1""")
def nearest_snap(s, d):
    """Prices to the nearest of the lines that the prices of their size stand on."""
    p = table(s, d, "part").select("p_partkey", "p_size", "p_retailprice")
    lines = p.select("p_size", (F.floor(F.col("p_retailprice") / 50) * 50).cast("double").alias("line"))
    return layout.cell_of("p_retailprice", lines, p, ["p_size"], 15).select("p_partkey", "snapped")


@query("""SELECT page_id, CASE WHEN instr(t, ':') > 0 THEN trim(substr(t, instr(t, ':') + 1)) ELSE '' END AS after FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)', 1) || CASE WHEN page_id % 2 = 0 THEN ' : part ' || page_id || ':x ' ELSE '' END AS t FROM pages)""")
def page_text_after_colon(s, d):
    t = F.concat(F.regexp_extract("html", "<title>([^<]*)", 1), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" : part "), F.col("page_id").cast("string"), F.lit(":x "))).otherwise(""))
    return table(s, d, "pages").select("page_id", t.alias("t")).select("page_id", X.after_colon("t").alias("after"))


@query("""SELECT page_id, CASE WHEN contains(html, '<table') THEN 'table' WHEN contains(html, '<ul>') AND NOT contains(html, '<footer') THEN 'list' WHEN contains(html, '<article') THEN 'article' END AS kind FROM pages""")
def page_classify(s, d):
    rules = [("table", lambda c: F.contains(c, F.lit("<table"))), ("list", lambda c: F.contains(c, F.lit("<ul>")) & ~F.contains(c, F.lit("<footer"))), ("article", lambda c: F.contains(c, F.lit("<article")))]
    return table(s, d, "pages").select("page_id", X.classify("html", rules).alias("kind"))


@query("""SELECT event_id, (json_extract(props, '$.k'))::INT AS k, floor(epoch(ts))::BIGINT AS second FROM events WHERE event_type = 'error'""")
def event_log_scan(s, d):
    e = table(s, d, "events").where("event_type = 'error'")
    return e.select("event_id", F.from_json("props", "k int")["k"].alias("k"), F.unix_timestamp("ts").alias("second"))


@query("""SELECT p_partkey, CASE WHEN regexp_matches(x, '^[=+@-]') THEN ' ' || x ELSE x END AS cell FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN '=' WHEN 1 THEN '+' WHEN 2 THEN '-' WHEN 3 THEN '@' ELSE '' END || p_name AS x FROM part)""")
def formula_guard(s, d):
    mark = F.element_at(F.array(*[F.lit(x) for x in ("=", "+", "-", "@", "")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    return table(s, d, "part").select("p_partkey", F.concat(mark, "p_name").alias("x")).select("p_partkey", X.safe_cell("x").alias("cell"))


@query("""SELECT p_partkey, CASE WHEN length(x) BETWEEN 1 AND 7 THEN x::INT END AS n, CASE WHEN y BETWEEN 18 AND 120 THEN y END AS age FROM (SELECT p_partkey, regexp_replace(translate(r, 'OoQDlI|iSsBZ', '000011115582'), '[^0-9]', '', 'g') AS x, try_cast(regexp_replace(translate(r, 'Oo', '00'), '[^0-9]', '', 'g') AS INT) AS y FROM (SELECT p_partkey, p_size || CASE WHEN p_partkey % 4 = 0 THEN 'O' WHEN p_partkey % 9 = 0 THEN ' B123456' ELSE 'l' END AS r FROM part))""")
def digit_repair(s, d):
    k = F.col("p_partkey")
    r = F.concat(F.col("p_size").cast("string"), F.when(k % 4 == 0, "O").when(k % 9 == 0, " B123456").otherwise("l"))
    return table(s, d, "part").select("p_partkey", r.alias("r")).select("p_partkey", X.count_digits("r").alias("n"), X.valid_age("r").alias("age"))


@query("""WITH u AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(x) AS y FROM u GROUP BY 1, 2),
s AS (SELECT u.vec_id, c.label, corr(u.x, c.y) AS s FROM u JOIN c USING (i) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label DESC) q FROM s)
SELECT vec_id, max(label) FILTER (q = 1) AS label, round(max(s) FILTER (q = 1), 6) AS score, round(max(s) FILTER (q = 1) - max(s) FILTER (q = 2), 6) AS margin FROM r GROUP BY 1""")
def template_match_margin(s, d):
    e = table(s, d, "embeddings")
    parts = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("y"))
    pix = parts.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "y"))), lambda z: z["y"]).alias("pix"))
    m = readings.template_match(e, pix, "vec_id", "embedding")
    return m.select("vec_id", "label", F.round("score", 6).alias("score"), F.round("margin", 6).alias("margin"))


@query("""WITH w AS (SELECT doc_id AS k, list_filter(regexp_split_to_array(coalesce(text, ''), '\\s+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT k AS id, array_to_string(w, ' ') AS p, (k % 10) / 10.0 AS pc, CASE k % 4 WHEN 0 THEN array_to_string(w[1:greatest(len(w) - 1, 0)], ' ') WHEN 1 THEN array_to_string(w, ' ') WHEN 2 THEN array_to_string(list_prepend(array_to_string(w[1:2], ''), w[3:]), ' ') ELSE array_to_string(w[2:], ' ') END AS t, (k % 7) / 7.0 AS tc FROM w),
v AS (SELECT *, list_filter(string_split(p, ' '), lambda x: x <> '') AS ps, list_filter(string_split(t, ' '), lambda x: x <> '') AS ts, replace(p, ' ', '') = replace(t, ' ', '') AS same FROM p),
l AS (SELECT token, count(*) AS n FROM (SELECT unnest(ps) AS token FROM v WHERE same) GROUP BY 1),
sc AS (SELECT id, e, avg(least(log2(1 + coalesce(n, 0)), 5.0)) AS x FROM (SELECT id, 0 AS e, unnest(ps) AS token FROM v UNION ALL SELECT id, 1, unnest(ts) FROM v) LEFT JOIN l USING (token) GROUP BY 1, 2),
z AS (SELECT v.*, CASE WHEN len(ts) = 0 THEN -99.0 WHEN len(ps) = 0 THEN 99.0 WHEN len(ts) < len(ps) AND ps[1:len(ts)] = ts THEN -99.0
  ELSE 2.0 * (coalesce(b.x, 0) - coalesce(a.x, 0)) + 6.0 * (tc - 0.5) - 3.0 * (pc - 0.95) + 0.3 * greatest(-3, least(3, length(replace(t, ' ', '')) - length(replace(p, ' ', '')))) END AS sco
  FROM v LEFT JOIN sc a ON a.id = v.id AND a.e = 0 LEFT JOIN sc b ON b.id = v.id AND b.e = 1)
SELECT id, CASE WHEN same THEN len(ts) > len(ps) ELSE sco > 0 END AS use_t, NOT same AND abs(sco) < 1.5 AS unsure, round(CASE WHEN same THEN 0.0 ELSE sco END, 6) AS score FROM z""")
def engine_arbitration(s, d):
    """Readings of all words of every text: the first engine reads all; the second loses the last word, reads all, joins
    the first two or loses the first. A text without words gives two empty readings, one of one word may give one."""
    w = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda x: x != "")
    k, size = F.col("doc_id"), F.size("w")
    x = table(s, d, "documents").select("doc_id", w.alias("w"))
    join = lambda c: F.array_join(c, " ")
    after = lambda a: F.slice("w", a, F.greatest(size, F.lit(1)))
    glued = F.concat(F.array(F.array_join(F.slice("w", 1, 2), "")), after(3))
    t = F.when(k % 4 == 0, join(F.slice("w", 1, F.greatest(size - 1, F.lit(0))))).when(k % 4 == 1, join("w")).when(k % 4 == 2, join(glued)).otherwise(join(after(2)))
    p = x.select(k.alias("id"), join("w").alias("p"), ((k % 10) / 10.0).alias("pc"), t.alias("t"), ((k % 7) / 7.0).alias("tc"))
    bare = lambda c: F.replace(F.col(c), F.lit(" "), F.lit(""))
    lex = p.where(bare("p") == bare("t")).select(F.explode(F.split("p", " ")).alias("token")).where("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return readings.arbitrate(p, lex, 1.0).select("id", "use_t", "unsure", F.round("score", 6).alias("score"))


_STATUS = "CASE WHEN event_id % 7 = 0 THEN 'S' WHEN event_id % 5 = 0 AND user_id % 3 = 0 THEN 'R' WHEN event_id % 4 = 0 AND value >= 50 THEN 'E' WHEN value > 60 THEN '?' ELSE '' END"


@query(f"SELECT event_id, {_STATUS} AS code, value > 60 OR {_STATUS} IN ('S', 'R', 'E') AS deleted, concat_ws('|', CASE WHEN {_STATUS} = '?' THEN 'status_letter_unclear' END, CASE WHEN value > 60 AND {_STATUS} NOT IN ('S', 'R', 'E') THEN 'deleted_without_status_code' END) AS why FROM events")
def status_derivation(s, d):
    from ..operators import cards

    i = F.col("event_id")
    e = table(s, d, "events").select(
        "event_id", F.when(i % 7 == 0, "S").otherwise("").alias("marker"), F.when(i % 5 == 0, "R").alias("letter"), (F.col("user_id") % 3).alias("ls"), F.lit(0).alias("serial"),
        F.when(i % 4 == 0, "E").alias("glyph"), (F.col("value") / 100).alias("gs"), F.col("value").alias("stamp"),
    )
    return e.select("event_id", cards.derive_status("marker", "letter", "ls", "serial", "glyph", "gs", "stamp").alias("x")).select("event_id", "x.code", "x.deleted", "x.why")


@query("""WITH a AS (SELECT o_orderkey k, o_custkey % 4 m1, o_orderkey % 4 m2, o_custkey total, CASE WHEN o_orderkey % 9 > 0 THEN 700 END last_serial, o_orderkey % 6 f, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 3 END p, CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE o_orderstatus END name FROM orders)
SELECT k, concat_ws(';', CASE WHEN m1 <> m2 THEN 'm1_differs_from_m2' END, CASE WHEN total > last_serial THEN 'total_exceeds_last_serial' END, CASE WHEN f <> p THEN 'part_number_differs_from_filename' END, CASE WHEN name = '' THEN 'missing_name' END) AS why FROM a""")
def cross_source_flags(s, d):
    from ..operators import cards

    k = F.col("o_orderkey")
    a = table(s, d, "orders").select(
        k.alias("k"), (F.col("o_custkey") % 4).alias("m1"), (k % 4).alias("m2"), F.col("o_custkey").alias("total"), F.when(k % 9 > 0, 700).alias("last_serial"), (k % 6).alias("f"),
        F.when(k % 5 != 0, k % 3).alias("p"), F.when(k % 8 == 0, "").otherwise(F.col("o_orderstatus")).alias("name"),
    )
    return a.select("k", cards.cross_source({"m": "m1"}, {"m": "m2"}, "total", "last_serial", [("part_number_differs_from_filename", "f", "p")], ["name"]).alias("why"))


@query("""SELECT vec_id, round_even(len(list_filter(embedding[5:44], lambda x: x < 0.05)) / (1.5 * 1.5), 0)::INT AS ink FROM embeddings""")
def ink_count(s, d):
    from ..operators import cards

    return table(s, d, "embeddings").select("vec_id", cards.ink(F.col("embedding"), 5, 40, 0.05, 1.5).alias("ink"))


@query("""WITH c AS (SELECT l_orderkey // 100 AS page, l_orderkey * 10 + l_linenumber AS cell_id, (l_partkey % 90)::DOUBLE AS x0, (l_suppkey % 90)::DOUBLE AS y0 FROM lineitem),
s AS (SELECT o_orderkey // 100 AS page, o_orderkey AS span_id, (o_custkey % 100) + 0.5 AS cx, (o_orderkey % 97) + 0.5 AS cy FROM orders)
SELECT page, span_id, cell_id, count(*) AS n FROM s JOIN c USING (page) WHERE cx BETWEEN x0 - 1 AND x0 + 13 AND cy BETWEEN y0 - 1 AND y0 + 9 GROUP BY 1, 2, 3""")
def spans_in_cells(s, d):
    return _spans_in_cells(table(s, d, "lineitem"), table(s, d, "orders"))


def _spans_in_cells(li, orders):
    from ..operators import cards

    c = li.select(F.floor(F.col("l_orderkey") / 100).alias("page"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("cell_id"), (F.col("l_partkey") % 90).cast("double").alias("x0"), (F.col("l_suppkey") % 90).cast("double").alias("y0"))
    c = c.withColumn("x1", F.col("x0") + 12).withColumn("y1", F.col("y0") + 8)
    o = orders.select(F.floor(F.col("o_orderkey") / 100).alias("page"), F.col("o_orderkey").alias("span_id"), (F.col("o_custkey") % 100).cast("double").alias("x0"), (F.col("o_orderkey") % 97).cast("double").alias("y0"))
    o = o.withColumn("x1", F.col("x0") + 1).withColumn("y1", F.col("y0") + 1)
    return cards.spans_in_cells(o, c, "page", 10).groupBy("page", "span_id", "cell_id").agg(F.count(F.lit(1)).alias("n"))


@query()
def house_resolution(s, d):
    from ..operators import cards

    e = table(s, d, "events")
    i = F.col("event_id")
    text = F.when(i % 11 == 0, F.concat((i % 50).cast("string"), F.lit(" /"))).when(i % 7 == 0, "$$").otherwise((F.col("user_id") % 20).cast("string"))
    r = e.select("user_id", i.alias("ord"), text.alias("text"), (F.col("value") / 100).alias("score"), F.when(i % 2 == 0, "hi").otherwise("en").alias("source"))
    return cards.resolve_house(r, ["user_id"])
