"""Named queries over the star schema, each with the same question in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.functions import fixed
from evidentia.functions import text as tx
from evidentia.operators import alignment as al
from evidentia.operators import attribution as at
from evidentia.operators import backtest as bt
from evidentia.operators import claims as cl
from evidentia.operators import crowding as cr
from evidentia.operators import matching as mt
from evidentia.operators import moves as mv
from evidentia.operators import report as rp
from evidentia.operators import resolve as rs
from evidentia.operators import screen as sc
from evidentia.sources import files, rest, shared
from evidentia.streaming import state as st

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(f"""SELECT subject, earliest, sponsors, kinds, n_claims, row_number() OVER (ORDER BY earliest DESC, sponsors, subject) AS rank FROM (
SELECT l_partkey AS subject, CAST(min(l_shipdate) AS DATE) AS earliest, count(DISTINCT l_suppkey) AS sponsors, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS kinds, count(*) AS n_claims FROM lineitem GROUP BY 1)""")
def emerging_rank(spark, d):
    rows = t(spark, d, "lineitem").select(F.col("l_partkey").alias("subject"), "l_suppkey", F.to_date("l_shipdate").alias("day"), "l_returnflag")
    out = cl.emerging(rows, "subject", "l_suppkey", "day", "l_returnflag")
    return cl.ranked(out, F.col("earliest").desc(), F.col("sponsors"), F.col("subject"))


@query(f"SELECT l_partkey, count(DISTINCT l_returnflag) AS n_kinds FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def corroborated(spark, d):
    return cl.corroborated(t(spark, d, "lineitem"), "l_partkey", "l_returnflag")


_CLAIMS = """SELECT *, substr(sha1(concat_ws('|', source, source_record_id, evidence_type, subject)), 1, 16) AS claim_key FROM (
SELECT CAST(o_custkey AS VARCHAR) AS subject, 'order' AS evidence_type, 'orders' AS source, CAST(o_orderkey AS VARCHAR) AS source_record_id, o_orderpriority AS actor, CAST(o_orderdate AS DATE) AS valid_time, DATE '2002-01-01' AS observed_at, 'A' AS path FROM orders
UNION ALL SELECT CAST(user_id AS VARCHAR), event_type, 'events', CAST(event_id AS VARCHAR), '', CAST(ts AS DATE), DATE '2024-02-01', 'B' FROM events)"""


def _claims(spark, d):
    o, e = t(spark, d, "orders"), t(spark, d, "events")
    a = cl.build(o, subject=F.col("o_custkey"), evidence_type=F.lit("order"), source=F.lit("orders"), record=F.col("o_orderkey"), actor=F.col("o_orderpriority"), valid_time=F.col("o_orderdate"), observed_at=F.lit("2002-01-01"), path=F.lit("A"))
    b = cl.build(e, subject=F.col("user_id"), evidence_type=F.col("event_type"), source=F.lit("events"), record=F.col("event_id"), actor=F.lit(""), valid_time=F.col("ts"), observed_at=F.lit("2024-02-01"), path=F.lit("B"))
    return a.unionByName(b)


@query(_CLAIMS)
def claim_log_build(spark, d):
    return _claims(spark, d)


@query(f"SELECT source, count(*) AS n FROM ({_CLAIMS}) WHERE path = 'B' GROUP BY 1")
def claim_append_idempotent(spark, d):
    """Appending all claims to a log that has path A adds exactly path B; what is added twice counts once."""
    c = _claims(spark, d)
    return cl.new_only(c.unionByName(c), c.filter("path = 'A'")).groupBy("source").agg(F.count("*").alias("n"))


@query(f"""SELECT claim_key, subject, observed_at FROM (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY observed_at DESC, claim_key DESC) AS n FROM ({_CLAIMS}) WHERE observed_at <= DATE '2003-01-01') WHERE n = 1""")
def claims_as_of(spark, d):
    return cl.as_of(_claims(spark, d), "subject", "observed_at", F.lit("2003-01-01").cast("date"), "claim_key").select("claim_key", "subject", "observed_at")


@query("""WITH a AS (SELECT upper(trim(p_name || ' ' || p_size)) AS key, list_sort(list(DISTINCT CAST(p_partkey AS VARCHAR))) AS ids FROM part GROUP BY 1),
s AS (SELECT upper(trim(s_name)) AS key, max(CAST(s_suppkey AS VARCHAR)) AS id FROM supplier GROUP BY 1),
m AS (SELECT DISTINCT p_name || ' ' || p_size AS mention FROM part UNION SELECT s_name FROM supplier UNION SELECT 'nobody knows')
SELECT mention, CASE WHEN s.id IS NOT NULL OR len(a.ids) = 1 THEN 'RESOLVED' WHEN len(a.ids) > 1 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS outcome, coalesce(s.id, CASE WHEN len(a.ids) = 1 THEN a.ids[1] END) AS id, CASE WHEN s.id IS NULL AND len(a.ids) > 1 THEN array_to_string(a.ids, ',') ELSE '' END AS candidates
FROM m LEFT JOIN s ON s.key = upper(trim(mention)) LEFT JOIN a ON a.key = upper(trim(mention))""")
def resolve_mentions(spark, d):
    part, sup = t(spark, d, "part"), t(spark, d, "supplier")
    name = F.concat_ws(" ", "p_name", F.col("p_size").cast("string"))
    sym, _ = rs.index(sup, "s_suppkey", "s_name")
    alias = rs.aliases(part.select(name.alias("name"), "p_partkey"), "name", "p_partkey")
    m = part.select(name.alias("mention")).union(sup.select("s_name")).union(spark.createDataFrame([("nobody knows",)], "mention string")).distinct()
    return rs.resolve(m, "mention", sym, alias).withColumn("candidates", F.array_join("candidates", ","))


@query(r"""SELECT doc_id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', '_', 'g'), '\b([A-Z][A-Z0-9]{1,6})\b', 1)), lambda x: x NOT IN ('THE', 'AND', 'BEGIN'))), ',') AS tokens FROM documents""")
def token_extract(spark, d):
    plain = F.regexp_replace("text", r"[^\x00-\x7F]", "_")  # where a word ends is a matter of ASCII in one engine and of Unicode in the other
    got = tx.symbols(plain, ["THE", "AND", "BEGIN"])
    return t(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(got), ",").alias("tokens"))


@query("SELECT doc_id, sha1(string_split_regex(text, '(?i) the ')[1]) AS head FROM documents")
def section_cut(spark, d):
    return t(spark, d, "documents").select("doc_id", F.sha1(tx.section_before(F.col("text"), " the ")).alias("head"))


@query("""SELECT page_id, sha1(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS plain FROM pages""")
def tag_strip(spark, d):
    return t(spark, d, "pages").select("page_id", F.sha1(tx.strip_tags(F.col("html"))).alias("plain"))


RULES = {"licence": ("licensed under", 3), "mail": ("@mail", 2), "number": ("[0-9]{4}", 2), "pipe": (" [|] ", 1)}


@query("""SELECT doc_id, CAST(3 * (text ILIKE '%licensed under%')::INT + 2 * (text ILIKE '%@mail%')::INT + 2 * regexp_matches(text, '[0-9]{4}')::INT + regexp_matches(text, ' [|] ')::INT AS INT) AS score,
concat_ws(',', CASE WHEN text ILIKE '%licensed under%' THEN 'licence' END, CASE WHEN text ILIKE '%@mail%' THEN 'mail' END, CASE WHEN regexp_matches(text, '[0-9]{4}') THEN 'number' END, CASE WHEN regexp_matches(text, ' [|] ') THEN 'pipe' END) AS signals FROM documents""")
def text_fingerprint(spark, d):
    score, names = tx.fingerprint(F.col("text"), RULES)
    return t(spark, d, "documents").select("doc_id", score.alias("score"), F.array_join(names, ",").alias("signals"))


@query("SELECT doc_id, regexp_matches(text, '(?i)thing') OR (regexp_matches(text, '(?i)with') AND NOT regexp_matches(text, '(?i)for')) AS verdict FROM documents")
def negation_guard(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.guarded(F.col("text"), "thing", "with", "for").alias("verdict"))


@query("""WITH s AS (SELECT s_suppkey, upper(s_name || ' (X) Co., Ltd.') AS n FROM supplier) SELECT s_suppkey, CASE WHEN contains(c, '#00000000') THEN 'FIRST' ELSE c END AS firm FROM (SELECT s_suppkey, trim(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(n, '\\([^)]*\\)', ' ', 'g'), '[.,/]', ' ', 'g'), '\\s+', ' ', 'g')), '(CO LTD)$', '')) AS c FROM s)""")
def firm_canonical(spark, d):
    name = F.concat(F.lit(" ; "), F.col("s_name"), F.lit(" (X) Co., Ltd.; other"))
    return t(spark, d, "supplier").select("s_suppkey", tx.organisation(name, [("#00000000", "FIRST")]).alias("firm"))


@query(r"""SELECT doc_id, contains(up, w) AS confirmed, regexp_matches(up, '(^|[^A-Z0-9])' || w || '($|[^A-Z0-9])') AS whole FROM (
SELECT doc_id, upper(regexp_replace(text, '[^\x00-\x7F]', '_', 'g')) AS up, CASE lang WHEN 'de' THEN 'DER' WHEN 'fr' THEN 'LES' WHEN 'es' THEN 'QUE' ELSE 'THE' END AS w FROM documents)""")
def title_confirm(spark, d):
    up = F.upper(F.regexp_replace("text", r"[^\x00-\x7F]", "_"))
    word = F.when(F.col("lang") == "de", "DER").when(F.col("lang") == "fr", "LES").when(F.col("lang") == "es", "QUE").otherwise("THE")
    return t(spark, d, "documents").select("doc_id", up.contains(word).alias("confirmed"), tx.whole_token(up, word).alias("whole"))


_SUMS = "SELECT l_orderkey, l_partkey, sum(l_quantity) FILTER (l_returnflag = 'A') AS title, sum(l_quantity) FILTER (l_returnflag = 'R') AS claims, sum(l_quantity) FILTER (l_returnflag = 'N') AS body_n, sum(l_quantity) AS total FROM lineitem GROUP BY 1, 2"


@query(f"""SELECT l_orderkey, max(l_partkey) FILTER (n = 1) AS entity, max(CASE WHEN coalesce(title, 0) > 0 THEN 'title' WHEN coalesce(claims, 0) > 0 THEN 'claims' ELSE 'body' END) FILTER (n = 1) AS conf, coalesce(string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY n) FILTER (n > 1), '') AS others
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY title DESC NULLS LAST, claims DESC NULLS LAST, total DESC NULLS LAST, l_partkey) AS n FROM ({_SUMS})) WHERE n <= 5 GROUP BY 1""")
def attribution_primary(spark, d):
    sums = at.field_sums(t(spark, d, "lineitem"), "l_orderkey", "l_partkey", "l_returnflag", "l_quantity", {"title": "A", "claims": "R"})
    return at.primary(sums, "l_orderkey", "l_partkey", ["title", "claims", "total"])


@query("SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE r = 1")
def common_surface_form(spark, d):
    return at.dominant(t(spark, d, "events"), "user_id", "event_type", F.count("*"))


@query("""SELECT doc_id, CASE WHEN source = 'src7' THEN 'trusted' WHEN regexp_matches(text, '(?i)licensed') THEN 'excluded' WHEN regexp_matches(text, '(?i)token =') THEN 'degrader' WHEN regexp_matches(text, '(?i)@mail') THEN 'candidate' WHEN lang = 'en' AND NOT regexp_matches(text, '(?i)method|[|]') THEN 'trusted' ELSE 'candidate' END AS grade FROM documents""")
def grade_rules(spark, d):
    conf = F.when(F.col("lang") == "en", "title").otherwise("body")
    g = at.grade(conf, F.col("text"), radar=F.col("source") == "src7", exclude="licensed", degrader="token =", implausible="@mail", method="method|[|]")
    return t(spark, d, "documents").select("doc_id", g.alias("grade"))


_NULLED = "SELECT o_orderkey, nullif(o_custkey % 1000, 3) AS a, nullif(o_orderkey % 5000, 3) AS b FROM orders UNION ALL SELECT NULL, NULL, 1 FROM region UNION ALL SELECT NULL, 1, NULL FROM region UNION ALL SELECT NULL, 9999999, NULL FROM region"


@query(f"SELECT o_orderkey, a, b FROM ({_NULLED}) o WHERE EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = o.a OR s.s_suppkey = o.b)")
def exists_disjunctive(spark, d):
    """With nulls in keys and in whole rows, and repeated rows."""
    o, r = t(spark, d, "orders"), t(spark, d, "region")
    rows = o.select("o_orderkey", F.nullif(F.col("o_custkey") % 1000, F.lit(3)).alias("a"), F.nullif(F.col("o_orderkey") % 5000, F.lit(3)).alias("b"))
    none = F.lit(None).cast("long")
    for a, b in ((none, F.lit(1)), (F.lit(1), none), (F.lit(9999999), none)):
        rows = rows.unionByName(r.select(none.alias("o_orderkey"), a.cast("long").alias("a"), b.cast("long").alias("b")))
    return at.semi_any(rows, [F.col("a"), F.col("b")], t(spark, d, "supplier"), "s_suppkey")


@query("SELECT o_custkey, count(*) AS n, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS hits, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order, max(o_totalprice) AS top FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING count(*) >= 3")
def feed_having_min(spark, d):
    hits = F.when(F.col("o_orderstatus") == "F", F.array("o_orderpriority")).otherwise(F.array().cast("array<string>"))
    return at.feed(t(spark, d, "orders"), "o_custkey", hits, 3, last_order=F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")), top=F.max("o_totalprice"))


@query("""SELECT l_partkey, players, records, first_year, latest, names, CASE WHEN first_year <= 1994 THEN 1994 WHEN first_year <= 1995 THEN 1995 WHEN first_year <= 1998 THEN 1998 END AS bracket, 2026 - first_year AS years, CASE WHEN players <= 2 THEN 'OPEN' WHEN players <= 4 THEN 'CONTESTED' ELSE 'CLOSED' END AS window FROM (
SELECT l_partkey, count(DISTINCT l_suppkey) FILTER (r) AS players, count(*) FILTER (r) AS records, CAST(min(year(l_shipdate)) AS INT) AS first_year, CAST(max(l_shipdate) FILTER (r) AS DATE) AS latest, array_to_string(list_sort(list(DISTINCT CAST(l_suppkey AS VARCHAR)) FILTER (r))[1:8], ',') AS names FROM (SELECT *, l_shipdate >= TIMESTAMP '2001-06-01' AS r FROM lineitem) GROUP BY 1) WHERE records > 0""")
def crowding_window(spark, d):
    """Players since a day, as the operator counts them; the first year is that of all records."""
    return cr.window(t(spark, d, "lineitem"), "l_partkey", "l_suppkey", "l_shipdate", 2026, F.lit("2001-06-01").cast("timestamp_ntz"), (1994, 1995, 1998))


@query(f"SELECT l_partkey, count(DISTINCT l_suppkey) AS n, CASE WHEN l_partkey % 97 = 0 THEN 'CROWDED' WHEN count(DISTINCT l_suppkey) <= 1 THEN 'OPEN' WHEN count(DISTINCT l_suppkey) <= 3 THEN 'EMERGING' WHEN count(DISTINCT l_suppkey) <= 10 THEN 'CONTESTED' ELSE 'CROWDED' END AS lane FROM lineitem GROUP BY 1")
def lane_tiers(spark, d):
    g = t(spark, d, "lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("n"))
    return g.withColumn("lane", cr.tier(F.col("n"), saturated=F.col("l_partkey") % 97 == 0, **cr.LANE))


@query(f"SELECT l_partkey, count(DISTINCT l_suppkey) AS players, arg_max(l_linestatus, CASE WHEN l_linestatus = 'F' THEN 2 WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS furthest, CASE WHEN count(DISTINCT l_suppkey) <= 1 THEN 'OPEN' WHEN count(DISTINCT l_suppkey) <= 4 THEN 'CONTESTED' ELSE 'CROWDED' END AS tier FROM lineitem GROUP BY 1")
def landscape(spark, d):
    return cr.landscape(t(spark, d, "lineitem"), "l_partkey", "l_suppkey", "l_linestatus", {"F": 2, "O": 1})


@query(f"""WITH m AS (SELECT l_suppkey, l_partkey, CASE WHEN l_returnflag = 'R' THEN 'clinical' ELSE 'patent' END AS kind, CAST(l_shipdate AS DATE) AS day, l_orderkey FROM lineitem),
g AS (SELECT l_suppkey, l_partkey, max(day) AS latest, min(day) AS earliest, count(*) FILTER (kind = 'patent') AS n_patents, count(*) FILTER (kind = 'clinical') AS n_trials, arg_min(kind, (day, kind, CAST(l_orderkey AS VARCHAR))) AS earliest_kind, count(*) AS n_signals, string_agg(CAST(day AS VARCHAR) || ' ' || kind || ' ' || l_orderkey, ';' ORDER BY CAST(day AS VARCHAR), kind, CAST(l_orderkey AS VARCHAR)) AS signals FROM m GROUP BY 1, 2)
SELECT *, n_patents > 0 AND n_trials > 0 AS cross_linked, CASE WHEN n_companies <= 1 THEN 'OPEN' WHEN n_companies <= 3 THEN 'EMERGING' WHEN n_companies <= 10 THEN 'CONTESTED' ELSE 'CROWDED' END AS lane FROM (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n_companies FROM g)""")
def unify_moves(spark, d):
    m = t(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.when(F.col("l_returnflag") == "R", "clinical").otherwise("patent").alias("kind"), F.to_date("l_shipdate").alias("day"), "l_orderkey")
    signals = F.array_join(F.transform("signals", lambda x: F.concat_ws(" ", x["date"], x["kind"], x["id"])), ";")
    return mv.unify(m, "l_suppkey", "l_partkey", "kind", "day", "l_orderkey").withColumn("signals", signals)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 ELSE 2 END, l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem) WHERE n = 1""")
def dedup_moves(spark, d):
    rank = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2)
    return mv.best_of(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], rank, F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_extendedprice")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(f"""WITH ev AS (SELECT o_orderkey, o_custkey % 100 AS owner FROM orders), tg AS (SELECT DISTINCT o_orderkey, owner, p FROM (SELECT o_orderkey, owner, unnest([o_orderkey % 500, o_orderkey % 700, owner]) AS p FROM ev)),
h AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem), ix AS (SELECT o_orderkey, owner, pos, [o_orderkey % 500, o_orderkey % 700, owner][pos + 1] AS p FROM ev, (SELECT unnest([0, 1, 2]) AS pos)),
lv AS (SELECT o_orderkey, pos, p, CASE WHEN EXISTS (SELECT 1 FROM h WHERE h.l_partkey = p AND h.l_suppkey = owner) THEN 0 WHEN EXISTS (SELECT 1 FROM h WHERE h.l_partkey = p) THEN 1 ELSE 2 END AS lv FROM ix)
SELECT o_orderkey, CASE b.lv WHEN 0 THEN 'LIKELY' WHEN 1 THEN 'POSSIBLE' ELSE 'NONE' END AS link, b.p AS link_target FROM (SELECT o_orderkey, arg_min({{'lv': lv, 'p': p}}, lv * 10 + pos) AS b FROM lv GROUP BY 1)""")
def crosslink_priority(spark, d):
    ev = t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 100).alias("owner"))
    ev = ev.withColumn("targets", F.array(F.col("o_orderkey") % 500, F.col("o_orderkey") % 700, F.col("owner")))
    return mv.crosslink(ev, "o_orderkey", "targets", "owner", t(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query("""SELECT c_custkey, CASE (EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01'))::INT + (c_acctbal > 5000)::INT + (c_mktsegment = 'BUILDING')::INT WHEN 0 THEN 'NOVEL' WHEN 1 THEN 'EMERGING' ELSE 'KNOWN' END AS tier FROM customer""")
def novelty_tier(spark, d):
    o = t(spark, d, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has", F.lit(True))
    c = t(spark, d, "customer").join(o, "c_custkey", "left")
    return c.select("c_custkey", mv.novelty(F.col("has"), F.col("c_acctbal") > 5000, F.col("c_mktsegment") == "BUILDING").alias("tier"))


_VERDICT = "SELECT o_custkey, CASE WHEN count(*) >= 3 THEN 'TAKEN' ELSE 'OPEN' END AS v FROM orders WHERE o_orderdate < TIMESTAMP '{}' GROUP BY 1"


@query(f"SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, a.v AS before, b.v AS after, CASE WHEN a.v IS NULL THEN 'NEW' WHEN b.v IS NULL THEN 'GONE' WHEN a.v <> b.v THEN 'CHANGED' ELSE 'SAME' END AS status FROM ({_VERDICT.format('1996-01-01')}) a FULL JOIN ({_VERDICT.format('1998-01-01')}) b ON a.o_custkey = b.o_custkey")
def snapshot_delta(spark, d):
    def at_day(day):
        o = t(spark, d, "orders").filter(F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz"))
        return o.groupBy("o_custkey").agg(F.when(F.count("*") >= 3, "TAKEN").otherwise("OPEN").alias("v"))

    return mv.snapshot_delta(at_day("1996-01-01"), at_day("1998-01-01"), "o_custkey", "v")


@query("SELECT event_id, user_id FROM events e WHERE ts >= TIMESTAMP '2024-01-03' AND NOT EXISTS (SELECT 1 FROM events s WHERE s.ts < TIMESTAMP '2024-01-03' AND s.user_id = e.user_id AND s.event_type = 'purchase')")
def diff_unseen(spark, d):
    e, cut = t(spark, d, "events"), F.lit("2024-01-03").cast("timestamp_ntz")
    return mv.unseen(e.filter(F.col("ts") >= cut), e.filter((F.col("ts") < cut) & (F.col("event_type") == "purchase")), "user_id").select("event_id", "user_id")


@query("SELECT o_orderkey, o_totalprice, (SELECT greatest(0, count(*) - 10) FROM orders WHERE o_orderstatus = 'P') AS overflow FROM orders WHERE o_orderstatus = 'P' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def digest_blocks(spark, d):
    o = t(spark, d, "orders").filter("o_orderstatus = 'P'").select("o_orderkey", "o_totalprice")
    return mv.digest(o, 10, F.col("o_totalprice").desc(), F.col("o_orderkey"))


@query("""SELECT s_suppkey, s_nationkey FROM supplier WHERE s_acctbal > 0 AND s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R') AND s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0)""")
def opportunity_intersection(spark, d):
    hit = t(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_suppkey").alias("s_suppkey"))
    deny = t(spark, d, "nation").filter("n_regionkey = 0").select(F.col("n_nationkey").alias("s_nationkey"))
    return cr.opportunities(t(spark, d, "supplier"), F.col("s_acctbal") > 0, hit, deny, "s_suppkey", "s_nationkey").select("s_suppkey", "s_nationkey")


@query("""SELECT p_partkey, array_to_string(list_concat(list_transform(list_filter(range(1, 5), lambda i: substr(p_name, i, 1) = 'e'), lambda i: 'front@' || i), list_transform(list_filter(range(5, 11), lambda i: substr(p_name, i, 1) = 'e'), lambda i: 'hinge@' || i)), ',') AS handles FROM part""")
def pocket_handles(spark, d):
    return t(spark, d, "part").select("p_partkey", F.array_join(tx.positions_of(F.col("p_name"), "e", [("front", 1, 4), ("hinge", 5, 10)]), ",").alias("handles"))


@query("SELECT p_type, count(*) AS n, count(DISTINCT p_brand) AS groups, string_agg(DISTINCT p_name, ',' ORDER BY p_name) AS kinds, max(p_retailprice) FILTER (p_size > 25) AS best FROM part GROUP BY 1")
def prior_art_agg(spark, d):
    return cr.prior_art(t(spark, d, "part"), "p_type", "p_partkey", "p_brand", "p_name", F.when(F.col("p_size") > 25, F.col("p_retailprice")))


_YEARS = "SELECT o_custkey, count(*) FILTER (year(o_orderdate) BETWEEN 1998 AND 2001) AS recent, count(*) FILTER (year(o_orderdate) BETWEEN 1995 AND 1997) AS base FROM orders GROUP BY 1"


@query(f"SELECT o_custkey, recent, base, round((recent / 2.0::DOUBLE) / (base / 3.0::DOUBLE + 1), 6) AS accel FROM ({_YEARS}) WHERE recent >= 3")
def momentum_accel(spark, d):
    y = bt.year_sums(t(spark, d, "orders"), "o_custkey", F.year("o_orderdate"), F.lit(1), recent=(1998, 2001), base=(1995, 1997))
    return cr.accelerating(y, "recent", "base", (2, 3), 3).withColumn("accel", F.round("accel", 6))


_EMERGE = "SELECT o_custkey, (count(*) FILTER (year(o_orderdate) = 1998) + 1)::DOUBLE / (count(*) FILTER (year(o_orderdate) BETWEEN 1996 AND 1997) + 1) AS signal, count(*) FILTER (year(o_orderdate) >= 2000) >= 3 AS emerged, count(*) FILTER (year(o_orderdate) >= 2000) AS outcome FROM orders GROUP BY 1"


def _emerge(spark, d):
    y = bt.year_sums(t(spark, d, "orders"), "o_custkey", F.year("o_orderdate"), F.lit(1), r=(1998, 1998), b=(1996, 1997), outcome=(2000, 9999))
    return y.select("o_custkey", tx.smoothed_ratio(F.col("r"), F.col("b")).alias("signal"), (F.col("outcome") >= 3).alias("emerged"), "outcome")


@query(f"""WITH r AS (SELECT *, row_number() OVER (ORDER BY signal DESC, o_custkey) AS n, count(*) OVER () AS c FROM ({_EMERGE}))
SELECT round(t, 9) AS top, round(b, 9) AS bottom, round(t / (b + 1e-9), 6) AS lift FROM (SELECT avg(emerged::INT) FILTER (n <= greatest(1, c // 3)) AS t, avg(emerged::INT) FILTER (n > c - greatest(1, c // 3)) AS b FROM r)""")
def emergence_lift(spark, d):
    out = bt.tertile_lift(_emerge(spark, d), "emerged", F.col("signal").desc(), F.col("o_custkey"))
    return out.select(F.round("top", 9).alias("top"), F.round("bottom", 9).alias("bottom"), F.round("lift", 6).alias("lift"))


@query(f"SELECT round(avg(emerged::INT), 9) AS precision FROM (SELECT emerged FROM ({_EMERGE}) ORDER BY signal DESC, o_custkey LIMIT 20)")
def precision_at_k(spark, d):
    return bt.precision_at(_emerge(spark, d), "emerged", 20, F.col("signal").desc(), F.col("o_custkey")).select(F.round("precision", 9).alias("precision"))


@query(f"SELECT round(corr(x, y), 9) AS rho FROM (SELECT row_number() OVER (ORDER BY signal, o_custkey) AS x, row_number() OVER (ORDER BY outcome, o_custkey) AS y FROM ({_EMERGE}))")
def spearman_ordinal(spark, d):
    return bt.spearman(_emerge(spark, d), "signal", "outcome", "o_custkey").select(F.round("rho", 9).alias("rho"))


@query("""WITH j AS (SELECT n_chars AS v, quality FROM documents JOIN labels USING (doc_id)), r AS (SELECT quality, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE AS rk FROM j),
s AS (SELECT sum(rk) FILTER (quality = 1) - count(*) FILTER (quality = 1) * (count(*) FILTER (quality = 1) + 1) / 2.0::DOUBLE AS u, CAST(count(*) FILTER (quality = 1) AS DOUBLE) AS np, CAST(count(*) FILTER (quality = 0) AS DOUBLE) AS nn FROM r),
z AS (SELECT u / (np * nn) AS auc, (u - np * nn / 2) / sqrt(np * nn * (np + nn + 1) / 12) AS z FROM s), q AS (SELECT auc, z, 1 / (1 + 0.2316419 * abs(z)) AS t FROM z),
p AS (SELECT auc, z, t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))) * exp(-z * z / 2) / 2.5066282746310002 AS tail FROM q)
SELECT round(auc, 9) AS auc, round(z, 6) AS z, round(CASE WHEN z >= 0 THEN tail ELSE 1 - tail END, 6) AS p FROM p""")
def auc_mann_whitney(spark, d):
    j = t(spark, d, "documents").select("doc_id", "n_chars").join(t(spark, d, "labels"), "doc_id")
    return bt.auc(j.withColumn("pos", F.col("quality") == 1), "n_chars", "pos").select(F.round("auc", 9).alias("auc"), F.round("z", 6).alias("z"), F.round("p", 6).alias("p"))


@query("""WITH a AS (SELECT c_custkey AS k, c_acctbal AS l FROM customer WHERE c_mktsegment = 'BUILDING'), b AS (SELECT c_custkey AS k, c_acctbal AS l FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT "case", control, rank FROM (SELECT a.k AS "case", b.k AS control, CAST(row_number() OVER (PARTITION BY a.k ORDER BY abs(a.l - b.l), b.k) AS INT) AS rank FROM a JOIN b ON true) WHERE rank <= 5""")
def matched_controls(spark, d):
    c = t(spark, d, "customer")
    return bt.matched(c.filter("c_mktsegment = 'BUILDING'"), c.filter("c_mktsegment <> 'BUILDING'"), "c_custkey", "c_acctbal", 5).select("case", "control", "rank")


@query("""WITH RECURSIVE a AS (SELECT s_suppkey AS k, s_acctbal AS l, row_number() OVER (ORDER BY s_suppkey) AS o FROM supplier WHERE s_nationkey < 5), b AS (SELECT s_suppkey AS k, s_acctbal AS l, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS place FROM supplier WHERE s_nationkey >= 5),
steps AS (SELECT a.k, a.l, row_number() OVER (ORDER BY o, i) AS n FROM a, (SELECT unnest([1, 2]) AS i)),
g AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS used, NULL::BIGINT AS "case", NULL::BIGINT AS control UNION ALL
SELECT n, list_append(used, p), k, p FROM (SELECT s.n, g.used, s.k, arg_min(b.k, (abs(b.l - s.l), b.l >= s.l, CASE WHEN b.l < s.l THEN -b.place ELSE b.place END)) AS p FROM g JOIN steps s ON s.n = g.n + 1 JOIN b ON NOT list_contains(g.used, b.k) GROUP BY 1, 2, 3))
SELECT "case", control, abs(x.s_acctbal - y.s_acctbal) AS distance FROM g JOIN supplier x ON x.s_suppkey = "case" JOIN supplier y ON y.s_suppkey = control""")
def matched_controls_greedy(spark, d):
    s = t(spark, d, "supplier")
    return mt.greedy_matched(s.filter("s_nationkey < 5"), s.filter("s_nationkey >= 5"), "s_suppkey", "s_acctbal", 2)


def _stirred(r, i):
    """A round of the keyed bijection, in SQL."""
    v = f"(({r} * 2654435761 + p * 4 + {i} + 7) % 4294967291)"
    v = f"(xor({v}, {v} >> 16) * 1540483477 % 4294967291)"
    return f"((xor({v}, {v} >> 13) * 1540483477 % 4294967291 >> 9) & m)"


@query(f"""WITH RECURSIVE r AS (SELECT emerged, row_number() OVER (ORDER BY signal, o_custkey) - 1 AS x, row_number() OVER (ORDER BY emerged, o_custkey) - 1 AS y, row_number() OVER (ORDER BY o_custkey) - 1 AS i, count(*) OVER () AS n FROM ({_EMERGE})),
h AS (SELECT greatest(4, (length(to_base(greatest(1, max(n) - 1), 2)) + 1) // 2)::INT AS h FROM r),
walk AS (SELECT x, i, n, p, i AS z, true AS open FROM r, (SELECT unnest(range(2000)) AS p) UNION ALL
SELECT x, i, n, p, z, z >= n FROM (SELECT x, i, n, p, (c << h) | xor(b, {_stirred('c', 3)}) AS z FROM (SELECT *, xor(a, {_stirred('b', 2)}) AS c FROM (SELECT *, xor(d, {_stirred('a', 1)}) AS b FROM (
SELECT *, xor(l, {_stirred('d', 0)}) AS a FROM (SELECT x, i, n, p, h, (1 << h) - 1 AS m, z >> h AS l, z & ((1 << h) - 1) AS d FROM walk, h WHERE open)))))),
k AS (SELECT p, w.x, w.n, row_number() OVER (PARTITION BY p ORDER BY r.emerged, w.i) - 1 AS rank FROM walk w JOIN r ON r.y = w.z WHERE NOT open),
s AS (SELECT p, sum((x - n // 2) * rank) AS s FROM k GROUP BY 1)
SELECT (count(*) FILTER (s >= (SELECT sum((x - n // 2) * y) FROM r)) + 1) / 2001.0::DOUBLE AS p FROM s""")
def permutation_test(spark, d):
    return bt.permutation_p(_emerge(spark, d).select("o_custkey", "signal", "emerged"), "signal", "emerged", "o_custkey", 2000, 7)


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate < TIMESTAMP '1998-01-01') AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def cohort_asof(spark, d):
    o = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("first"))
    return t(spark, d, "customer").join(o.filter(F.col("first") >= F.lit("1998-01-01").cast("timestamp_ntz")), "c_custkey", "left_semi").select("c_custkey")


@query("""SELECT c_custkey, n_name, r_name, coalesce(o.n, 0) AS n_orders, coalesce(CASE WHEN o.n > 12 THEN 'BUSY' END, c_mktsegment) AS verdict FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey""")
def evidence_wide(spark, d):
    n = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"), F.when(F.count("*") > 12, "BUSY").alias("busy"))
    places = t(spark, d, "nation").join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    wide = mv.widened(mv.widened(t(spark, d, "customer"), "c_nationkey", (places, {})), "c_custkey", (n, {"n_orders": 0}))
    return wide.select("c_custkey", "n_name", "r_name", "n_orders", F.coalesce("busy", "c_mktsegment").alias("verdict"))


_A, _B = "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'"


@query(f"SELECT 'union' AS op, count(*) AS n FROM ({_A} UNION {_B}) UNION ALL SELECT 'union_all', count(*) FROM ({_A} UNION ALL {_B}) UNION ALL SELECT 'except', count(*) FROM ({_A} EXCEPT {_B}) UNION ALL SELECT 'intersect', count(*) FROM ({_A} INTERSECT {_B})")
def set_ops(spark, d):
    o = t(spark, d, "orders")
    a, b = (o.filter(F.col("o_orderstatus") == s).select(F.col("o_custkey").alias("k")) for s in "FP")
    parts = {"union": a.union(b).distinct(), "union_all": a.union(b), "except": a.subtract(b), "intersect": a.intersect(b)}
    out = None
    for name, df in parts.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
        out = row if out is None else out.union(row)
    return out


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_tumbling(spark, d):
    e = t(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return st.tumbling(e, "ts", "1 hour", "event_type").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT w AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts), time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS w FROM events) GROUP BY 1, 2")
def event_sliding(spark, d):
    e = t(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return st.tumbling(e, "ts", "2 hours", "event_type", slide="1 hour").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("""WITH g AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), h AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT min(ts) AS start, user_id, count(*) AS n FROM h GROUP BY user_id, k""")
def event_session(spark, d):
    e = t(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    return st.sessions(e, "ts", "12 hours", "user_id").select(F.col("start").cast("timestamp_ntz").alias("start"), "user_id", "n")


def _several_files(spark, d, n=4, rows=500_000):
    """The events in n turns by time, written one after the other, and the number of files of a turn: streams that take so many files for each batch take the turns in this order.

    A turn is written and read by a task for about so many ``rows``. All turns need the same number of files, none without rows: a task that deals k rows or more in turn fills k files, and some task has as many where
    a turn has k rows for each task."""
    at_path, events = _folder(spark, "events"), t(spark, d, "events")
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    edges = [low + (high - low) * i / n for i in range(1, n)] if low is not None else []
    part = sum((F.when(F.col("ts") >= F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    counts = {r.part: r["count"] for r in events.groupBy(part.alias("part")).count().collect()}
    most, least = max(counts.values(), default=0), min(counts.get(i, 0) for i in range(n))
    k = max(1, min(-(-most // rows), least // max(1, events.rdd.getNumPartitions())))
    for i in range(n):
        turn = events.filter(part == i)
        dealt = turn.withColumn("_file", (F.monotonically_increasing_id() % k).cast("int")).repartitionById(k, F.col("_file")).drop("_file")
        (turn.coalesce(1) if k == 1 else dealt).write.mode("append").parquet(at_path)
    return at_path, k


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(spark, d):
    """Each pair comes once, in whichever batch it comes first."""
    schema, out = t(spark, d, "events").schema, _folder(spark, "first-seen")
    path, k = _several_files(spark, d)
    events = st.source(spark, path, schema, files=k).select("user_id", "event_type")
    st.appended(st.first_seen(events, ["user_id", "event_type"]), out, _folder(spark, "checkpoint"))
    return spark.read.schema("user_id long, event_type string").parquet(out)


@query("SELECT event_type, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS k_sum, count(*) AS n FROM events GROUP BY 1")
def nested_projection(spark, d):
    e = t(spark, d, "events").withColumn("k", tx.json_field(F.col("props"), "$.k", "bigint", 0))
    return e.groupBy("event_type").agg(F.sum("k").alias("k_sum"), F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, lag(l_shipdate) OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice) <= l_shipdate AS in_order FROM lineitem")
def order_check(spark, d):
    checked = cl.out_of_order(t(spark, d, "lineitem"), *map(F.col, ("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")), key="l_partkey", date="l_shipdate")
    return checked.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "in_order")


@query("SELECT o_orderpriority, count(*) AS n, median(o_totalprice) AS med, round(avg((o_orderstatus = 'F')::INT), 9) AS rate, max(o_totalprice) AS top FROM orders GROUP BY 1")
def frequency_table(spark, d):
    return cr.frequencies(t(spark, d, "orders"), "o_orderpriority", "o_totalprice", F.col("o_orderstatus") == "F").withColumn("rate", F.round("rate", 9))


@query("SELECT doc_id, array_to_string(list_filter(string_split_regex(text, '[.] '), lambda x: contains(x, 'the') AND length(x) > 12 AND length(x) < 320 AND NOT starts_with(x, '['))[1:3], '#') AS leads FROM documents")
def paragraph_leads(spark, d):
    return t(spark, d, "documents").select("doc_id", F.array_join(tx.leads(F.col("text"), "[.] ", "the"), "#").alias("leads"))


@query(f"SELECT l_suppkey, count(DISTINCT l_partkey) AS actors, count(DISTINCT l_returnflag) AS kinds FROM lineitem JOIN (SELECT l_suppkey, max(CAST(l_shipdate AS DATE)) AS last FROM lineitem GROUP BY 1) USING (l_suppkey) WHERE CAST(l_shipdate AS DATE) >= last - 30 GROUP BY 1 HAVING count(DISTINCT l_partkey) > 1")
def rollup_corroboration(spark, d):
    r = t(spark, d, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return cl.rolled_up(r, "l_suppkey", "l_partkey", "l_returnflag", "day", 30)


# --- attribution with validated mentions ---

_FORMS = "SELECT DISTINCT 'E' || p_size AS entity, upper(trim(p_name)) AS form FROM part WHERE p_type IN ('STANDARD', 'ECONOMY', 'PROMO')"
_TITLES = "SELECT o_orderkey, upper(p_name) AS title FROM orders JOIN part ON p_partkey = o_custkey"


def _forms(spark, d):
    official = t(spark, d, "part").filter(F.col("p_type").isin("STANDARD", "ECONOMY", "PROMO")).select(F.concat(F.lit("E"), "p_size").alias("entity"), "p_name")
    return at.surface_forms(official, "entity", ["p_name"], [])


def _mentions(spark, d, parts=None):
    """Lines of orders as mentions of entities: the part's name must be a form of its entity."""
    found = t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat(F.lit("E"), "p_size").alias("entity"), "p_name", "p_brand")
    valid = at.valid_mentions(found, "entity", ["p_name", "p_brand"], _forms(spark, d))
    records = t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return at.mention_rows(t(spark, d, "lineitem"), records, valid, record="l_orderkey", mention="l_partkey", parts=parts)


_MENTIONS = f"""SELECT l_orderkey, entity, l_returnflag, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN (SELECT p_partkey, 'E' || p_size AS entity, p_name, p_brand FROM part p
WHERE EXISTS (SELECT 1 FROM ({_FORMS}) f WHERE f.entity = 'E' || p.p_size AND f.form IN (upper(p.p_name), upper(p.p_brand)))) e ON e.p_partkey = l_partkey"""


@query(f"SELECT entity, count(*) AS n, sum(l_quantity) AS quantity FROM ({_MENTIONS}) GROUP BY 1")
def mention_star(spark, d):
    return _mentions(spark, d).groupBy("entity").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query(f"""WITH m AS ({_MENTIONS}), s AS (SELECT l_orderkey, entity, sum(l_quantity) FILTER (l_returnflag = 'A') AS title, sum(l_quantity) FILTER (l_returnflag = 'R') AS claims, sum(l_quantity) AS total FROM m GROUP BY 1, 2)
SELECT DISTINCT s.l_orderkey, s.entity FROM s JOIN ({_TITLES}) t ON t.o_orderkey = s.l_orderkey JOIN ({_FORMS}) f USING (entity) WHERE regexp_matches(t.title, '(^|[^A-Z0-9])' || f.form || '($|[^A-Z0-9])')""")
def title_theta_semi(spark, d):
    titles = t(spark, d, "orders").join(t(spark, d, "part"), F.col("p_partkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("l_orderkey"), "p_name")
    parts = at.parts_for(t(spark, d, "lineitem"))
    return at.in_title(_mentions(spark, d, parts), "l_orderkey", "entity", titles, F.col("p_name"), _forms(spark, d), parts)


@query(f"""WITH m AS ({_MENTIONS}), s AS (SELECT l_orderkey, m.entity, 'S' || m.entity AS symbol, sum(l_quantity) FILTER (l_returnflag = 'A') AS title, sum(l_quantity) FILTER (l_returnflag = 'R') AS claims, sum(l_quantity) AS total FROM m GROUP BY 1, 2),
named AS (SELECT DISTINCT s.l_orderkey, s.entity FROM s JOIN ({_TITLES}) t ON t.o_orderkey = s.l_orderkey JOIN ({_FORMS}) f ON f.entity = s.entity WHERE s.title > 0 AND contains(t.title, f.form) AND regexp_matches(t.title, '(^|[^A-Z0-9])' || f.form || '($|[^A-Z0-9])')),
r AS (SELECT s.* FROM s LEFT JOIN named ON named.l_orderkey = s.l_orderkey AND named.entity = s.entity WHERE coalesce(title, 0) = 0 OR named.entity IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY title DESC NULLS LAST, claims DESC NULLS LAST, total DESC NULLS LAST, entity) AS n FROM r)
SELECT l_orderkey, max(symbol) FILTER (n = 1) AS entity, max(CASE WHEN coalesce(title, 0) > 0 THEN 'title' WHEN coalesce(claims, 0) > 0 THEN 'claims' ELSE 'body' END) FILTER (n = 1) AS conf, coalesce(string_agg(symbol, ',' ORDER BY n) FILTER (n > 1), '') AS others FROM n WHERE n <= 5 GROUP BY 1""")
def attribution_validated(spark, d):
    titles = t(spark, d, "orders").join(t(spark, d, "part"), F.col("p_partkey") == F.col("o_custkey")).select(F.col("o_orderkey").alias("l_orderkey"), "p_name")
    symbols = t(spark, d, "part").select(F.concat(F.lit("E"), "p_size").alias("entity")).distinct().withColumn("symbol", F.concat(F.lit("S"), "entity"))
    parts = at.parts_for(t(spark, d, "lineitem"))
    return at.attribute(_mentions(spark, d, parts), "l_orderkey", "entity", "l_returnflag", "l_quantity", {"title": "A", "claims": "R"}, titles, F.col("p_name"), _forms(spark, d), symbols, parts=parts)


@query("""SELECT o_orderkey, count(*) AS n, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS hits FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey
WHERE o_orderdate > TIMESTAMP '1996-06-01' AND substr(o_orderpriority, 1, 2) IN ('1-', '3-') AND p_type IN ('PROMO', 'SMALL') GROUP BY 1 HAVING count(*) >= 3""")
def compound_feed(spark, d):
    records = at.recent_of(t(spark, d, "orders"), F.lit("1996-06-01").cast("timestamp_ntz"), "o_orderdate", ["1-", "3-"], "o_orderpriority")
    hits = F.when(F.col("p_type").isin("PROMO", "SMALL"), F.array("p_brand")).otherwise(F.array().cast("array<string>"))
    rows = records.join(t(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).join(t(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey"))
    return at.feed(rows, "o_orderkey", hits, 3)


@query(f"SELECT grade, count(*) AS n, count(*) FILTER (lang IN ('en', 'fr')) AS n_by_confidence FROM ({ORACLE['grade_rules']}) JOIN (SELECT doc_id, lang FROM documents) USING (doc_id) GROUP BY 1")
def regrade_census(spark, d):
    docs = t(spark, d, "documents")
    targets = docs.select("doc_id", F.when(F.col("lang") == "en", "title").when(F.col("lang") == "fr", "claims").otherwise("body").alias("conf"), F.col("source").alias("radar"), F.lit("none").alias("grade"))
    g = at.grade(F.col("conf"), F.col("text"), radar=F.col("radar") == "src7", exclude="licensed", degrader="token =", implausible="@mail", method="method|[|]")
    return at.census(at.regrade(targets, docs.select("doc_id", "text"), "doc_id", g))


# --- claims from text and names ---

_WORDS = "SELECT DISTINCT upper(split_part(p_name, ' ', 1)) AS key, 'W:' || split_part(p_name, ' ', 1) AS id FROM part"


@query(rf"""WITH a AS (SELECT upper(split_part(p_name, ' ', 2)) AS key, list_sort(list(DISTINCT p_type)) AS ids FROM part GROUP BY 1), m AS (SELECT p_partkey, unnest(list_distinct(regexp_extract_all(upper(p_name), '\b([A-Z][A-Z0-9]{{1,6}})\b', 1))) AS key FROM part)
SELECT p_partkey, coalesce(w.id, a.ids[1]) AS entity, 'A' AS path FROM m LEFT JOIN ({_WORDS}) w USING (key) LEFT JOIN a USING (key) WHERE key <> 'RED' AND (w.id IS NOT NULL OR len(a.ids) = 1)
UNION ALL SELECT p_partkey, 'B:' || p_type, 'B' FROM part WHERE p_type IN ('PROMO', 'LARGE')""")
def mention_explode(spark, d):
    part = t(spark, d, "part")
    words = part.select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("w"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("v"), "p_type")
    sym, _ = rs.index(words.select(F.concat(F.lit("W:"), "w").alias("id"), "w").distinct(), "id", "w")
    targets = part.select(F.col("p_type").alias("name"), F.concat(F.lit("B:"), "p_type").alias("id")).filter(F.col("name").isin("PROMO", "LARGE"))
    got = cl.mentions(part, F.upper("p_name"), F.array("p_type"), sym, rs.aliases(words, "v", "p_type"), targets, stop=["RED"])
    return got.select("p_partkey", "entity", "path")


@query("""SELECT s_suppkey AS claim, lower(s_name) AS mention, CAST(s_suppkey AS VARCHAR) AS subject, 'v2' AS resolver_version FROM supplier WHERE s_nationkey <> 3""")
def canonical_projection(spark, d):
    sup = t(spark, d, "supplier")
    sym, alias = rs.index(sup.filter("s_nationkey <> 3"), "s_suppkey", "s_name")
    log = sup.select(F.col("s_suppkey").alias("claim"), F.lower("s_name").alias("mention"), F.lit("old").alias("subject"))
    return cl.projected(log, "mention", sym, alias, "v2")


@query("SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' - 10 AND CAST(ts AS DATE) <= DATE '2024-01-20'")
def trailing_window(spark, d):
    e = t(spark, d, "events").withColumn("day", F.to_date("ts"))
    return cl.trailing(e, "day", F.lit("2024-01-20").cast("date"), 10).select("event_id", "user_id")


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) > (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01') - 7")
def incremental_cursor(spark, d):
    have = t(spark, d, "lineitem").filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(F.to_date("l_shipdate").alias("day"))
    return st.newer(t(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")), "day", have, "day", 7).select("o_orderkey")


# --- screening, cascades, buckets ---

_DESCRIPTION = "'<p>Example ' || p_size || ': N-(' || p_name || ')acrylamide as a white solid</p><p>poly' || p_type || ' 2-acrylamide gel</p><p>' || repeat('3-chloroacetamide and (epoxide) ' || p_brand || ' for the tests; ', p_size % 5) || '</p>'"
_HITS = r"(acryl|prop-?2-?en|2-?propen)amide|(propiol|but-?2-?yn)amide|chloroacetamide|vinyl[\s-]?sulfon(amide|e)|epoxide|maleimid"


@query(rf"""WITH d AS (SELECT p_partkey, p_name, regexp_replace({_DESCRIPTION}, '<[^>]+>', ' ', 'g') AS t, len(list_distinct(list_filter(regexp_extract_all({_DESCRIPTION}, '<p>(.*?)</p>', 1), lambda p: length(trim(p)) > 12 AND length(trim(p)) < 320 AND regexp_matches(p, '(?i)acrylamide')))) AS leads FROM part WHERE p_type IN ('PROMO', 'SMALL')),
h AS (SELECT p_partkey, t, i, length(regexp_extract(substr(t, i), '(?i)^({_HITS})')) AS n FROM (SELECT p_partkey, t, unnest(range(1, length(t) + 1)) AS i FROM d) WHERE regexp_matches(substr(t, i), '(?i)^({_HITS})') AND i > 1 AND regexp_matches(substr(t, greatest(1, i - 2), i - greatest(1, i - 2)), '[\])\-0-9]\s?$')),
k AS (SELECT p_partkey, count(*) AS n FROM h WHERE NOT regexp_matches(trim(substr(t, greatest(1, i - 28), i - greatest(1, i - 28) + n + 12)), '(?i)\b(gel|poly|polymer|excipient|column|purification|resin|hydrogel|coating)\b') GROUP BY 1)
SELECT p_partkey, CAST(n AS INT) AS mentions, CAST(leads AS INT) AS lead_names, n >= 3 AS needs_images FROM k JOIN d USING (p_partkey) WHERE n >= 3""")
def patent_screen(spark, d):
    part = t(spark, d, "part").withColumn("office", F.when(F.col("p_type") == "PROMO", "WO1").when(F.col("p_type") == "SMALL", "EP2").otherwise("US3"))
    some = F.repeat(F.concat(F.lit("3-chloroacetamide and (epoxide) "), "p_brand", F.lit(" for the tests; ")), F.col("p_size") % 5)
    text = F.concat(F.lit("<p>Example "), "p_size", F.lit(": N-("), "p_name", F.lit(")acrylamide as a white solid</p><p>poly"), "p_type", F.lit(" 2-acrylamide gel</p><p>"), some, F.lit("</p>"))
    out = sc.screen(part.select("p_partkey", "p_name", "office", text.alias("description"), F.lit(None).cast("string").alias("claims")), "office", F.col("p_name"), "description", "claims")
    return out.select("p_partkey", "mentions", "lead_names", "needs_images")


@query("""SELECT doc_id, CASE WHEN lang = 'en' THEN 'LIKELY' WHEN regexp_matches(text, '(?i)token =') THEN 'LIKELY' WHEN score >= 4 THEN 'FINGERPRINT' WHEN lang = 'de' THEN 'POSSIBLE' ELSE 'NONE' END AS level FROM (
SELECT *, 3 * (text ILIKE '%licensed under%')::INT + 2 * (text ILIKE '%@mail%')::INT + 2 * regexp_matches(text, '[0-9]{4}')::INT + regexp_matches(text, ' [|] ')::INT AS score FROM documents)""")
def trial_cascade(spark, d):
    link = F.when(F.col("lang") == "en", "LIKELY").when(F.col("lang") == "de", "POSSIBLE").otherwise("NONE")
    score, _ = tx.fingerprint(F.col("text"), RULES)
    return t(spark, d, "documents").select("doc_id", mv.cascade(link, F.col("text").rlike("(?i)token ="), score).alias("level"))


@query("SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN c_acctbal > 9000 THEN 'traps' WHEN c_mktsegment = 'BUILDING' THEN 'novel' ELSE 'others' END AS bucket FROM customer) GROUP BY 1")
def disjoint_buckets(spark, d):
    return cr.buckets(t(spark, d, "customer"), ("traps", F.col("c_acctbal") > 9000), ("novel", F.col("c_mktsegment") == "BUILDING"), rest="others").groupBy("bucket").agg(F.count("*").alias("n"))


@query("""SELECT l_partkey, bool_or(l_returnflag = 'R') AS returned, bool_or(l_linestatus = 'O') AS open, max(l_quantity) AS l_quantity, arg_min(l_suppkey, (l_shipdate, l_orderkey, l_linenumber, l_suppkey)) AS l_suppkey FROM lineitem GROUP BY 1""")
def flags_by_key(spark, d):
    rows = t(spark, d, "lineitem").select("l_partkey", (F.col("l_returnflag") == "R").alias("returned"), (F.col("l_linestatus") == "O").alias("open"), "l_quantity", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    return cr.flags_of(rows, "l_partkey", ["returned", "open"], ["l_quantity"], [F.col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey")]).select("l_partkey", "returned", "open", "l_quantity", "l_suppkey")


@query("""SELECT p_partkey, len(list_filter([p_name, p_type], lambda x: regexp_matches(x, '(?i)red|promo'))) > 0 AS any_hit, len(list_filter([p_name, p_type], lambda x: NOT regexp_matches(x, '(?i)r'))) = 0 AS all_hit FROM part""")
def array_any_all(spark, d):
    values = F.array("p_name", "p_type")
    return t(spark, d, "part").select("p_partkey", tx.any_of(values, "red|promo").alias("any_hit"), tx.all_of(values, "r").alias("all_hit"))


@query("SELECT l_partkey, l_linenumber, verdict, first(verdict) OVER (PARTITION BY l_partkey ORDER BY CASE verdict WHEN 'unique-handle' THEN 0 WHEN 'partial' THEN 1 ELSE 2 END) AS selectivity FROM (SELECT l_partkey, l_linenumber, CASE count(*) FILTER (l_returnflag = 'A') WHEN 0 THEN 'unique-handle' WHEN count(*) THEN 'conserved-liability' ELSE 'partial' END AS verdict FROM lineitem GROUP BY 1, 2)")
def residue_vote(spark, d):
    return al.selectivity(t(spark, d, "lineitem"), "l_partkey", "l_linenumber", "l_returnflag", "A")


# --- filings, dossier, digest, top-up ---

@query("""SELECT l_partkey, count(DISTINCT l_suppkey) AS players, CAST(max(l_shipdate) AS DATE) AS latest, count(*) AS filings FROM lineitem JOIN part ON p_partkey = l_partkey
WHERE l_shipdate >= TIMESTAMP '2001-03-01' AND NOT regexp_matches(p_type, 'MEDIUM') AND contains(upper(p_name || ' ' || p_brand), upper(split_part(p_name, ' ', 2))) GROUP BY 1 HAVING count(DISTINCT l_suppkey) <= 3 AND CAST(max(l_shipdate) AS DATE) >= DATE '2001-06-01'""")
def fresh_filings(spark, d):
    rows = t(spark, d, "lineitem").join(t(spark, d, "part"), F.col("p_partkey") == F.col("l_partkey")).withColumns({"day": F.to_date("l_shipdate"), "target_name": F.split_part("p_name", F.lit(" "), F.lit(2)), "none": F.lit("")})
    title = F.concat_ws(" ", "p_name", "p_brand", F.when(F.col("p_type") == "MEDIUM", F.lit("medium")))
    return cr.fresh(rows, "l_partkey", "l_suppkey", "day", title, [F.col("none"), F.col("target_name")], since=F.lit("2001-03-01").cast("date"), latest_since=F.lit("2001-06-01").cast("date"), skip="medium")


_LANES = "SELECT c_custkey, c_name, c_mktsegment, c_nationkey, o.latest, o.n, CASE WHEN o.n <= 8 THEN 'OPEN' WHEN o.n <= 10 THEN 'EMERGING' ELSE 'CROWDED' END AS lane FROM customer JOIN (SELECT o_custkey, count(*) AS n, CAST(max(o_orderdate) AS DATE) AS latest FROM orders GROUP BY 1) o ON o_custkey = c_custkey"


def _lanes(spark, d):
    o = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.to_date(F.max("o_orderdate")).alias("latest"))
    lane = F.when(F.col("n") <= 8, "OPEN").when(F.col("n") <= 10, "EMERGING").otherwise("CROWDED")
    return t(spark, d, "customer").join(o, "c_custkey").withColumn("lane", lane)


@query(f"""WITH f AS (SELECT *, c_nationkey % 3 > 0 AS names, CASE c_mktsegment WHEN 'BUILDING' THEN 'TRAP' WHEN 'MACHINERY' THEN 'OPEN' WHEN 'FURNITURE' THEN 'TAKEN' END AS v FROM ({_LANES}) WHERE lane IN ('OPEN', 'EMERGING') ORDER BY latest DESC, c_custkey, c_name LIMIT 12)
SELECT CAST(row_number() OVER (ORDER BY names DESC, CASE WHEN names THEN CASE v WHEN 'OPEN' THEN 0 WHEN 'TAKEN' THEN 2 WHEN 'TRAP' THEN 3 ELSE 1 END ELSE 1 END, latest DESC, c_custkey, c_name) AS INT) AS rank, c_custkey AS target,
'## ' || c_custkey || ' - ' || lane || ', ' || n || ' filer(s), ' || CASE WHEN NOT names THEN 'mis-attributed' ELSE coalesce(v, '?') END || chr(10) || '- **Who is moving:** ' || c_name || ' (' || latest || ')' || chr(10) || '- **Title confirms target:** ' || CASE WHEN names THEN 'yes' ELSE 'no, verify' END || chr(10) || '- **prior art:** ' || CASE WHEN n > 7 THEN n::VARCHAR ELSE 'none on record' END AS section FROM f""")
def move_dossier(spark, d):
    v = F.when(F.col("c_mktsegment") == "BUILDING", "TRAP").when(F.col("c_mktsegment") == "MACHINERY", "OPEN").when(F.col("c_mktsegment") == "FURNITURE", "TAKEN")
    return rp.dossier(_lanes(spark, d), "c_custkey", "c_name", "latest", "lane", "n", names=F.col("c_nationkey") % 3 > 0, verdict=v, verdicts=fixed.VERDICTS, prior_art=F.when(F.col("n") > 7, F.col("n")))


@query(f"""WITH f AS (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN 3 WHEN n <= 6 AND c_name <> 'Customer#000000007' THEN 1 ELSE 2 END AS block FROM ({_LANES}) WHERE lane <> 'CROWDED'),
k AS (SELECT *, row_number() OVER (ORDER BY block, latest DESC, c_custkey, c_name) AS rank FROM (SELECT * FROM f ORDER BY block, latest DESC, c_custkey, c_name LIMIT 400))
SELECT block, CAST(rank AS INT) AS rank, '- *' || c_custkey || '*' || CASE WHEN block = 3 THEN ' (' || latest || ') - ' || c_name || ' has a new move, but skip it: the angle is taken.' ELSE ' - ' || CASE WHEN c_custkey = 7 THEN c_name || ' + others' WHEN n > 7 THEN c_name || ', ' || lower(c_mktsegment)[1:0] || upper(c_mktsegment[1:1]) || lower(c_mktsegment[2:]) ELSE c_name END || ' (' || latest || ').' END AS line, greatest(0, (SELECT count(*) FROM f) - 400) AS overflow FROM k""")
def digest_report(spark, d):
    rows = _lanes(spark, d).filter("lane <> 'CROWDED'").withColumn("filers", F.when(F.col("n") > 7, F.array("c_name", "c_mktsegment")).otherwise(F.array("c_name")))
    return rp.digest(rows, "c_custkey", "c_name", "latest", "filers", novel=F.col("n") <= 6, trap=F.col("c_mktsegment") == "BUILDING", limit=400, softened=[7])


@query("SELECT 'feed' AS which, count(*) AS n FROM (SELECT c_name FROM customer WHERE c_nationkey < 10 UNION SELECT c_name FROM customer WHERE c_acctbal > 5000) UNION ALL SELECT 'census', count(*) FROM (SELECT c_name FROM customer WHERE c_nationkey < 5 UNION SELECT c_name FROM customer WHERE c_acctbal > 5000) UNION ALL SELECT 'replaced', count(*) FROM customer WHERE c_acctbal > 5000")
def top_up_upsert(spark, d):
    """Hits come twice, in two spellings of their key."""
    c = t(spark, d, "customer").select("c_name", "c_acctbal", "c_nationkey")
    hits = c.filter("c_acctbal > 5000")
    hits = hits.unionByName(hits.withColumn("c_name", F.lower("c_name")))
    key = F.upper("c_name")
    feed, census = mv.top_up(c.filter("c_nationkey < 10"), c.filter("c_nationkey < 5"), hits, "c_name", key)
    replaced, _ = mv.top_up(c.filter("c_nationkey < 10"), c.filter("c_nationkey < 5"), hits, "c_name", key, full=True)
    out = None
    for name, df in (("feed", feed), ("census", census), ("replaced", replaced)):
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("which"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("""SELECT c_custkey, coalesce(f.v, CASE WHEN o.n > 12 THEN 'BUSY' END) AS verdict, o.latest FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(max(o_orderdate) AS DATE) AS latest FROM orders GROUP BY 1) o ON o_custkey = c_custkey LEFT JOIN (SELECT c_custkey AS k, 'FACT' AS v FROM customer WHERE c_mktsegment = 'BUILDING') f ON f.k = c_custkey""")
def judged_ranking(spark, d):
    c = t(spark, d, "customer").select("c_custkey")
    lanes = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.to_date(F.max("o_orderdate")).alias("latest"))
    facts = t(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("FACT").alias("verdict"))
    return mv.judged(c, "c_custkey", facts, lanes.select("c_custkey", F.when(F.col("n") > 12, "BUSY").alias("verdict")), lanes.select("c_custkey", "latest")).select("c_custkey", "verdict", "latest")


# --- statistics, samples, counts, forms ---

@query(f"""WITH r AS (SELECT emerged, row_number() OVER (ORDER BY signal, o_custkey) + row_number() OVER (ORDER BY o_custkey % 97, o_custkey) AS v FROM (SELECT * FROM ({_EMERGE}))), k AS (SELECT emerged, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0::DOUBLE AS rk FROM r)
SELECT round((rs - np * (np + 1) / 2) / (np * nn), 9) AS auc FROM (SELECT sum(rk) FILTER (emerged) AS rs, CAST(count(*) FILTER (emerged) AS DOUBLE) AS np, CAST(count(*) FILTER (NOT emerged) AS DOUBLE) AS nn FROM k)""")
def rank_sum_auc(spark, d):
    rows = _emerge(spark, d).withColumn("other", F.col("o_custkey") % 97)
    return bt.rank_sum(rows, ["signal", "other"], "emerged", "o_custkey").select(F.round("auc", 9).alias("auc"))


@query("SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS r, count(*) OVER () AS n FROM customer) WHERE r % greatest(1, n // 40) = 0")
def strided_sample(spark, d):
    return bt.strided(t(spark, d, "customer"), 40, F.col("c_acctbal"), F.col("c_custkey")).select("c_custkey")


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def count_only(spark, d):
    return rest.counts(t(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


@query("""SELECT s_suppkey, upper(s_name) AS assignee, CASE WHEN length(s_name) <= 8 AND NOT contains(s_name, ' ') THEN upper(s_name) ELSE s_name END AS form, 'https://patents.google.com/patent/' || s_name AS patent, CASE WHEN s_suppkey % 2 = 0 THEN 'https://euclinicaltrials.eu/ctis-public/#/study/20' || s_suppkey ELSE 'https://clinicaltrials.gov/study/NCT' || s_suppkey END AS trial, s_nationkey < 5 AS phase, 'Supplier O''Neil-' || s_suppkey || 'X' AS title FROM supplier""")
def scalar_forms(spark, d):
    s = t(spark, d, "supplier")
    trial = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("20"), "s_suppkey")).otherwise(F.concat(F.lit("NCT"), "s_suppkey"))
    phase = F.when(F.col("s_nationkey") < 5, "Phase I and Phase II").otherwise("Phase III")
    return s.select("s_suppkey", tx.assignee(F.concat("s_name", F.lit(" (US) Co., KGaA, LLP"))).alias("assignee"), tx.surface_form(F.col("s_name")).alias("form"), tx.patent_url(F.concat(F.lit("-"), "s_name")).alias("patent"), tx.trial_url(trial).alias("trial"), tx.phase_one(phase).alias("phase"), tx.title_case(F.concat(F.lit("SUPPLIER o'neil-"), "s_suppkey", F.lit("x"))).alias("title"))


@query("""SELECT key, arg_max(s_suppkey, (s_acctbal, s_suppkey)) AS s_suppkey FROM (SELECT s_suppkey, s_acctbal, unnest(['N' || s_nationkey, 'B' || (s_suppkey % 7)]) AS key FROM supplier) GROUP BY 1""")
def alias_last_wins(spark, d):
    rows = t(spark, d, "supplier").withColumn("packed", F.concat(F.lit("N"), "s_nationkey", F.lit("||B"), F.col("s_suppkey") % 7))
    return mv.by_alias(rows, "packed", F.col("s_acctbal"), "s_suppkey")


@query("""SELECT l_suppkey, l_partkey, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (ORDER BY n_patents > 0 AND n_trials > 0 DESC, earliest_kind = 'clinical' DESC, earliest DESC, l_suppkey, l_partkey) AS rank FROM (
SELECT l_suppkey, l_partkey, min(CAST(l_shipdate AS DATE)) AS earliest, count(*) FILTER (l_returnflag <> 'R') AS n_patents, count(*) FILTER (l_returnflag = 'R') AS n_trials, arg_min(CASE WHEN l_returnflag = 'R' THEN 'clinical' ELSE 'patent' END, (CAST(l_shipdate AS DATE), CASE WHEN l_returnflag = 'R' THEN 'clinical' ELSE 'patent' END)) AS earliest_kind FROM lineitem GROUP BY 1, 2)) WHERE rank <= 50""")
def moves_in_order(spark, d):
    m = t(spark, d, "lineitem").select("l_suppkey", "l_partkey", F.when(F.col("l_returnflag") == "R", "clinical").otherwise("patent").alias("kind"), F.to_date("l_shipdate").alias("day"), "l_orderkey")
    top = mv.in_report_order(mv.unify(m, "l_suppkey", "l_partkey", "kind", "day", "l_orderkey"), "cross_linked", "earliest_kind", "earliest", "l_suppkey", "l_partkey").limit(50)
    order = [F.col("cross_linked").desc(), (F.col("earliest_kind") == "clinical").desc(), F.col("earliest").desc(), F.col("l_suppkey"), F.col("l_partkey")]
    return cl.ranked(top, *order).select("l_suppkey", "l_partkey", F.col("rank").cast("int").alias("rank"))


@query("""SELECT n_regionkey, count(DISTINCT f) AS firms, CASE WHEN count(DISTINCT f) <= 1 THEN 'OPEN' WHEN count(DISTINCT f) <= 3 THEN 'EMERGING' WHEN count(DISTINCT f) <= 10 THEN 'CONTESTED' ELSE 'CROWDED' END AS lane FROM (SELECT n_regionkey, 'OWNER ' || (s_suppkey % 20) AS f FROM supplier JOIN nation ON n_nationkey = s_nationkey) GROUP BY 1""")
def firms_normalised(spark, d):
    """Spellings of one owner count once."""
    s = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    spelling = F.concat(F.lit("Owner "), F.col("s_suppkey") % 20, F.when(F.col("s_suppkey") % 2 == 0, ", Inc.").otherwise(" (US) LLC"))
    g = s.withColumn("firm", tx.organisation(spelling)).groupBy("n_regionkey").agg(F.countDistinct("firm").alias("firms"))
    return g.withColumn("lane", cr.tier(F.col("firms"), **cr.LANE))


_HANDLES = "list_concat(list_transform(list_filter(range(1, 5), lambda i: substr(p_name, i, 1) = 'e'), lambda i: 'front@' || i), list_transform(list_filter(range(5, 11), lambda i: substr(p_name, i, 1) = 'e'), lambda i: 'hinge@' || i))"


@query(f"""SELECT p_brand, p_partkey, array_to_string(h, ',') AS handles, CASE WHEN b = 1 THEN 'hinge' ELSE 'front' END AS best FROM (
SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY b, p_partkey) AS n FROM (SELECT p_brand, p_partkey, h, CASE WHEN contains(array_to_string(h, ','), 'hinge') THEN 1 ELSE 2 END AS b FROM (SELECT *, {_HANDLES} AS h FROM part WHERE length(p_name) = 10) WHERE len(h) > 0)) WHERE n = 1""")
def pocket_selection(spark, d):
    got = cr.pockets(t(spark, d, "part"), "p_brand", "p_partkey", "p_name", 10, "e", [("front", 1, 4), ("hinge", 5, 10)], ["hinge", "front"])
    return got.withColumn("handles", F.array_join("handles", ","))


@query(f"""SELECT h.o_custkey, h.recent, round(h.accel, 6) AS accel, c_name, coalesce(l.n, 0) AS late FROM (SELECT o_custkey, recent, (recent / 2.0::DOUBLE) / (base / 3.0::DOUBLE + 1) AS accel FROM ({_YEARS}) WHERE recent >= 3 ORDER BY accel DESC, o_custkey LIMIT 40) h
LEFT JOIN customer ON c_custkey = h.o_custkey LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY 1) l ON l.o_custkey = h.o_custkey""")
def momentum_hot(spark, d):
    """The hottest 40, with what else is known of them."""
    o = t(spark, d, "orders")
    y = bt.year_sums(o, "o_custkey", F.year("o_orderdate"), F.lit(1), recent=(1998, 2001), base=(1995, 1997))
    hot = cr.accelerating(y, "recent", "base", (2, 3), 3).orderBy(F.col("accel").desc(), "o_custkey").limit(40)
    late = o.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).groupBy("o_custkey").agg(F.count("*").alias("late"))
    wide = mv.widened(hot, "o_custkey", (t(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), {}), (late, {"late": 0}))
    return wide.select("o_custkey", "recent", F.round("accel", 6).alias("accel"), "c_name", "late")


@query(f"""SELECT subject, source_record_id, path, substr(sha1(concat_ws('|', 'parts', source_record_id, 'patent', subject)), 1, 16) AS claim_key FROM (SELECT entity AS subject, CAST(p_partkey AS VARCHAR) AS source_record_id, path FROM ({ORACLE['mention_explode']}))""")
def claims_from_text(spark, d):
    found = mention_explode(spark, d)
    claims = cl.build(found, subject=F.col("entity"), evidence_type=F.lit("patent"), source=F.lit("parts"), record=F.col("p_partkey"), actor=F.lit(""), valid_time=F.lit(None), observed_at=F.lit("2024-01-01"), path=F.col("path"))
    return claims.select("subject", "source_record_id", "path", "claim_key")


# --- sinks and streams, written and read back ---

def _folder(spark, name):
    return f"{shared.base_uri(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"SELECT source, path, count(*) AS n, min(valid_time) AS first, max(claim_key) AS last_key FROM ({_CLAIMS}) GROUP BY 1, 2")
def claim_log_append(spark, d):
    """The log after all claims were appended once in part and once whole: each is there once."""
    claims, at_path = _claims(spark, d), _folder(spark, "claim-log")
    for part in (claims.filter("path = 'A'"), claims):
        files.append_new(part, at_path, cl.CLAIM)
    log = files.json_lines(spark, at_path, cl.CLAIM)
    return log.groupBy("source", "path").agg(F.count("*").alias("n"), F.min("valid_time").alias("first"), F.max("claim_key").alias("last_key"))


@query("SELECT DISTINCT user_id FROM events")
def stream_append(spark, d):
    """A stream appended by key, run again from its beginning: nothing comes twice."""
    schema, out = t(spark, d, "events").schema, _folder(spark, "stream-log")
    for run in ("first", "again"):
        st.append_new(st.source(spark, f"{d}/events.parquet*", schema), out, _folder(spark, f"checkpoint-{run}"), "user_id").awaitTermination()
    return spark.read.schema(schema).parquet(out).select("user_id")


@query("SELECT user_id, props, min(ts) AS earliest, max(ts) AS latest, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds, count(DISTINCT event_type) > 1 AS cross_linked FROM events GROUP BY 1, 2")
def stream_merged_moves(spark, d):
    """Moves of a pair merged as they come, whatever their source."""
    path, k = _several_files(spark, d)
    events = st.source(spark, path, t(spark, d, "events").schema, files=k)
    merged, out = st.merged_moves(events, "user_id", "props", "event_type", "ts"), _folder(spark, "merged-moves")
    st.upserted(merged, out, _folder(spark, "checkpoint"))
    return st.latest(spark, out, ["user_id", "props"], merged.schema).withColumn("kinds", F.array_join("kinds", ","))


@query("SELECT p_brand, count(*) AS n, max(p_retailprice) AS top FROM part GROUP BY 1")
def state_versions(spark, d):
    """Keyed state: the newest whole version is read, whatever older ones hold."""
    state = t(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.max("p_retailprice").alias("top"))
    at_path = _folder(spark, "state")
    files.replace_state(state.limit(3), at_path, 9)
    files.replace_state(state, at_path, 10)
    return files.newest_state(spark, at_path, state.schema)
