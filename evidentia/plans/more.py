"""Queries of streams with state, joint commits, life cycles of identifiers and claims in two times, each with the same question in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.functions import fixed
from evidentia.functions import text as tx
from evidentia.functions import xml as xm
from evidentia.operators import alignment as al
from evidentia.operators import attribution as at
from evidentia.operators import backtest as bt
from evidentia.operators import crowding as cr
from evidentia.operators import lifecycle as lc
from evidentia.operators import moves as mv
from evidentia.operators import resolve as rs
from evidentia.plans.queries import RULES, _folder, _several_files, query, t
from evidentia.sources import commits, files
from evidentia.streaming import keyed as ky
from evidentia.streaming import state as st


@query("""WITH e AS (SELECT event_id, user_id, event_type, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS before, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) AS n FROM events)
SELECT user_id, count(*) FILTER (n > 1) AS changed, count(*) FILTER (n = 1) AS started, arg_max(event_type, (ts, event_type)) AS last FROM e WHERE n = 1 OR before <> event_type GROUP BY 1""")
def stream_changes(spark, d):
    """Changes of each user's state as they come, over several batches: how many, and the last one."""
    ky.with_state_store(spark)
    path, k = _several_files(spark, d)
    events, out = st.source(spark, path, t(spark, d, "events").schema, files=k), _folder(spark, "changes")
    st.appended(ky.changes(events, "user_id", "event_type", "ts"), out, _folder(spark, "checkpoint"))
    got = spark.read.schema("user_id long, at timestamp, before string, after string, status string").parquet(out)
    counts = [F.count_if(F.col("status") == s).alias(n) for s, n in (("CHANGED", "changed"), ("NEW", "started"))]
    return got.groupBy("user_id").agg(*counts, F.max_by("after", F.struct("at", "after")).alias("last"))


@query("SELECT user_id, event_type AS kind, min(ts) AS earliest, max(ts) AS latest, array_to_string(list_sort(list(DISTINCT props)), ',') AS kinds, count(DISTINCT props) > 1 AS cross_linked FROM events GROUP BY 1, 2")
def stream_upgraded_moves(spark, d):
    """Moves with state, over several batches and a restart in between: the last row of each pair."""
    ky.with_state_store(spark)
    (path, k), out, checkpoint = _several_files(spark, d), _folder(spark, "moves"), _folder(spark, "checkpoint")
    for _ in range(2):
        events = st.source(spark, path, t(spark, d, "events").schema, files=k).withColumn("ts", F.col("ts").cast("timestamp"))
        st.appended(ky.upgraded_moves(events, "user_id", "event_type", "props", "ts"), out, checkpoint)
    rows = spark.read.schema("user_id long, event_type string, earliest timestamp, latest timestamp, kinds string, cross_linked boolean").parquet(out)
    newest = rows.groupBy("user_id", "event_type").agg(F.max_by(F.struct("earliest", "latest", "kinds", "cross_linked"), F.struct(F.size(F.split("kinds", ",")), "latest", F.negative(F.unix_micros("earliest")))).alias("m"))
    return newest.select("user_id", F.col("event_type").alias("kind"), F.col("m.earliest").cast("timestamp_ntz").alias("earliest"), F.col("m.latest").cast("timestamp_ntz").alias("latest"), "m.kinds", "m.cross_linked")


# --- identifiers, claims in two times, joint commits ---

_RENAMED = "SELECT s_suppkey AS old, s_suppkey // 3 AS new, CASE WHEN s_suppkey % 5 = 0 THEN 2 ELSE 1 END AS version FROM supplier WHERE s_suppkey > 2 AND s_nationkey <> 7"


@query(f"""WITH RECURSIVE c AS (SELECT old, new FROM ({_RENAMED}) WHERE version <= 1), r AS (SELECT old AS id, new AS tip FROM c UNION ALL SELECT id, new FROM r JOIN c ON c.old = r.tip)
SELECT p.l_suppkey AS original, coalesce(x.tip, p.l_suppkey) AS l_suppkey, p.n, 'v1' AS id_version FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) p LEFT JOIN (SELECT id, tip FROM r WHERE tip NOT IN (SELECT old FROM c)) x ON x.id = p.l_suppkey""")
def canonical_ids(spark, d):
    """Suppliers renamed and merged in chains (each into a third of its number), as version 1 of the identifiers knows it."""
    s = t(spark, d, "supplier").filter("s_suppkey > 2 and s_nationkey <> 7")
    renamed = s.select(F.col("s_suppkey").alias("old"), F.floor(F.col("s_suppkey") / 3).alias("new"), F.when(F.col("s_suppkey") % 5 == 0, 2).otherwise(1).alias("version"))
    names = lc.canonical_ids(lc.by_version(renamed, "old", "new", "version", F.lit(1)), "old", "new")
    claims = t(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return lc.as_canonical(claims, "l_suppkey", names, "v1")


_TWO_TIMES = "SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS valid, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) AS observed, o_orderpriority AS v, o_orderkey AS o FROM orders"


def _two_times(spark, d):
    day = F.to_date("o_orderdate")
    return t(spark, d, "orders").select(F.col("o_custkey").alias("k"), day.alias("valid"), F.date_add(day, (F.col("o_orderkey") % 400).cast("int")).alias("observed"), F.col("o_orderpriority").alias("v"), F.col("o_orderkey").alias("o"))


@query(f"""WITH c AS (SELECT k, valid, observed, v, o, lead(observed) OVER (PARTITION BY k, valid ORDER BY observed) AS until FROM (SELECT *, row_number() OVER (PARTITION BY k, valid, observed ORDER BY o DESC) AS n FROM ({_TWO_TIMES})) WHERE n = 1),
f AS (SELECT k, valid, min(observed) AS since FROM c GROUP BY 1, 2),
stops AS (SELECT c.k, c.valid, c.observed, greatest(c.observed, f.since) AS tip FROM c JOIN f ON f.k = c.k AND f.valid > c.valid AND (c.until IS NULL OR f.since < c.until) UNION SELECT k, valid, observed, observed FROM c),
nexts AS (SELECT s.k, s.valid, s.observed, s.tip, min(f.valid) AS valid_to FROM stops s LEFT JOIN f ON f.k = s.k AND f.valid > s.valid AND f.since <= s.tip GROUP BY 1, 2, 3, 4),
kept AS (SELECT *, lag(valid_to) OVER w AS before, row_number() OVER w AS i FROM nexts WINDOW w AS (PARTITION BY k, valid, observed ORDER BY tip))
SELECT c.k, c.valid, x.tip AS observed, c.v, c.o, x.valid_to, coalesce(lead(x.tip) OVER (PARTITION BY x.k, x.valid, x.observed ORDER BY x.tip), c.until) AS observed_to FROM (SELECT * FROM kept WHERE i = 1 OR valid_to IS DISTINCT FROM before) x JOIN c USING (k, valid, observed)""")
def claim_rectangles(spark, d):
    """Orders as claims about their day, observed up to 399 days later and in any order."""
    return lc.rectangles(_two_times(spark, d), "k", "valid", "observed", "o")


@query(f"""SELECT k, v FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY valid DESC, observed DESC, o DESC) AS n FROM ({_TWO_TIMES}) WHERE valid <= DATE '1999-03-01' AND observed <= DATE '1999-06-01') WHERE n = 1""")
def claims_as_of_both(spark, d):
    """What was known in June to hold in March."""
    day = lambda x: F.lit(x).cast("date")
    return lc.known_to_hold(_two_times(spark, d), "k", "valid", "observed", day("1999-03-01"), day("1999-06-01"), "o").select("k", "v")


@query("SELECT 'feed' AS name, count(*) AS n, max(c_custkey) AS last FROM customer WHERE c_nationkey < 10 OR c_acctbal > 5000 UNION ALL SELECT 'census', count(*), max(c_custkey) FROM customer WHERE c_nationkey < 5 OR c_acctbal > 5000")
def feed_and_census(spark, d):
    """Feed and census change together: a second version adds the same hits to both, and readers see both or neither."""
    c, at_path = t(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey"), _folder(spark, "joint")
    commits.commit(spark, at_path, {"feed": c.filter("c_nationkey < 10"), "census": c.filter("c_nationkey < 5")}, 0)
    hits = c.filter("c_acctbal > 5000")
    commits.update(spark, at_path, lambda tables: {n: x.unionByName(hits.join(x, "c_custkey", "left_anti").select(*x.columns)) for n, x in tables.items()})
    _, tables = commits.read(spark, at_path)
    rows = [tables[n].agg(F.count("*").alias("n"), F.max("c_custkey").alias("last")).select(F.lit(n).alias("name"), "n", "last") for n in ("feed", "census")]
    return rows[0].unionByName(rows[1])


# --- landscape, opportunities, cascade with all levels ---

_PROGRAMS = "SELECT l_partkey AS target, CASE l_suppkey % 5 WHEN 0 THEN 'University ' || l_suppkey WHEN 1 THEN 'John Smith' ELSE 'Sponsor ' || l_suppkey END AS sponsor, l_shipmode AS phase, 'D' || l_linenumber AS drug FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'PHASE3' WHEN 'R' THEN 'PHASE2' ELSE 'NA' END AS l_shipmode FROM lineitem)"


@query(f"""WITH p AS ({_PROGRAMS}), e AS (SELECT target, sponsor, max(CASE phase WHEN 'PHASE3' THEN 3 WHEN 'PHASE2' THEN 2 ELSE 0 END) AS r, min(drug) AS d FROM p WHERE sponsor LIKE 'Sponsor%' GROUP BY 1, 2),
c AS (SELECT target, count(*) AS n_clinical, arg_min({{'s': sponsor, 'p': CASE r WHEN 3 THEN 'PHASE3' WHEN 2 THEN 'PHASE2' ELSE 'NA' END, 'd': d}}, (-r, sponsor)) AS lead FROM e GROUP BY 1),
l AS (SELECT o_custkey AS target, count(*) AS n_landscape, bool_or(o_orderstatus = 'P') AS covalent FROM orders GROUP BY 1), f AS (SELECT DISTINCT p_partkey AS target FROM part WHERE p_size > 40),
a AS (SELECT target, coalesce(n_clinical, 0) AS n_clinical, coalesce(n_landscape, 0) AS n_landscape, lead, coalesce(covalent, false) OR f.target IS NOT NULL AS contested FROM c FULL JOIN l USING (target) FULL JOIN f USING (target))
SELECT target, n_clinical, n_landscape, lead.s AS leader, lead.p AS phase, lead.d AS drug, CASE WHEN greatest(n_clinical, n_landscape) <= 1 THEN 'OPEN' WHEN greatest(n_clinical, n_landscape) <= 4 THEN 'CONTESTED' ELSE 'CROWDED' END AS crowding, CASE WHEN contested THEN 'contested' ELSE 'open' END AS covalent_lane FROM a""")
def competition(spark, d):
    """Registry programs without academic and personal sponsors, entries found elsewhere, filers."""
    li = t(spark, d, "lineitem")
    kind, who = F.col("l_suppkey") % 5, F.col("l_suppkey").cast("string")
    sponsor = F.when(kind == 0, F.concat(F.lit("University "), who)).when(kind == 1, "John Smith").otherwise(F.concat(F.lit("Sponsor "), who))
    phase = F.when(F.col("l_returnflag") == "A", "PHASE3").when(F.col("l_returnflag") == "R", "PHASE2").otherwise("NA")
    programs = li.select(F.col("l_partkey").alias("target"), sponsor.alias("sponsor"), phase.alias("phase"), F.concat(F.lit("D"), F.col("l_linenumber").cast("string")).alias("drug"))
    entries = t(spark, d, "orders").select(F.col("o_custkey").alias("target"), (F.col("o_orderstatus") == "P").alias("covalent"))
    filers = t(spark, d, "part").filter("p_size > 40").select(F.col("p_partkey").alias("target"))
    return cr.competition(programs, filers, entries, "target", "sponsor", "phase", {"PHASE3": 3, "PHASE2": 2}, "drug", "covalent")


@query("""WITH a AS (SELECT key, arg_max(symbol, pos) AS symbol FROM (SELECT unnest(['S' || s_suppkey, 'S' || (s_suppkey + 7)]) AS key, 'G' || (s_suppkey // 3) AS symbol, s_suppkey AS pos FROM supplier) GROUP BY 1),
n AS (SELECT 'S' || l_suppkey AS id, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
e AS (SELECT 'S' || s_suppkey AS id, s_suppkey, s_acctbal > 3000 AS fda, s_nationkey % 2 = 0 AS chembl, s_acctbal > 0 AS ligandable FROM supplier),
k AS (SELECT a.symbol, e.*, coalesce(n.n, 0) AS sites, EXISTS (SELECT 1 FROM customer WHERE c_nationkey = 3 AND 'G' || c_custkey = a.symbol) AS closed, EXISTS (SELECT 1 FROM customer WHERE c_nationkey = 5 AND 'G' || c_custkey = a.symbol) AS toxic FROM e JOIN a ON a.key = e.id LEFT JOIN n ON n.id = e.id WHERE ligandable)
SELECT symbol, bool_or(fda) AS fda, bool_or(chembl) AS chembl, bool_or(closed) AS closed, bool_or(toxic) AS toxic, max(sites) AS n_sites, arg_min(id, s_suppkey) AS id, CASE WHEN bool_or(fda) AND NOT bool_or(closed) AND NOT bool_or(toxic) THEN 'opportunity' WHEN bool_or(fda) AND NOT bool_or(closed) THEN 'toxic' ELSE 'other' END AS bucket FROM k GROUP BY 1""")
def opportunity_table(spark, d):
    """Entities under the symbols of their packed aliases, flags merged, against what is closed and toxic."""
    s = t(spark, d, "supplier")
    name = lambda c, x: F.concat(F.lit(x), c.cast("string"))
    aliases = mv.by_alias(s.select(F.concat_ws("|", name(F.col("s_suppkey"), "S"), name(F.col("s_suppkey") + 7, "S")).alias("packed"), name(F.floor(F.col("s_suppkey") / 3), "G").alias("symbol"), "s_suppkey"), "packed", F.col("s_suppkey"), "symbol")
    entities = s.select(name(F.col("s_suppkey"), "S").alias("id"), "s_suppkey", (F.col("s_acctbal") > 3000).alias("fda"), (F.col("s_nationkey") % 2 == 0).alias("chembl"), (F.col("s_acctbal") > 0).alias("ligandable"))
    sites = t(spark, d, "lineitem").filter("l_returnflag = 'A'").select(name(F.col("l_suppkey"), "S").alias("id"))
    symbols = lambda nation: t(spark, d, "customer").filter(F.col("c_nationkey") == nation).select(name(F.col("c_custkey"), "G").alias("symbol"))
    out = cr.opportunity_table(entities, "id", aliases, sites, ["fda", "chembl"], "ligandable", "fda", symbols(3), symbols(5), [F.col("s_suppkey")])
    return out.select("symbol", "fda", "chembl", "closed", "toxic", "n_sites", "id", "bucket")


@query("""WITH p AS (SELECT page_id % 499 AS doc_id, string_agg(url || ' ' || regexp_replace(html, '<[^>]*>', ' ', 'g'), ' ' ORDER BY page_id) AS t FROM (SELECT *, row_number() OVER (PARTITION BY page_id % 499 ORDER BY page_id) AS n FROM pages) WHERE n <= 5 GROUP BY 1),
d AS (SELECT doc_id, n_chars, CASE WHEN regexp_matches(text, '(?i)token =') THEN 'LIKELY' WHEN lang = 'en' THEN 'LIKELY' WHEN lang = 'de' THEN 'POSSIBLE' ELSE 'NONE' END AS a,
3 * (text ILIKE '%licensed under%')::INT + 2 * (text ILIKE '%@mail%')::INT + 2 * regexp_matches(text, '[0-9]{4}')::INT + regexp_matches(text, ' [|] ')::INT AS score FROM documents),
f AS (SELECT *, CASE WHEN score >= 4 AND a IN ('NONE', 'POSSIBLE') THEN 'FINGERPRINT' ELSE a END AS b FROM d),
g AS (SELECT f.*, CASE WHEN b <> 'LIKELY' AND coalesce(regexp_matches(t, '(?i)method') OR (regexp_matches(t, '(?i)der') AND NOT regexp_matches(t, '(?i)und')), false) THEN 'LIKELY' ELSE b END AS c FROM f LEFT JOIN p USING (doc_id))
SELECT doc_id, CASE WHEN n_chars % 7 = 0 AND c <> 'LIKELY' AND n_chars % 2 = 0 THEN 'LIKELY' WHEN n_chars % 7 = 0 AND c = 'NONE' THEN 'POSSIBLE' ELSE c END AS level FROM g""")
def covalency_cascade(spark, d):
    """All levels: link, class word, fingerprint, the first five publications of each (pages), and the web with and without a source."""
    docs, pages = t(spark, d, "documents"), t(spark, d, "pages")
    refs = pages.select((F.col("page_id") % 499).alias("doc_id"), F.col("page_id").alias("pmid"))
    papers = pages.select("page_id", "url", F.regexp_replace("html", "<[^>]*>", " ").alias("abstract"))
    texts = mv.publications(refs, "doc_id", "pmid", "pmid", papers, "page_id", "url", "abstract").withColumnRenamed("text", "published")
    score, _ = tx.fingerprint(F.col("text"), RULES)
    link = F.when(F.col("lang") == "en", "LIKELY").when(F.col("lang") == "de", "POSSIBLE").otherwise("NONE")
    known = tx.guarded(F.col("published"), "method", "der", "und")
    level = mv.covalency(link, F.col("text").rlike("(?i)token ="), score, known, F.col("n_chars") % 7 == 0, F.when(F.col("n_chars") % 2 == 0, 1))
    return docs.join(texts, "doc_id", "left").select("doc_id", level.alias("level"))


@query("SELECT l_orderkey, min(CAST(l_shipdate AS DATE)) FILTER (l_returnflag = 'R') AS first_return FROM lineitem GROUP BY 1")
def first_of_nested(spark, d):
    """The first date among those elements of a nested list that are of one kind."""
    nested = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_returnflag", F.to_date("l_shipdate").alias("day"))).alias("lines"))
    first = tx.least_of(F.col("lines"), lambda x: x["l_returnflag"] == "R", lambda x: x["day"])
    return nested.select("l_orderkey", first.alias("first_return"))


_SAID = ["Compounds as SARS inhibitors", "Bifunctional degrader of {}", "Methods of treating {}", "Inhibitors of {} kinase", "Combination therapy with {}", "Antibody conjugates", "Glutarimide compounds", "Pyrimidines as {} modulators"]


@query(f"""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'trusted' WHEN regexp_matches(title, '(?i){fixed.EXCLUDE}') THEN 'excluded' WHEN regexp_matches(title, '(?i){fixed.DEGRADER}') THEN 'degrader' WHEN regexp_matches(symbol, '(?i){fixed.IMPLAUSIBLE}') OR regexp_matches(symbol, '(?i){fixed.NOT_TARGET}') THEN 'candidate' WHEN conf = 'title' AND NOT regexp_matches(title, '(?i){fixed.METHOD}') THEN 'trusted' ELSE 'candidate' END AS grade FROM (
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'title' WHEN 1 THEN 'claims' ELSE 'body' END AS conf, [{', '.join(f"'OR{i}A', 'COL{i}', 'EGFR{i}'" for i in range(3))}][o_custkey % 9 + 1] AS symbol, replace([{', '.join(f"'{x}'" for x in _SAID)}][o_orderkey % {len(_SAID)} + 1], '{{}}', o_orderpriority) AS title FROM orders)""")
def grade_titles(spark, d):
    """The patterns of the grade themselves, over titles made of the tables' values."""
    symbols = F.array(*[F.lit(x) for i in range(3) for x in (f"OR{i}A", f"COL{i}", f"EGFR{i}")])
    said = F.array(*map(F.lit, _SAID))
    at_ = lambda c, n: (F.col(c) % n + 1).cast("int")
    o = t(spark, d, "orders").withColumns({"symbol": F.element_at(symbols, at_("o_custkey", 9)), "title": F.replace(F.element_at(said, at_("o_orderkey", len(_SAID))), F.lit("{}"), F.col("o_orderpriority"))})
    conf = F.when(F.col("o_orderkey") % 3 == 0, "title").when(F.col("o_orderkey") % 3 == 1, "claims").otherwise("body")
    implausible = F.col("symbol").rlike("(?i)" + fixed.IMPLAUSIBLE) | F.col("symbol").rlike("(?i)" + fixed.NOT_TARGET)
    grade = at.grade(conf, F.col("title"), radar=F.col("o_orderkey") % 11 == 0, exclude=fixed.EXCLUDE, degrader=fixed.DEGRADER, implausible=implausible, method=fixed.METHOD)
    return o.select("o_orderkey", grade.alias("grade"))


# --- forms of single values ---

_BASE = "SELECT s_suppkey AS k, s_name AS n, s_acctbal AS b, s_nationkey AS c FROM supplier"


@query(f"""SELECT k, lower(n) AS base, 'US' || (1000 + k) AS publication, DATE '2020-01-01' + k::INT % 300 AS compact, DATE '2021-03-01' + k::INT % 28 AS slashed, k * 1000.0::DOUBLE + 0.5 AS number, 'Supplier covalent ' || k AS snippet, CASE WHEN k % 3 = 0 THEN '-' ELSE n END AS first,
k % 2 = 0 OR k % 7 = 1 AS academic, k % 5 > 1 AS supported, CASE WHEN k % 2 = 0 THEN 'u' || k ELSE '' END AS link, CAST(k % 4 AS INT) AS n_rescued, k % 3 = 1 AS residue, 'KRAS,T' || k AS tokens, 'm' || k || ' d' || k || ' 1y' AS design FROM ({_BASE})""")
def value_forms(spark, d):
    """Names, numbers, dates, lists and links in the forms that sources have them in, each back to its value."""
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("n"))
    k = F.col("k")
    text = lambda *c: F.concat(*(x if not isinstance(x, str) else F.lit(x) for x in c))
    kk = k.cast("string")
    salt = F.element_at(F.array(*map(F.lit, [" Hydrochloride", " mesylate  monohydrate", "", " sodium"])), (k % 4 + 1).cast("int"))
    day = lambda start, n: F.date_add(F.lit(start).cast("date"), (k % n).cast("int"))
    outcomes = F.array(F.struct(text("m", kk).alias("measure"), text("d", kk).alias("description"), F.lit("1y").alias("timeFrame")))
    sponsor = F.when(k % 2 == 0, text("Hospital ", kk)).when(k % 7 == 1, "Anna Miller").otherwise(text("Maker ", kk, " Ltd"))
    values = {
        "base": tx.base_substance(text(F.col("n"), salt)),
        "publication": tx.publication_key(text("US-", (k + 1000).cast("string"), "-A1")),
        "compact": tx.compact_date(F.date_format(day("2020-01-01", 300), "yyyyMMdd")),
        "slashed": tx.slashed_date(text("seen ", F.date_format(day("2021-03-01", 28), "dd/MM/yyyy"), " there")),
        "number": tx.number(text(kk, ",000.5")),
        "snippet": tx.snippet(text("a Supplier covalent ", kk, " of"), r"supplier covalent \d+"),
        "first": tx.first_or(F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array("n", F.lit("x"))), "-"),
        "academic": tx.academic(sponsor),
        "supported": tx.supported(F.when(k % 5 != 1, True), F.when(k % 5 > 0, F.array("n")).otherwise(F.array().cast("array<string>"))),
        "n_rescued": F.size(tx.rescued_json(text("Here: ```json\n[", F.array_join(F.transform(F.filter(F.sequence(F.lit(0), k % 4), lambda i: i > 0), lambda i: text('{"a": ', i.cast("string"), "}")), ", "), "]\n``` so"), "array<struct<a:int>>")),
        "residue": al.residue_is(F.when(k % 3 == 1, "AC").otherwise("CA"), F.lit(2)),
        "tokens": F.array_join(tx.unsuppressed(text("KRAS HER2-negative T", kk, " EGFR mutant"), 1, 7), ","),
        "design": F.trim(tx.design_text(outcomes, F.lit(""))),
    }
    linked = mv.live(s.withColumn("link", text("u", kk)), "link", F.when(k % 2 == 0, True))
    return linked.select("k", "link", *(c.alias(name) for name, c in values.items()))


@query("""SELECT p_partkey, concat_ws('|', '1. A ' || p_name || ' of ' || p_size || '.', CASE WHEN p_size % 2 = 0 THEN '3. A use & a ' || p_brand || '.' END) AS blob, concat_ws('|', 'A ' || p_name || ' of ' || p_size || '.', CASE WHEN p_size % 2 = 0 THEN 'A use of ' || p_brand || '.' END) AS plain FROM part""")
def independent_claims(spark, d):
    """Claims of documents in XML (one blob of numbered lines, or an element each) and in plain text."""
    p = t(spark, d, "part")
    even = F.col("p_size") % 2 == 0
    one, size = F.concat(F.lit("1. A "), F.col("p_name"), F.lit(" of ")), F.col("p_size").cast("string")
    use = F.when(even, F.concat(F.lit("3. A use &amp; a <b>"), F.col("p_brand"), F.lit("</b>."))).otherwise(F.lit("3. The thing of claims 1-2."))
    blob = F.concat(F.lit('<r xmlns:x="u"><x:claims><x:claim id="c"><x:claim-text>'), one, F.lit("</x:claim-text><x:claim-text>\n"), size, F.lit(".</x:claim-text><x:claim-text>2. The thing of Claim 1,</x:claim-text><x:claim-text>but green.</x:claim-text><x:claim-text>"), use, F.lit("</x:claim-text></x:claim></x:claims></r>"))
    each = F.concat(F.lit("<claims><claim><claim-text>"), one, size, F.lit(".</claim-text></claim><claim><claim-text>2. That of <claim-ref>it</claim-ref>.</claim-text></claim><claim><claim-text>"), use, F.lit("</claim-text></claim></claims>"))
    doc = F.when(F.col("p_partkey") % 2 == 0, blob).otherwise(each)
    text = F.concat(F.lit("1. A "), "p_name", F.lit(" of "), size, F.lit(".\n2. That of claim 1.\n 3. "), F.when(even, F.concat(F.lit("A use of "), "p_brand", F.lit("."))).otherwise("One as in Claims 1 and 2."))
    return p.select("p_partkey", F.array_join(xm.independent_claims(doc), "|").alias("blob"), F.array_join(tx.independent_claims(text), "|").alias("plain"))


@query("""WITH n AS (SELECT p_partkey, lower(trim(p_name)) AS base FROM part), pa AS (SELECT lower(trim(p_name)) AS base, list(DISTINCT p_brand) AS parents FROM part WHERE p_size > 45 GROUP BY 1),
tg AS (SELECT p_brand AS parent, list_sort(list(DISTINCT 'Supplier#' || lpad(CAST(p_partkey % 50 AS VARCHAR), 9, '0'))) AS t FROM part WHERE p_size % 10 = 0 GROUP BY 1), fb AS (SELECT lower(trim(p_name)) AS base, list_sort(list(DISTINCT p_type)) AS f FROM part WHERE p_size < 3 GROUP BY 1),
j AS (SELECT p_partkey, len(parents) > 1 AS many, CASE WHEN len(parents) > 1 THEN NULL ELSE coalesce(t, f) END AS s FROM n LEFT JOIN pa USING (base) LEFT JOIN tg ON tg.parent = CASE WHEN len(parents) = 1 THEN parents[1] END LEFT JOIN fb USING (base)),
e AS (SELECT p_partkey, many, unnest(CASE WHEN s IS NULL THEN [NULL] ELSE s END) AS symbol FROM j)
SELECT p_partkey, symbol, CASE WHEN coalesce(many, false) THEN 'AMBIGUOUS' WHEN s_suppkey IS NOT NULL THEN 'RESOLVED' ELSE 'UNRESOLVED' END AS outcome, CAST(s_suppkey AS VARCHAR) AS id FROM e LEFT JOIN supplier ON upper(s_name) = upper(symbol)""")
def substance_cascade(spark, d):
    """Names to their only parent, the parent's targets, or else a fallback's, each resolved."""
    p, s = t(spark, d, "part"), t(spark, d, "supplier")
    parents = p.filter("p_size > 45").select(F.concat("p_name", F.lit(" sodium")).alias("name"), F.col("p_brand").alias("parent"))
    targets = p.select(F.col("p_brand").alias("parent"), F.concat(F.lit("Supplier#"), F.lpad((F.col("p_partkey") % 50).cast("string"), 9, "0")).alias("symbol"), F.when(F.col("p_size") % 10 == 0, "SINGLE PROTEIN").otherwise("FAMILY").alias("kind"))
    fallback = p.filter("p_size < 3").select(F.col("p_name").alias("name"), F.col("p_type").alias("symbol"))
    sym, alias = rs.index(s, "s_suppkey", "s_name")
    names = p.select("p_partkey", F.concat("p_name", F.lit(" Hydrochloride")).alias("drug"))
    return rs.resolve_substance(names, "drug", parents, targets, fallback, sym, alias).select("p_partkey", "symbol", "outcome", "id")


@query("""SELECT c_custkey FROM (SELECT c_custkey, c_mktsegment, sum((c_mktsegment = 'BUILDING')::INT) OVER (ORDER BY c_acctbal DESC, c_custkey) AS k, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 800 AND c_mktsegment = 'BUILDING' AND k <= 40""")
def screened_until(spark, d):
    """Early exit: in order, until 40 pass or 800 were looked at."""
    return bt.until(t(spark, d, "customer"), F.col("c_mktsegment") == "BUILDING", 40, 800, F.col("c_acctbal").desc(), F.col("c_custkey")).select("c_custkey")


# --- files, written and read back ---


@query("""SELECT 'tab' AS how, count(*) AS n, max(s_name) AS last FROM supplier UNION ALL SELECT 'comma', count(*), max(s_name) FROM supplier UNION ALL SELECT 'json', count(*), max(s_name) FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT 'keys', count(*), max('K' || s_suppkey) FROM supplier
UNION ALL SELECT 'xml', count(*), max(s_name) FROM supplier UNION ALL SELECT 'snapshot', count(*), max(s_name) FROM supplier WHERE s_suppkey > 3 UNION ALL SELECT 'pointer', 1, 'v2' UNION ALL SELECT 'dated', count(*), max(s_name) FROM supplier WHERE s_suppkey <= 40""")
def file_round_trips(spark, d):
    """A table through each kind of file."""
    s, at_path, out = t(spark, d, "supplier").select("s_suppkey", "s_name"), _folder(spark, "files"), []
    text = s.select(F.col("s_suppkey").cast("string").alias("k"), F.col("s_name").alias("v"))
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])

    def seen(how, df):
        out.append(df.agg(F.count("*").alias("n"), F.max("v").alias("last")).select(F.lit(how).alias("how"), "n", "last"))

    for how, sep in (("tab", "\t"), ("comma", ",")):
        text.write.option("sep", sep).option("header", True).csv(f"{at_path}/{how}")
        seen(how, files.delimited(spark, f"{at_path}/{how}", ["k", "v"], sep))
    files.overwrite_json(text, f"{at_path}/json")
    files.overwrite_json(s.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("k"), F.col("s_name").alias("v")), f"{at_path}/json")  # replaces the first
    seen("json", files.json_lines(spark, f"{at_path}/json", schema))
    text.select(F.concat(F.lit("K"), "k", F.lit(" (x)\tmore"))).write.text(f"{at_path}/keys")
    seen("keys", files.key_list(spark, f"{at_path}/keys").withColumnRenamed("key", "v"))
    text.write.format("xml").option("rowTag", "row").option("rootTag", "rows").save(f"{at_path}/xml")
    seen("xml", files.xml(spark, f"{at_path}/xml", "row", schema))
    for day, low in (("2024-01-05", 0), ("2024-02-01", 3)):
        text.filter(F.col("k").cast("int") > low).write.parquet(f"{at_path}/snapshots/{day}/t")
    newest = files.latest_snapshot(spark, f"{at_path}/snapshots", "t")
    seen("snapshot", files.parquet(spark, f"{at_path}/snapshots/{newest}/t", ["v"]))
    for v in ("v1", "v2"):
        files.write_pointer(spark, f"{at_path}/pointer", v)
    seen("pointer", files.constant(spark, [(files.read_pointer(spark, f"{at_path}/pointer"),)], "v string"))
    files.dated_snapshot(text.filter(F.col("k").cast("int") <= 9), f"{at_path}/dated", "2024-03-01")
    files.dated_snapshot(text.filter(F.col("k").cast("int") <= 40), f"{at_path}/dated", "2024-03-01")
    seen("dated", spark.read.schema(schema).parquet(f"{at_path}/dated/run_date=2024-03-01"))
    rows = out[0]
    for row in out[1:]:
        rows = rows.unionByName(row)
    return rows


# --- alignment inside a vote ---

_SEQUENCE = "regexp_replace(upper(p_name || p_type || p_brand), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g')"
_RESIDUE = f"CASE WHEN length({_SEQUENCE}) < 5 THEN '-' WHEN p_partkey % 3 = 1 THEN CASE substr({_SEQUENCE}, 5, 1) WHEN 'E' THEN 'W' ELSE 'E' END ELSE substr({_SEQUENCE}, 5, 1) END"


@query(f"""SELECT p_brand, p_size, verdict, first(verdict) OVER (PARTITION BY p_brand ORDER BY CASE verdict WHEN 'unique-handle' THEN 0 WHEN 'partial' THEN 1 ELSE 2 END) AS selectivity FROM (
SELECT p_brand, p_size, CASE count(*) FILTER (residue = 'E') WHEN 0 THEN 'unique-handle' WHEN count(*) THEN 'conserved-liability' ELSE 'partial' END AS verdict FROM (SELECT p_brand, p_size, {_RESIDUE} AS residue FROM part) GROUP BY 1, 2)""")
def paralog_vote(spark, d):
    """The residue that each paralog (the sequence itself, with another residue at the place, or with residues before it) has where the sequence has its fifth, found by alignment, and the votes."""
    p = t(spark, d, "part")
    a = F.regexp_replace(F.upper(F.concat("p_name", "p_type", "p_brand")), "[^ACDEFGHIKLMNPQRSTVWY]", "")
    other = F.concat(F.substring("a", 1, 4), F.when(F.substring("a", 5, 1) == "E", "W").otherwise("E"), F.expr("substring(a, 6)"))
    b = F.when(F.col("p_partkey") % 3 == 0, F.col("a")).when(F.col("p_partkey") % 3 == 1, other).otherwise(F.concat(F.lit("WWWW"), "a"))
    rows = p.withColumn("a", a).select("p_brand", "p_size", al.aligned_residue("a", F.lit(5), b).alias("residue"))
    return al.selectivity(rows, "p_brand", "p_size", "residue", "E")
