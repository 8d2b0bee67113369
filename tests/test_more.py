"""Gold cases of the text functions with their full lists, ranks over many wide rows, and operators against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from evidentia.functions import fixed
from evidentia.functions import text as tx
from evidentia.operators import alignment as al
from evidentia.operators import attribution as at
from evidentia.operators import backtest as bt
from evidentia.operators import claims as cl
from evidentia.operators import crowding as cr
from evidentia.operators import moves as mv
from evidentia.operators import resolve as rs
from evidentia.operators import screen as sc


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


@pytest.fixture
def small_partitions(spark):
    """Sizes at which adaptive execution cuts a million rows into many partitions, and other ones for every set of columns."""
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "300k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k", "spark.sql.shuffle.partitions": "64"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_ranks_of_a_million_wide_rows(spark, small_partitions):
    n = 1_000_000
    df = spark.range(n).select("id", (F.xxhash64("id") % 5000).alias("v"), F.repeat(F.sha1(F.col("id").cast("string")), 2).alias("payload"))
    got = cl.ranked(df, F.col("v").desc(), F.col("id"))
    assert got.columns == ["id", "v", "payload", "rank"]
    row = got.agg(F.count("*"), F.countDistinct("rank"), F.countDistinct("id"), F.min("rank"), F.max("rank")).first()
    assert tuple(row) == (n, n, n, 1, n)
    pairs = got.groupBy("v").agg(F.min("rank").alias("a"), F.max("rank").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a and x.v > y.v for x, y in zip(pairs, pairs[1:], strict=False))
    sums = bt.ranked_sum(df.groupBy("v").agg(F.count("*").alias("_c")), "v").orderBy("v").collect()
    before = 0
    for r in sums:
        assert r._before == before
        before += r._c
    assert before == n
    auc = bt.auc(df.withColumn("pos", F.col("v") > 0), "v", "pos").first()
    assert auc.auc == 1.0


def test_nearest_controls_however_far(spark):
    r = random.Random(3)
    cases = [(i, r.choice([0.0, 5.0, 5.0, 1e6, -300.0, r.uniform(0, 50)])) for i in range(40)] + [(99, None)]
    controls = [(1000 + i, r.choice([5.0, 7.0, r.uniform(0, 40)])) for i in range(60)] + [(5000, None)]
    df = lambda rows: spark.createDataFrame(rows, "k long, l double")
    for k in (1, 5, 100):
        got = {}
        for x in bt.matched(df(cases), df(controls), "k", "l", k).orderBy("rank").collect():
            got.setdefault(x.case, []).append(x.control)
        expect = {c: [b for _, b in sorted((abs(v - l), b) for b, v in controls if v is not None)[:k]] for c, l in cases if l is not None}
        assert got == expect
    assert bt.matched(df(cases), df(controls), "k", "l", 5, width=1.0).filter("distance > 1").count() == 0
    assert bt.matched(df(cases).limit(0), df(controls), "k", "l", 5).count() == bt.matched(df(cases), df(controls).limit(0), "k", "l", 5).count() == 0


def test_any_key_with_nulls(spark):
    left = spark.createDataFrame([("a", 1, None), ("a", None, 1), ("a", None, None), ("b", 2, 3), ("b", 2, 3), ("c", 9, 3)], "n string, x int, y int")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    got = [tuple(r) for r in at.semi_any(left, [F.col("x"), F.col("y")], right, "k").collect()]
    assert sorted(got, key=str) == sorted([("a", 1, None), ("a", None, 1), ("b", 2, 3), ("b", 2, 3), ("c", 9, 3)], key=str)
    assert at.semi_any(left, [F.col("x")], right.limit(0), "k").count() == 0


def test_gold_grades(spark):
    cases = [("title", "BTK", "BTK inhibitors", "trusted"), ("title", "SYK", "Novel SYK inhibitors", "trusted"), ("claims", "EGFR", "KRAS G12C inhibitors", "candidate"), ("claims", "ISYNA1", "Compounds", "candidate"), ("body", "RAF1", "Compounds", "candidate"),
             ("radar", "EGFR", "anything", "trusted"), ("title", "MPRO", "SARS-CoV-2 Mpro inhibitors", "excluded"), ("title", "IKZF2", "3-(1-oxoisoindolin-2-yl)piperidine-2,6-dione derivatives", "degrader"), ("title", "EGFR", "Combination therapy with an inhibitor", "candidate"), ("title", "OR5A1", "OR5A1 inhibitors", "candidate"), ("title", "COL1A1", "x", "candidate"), ("title", "BTK", None, "trusted")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, conf string, sym string, title string, expect string")
    symbol = F.col("sym").rlike("(?i)" + fixed.IMPLAUSIBLE) | F.col("sym").rlike("(?i)" + fixed.NOT_TARGET)
    g = at.grade(F.col("conf"), F.col("title"), radar=F.col("conf") == "radar", exclude=fixed.EXCLUDE, degrader=fixed.DEGRADER, implausible=symbol, method=fixed.METHOD)
    assert [r for r in df.select("expect", g.alias("g"), "title").collect() if r.expect != r.g] == []


def test_gold_fingerprints_and_verdicts(spark):
    score = column(spark, ["BTK receptor occupancy in PBMCs, irreversible binding", "MTD, PK and RECIST response", None], lambda c: tx.fingerprint(c, fixed.FINGERPRINT)[0])
    names = column(spark, ["BTK receptor occupancy in PBMCs, irreversible binding"], lambda c: tx.fingerprint(c, fixed.FINGERPRINT)[1])
    assert score == [7, 0, 0] and names == [["covalent_stated", "occupancy_timecourse", "pbmc_pd"]] and score[0] >= fixed.FINGERPRINT_LEAST
    verdict = lambda c: tx.guarded(c, fixed.STRONG, fixed.WORD, fixed.AGAINST)
    assert column(spark, ["an irreversible EGFR-TKI", "covalently binds Cys797", "a non-covalent inhibitor, unlike covalent ones", "reversible, not irreversible", None], verdict) == [True, True, False, False, False]
    assert column(spark, ["an irreversible EGFR-TKI and more"], lambda c: tx.snippet(c, fixed.WORD)) == ["irreversible"]


def test_gold_names(spark):
    firm = lambda c: tx.organisation(c, fixed.OWNERS, fixed.CHINESE)
    got = column(spark, ["Gilead Sciences, Inc.; Other Co", "ARRAY BIOPHARMA INC", "Mirati Therapeutics, Inc.", "Blueprint Medicines Corporation", "Genentech, Inc.", "吉利德科学公司", "Nimbus Lakshmi, Inc.", "Wilmington Savings Fund Society", "ANKURA TRUST COMPANY, LLC", "Some Tiny Biotech LLC", "US Bank National Association", "U.S. Bank National Association", "Foo KGaA", "Bar Oy AB", "INC", None], firm)
    assert got == ["GILEAD SCIENCES", "PFIZER", "BRISTOL MYERS SQUIBB", "SANOFI", "ROCHE", "GILEAD SCIENCES", "NIMBUS THERAPEUTICS", "", "", "SOME TINY BIOTECH", "", "U S BANK NATIONAL ASSOCIATION", "FOO", "BAR", "", ""]
    assert column(spark, ["Acme (US) Co., Ltd.", "Umbrella Trustee SAS", None], tx.assignee) == ["ACME", "UMBRELLA TRUSTEE", ""]
    assert column(spark, ["Imatinib Mesylate", "X dihydrochloride monohydrate", "calcium", "a  Besylate ", "sodium calcium", None], tx.base_substance) == ["imatinib", "x", "calcium", "a", "sodium", None]
    assert column(spark, ["egfr", "tyrosine kinase", "averylongname", None], tx.surface_form) == ["EGFR", "tyrosine kinase", "averylongname", None]
    assert column(spark, ["o'neil-smith 2nd", "ÉCOLE x", "", None], tx.title_case) == ["O'Neil-Smith 2Nd", "École X", "", None]
    assert column(spark, ["University of X", "John Smith", "ACME INC", None], tx.academic) == [True, True, False, False]
    assert column(spark, ["Phase I and Phase II (Integrated)", "Phase III", "Phase II", None], tx.phase_one) == [True, False, False, False]
    assert column(spark, ["WO-2024-1-A1", None], tx.patent_url) == ["https://patents.google.com/patent/WO20241A1", "https://patents.google.com/patent/"]
    assert column(spark, ["2024-5", "NCT1"], tx.trial_url) == ["https://euclinicaltrials.eu/ctis-public/#/study/2024-5", "https://clinicaltrials.gov/study/NCT1"]
    assert column(spark, ['see [{"a": 1}, {"a": 2}] ok'], lambda c: F.size(tx.rescued_json(c, "array<struct<a:int>>"))) == [2]
    assert column(spark, [["177Lu-x", "placebo"], ["mAb", None], [], None], lambda c: tx.all_of(c, fixed.NOT_SMALL), "array<string>") == [False, False, True, True]
    pair = spark.createDataFrame([(True, ["u"]), (True, []), (True, None), (None, ["u"])], "f boolean, s array<string>")
    assert [r[0] for r in pair.select(tx.supported(F.col("f"), F.col("s"))).collect()] == [True, False, False, False]


def test_nomenclature_and_leads(spark):
    cases = {
        "N-(3-fluorophenyl)prop-2-enamide": ["N-(3-fluorophenyl)prop-2-enamide"],
        "polyacrylamide gel": [],  # inside a word
        "the acrylamide": [],  # after a word
        "4-(x) acrylamide": ["4-(x) acrylamide"],  # a bracket and one space
        "4-(x)  acrylamide": [],  # two spaces
        "3-vinyl sulfone resin": [],  # a word against it, close behind
        "3-vinyl sulfone, as told far away: resin": ["3-vinyl sulfone, as told fa"],  # twelve characters behind only
        "resin; a long way before it comes 3-epoxide": ["long way before it comes 3-epoxide"],
        "1-maleimide and 2-chloroacetamide": ["1-maleimide and 2-chlo", "1-maleimide and 2-chloroacetamide"],
        "[a]propiolamide": ["[a]propiolamide"],
        "": [],
    }
    assert column(spark, [*cases, None], tx.nomenclature) == [*cases.values(), []]
    xml = "<p>Example 12: /V-(4-chlorophenyl)prop-2-enamide 1H NMR (400 MHz)</p><p>[0001] acrylamide intro</p><p>C<sub>2</sub> a long acrylamide name H<3>x as a white solid</p><p>short</p><p>Example 12: /V-(4-chlorophenyl)prop-2-enamide LCMS</p>"
    assert column(spark, [xml, None], tx.lead_names) == [["N-(4-chlorophenyl)prop-2-enamide", "C<sub>2</sub> a long acrylamide name H3x"], []]
    rows = [("WO1", "BTK", "<p>btk N-(a)prop-2-enamide and N-(b)prop-2-enamide or 3-chloroacetamide</p>", None), ("EP2", "BTK", "<p>BTK only</p>", "claim: 2-chloroacetamide of it"), ("US3", "BTK", "<p>BTK N-(a)prop-2-enamide N-(a)prop-2-enamide N-(a)prop-2-enamide</p>", None), ("WO4", "EGFR", "<p>other N-(a)prop-2-enamide N-(a)prop-2-enamide N-(a)prop-2-enamide</p>", None), ("WO5", "BTK", "BTK", None)]
    df = spark.createDataFrame(rows, "pn string, target string, d string, c string")
    got = {x.pn: x for x in sc.screen(df, "pn", F.col("target"), "d", "c").collect()}
    assert set(got) == {"WO1", "EP2"} and got["WO1"].needs_images and got["WO1"].mentions == 3 and not got["EP2"].needs_images and len(got["EP2"].in_claims) == 1
    confirmed = sc.screen(df, "pn", F.col("target"), "d", "c", F.when(F.col("pn") == "WO5", F.array(F.lit("x")))).collect()
    assert {x.pn for x in confirmed} == {"WO1", "EP2", "WO5"}


def test_design_text(spark):
    df = spark.createDataFrame([([("occupancy", None, "day 1"), ("b", "c", None)], "x" * 5000), (None, None)], "o array<struct<measure:string,description:string,timeFrame:string>>, d string")
    a, b = [r[0] for r in df.select(tx.design_text(F.col("o"), F.col("d"))).collect()]
    assert a.startswith("occupancy  day 1 b c  xxx") and a.count("x") == 4000 and b.strip() == ""


def test_forms_and_attribution_gold(spark):
    genes = spark.createDataFrame([("1", "KRAS", "proto-oncogene", "KRAS2|RASK2"), ("2", "EGFR", "receptor", "ERBB|HER1"), ("3", "F2R", "receptor of thrombin", "THE|PAR1")], "id string, symbol string, name string, alias string")
    forms = at.surface_forms(genes, "id", ["symbol", "name"], ["alias"], stop=["THE"])
    assert {tuple(r) for r in forms.filter("entity = '3'").collect()} == {("3", "F2R"), ("3", "RECEPTOR OF THROMBIN"), ("3", "PAR1")}
    links = spark.createDataFrame([("p1", "3", 4, 9), ("p1", "1", 2, 5), ("p1", "2", 1, 50), ("p2", "1", 4, 1), ("p2", "2", 4, 1), ("p3", "9", 4, 1)], "pn string, id string, f int, c int")
    titles = spark.createDataFrame([("p1", "IRAK degraders"), ("p2", "KRAS G12C and HER1-like compounds"), ("p3", "x")], "pn string, title string")
    got = {r.pn: (r.entity, r.conf, r.others) for r in at.attribute(links, "pn", "id", "f", "c", {"title": 4, "claims": 2, "abstract": 3}, titles, F.col("title"), forms.withColumnRenamed("entity", "entity"), genes.select(F.col("id"), "symbol")).collect()}
    assert got == {"p1": ("KRAS", "claims", "EGFR"), "p2": ("KRAS", "title", "EGFR")}


def test_mentions_of_texts_and_drugs(spark):
    genes = spark.createDataFrame([("1", "ERBB2", "HER2"), ("2", "BTK", "")], "id string, symbol string, alias string")
    sym, alias = rs.index(genes, "id", "symbol", ["alias"])
    df = spark.createDataFrame([("n1", "HER2 and FOR the BTK", ["ibrutinib", "none"]), ("n2", None, None)], "n string, t string, d array<string>")
    targets = spark.createDataFrame([("ibrutinib", "2")], "name string, id string")
    assert sorted(tuple(r) for r in cl.mentions(df, F.col("t"), F.col("d"), sym, alias, targets, stop=fixed.STOP).select("n", "entity", "path").collect()) == [("n1", "1", "A"), ("n1", "2", "A"), ("n1", "2", "B")]


def test_substance_cascade(spark):
    genes = spark.createDataFrame([("10", "BTK", ""), ("11", "EGFR", "")], "id string, symbol string, alias string")
    sym, alias = rs.index(genes, "id", "symbol", ["alias"])
    parents = spark.createDataFrame([("Ibrutinib", "P1"), ("Dual", "P2"), ("dual hydrochloride", "P3"), ("Empty", "P4")], "name string, parent string")
    targets = spark.createDataFrame([("P1", "BTK", "SINGLE PROTEIN"), ("P1", "EGFR", "PROTEIN FAMILY")], "parent string, symbol string, kind string")
    fallback = spark.createDataFrame([("empty", "EGFR"), ("foo", "xyz")], "name string, symbol string")
    names = spark.createDataFrame([(x,) for x in ("IBRUTINIB besylate", "Dual", "Empty sodium", "foo", "unknown", None)], "drug string")
    got = {r.drug: (r.outcome, r.id) for r in rs.resolve_substance(names, "drug", parents, targets, fallback, sym, alias).collect()}
    assert got == {"IBRUTINIB besylate": ("RESOLVED", "10"), "Dual": ("AMBIGUOUS", None), "Empty sodium": ("RESOLVED", "11"), "foo": ("UNRESOLVED", None), "unknown": ("UNRESOLVED", None), None: ("UNRESOLVED", None)}


def test_votes_buckets_and_flags(spark):
    rows = [("T", 1, "S"), ("T", 1, "A"), ("T", 2, "C"), ("T", 2, "A"), ("U", 1, "C"), ("U", 1, "C"), ("V", 1, None)]
    got = {(r.t, r.p): (r.verdict, r.selectivity) for r in al.selectivity(spark.createDataFrame(rows, "t string, p int, r string"), "t", "p", "r").collect()}
    assert got == {("T", 1): ("unique-handle", "unique-handle"), ("T", 2): ("partial", "unique-handle"), ("U", 1): ("conserved-liability", "conserved-liability"), ("V", 1): ("unique-handle", "unique-handle")}
    df = spark.createDataFrame([("k", True, None, 1, "late", 2), ("k", None, True, 5, "early", 1), ("l", None, None, None, "x", 1)], "k string, a boolean, b boolean, m int, n string, o int")
    flags = {r.k: r for r in cr.flags_of(df, "k", ["a", "b"], ["m"], [F.col("o")]).collect()}
    assert (flags["k"].a, flags["k"].b, flags["k"].m, flags["k"].n) == (True, True, 5, "early") and flags["l"].a is None
    assert {r.n: r.bucket for r in cr.buckets(df, ("a", F.col("a")), ("b", F.col("b")), rest="none").collect()} == {"late": "a", "early": "b", "x": "none"}
    names = spark.createDataFrame([("x", ["mAb"], "t"), ("y", ["drug", "antibody"], "t"), ("z", ["drug"], "food effect study"), ("w", [], "t"), ("v", None, None)], "n string, d array<string>, t string")
    assert [r.n for r in mv.small_molecule(names, "d", F.col("t"), fixed.NOT_SMALL, fixed.PROBE).collect()] == ["y"]


def test_samples_and_early_exit(spark):
    df = spark.range(1000)
    a, b = ([r.id for r in bt.seeded_sample(df, "id", s, 50).collect()] for s in (1, 2))
    assert a == [r.id for r in bt.seeded_sample(df.repartition(7), "id", 1, 50).collect()] and a != b and len(set(a)) == 50
    got = [r.id for r in bt.until(df, F.col("id") % 3 == 0, 5, 100, F.col("id")).collect()]
    assert got == [0, 3, 6, 9, 12] and bt.until(df, F.col("id") % 3 == 0, 100, 10, F.col("id")).count() == 4
    assert [r.id for r in bt.strided(df, 7, F.col("id")).orderBy("id").collect()] == list(range(0, 1000, 142)) and bt.strided(df.limit(3), 7, F.col("id")).count() == 3


def test_top_up_links_and_cascade(spark):
    feed = spark.createDataFrame([("WO1", 1)], "pn string, n int")
    hits = spark.createDataFrame([("WO-1-A1", 9), ("WO2", 5), ("WO-2-A2", 6)], "pn string, n int")
    key = tx.publication_key(F.col("pn"))
    a, b = mv.top_up(feed, feed.limit(0), hits, "pn", key)
    assert sorted(r.pn for r in a.collect()) == ["WO-2-A2", "WO1"] and sorted(r.pn for r in b.collect()) == ["WO-1-A1", "WO-2-A2"]
    assert sorted(r.pn for r in mv.top_up(feed, feed, hits, "pn", key, full=True)[0].collect()) == ["WO-1-A1", "WO-2-A2"]
    assert [r.pn for r in mv.upsert(feed, hits.filter("n = 5"), "pn").orderBy("pn").collect()] == ["WO1", "WO2"]
    assert [r.u for r in mv.live(spark.createDataFrame([("a", True), ("b", None)], "u string, ok boolean"), "u", F.col("ok")).collect()] == ["a", ""]
    df = spark.createDataFrame([("LIKELY", False, 0), ("POSSIBLE", True, 0), ("POSSIBLE", False, 4), ("NONE", False, 3)], "l string, c boolean, f int")
    assert [r[0] for r in df.select(mv.cascade(F.col("l"), F.col("c"), F.col("f"))).collect()] == ["LIKELY", "LIKELY", "FINGERPRINT", "NONE"]


def test_first_or_and_nested_fields(spark):
    assert column(spark, [["a", "b"], [], None], tx.first_or, "array<string>") == ["a", "", ""]
    texts = ['{"a": {"b": 3}}', '{"a": {}}', '{"a": {"b": "x"}}', "no json", None]
    assert column(spark, texts, lambda c: tx.json_field(c, "$.a.b", "int", 0)) == [3, 0, 0, 0, 0]
    long = "the " * 100
    assert column(spark, [f"[1] the long enough one. the second long part. short. {long}. the third long part. the fourth long part", None], lambda c: tx.leads(c, "[.] ", "the")) == [["the second long part", "the third long part", "the fourth long part"], None]


def test_wide_evidence_and_order(spark):
    base = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    n = spark.createDataFrame([("a", 3)], "k string, n int")
    v = spark.createDataFrame([("b", "x")], "k string, v string")
    assert sorted((tuple(r) for r in mv.widened(base, "k", (n, {"n": 0}), (v, {"v": None})).collect()), key=str) == sorted([("a", 3, None), ("b", 0, "x"), (None, 0, None)], key=str)
    rows = [("p", False, "patent", "2024-02-01"), ("q", True, "patent", "2020-01-01"), ("r", True, "clinical", "2019-01-01"), ("s", False, "patent", None), ("t", False, "clinical", "2024-01-01")]
    df = spark.createDataFrame(rows, "k string, x boolean, e string, d string")
    assert [r.k for r in mv.in_report_order(df, "x", "e", "d", "k").collect()] == ["r", "q", "t", "p", "s"]
    assert [r.overflow for r in mv.digest(df, 3, F.col("k")).collect()] == [2, 2, 2]
    facts = spark.createDataFrame([("p", "TAKEN")], "k string, verdict string")
    verdicts = spark.createDataFrame([("p", "OPEN"), ("q", "TRAP")], "k string, verdict string")
    got = {r.k: (r.verdict, r.note) for r in mv.judged(df.select("k"), "k", facts, verdicts, spark.createDataFrame([("q", "n")], "k string, note string")).collect()}
    assert got == {"p": ("TAKEN", None), "q": ("TRAP", "n"), "r": (None, None), "s": (None, None), "t": (None, None)}


def test_claim_key_of_a_saved_claim(spark):
    df = spark.createDataFrame([("HGNC:4552", "trial", "ctgov", "NCT04094896", "A")], "s string, e string, c string, r string, p string")
    out = cl.build(df, subject=F.col("s"), evidence_type=F.col("e"), source=F.col("c"), record=F.col("r"), actor=F.lit(None), valid_time=F.lit("2019-09-19"), observed_at=F.lit("2026-06-17"), path=F.col("p"))
    assert out.first().claim_key == "02be4f0977f29d33"


def test_links_of_trials_to_owners(spark):
    events = spark.createDataFrame([(1, "A", ["x", "y"]), (2, "B", ["x", "z"]), (3, "", ["x"]), (4, "C", ["q", "r"]), (5, "C", []), (6, None, None)], "id int, owner string, targets array<string>")
    index = spark.createDataFrame([("y", "A"), ("x", ""), ("z", "A")], "t string, o string")
    got = {r.id: (r.link, r.link_target) for r in mv.crosslink(events, "id", "targets", "owner", index, "t", "o").collect()}
    assert got == {1: ("LIKELY", "y"), 2: ("POSSIBLE", "x"), 3: ("POSSIBLE", "x"), 4: ("NONE", "q"), 5: ("NONE", None), 6: ("NONE", None)}


def test_targets_in_a_trial(spark):
    genes = spark.createDataFrame([("1", "BTK", ""), ("2", "EGFR", "HER1"), ("3", "ERBB2", "HER2"), ("4", "AAA1", "DUP"), ("5", "BBB1", "DUP"), ("6", "AML", "")], "id string, symbol string, alias string")
    sym, alias = rs.index(genes, "id", "symbol", ["alias"])
    df = spark.createDataFrame([(1, "BTK and HER1 in NSCLC and AML, HER2-negative, DUP; Phase 1 HER2 low"), (2, "nothing"), (3, None)], "n int, t string")
    got = {r.n: r.targets for r in rs.named_targets(df, "n", F.col("t"), sym, alias, genes, ["NSCLC", "AML"]).collect()}
    assert got == {1: ["BTK", "EGFR"], 2: [], 3: []}


def test_claims_in_xml(spark):
    from evidentia.functions import xml

    st36 = '<c xmlns="urn:x"><claim><claim-text>1. A  compound\n of X.</claim-text></claim><claim><claim-text>2. It of <claim-ref>claim 1</claim-ref>.</claim-text></claim><claim><claim-text>3. A method.</claim-text></claim><claim>4. As in claims 1-2.</claim></c>'
    ops = "<r><claims><claim><claim-text>1. A compound,</claim-text><claim-text>with Y.</claim-text><claim-text>2. The compound of claim 1.</claim-text><claim-text>3. A use.</claim-text></claim></claims></r>"
    got = column(spark, [st36, ops, "<r/>", "no xml", None], xml.independent_claims)
    assert got == [["1. A compound of X.", "3. A method."], ["1. A compound, with Y.", "3. A use."], [], [], []]
