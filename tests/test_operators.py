"""Gold cases and nulls for the text functions and operators."""

import datetime as dt

from pyspark.sql import functions as F

from evidentia.functions import text as tx
from evidentia.operators import alignment as al
from evidentia.operators import attribution as at
from evidentia.operators import claims as cl
from evidentia.operators import moves as mv
from evidentia.operators import resolve as rs
from evidentia.sources import files


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_text_functions(spark):
    firms = column(spark, ["Some Tiny Biotech LLC", "; Acme (US) Co., Ltd.; Other", "Wilmington Trust", None, "Genentech Inc"], lambda c: tx.organisation(c, [("GENENTECH", "ROCHE")]))
    assert firms == ["SOME TINY BIOTECH", "ACME", "", "", "ROCHE"]
    assert column(spark, ["Imatinib Mesylate", "sodium", None], tx.base_substance) == ["imatinib", "sodium", None]
    assert column(spark, ["WO-2020123456-A1", "EP1"], tx.publication_key) == ["WO2020123456", "EP1"]
    assert column(spark, ["GR: 29/06/2026", "n/a", None], tx.slashed_date) == [dt.date(2026, 6, 29), None, None]
    assert column(spark, ["20240229", "x", None], tx.compact_date) == [dt.date(2024, 2, 29), None, None]
    assert column(spark, ["a|| b|", None], tx.split_packed) == [["a", "b"], []]
    assert column(spark, ["EGFR and BTK in NSCLC; EGFR"], lambda c: tx.symbols(c, ["NSCLC"])) == [["EGFR", "BTK"]]
    assert column(spark, ["HER2-negative with EGFR"], tx.unsuppressed) == [["EGFR"]]
    assert column(spark, ["1. A thing.\n2. The thing of claim 1.\n3. Another."], tx.independent_claims) == [["A thing.", "Another."]]
    assert column(spark, ["1,234.5", "n/a", None], tx.number) == [1234.5, None, None]
    guard = lambda c: tx.guarded(c, "irreversible|covalently binds", "covalent", "non-covalent|unlike")
    assert column(spark, ["irreversible EGFR-TKI", "covalently binds Cys797", "non-covalent, unlike covalent", None], guard) == [True, True, False, False]
    assert column(spark, ['x ```{"a": 1}``` y'], lambda c: tx.rescued_json(c, "a int")["a"]) == [1]
    assert [round(p, 5) for p in column(spark, [0.0, 1.96, -1.0], tx.normal_tail, "double")] == [0.5, 0.025, 0.84134]
    assert column(spark, ["xECx"], lambda c: tx.positions_of(c, "C", [("hinge", 1, 4)])) == [["hinge@3"]]


def test_resolver(spark):
    e = spark.createDataFrame([("1", "ERBB2", "HER2|NEU", ""), ("2", "CCR10", "GPR2", ""), ("3", "ASPM", "ASP", ""), ("4", "ASPA", "ASP", ""), ("5", "X", "CCR10", None)], "id string, symbol string, alias string, prev string")
    sym, alias = rs.index(e, "id", "symbol", ["alias", "prev"])
    m = spark.createDataFrame([(x,) for x in ("ERBB2", "her2", "CCR10", "ASP", "xyzzy", None)], "m string")
    got = {r.m: (r.outcome, r.id, r.candidates) for r in rs.resolve(m, "m", sym, alias).collect()}
    assert got == {"ERBB2": ("RESOLVED", "1", []), "her2": ("RESOLVED", "1", []), "CCR10": ("RESOLVED", "2", []), "ASP": ("AMBIGUOUS", None, ["3", "4"]), "xyzzy": ("UNRESOLVED", None, []), None: ("UNRESOLVED", None, [])}


def test_grade_and_moves(spark):
    rows = [("title", "inhibitors of X"), ("claims", "inhibitors of X"), ("title", "glue degrader"), ("title", "SARS-CoV-2 protease"), ("title", "combination therapy"), ("title", None)]
    df = spark.createDataFrame(rows, "conf string, title string")
    g = at.grade(F.col("conf"), F.col("title"), radar=F.lit(False), exclude="sars", degrader="degrader", implausible="never", method="combination")
    assert [r[0] for r in df.select(g).collect()] == ["trusted", "candidate", "degrader", "excluded", "candidate", "trusted"]
    m = spark.createDataFrame([("ACME", "EGFR", "patent", "2025-01-01", "p"), ("ACME", "EGFR", "clinical", "2024-06-01", "t"), ("BETA", "BTK", "patent", None, "q"), ("", "BTK", "patent", "2024-01-01", "z")], "c string, t string, k string, d string, i string")
    got = {r.c: r for r in mv.unify(m, "c", "t", "k", "d", "i").collect()}
    assert got["ACME"].cross_linked and got["ACME"].earliest == "2024-06-01" and got["ACME"].earliest_kind == "clinical" and not got["BETA"].cross_linked and set(got) == {"ACME", "BETA"}
    flags = spark.createDataFrame([(False, False, None), (True, False, None), (True, True, True)], "a boolean, b boolean, c boolean")
    assert [r[0] for r in flags.select(mv.novelty(*map(F.col, "abc"))).collect()] == ["NOVEL", "EMERGING", "KNOWN"]


def test_append_is_idempotent(spark, tmp_path):
    c = spark.createDataFrame([("s", "k1"), ("s", "k2"), ("s", "k2")], "subject string, claim_key string")
    for _ in range(2):
        files.append_new(c, str(tmp_path / "log"), c.schema)
    assert files.json_lines(spark, str(tmp_path / "log"), c.schema).count() == 2
    assert files.json_document(spark, str(tmp_path / "none"), c.schema).count() == 0
    assert cl.new_only(c.limit(0), c).count() == 0


def test_alignment(spark):
    df = spark.createDataFrame([("MKCLA", 3, "MKCLA"), ("MKCLA", 3, "MKSLA"), ("MKCCLA", 4, "MKLA"), (None, 1, "M")], "a string, p int, b string")
    got = [r[0] for r in df.select(al.aligned_residue("a", "p", "b")).collect()]
    assert got[:2] == ["C", "S"] and got[2] == "-" and got[3] == "-"


def test_stream_append(spark, tmp_path):
    from evidentia.streaming import state as st

    src = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    src.write.parquet(str(tmp_path / "in"))
    for i in range(2):
        st.append_new(st.source(spark, str(tmp_path / "in"), src.schema), str(tmp_path / "out"), str(tmp_path / f"cp{i}"), "k").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_permutation_p_of_the_data(spark):
    from evidentia.operators import backtest as bt

    p = lambda rows: bt.permutation_p(spark.createDataFrame(rows, "k int, s double, o boolean"), "s", "o", "k", 2000, 7).first().p
    assert p([(i, float(i), i >= 20) for i in range(40)]) == 1 / 2001
    assert p([(i, float(-i), i >= 20) for i in range(40)]) > 0.99
    assert p([(i, float(i * 7 % 40), False) for i in range(40)]) == 1 and p([]) == 1
    # of all 24 orders of four outcomes (ties by key), those with a Spearman value of that of the data or more
    import itertools
    s, o = [3, 1, 4, 2], [0, 1, 1, 0]
    ranks = lambda v: [sorted(range(4), key=lambda i: (v[i], i)).index(j) for j in range(4)]
    rho = lambda y: sum(a * b for a, b in zip(ranks(s), ranks(y), strict=True))
    share = sum(rho(q) >= rho(o) for q in itertools.permutations(o)) / 24
    assert abs(p([(i, float(s[i]), bool(o[i])) for i in range(4)]) - share) < 0.04
