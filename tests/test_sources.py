"""Readers, writers and REST protocols, against files and a local server."""

import http.server
import io
import json
import threading
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.operators import report as rp
from evidentia.sources import files, rest
from evidentia.streaming import state as st

KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


class Server(http.server.BaseHTTPRequestHandler):
    seen: list = []

    def answer(self, code, body):
        data = json.dumps(body).encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *args):
        pass

    def do_GET(self):
        from urllib.parse import parse_qs, urlparse

        Server.seen.append(self.path)
        url, q = urlparse(self.path), parse_qs(urlparse(self.path).query)
        if url.path == "/tokens":
            page = int(q.get("pageToken", ["0"])[0])
            self.answer(200, {"studies": [{"id": f"{q['query'][0]}-{page}-{i}"} for i in range(3)], **({"next": str(page + 1)} if page < 29 else {})})
        elif url.path == "/flaky":
            n = sum(p == self.path for p in Server.seen)
            self.answer(503 if n < 3 else 200, {"rows": [{"id": 1}]})
        elif url.path == "/refused":
            self.answer(400, {})
        elif url.path == "/private":
            ok = self.headers.get("Authorization") == "Bearer t2"
            self.answer(200 if ok else 401, {"rows": [{"id": "secret"}]})
        elif url.path == "/count":
            self.answer(200, {"meta": {"total": len(q["query"][0])}})
        else:
            self.answer(404, {})

    def do_POST(self):
        raw = self.rfile.read(int(self.headers["Content-Length"])).decode()
        Server.seen.append((self.path, raw))
        if self.path == "/auth":
            self.answer(200, {"access_token": f"t{sum(p[0] == '/auth' for p in Server.seen)}"})
            return
        body = json.loads(raw)
        if self.path == "/pages":
            page = body["pagination"]["page"]
            self.answer(200, {"data": [{"id": f"{page}-{i}"} for i in range(body["pagination"]["size"])] if page <= 30 else []})
        elif self.path == "/search":
            self.answer(200, {"data": [{"id": d, "pd": d} for d in ("2020", "2024", "2022", "2021")]})
        elif self.path == "/graphql":
            bad = body["variables"].get("id") == "bad"
            self.answer(200, {"errors": [{"message": "no"}]} if bad else {"data": {"target": {"id": body["variables"]["id"], "level": "Tbio"}}})


@pytest.fixture(scope="module")
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def read(url, fetch, queries=("null",), **options):
    reader = rest.RestReader({"url": url, "fetch": f"evidentia.sources.rest:{fetch}", "queries": json.dumps(list(queries)), "wait": "0", **options})
    return [row for p in reader.partitions() for row in reader.read(p)]


def test_pages_are_read_to_the_end(spark, server):
    opts = {"rows": "studies", "next": "next"}
    got = read(f"{server}/tokens", "by_token", ["a", "b"], **opts)
    assert len(got) == len(set(got)) == 2 * 30 * 3
    assert len(read(f"{server}/pages", "by_page", [None], size="5")) == 150
    with pytest.raises(RuntimeError):
        read(f"{server}/tokens", "by_token", ["a"], max_pages="12", **opts)
    assert len(read(f"{server}/tokens", "by_token", ["a"], max_pages="12", beyond="stop", **opts)) == 36
    spark.dataSource.register(rest.RestSource)
    df = spark.read.format("evidence_rest").options(url=f"{server}/tokens", fetch="evidentia.sources.rest:by_token", queries='["x", "y"]', **opts).load()
    assert df.count() == 180 and df.columns == ["id", "body"] and df.rdd.getNumPartitions() == 2


def test_retries_missing_pages_and_refusals(server):
    assert len(read(f"{server}/flaky", "by_token", [None])) == 1 and Server.seen.count("/flaky") == 3
    assert read(f"{server}/none", "by_token", [None]) == []
    with pytest.raises(Exception, match="400"):
        read(f"{server}/refused", "by_token", [None])
    assert Server.seen.count("/refused") == 1


def test_new_token_after_a_refusal(server):
    rest._tokens.clear()
    got = read(f"{server}/private", "by_token", [None], auth_url=f"{server}/auth", client_id="i", client_secret="s")
    assert [i for i, _ in got] == ["secret"] and sum(isinstance(p, tuple) and p[0] == "/auth" for p in Server.seen) == 2


def test_search_graphql_counts_and_memo(server):
    assert [i for i, _ in read(f"{server}/search", "by_search", ["q"], sort="pd", limit="3")] == ["2024", "2022", "2021"]
    assert json.loads(read(f"{server}/graphql", "by_graphql", [{"id": "T1"}], document="query q", rows="target")[0][1]) == {"id": "T1", "level": "Tbio"}
    with pytest.raises(RuntimeError):
        read(f"{server}/graphql", "by_graphql", [{"id": "bad"}], document="query q", rows="target")
    for _ in range(2):
        assert [json.loads(b) for _, b in read(f"{server}/count", "by_count", ["abc", "de"], count="meta.total", memo="true")] == [{"id": "abc", "n": 3}, {"id": "de", "n": 2}]
    assert sum(p == "/count?query=abc" for p in Server.seen) == 1


def test_workbooks(spark, tmp_path):
    strings = "<sst xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'><si><t>sym</t></si><si><r><t>EG</t></r><r><t>FR</t></r></si></sst>"
    sheet = "<worksheet xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'><sheetData><row r='1'><c r='A1' t='s'><v>0</v></c></row><row r='2'><c r='A2' t='s'><v>1</v></c><c r='C2'><v>7.5</v></c><c r='AA2'><v>9</v></c></row><row r='3'><c r='B3' t='inlineStr'><is><t>x</t></is></c></row></sheetData></worksheet>"
    for name in ("a.xlsx", "b.xlsx"):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as z:
            z.writestr("xl/worksheets/sheet1.xml", sheet)
            z.writestr("xl/sharedStrings.xml", strings)
        (tmp_path / name).write_bytes(buffer.getvalue())
    got = files.xlsx(spark, str(tmp_path), ["sym", "note", "n"])
    assert sorted(tuple(r)[1:] for r in got.collect()) == [(2, "EGFR", None, "7.5")] * 2 + [(3, None, "x", None)] * 2


def test_text_readers(spark, tmp_path):
    (tmp_path / "t.tsv").write_text('sym\tname\nA"B\t"quoted\nC\t\n')
    assert [tuple(r) for r in files.delimited(spark, str(tmp_path / "t.tsv"), ["sym", "name"]).collect()] == [('A"B', '"quoted'), ("C", None)]
    (tmp_path / "t.csv").write_text('sym,name\n"A,B",x\n')
    assert [tuple(r) for r in files.delimited(spark, str(tmp_path / "t.csv"), ["sym", "name"], sep=",").collect()] == [("A,B", "x")]
    (tmp_path / "keys.txt").write_text("gene\nEGFR (HER1)\tx\n\nBTK\ty\n")
    assert [r.key for r in files.key_list(spark, str(tmp_path / "keys.txt"), header="gene").collect()] == ["EGFR", "BTK"]
    (tmp_path / "x.xml").write_text("<all><claim><id>1</id><text>a</text></claim><claim><id>2</id></claim></all>")
    rows = files.xml(spark, str(tmp_path / "x.xml"), "claim", T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])).collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, None)]
    (tmp_path / "doc.json").write_text('[{"k": "a",\n "v": 1},\n {"k": "b"}]')
    assert [tuple(r) for r in files.json_document(spark, str(tmp_path / "doc.json"), KV).collect()] == [("a", 1), ("b", None)]
    (tmp_path / "log.jsonl").write_text('{"k": "a", "v": 1}\n{"k": "b", "v": 2}\n')
    assert files.json_lines(spark, str(tmp_path / "log.jsonl"), KV).count() == 2 and files.json_lines(spark, str(tmp_path / "none"), KV).count() == 0
    assert files.images(spark, str(tmp_path / "keys.txt")).select("length").first()[0] == (tmp_path / "keys.txt").stat().st_size


def test_snapshots_states_and_pointers(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], KV)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        files.dated_snapshot(df, str(tmp_path / "snap"), day)
    back = spark.read.parquet(str(tmp_path / "snap"))
    assert back.count() == 4 and back.filter("run_date = '2024-01-02'").count() == 2
    for day in ("2024-01-01", "2024-03-01", "latest"):
        df.write.parquet(str(tmp_path / "bulk" / day / "t.parquet"))
    (tmp_path / "bulk" / "2024-05-01" / "t.parquet").mkdir(parents=True)
    (tmp_path / "bulk" / "2024-05-01" / "t.parquet" / "broken.parquet").write_bytes(b"no parquet")
    (tmp_path / "bulk" / "2024-06-01").mkdir()
    assert files.latest_snapshot(spark, str(tmp_path / "bulk"), "t.parquet") == "2024-03-01" and files.latest_snapshot(spark, str(tmp_path / "none"), "t") is None
    state = str(tmp_path / "state")
    assert files.newest_state(spark, state, KV).count() == 0
    files.replace_state(df, state, 9)
    files.replace_state(df.limit(1), state, 10)
    (tmp_path / "state" / "version=0000000011").mkdir()
    assert files.newest_state(spark, state, KV).count() == 1
    assert files.read_pointer(spark, str(tmp_path / "p")) is None
    for value in ("2024-01-01", "2024-03-01"):
        files.write_pointer(spark, str(tmp_path / "p"), value)
    assert files.read_pointer(spark, str(tmp_path / "p")) == "2024-03-01"
    for _ in range(2):
        files.overwrite_json(df, str(tmp_path / "artifact"))
    assert files.json_lines(spark, str(tmp_path / "artifact"), KV).count() == 2


def test_failures_to_read_a_log_are_not_an_empty_log(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part.parquet").write_bytes(b"broken")
    spark.createDataFrame([("a", 1)], KV).write.parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="parquet"):
        st.append_new(st.source(spark, str(tmp_path / "in"), KV), str(tmp_path / "log"), str(tmp_path / "cp"), "k").awaitTermination()


def test_cursor_and_eviction(spark):
    rows = spark.createDataFrame([(i, f"2024-01-{i:02d}") for i in range(1, 11)], "i int, d string").withColumn("d", F.to_date("d"))
    assert st.newer(rows, "d", rows.filter("i <= 6"), "d").count() == 4 and st.newer(rows, "d", rows.filter("i <= 6"), "d", 2).count() == 6 and st.newer(rows, "d", rows.limit(0), "d").count() == 10
    assert st.evicted(rows, F.when(F.col("i") > 8, True)).count() == 2


def test_late_rows_and_merged_moves(spark, tmp_path):
    import datetime as dt

    at = lambda h: dt.datetime(2024, 1, 1 + h // 24, h % 24)
    schema = "ts timestamp, k string, kind string"
    for i, rows in enumerate([[(at(1), "a", "patent"), (at(30), "b", "patent")], [(at(29), "b", "clinical"), (at(60), "d", "patent")], [(at(2), "c", "patent"), (at(61), "a", "clinical")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        (tmp_path / f"mark{i}").touch()
    src = st.timed(st.source(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema), "ts", "2 hours")
    got = {(r.start.day, r.start.hour): r.n for r in st.drained(st.tumbling(src, "ts", "1 hour"), "late_rows").collect()}
    assert (1, 2) not in got and got[1, 1] == 1  # the row of 2 o'clock came a batch after the watermark had passed it
    src = st.source(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
    merged = {r.k: r for r in st.drained(st.merged_moves(src.withColumn("t", F.lit("t")), "k", "t", "kind", "ts"), "merged", "complete").collect()}
    assert merged["a"].cross_linked and merged["b"].cross_linked and merged["b"].earliest == at(29) and not merged["c"].cross_linked


def test_reports(spark):
    rows = [("EGFR", "ACME INC", "2024-05-01", ["ACME INC", "BETA"], False, False), ("BTK", "beta", "2024-06-01", ["beta"], True, False), ("KRAS", "gamma", "2024-07-01", ["gamma"], False, True), ("IKZF2", "delta", None, ["delta"], True, False)]
    df = spark.createDataFrame(rows, "target string, company string, day string, filers array<string>, novel boolean, trap boolean")
    pinned = spark.createDataFrame([("MET", "x co", "2024-01-01"), ("RET", None, None)], "target string, company string, day string")
    lines = rp.digest(df, "target", "company", "day", "filers", novel=F.col("novel"), trap=F.col("trap"), pinned=pinned, softened=["IKZF2"], link=F.lit("u"))
    assert [(r.block, r.line.split("*")[1]) for r in lines.collect()] == [(0, "MET"), (0, "RET"), (1, "BTK"), (2, "EGFR"), (2, "IKZF2"), (3, "KRAS")]
    text = rp.markdown(lines, "line", "block", "rank", title="Digest")
    assert text.startswith("# Digest\n\n- *MET* - new move from X Co (2024-01-01).") and "Acme Inc, Beta (2024-05-01). <u|see>" in text and "Delta + others." in text and "skip it" in text and "nothing new" in text
    few = rp.digest(df, "target", "company", "day", "filers", novel=F.col("novel"), trap=F.col("trap"), limit=1).collect()
    assert len(few) == 1 and few[0].overflow == 3
    assert rp.softened_if_failed([{"target": "a"}, {"target": "b"}], lambda f: f["target"] == "b") == ["b"] and rp.softened_if_failed([{"target": "a"}], lambda f: 1 / 0) == ["a"]
