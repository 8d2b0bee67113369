"""Remote sources that test conditions, grow, or are asked once; tables that are committed together."""

import http.server
import json
import threading
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from evidentia.sources import commits, responses, rest
from evidentia.streaming import state as st


class Registry(http.server.BaseHTTPRequestHandler):
    """Rows with a date and a cursor, in pages of seven; ``rows`` may grow."""

    rows: list = []
    seen: list = []

    def log_message(self, *args):
        pass

    def do_GET(self):
        url = urlparse(self.path)
        q = {k: v[0] for k, v in parse_qs(url.query).items()}
        Registry.seen.append((url.path, q))
        rows = [r for r in Registry.rows if r["kind"] == q.get("query", r["kind"])]
        if url.path == "/latest":
            body = {"meta": {"top": max((r["cursor"] for r in rows), default=0)}}
        else:
            rows = [r for r in rows if q.get("since", "") <= r["day"] and r["kind"] == q.get("kind", r["kind"]) and int(q.get("after", "-1")) < r["cursor"] <= int(q.get("until", "1000000"))]
            at = int(q.get("pageToken", "0"))
            body = {"rows": rows[at : at + 7], **({"nextPageToken": str(at + 7)} if len(rows) > at + 7 else {})}
        data = json.dumps(body).encode()
        self.send_response(200)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)


@pytest.fixture(scope="module")
def registry():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Registry)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def rows(lo, hi):
    return [{"id": f"r{i}", "cursor": i, "kind": "ab"[i % 2], "day": f"2024-01-{i % 28 + 1:02d}", "n": i, "more": {"x": i}} for i in range(lo, hi)]


SCHEMA = "id string, kind string, day date, n long, more string"


def test_conditions_become_parameters(spark, registry):
    Registry.rows[:] = rows(1, 61)
    spark.dataSource.register(rest.RestSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    down = json.dumps({"day": {">=": "since"}, "kind": {"=": "kind"}})
    plain = spark.read.format("evidence_rest").schema(SCHEMA).option("url", f"{registry}/rows")
    wanted = (F.col("day") >= F.lit("2024-01-15").cast("date")) & (F.col("kind") == "a") & (F.col("n") % 3 == 0) & (F.col("n") > 4)
    without = sorted(map(tuple, plain.load().filter(wanted).collect()))
    Registry.seen.clear()
    with_ = sorted(map(tuple, plain.option("pushdown", down).load().filter(wanted).collect()))
    asked = [q for path, q in Registry.seen if path == "/rows"]
    assert with_ == without and len(with_) > 3 and all(q["since"] == "2024-01-15" and q["kind"] == "a" for q in asked)
    assert json.loads(with_[0][4]) == {"x": with_[0][3]}


def test_a_stream_of_a_growing_registry(spark, registry, tmp_path):
    spark.dataSource.register(rest.RestSource)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = spark.readStream.format("evidence_rest").schema("id string, n long").options(url=f"{registry}/rows", latest=f"{registry}/latest", cursor="meta.top", queries='["a", "b"]').load()
        st.appended(stream, out, checkpoint)
        return sorted(r.n for r in spark.read.schema("id string, n long").parquet(out).collect())

    for hi in (11, 11, 40, 75):
        Registry.rows[:] = rows(1, hi)
        assert run() == list(range(1, hi))
    reader = rest.RestStream({"url": f"{registry}/rows", "queries": '["a"]'})
    part = reader.partitions({'"a"': 10}, {'"a"': 20})
    assert len(part) == 1 and list(reader.read(part[0])) == list(reader.read(part[0])) and len(list(reader.read(part[0]))) == 5
    assert reader.partitions({'"a"': 20}, {'"a"': 20}) == []


def test_each_request_goes_out_once(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()

    def fetch(method, url, body):
        import uuid

        (log / uuid.uuid4().hex).write_text(url)
        if url == "bad":
            raise OSError("down")
        return json.dumps({"url": url, "body": body})

    at = str(tmp_path / "answers")
    asked = spark.createDataFrame([("get", f"u{i % 5}", None, i) for i in range(40)] + [("POST", "u1", "b", 40), ("GET", "bad", None, 41)], "method string, url string, body string, i int")
    first = {r.i: r.answer for r in responses.answered(asked, at, fetch).collect()}
    assert len(first) == 42 and first[41] is None and json.loads(first[40])["body"] == "b" and len(list(log.iterdir())) == 7
    assert {r.i: r.answer for r in responses.answered(asked, at, fetch).collect()} == first
    assert sorted(p.read_text() for p in log.iterdir()).count("bad") == 2 and len(list(log.iterdir())) == 8  # only what failed is asked again
    responses.evict(spark, at, str(tmp_path / "kept"), F.col("url") != "u3")
    assert responses.stored(spark, str(tmp_path / "kept")).count() == 5
    again = {r.i: r.answer for r in responses.answered(asked.filter("url = 'u3'"), str(tmp_path / "kept"), fetch).collect()}
    assert len(list(log.iterdir())) == 9 and all(again[i] == first[i] for i in again)


def test_tables_change_together(spark, tmp_path):
    at = str(tmp_path / "joint")
    df = lambda *n: spark.createDataFrame([(i,) for i in n], "i int")
    ids = lambda v=None: {n: sorted(r.i for r in t.collect()) for n, t in commits.read(spark, at, v)[1].items()}
    assert commits.read(spark, at) == (0, {})
    assert commits.commit(spark, at, {"feed": df(1, 2), "census": df(1)}, 0) == 1

    class Broken:  # fails after the first table was written
        def __getattr__(self, name):
            raise OSError("disk")

    with pytest.raises(OSError):
        commits.commit(spark, at, {"feed": df(1, 2, 3), "census": Broken()}, 1)
    assert ids() == {"feed": [1, 2], "census": [1]} and commits.versions(spark, at) == [1]
    assert commits.commit(spark, at, {"feed": df(9)}, 1) == 2
    with pytest.raises(commits.Conflict):  # the second of two writers
        commits.commit(spark, at, {"feed": df(8)}, 1)
    assert ids() == {"feed": [9], "census": [1]} and ids(1) == {"feed": [1, 2], "census": [1]}
    tries = []

    def change(tables):
        tries.append(1)
        if len(tries) == 1:  # someone comes in between
            commits.commit(spark, at, {"census": df(5)}, 2)
        return {"feed": tables["feed"].unionByName(tables["census"])}

    assert commits.update(spark, at, change) == 4 and len(tries) == 2 and ids() == {"feed": [5, 9], "census": [5]}
