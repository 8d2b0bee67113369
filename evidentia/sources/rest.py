"""REST sources as a Python data source: rows of pages; the transport is pluggable, so tests run against a local server or a function.

``spark.dataSource.register(RestSource)``, then ``spark.read.format("evidence_rest").option("fetch", "module:function")``. The function takes (options, token) and
returns (rows, next token or None); ``queries``, a JSON array, gives a partition to each query. Pages are read to the end: a source that wants a bound
says so (``max_pages``) and says what happens there (``beyond``: "fail", the default, or "stop"). Fetch functions for common protocols are below.

Rows have the columns of the reader's schema (by name, from the row's JSON; ``id`` and ``body``, the whole row, if no schema is given). ``pushdown``, a JSON object
{column: {operator: parameter}}, says which conditions the server can test: they go out as request parameters, the others are left to Spark (this needs
``spark.sql.python.filterPushdown.enabled``).

As a stream (``spark.readStream``), a query is read up to where the server says it is: ``latest`` is a URL whose answer has the highest ``cursor`` of a query, rows carry their own at ``cursor_of``, and a
batch asks for those after ``cursor_param`` up to ``until_param``. Offsets hold a cursor for each query, so a batch can be read again, and a restart goes on after the last one.

Waits grow linearly; a failure for good fails the task, and Spark's own retries come on top.
"""

from __future__ import annotations

import datetime
import functools
import importlib
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType


class RestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "evidence_rest"

    def schema(self) -> str:
        return "id string, body string"

    def reader(self, schema) -> DataSourceReader:
        return RestReader(dict(self.options), schema)

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return RestStream(dict(self.options), schema)


#: Operators of the conditions that Spark offers.
OPERATORS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
_PLAIN = {"string": str, "long": int, "integer": int, "double": float, "boolean": bool}


def _sent(value: object) -> str:
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


class _Pages:
    """Rows of the pages of a query, in the columns of a schema."""

    def __init__(self, options: dict[str, str], schema: StructType | None = None):
        self.options, self.pushed = options, {}
        self.columns = [(f.name, f.dataType.typeName()) for f in schema.fields] if schema is not None else [("id", "string"), ("body", "string")]

    def row(self, row: dict) -> tuple:
        out = []
        for name, kind in self.columns:
            v = str(row.get(self.options.get("id", "id"))) if name == "id" else json.dumps(row) if name == "body" and "body" not in row else row.get(name)
            if v is not None and kind in ("date", "timestamp"):
                v = datetime.date.fromisoformat(str(v)[:10]) if kind == "date" else datetime.datetime.fromisoformat(str(v))
            out.append(v if v is None or kind not in _PLAIN else json.dumps(v) if kind == "string" and isinstance(v, dict | list) else _PLAIN[kind](v))
        return tuple(out)

    def rows(self, query: object, **more: object):
        given = {**json.loads(self.options.get("params", "{}")), **self.pushed, **more}
        options = {**self.options, "params": json.dumps(given), "query": query}
        module, _, name = self.options.get("fetch", f"{__name__}:by_token").partition(":")
        fetch = getattr(importlib.import_module(module), name)
        most = int(self.options["max_pages"]) if "max_pages" in self.options else None
        token, pages = None, 0
        while True:
            if most is not None and pages >= most:
                if self.options.get("beyond", "fail") == "stop":
                    return
                raise RuntimeError(f"more than {most} pages; raise max_pages, or set beyond=stop to leave the rest")
            rows, token = self._retry(fetch, options, token)
            yield from rows
            pages += 1
            if token is None or not rows:
                return

    def _retry(self, fetch, options, token):
        tries = int(self.options.get("tries", "4"))
        for i in range(tries):
            try:
                return fetch(options, token)
            except urllib.error.HTTPError as e:
                if i == tries - 1 or e.code != 429 and e.code < 500:
                    raise
            except OSError:
                if i == tries - 1:
                    raise
            time.sleep(float(self.options.get("wait", "1")) * (i + 1))
        raise AssertionError


class RestReader(_Pages, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Conditions that the server tests become parameters; the others are given back."""
        known = json.loads(self.options.get("pushdown", "{}"))
        for f in filters:
            name = known.get(".".join(f.attribute), {}).get(OPERATORS.get(type(f))) if hasattr(f, "attribute") else None
            if name and name not in self.pushed:
                self.pushed[name] = _sent(f.value)
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """One partition for each of the ``queries``; each is paged on its own."""
        return [InputPartition(q) for q in json.loads(self.options.get("queries", "[null]"))]

    def read(self, partition: InputPartition):
        for row in self.rows(partition.value):
            yield self.row(row)


class RestStream(_Pages, DataSourceStreamReader):
    """Rows of each query by their cursor. An offset is {query: cursor}; the query is its JSON text."""

    def _queries(self) -> list[str]:
        return [json.dumps(q, sort_keys=True) for q in json.loads(self.options.get("queries", "[null]"))]

    def initialOffset(self) -> dict:  # noqa: N802
        return {q: int(self.options.get("from", "0")) for q in self._queries()}

    def latestOffset(self) -> dict:  # noqa: N802
        found = {}
        for q in self._queries():
            options = {**self.options, "url": self.options["latest"], "query": json.loads(q)}
            answer = self._retry(lambda o, _: call(o, _url(o)), options, None)
            found[q] = int(_at(answer, self.options.get("cursor", "cursor")) or 0)
        return found

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition((q, int(start.get(q, 0)), int(to))) for q, to in end.items() if int(to) > int(start.get(q, 0))]

    def read(self, partition: InputPartition):
        query, start, end = partition.value
        name = self.options.get("cursor_of", "cursor")
        for row in self.rows(json.loads(query), **{self.options.get("cursor_param", "after"): start, self.options.get("until_param", "until"): end}):
            if start < int(row[name]) <= end:  # a server that ignores a bound gives more
                yield self.row(row)


_tokens: dict[str, str] = {}


def _authorised(options: dict[str, str], anew: bool = False) -> dict[str, str]:
    """A bearer token by client credentials from ``auth_url``, kept by this worker until it is refused."""
    url = options.get("auth_url")
    if not url:
        return {}
    if anew or url not in _tokens:
        body = urllib.parse.urlencode({"grant_type": "client_credentials", "client_id": options.get("client_id", ""), "client_secret": options.get("client_secret", "")}).encode()
        with urllib.request.urlopen(urllib.request.Request(url, data=body), timeout=60) as r:
            _tokens[url] = json.load(r)["access_token"]
    return {"Authorization": f"Bearer {_tokens[url]}"}


def call(options: dict[str, str], url: str, body: object = None) -> dict:
    """One JSON answer. 404 is an empty one; after 401 or 403 there is one more try with a new token. GETs may be kept (``memo``)."""
    if body is None and options.get("memo") == "true":
        return _memo(url, tuple(sorted((k, v) for k, v in options.items() if isinstance(v, str) and k in ("auth_url", "client_id", "client_secret"))))
    return _send(options, url, body)


@functools.lru_cache(maxsize=10_000)
def _memo(url: str, options: tuple) -> dict:
    return _send(dict(options), url, None)


def _send(options: dict[str, str], url: str, body: object) -> dict:
    for anew in (False, True):
        data = None if body is None else json.dumps(body).encode()
        head = {"Accept": "application/json", **({"Content-Type": "application/json"} if data else {}), **_authorised(options, anew)}
        try:
            with urllib.request.urlopen(urllib.request.Request(url, data=data, headers=head), timeout=60) as r:
                return json.load(r)
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return {}
            if anew or e.code not in (401, 403) or "auth_url" not in options:
                raise
    raise AssertionError


def _at(answer: object, path: str) -> object:
    """A value by a dotted path; null where there is none."""
    for name in path.split(".") if path else []:
        answer = answer.get(name) if isinstance(answer, dict) else None
    return answer


def _url(options: dict[str, str], **more: object) -> str:
    given = {**json.loads(options.get("params", "{}")), **(options["query"] if isinstance(options.get("query"), dict) else {}), **{k: v for k, v in more.items() if v is not None}}
    if isinstance(options.get("query"), str):
        given[options.get("query_param", "query")] = options["query"]
    return options["url"] + ("?" + urllib.parse.urlencode(given) if given else "")


def by_token(options: dict[str, str], token):
    """GET; rows at ``rows``, the next page's token at ``next`` (sent as ``token_param``). Without a token, one page."""
    got = call(options, _url(options, **{options.get("token_param", "pageToken"): token}))
    return _at(got, options.get("rows", "rows")) or [], _at(got, options.get("next", "nextPageToken")) or None


def by_page(options: dict[str, str], token):
    """POST of ``body`` with pagination by number from 1; an empty page ends it."""
    page = token or 1
    body = {**json.loads(options.get("body", "{}")), **(options["query"] if isinstance(options.get("query"), dict) else {}), "pagination": {"page": page, "size": int(options.get("size", "50"))}}
    rows = _at(call(options, options["url"], body), options.get("rows", "data")) or []
    return rows, page + 1 if rows else None


def by_search(options: dict[str, str], token):
    """POST search: rows sorted by ``sort``, newest first, the first ``limit`` of them."""
    rows = _at(call(options, options["url"], {**json.loads(options.get("body", "{}")), "query": options.get("query")}), options.get("rows", "data")) or []
    key = options.get("sort")
    rows = sorted(rows, key=lambda r: str(_at(r, key) or ""), reverse=True) if key else rows
    return rows[: int(options["limit"])] if "limit" in options else rows, None


def by_graphql(options: dict[str, str], token):
    """POST of a GraphQL ``document`` with the query as its variables; errors in the answer are failures."""
    got = call(options, options["url"], {"query": options["document"], "variables": options.get("query") or {}})
    if got.get("errors"):
        raise RuntimeError(str(got["errors"])[:500])
    rows = _at(got, "data." + options["rows"] if options.get("rows") else "data")
    return rows if isinstance(rows, list) else [rows] if rows else [], None


def by_count(options: dict[str, str], token):
    """One row for a query: its number of records, which the server counts."""
    got = call(options, _url(options))
    return [{"id": json.dumps(options.get("query")) if not isinstance(options.get("query"), str) else options["query"], "n": _at(got, options.get("count", "totalCount")) or 0}], None


def counts(facts: DataFrame, *keys: str) -> DataFrame:
    """The same question over stored facts."""
    return facts.groupBy(*keys).agg(F.count("*").alias("n"))
