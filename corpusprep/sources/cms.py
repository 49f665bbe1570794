"""A paged content store as a data source: one partition per page, equality filters sent with the request.

    spark.dataSource.register(ContentStore)
    spark.read.format("content_store").options(endpoint=..., collection="subjects", locale="en").load()

The transport is a class path, so that tests (and stores with another protocol) bring their own; the default speaks HTTP. Rows are
(document_id, record), the record as JSON text: which keys are there matters to those who read it.
"""

from __future__ import annotations

import importlib
import json
import logging
import math
import urllib.parse
import urllib.request
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, InputPartition, WriterCommitMessage

PAGE_SIZE = 100


class HttpTransport:
    """GET of one page; the answer is {"data": [...], "meta": {"pagination": {"total": n}}}."""

    def __init__(self, options: dict[str, str]) -> None:
        self.endpoint, self.token, self.timeout = options["endpoint"].rstrip("/"), options.get("token"), float(options.get("timeout", 10))

    def _call(self, method: str, path: str, query: dict, body: dict | None = None) -> dict:
        url = f"{self.endpoint}/api/{path}?{urllib.parse.urlencode(query)}"
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.token}"} if self.token else {})
        request = urllib.request.Request(url, json.dumps({"data": body}).encode() if body is not None else None, headers, method=method)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:  # noqa: S310
            return json.load(answer)

    def page(self, collection: str, query: dict) -> dict:
        return self._call("GET", collection, query)

    def locales(self) -> list[dict]:
        return self._call("GET", "i18n/locales", {})

    def write(self, verb: str, collection: str, document_id: str | None, locale: str | None, payload: dict) -> dict:
        """The answer: {"data": record}, which tells the id of what was created."""
        publish = {"status": "published"} | ({"locale": locale} if locale else {})
        if verb == "create":
            return self._call("POST", collection, publish, payload)
        return self._call("PUT", f"{collection}/{document_id}", publish, {} if verb == "publish" else payload)


def _transport(options: dict[str, str]):
    module, _, name = options.get("transport", f"{__name__}:HttpTransport").partition(":")
    return getattr(importlib.import_module(module), name)(options)


def locales(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The locales that a store knows: code, name, is_default. A store has a few, so the driver asks once."""
    rows = [(r.get("code"), r.get("name"), bool(r.get("isDefault"))) for r in _transport(options).locales()]
    return spark.createDataFrame(rows, "code string, name string, is_default boolean")


def require_locales(known: DataFrame, wanted: list[str]) -> None:
    """Raise if the store lacks one of the locales that a plan is to write."""
    have = {r["code"] for r in known.collect()}
    if missing := [c for c in wanted if c not in have]:
        raise ValueError(f"the store has no locale {', '.join(missing)}")


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.filters = options, {}
        self.fields = [c.strip() for c in options.get("fields", "").split(",") if c.strip()]

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality of a string goes with the request: document_id = x and, where ``fields`` names columns, field = x. The rest
        stays with Spark."""
        names = {"document_id": "documentId"} | {c: c for c in self.fields}
        for f in filters:
            if isinstance(f, EqualTo) and len(f.attribute) == 1 and f.attribute[0] in names and f"filters[{names[f.attribute[0]]}][$eq]" not in self.filters:
                self.filters[f"filters[{names[f.attribute[0]]}][$eq]"] = f.value
            else:
                yield f

    def _query(self, page: int, size: int) -> dict:
        fixed = {k: self.options[k] for k in ("locale", "status", "populate") if k in self.options}
        return fixed | self.filters | {"pagination[page]": page, "pagination[pageSize]": size}

    def partitions(self) -> list[InputPartition]:
        total = _transport(self.options).page(self.options["collection"], self._query(1, 1))["meta"]["pagination"]["total"]
        return [InputPartition(i + 1) for i in range(math.ceil(total / PAGE_SIZE))]

    def read(self, partition: InputPartition | None) -> Iterator[tuple]:
        if partition is None:  # an empty store has no page
            return
        for i, record in enumerate(_transport(self.options).page(self.options["collection"], self._query(partition.value, PAGE_SIZE))["data"]):
            inner = record.get("attributes") or {}
            yield record.get("documentId") or inner.get("documentId"), (partition.value - 1) * PAGE_SIZE + i, json.dumps(record, ensure_ascii=False), *[_string(record[c] if c in record else inner.get(c)) for c in self.fields]


def _string(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _value(record: object, name: str) -> object:
    """A field of a record: the top level wherever it has the key, else ``attributes``."""
    if not isinstance(record, dict):
        return None
    return record[name] if name in record else (record.get("attributes") or {}).get(name)


@dataclass
class Sent(WriterCommitMessage):
    """Writes of a partition that did something, by verb."""

    verbs: dict[str, int]


class _Writer(DataSourceWriter):
    """Rows (code, step, verb, locale, document_id, payload as JSON), all steps of a code in one partition and in order, as ``send``
    deals them. A create hands the id that the store returned to the steps after it. Nothing is sent unless ``apply`` is "true".

    A task may run again after it has written: a create first looks its code up in its locale, and where the first try has left a
    record it updates that one instead; every other verb names its document and can be repeated."""

    def __init__(self, options: dict[str, str]) -> None:
        self.options = options

    def write(self, rows: Iterator) -> WriterCommitMessage:
        transport = _transport(self.options) if self.options.get("apply") == "true" else None
        collection, sent = self.options["collection"], Counter()
        code, step, document_id = None, 0, None
        for r in rows:
            if "code" not in r or r["code"] != code:
                code, step, document_id = (r["code"] if "code" in r else None), 0, None
            if "step" in r:
                if r["step"] <= step:
                    raise ValueError(f"steps of {code} come out of order; deal the rows with send()")
                step = r["step"]
            sent[r["verb"]] += 1
            if transport is None:
                continue
            verb, payload = r["verb"], json.loads(r["payload"])
            if verb == "create":
                document_id = self._present(transport, collection, code, r["locale"])
                if document_id is None:
                    answer = transport.write("create", collection, None, r["locale"], payload)
                    document_id = _value((answer or {}).get("data"), "documentId")
                    if not document_id:
                        raise RuntimeError(f"the store returned no documentId for {code}")
                    continue
                verb = "update"
            target = r["document_id"] or document_id
            if not target:
                raise ValueError(f"{verb} of {code} has no document: neither the plan nor a create before it tells one")
            transport.write(verb, collection, target, r["locale"], payload)
        return Sent(dict(sent))

    @staticmethod
    def _present(transport: object, collection: str, code: str | None, locale: str | None) -> str | None:
        query = {"filters[code][$eq]": code, "pagination[page]": 1, "pagination[pageSize]": 2} | ({"locale": locale} if locale else {})
        found = [r for r in transport.page(collection, query)["data"] if _value(r, "code") == code]
        if len(found) > 1:
            raise RuntimeError(f"the store has {code} more than once")
        return _value(found[0], "documentId") if found else None

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        total = sum((Counter(m.verbs) for m in messages if m is not None), Counter())
        logging.getLogger(__name__).info("%s: %s", self.options["collection"], dict(total))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """What was written stays: the store has no way back, and sending again goes on from there."""


def send(writes: DataFrame, options: dict[str, str], parallel: int = 8) -> None:
    """Send the writes of a plan (``reconcile.writes``) to a store: all of a code in one task, by step. Sent again, for a task that died or a
    job that failed, they leave the store as one pass would. ``parallel`` bounds the tasks that write at once."""
    writes.sparkSession.dataSource.register(ContentStore)
    writes.repartition(parallel, "code").sortWithinPartitions("code", "step").write.format("content_store").options(**options).mode("append").save()


class ContentStore(DataSource):
    @classmethod
    def name(cls) -> str:
        return "content_store"

    def schema(self) -> str:
        """``fields`` (names, comma-separated) are read out of each record as strings, so that equality with them is asked of the store."""
        names = [c.strip() for c in self.options.get("fields", "").split(",") if c.strip()]
        return ", ".join(["document_id string", "position long", "record string", *(f"`{c}` string" for c in names)])

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(dict(self.options))
