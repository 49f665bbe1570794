"""A content store in a folder, behind the transport of ``corpusprep.sources.cms``: one file for each document and locale."""

import json
import os
import uuid


class FileStore:
    def __init__(self, options):
        self.folder, self.fail_on = options["folder"], options.get("fail_on")

    def _records(self, collection):
        folder = f"{self.folder}/{collection}"
        for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
            with open(f"{folder}/{name}") as f:
                yield json.load(f)

    def page(self, collection, query):
        rows = [r for r in self._records(collection) if query.get("locale") in (None, r["attributes"]["locale"])]
        if (code := query.get("filters[code][$eq]")) is not None:
            rows = [r for r in rows if r["attributes"]["code"] == code]
        n = query["pagination[pageSize]"]
        return {"data": rows[(query["pagination[page]"] - 1) * n :][:n], "meta": {"pagination": {"total": len(rows)}}}

    def write(self, verb, collection, document_id, locale, payload):
        assert document_id or verb == "create"
        if self.fail_on == f"{verb} {payload.get('code')}" and not os.path.exists(f"{self.folder}/failed"):
            open(f"{self.folder}/failed", "w").close()
            raise ConnectionError("the store went away")
        document = document_id or f"doc-{uuid.uuid4().hex[:8]}"
        os.makedirs(f"{self.folder}/{collection}", exist_ok=True)
        path = f"{self.folder}/{collection}/{document}-{locale}"
        old = {}
        if os.path.exists(path):
            with open(path) as f:
                old = json.load(f)["attributes"]
        record = {"documentId": document, "attributes": old | {"locale": locale} | payload}
        part = f"{self.folder}/{uuid.uuid4().hex}"
        with open(part, "w") as f:
            json.dump(record, f)
        os.replace(part, path)  # other tasks read meanwhile
        return {"data": record}
