"""A client for tests and queries: answers by rule, without any network."""

from __future__ import annotations

import json
import sys

from pyspark import cloudpickle

# Workers need not have this package installed to run the client.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class RuleClient:
    """Rejects documents whose field ``k`` is text (400), or whose user number is divisible by 89 (429)."""

    def send(self, body: str) -> tuple[int, bool, str]:
        lines = body.split("\n")
        items = [self._item(lines[i], lines[i + 1]) for i in range(0, len(lines) - 1, 2)]
        errors = any("error" in next(iter(item.values())) for item in items)
        return 200, True, json.dumps({"errors": errors, "items": items})

    def _item(self, action: str, document: str) -> dict:
        (op, target), = json.loads(action).items()
        fields = json.loads(document)["fields"]
        item = {"_index": target["_index"], "_id": target.get("_id")}
        if isinstance(fields["k"], str):
            error = {"type": "mapper_parsing_exception", "reason": "field k is not a number"}
            return {op: {**item, "status": 400, "error": error}}
        if fields["UserId"] % 89 == 0:
            return {op: {**item, "status": 429, "error": {"type": "rejected", "reason": "queue is full"}}}
        return {op: {**item, "status": 201}}
