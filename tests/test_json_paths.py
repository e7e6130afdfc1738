"""Paths of a JSON column against a walk over each document."""

import json
from collections import Counter

from ledgerline.operators.json_paths import json_paths


def kind(v):
    names = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null", int: "number", float: "number"}
    return names[type(v)]


def walk(v, path, depth):
    yield path, kind(v)
    if depth:
        inner = [(f"{path}.{k}", x) for k, x in v.items()] if isinstance(v, dict) else [(f"{path}[]", x) for x in v] if isinstance(v, list) else []
        for p, x in inner:
            yield from walk(x, p, depth - 1)


def test_paths(spark):
    docs = [{"a": 1, "b": {"c": [1, "x", None, {"d": 2.5}]}}, {"a": "1"}, {}, [], [[1], {"a": True}], 5, "text", None, {"a.b": 1, "": 2}]
    texts = [json.dumps(d) for d in docs] * 3 + ["{", "", None, "{'a': 1}"]
    for depth in (0, 1, 2, 6):
        want = Counter()
        for t in texts:
            try:
                want.update(walk(json.loads(t), "$", depth))
            except TypeError:
                want["$", "missing"] += 1
            except ValueError:
                want["$", "malformed"] += 1
        frame = spark.createDataFrame([(t, 1, "p") for t in texts], "j string, doc int, path string")
        assert {(r["path"], r["type"]): r["values"] for r in json_paths(frame, "j", depth).collect()} == want
