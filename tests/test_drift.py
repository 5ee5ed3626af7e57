"""Schema drift against a walk over parsed messages."""

import json
import random
from collections import Counter

from pyspark.sql import functions as F

from sensorstream.operators.drift import drift, field_types, shapes
from sensorstream.schemas import READING

ODD = [
    None, "", "nope", '{"id":1', "null", "12", '"s"', "[]", "{}", '[1,"a"]', '{"id":1,"id":2}', '{"id":1,"value":1e3}',
    '{"a b":{"x.y":[{"k":1},{"k":null}]},"c`d":true}', '{"":1,"[]":2,"ü":{"OBJECT<":[]},"DECIMAL":1.25}',
    '{"v":12345678901234567890}', '{"id":{"id":{"id":[[[1]]]}}}', '{"note":"}, id: BIGINT, x"}',
]


def quoted(name):
    plain = name.isascii() and name.replace("_", "a").isalnum() and not name.isdigit()
    return name if plain else "`" + name.replace("`", "``") + "`"


def type_of(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "truth"
    if isinstance(v, int):
        return "whole" if abs(v) < 2**63 else "fraction"
    return {float: "fraction", str: "text", dict: "object", list: "array"}[type(v)]


def walk(values, path, found):
    """Types of values that share a path in one message; nulls give way to others."""
    kinds = {type_of(v) for v in values}
    kinds = (kinds - {"null"}) or {"null"}
    kind = kinds.pop() if len(kinds) == 1 else "mixed"
    found.add((".".join(path), kind))
    some = [v for v in values if v is not None]
    if kind == "object":
        for name in {k for v in some for k in v}:
            walk([v[name] for v in some if name in v], [*path, quoted(name)], found)
    if kind == "array":
        walk([x for v in some for x in v] or [None], [*path, "[]"], found)


def plain(texts):
    counts = Counter()
    for text in texts:
        found = set()
        try:
            names = lambda pairs: dict(pairs) if len(dict(pairs)) == len(pairs) else 1 / 0
            walk([json.loads(text, object_pairs_hook=names)], [], found)
        except (ValueError, TypeError, ZeroDivisionError):
            found = {("", "unreadable")}
        counts.update(found)
    return counts


def counted(frame):
    return Counter({(r.path, r.type): r.n for r in frame.collect()})


def random_value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 6)
    if kind == 6:
        return {rng.choice(["id", "value", "a b", "x"]): random_value(rng, depth + 1) for _ in range(rng.randrange(3))}
    if kind == 7:
        return [rng.choice([None, 3, 4]) for _ in range(rng.randrange(3))]
    return [None, True, 7, 2.5, "t", rng.randrange(10**6)][kind]


def test_types_of_odd_and_random_messages(spark):
    rng = random.Random(3)
    made = [json.dumps({k: random_value(rng) for k in rng.sample([*READING.names, "more"], 4)}) for _ in range(300)]
    texts = ODD + made + made[:20]
    frame = spark.createDataFrame([(t,) for t in texts], "value string").repartition(5)
    assert counted(field_types(shapes(frame))) == plain(texts)


def test_counts_of_parts_add_up(spark):
    frame = spark.createDataFrame([(t, k % 2) for k, t in enumerate(ODD * 3)], "value string, half int")
    halves = field_types(shapes(frame, ["half"]), ["half"]).groupBy("path", "type").agg(F.sum("n").alias("n"))
    assert counted(halves) == counted(field_types(shapes(frame)))


def test_faults(spark):
    good = {"id": 1, "location_id": 2, "latitude": 1.5, "longitude": 2, "elevation": 0.5, "sensor_type": "t",
            "timestamp": "2010-01-01 00:00:00", "value": 95}
    texts = [json.dumps(good)] * 3
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    assert drift(field_types(shapes(frame))).where("fault is not null").isEmpty()
    lacking = {k: v for k, v in good.items() if k != "elevation"}
    texts += [json.dumps(lacking), json.dumps(good | {"id": "x", "extra": {"elevation": 1}}), json.dumps(good | {"value": None}), "[]"]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    found = {(r.path, r.type, r.n, r.fault) for r in drift(field_types(shapes(frame))).collect() if r.fault}
    assert found == {
        ("", "array", 1, "no object"), ("[]", "null", 1, "unknown field"), ("elevation", "absent", 1, "missing"),
        ("id", "text", 1, "wrong type"), ("extra", "object", 1, "unknown field"),
        ("extra.elevation", "whole", 1, "unknown field"), ("value", "null", 1, "wrong type"),
    }
    assert drift(field_types(shapes(frame.where("false")))).isEmpty()


def test_shapes_are_counted_before_the_only_exchange(spark):
    frame = spark.createDataFrame([(t,) for t in ODD], "value string")
    plan = shapes(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
    assert "partial_count" in plan[plan.index("Exchange") :]
