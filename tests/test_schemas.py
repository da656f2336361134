"""Schema evolution: kinds of fields, changes against the registry, and rows that follow."""

import json

import pytest
from pyspark.sql import functions as F

from chronolake.functions.specs import EntitySpec, RegexGroup
from chronolake.operators import schemas
from chronolake.operators.decode import decode_payload
from chronolake.operators.envelope import parse_envelope
from chronolake.operators.history import build_history, current_rows
from chronolake.operators.schemas import REGISTRY, advanced, evolved, observed_fields, schema_changes, widened_rows
from chronolake.operators.scd2 import apply_scd2
from chronolake.sources.files import RECORD
from shop import Feed

SPEC = EntitySpec("users", {"id": "bigint", "name": "string", "score": "bigint"})


def images(spark, rows):
    return spark.createDataFrame([(t, op, v if v is None or isinstance(v, str) else json.dumps(v)) for t, op, v in rows],
                                 "source_table string, operation string, after_json string")


def test_kinds_hold_all_values(spark):
    rows = [("a", "c", {"i": 1, "d": 1, "s": "x", "m": 1, "b": True, "o": {"x": 1}, "n": None, "v": None})]
    rows += [("a", "u", {"i": 2, "d": 0.5, "s": "1", "m": "1", "b": False, "o": {"y": 1}, "n": None, "v": 3})]
    rows += [("a", "d", {"ghost": 1}), ("a", "c", "no json"), ("a", "c", "[1]"), ("a", "c", None), (None, "c", {"i": 1}), ("b", "c", {"i": 1e300})]
    found = {(r.source_table, r.field): (r.kind, r.row_count) for r in observed_fields(images(spark, rows)).collect()}
    kinds = {"i": "bigint", "d": "double", "s": "string", "m": "string", "b": "boolean", "o": "string", "n": "void", "v": "bigint"}
    assert found == {**{("a", f): (k, 2) for f, k in kinds.items()}, ("b", "i"): ("double", 1)}
    assert observed_fields(images(spark, [])).count() == 0


def test_changes_against_the_registry(spark):
    known = spark.createDataFrame(
        [("a", "same", "bigint"), ("a", "narrow", "bigint"), ("a", "wide", "double"), ("a", "gone", "boolean"),
         ("a", "later", "void"), ("a", "mixed", "boolean"), ("quiet", "x", "string")], REGISTRY)
    batch = observed_fields(images(spark, [("a", "c", {"same": 1, "narrow": 1.5, "wide": 1, "later": 2, "mixed": 1, "new": "x"}), ("c", "c", {"id": 1})]))
    changes = schema_changes(known, batch)
    assert {(r.source_table, r.field): (r.change, r.old_kind, r.new_kind, r.row_count) for r in changes.collect()} == {
        ("a", "same"): ("unchanged", "bigint", "bigint", 1),
        ("a", "narrow"): ("widened", "bigint", "double", 1),
        ("a", "wide"): ("unchanged", "double", "double", 1),
        ("a", "gone"): ("dropped", "boolean", "boolean", 0),
        ("a", "later"): ("widened", "void", "bigint", 1),
        ("a", "mixed"): ("widened", "boolean", "string", 1),
        ("a", "new"): ("added", None, "string", 1),
        ("quiet", "x"): ("unchanged", "string", "string", 0),
        ("c", "id"): ("added", None, "bigint", 1),
    }
    again = schema_changes(advanced(changes), batch)
    assert {r.change for r in again.collect()} == {"unchanged", "dropped"}


def test_entities_follow_but_for_clashing_names(spark, monkeypatch):
    spec = EntitySpec("users", {"id": "bigint", "n": "bigint", "q": "int", "cents": "double"}, {"domain": RegexGroup("n", "(.)", 1)}, decimals={"cents": 2})
    fields = {"id": "string", "n": "double", "q": "string", "cents": "string", "N": "string", "domain": "string",
              "operation": "string", "_Hash": "string", "nothing": "void", "city": "string", "City": "bigint"}
    registry = spark.createDataFrame([("users", f, k) for f, k in fields.items()] + [("other", "x", "string")], REGISTRY)
    assert evolved(spec, registry).columns == {"id": "bigint", "n": "double", "q": "int", "cents": "double", "City": "bigint"}
    monkeypatch.setattr(schemas, "MAX_FIELDS", 3)
    with pytest.raises(ValueError, match="more than 3 fields"):
        evolved(spec, registry)


def test_silver_rows_keep_new_columns(spark):
    feed = Feed()

    def parse(records):
        return parse_envelope(spark.createDataFrame([{**r, "timestamp": None} for r in records], RECORD))

    before = parse([feed.record("users", "c", {"id": n, "name": f"u{n}", "score": n}) for n in (1, 2, 3)])
    history = build_history(decode_payload(before, SPEC), SPEC)
    registry = advanced(schema_changes(spark.createDataFrame([], REGISTRY), observed_fields(before)))
    after = parse([
        feed.record("users", "u", {"id": 1, "name": "u1", "score": 1}),
        feed.record("users", "u", {"id": 2, "name": "u2", "score": 2.5}),
        feed.record("users", "u", {"id": 3, "name": "u3", "score": 3, "city": "Rome"}),
    ])
    changes = schema_changes(registry, observed_fields(after))
    spec = evolved(SPEC, advanced(changes))
    assert spec.columns == {"id": "bigint", "name": "string", "score": "double", "city": "string"}
    wide = widened_rows(history, spec)
    assert wide.dtypes == list(spec.silver_types().items())
    # What was there already has the hash that the evolved entity gives it.
    assert {r._hash for r in wide.collect()} == {r._hash for r in build_history(decode_payload(before, spec), spec).collect()}
    stepped = apply_scd2(current_rows(wide), decode_payload(after, spec), spec, F.lit("2030-01-01").cast("timestamp"))
    now = {r.id: r for r in stepped.where("_is_current").collect()}
    assert [(now[n].score, now[n].city) for n in (1, 2, 3)] == [(1.0, None), (2.5, None), (3.0, "Rome")]
    assert stepped.where("not _is_current").count() == 2  # the first only repeats its content
