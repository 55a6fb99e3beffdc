from datetime import datetime

import pytest
from helpers import rows

from candlewick.operators.quality import Check, invariant_checks, mart_checks, require_clean, run_checks


def test_there_are_88_mart_checks():
    kinds = [c.kind for c in mart_checks()]
    assert len(set(mart_checks())) == len(kinds) == 88
    counts = {k: kinds.count(k) for k in set(kinds)}
    assert counts == {"not_null": 55, "relationships": 17, "accepted_values": 11, "unique": 5}
    assert len(invariant_checks()) == 6


def test_each_kind_counts_its_failures(table):
    child = table(
        "id int, parent int, kind string", (1, 10, "a"), (1, 11, "b"), (2, 99, None), (None, None, "x"), (3, 99, "x"),
    )
    parent = table("id int", (10,), (11,), (11,))
    checks = [
        Check("not_null", "child", "id"), Check("unique", "child", "id"),
        Check("relationships", "child", "parent", ("parent", "id")),
        Check("accepted_values", "child", "kind", ("a", "b")),
        Check("unique_key", "child", "id, parent", ("id", "parent")),
        Check("unique", "parent", "id"),
    ]
    report = run_checks({"child": child, "parent": parent}, checks)
    assert rows(report, "check", "model", "failures") == [
        ("accepted_values", "child", 2), ("not_null", "child", 1), ("relationships", "child", 2),
        ("unique", "child", 1), ("unique", "parent", 1), ("unique_key", "child", 0),
    ]
    with pytest.raises(ValueError, match="relationships child.parent: 2"):
        require_clean(report)
    require_clean(report.filter("failures = 0"))


def test_overlapping_versions_are_found(table):
    t = datetime
    dim = table(
        "asset_id string, valid_from timestamp, valid_to timestamp",
        ("a", t(2024, 1, 1), t(2024, 2, 1)), ("a", t(2024, 2, 1), None), ("b", t(2024, 1, 1), None), ("b", t(2024, 3, 1), None),
    )
    check = Check("no_overlap", "dim", "asset_id", ("valid_from", "valid_to"))
    assert rows(run_checks({"dim": dim}, [check]), "failures") == [(1,)]


def test_absent_tables_fail_the_gate(table):
    child = table("id int, parent int", (1, 10))
    checks = [Check("not_null", "child", "id"), Check("relationships", "child", "parent", ("gone", "id")), Check("unique", "gone", "id")]
    report = run_checks({"child": child}, checks)
    assert rows(report, "check", "column", "failures") == [
        ("not_null", "id", 0), ("relationships", "parent: no table gone", 1), ("unique", "id: no table gone", 1)
    ]
    with pytest.raises(ValueError, match="no table gone"):
        require_clean(report)
