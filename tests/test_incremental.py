from datetime import datetime

from helpers import d, days, rows
from pyspark.sql import functions as F

from candlewick import schemas as S
from candlewick.operators.incremental import advance_control, backfill_days, incremental_filter, scd2_apply
from candlewick.operators.quality import Check, run_checks


def t(text):
    return datetime.fromisoformat(text)


def test_look_back_from_the_newest_stored_day(table):
    source = table("s string, date date", *[("a", x) for x in days("2024-01-01", 20)])
    target = source.filter(F.col("date") <= d("2024-01-10"))
    fresh = incremental_filter(source, target, date="date", lookback_days=3)
    assert fresh.agg(F.min("date")).first()[0] == d("2024-01-07")


def test_empty_target_takes_everything(table):
    source = table("s string, date date", *[("a", x) for x in days("2024-01-01", 20)])
    assert incremental_filter(source, source.limit(0), date="date", lookback_days=3).count() == 20


def test_lagging_symbol_loses_its_gap_unless_marked_per_key(table):
    source = table("s string, date date", *[(s, x) for s in "ab" for x in days("2024-01-01", 20)])
    target = source.filter("(s = 'a' and date <= '2024-01-18') or (s = 'b' and date <= '2024-01-05')")
    glob = incremental_filter(source, target, date="date", lookback_days=3)
    own = incremental_filter(source, target, date="date", lookback_days=3, per_key="s")
    first = {s: lo for s, lo in rows(glob.groupBy("s").agg(F.min("date")))}
    assert first == {"a": d("2024-01-15"), "b": d("2024-01-15")}
    first = {s: lo for s, lo in rows(own.groupBy("s").agg(F.min("date")))}
    assert first == {"a": d("2024-01-15"), "b": d("2024-01-02")}


def test_backfill_window(table):
    control = table(
        "pipeline_name string, last_load_timestamp timestamp, is_first_load boolean",
        ("first", None, True), ("gap0", t("2024-03-31 07:45:00"), False),
        ("gap5", t("2024-03-26 23:59:00"), False), ("gap90", t("2024-01-01"), False),
    )
    out = backfill_days(control, as_of=F.lit(d("2024-03-31")))
    assert dict(rows(out, "pipeline_name", "backfill_days")) == {"first": 30, "gap0": 1, "gap5": 6, "gap90": 30}
    assert dict(rows(out, "pipeline_name", "days_uncovered")) == {"first": 0, "gap0": 0, "gap5": 0, "gap90": 61}
    forced = backfill_days(control, as_of=F.lit(d("2024-03-31")), override=200)
    assert {r[0] for r in rows(forced, "backfill_days")} == {200}


def test_failed_run_keeps_the_mark(table):
    control = table(S.CONTROL, ("p", t("2024-01-01"), True, None, None))
    now = F.lit(t("2024-01-05"))
    failed = advance_control(control, status=F.lit("FAILED"), now=now).first()
    assert (failed.last_load_timestamp, failed.is_first_load) == (t("2024-01-01"), True)
    moved = advance_control(control, status=F.lit("PARTIAL_SUCCESS"), now=now).first()
    assert (moved.last_load_timestamp, moved.is_first_load) == (t("2024-01-05"), False)


SNAP = "asset_id string, symbol string, asset_type string, first_seen date, last_seen date"
ARGS = dict(
    key="asset_id", tracked=["symbol", "asset_type"], first_seen="first_seen", last_seen="last_seen",
    surrogate="asset_key",
)


def test_scd2_closes_changed_versions_and_opens_new_ones(table):
    first = table(SNAP, *[(a, a, "Crypto", d("2024-01-01"), d("2024-02-01")) for a in ("b", "a", "gone")])
    dim = scd2_apply(None, first, **ARGS)
    assert rows(dim, "asset_key", "asset_id") == [(1, "a"), (2, "b"), (3, "gone")]

    second = table(
        SNAP, ("a", "a", "Stock", d("2024-01-01"), d("2024-03-01")), ("b", "b", "Crypto", d("2024-01-01"), d("2024-03-01")),
        ("new", "new", "Stock", d("2024-02-15"), d("2024-03-01")),
    )
    changed = scd2_apply(dim, second, **ARGS)
    got = {(r.asset_id, r.asset_key): (r.asset_type, r.valid_from, r.valid_to, r.is_current) for r in changed.collect()}
    assert got == {
        ("a", 1): ("Crypto", t("2024-01-01"), t("2024-03-01"), False),
        ("a", 4): ("Stock", t("2024-03-01"), None, True),
        ("b", 2): ("Crypto", t("2024-01-01"), None, True),
        ("gone", 3): ("Crypto", t("2024-01-01"), None, True),
        ("new", 5): ("Stock", t("2024-02-15"), None, True),
    }
    # no change, no new rows
    assert rows(scd2_apply(changed, second, **ARGS)) == rows(changed)
    clean = run_checks(
        {"dim_asset": changed},
        [Check("unique", "dim_asset", "asset_key"), Check("no_overlap", "dim_asset", "asset_id", ("valid_from", "valid_to"))],
    )
    assert [r.failures for r in clean.collect()] == [0, 0]


def test_scd2_treats_null_as_a_value(table):
    first = table(SNAP, ("a", "a", None, d("2024-01-01"), d("2024-02-01")))
    dim = scd2_apply(None, first, **ARGS)
    assert scd2_apply(dim, first, **ARGS).count() == 1
    second = table(SNAP, ("a", "a", "Crypto", d("2024-01-01"), d("2024-03-01")))
    assert scd2_apply(dim, second, **ARGS).count() == 2


def test_key_known_only_by_closed_versions_reopens_after_them(table):
    dim = table(S.DIM_ASSET, (1, "a", "a", "Crypto", t("2024-01-01"), t("2024-02-01"), False))
    snap = table(SNAP, ("a", "a", "Crypto", d("2024-01-01"), d("2024-03-01")))
    out = scd2_apply(dim, snap, **ARGS)
    assert rows(out, "asset_key", "valid_from", "valid_to") == [
        (1, t("2024-01-01"), t("2024-02-01")), (2, t("2024-03-01"), None)
    ]
