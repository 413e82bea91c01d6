"""Jobs that die half way: what the next one finds, finishes, resumes or discards."""

from datetime import datetime

import pytest

from helpers import at, event, events, multiset
from tidemark.contract import ALERTS, BRONZE, LIQUIDITY, SILVER
from tidemark.operators import compact
from tidemark.operators import medallion as m
from tidemark.operators.compact import compact_layer, compact_partitions
from tidemark.operators.gold import hourly_liquidity
from tidemark.plans import gold_build
from tidemark.plans.gold_build import build_gold
from tidemark.sources.folders import Folders
from tidemark.sources.journal import Change, begin, recover, unfinished
from tidemark.sources.layers import compacted_root, expire_compacted, read_layer, read_layered
from tidemark.sources.tables import read_table, table_root, write_load, write_silver

HOUR = 3600
AS_OF = datetime(2026, 5, 30, 15)
STABLE = [c for c in LIQUIDITY.columns if c != "model_updated_at"]


class Killed(Exception):
    pass


def silver_of(spark, salt, *rows):
    return m.to_silver(m.valid(m.with_event_time(events(spark, *rows))), salt)


def load(spark, salt, warehouse, number, hours, tag=""):
    rows = [event(f"t{tag}{number}-{h}-{i}", at(h * HOUR + i + number)) for h in hours for i in range(3)]
    write_silver(silver_of(spark, salt, *rows), table_root(warehouse, SILVER), f"q-{number}")


def live(spark, warehouse):
    return multiset(read_table(spark, table_root(warehouse, SILVER), SILVER))


def dies_at(monkeypatch, owner, name, call):
    """Let the n-th call of a method raise, as if the job had been killed there."""
    calls, real = [], getattr(owner, name)

    def wrapped(*args, **kwargs):
        calls.append(1)
        if len(calls) == call:
            raise Killed
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, wrapped)


@pytest.mark.parametrize("owner, name, call", [(Change, "finish", 1), (Folders, "move_here", 1), (Folders, "move_here", 2)])
def test_merge_that_died_while_swapping_is_finished(spark, salt, tmp_path, monkeypatch, owner, name, call):
    first = silver_of(spark, salt, *[event(f"a{h}", at(h * HOUR)) for h in range(3)])
    second = silver_of(spark, salt, *[event(f"{x}{h}", at(h * HOUR)) for h in range(4) for x in "ab"])
    root = build_gold(spark, "gold_hourly_liquidity", first, str(tmp_path), as_of=AS_OF)
    with monkeypatch.context() as patch:
        dies_at(patch, owner, name, call)
        with pytest.raises(Killed):
            build_gold(spark, "gold_hourly_liquidity", second, str(tmp_path), as_of=AS_OF)
    assert [c.state for c in unfinished(spark, root)] == ["staged"]
    assert recover(spark, root) == []
    assert multiset(read_table(spark, root, LIQUIDITY), STABLE) == multiset(hourly_liquidity(second), STABLE)
    assert Folders(spark, root).names("_journal") == Folders(spark, root).names("_staging") == []


def test_merge_that_died_before_staging_leaves_the_table(spark, salt, tmp_path, monkeypatch):
    first = silver_of(spark, salt, event("a", at(1)))
    root = build_gold(spark, "gold_hourly_liquidity", first, str(tmp_path), as_of=AS_OF)
    with monkeypatch.context() as patch:
        dies_at(patch, gold_build, "merge_incremental", 1)
        with pytest.raises(Killed):
            build_gold(spark, "gold_hourly_liquidity", silver_of(spark, salt, event("b", at(2))), str(tmp_path), as_of=AS_OF)
    assert [c.state for c in unfinished(spark, root)] == ["staging"]
    rows = silver_of(spark, salt, event("a", at(1)), event("c", at(3)))
    build_gold(spark, "gold_hourly_liquidity", rows, str(tmp_path), as_of=AS_OF)  # discards the rest of the dead one
    assert multiset(read_table(spark, root, LIQUIDITY), STABLE) == multiset(hourly_liquidity(rows), STABLE)
    assert Folders(spark, root).names("_staging") == []


def test_merge_writes_only_its_hours(spark, salt, tmp_path):
    import glob

    rows = silver_of(spark, salt, event("old", at(-90 * HOUR), is_flagged_suspicious=True), event("new", at(1), is_flagged_suspicious=True))
    root = build_gold(spark, "gold_fraud_alerts", rows, str(tmp_path), as_of=AS_OF)
    before = set(glob.glob(f"{root}/**/*.parquet", recursive=True))
    build_gold(spark, "gold_fraud_alerts", rows, str(tmp_path), as_of=AS_OF)
    after = set(glob.glob(f"{root}/**/*.parquet", recursive=True))
    assert {f for f in before if "day=26" in f} == {f for f in after if "day=26" in f} != set()
    assert len(after) == len(before) and after != before
    assert multiset(read_table(spark, root, ALERTS).drop("model_updated_at")) != []


def test_compaction_in_place_survives(spark, salt, tmp_path, monkeypatch):
    root = f"{tmp_path}/gold"
    rows = hourly_liquidity(silver_of(spark, salt, *[event(f"t{h}{c}", at(h * HOUR), currency=c) for h in range(4) for c in ("USD", "EUR", "JPY")]))
    rows.repartition(6).write.partitionBy(*LIQUIDITY.partition_by).parquet(root)
    wanted = multiset(read_table(spark, root, LIQUIDITY), STABLE)
    with monkeypatch.context() as patch:
        dies_at(patch, Folders, "move_here", 3)
        with pytest.raises(Killed):
            compact_partitions(spark, root, root, LIQUIDITY)
    compact_partitions(spark, root, root, LIQUIDITY)
    assert multiset(read_table(spark, root, LIQUIDITY), STABLE) == wanted
    assert compact_partitions(spark, root, root, LIQUIDITY).rewritten_hours == 0


def test_layer_takes_in_closed_hours_once(spark, salt, tmp_path):
    lake = str(tmp_path)
    for number in range(3):
        load(spark, salt, lake, number, range(3))
    assert read_layer(spark, compacted_root(lake, SILVER)) is None
    report = compact_layer(spark, lake, SILVER)
    assert (report.rewritten_hours, report.files_planned) == (2, 2) and report.files_before >= 6
    layer = read_layer(spark, compacted_root(lake, SILVER))
    assert (layer.through_key, layer.loads) == (2026053013, {"q": 2})
    assert multiset(read_layered(spark, lake, SILVER)) == live(spark, lake)
    assert compact_layer(spark, lake, SILVER).rewritten_hours == 0  # nothing is copied again

    load(spark, salt, lake, 3, [0, 2, 3])  # a late load for hour 0, the open hour, and a new one
    assert multiset(read_layered(spark, lake, SILVER)) == live(spark, lake)
    wanted = live(spark, lake)
    report = compact_layer(spark, lake, SILVER)
    assert report.rewritten_hours == 2  # hours 0 and 2
    assert multiset(read_layered(spark, lake, SILVER)) == wanted
    for bounds in ((2026053012, 2026053012), (2026053013, None), (None, 2026053014), (2026053015, None)):
        got = read_layered(spark, lake, SILVER, *bounds)
        assert multiset(got) == multiset(compact.in_hours(read_table(spark, table_root(lake, SILVER), SILVER), *bounds))

    # An earlier end does not lose late rows of hours that the layer has already.
    load(spark, salt, lake, 4, [1, 2])
    wanted = live(spark, lake)
    compact_layer(spark, lake, SILVER, end_key=2026053012)
    assert multiset(read_layered(spark, lake, SILVER)) == wanted
    assert expire_compacted(spark, lake, SILVER) > 0
    assert multiset(read_layered(spark, lake, SILVER)) == wanted
    load(spark, salt, lake, 4, [1, 2])  # the last load replayed after it was taken in and expired
    assert multiset(read_layered(spark, lake, SILVER)) == wanted


def test_loads_under_way_stay_live(spark, salt, tmp_path):
    lake = str(tmp_path)
    load(spark, salt, lake, 0, range(3))
    half = silver_of(spark, salt, event("half", at(5)))
    write_load(half, table_root(lake, SILVER), SILVER, "q-1")
    Folders(spark, table_root(lake, SILVER)).write_json("_loads/q", {"last": 0})  # as before load 1 is complete
    compact_layer(spark, lake, SILVER)
    assert read_layer(spark, compacted_root(lake, SILVER)).loads == {"q": 0}
    assert multiset(read_layered(spark, lake, SILVER)) == live(spark, lake)


@pytest.mark.parametrize(
    "owner, name, call", [(compact, "_write_merged", 2), (Change, "stage", 1), (Change, "finish", 1), (Folders, "move_here", 2)]
)
def test_layer_compaction_that_died_is_resumed(spark, salt, tmp_path, monkeypatch, owner, name, call):
    lake = str(tmp_path)
    for number in range(2):
        load(spark, salt, lake, number, range(4))
    wanted = live(spark, lake)
    with monkeypatch.context() as patch:
        dies_at(patch, owner, name, call)
        with pytest.raises(Killed):
            compact_layer(spark, lake, SILVER, run_tasks=1)
    load(spark, salt, lake, 2, [0, 1, 4], tag="later")
    assert multiset(read_layered(spark, lake, SILVER)) == live(spark, lake)
    written = []
    real = compact._write_merged
    monkeypatch.setattr(compact, "_write_merged", lambda rows, dst, spec, run, target: (written.extend(h.hour_key for h in run), real(rows, dst, spec, run, target))[1])
    compact_layer(spark, lake, SILVER, run_tasks=1)
    if name == "_write_merged":  # hour 12 had been staged; it is written again for the later load alone
        assert written == [2026053013, 2026053014, 2026053012, 2026053013, 2026053015]
    assert multiset(read_layered(spark, lake, SILVER)) == live(spark, lake)
    assert set(wanted) <= set(live(spark, lake))
    expire_compacted(spark, lake, SILVER)
    assert Folders(spark, table_root(lake, SILVER)).hours(end_key=2026053015, whole=True) == [
        f"year=2026/month=5/day=30/hour={h}" for h in (12, 13, 14, 15)
    ]
    assert len(multiset(read_layered(spark, lake, SILVER))) == len(wanted) + 9


def test_changes_are_noted_until_done(spark, tmp_path):
    change = begin(spark, str(tmp_path), "merge", note={"_mark": {"a": 1}})
    assert [(c.name, c.state) for c in unfinished(spark, str(tmp_path))] == [(change.name, "staging")]
    change.stage()
    recover(spark, str(tmp_path))
    assert unfinished(spark, str(tmp_path)) == []
    assert Folders(spark, str(tmp_path)).read_json("_mark") == {"a": 1}


def test_only_streamed_tables_have_layers(spark, tmp_path):
    with pytest.raises(ValueError, match="streamed"):
        compact_layer(spark, str(tmp_path), LIQUIDITY)
    assert compact_layer(spark, str(tmp_path), BRONZE).rewritten_hours == 0
