"""Daily refresh: newest deliveries replace older ones, and readers see whole versions only."""

import os

import pytest

from placelens.operators.cleaning import clean_places
from placelens.operators.facility import code_counts
from placelens.session import shared_folder
from placelens.sources.tables import read_raw_places
from placelens.streaming import refresh
from tests.conftest import rows
from tests.test_sources import raw_line


def drop(path, lines, modified):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(line + "\n" for line in lines))
    os.utime(path, (modified, modified))
    return str(path)


@pytest.fixture
def folders(tmp_path):
    return tmp_path / "raw", str(tmp_path / "store"), str(tmp_path / "state")


def streamed(spark, raw, store, state):
    query = refresh.run_refresh(refresh.stream_raw_places(spark, f"{raw}/*"), store, state)
    assert query.awaitTermination(120)


def agrees(spark, store, files):
    """The store holds what a batch run over these files gives, places and counts."""
    batch = clean_places(read_raw_places(spark, files))
    assert rows(refresh.read_places(spark, store)) == rows(batch)
    assert rows(refresh.read_counts(spark, store)) == rows(code_counts(batch))
    return True


def test_a_delivery_replaces_the_one_before(spark, folders):
    raw, store, state = folders
    aa = drop(raw / "day1/AA.csv", [raw_line(1), raw_line(2), raw_line(3, code="HSP")], 1000)
    bb = drop(raw / "day1/BB.csv", [raw_line(4, country="BB"), raw_line(5), raw_line(6, country="")], 1000)
    streamed(spark, raw, store, state)
    assert agrees(spark, store, [aa, bb]) and refresh.current_version(spark, store) == 1
    # Another path, fewer rows, one of them new; two files of a new country, of which the later one counts.
    aa = drop(raw / "day2/AA.csv", [raw_line(1, code="HSP"), raw_line(9)], 2000)
    cc = drop(raw / "day2/CC.csv", [raw_line(20, country="CC")], 2500)
    drop(raw / "day1/CC.csv", [raw_line(21, country="CC"), raw_line(22, country="CC")], 1500)
    streamed(spark, raw, store, state)
    assert agrees(spark, store, [aa, bb, cc]) and refresh.current_version(spark, store) == 2
    assert rows(refresh.read_places(spark, store, ["CC"])) == rows(clean_places(read_raw_places(spark, cc)))
    # Nothing new, and an old file that comes late.
    drop(raw / "late/AA.csv", [raw_line(77)], 1200)
    streamed(spark, raw, store, state)
    assert agrees(spark, store, [aa, bb, cc]) and refresh.current_version(spark, store) == 2


def test_a_file_replaced_under_its_path(spark, folders):
    raw, store, _ = folders
    bb = drop(raw / "BB.csv", [raw_line(4, country="BB")], 1000)
    aa = drop(raw / "A+ A.csv", [raw_line(1), raw_line(2)], 1000)
    assert refresh.refresh_changed(spark, str(raw), store) == 1 and agrees(spark, store, [aa, bb])
    assert refresh.refresh_changed(spark, str(raw), store) == 1
    drop(raw / "A+ A.csv", [raw_line(3)], 3000)
    assert refresh.refresh_changed(spark, str(raw), store) == 2 and agrees(spark, store, [aa, bb])
    versions = {r.delivery: r.version for r in refresh.manifest(spark, store).collect()}
    assert versions == {"A+ A": 2, "BB": 1}


def test_a_crash_leaves_the_old_version(spark, folders, monkeypatch):
    raw, store, state = folders
    old = drop(raw / "day1/AA.csv", [raw_line(1), raw_line(2)], 1000)
    streamed(spark, raw, store, state)
    reader = refresh.read_places(spark, store)
    new = drop(raw / "day2/AA.csv", [raw_line(3)], 2000)
    switch = refresh._switch

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(refresh, "_switch", crash)
    with pytest.raises(Exception, match="lost"):
        streamed(spark, raw, store, state)
    assert agrees(spark, store, old)
    # The batch is repeated, over the folders that the crash left.
    monkeypatch.setattr(refresh, "_switch", switch)
    streamed(spark, raw, store, state)
    assert agrees(spark, store, new)
    # Once more, as after a crash between the pointer and the checkpoint: nothing changes.
    again = refresh._raw_places(spark.read, [old, new])
    assert refresh.apply_deliveries(again, store) == 2 and agrees(spark, store, new)
    assert rows(reader.select("geonameid")) == [(1,), (2,)]


def test_vacuum_keeps_what_manifests_name(spark, folders, tmp_path):
    raw, store, _ = folders
    files = {}
    for day, name in enumerate(["AA", "BB", "AA", "AA"]):
        files[name] = drop(raw / f"{name}.csv", [raw_line(10 * day + i, country=name) for i in range(day + 1)], 1000 + day)
        refresh.refresh_changed(spark, str(raw), store)
    assert refresh.vacuum(spark, store, keep=1) == 3 + 2 * 2
    assert agrees(spark, store, list(files.values()))
    left = sorted(str(p.relative_to(f"{store}/places")) for p in (tmp_path / "store/places").glob("*/delivery=*"))
    assert left == ["version=2/delivery=BB", "version=4/delivery=AA"]
    assert refresh.vacuum(spark, store, keep=1) == 0


def test_an_empty_store(spark, folders):
    _, store, _ = folders
    assert refresh.read_places(spark, store).count() == refresh.read_counts(spark, store).count() == 0


def test_state_goes_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert shared_folder(spark, "daily") == f"{root.rstrip('/')}/daily"

    class Unset:
        class conf:
            @staticmethod
            def get(_key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset, "daily")
