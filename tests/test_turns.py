"""Runs that share a store at the same time."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from joblark.plans import ingest as jobs
from joblark.plans.ingest import IngestOptions
from joblark.sources import store as areas
from joblark.sources import turns as turns_module
from tests.test_ingest import as_of, ids, ingest, itviec, pages, saved, topdev


@pytest.fixture
def turns(spark, store):
    return areas.turns(spark, store)


def between(monkeypatch, act):
    """Do something once after the next run has settled and before it claims."""
    real, seen = jobs.settle, []

    def settle(*args):
        seen.append(args[7])
        staged = real(*args)
        if len(seen) == 1:
            act()
        return staged

    monkeypatch.setattr(jobs, "settle", settle)
    return seen


def test_a_number_is_given_once(turns):
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: turns.take(1, f"run {i}"), range(8)))
    assert sum(got) == 1 and turns.run_of(1) == f"run {got.index(True)}"
    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(lambda i: turns.claim(f"r{i}", 0, lambda _: False), range(8))) == list(range(2, 10))


def test_a_claim_is_compared_with_later_ones_only(turns):
    asked = []
    compare = lambda others: asked.append(others) or "b" in others
    assert turns.claim("a", 0, compare) == 1 and asked == []
    assert turns.claim("b", 1, compare) == 2 and asked == []
    assert turns.claim("c", 2, compare) == 3 and asked == []
    assert turns.claim("d", 1, compare) is None and asked == [["b", "c"]]
    assert turns.claim("d", 2, compare) == 4


def test_saved_claims_are_kept_for_some_time(turns, monkeypatch):
    monkeypatch.setattr(turns_module, "KEPT", 2)
    gone = []
    for n in range(1, 6):
        assert turns.claim(f"r{n}", n - 1, lambda _: False) == n
        gone += turns.saved(f"r{n}")
    assert gone == ["r1", "r2", "r3"] and [t.number for t in turns.listed()] == [4, 5]
    assert turns.claim("late", 2, lambda _: False) is None  # it missed claims that are no longer kept
    assert turns.claim("late", 3, lambda _: False) == 6


def test_an_open_claim_is_waited_for_until_its_lease_ends(turns, monkeypatch):
    monkeypatch.setattr(turns_module, "POLL_SECONDS", 0.05)
    turns.take(1, "a")
    turns.take(2, "b")
    waiting = threading.Thread(target=turns.wait, args=(2, 60))
    waiting.start()
    waiting.join(0.5)
    assert waiting.is_alive() and not turns.is_abandoned("a", 60)
    turns.saved("a")
    waiting.join(10)
    assert not waiting.is_alive()
    turns.take(3, "c")
    turns.wait(3, 0)  # b took its turn, but its lease is over
    assert turns.is_abandoned("b", 0) and not turns.is_abandoned("a", 0)
    turns.fail(3)
    assert turns.is_abandoned("c", 60)
    assert turns.again("c") == 4 and not turns.is_abandoned("c", 60)


def test_runs_that_interleave_save_an_id_once(spark, store, monkeypatch):
    seen = between(monkeypatch, lambda: ingest(spark, store, itviec(1), itviec(3)))
    assert ids(ingest(spark, store, itviec(1), itviec(2))) == ["itviec_s2"]
    assert saved(spark, store) == ["itviec_s1", "itviec_s2", "itviec_s3"]
    assert areas.read_jobs(spark, store, "itviec").count() == 3
    assert len(seen) == 3 and seen[0] == seen[2] != seen[1]  # the first settles again
    outcomes = areas.read_outcomes(spark, store).where(f"run_id = '{seen[0]}'").select("url", "outcome").collect()
    assert sorted(tuple(r) for r in outcomes) == [(itviec(1)[1], "known_id"), (itviec(2)[1], "saved")]
    assert [t.state for t in areas.turns(spark, store).listed()] == ["saved", "saved"]


def test_runs_without_a_common_id_settle_once(spark, store, monkeypatch):
    seen = between(monkeypatch, lambda: ingest(spark, store, itviec(3), topdev(1)))
    ingest(spark, store, itviec(1), topdev(2))
    assert saved(spark, store) == ["itviec_s1", "itviec_s3", "topdev_1", "topdev_2"] and len(seen) == 2


def test_a_claim_that_is_not_saved_counts_as_known(spark, store, monkeypatch):
    """The other run fails in its save; its rows are its own still, and are saved when it is finished."""

    def other():
        real = areas.load_silver
        monkeypatch.setattr(areas, "load_silver", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.run(pages(spark, itviec(1)), (jobs_spec,), store, as_of=as_of())
        monkeypatch.setattr(areas, "load_silver", real)

    from joblark.sources.sites import ITVIEC as jobs_spec

    between(monkeypatch, other)
    assert ids(ingest(spark, store, itviec(1), itviec(2))) == ["itviec_s2"]
    assert saved(spark, store) == ["itviec_s2"]
    jobs.run(pages(spark, itviec(4)), (jobs_spec,), store, as_of=as_of())
    assert saved(spark, store) == ["itviec_s1", "itviec_s2", "itviec_s4"]


def test_a_run_at_work_is_not_finished_by_another(spark, store, monkeypatch):
    """A run that has settled or claimed is left alone while its lease lasts."""
    real, other = areas.load_silver, []

    def slow(*args):
        monkeypatch.setattr(areas, "load_silver", real)
        run = threading.Thread(target=lambda: other.append(ids(ingest(spark, store, itviec(1), itviec(2)))))
        run.start()
        run.join(4)
        other.append(run)
        real(*args)

    monkeypatch.setattr(areas, "load_silver", slow)
    assert ids(ingest(spark, store, itviec(1))) == ["itviec_s1"]
    other[0].join(120)
    assert other[1:] == [["itviec_s2"]] and saved(spark, store) == ["itviec_s1", "itviec_s2"]


def test_many_runs_at_once(spark, store):
    rows = [[itviec(i), itviec(i + 1), topdev(i)] for i in range(4)]
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda r: ids(ingest(spark, store, *r, options=IngestOptions(on_gate="reject"))), rows))
    want = sorted([f"itviec_s{i}" for i in range(5)] + [f"topdev_{i}" for i in range(4)])
    assert sorted(sum(got, [])) == want == saved(spark, store)
    assert areas.read_jobs(spark, store, "itviec").count() == 5
