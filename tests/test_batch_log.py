import pytest

from tripfold.sources.paths import file_names
from tripfold.streaming import batch_log
from tripfold.streaming.batch_log import BatchLog


@pytest.fixture
def done():
    return set()


@pytest.fixture
def log(spark, tmp_path, done):
    return BatchLog(spark, str(tmp_path), "p", done.__contains__)


def test_numbers(log, done):
    assert log.number("a", 0) == 0 == log.number("a", 0)
    with pytest.raises(ValueError, match="a-0"):
        log.number("b", 0)
    done.add(0)
    assert (log.number("b", 0), log.number("a", 0)) == (1, 0)


@pytest.mark.parametrize("finished", [False, True])
def test_two_runs_that_ask_at_the_same_time(log, done, monkeypatch, finished):
    """Between the look and the grab of one run, another takes the number, and finishes its batch or not."""
    original = batch_log.create_file

    def late(*args):
        monkeypatch.setattr(batch_log, "create_file", original)
        assert log.number("other", 0) == 0
        if finished:
            done.add(0)
        return original(*args)

    monkeypatch.setattr(batch_log, "create_file", late)
    if finished:
        assert log.number("own", 0) == 1
    else:
        with pytest.raises(ValueError, match="other-0"):
            log.number("own", 0)
    assert log.number("other", 0) == 0


def test_folding_keeps_every_run(spark, log, done, monkeypatch):
    monkeypatch.setattr(batch_log, "RECENT", 3)
    for n in range(12):
        assert log.number("stream" if n % 2 else f"single{n}", n) == n
        done.add(n)
        if n % 4 == 3:
            log.fold()
    assert len(file_names(spark, log.folder)) <= 3 + 1 + 3
    assert log.number("stream", 11) == 11 and log.number("single2", 2) == 2 and log.number("stream", 12) == 12
    done.add(12)
    log.fold()
    log.fold()
    assert log.number("new", 0) == 13 and len(file_names(spark, log.folder)) <= 4 + 1


def test_a_start_that_was_cut_off(spark, log, done, monkeypatch):
    monkeypatch.setattr(batch_log, "PATIENCE", 0.2)
    batch_log.create_file(spark, f"{log.folder}/000000000", "")
    with pytest.raises(ValueError, match="names no run"):
        log.number("a", 0)
