"""The status log as a state machine."""

from datetime import datetime

import pytest

from wiremere.operators import status

T = [datetime(2024, 1, d) for d in range(1, 20)]


@pytest.fixture
def bronze(frame):
    rows = [(str(i), "s", None, f"t{i}", "x" * 300, T[10 - i]) for i in range(4)]
    return frame(
        "id string, source_name string, source_url string, title string, raw_text string, "
        "ingested_at timestamp", rows,
    )


@pytest.fixture
def log(frame):
    return lambda *rows: frame(
        "bronze_id string, status string, error string, logged_at timestamp, run_id string",
        [(*r, "run") for r in rows],
    )


def ids(df, column="id"):
    return sorted((r[column] for r in df.collect()), reverse=True)


def test_states_in_turn(bronze, log, frame):
    failed = log(("1", "failed", "boom", T[1]))
    assert ids(status.work_queue(bronze, failed)) == ["3", "2", "0"]
    letter = status.dead_letter_page(bronze, failed, 5).first()
    assert (letter["id"], letter["processing_error"], len(letter["raw_text_preview"])) == ("1", "boom", 200)

    again = status.retry(failed, frame("bronze_id string", [("1",), ("2",)]), T[2])
    assert ids(again, "bronze_id") == ["1"], "only failed articles are retried"
    retried = failed.unionByName(again)
    assert ids(status.work_queue(bronze, retried)) == ["3", "2", "1", "0"]
    assert status.dead_letters(bronze, retried).isEmpty()

    done = retried.unionByName(log(("1", "silver", None, T[3])))
    assert ids(status.work_queue(bronze, done)) == ["3", "2", "0"]
    assert status.dead_letters(bronze, done).isEmpty()


def test_limits_and_order(bronze, log):
    nothing = log(("9", "noise", None, T[0]))
    assert ids(status.work_queue(bronze, nothing, 2)) == ["3", "2"]
    assert len(ids(status.work_queue(bronze, nothing, None))) == 4


def test_silver_without_status_counts_as_done(bronze, log, frame):
    silver = frame("bronze_id string", [("0",), ("1",)])
    state = log(("1", "retry", None, T[1]))
    assert sorted(ids(status.work_queue(bronze, state, silver=silver))) == ["1", "2", "3"]


def test_latest_row_wins_whatever_the_order(log):
    rows = [("1", "failed", "e", T[3]), ("1", "retry", None, T[5]), ("1", "silver", None, T[4])]
    assert ids(status.current(log(*rows)), "status") == ["retry"]
    assert ids(status.current(log(*rows[::-1])), "status") == ["retry"]


def test_noise_is_neither_signal_nor_failure(frame):
    batch = frame("bronze_id string", [("1",), ("2",), ("3",), ("3",)])
    one, two = (frame("bronze_id string", [(i,)]) for i in "12")
    assert ids(status.noise(batch, one, two), "bronze_id") == ["3"]


def test_dead_letter_count_is_not_capped(frame, log):
    from wiremere.operators import gold

    many = log(*[(str(i), "failed", "e", T[1]) for i in range(1500)])
    nothing = frame("x int", [(1,)])
    assert gold.lake_stats(nothing, nothing, many).first()["dlq_total"] == 1500
