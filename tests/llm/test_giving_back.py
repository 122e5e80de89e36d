"""Python workers outlive their tasks: what a task has freed goes back to the system at its end."""

import pytest

from ridestar.llm import words


@pytest.mark.parametrize("fails", [False, True])
def test_memory_is_given_back_once_at_the_end_of_a_task(monkeypatch, fails):
    seen = []
    monkeypatch.setattr(words, "give_back", lambda: seen.append("end"))

    def work(batches):
        for b in batches:
            seen.append(b)
            yield b
        if fails:
            raise ValueError("a task that fails")

    got = []
    try:
        got += list(words.giving_back(work)(iter([1, 2])))
    except ValueError:
        assert fails
    assert seen == [1, 2, "end"] and got == ([] if fails else [1, 2])
