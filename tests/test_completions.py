"""Completions: each prompt is asked for successfully once, whatever fails."""

import os

import pytest

from tidemark.operators import completions as C


def prompts(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "id int, prompt string").repartition(3)


def service(folder, fails):
    """Answers in capitals; notes every answered prompt in a file of its own; fails as told."""

    def ask(batch):
        for p in batch:
            calls = len(os.listdir(folder))
            open(f"{folder}/call-{calls}-{os.getpid()}-{os.urandom(4).hex()}", "w").close()
            if fails(p, calls):
                raise RuntimeError(f"no answer to {p}")
        for p in batch:
            with open(f"{folder}/done-{p}-{os.urandom(4).hex()}", "w"):
                pass
        return [p.upper() for p in batch]

    return ask


def answered(folder):
    return sorted(f.split("-")[1] for f in os.listdir(folder) if f.startswith("done"))


def test_every_third_call_fails(spark, tmp_path):
    calls, ledger = tmp_path / "calls", f"file:{tmp_path}/ledger"
    calls.mkdir()
    texts = [f"p{i}" for i in range(23)] + ["p1", "p1", None, ""]
    every_third = lambda p, n: n % 3 == 2
    out = C.complete_once(prompts(spark, texts), service(str(calls), every_third), ledger, "reply", batch=4, attempts=20)
    got = {r.id: r for r in out.collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i].reply == (None if t is None else t.upper()) and got[i].error is None
        assert (got[i].generated_at is None) == (t is None)
    assert answered(calls) == sorted({t for t in texts if t is not None})
    again = C.complete_once(prompts(spark, [*texts, "new"]), service(str(calls), lambda p, n: False), ledger, "reply")
    assert again.where("reply IS NOT NULL").count() == len(texts)
    assert answered(calls) == sorted({*(t for t in texts if t is not None), "new"})


def test_a_row_that_keeps_failing_does_not_fail_the_rest(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    bad = lambda p, n: p == "bad"
    out = C.complete_once(prompts(spark, ["a", "bad", "b"]), service(str(calls), bad), ledger, batch=8)
    got = {r.id: (r.narrative, r.error) for r in out.collect()}
    assert got == {0: ("A", None), 1: (None, "RuntimeError: no answer to bad"), 2: ("B", None)}
    out = C.complete_once(prompts(spark, ["a", "bad", "b"]), service(str(calls), lambda p, n: False), ledger)
    assert {r.id: (r.narrative, r.error) for r in out.collect()}[1] == ("BAD", None)
    assert answered(calls) == ["a", "b", "bad"]


def test_a_task_that_runs_again_does_not_ask_again(spark, tmp_path):
    """Batches of a first attempt are found by the second, here by evaluating the same rows twice."""
    asked = []
    fn = lambda batch: asked.append(batch) or [p for p in batch]
    assert C.ask_batch(fn, ["x", "y"], 3) == [("x", None), ("y", None)] and len(asked) == 1
    wrong = lambda batch: batch * 2 if len(batch) > 1 else batch
    assert C.ask_batch(wrong, ["x", "y"], 1) == [("x", None), ("y", None)]
    none = C.complete_once(prompts(spark, []), fn, str(tmp_path / "l"))
    assert none.collect() == [] and none.columns == ["id", "narrative", "generated_at", "error"]


@pytest.mark.parametrize("texts", [[None, None], ["same"] * 5])
def test_null_and_equal_prompts(spark, tmp_path, texts):
    out = C.complete_once(prompts(spark, texts), lambda b: [p + "!" for p in b], str(tmp_path / "l"))
    assert [r.narrative for r in out.collect()] == [None if t is None else t + "!" for t in texts]
