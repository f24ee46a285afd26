"""K5 chain: stop, resume, another input, and a second model against the first."""

import random

import pytest
from pyspark.sql import functions as F

from scoreloop.plans import chain as C
from tests.conftest import feedback

AS_OF = "2024-02-01 00:00:00"
SETTINGS = dict(epochs=2, rounds=2, dim=64, rates={"a": 20.0})


def rows(spark, n=300, seed=1):
    rnd = random.Random(seed)
    kinds = {"human": ("warm plain story", 0.1), "ai": ("cold formal output", 0.9)}
    data = []
    for i in range(n):
        fb = rnd.choice(sorted(kinds))
        data.append((i, f"{kinds[fb][0]} number {i} {'word ' * rnd.randint(1, 9)}", kinds[fb][1], fb, f"2024-01-{rnd.randint(10, 30)}"))
    return feedback(spark, data)


class Cut(Exception):
    pass


def spied(monkeypatch, fail=None):
    """Counts the steps that run; the step ``fail`` dies after its work, before its journal entry."""
    ran = []

    def wrap(name):
        real = getattr(C.Chain, name)

        def step(self):
            ran.append(name)
            out = real(self)
            if name == fail:
                raise Cut(name)
            return out

        monkeypatch.setattr(C.Chain, name, step)

    for name in C.STEPS:
        wrap(name)
    return ran


@pytest.mark.parametrize("fail", ["split", "train"])
def test_killed_and_run_again(spark, tmp_dir, fail):
    fe = rows(spark)
    want = sorted(map(tuple, C.retrain_chain(spark, fe, AS_OF, f"{tmp_dir}/whole", **SETTINGS).collect()), key=str)
    assert [w[0] for w in want if w[1] in ("ok", "promoted")] and len(want) == 8
    with pytest.MonkeyPatch.context() as m:
        ran = spied(m, fail)
        with pytest.raises(Cut):
            C.retrain_chain(spark, fe, AS_OF, f"{tmp_dir}/cut", **SETTINGS)
        assert ran == list(C.STEPS[:C.STEPS.index(fail) + 1])
    with pytest.MonkeyPatch.context() as m:
        ran = spied(m)
        got = C.retrain_chain(spark, fe, AS_OF, f"{tmp_dir}/cut", **SETTINGS)
        assert ran == list(C.STEPS[C.STEPS.index(fail):])  # finished steps come from the journal
        assert sorted(map(tuple, got.collect()), key=str) == want
        ran.clear()
        assert sorted(map(tuple, C.retrain_chain(spark, fe, AS_OF, f"{tmp_dir}/cut", **SETTINGS).collect()), key=str) == want and ran == []


def test_other_input_is_another_run_and_must_be_better(spark, tmp_dir):
    first = {r.step: r for r in C.retrain_chain(spark, rows(spark), AS_OF, tmp_dir, **SETTINGS).collect()}
    assert first["decide"].status == "promoted" and first["evaluate"].value < 0.3
    assert first["split.train"].n_rows + first["split.val"].n_rows + first["split.test"].n_rows == first["clean"].n_rows
    second = {r.step: r for r in C.retrain_chain(spark, rows(spark), AS_OF, tmp_dir, **{**SETTINGS, "rates": {"a": 1e-6}}).collect()}
    assert second["decide"].status == "rejected" and second["evaluate"].value > first["evaluate"].value
    bad = {r.step: r for r in C.retrain_chain(spark, rows(spark).withColumn("user_feedback", F.lit("ai")).withColumn("target_score", F.lit(1.0)),
                                              AS_OF, tmp_dir, **SETTINGS).collect()}
    assert set(bad) == {"clean", "validate"} and bad["validate"].status == "failed"
    empty = {r.step: r.status for r in C.retrain_chain(spark, rows(spark).limit(0), AS_OF, tmp_dir, **SETTINGS).collect()}
    assert empty == {"clean": "ok", "validate": "failed"}
