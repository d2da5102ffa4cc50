import pytest

from gridpulse.operators import modeling
from gridpulse.plans import queries

SF_DIR = "/root/testdata/sf0.001"


def settings(candidate):
    return candidate.name, candidate.base, set(candidate.space), candidate.early_stopping


@pytest.mark.parametrize("name", ["walk_forward_scores", "model_selection", "tuning_trials"])
def test_training_queries_run_the_whole_job(spark, monkeypatch, name):
    asked = {}

    def record(of):
        def run(frame, *args, **kwargs):
            asked[of] = (*args, kwargs)
            raise InterruptedError

        return run

    for of in ("walk_forward", "select_model", "tune"):
        monkeypatch.setattr(modeling, of, record(of))
    with pytest.raises(InterruptedError):
        queries.REGISTRY[name](spark, SF_DIR)
    default = [settings(c) for c in modeling.default_candidates()]
    assert default[0][1]["maxIter"] == 100 and default[1][1]["numTrees"] == 100
    if name == "model_selection":
        assert [settings(c) for c in asked["select_model"][1]] == default
    else:
        of = "tune" if name == "tuning_trials" else "walk_forward"
        assert settings(asked[of][0]) == default[0]
        assert of == "walk_forward" or asked[of][-1]["n_trials"] == 20
