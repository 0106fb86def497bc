"""The model keys on the fitted booster (300 rounds, fitted once per session)."""

from tierlake.operators import modeling as md
from tierlake.plans import queries_model as qm
from tests.conftest import SF_SMALL


def test_model_predictions_scores_every_test_row_with_the_fitted_booster(spark, monkeypatch):
    scored = []
    monkeypatch.setattr(md, "score", lambda model, df, *names, f=md.score: scored.append(model) or f(model, df, *names))
    rows = qm.q_model_predictions(spark, SF_SMALL).collect()
    assert [m.stages[-1].getNumTrees for m in scored] == [md.PODIUM_PARAMS["maxIter"]]
    assert len(rows) == qm.test_split(spark, SF_SMALL).count()
    assert all(r.in_range and r.label_matches for r in rows)
