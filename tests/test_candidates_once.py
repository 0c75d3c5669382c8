"""sv_candidates works out its clusters once."""

from strandmill.operators import lookback
from strandmill.plans import signals


def test_clusters_are_looked_back_once(spark, sf, monkeypatch):
    tables = []
    look_back = lookback.look_back
    monkeypatch.setattr(lookback, "look_back", lambda *a, **k: tables.append(look_back(*a, **k)) or tables[-1])
    found = signals.sv_candidates(spark, sf)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(tables) == 1 and "MapInPandas" not in plan and "MapInArrow" not in plan
