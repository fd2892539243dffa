"""The scored bundle is the one that ml_quantile_boost trains."""

import pytest

from kestrel.plans import modeling as m


class Fitted(Exception):
    pass


def test_batch_score_fits_all_rounds(views, monkeypatch):
    def fit(v, rounds=m.BOOST_ROUNDS):
        raise Fitted(rounds)

    monkeypatch.setattr(m, "fit_delay_quantiles", fit)
    monkeypatch.setattr(m, "_BUNDLES", {})
    for query in (m.ml_batch_score, m.ml_quantile_boost, m.ml_feature_importance):
        with pytest.raises(Fitted) as e:
            query(views)
        assert e.value.args == (m.BOOST_ROUNDS,)
