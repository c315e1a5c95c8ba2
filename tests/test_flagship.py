"""The flagship flow end to end at sf0.001 (the driver's smoke check, plus its invariants)."""

from tilerank import constants as K


def test_entry_ranks_every_tile(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert rows
    ranks = sorted(r["national_rank"] for r in rows)
    assert ranks == list(range(1, len(rows) + 1))
    # survey-triggered (approved) tiles come first
    n_flag = sum(1 for r in rows if r["field_survey_triggered"])
    assert all(r["field_survey_triggered"] for r in rows if r["national_rank"] <= n_flag)
    for r in rows:
        assert r["field_survey_triggered"] == (r["confidence_tier"] == K.TIER_APPROVED)
        assert r["inference_status"] == K.INFERENCE_STATUS
        assert r["cv_predicted_speed"] is not None
        if K.SUFFICIENT_MARKER not in r["confidence_tier"]:
            assert r["top_shap_driver"] is None and r["top_shap_value"] is None
        if not r["field_survey_triggered"]:
            assert r["priority_score"] is None
