"""The lists that both the queries and their check SQL are built from, pinned apart from them."""

from riskloom.functions import fixed_values as fv
from riskloom.sources.synthetic import CORE_DRAWS, bureau_draws


def test_column_lists():
    assert (len(fv.CORE_FEATURES), len(fv.LOOKUP_FEATURES), len(fv.SCORING_NUMERICS)) == (33, 60, 29)
    for names in (fv.CORE_FEATURES, fv.LOOKUP_FEATURES):
        assert len(set(names)) == len(names)
    assert fv.CORE_FEATURES[:3] == ["age", "monthly_income", "num_active_loans"]
    assert fv.CORE_FEATURES[-2:] == ["ontime_ratio_12m", "revolving_ratio"]
    assert [n for n in fv.LOOKUP_FEATURES if n.startswith("bureau_")] == [f"bureau_score_comp_{i:02}" for i in range(1, 11)] + ["bureau_attr_001"]
    assert {n: len(v) for n, v in fv.SCORING_CATEGORIES.items()} == {"gender": 2, "employment_type": 5, "education": 5, "region_code": 18}


def test_score_terms():
    assert fv.LOGIT_INTERCEPT == -2.5
    assert [round(w, 3) for *_, w in fv.LOGIT_TERMS] == [0.55, 0.30, 0.75, 0.45, 0.30, 0.25, 0.38, 0.18, 0.80, -0.015, -0.25, -0.30]
    assert (fv.PD_APPROVE_BELOW, fv.PD_REVIEW_BELOW, fv.SCORE_CUTS) == (0.10, 0.30, [580, 670, 740, 800])


def test_application_odds():
    assert fv.REGION_CODES[0] == "DKI" and len(fv.REGION_WEIGHTS) == 18
    assert all(3 <= w <= 30 for w in fv.REGION_WEIGHTS) and len(set(fv.REGION_WEIGHTS)) > 5
    assert dict(zip(fv.PRODUCT_CODES, fv.PRODUCT_WEIGHTS)) == {"CC": 25, "KTA": 22, "KPR": 10, "KKB": 12, "BNPL": 18, "FINTECH": 20, "MODAL": 8}
    assert dict(zip(fv.CHANNELS, fv.CHANNEL_WEIGHTS)) == {"Branch": 20, "Mobile App": 40, "Web": 20, "Agent": 10, "Partner": 10}
    assert len(fv.LENDER_CODES) == 12 and fv.LENDER_CODES[0] == "BNK001" and fv.LENDER_CODES[-1] == "FIN006"


def test_draws():
    draws = CORE_DRAWS | bureau_draws()
    assert len(CORE_DRAWS) == 24 and len(draws) == 194
    assert all(d.low <= d.high for d in draws.values())
    assert {d.kind for d in draws.values()} <= {"integer", "real", "product_integer", "product_real", "choice"}
    assert (draws["age"].kind, draws["kol_status"].kind) == ("integer", "integer")
