"""DataFrame -> DataFrame operators (feature engineering, evaluation, quality, bias, explanation)."""
