"""SHAP values of fitted models, importances and textual explanations."""
