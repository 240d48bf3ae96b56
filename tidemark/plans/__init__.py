"""Fitted plans. ``fit_*`` looks at data once and returns a small plan object;
``plan.transform(df)`` applies it as column expressions."""
