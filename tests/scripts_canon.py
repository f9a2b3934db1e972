"""Order-insensitive canonical form of a result frame (shared by tests and scripts)."""

import pandas as pd


def canon(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)].copy()
    for c in pdf.columns:
        pdf[c] = pdf[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else
                            (str(v)[:10] if hasattr(v, "isoformat") and not isinstance(v, str) else v))
    pdf = pdf.astype(object).where(pdf.notna(), None)
    return pdf.sort_values(list(pdf.columns), key=lambda s: s.map(lambda v: (v is None, str(v)))).reset_index(drop=True)
