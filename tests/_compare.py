"""Order-insensitive result comparison (floats rounded, NULL/NaN unified, timestamps ISO)."""

import math


def norm_value(x):
    if x is None:
        return "∅"
    if isinstance(x, float):
        if math.isnan(x):
            return "∅"
        return f"{x:.6g}" if abs(x) >= 1e15 else f"{round(x, 6):.6f}"
    if isinstance(x, bool):
        return str(x)
    if hasattr(x, "isoformat"):
        return x.isoformat(sep=" ") if hasattr(x, "hour") else x.isoformat()
    return str(x)


def norm_rows(rows, cols):
    order = sorted(cols)
    idx = [cols.index(c) for c in order]
    return sorted(tuple(norm_value(r[i]) for i in idx) for r in rows)
