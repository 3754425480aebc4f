"""Order-insensitive comparison of two results."""


def rows(frame):
    frame = frame[sorted(frame.columns)]
    out = []
    for r in frame.astype(object).where(frame.notna(), None).itertuples(index=False):
        out.append(tuple(round(float(x), 5) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in r))
    return sorted(out, key=str)
