"""Developer tools: oracle comparison, plan report."""

import contextlib
import io


def explain_text(df, mode: str = "formatted") -> str:
    """The text of ``df.explain(mode)`` (public API; captured from stdout)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
