import contextlib
import io


def explain_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``DataFrame.explain`` prints it."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
