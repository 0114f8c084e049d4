"""Column expressions: everything here stays inside the JVM."""

from tasteloom.functions.dates import epoch_seconds, register_change_date, yearmonth
from tasteloom.functions.numeric import liked_adjustment, log_base
from tasteloom.functions.text import delimited, genre_text, strip_controls, whitespace_tokens
from tasteloom.functions.vectors import cosine, dot, l2_norm, score_in

__all__ = [
    "cosine",
    "delimited",
    "dot",
    "epoch_seconds",
    "genre_text",
    "l2_norm",
    "liked_adjustment",
    "log_base",
    "register_change_date",
    "score_in",
    "strip_controls",
    "whitespace_tokens",
    "yearmonth",
]
