"""DuckDB SQL twins of the Column expressions, for the oracle queries only."""

from __future__ import annotations

from msgtriage.schema import URL_PATTERN, stop_words


def lit_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def tokens_sql(text: str, variant: str | None = "train", strip_urls: bool = True) -> str:
    """DuckDB twin of ``functions.text.tokenize``."""
    x = text
    if strip_urls:
        x = f"regexp_replace({x}, '{URL_PATTERN}', '', 'g')"
    x = f"regexp_replace(lower(trim({x})), '[^a-zA-Z]', ' ', 'g')"
    cond = "t <> ''"
    if variant is not None:
        cond += f" AND NOT list_contains({lit_list(stop_words(variant))}, t)"
    return f"list_filter(regexp_split_to_array({x}, ' +'), lambda t: {cond})"


def md5_int_sql(expr: str, digits: int = 15) -> str:
    """First ``digits`` hex digits of md5(expr) as BIGINT."""
    return f"CAST(('0x' || substr(md5({expr}), 1, {digits})) AS BIGINT)"


def initcap_sql(expr: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({expr}, ' '), "
        "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ')"
    )
