"""Column functions over raw text: JSON extraction, names, error classes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters stripped at both ends of a text (fixed values).
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

FENCE = "```"

# From the first opening to the last closing brace; tried at the start of a text only, so in time of its length.
BRACES = r"(?s)\A[^{]*+(\{.*\})"

# Error classes in the order they are tried, with the words that mark them (fixed values).
ERROR_WORDS = [
    ("api_key", ["api_key", "api key"]),
    ("authentication", ["auth", "unauthorized", "forbidden", "401", "403"]),
    ("connection", ["connect", "timeout", "econnrefused", "dns"]),
]


def strip(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.trim(text, F.lit(WHITESPACE))


def _last_brace(text: Column) -> Column:
    """Place of the last closing brace, 0 without one."""
    return F.when(text.contains("}"), F.length(text) - F.length(F.substring_index(text, "}", -1))).otherwise(0)


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def json_object(text: Column | str) -> Column:
    """The JSON object in a model answer: inside the first code fence if there is
    one, from the first ``{`` to the last ``}``; NULL where there is none.

    What stands between fence and brace does not matter, so plain searches do; only texts
    with a fence are cut at it.
    """
    text = F.col(text) if isinstance(text, str) else text
    parts = F.split(text, FENCE, 3)
    inner = F.when(text.contains(FENCE), _with(parts, lambda p: F.when(F.size(p) == 3, F.get(p, 1)).otherwise(text))).otherwise(text)
    return F.nullif(F.regexp_extract(inner, BRACES, 1), F.lit(""))


def truncated(text: Column | str) -> Column:
    """An opening brace with no closing brace after it."""
    text = F.col(text) if isinstance(text, str) else text
    return text.contains("{") & (_last_brace(text) < F.instr(text, "{"))


def safe_name(name: Column | str) -> Column:
    """Blanks and slashes become underscores."""
    return F.translate(name, " /\\", "___")


def error_class(error: Column | str, provider: Column | str) -> Column:
    """Which kind of advice an error text calls for; NULL for none."""
    error = F.lower(F.col(error) if isinstance(error, str) else error)
    provider = F.col(provider) if isinstance(provider, str) else provider
    result = None
    for label, words in ERROR_WORDS:
        hit = error.contains(words[0])
        for word in words[1:]:
            hit = hit | error.contains(word)
        value: Column | str = label
        if label == "connection":
            value = F.when((provider == "gateway") | error.contains("gateway"), "gateway").otherwise(label)
        result = F.when(hit, value) if result is None else result.when(hit, value)
    return result
