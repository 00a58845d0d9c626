"""Column functions that turn one raw page line into (title, outlinks).

Everything is a built-in Spark expression (Java regex, string and array
functions), so parsing runs inside whole-stage codegen with no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from surfrank.plans.presets import Preset

# --- fixed values: markup patterns that must equal the reference's ---------
TITLE_PATTERN = r"<title.*?>(.*?)<\/title>"
LINK_PATTERN = r"\[\[(.*?)\]\]"
LINK_PATTERN_NEWLINE_DOT = r"\[\[([^\n]*?)\]\]"
TEXT_BODY_PATTERN = r"<text.*?>(.*?)<\/text>"
TITLE_OPEN = "<title>"
TITLE_CLOSE = "</title>"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_tabs(c: Column | str) -> Column:
    """TAB -> space in a string column."""
    return F.translate(_col(c), "\t", " ")


def normalize_tabs_array(c: Column | str) -> Column:
    """TAB -> space in every element of an array<string> column."""
    return F.transform(_col(c), lambda x: F.translate(x, "\t", " "))


def title_regex(line: Column | str) -> Column:
    """First regex title match, null when the line has none.

    An empty title is legal, so the test is a match test, not ``!= ''``.
    """
    line = _col(line)
    return F.when(line.rlike(TITLE_PATTERN), F.regexp_extract(line, TITLE_PATTERN, 1))


def _positional_bounds(line: Column) -> tuple[Column, Column, Column]:
    """0-based start, 0-based end (-1 when missing) and the '</title>' flag."""
    open_at = F.instr(line, TITLE_OPEN)  # 1-based, 0 when missing
    close_at = F.instr(line, TITLE_CLOSE)
    start = F.when(open_at == 0, F.lit(6)).otherwise(open_at + 6)  # indexOf + 7
    end = close_at - 1
    return start, end, close_at > 0


def title_positional(line: Column | str, on_bad_title: str = "slice") -> Column:
    """Text between the first '<title>' and the first '</title>' (P2).

    ``slice``: Python slice semantics (a missing '</title>' ends the slice one
    character before the end of the line; an empty slice is '').
    ``error``: the job fails on a line where the substring is undefined.
    ``skip``: such a line yields null and is dropped like an unparsable one.
    """
    line = _col(line)
    start, end, has_close = _positional_bounds(line)
    if on_bad_title == "slice":
        stop = F.when(has_close, end).otherwise(F.length(line) - 1)
        return F.when(stop > start, F.substring(line, start + 1, stop - start)).otherwise(F.lit(""))
    ok = has_close & (end >= start)
    good = F.substring(line, start + 1, end - start)
    if on_bad_title == "error":
        return F.when(ok, good).otherwise(
            F.raise_error(
                F.concat(F.lit("unparsable page title in a line of "), F.length(line).cast("string"), F.lit(" characters"))
            )
        )
    if on_bad_title == "skip":
        return F.when(ok, good)
    raise ValueError(f"unknown on_bad_title {on_bad_title!r}")


def outlinks(line: Column | str, link_dot: str = "java") -> Column:
    """All link targets in order, lazy match, duplicates kept."""
    pattern = LINK_PATTERN if link_dot == "java" else LINK_PATTERN_NEWLINE_DOT
    return F.regexp_extract_all(_col(line), F.lit(pattern), F.lit(1))


def outlinks_text_scope(line: Column | str, link_dot: str = "java") -> Column:
    """Links inside the first <text ...>...</text> body only; none without a body (P5)."""
    line = _col(line)
    body = F.regexp_extract(line, TEXT_BODY_PATTERN, 1)
    return F.when(line.rlike(TEXT_BODY_PATTERN), outlinks(body, link_dot)).otherwise(
        F.array().cast("array<string>")
    )


def page_title(line: Column | str, preset: Preset) -> Column:
    line = _col(line)
    if preset.title_mode == "regex":
        t = title_regex(line)
    elif preset.title_mode == "positional":
        t = title_positional(line, preset.on_bad_title)
    else:
        raise ValueError(f"unknown title_mode {preset.title_mode!r}")
    return normalize_tabs(t) if preset.normalize_tabs else t


def page_links(line: Column | str, preset: Preset) -> Column:
    line = _col(line)
    if preset.normalize_tabs:
        line = F.replace(line, F.lit("\t"), F.lit(" "))  # the patterns match either, so no link need be looked at again
    return outlinks_text_scope(line, preset.link_dot) if preset.text_scope else outlinks(line, preset.link_dot)


def parse_line(line: Column | str, preset: Preset) -> tuple[Column, Column]:
    """(title, outlinks) of one line under a preset (P6).  Title is null when unparsable."""
    return page_title(line, preset).alias("title"), page_links(line, preset).alias("outlinks")
