"""Parsing and arithmetic conventions.

The three published implementations of the algorithm agree on clean input and
differ on dirty input.  Each difference is one switch here; a preset names a
consistent set of switches.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Preset:
    name: str
    # "regex": first match of <title ...>(...)</title>, rows without a match are skipped.
    # "positional": text between the first "<title>" and the first "</title>".
    title_mode: str = "regex"
    # What a positional title does when "</title>" is missing or precedes the start:
    # "skip" (row dropped), "error" (job fails), "slice" (Python slice rules).
    on_bad_title: str = "skip"
    # Replace TAB by a space in titles and links.
    normalize_tabs: bool = True
    # "marker": a blank link [[]] creates vertex '' but no edge; "keep": a real edge to ''.
    blank_links: str = "marker"
    # "double" or "float32" arithmetic for alpha / N and 1 - alpha.
    alpha_precision: str = "double"
    # "java": regex dot stops at line terminators incl. U+0085/U+2028/U+2029;
    # "newline_only": dot stops only at "\n".
    link_dot: str = "java"
    # "error": empty input fails; "empty": empty input gives an empty ranking.
    on_empty: str = "error"
    # Only links inside <text ...>...</text> (an optional, disabled-by-default scope).
    text_scope: bool = False
    # Text form of the ranked output: "tsv", "tuple_jvm", "tuple_py".
    output_format: str = "tsv"

    def __post_init__(self) -> None:
        allowed = {
            "title_mode": ("regex", "positional"),
            "on_bad_title": ("skip", "error", "slice"),
            "blank_links": ("marker", "keep"),
            "alpha_precision": ("double", "float32"),
            "link_dot": ("java", "newline_only"),
            "on_empty": ("error", "empty"),
            "output_format": ("tsv", "tuple_jvm", "tuple_py"),
        }
        for field, values in allowed.items():
            if getattr(self, field) not in values:
                raise ValueError(f"{field} must be one of {values}, got {getattr(self, field)!r}")

    def with_options(self, **kwargs) -> "Preset":
        return replace(self, **kwargs)


MAPREDUCE = Preset(name="mapreduce")

RDD_JVM = Preset(
    name="rdd_jvm",
    title_mode="positional",
    on_bad_title="error",
    normalize_tabs=False,
    blank_links="keep",
    alpha_precision="float32",
    link_dot="java",
    on_empty="empty",
    output_format="tuple_jvm",
)

RDD_PY = Preset(
    name="rdd_py",
    title_mode="positional",
    on_bad_title="slice",
    normalize_tabs=False,
    blank_links="keep",
    alpha_precision="double",
    link_dot="newline_only",
    on_empty="empty",
    output_format="tuple_py",
)

PRESETS = {p.name: p for p in (MAPREDUCE, RDD_JVM, RDD_PY)}


def get_preset(preset: str | Preset) -> Preset:
    if isinstance(preset, Preset):
        return preset
    try:
        return PRESETS[preset]
    except KeyError:
        raise ValueError(f"unknown preset {preset!r}; choose one of {sorted(PRESETS)}") from None
