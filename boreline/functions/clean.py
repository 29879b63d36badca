"""Cleaning and naming expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label spellings that mean the same label, and the "no label" mark.
DESIGN_SPELLINGS = ["design", "slurry"]
SHUT_OFF_SPELLINGS = ["shut_off", "shutoff", "shut_off_period"]
NO_LABEL = "na"
UNKNOWN = "Unknown"
ALL = "__ALL__"

# Selectable concentration measures; any other name means the default.
MEASURES = {
    "inline": "prop_conc_inline",
    "target": "prop_conc_target",
    "auger": "prop_conc_blend_auger",
}
DEFAULT_MEASURE = "prop_conc_blend_denso"

TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_blank(c: str | Column) -> Column:
    c = as_col(c)
    return F.when(c != "", c)


def blank_to(*candidates: str | Column, default: str = UNKNOWN) -> Column:
    """First candidate that is neither null nor empty, else ``default``."""
    return F.coalesce(*[non_blank(c) for c in candidates], F.lit(default))


def is_design(label: str | Column) -> Column:
    """True for rows labelled as the design part of a stage; null counts as false."""
    return F.coalesce(F.lower(F.trim(as_col(label))).isin(DESIGN_SPELLINGS), F.lit(False))


def normal_label(label: str | Column) -> Column:
    """One spelling per label; the "no label" mark becomes null."""
    low = F.lower(as_col(label))
    return (
        F.when(low.isin(DESIGN_SPELLINGS), "design")
        .when(low.isin(SHUT_OFF_SPELLINGS), "shut_off")
        .when(low != NO_LABEL, low)
    )


def chart_label(label: str | Column) -> Column:
    """Label as charts show it: design is drawn as slurry, "no label" as null."""
    label = as_col(label)
    low = F.lower(label)
    return F.when(low == "design", "slurry").when(low != NO_LABEL, label)


def has_label(label: str | Column) -> Column:
    label = as_col(label)
    return label.isNotNull() & (F.lower(label) != NO_LABEL)


def measure(name: str | None) -> Column:
    """The concentration measure a caller asked for."""
    return F.col(MEASURES.get(name or "", DEFAULT_MEASURE))


def safe_double(c: str | Column) -> Column:
    return as_col(c).try_cast("double")


def safe_time(c: str | Column) -> Column:
    """Text to time; blank or malformed text becomes null."""
    return F.nullif(F.trim(as_col(c)), F.lit("")).try_cast("timestamp_ntz")


def name_family(name: str | Column, pad: str | Column | None = None) -> Column:
    """Pad when given, else the first two words of the name, or three when word three is digits."""
    name = as_col(name)
    words = F.split(F.trim(name), r"\s+")
    word = [F.get(words, F.lit(i)) for i in range(3)]
    taken = F.when(word[2].rlike(r"^[0-9]+$"), F.concat_ws(" ", *word)).otherwise(F.concat_ws(" ", word[0], word[1]))
    family = F.coalesce(non_blank(taken), F.lit(UNKNOWN))
    if pad is None:
        return family
    return F.coalesce(non_blank(F.trim(as_col(pad))), family)


def time_text(c: str | Column) -> Column:
    return F.date_format(as_col(c), TIME_TEXT)


def number_text(c: str | Column) -> Column:
    """Whole numbers print without a fraction part."""
    c = as_col(c)
    whole = c.cast("bigint")
    return F.when(c == whole, whole.cast("string")).otherwise(c.cast("string"))


def point_id(*parts: str | Column) -> Column:
    return F.concat_ws(":", *[as_col(p) for p in parts])
