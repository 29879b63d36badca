"""Display values of the dashboards."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import as_col

# Colours, titles, weights and limits the dashboards show.
LABEL_COLORS = {
    "stage_start": "#5B5FC7",
    "ramp_up": "#D64B8B",
    "slurry": "#3BA66B",
    "ramp_down": "#D9902F",
    "shut_off": "#9A4C8D",
    "stage_end": "#4AA8B5",
}
LABEL_OTHER = "#7A8496"
PHASE_COLORS = {"pad": "#6F64C7", "prop": "#C98A2E", "flush": "#4B9F63"}
PHASE_OTHER = "#5F8FD6"
ANNOTATION_COLORS = {
    "stage_start": "#1A008B",
    "ramp_up": "#FF1892",
    "slurry": "#01FF81",
    "design": "#01FF81",
    "ramp_down": "#FEA804",
    "shut_off": "#830080",
    "stage_end": "#08FDFF",
}
PAD_ANNOTATION_COLORS = ANNOTATION_COLORS | {"stage_start": "#8A8FC9", "stage_end": "#7FB8C2"}
ANNOTATION_OTHER = "#787878"
EVENT_COLORS = {
    "pressure_surge": "rgba(211,84,0,0.20)",
    "pump_rate_drop": "rgba(40,120,181,0.20)",
    "mid_stage_shutdown": "rgba(48,52,59,0.20)",
}
EVENT_OTHER = "rgba(42,157,111,0.20)"
ANOMALY_KINDS = [
    (1, "Pressure Surges", "pressure_surge_lines", "#D35400"),
    (2, "Pump Rate Drops", "pump_rate_drop_lines", "#2878B5"),
    (3, "Mid-Stage Shutdowns", "mid_stage_shutdown_lines", "#30343B"),
    (4, "Sweep", "sweep_lines", "#2A9D6F"),
]
SCORE_PARTS = [
    ("A - Process Stability", "score_a", 0.20, "#2878B5", "process_stability", "Process Stability"),
    ("B - Event Burden", "score_b", 0.36, "#D35400", "anomaly_burden", "Event Burden"),
    ("C - Substage Coherence", "score_c", 0.16, "#2A9D6F", "substage_coherence", "Substage Coherence"),
    ("D - Achievable Telemetry", "score_d", 0.28, "#7A5AF8", "achievable_telemetry", "Achievable Telemetry"),
]
SCORE_BANDS = [(70, "#2A9D6F"), (45, "#E6A23C")]
SCORE_LOW = "#D9534F"
SUBSTAGES = [
    (1, "stage_start", "Stage Start"),
    (2, "ramp_up", "Ramp Up"),
    (3, "design", "Design"),
    (4, "ramp_down", "Ramp Down"),
    (5, "shut_off", "Shut-Off"),
    (6, "stage_end", "Stage End"),
]
REQUIRED_SUBSTAGES = ["stage_start", "ramp_up", "design", "ramp_down", "stage_end"]
GROUND_TRUTH_COLOR = "#228B22"
GAP_STAGE_COLOR = "#D9902F"


def lookup(c: str | Column, table: dict[str, str], other: str | Column | None = None) -> Column:
    """Map a code through a fixed table."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    found = F.try_element_at(pairs, as_col(c))
    if other is None:
        return found
    return F.coalesce(found, other if isinstance(other, Column) else F.lit(other))


def band_color(score: str | Column) -> Column:
    score = as_col(score)
    banded = F
    for limit, color in SCORE_BANDS:
        banded = banded.when(score >= limit, color)
    return banded.otherwise(SCORE_LOW)


def driver_title(code: str | Column) -> Column:
    return lookup(code, {p[4]: p[5] for p in SCORE_PARTS}, as_col(code))


def event_title(code: str | Column) -> Column:
    return F.initcap(F.replace(as_col(code), F.lit("_"), F.lit(" ")))
