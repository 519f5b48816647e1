"""Control-room text: labels, decimal commas and minute clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels that consumers of the result tables compare with.
OUTBOUND, INBOUND = "Ida", "Volta"
STOPPED, DELAYED, NORMAL = "PARADO", "ATRASADO", "NORMAL"
STATUS_BADGES = {STOPPED: "🟡 PARADO", DELAYED: "🔴 ATRASADO"}
STATUS_BADGE_ELSE = "• NORMAL"
BUNCHED = "🚨 COMBOIAMENTO / BUNCHING (Colados)"
SERVICE_GAP = "🔴 BURACO DE OFERTA (Espaçamento Crítico)"
WIDE = "🟡 ATENÇÃO (Espaçamento Moderado)"
REGULAR = "🟢 REGULAR (Espaçamento Ideal)"


def direction_label(sl: Column) -> Column:
    """Direction 2 runs inbound; every other value, NULL too, counts as outbound."""
    return F.when(sl == 2, INBOUND).otherwise(OUTBOUND)


def status_badge(status: Column) -> Column:
    badge = F
    for value, text in STATUS_BADGES.items():
        badge = badge.when(status == value, text)
    return badge.otherwise(STATUS_BADGE_ELSE)


def spacing_diagnosis(gap_km: Column) -> Column:
    """Diagnosis of the gap between two vehicles; the first rule that holds wins."""
    return (
        F.when(gap_km <= 0.20, BUNCHED)
        .when(gap_km >= 5.0, SERVICE_GAP)
        .when(gap_km >= 3.0, WIDE)
        .otherwise(REGULAR)
    )


def fixed(value: Column, places: int) -> Column:
    """Exact decimal with ``places`` digits, rounded once, ties away from zero."""
    return F.round(value.cast("decimal(38,15)"), places)


def decimal_comma(value: Column, places: int) -> Column:
    """Decimal text with a comma, e.g. ``12,30``."""
    return F.translate(fixed(value, places).cast("string"), ".", ",")


def minute_clock(minutes: Column) -> Column:
    """Minutes as ``MI:SS``; whole hours are dropped. Decimal arithmetic keeps 9.72 at 43 seconds."""
    seconds = F.floor(minutes.cast("decimal(12,2)") * 60).cast("long")
    minute, second = F.floor(seconds / 60).cast("long") % 60, seconds % 60
    return F.concat(F.lpad(minute.cast("string"), 2, "0"), F.lit(":"), F.lpad(second.cast("string"), 2, "0"))
