"""Clock times and weekday masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of masks (lowest bit Monday) and of days.
NAMED = {127: "Zilnic", 31: "Luni - Vineri", 96: "Sâmbătă - Duminică", 63: "Luni - Sâmbătă", 95: "Luni - Vineri și Duminică"}
DAYS = ["Luni", "Marți", "Miercuri", "Joi", "Vineri", "Sâmbătă", "Duminică"]


def weekdays(mask: Column) -> Column:
    """Days of a mask given as text; named masks by their name, otherwise a list; all days where the text is no number or has no day."""
    m = F.pmod(mask.try_cast("long"), F.lit(128))
    named = F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv])
    chosen = F.array_compact(F.array(*[F.when(F.shiftright(m, i) % 2 == 1, d) for i, d in enumerate(DAYS)]))
    return F.coalesce(F.try_element_at(named, m.cast("int")), F.nullif(F.array_join(chosen, ", "), F.lit("")), F.lit("Zilnic"))


def clock(seconds: Column) -> Column:
    """HH:MM of seconds given as text, hours modulo 24, negative ones counted backwards; null where the text is no number."""
    s = seconds.try_cast("long")
    hours, minutes = F.pmod(F.floor(s / 3600), F.lit(24)), F.floor(F.pmod(s, F.lit(3600)) / 60)
    return F.concat(F.lpad(hours.cast("string"), 2, "0"), F.lit(":"), F.lpad(minutes.cast("string"), 2, "0"))
