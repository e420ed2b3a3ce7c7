"""Column-level helpers: every function takes and returns ``Column`` objects (JVM-side, codegen'd)."""

from triplake.functions.casts import (safe_cast, safe_long, safe_double, payment_code, vendor_code,
                                      parse_timestamp)
from triplake.functions.dates import (iso_weekday, weekday_name, trip_minutes, anio_of, mes_of,
                                      year_range_predicate)
from triplake.functions.numeric import round2, ratio, mean, nz_sum

__all__ = ["safe_cast", "safe_long", "safe_double", "payment_code", "vendor_code", "parse_timestamp",
           "iso_weekday", "weekday_name", "trip_minutes", "anio_of", "mes_of", "year_range_predicate",
           "round2", "ratio", "mean", "nz_sum"]
