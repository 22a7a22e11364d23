"""Sources and sinks (S1-S7) and the canonical readings tables."""

from .fixtures import readings_hourly, readings_per_event  # noqa: F401
from .readers import (fit_or_load, load_params, read_first_available, read_readings,  # noqa: F401
                      rollup_readings, save_params, slice_rows, write_readings, write_report)
