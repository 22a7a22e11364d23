"""Column-level functions (F1-F9, F15, P5, P6): pure expressions, codegen-friendly."""

from .calendar import *  # noqa: F401,F403
from .numeric import *  # noqa: F401,F403
