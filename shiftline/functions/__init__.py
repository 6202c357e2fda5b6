"""Column expressions shared by all plans (all JVM-side built-ins)."""

from shiftline.functions.scalar import *  # noqa: F401,F403
from shiftline.functions import measures  # noqa: F401
