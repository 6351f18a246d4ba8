"""Column-expression helpers (all JVM-side, codegen-friendly)."""

from gridpulse.functions.scalars import *  # noqa: F401,F403
from gridpulse.functions.jsonx import *  # noqa: F401,F403
