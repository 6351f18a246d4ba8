"""Sources: table readers, typed loaders and small fixed dimensions."""

from gridpulse.sources.readers import *  # noqa: F401,F403
from gridpulse.sources import dims  # noqa: F401
